"""Blocks of documents, and the keyed exchange between blocks.

Counting or comparing billions of small keys one row each is dominated by row
overhead.  Instead documents are packed into blocks of a few MB, a block sorts
and pre-aggregates its keys, and one row per (key range, block) carries them as
an array.  Spark deals the rows by key range, a reducer answers each row with an
array in the same order, and Spark deals the answers back to the blocks.  A key
costs at most one entry per block however often it occurs, so a hot key loads no
task.  Blocks are written once to the shared checkpoint folder: their contents
and order are then fixed, whatever executor is lost later.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.session import materialize

BLOCK_BYTES = 4 << 20
KINDS = 4        # a block's id modulo this is its kind
BLOCK_SCHEMA = "block long, kind int, ids array<long>, sizes array<long>, n_bytes long, payload binary"
EXCHANGE_SCHEMA = "part int, block long, n long, payload binary"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
          "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string over the few types used here."""
    return pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in ddl.split(", ")])


def pack(*arrays: np.ndarray) -> bytes:
    """Compressed bytes of arrays, one after the other."""
    return pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)


def unpack(payload: bytes, n: int, *kinds) -> list[np.ndarray]:
    """Inverse of :func:`pack` for arrays of ``n`` entries each."""
    kinds = [np.dtype(k) for k in kinds]
    raw = pa.decompress(payload, decompressed_size=n * sum(k.itemsize for k in kinds), codec="zstd", asbytes=True)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(raw, dtype=k, count=n, offset=at))
        at += n * k.itemsize
    return out


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts (sizes the exchange, not the data)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()["b"]


def n_parts(n_bytes: int, per_part: int = 8 << 20) -> int:
    """Key ranges of an exchange: one for each ``per_part`` bytes of text, 16 at least."""
    return max(16, -(-n_bytes // per_part))


def pack_blocks(batches, block_bytes: int):
    """Arrow batches of (id, text, kind) to block rows."""
    schema = arrow_schema(BLOCK_SCHEMA)
    base = TaskContext.get().partitionId() << 32
    waiting: dict[int, list] = {}
    made = 0

    def row(kind):
        nonlocal made
        ids, texts, _ = waiting.pop(kind)
        joined = b"".join(texts)
        out = pa.RecordBatch.from_arrays(
            [pa.array([(base + made) * KINDS + kind], pa.int64()), pa.array([kind], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([len(joined)], pa.int64()),
             pa.array([pa.compress(joined, codec="zstd", asbytes=True)], pa.binary())], schema=schema)
        made += 1
        return out

    for batch in batches:
        for i, t, kind in zip(*(c.to_pylist() for c in batch.columns)):
            t = t or b""
            ids, texts, size = waiting.get(kind, ([], [], 0))
            if texts and size + len(t) > block_bytes:
                yield row(kind)
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            waiting[kind] = (ids, texts, size + len(t))
    for kind in sorted(waiting):
        yield row(kind)


def make_blocks(docs: DataFrame, kind=None, doc_id: str = "doc_id", text: str = "text",
                block_bytes: int = BLOCK_BYTES, name: str = "blocks") -> DataFrame:
    """Pack documents into blocks of about ``block_bytes`` bytes of one ``kind`` each.

    A document is never split, so one longer than ``block_bytes`` is a block of
    its own.  Null texts are empty; null ids stay null.
    """
    kind = F.lit(0) if kind is None else kind
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"), kind.cast("int").alias("kind"))
    return materialize(rows.mapInArrow(functools.partial(pack_blocks, block_bytes=block_bytes), BLOCK_SCHEMA), name)


def open_block(row: dict) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, bounds and bytes of a block row."""
    raw = pa.decompress(row["payload"], decompressed_size=row["n_bytes"], codec="zstd", asbytes=True)
    bounds = np.zeros(len(row["sizes"]) + 1, dtype=np.int64)
    np.cumsum(np.array(row["sizes"], dtype=np.int64), out=bounds[1:])
    return row["ids"], bounds, np.frombuffer(raw, dtype=np.uint8)


def deal(block: int, keys: np.ndarray, parts: int, *columns: np.ndarray):
    """Rows (part, block, n, payload) for entries sorted by key, and the order used.

    The part is taken from high bits of the key, so each part holds one slice.
    """
    part = part_of(keys, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    rows = []
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        at = order[lo:hi]
        rows.append((int(part[at[0]]), block, len(at), pack(keys[at], *(c[at] for c in columns))))
    return rows, order


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def table(rows: list[tuple], ddl: str) -> pa.Table:
    """Arrow table of row tuples."""
    schema = arrow_schema(ddl)
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def by_block(blocks: DataFrame, answers: DataFrame, f, ddl: str) -> DataFrame:
    """Bring the answers of an exchange back to their blocks: ``f(block row, answer rows)``
    returns row tuples.  ``answers`` rows are (part, block, n, payload)."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        answered = sorted(right.to_pylist(), key=lambda r: r["part"])
        return table([x for row in left.to_pylist() for x in f(row, answered)], ddl)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(both, ddl)


def reduce_parts(entries: DataFrame, f, ddl: str = EXCHANGE_SCHEMA) -> DataFrame:
    """All rows of a key range at once: ``f(rows)`` returns row tuples."""
    def one(rows: pa.Table) -> pa.Table:
        return table(f(sorted(rows.to_pylist(), key=lambda r: r["block"])), ddl)

    return entries.groupBy("part").applyInArrow(one, ddl)


def map_blocks(blocks: DataFrame, f, ddl: str) -> DataFrame:
    """``f(block row)`` returns row tuples, for every block."""
    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from table(f(row), ddl).to_batches() or []

    return blocks.mapInArrow(each, ddl)
