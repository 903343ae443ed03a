"""Token ids in binary files of compressed bit or byte planes.

A file is laid out as::

    header     "<4sBBHIqq"   magic, plane kind, bytes of an id, 0, ids of a chunk, partition, ids before
    chunks     every chunk's planes, one zstandard frame after the other; a plane of zeros has none
    documents  a zstandard frame: doc_id (int64), 1 where it is null (uint8), ids (int64) of each
    index      "<qII" + one "<I" a plane, for every chunk: offset, ids, crc32 of the ids, plane sizes
    footer     "<qqqqqq4s"   offset and size of documents, offset of index, chunks, documents, ids; magic

followed by one line feed.  All numbers are little-endian.  A chunk's ids (``CHUNK`` of them, fewer in the
last) are transposed, so that plane ``k`` holds byte (or bit) ``k`` of all of them.  A file starts
and ends with a document; "ids before" counts the ids of the earlier files of its partition.

Documents are range-partitioned by id, and each partition writes its files in order, so the
files keep the order of the whole table.  Spark's text writer puts the bytes down (a
binary value cast to a string is written as it is), hence its commit protocol
covers lost executors, and any file system that Spark knows can hold the files.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.blocks import arrow_schema, text_bytes
from pitpanel.session import checkpoint_dir

MAGIC = b"IDP1"
HEADER, FOOTER, ENTRY = struct.Struct("<4sBBHIqq"), struct.Struct("<qqqqqq4s"), struct.Struct("<qII")
PLANES = {"byte": 4, "bit": 32}
KINDS = list(PLANES)
CHUNK = 1 << 16             # ids of a chunk
FILE_IDS = 1 << 24          # a file ends with the document that reaches this
PART_BYTES = 32 << 20       # text of a partition ...
MOST_PARTS = 1 << 16        # ... or more, so that the offsets of all partitions stay small
END = 2
SLICE = 40 << 20            # text that is encoded at a time
ID = np.dtype("<u4")


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Byte or bit planes of ids, lowest first; a plane of zeros is empty."""
    planes = np.ascontiguousarray(ids.astype(ID).view(np.uint8).reshape(-1, 4).T)
    if kind == "bit":
        bits = np.unpackbits(planes[:, :, None], axis=2, bitorder="little")           # byte, id, bit
        planes = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """Inverse of :func:`to_planes`."""
    width = n if kind == "byte" else -(-n // 8)
    rows = np.zeros((PLANES[kind], width), dtype=np.uint8)
    for k, p in enumerate(planes):
        if p:
            rows[k] = np.frombuffer(p, dtype=np.uint8)
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little").reshape(4, 8, n)
        rows = np.packbits(bits, axis=1, bitorder="little").reshape(4, n)
    return np.ascontiguousarray(rows.T).reshape(-1).view(ID)


class FileWriter:
    """Collects documents into the bytes of one file."""

    def __init__(self, kind: str, chunk: int, part: int, before: int):
        self.kind, self.chunk = kind, chunk
        self.out = bytearray(HEADER.pack(MAGIC, KINDS.index(kind), ID.itemsize, 0, chunk, part, before))
        self.index, self.ids, self.sizes = bytearray(), [], []
        self.n_ids, self.waiting, self.rest = 0, [], 0
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.rest += len(ids)
        if self.rest >= self.chunk:
            self._flush(self.rest // self.chunk * self.chunk)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, ID)
        for at in range(0, n, self.chunk):
            ids = flat[at:min(at + self.chunk, n)]
            frames = [self.press.compress(p) if p else b"" for p in to_planes(ids, self.kind)]
            self.index += ENTRY.pack(len(self.out), len(ids), zlib.crc32(ids.astype(ID).tobytes()))
            self.index += struct.pack(f"<{len(frames)}I", *map(len, frames))
            for f in frames:
                self.out += f
        self.waiting, self.rest = [flat[n:]], self.rest - n

    def close(self) -> bytes:
        self._flush(self.rest)
        docs = self.press.compress(
            np.array([i or 0 for i in self.ids], "<i8").tobytes() + np.array([i is None for i in self.ids], np.uint8).tobytes()
            + np.array(self.sizes, "<i8").tobytes())
        at = len(self.out)
        n_chunks = len(self.index) // (ENTRY.size + 4 * PLANES[self.kind])
        return bytes(self.out) + docs + bytes(self.index) + FOOTER.pack(at, len(docs), at + len(docs), n_chunks, len(self.ids), self.n_ids, MAGIC)


class FileReader:
    """Documents and ids of one file, by chunk."""

    def __init__(self, content: bytes):
        content = memoryview(content)
        self.content = content
        magic, kind, size, _, self.chunk, self.part, self.before = HEADER.unpack_from(content, 0)
        at, length, index, self.n_chunks, self.n_docs, self.n_ids, end = FOOTER.unpack_from(content, len(content) - 1 - FOOTER.size)
        if (magic, end, size) != (MAGIC, MAGIC, ID.itemsize):
            raise ValueError("not a file of token id planes")
        self.kind, self.index = KINDS[kind], index
        self.docs = (at, length)

    def documents(self) -> tuple[list, np.ndarray]:
        """Ids of the documents (None: null), and the ids each of them has."""
        at, length = self.docs
        raw = zstandard.ZstdDecompressor().decompress(self.content[at:at + length])
        n = self.n_docs
        null = np.frombuffer(raw, np.uint8, n, 8 * n)
        ids = [None if z else i for i, z in zip(np.frombuffer(raw, "<i8", n).tolist(), null.tolist())]
        return ids, np.frombuffer(raw, "<i8", n, 9 * n)

    def read_chunk(self, i: int) -> np.ndarray:
        n_planes = PLANES[self.kind]
        entry = self.index + i * (ENTRY.size + 4 * n_planes)
        at, n, crc = ENTRY.unpack_from(self.content, entry)
        planes = []
        for size in struct.unpack_from(f"<{n_planes}I", self.content, entry + ENTRY.size):
            planes.append(zstandard.ZstdDecompressor().decompress(self.content[at:at + size]) if size else b"")
            at += size
        ids = from_planes(planes, n, self.kind)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"chunk {i} of partition {self.part} is damaged")
        return ids

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; only their chunks are decompressed."""
        if n <= 0:
            return np.zeros(0, ID)
        first, last = start // self.chunk, (start + n - 1) // self.chunk
        ids = np.concatenate([self.read_chunk(i) for i in range(first, last + 1)])
        return ids[start - first * self.chunk:][:n]

    def each(self):
        """(document id, start in the file, ids) one after the other, holding a chunk and a document."""
        ids, sizes = self.documents()
        held, chunk, start = np.zeros(0, ID), 0, 0
        for doc_id, n in zip(ids, sizes.tolist()):
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.read_chunk(chunk))
                have += len(parts[-1])
                chunk += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, start, held[:n]
            held, start = held[n:], start + n


@functools.lru_cache(maxsize=2)
def _tokenizer(model: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core
    from tokenizers import Tokenizer
    return Tokenizer.from_str(model)


class Encoder:
    """Ids of whole texts, as one array and the bounds of each text.

    With ``by_word``, texts are cut at ASCII white space and the library encodes each different word
    once, hundreds of words in one text (offsets tell whose an id is): for a tokenizer that drops white space
    and never looks across it, that gives the ids of the whole text.  Otherwise whole texts go to the library.
    """

    def __init__(self, model: str, by_word: bool):
        self.model, self.by_word = _tokenizer(model), by_word

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], ID), np.cumsum([0, *map(len, ids)])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) + 1 for w in words], out=starts[1:])
        found = self.model.encode_batch([" ".join(words)], add_special_tokens=False)[0]
        owner = np.searchsorted(starts, [a for a, _ in found.offsets], side="right") - 1
        if np.any(np.diff(owner) < 0):
            return self._encode(words)
        return np.array(found.ids, ID), np.searchsorted(owner, np.arange(len(words) + 1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            return self._encode(texts.to_pylist())
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        ids, sizes = [np.zeros(0, ID)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(coded.dictionary), 512):
            x, cuts = self._encode_words(coded.dictionary.slice(i, 512).to_pylist())
            ids.append(x)
            sizes.append(np.diff(cuts))
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        first = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[word]
        ends = np.zeros(len(word) + 1, dtype=np.int64)
        np.cumsum(n, out=ends[1:])
        out = [ids[:0]]
        for i in range(0, len(word), 1 << 18):                                    # bounds the index arrays
            m = n[i:i + (1 << 18)]
            out.append(ids[np.repeat(first[word[i:i + (1 << 18)]] - np.cumsum(m) + m, m) + np.arange(m.sum())])
        return np.concatenate(out), ends[words.offsets.to_numpy() - words.offsets[0].as_py()]


def _slices(batches, size: int):
    """Ids and texts of slices of about ``size`` bytes of text, a row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(lengths) - lengths) // size
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            rows = batch.slice(a, b - a)
            yield rows.column(0).to_pylist(), rows.column(1)


def _write_task(batches, model, by_word: bool, end: int | None, kind: str, chunk: int, file_ids: int):
    encoder, part, before, out = Encoder(model.value, by_word), TaskContext.get().partitionId(), 0, None
    tail = np.array([] if end is None else [end], ID)

    def row():
        return pa.RecordBatch.from_arrays([pa.array([out.close()], pa.binary())], names=["payload"])

    for ids, texts in _slices(batches, SLICE):
        found, cuts = encoder.encode(texts)
        for doc_id, a, b in zip(ids, cuts, cuts[1:]):
            out = out or FileWriter(kind, chunk, part, before)
            out.add(doc_id, np.concatenate([found[a:b], tail]))
            if out.n_ids >= file_ids:
                before += out.n_ids
                yield row()
                out = None
    if out:
        yield row()


def write_ids(docs: DataFrame, path: str, tokenizer: str, by_word: bool, end: int | None = END, doc_id: str = "doc_id",
              text: str = "text", kind: str = "byte", chunk: int = CHUNK, file_ids: int = FILE_IDS, part_bytes: int = PART_BYTES) -> None:
    """Encode whole texts and write their ids below ``path``, in ascending order of ``doc_id``.

    ``tokenizer``: path of a ``tokenizers`` file, read by the driver; see :class:`Encoder` for
    ``by_word``; ``end``: id appended to each document; ``kind``: "byte" or "bit".

    A null text is empty (its document has the end id alone); null ids come first; rows with one id are ordered by a hash
    of the text and then by their place in the table, and a hot id is dealt over partitions by both;
    an empty table gives no documents; further columns are ignored.  A very long text is encoded as a
    whole in one task and ends its file.
    """
    if kind not in PLANES:
        raise ValueError(f"kind is one of {KINDS}")
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    parts = min(MOST_PARTS, max(1, -(-text_bytes(docs, text) // part_bytes)))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("r"))
    order = ["id", "h", "r"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    task = functools.partial(_write_task, model=model, by_word=by_word, end=end, kind=kind, chunk=chunk, file_ids=file_ids)
    files = dealt.mapInArrow(task, "payload binary").select(F.col("payload").cast("string"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def _index_task(batches):
    schema = arrow_schema("path string, part long, before long, ids long, documents long, chunks long")
    for batch in batches:
        rows = [(p.as_py(), FileReader(c.as_buffer())) for p, c in zip(*batch.columns)]
        cols = list(zip(*((p, f.part, f.before, f.n_ids, f.n_docs, f.n_chunks) for p, f in rows))) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """A row per file: ``path, part, before, ids, documents, chunks``, from headers and footers."""
    return _files(spark, path).mapInArrow(_index_task, "path string, part long, before long, ids long, documents long, chunks long")


def _read_task(batches, full: bool):
    ddl = "doc_id long, part long, start long, n_tokens long, ids_crc32 long"
    schema = arrow_schema(ddl)
    if full:
        schema = schema.append(pa.field("ids", pa.list_(pa.int64())))
    for batch in batches:
        for content in batch.column(1):
            f = FileReader(content.as_buffer())
            rows, held = [], 0
            for doc_id, start, ids in f.each():
                rows.append((doc_id, f.part, f.before + start, len(ids), zlib.crc32(ids.tobytes()), *([ids.tolist()] if full else [])))
                held += len(ids) if full else 1
                if held > 1 << 20:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def read_ids(spark: SparkSession, path: str, full: bool = True) -> DataFrame:
    """The documents of the files below ``path``: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), with ``full`` the ``ids``.

    Every chunk's checksum is tested.  The offsets of the partitions (at most ``MOST_PARTS`` numbers)
    pass through the driver.
    """
    sizes = file_index(spark, path).groupBy("part").agg(F.sum("ids").alias("n")).orderBy("part").collect()
    base, at = [], 0
    for r in sizes:
        base.append((r["part"], at))
        at += r["n"]
    ddl = "doc_id long, part long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if full else "")
    docs = _files(spark, path).mapInArrow(functools.partial(_read_task, full=full), ddl)
    bases = F.broadcast(spark.createDataFrame(base, "part long, base long"))
    return docs.join(bases, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32",
                                           *(["ids"] if full else []))


def token_files(docs: DataFrame, tokenizer: str, by_word: bool = True, **options) -> DataFrame:
    """Write the ids of ``docs`` to a new folder of the shared checkpoint folder and read them back."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pitpanel-ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer, by_word, **options)
    return read_ids(spark, path, full=False)
