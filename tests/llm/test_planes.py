"""Token id files: planes, files, and the whole table against the tokenizer."""

import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pitpanel.llm.planes import (END, ID, FileReader, FileWriter, Encoder, file_index, from_planes, read_ids, to_planes,
                                 write_ids)
from pitpanel.llm.queries import op13_id_planes

MODEL = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    """Ids of whole texts, from the library."""
    t = Tokenizer.from_file(MODEL)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, END], ID) for x in texts]


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(kind, n):
    rng = np.random.default_rng(n)
    for top in (1, 256, 49408, 1 << 32):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(ID)
        assert (from_planes(to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip(kind):
    rng = np.random.default_rng(4)
    docs = [(i if i % 7 else None, rng.integers(0, 49408, n).astype(ID)) for i, n in enumerate([5, 0, 100, 64, 1000, 1, 63])]
    w = FileWriter(kind, 64, 3, 11)
    for i, ids in docs:
        w.add(i, ids)
    raw = w.close() + b"\n"
    f = FileReader(raw)
    assert (f.part, f.before, f.n_docs, f.n_ids) == (3, 11, len(docs), 1233)
    assert [(i, ids.tolist()) for i, _, ids in f.each()] == [(i, ids.tolist()) for i, ids in docs]
    flat = np.concatenate([ids for _, ids in docs])
    for start, n in ((0, 1233), (60, 10), (64, 64), (1232, 1), (5, 0)):
        assert (f.read(start, n) == flat[start:start + n]).all()
    bad = bytearray(raw)
    bad[40] ^= 255
    with pytest.raises(Exception):
        FileReader(bytes(bad)).read_chunk(0)


def test_words_give_the_ids_of_the_whole_text():
    rng = random.Random(2)
    odd = ["a", "İ", "ΣΑΣ", "é", "́", "̧́", "\x0b", "\x0c", "\x1c", "\x85", " ", " ", "　", "'s", "'", "s", "12", "<|endoftext|>",
           "<|startoftext|>", "한글", "한", "🙂", "!!", "\t", "\n", " ", "  ", "\r\n", "_", "​", "ﬁ", "x" * 200]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(400)]
    with open(MODEL) as f:
        model = f.read()
    for by_word in (True, False):
        got, cuts = Encoder(model, by_word).encode(pa.array([*texts, None, "x"]).slice(1))
        assert [got[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [w[:-1].tolist() for w in whole([*texts[1:], "", "x"])]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, at = [], 0
    for r, ids in zip(docs, whole([r["text"] for r in docs])):
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in op13_id_planes(spark, sf).collect()) == want


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_hard_rows_and_files(spark, tmp_root, kind):
    rng = random.Random(8)
    rows = [(i, " ".join(str(rng.randrange(50)) for _ in range(rng.randrange(30))), "k") for i in range(90, 0, -1)]
    rows += [(5, "hot text", "a")] * 60 + [(5, None, "b"), (5, "", "c"), (None, "no id", "d"), (None, None, "e"), (91, "long " * 30_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    path = f"{tmp_root}/{uuid.uuid4().hex}"
    write_ids(docs, path, MODEL, by_word=True, kind=kind, chunk=256, file_ids=1000, part_bytes=20_000)
    index = file_index(spark, path).collect()
    assert len(index) > 4 and sum(r["documents"] for r in index) == len(rows)
    got = sorted(read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == r["n_tokens"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], ID).tobytes())
        at += r["n_tokens"]
    want = whole([r[1] for r in rows])
    key = lambda i, ids: (-1 if i is None else i, ids)
    assert sorted(key(r["doc_id"], r["ids"]) for r in got) == sorted(key(r[0], w.tolist()) for r, w in zip(rows, want))
    empty = f"{tmp_root}/{uuid.uuid4().hex}"
    write_ids(docs.limit(0), empty, MODEL, by_word=True)
    assert read_ids(spark, empty).count() == 0
