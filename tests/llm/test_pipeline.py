"""The pipeline's stages against their operators, and its edge cases."""

import re

import corpus_pipeline
from pitpanel.llm.decontaminate import contaminated
from pitpanel.llm.secrets import find_secrets
from pitpanel.llm.simhash import near_duplicates
from pitpanel.llm.toxicity import toxicity_scores
from pitpanel.session import materialize

SF = "/root/testdata/sf0.01"


def test_each_stage_does_what_its_operator_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name, f in list(stages.items())[:4]:
        out = materialize(f(spark, docs, SF), "test-stage")
        assert out.schema.names == docs.schema.names
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert before - ids == {r.doc_id for r in toxicity_scores(docs, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            assert ids == {r.component_id for r in near_duplicates(docs).collect()}
        elif name == "decontamination":
            assert before - ids == {r.doc_id for r in contaminated(docs, bench).collect()}
            items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in bench.collect()]
            for r in out.collect():
                text = " ".join(re.findall(r"\w+", r.text.lower()))
                assert not any(len(i.split()) > 5 and i in text for i in items)
        else:
            assert ids == before
            assert {r.spans for r in find_secrets(out).select("spans").collect()} == {""}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        kept[name] = len(ids)
        docs = out
    assert 500 < kept["secrets"] <= kept["near_duplicates"] < 1000
    last = stages["mixing"](spark, docs, SF)
    assert last.count() == kept["secrets"]


def test_nulls_repeats_and_an_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string, _row string, _secret_spans string"
    rows = [(None, None, None, None, None, "a"), (1, "", "en", "s", 0, "b"), (2, "token=abcdefgh here", "en", "s", 19, "c"),
            (2, "token=abcdefgh here", "en", "s", 19, "c"), (None, "only this long text here", "de", "s", 3, "d"), (9, "x " * 30000, "en", None, 1, None)]
    rows = [(*r, "e", "f") for r in rows]
    for data, want in ((rows, 4), ([], 0)):
        docs = spark.createDataFrame(data, schema)
        for name, f in corpus_pipeline.STAGES:
            out = materialize(f(spark, docs, SF), "test-stage")
            if name == "toxicity":          # six rows teach it nothing; it must only not fail
                assert out.columns == docs.columns
                continue
            docs = out
            if name != "mixing":
                assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert docs.count() == want
