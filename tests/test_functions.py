"""Canonical JSON, content hash and scalar helpers."""

import hashlib
import json

from pyspark.sql import functions as F

from pitpanel.functions.canonical import canonical_json, content_hash, record_json
from pitpanel.functions.scalars import flatten_nested, profile_text, to_double
from pitpanel.functions.timeparts import floor_to, parse_iso


def test_hash_equals_python_canonical_json(spark):
    rows = [("123", None, True, 5, "ü/\"q\""), ("9", "x", False, None, "")]
    df = spark.createDataFrame(rows, "sku string, b string, c boolean, d long, e string")
    got = [r.h for r in df.select(content_hash(["sku", "b", "c", "d", "e"]).alias("h")).collect()]
    want = []
    for sku, b, c, d, e in rows:
        text = json.dumps({"sku": sku, "b": b, "c": c, "d": d, "e": e}, sort_keys=True,
                          separators=(",", ":"), ensure_ascii=False)
        want.append(hashlib.sha256(text.encode()).hexdigest())
    assert got == want


def test_hash_invariant_to_column_order(spark):
    df = spark.createDataFrame([("1", "a", "b")], "sku string, x string, y string")
    a = df.select(content_hash(["sku", "x", "y"])).first()[0]
    b = df.select("y", "sku", "x").select(content_hash(["y", "x", "sku"])).first()[0]
    assert a == b


def test_canonical_json_sorts_nested_keys(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [{"z": 1, "y": "é"}]}',), ("not json",)], "s string")
    got = [r[0] for r in df.select(canonical_json("s")).collect()]
    assert got == ['{"a":[{"y":"é","z":1}],"b":1}', None]


def test_record_json_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None)], "sku string, v string")
    assert df.select(record_json(["v", "sku"])).first()[0] == '{"sku":"1","v":null}'


def test_scalars(spark):
    df = spark.createDataFrame([("12.5", "x" * 100, "2026-04-22 07:50:57.123456+00:00"),
                                ("n/a", "short", "2026-04-22T07:50:57Z")], "p string, t string, s string")
    r = df.select(to_double("p").alias("p"), profile_text("t").alias("t"), parse_iso("s").alias("s")).collect()
    assert r[0].p == 12.5 and r[1].p is None
    assert len(r[0].t) == 80 and r[0].t.endswith("...") and r[1].t == "short"
    assert r[0].s is not None and r[1].s is not None


def test_floor_to_is_zone_free(spark):
    df = spark.createDataFrame([("2024-03-31 23:30:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = df.select(floor_to("t", "month").alias("m"), floor_to("t", "quarter").alias("q"),
                      floor_to("t", "day").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.m.month, r.q.month, r.d.day) == (3, 1, 31)


def test_flatten_nested(spark):
    df = spark.createDataFrame([(1, [1.5, 2.0], {"a": 1})], "id long, v array<double>, m map<string,int>")
    r = flatten_nested(df).first()
    assert r.v == "[1.5,2.0]" and r.m == '{"a":1}' and r.id == 1


def test_updated_since_and_show_fields(spark):
    from pitpanel.operators.filters import updated_since
    from pitpanel.schemas import METADATA_FIELDS, PRICE_FIELDS, show_fields
    df = spark.createDataFrame([("2026-04-20T10:00:00",), ("2026-04-10",), ("junk",)], "itemUpdateDate string")
    assert updated_since(df, "2026-04-14").count() == 1
    f = show_fields().split(",")
    assert f == sorted(f) and set(f) == set(PRICE_FIELDS) | set(METADATA_FIELDS) and len(f) == len(set(f))


def test_json_paths_on_arrays_and_entries(spark):
    from pitpanel.functions.canonical import json_entries, json_items
    df = spark.createDataFrame([('[{"name":"TV","id":"c1"},{"name":"OLED","id":"c2"}]', '{"a":1,"b":"x"}')],
                               "categoryPath string, props string")
    assert df.select(F.get_json_object("categoryPath", "$[0].name")).first()[0] == "TV"
    names = [r.col.name for r in df.select(json_items("categoryPath", "struct<name:string,id:string>")).collect()]
    assert names == ["TV", "OLED"]
    assert sorted((r.key, r.value) for r in df.select(json_entries("props")).collect()) == [("a", "1"), ("b", "x")]


def test_time_helpers(spark):
    import datetime as dt
    from pitpanel.functions.timeparts import partition_parts, run_stamp, seconds_between
    df = spark.createDataFrame([(dt.datetime(2026, 4, 22, 7, 50, 57, 123456), dt.datetime(2026, 4, 22, 8, 1, 58))],
                               "s timestamp_ntz, f timestamp_ntz")
    r = df.select(*partition_parts("s"), run_stamp(F.col("s").cast("timestamp")).alias("stamp"),
                  seconds_between("s", "f").alias("d"), floor_to("s", "hour").alias("h"),
                  floor_to("s", "year").alias("y"), floor_to("s", "week").alias("w")).first()
    assert (r.year, r.month, r.day) == (2026, 4, 22)
    assert r.stamp == "2026-04-22T07-50-57Z"
    assert abs(r.d - 660.876544) < 1e-9
    assert r.h == dt.datetime(2026, 4, 22, 7) and r.y == dt.datetime(2026, 1, 1)
    assert r.w == dt.datetime(2026, 4, 20)            # Monday of that week


def test_canonical_json_nested_arrays(spark):
    df = spark.createDataFrame([('[{"z": [3, {"b": 2, "a": 1}], "y": null}]',)], "s string")
    assert df.select(canonical_json("s")).first()[0] == '[{"y":null,"z":[3,{"a":1,"b":2}]}]'
