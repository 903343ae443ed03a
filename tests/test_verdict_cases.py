"""Inputs that once lost rows or failed."""

from pyspark.sql import functions as F

from pitpanel.operators.filters import MAX_IN_LIST, key_filter
from pitpanel.sources.landed import records


def test_records_without_the_flag_are_kept(spark):
    pages = spark.createDataFrame([([(1, None), (2, True), (3, False)],)], "products array<struct<sku:int,active:boolean>>")
    assert [r.sku for r in records(pages).collect()] == [1, 2]


def test_key_filter_keeps_column_order(spark):
    df = spark.createDataFrame([(1.0, "7"), (2.0, "8")], "v double, sku string")
    for keys in (["7"], ["7"] + [f"x{i}" for i in range(MAX_IN_LIST)], df.where("sku = '7'").select("sku")):
        out = key_filter(df, "sku", keys)
        assert out.columns == ["v", "sku"] and out.agg(F.sum("v")).first()[0] == 1.0


def test_run_logs_with_text_numbers_or_no_start_are_kept(spark, tmp_path):
    from pitpanel.sources.runlogs import read_run_logs, runs_summary
    texts = {"a": '{"status": "ok", "api_calls": "564", "errors": ["x"]}', "b": '{"started_at": "2026-04-21", "api_calls": 3}',
             "c": '{"started_at": "2026', "d": '{"started_at": "2026-04-22", "prices_rows": "many"}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = sorted((r.started_at or "", r.api_calls, r.prices_rows, r.errors) for r in read_run_logs(spark, str(tmp_path)).collect())
    assert got == [("", 564, None, ["x"]), ("2026-04-21", 3, None, None), ("2026-04-22", None, None, None)]
    assert runs_summary(spark, str(tmp_path)).count() == 3


def test_time_bounds_follow_the_folders_in_any_session_zone(spark):
    import datetime as dt
    from pitpanel.operators.filters import latest_snapshot, time_range
    at = lambda h: dt.datetime(2026, 4, 21, h, tzinfo=dt.timezone.utc)
    rows = [("1", at(1), 2026, 4, 21), ("2", at(2), 2026, 4, 21), ("3", at(2), None, None, None), ("4", at(9), 2026, 4, 21)]
    df = spark.createDataFrame(rows, "sku string, fetched_at timestamp, year int, month int, day int")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            for start, end, want in ((None, at(3), "123"), (at(2), at(3), "23"), (at(2), None, "234")):
                got = sorted(r.sku for r in time_range(df, "fetched_at", start, end).collect())
                assert got == list(want), (z, start, end)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.sku for r in latest_snapshot(df.where("year is null"), "fetched_at").collect()] == ["3"]


def test_null_group_keeps_its_median(spark):
    from pitpanel.operators.audit import value_summary
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r.g: r.median_value for r in value_summary(df, "v", ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_days_without_runs_and_unfinished_runs(spark):
    from pitpanel.operators.monitor import alerts, report_lines
    rows = [("2026-04-20", "2026-04-20 01:00:00", "2026-04-20 01:10:00", "ok", 5), ("2026-04-22", "2026-04-22 01:00:00", None, "running", None)]
    runs = spark.createDataFrame(rows, "d string, s string, f string, status string, n long").selectExpr(
        "cast(d as timestamp_ntz) run_day", "cast(s as timestamp_ntz) started_at", "cast(f as timestamp_ntz) finished_at", "status",
        "n products_fetched", "n metadata_changed_rows", "n api_calls")
    found = alerts(runs, today="2026-04-24", expected_runs=1)
    assert {(r.run_day.day, r.value) for r in found.where("alert = 'too_few_runs'").collect()} == {(21, 0.0), (23, 0.0)}
    lines = {(r.run_day.day, r.section, r.line_no): r.text for r in report_lines(runs, found).collect()}
    assert lines[(21, 2, 0)] == "- Total: **0** (ok: 0, errors: 0)"
    assert lines[(22, 2, 1)] == "| 2026-04-22 01:00:00 | running | ? | ? | ? | ? |"


def land(path, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / "page-1.json").write_text(text)
    return str(path)


def test_scalars_delivered_as_text_are_kept(spark, tmp_path):
    from pitpanel.sources.landed import build_metadata, build_prices, read_pages
    as_text = '{"currentPage": 1, "totalPages": 1, "total": 1, "products": [{"sku": "77", "regularPrice": "9.5", "onSale": "true", "classId": "3", "customerReviewCount": "4.0", "name": 5}]}'
    as_values = '{"currentPage": 1, "totalPages": 1, "total": 1, "products": [{"sku": 77, "regularPrice": 9.5, "onSale": true, "classId": 3, "customerReviewCount": 4, "name": "5"}]}'
    got = []
    for name, text in (("a", as_text), ("b", as_values)):
        recs = records(read_pages(spark, land(tmp_path / name, text)))
        got.append((build_prices(recs, "2026-04-21").collect(), build_metadata(recs, "2026-04-21").collect()))
    assert got[0] == got[1]
    price = got[0][0][0]
    assert (price.sku, price.regularPrice, price.onSale, price.customerReviewCount) == ("77", 9.5, True, 4)


def test_truncated_pages_and_records_without_a_key_fail_the_run(spark, tmp_path):
    import datetime as dt
    import pytest
    from pitpanel.sources.landed import read_pages
    from pitpanel.sources.runlogs import read_run_logs
    from pitpanel.streaming.intake import ingest_run
    whole = '{"currentPage": 1, "totalPages": 2, "total": 2, "products": [{"sku": 1}]}'
    for name, text in (("cut", '{"currentPage": 2, "totalPages": 2, "total": 2, "products": [{"sku"'),
                       ("keyless", '{"currentPage": 2, "totalPages": 2, "total": 2, "products": [{"name": "x"}]}')):
        folder = tmp_path / name
        land(folder, whole)
        (folder / "page-2.json").write_text(text)
        root = str(tmp_path / f"data-{name}")
        with pytest.raises(Exception):
            ingest_run(spark, records(read_pages(spark, str(folder))), root, dt.datetime(2026, 4, 21, tzinfo=dt.timezone.utc))
        assert [r.status for r in read_run_logs(spark, root + "/logs/runs").collect()] == ["error"]


def test_buckets_stay_in_order_where_a_zone_steps_back(spark):
    from pitpanel.operators.sequence import time_bucket
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")      # 2017-02-18 24:00 became 23:00
        df = spark.range(48).select((F.lit(1487372400) + F.col("id") * 1800).cast("timestamp").alias("t"))
        buckets = [r.b for r in df.orderBy("t").select(time_bucket("t", 1).alias("b")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert buckets == sorted(buckets) and len(set(buckets)) == 2


def test_percentile_with_other_aggregates_keeps_empty_groups(spark):
    from pitpanel.operators.stats import exact_median
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), ("b", None), (None, 7.0)], "g string, v double")
    got = {r.g: (r.n, r.median) for r in exact_median(df, "v", ["g"], also=[F.count("*").alias("n")]).collect()}
    assert got == {"a": (3, 2.5), "b": (1, None), None: (1, 7.0)}
