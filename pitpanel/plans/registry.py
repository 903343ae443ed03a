"""Registered queries: one per operator of the inventory, over the fixture
views of the driver's tables.  Each takes ``(spark, sf_dir)`` and returns a
lazy DataFrame whose column names match :mod:`pitpanel.plans.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.plans import fixtures as fx
from pitpanel.plans import loaders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ATTRS = list(fx.SNAPSHOT_ATTRS)


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@query("panel_point_in_time")
def panel_point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    """JN2: every price row with the attribute version in effect then."""
    # row order is a presentation step (SRT1 is exercised by prices_range);
    # skipping it saves a sampled range shuffle of the whole panel
    return loaders.load_panel_historical(fx.fx_prices(spark, sf), fx.fx_history(spark, sf, stored=True),
                                         columns=ATTRS, sort=False, bucket_days=fx.BUCKET_DAYS)


# ---------------------------------------------------------------- helpers
GRID = 2.0 ** 20     # float aggregates are quantised to 2^-20 (see oracle module)
TOP_K = 5            # size of the relative-price choice set (most-reviewed keys)
DRIFT_DATES = ("1994-01-01", "1996-01-01", "1998-01-01")
AS_OF = "1998-01-01"
RANGE = ("1995-01-01", "1995-12-31")


def _r(c):
    """Quantise a float aggregate to multiples of 2^-20 (order-stable)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(GRID)) / F.lit(GRID)


def _latest(spark, sf):
    return loaders.load_prices_latest(fx.fx_prices(spark, sf))


def _top_reviewed(spark, sf, k: int):
    from pitpanel.operators.stats import ranked
    return ranked(_latest(spark, sf), "review_count", k, tiebreak=("sku",))


# ---------------------------------------------------------------- loaders
@query("snapshot_latest")
def snapshot_latest(spark, sf):
    """FLT3: rows of the most recent run (global max, not per key)."""
    return _latest(spark, sf)


@query("snapshot_latest_active")
def snapshot_latest_active(spark, sf):
    """FLT3 + FLT2 with a key DataFrame: latest run, active catalog only."""
    return loaders.load_prices_latest(fx.fx_prices(spark, sf),
                                      skus=fx.fx_metadata_active(spark, sf).select("sku"))


@query("prices_range")
def prices_range(spark, sf):
    """FLT1 + SRT1: inclusive time range, ordered by key and time."""
    return loaders.load_prices(fx.fx_prices(spark, sf), start=RANGE[0], end=RANGE[1])


@query("top_reviewed_history")
def top_reviewed_history(spark, sf):
    """FLT2 + SRT4: full price history of the most-reviewed keys of the latest run."""
    return loaders.load_prices(fx.fx_prices(spark, sf),
                               skus=_top_reviewed(spark, sf, TOP_K).select("sku"))


@query("sku_trajectory")
def sku_trajectory(spark, sf):
    """SRT6: one key over time (the most-reviewed key of the latest run)."""
    traj = loaders.load_prices(fx.fx_prices(spark, sf),
                               skus=_top_reviewed(spark, sf, 1).select("sku"))
    return traj.select("fetched_at", "regular_price", "sale_price", "on_sale")


@query("metadata_current_keys")
def metadata_current_keys(spark, sf):
    """SRC2 + FLT2: current attributes of the keys in the latest run."""
    return loaders.load_metadata_current(fx.fx_metadata_current(spark, sf),
                                         skus=_latest(spark, sf).select("sku"))


@query("metadata_as_of")
def metadata_as_of(spark, sf):
    """WIN1 + FLT4: attributes of every key as of a past moment."""
    return loaders.load_metadata_at(fx.fx_history(spark, sf), AS_OF)


@query("metadata_as_of_active")
def metadata_as_of_active(spark, sf):
    """WIN1 + FLT5: as-of state restricted to the current catalog."""
    return loaders.load_metadata_at(fx.fx_history(spark, sf), AS_OF,
                                    restrict_to=fx.fx_metadata_active(spark, sf))


@query("attribute_drift")
def attribute_drift(spark, sf):
    """WIN2: as-of state at several moments in one aggregation."""
    from pitpanel.operators.scd import as_of_many
    return as_of_many(fx.fx_history(spark, sf), DRIFT_DATES, ATTRS)


@query("drifted_keys")
def drifted_keys_q(spark, sf):
    """WIN2: keys whose class or department changed across the drift dates."""
    from pitpanel.operators.scd import drifted_keys
    return drifted_keys(fx.fx_history(spark, sf), DRIFT_DATES, ATTRS)


@query("attribute_grid")
def attribute_grid(spark, sf):
    """WIN2 on a long grid: keys of each class on each of 3,650 days."""
    from pitpanel.operators.scd import as_of_grid
    return as_of_grid(fx.fx_history(spark, sf, stored=True), "1992-01-01", 3650, ["class"], bucket_days=fx.BUCKET_DAYS, count="n_skus")


@query("panel_current")
def panel_current(spark, sf):
    """JN1 + PRJ7: prices LEFT JOIN current attributes."""
    return loaders.load_panel(fx.fx_prices(spark, sf), fx.fx_metadata_active(spark, sf),
                              columns=["name", "manufacturer", "department", "size"], sort=False)


@query("panel_point_in_time_window")
def panel_point_in_time_window(spark, sf):
    """JN2 with time bounds: history gets only the upper bound."""
    return loaders.load_panel_historical(fx.fx_prices(spark, sf), fx.fx_history(spark, sf, stored=True),
                                         start=RANGE[0], end=RANGE[1], columns=ATTRS, sort=False,
                                         bucket_days=fx.BUCKET_DAYS)


# ---------------------------------------------------------------- SCD core
@query("validity_intervals")
def validity_intervals(spark, sf):
    """SCD5: each version's [observed_at, valid_to)."""
    from pitpanel.operators.scd import validity_intervals as vi
    return vi(fx.fx_history(spark, sf, stored=True), bucket_days=fx.BUCKET_DAYS)


@query("content_hash")
def content_hash_q(spark, sf):
    """PRJ3: SHA-256 of the canonical JSON of every attribute and the key."""
    return fx.fx_hashed_snapshots(spark, sf)


@query("canonical_json")
def canonical_json_q(spark, sf):
    """PRJ2: JSON text with sorted keys and no whitespace."""
    from pitpanel.functions.canonical import canonical_json
    return fx.fx_raw(spark, sf).select("event_id", canonical_json("props").alias("props_canonical"))


@query("scd2_changed_rows")
def scd2_changed_rows(spark, sf):
    """SCD1 backfill: snapshot rows whose hash differs from the key's previous one."""
    from pitpanel.operators.scd import change_log
    return change_log(fx.fx_hashed_snapshots(spark, sf, stored=True), bucket_days=fx.BUCKET_DAYS)


@query("scd2_index")
def scd2_index(spark, sf):
    """SCD2: last hash, first and last sighting per key."""
    from pitpanel.operators.scd import build_index
    return build_index(fx.fx_hashed_snapshots(spark, sf))


def _step_inputs(spark, sf):
    from pitpanel.operators.scd import build_index
    snaps = fx.fx_hashed_snapshots(spark, sf)
    last = F.lit(snaps.agg(F.max("observed_at")).first()[0]).cast("timestamp_ntz")
    current = snaps.where(F.col("observed_at") == last)
    index = build_index(snaps.where(F.col("observed_at") < last))
    return current, index


@query("scd2_step_diff")
def scd2_step_diff(spark, sf):
    """JN4/JN5: one ingestion step -- changed rows of the last run."""
    from pitpanel.operators.scd import diff
    current, index = _step_inputs(spark, sf)
    return diff(current, index)[0]


@query("scd2_step_index")
def scd2_step_index(spark, sf):
    """JN6/JN7 + SET1: the index after the last run (absent keys carried)."""
    from pitpanel.operators.scd import diff
    current, index = _step_inputs(spark, sf)
    return diff(current, index)[1]


# ---------------------------------------------------------------- analyses
@query("newly_on_sale")
def newly_on_sale(spark, sf):
    """JN8 + FLT12: on sale now, not on sale in the last run >1 day older."""
    from pitpanel.operators.filters import previous_snapshot
    prices = fx.fx_prices(spark, sf)
    now = loaders.load_prices_latest(prices).select("sku", "on_sale", "sale_price")
    before = previous_snapshot(prices, "fetched_at", "1 day").select(
        "sku", F.col("on_sale").alias("prev_on_sale"), F.col("sale_price").alias("prev_sale_price"))
    j = now.join(before, on="sku", how="inner")
    return j.where(F.col("on_sale") & ~F.col("prev_on_sale")).select("sku", "sale_price", "prev_sale_price")


@query("dept_daily_average")
def dept_daily_average(spark, sf):
    """AGG10 + JN3: mean sale price and rows per (day, department)."""
    from pitpanel.functions.timeparts import floor_to
    from pitpanel.operators.stats import mean_and_count_by
    out = mean_and_count_by(fx.fx_prices(spark, sf), fx.fx_metadata_current(spark, sf), "sku",
                            "sale_price", {"day": floor_to("fetched_at", "day")}, ["department"],
                            mean_name="avg_sale_price", count_name="n")
    return out.select("day", "department", _r("avg_sale_price").alias("avg_sale_price"), "n")


@query("dept_volatility")
def dept_volatility(spark, sf):
    """AGG12 + AGG4 + AGG2 + FLT10: sale-price stddev and distinct keys per
    department over the trailing year before the latest run."""
    prices = fx.fx_prices(spark, sf)
    now = F.lit(prices.agg(F.max("fetched_at")).first()[0]).cast("timestamp_ntz")
    recent = prices.where(F.col("fetched_at") >= now - F.expr("INTERVAL 365 DAYS"))
    cur = fx.fx_metadata_current(spark, sf).select("sku", "department")
    from pitpanel.operators.joins import maybe_broadcast
    j = recent.join(maybe_broadcast(cur), on="sku", how="inner")
    out = j.groupBy("department").agg(F.stddev_samp("sale_price").alias("sd_price"),
                                      F.count_distinct("sku").alias("n_skus"))
    return out.select("department", _r("sd_price").alias("sd_price"), "n_skus") \
              .orderBy(F.col("sd_price").desc_nulls_last(), "department")


@query("dept_top")
def dept_top(spark, sf):
    """AGG1 + SRT3: the ten largest manufacturers of the current catalog."""
    cur = fx.fx_metadata_current(spark, sf).where(F.col("manufacturer").isNotNull())
    counts = cur.groupBy("manufacturer").agg(F.count(F.lit(1)).alias("n_skus"))
    return counts.orderBy(F.col("n_skus").desc(), "manufacturer").limit(10)


@query("dept_summary")
def dept_summary(spark, sf):
    """AGG11 + AGG7: latest run x current catalog per manufacturer, top 20."""
    from pitpanel.operators.stats import share
    from pitpanel.operators.joins import maybe_broadcast
    latest = _latest(spark, sf)
    cur = fx.fx_metadata_current(spark, sf).where(F.col("manufacturer").isNotNull()) \
            .select("sku", "manufacturer")
    j = latest.join(maybe_broadcast(cur), on="sku", how="inner")
    g = j.groupBy("manufacturer").agg(F.count(F.lit(1)).alias("n_skus"),
                                    _r(F.avg("regular_price")).alias("mean_price"),
                                    _r(share(F.col("on_sale"))).alias("pct_on_sale"))
    return g.orderBy(F.col("n_skus").desc(), "manufacturer").limit(20)


@query("on_sale_share")
def on_sale_share(spark, sf):
    """AGG6: on-sale count, total and rounded percentage of the latest run."""
    latest = _latest(spark, sf)
    g = latest.agg(F.count_if(F.col("on_sale")).alias("on_sale"), F.count(F.lit(1)).alias("total"))
    return g.select("on_sale", "total",
                    F.round(F.lit(100.0) * F.col("on_sale") / F.col("total"), 2).alias("pct_on_sale"))


@query("distinct_keys")
def distinct_keys(spark, sf):
    """AGG2: distinct keys and rows per year of the panel."""
    prices = fx.fx_prices(spark, sf)
    return prices.groupBy(F.year("fetched_at").alias("year")).agg(
        F.count_distinct("sku").alias("n_skus"), F.count(F.lit(1)).alias("n_rows"))


@query("price_stats")
def price_stats(spark, sf):
    """AGG3 + AGG5: mean and (interpolated) median prices of the latest run."""
    from pitpanel.operators.stats import exact_median
    latest = _latest(spark, sf)
    med = exact_median(latest, "regular_price").select("median").scalar()
    return latest.agg(_r(F.avg("regular_price")).alias("mean_regular"),
                      _r(med).alias("median_regular"),
                      _r(F.avg("sale_price")).alias("mean_sale"))


@query("most_reviewed")
def most_reviewed(spark, sf):
    """SRT4 + FLT8: five most-reviewed keys of the latest run, ties by key."""
    return _top_reviewed(spark, sf, TOP_K).select("rank", "sku", "review_count",
                                                  "regular_price", "sale_price")


@query("relative_prices")
def relative_prices_q(spark, sf):
    """RSH1 + PRJ8: time x choice-set pivot of sale prices over the baseline."""
    from pitpanel.operators.reshape import relative_prices
    return relative_prices(fx.fx_prices(spark, sf), _top_reviewed(spark, sf, TOP_K), TOP_K)


@query("price_histogram")
def price_histogram(spark, sf):
    """AGG15: 80 equal-width bins over positive regular prices."""
    from pitpanel.operators.stats import histogram
    return histogram(fx.fx_prices(spark, sf), "regular_price", bins=80)


@query("json_extract")
def json_extract(spark, sf):
    """§2.12: field extraction from JSON text."""
    raw = fx.fx_raw(spark, sf)
    return raw.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("try_cast_percent")
def try_cast_percent(spark, sf):
    """§2.12: lenient text -> double (API delivers percent savings as text)."""
    from pitpanel.functions.scalars import to_double
    p = fx.fx_prices(spark, sf)
    pct = F.round(F.lit(100.0) * (F.col("regular_price") - F.col("sale_price")) / F.col("regular_price"))
    text = F.when(F.col("on_sale"), pct.cast("long").cast("string")).otherwise(F.lit("n/a"))
    return p.select("sku", "fetched_at", text.alias("percent_text")) \
            .withColumn("percent_savings", to_double("percent_text"))


# ---------------------------------------------------------------- monitoring
@query("runs_latest")
def runs_latest(spark, sf):
    """SRT5: the ten latest runs."""
    runs = fx.fx_runs(spark, sf)
    return runs.orderBy(F.col("started_at").desc()).limit(10).select(
        "started_at", "status", "products_fetched", "metadata_changed_rows", "api_calls")


@query("run_durations")
def run_durations_q(spark, sf):
    """PRJ10: run duration in seconds."""
    from pitpanel.operators.monitor import run_durations
    return run_durations(fx.fx_runs(spark, sf)).select("run_day", "run_id", "duration_s")


@query("daily_rollup")
def daily_rollup_q(spark, sf):
    """AGG9 + AGG14: runs, ok, errors and history rows per day."""
    from pitpanel.operators.monitor import daily_rollup
    return daily_rollup(fx.fx_runs(spark, sf))


def _day_after_last_run(runs):
    """'Today' for the fixture runs: the day after the last run (all days complete)."""
    import datetime as dt
    last = runs.agg(F.max("run_day")).first()[0]
    return (last + dt.timedelta(days=1)).date().isoformat() if last else None


def _health(spark, sf):
    from pitpanel.operators.monitor import catalog_health
    return catalog_health(fx.fx_prices(spark, sf, stored=True), fx.fx_history(spark, sf),
                          compare_to="previous_run_day")


@query("catalog_health")
def catalog_health_q(spark, sf):
    """MON5: per-day statistics of the day's last snapshot, change and churn."""
    h = _health(spark, sf)
    return h.select("day", "n_skus", "n_on_sale", _r("pct_on_sale").alias("pct_on_sale"),
                    _r("mean_regular").alias("mean_regular"),
                    _r("median_regular").alias("median_regular"),
                    _r("mean_sale").alias("mean_sale"), "prev_n_skus", "delta_skus",
                    _r("delta_pct").alias("delta_pct"), "churn")


def _rolled(spark, sf):
    """The written panel with its rollup brought up to date twice: after half of the runs, after all."""
    from pitpanel.operators.rollup import update_rollup
    store = _panel(spark, sf)
    update_rollup(store, until="1995-06-01T00-00-00Z")
    update_rollup(store)
    return store


@query("rollup_incremental")
def rollup_incremental(spark, sf):
    """MON5 + SNK6 from stored partials of each run: equal to the computation over all snapshots."""
    from pitpanel.operators.rollup import rollup_health
    h = rollup_health(_rolled(spark, sf), compare_to="previous_run_day")
    return h.select("day", "n_skus", "n_on_sale", _r("pct_on_sale").alias("pct_on_sale"), _r("mean_regular").alias("mean_regular"),
                    _r("median_regular").alias("median_regular"), _r("mean_sale").alias("mean_sale"), "prev_n_skus", "delta_skus",
                    _r("delta_pct").alias("delta_pct"))


@query("rollup_periods")
def rollup_periods_q(spark, sf):
    """AGG5 + AGG9 over years, merged from the runs' partials: counts, exact means, and a median whose
    rank is within 2 % of the middle."""
    from pitpanel.functions.timeparts import floor_to
    from pitpanel.operators.rollup import rollup_periods
    store = _rolled(spark, sf)
    periods = rollup_periods(store, "year")
    prices = store.prices().select(floor_to(F.to_date(F.substring("run", 1, 10)), "year").alias("period"), F.col("regularPrice").alias("x"))
    ranked = prices.join(F.broadcast(periods.select("period", "median_estimate")), "period").groupBy("period").agg(
        (F.count_if(F.col("x") <= F.col("median_estimate")) / F.count("x")).alias("upper"),
        (F.count_if(F.col("x") < F.col("median_estimate")) / F.count("x")).alias("lower"))
    return periods.join(ranked, "period").select(
        "period", "n_runs", "n_rows", _r("mean_regular").alias("mean_regular"),
        ((F.col("lower") <= 0.52) & (F.col("upper") >= 0.48)).alias("median_within_bound"))


@query("alerts")
def alerts_q(spark, sf):
    """MON1-MON4 + WIN3: alert rows for runs and catalog size."""
    from pitpanel.operators.monitor import alerts
    runs = fx.fx_runs(spark, sf, stored=True)
    out = alerts(runs, _health(spark, sf), today=_day_after_last_run(runs), expected_runs=6)
    return out.select(F.col("run_day").alias("day"), "alert", _r("value").alias("value"))


@query("report_lines")
def report_lines_q(spark, sf):
    """MON6: daily report lines (header, alerts, run table)."""
    from pitpanel.operators.monitor import alerts, report_lines
    runs = fx.fx_runs(spark, sf, stored=True)
    return report_lines(runs, alerts(runs, today=_day_after_last_run(runs), expected_runs=6))


# ---------------------------------------------------------------- audits
@query("filter_counts")
def filter_counts_q(spark, sf):
    """AUD1: record counts under different filters."""
    from pitpanel.operators.audit import filter_counts
    return filter_counts(fx.fx_raw(spark, sf), {"n_errors": F.col("event_type") == "error",
                                               "n_high_value": F.col("value") > 50})


@query("latency_summary")
def latency_summary(spark, sf):
    """AGG13: min / median / max of a latency-like value per record type."""
    from pitpanel.operators.audit import value_summary
    return value_summary(fx.fx_raw(spark, sf), "value", by=["event_type"])


@query("run_overlap")
def run_overlap_q(spark, sf):
    """AUD3 + SET2: key overlap of each run with the previous run."""
    from pitpanel.operators.audit import run_overlap
    return run_overlap(fx.fx_prices(spark, sf), bucket_days=fx.BUCKET_DAYS)


@query("page_disjointness")
def page_disjointness_q(spark, sf):
    """AUD3: keys appearing on more than one page of a day's sweep."""
    from pitpanel.functions.timeparts import floor_to
    from pitpanel.operators.audit import page_disjointness
    raw = fx.fx_raw(spark, sf).withColumn("run_day", floor_to("observed_at", "day"))
    return page_disjointness(raw, "run_day", "event_type", "sku")


@query("schema_inventory")
def schema_inventory_q(spark, sf):
    """AUD2 + SET3: union of field names over JSON records."""
    from pitpanel.operators.audit import schema_inventory
    return schema_inventory(fx.fx_raw(spark, sf), "props")


@query("typed_inventory")
def typed_inventory_q(spark, sf):
    """AUD2 + SET3 over all levels: paths and types of nested records."""
    from pitpanel.operators.audit import typed_inventory
    doc = F.concat(F.lit('{"kind":"'), "event_type", F.lit('","raw":'), "props", F.lit(',"tags":[{"n":'), (F.col("event_id") % 3).cast("string"),
                   F.lit('},"x",'), (F.col("event_id") % 2).cast("string"), F.lit(".5]}"))
    return typed_inventory(fx.fx_raw(spark, sf).select(doc.alias("doc")), "doc")


@query("trailing_distinct")
def trailing_distinct_q(spark, sf):
    """AGG2 + AGG12 with mergeable sketches: distinct keys of the seven days up to each day, beside
    the exact count, and whether the estimate is within four standard errors."""
    from pitpanel.operators.stats import trailing_distinct
    raw = fx.fx_raw(spark, sf)
    day = F.to_date("observed_at")
    approx = trailing_distinct(raw, "sku", day, 7)
    reach = raw.select("sku", day.alias("own")).distinct().select("sku", "own", F.explode(F.sequence("own", F.date_add("own", 6))).alias("d"))
    exact = reach.groupBy("d").agg(F.count_distinct("sku").alias("n_exact"), F.max("own").alias("own")).where("d = own")
    j = approx.join(exact.select(F.col("d").cast("timestamp_ntz").alias("day"), "n_exact"), "day")
    error = F.abs(F.col("n_estimate") - F.col("n_exact"))
    return j.select("day", "n_exact", (error <= F.greatest(F.lit(1.0), F.lit(4 * 1.04 / 2 ** 7) * F.col("n_exact"))).alias("within_bound"))


@query("record_width")
def record_width_q(spark, sf):
    """AUD2: fields per record."""
    from pitpanel.operators.audit import record_width
    return record_width(fx.fx_raw(spark, sf), "props")


@query("table_profile")
def table_profile_q(spark, sf):
    """AUD5: per-column null counts of the current catalog."""
    from pitpanel.operators.audit import table_profile
    return table_profile(fx.fx_metadata_current(spark, sf)).select("column", "null_count", "n_rows")


@query("csv_ready")
def csv_ready(spark, sf):
    """SC3: nested columns rendered as JSON text for CSV export, numbers with six places."""
    from pitpanel.functions.scalars import flatten_nested
    return flatten_nested(fx.table(spark, sf, "embeddings"), decimals=6)


# ---------------------------------------------------------------- ad-hoc SQL
def _views(spark, sf):
    """The fixture panel under the view names analysts query."""
    fx.fx_prices(spark, sf).createOrReplaceTempView("prices")
    fx.fx_metadata_current(spark, sf).createOrReplaceTempView("metadata_current")
    fx.fx_metadata_active(spark, sf).createOrReplaceTempView("metadata_active")
    fx.fx_history(spark, sf).createOrReplaceTempView("metadata_history")


@query("sql_category_daily_average")
def sql_category_daily_average(spark, sf):
    """SRC4 + AGG10 through spark.sql: sums per key and day first, then per category."""
    _views(spark, sf)
    return spark.sql("""
        WITH key_days AS (
            SELECT sku, to_date(fetched_at) AS on_date, sum(sale_price) AS paid,
                   count(sale_price) AS priced, count(*) AS seen
            FROM prices GROUP BY sku, to_date(fetched_at)
        )
        SELECT CAST(on_date AS TIMESTAMP_NTZ) AS day, department,
               round(try_divide(sum(paid), sum(priced)) * 1048576.0D) / 1048576.0D AS avg_sale_price,
               sum(seen) AS n
        FROM key_days INNER JOIN metadata_current ON key_days.sku = metadata_current.sku
        GROUP BY on_date, department""")


@query("sql_newly_on_sale_count")
def sql_newly_on_sale_count(spark, sf):
    """SRC4 + JN8 through spark.sql: keys whose flag turned on between the two compared runs,
    by conditional aggregates per key (no self join)."""
    _views(spark, sf)
    return spark.sql("""
        WITH run_times AS (
            SELECT fetched_at, max(fetched_at) OVER () AS newest FROM prices GROUP BY fetched_at
        ),
        compared AS (
            SELECT newest, max(CASE WHEN fetched_at < newest - INTERVAL 1 DAY THEN fetched_at END) AS base
            FROM run_times GROUP BY newest
        ),
        sides AS (
            SELECT stack(2, newest, true, base, false) AS (fetched_at, is_newest) FROM compared
        ),
        flags AS (
            SELECT sku, max(on_sale) FILTER (WHERE is_newest) AS now_on,
                   max(on_sale) FILTER (WHERE NOT is_newest) AS base_on
            FROM prices JOIN sides USING (fetched_at) GROUP BY sku
        )
        SELECT count_if(now_on AND NOT base_on) AS newly_on_sale FROM flags""")


@query("sql_on_sale_now")
def sql_on_sale_now(spark, sf):
    """SRC4 + AGG6 through spark.sql: counts per run, the newest run's share."""
    _views(spark, sf)
    return spark.sql("""
        SELECT on_sale, total, round(100.0D * on_sale / total, 2) AS pct_on_sale
        FROM (SELECT fetched_at, count_if(on_sale) AS on_sale, count(*) AS total
              FROM prices GROUP BY fetched_at)
        ORDER BY fetched_at DESC LIMIT 1""")


@query("sql_metadata_as_of")
def sql_metadata_as_of(spark, sf):
    """SRC4 + WIN1 through spark.sql: the greatest version (time, then attributes: a total order)
    of each active key."""
    _views(spark, sf)
    return spark.sql("""
        WITH seen AS (
            SELECT h.sku, max(struct(h.observed_at, h.class, h.department)) AS newest
            FROM metadata_history AS h LEFT SEMI JOIN metadata_active AS a ON a.sku = h.sku
            WHERE h.observed_at <= TIMESTAMP_NTZ '1998-01-01 00:00:00'
            GROUP BY h.sku
        )
        SELECT sku, newest.observed_at, newest.class, newest.department FROM seen""")


@query("table_first_row")
def table_first_row(spark, sf):
    """AUD5 / PRJ9: the first row of the current catalog, values cut at 80 chars."""
    from pitpanel.operators.audit import first_row_profile
    return first_row_profile(fx.fx_metadata_current(spark, sf), ["sku"])


@query("json_each")
def json_each_q(spark, sf):
    """§2.12: key/value pairs of JSON objects held as text."""
    from pitpanel.functions.canonical import json_entries
    return fx.fx_raw(spark, sf).select("event_id", json_entries("props"))


@query("intake_stream_history")
def intake_stream_history(spark, sf):
    """ING1 + STR1: the quarterly snapshots landed as API pages, ingested by
    the Structured Streaming intake; its change log equals the fixture's."""
    from pitpanel.sources.store import PanelStore
    from pitpanel.streaming.intake import stream_intake
    base = _scratch(spark, "intake")
    fx.land_fixture_pages(spark, sf, f"{base}/landing")
    stream_intake(spark, f"{base}/landing", f"{base}/panel", f"{base}/stream-checkpoint",
                  multiline=False, reports=False).awaitTermination()
    return _plain_history(PanelStore(spark, f"{base}/panel").history())


def _run_time(c="run"):
    return F.to_timestamp_ntz(F.col(c), F.lit("yyyy-MM-dd'T'HH-mm-ss'Z'"))


def _plain_history(h):
    return h.select("sku", _run_time().alias("observed_at"), "class", "department")


# runs that arrive after all others: two in the middle, and the first one of all
LATE = "(month(observed_at) = 4 AND year(observed_at) % 3 = 1) OR observed_at < TIMESTAMP_NTZ '1992-04-01'"


def _late_panel(spark, sf):
    """The quarterly runs, ingested by the stream with some of them arriving last."""
    from pitpanel.sources.store import PanelStore
    from pitpanel.streaming.intake import stream_intake
    base = _scratch(spark, "late")
    for name, where in (("in-time", f"NOT ({LATE})"), ("late", LATE)):
        fx.land_fixture_pages(spark, sf, f"{base}/{name}", where=where)
        stream_intake(spark, f"{base}/{name}", f"{base}/panel", f"{base}/{name}-checkpoint", multiline=False, late="splice", reports=False).awaitTermination()
    return PanelStore(spark, f"{base}/panel")


@query("intake_late_runs")
def intake_late_runs(spark, sf):
    """STR1: runs that arrive late are spliced in; the change log is that of sorted arrival."""
    return _plain_history(_late_panel(spark, sf).history())


@query("intake_late_state")
def intake_late_state(spark, sf):
    """SCD2 + SNK3: the index and attributes folded as of a middle run and the newest, late runs included."""
    store = _late_panel(spark, sf)
    runs = sorted(store.ledger().runs)
    parts = []
    for run in (runs[len(runs) // 2], runs[-1]):
        utc = lambda c: F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss")).alias(c)
        index = store.state(until=run).select("sku", utc("first_seen"), utc("last_seen"), "present")
        attrs = store.attributes(until=run).select("sku", "class", "department")
        parts.append(index.join(attrs, "sku").withColumn("as_of", F.lit(run)))
    return parts[0].unionByName(parts[1]).withColumn("as_of", _run_time("as_of"))


@query("intake_index_rows")
def intake_index_rows(spark, sf):
    """SNK3: index rows that each run writes: keys changed or back, and keys gone."""
    from pitpanel.sources.store import PanelStore
    from pitpanel.streaming.intake import stream_intake
    base = _scratch(spark, "deltas")
    fx.land_fixture_pages(spark, sf, f"{base}/landing")
    stream_intake(spark, f"{base}/landing", f"{base}/panel", f"{base}/checkpoint", multiline=False, reports=False).awaitTermination()
    rows = PanelStore(spark, f"{base}/panel").index_deltas()
    return rows.groupBy("run").agg(F.count_if("present").alias("n_written"), F.count_if(~F.col("present")).alias("n_gone")) \
               .select(_run_time().alias("run_at"), "n_written", "n_gone")


# ---------------------------------------------------------------- over written files
def _scratch(spark, name: str) -> str:
    import uuid
    from pitpanel.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/pitpanel-{name}-{uuid.uuid4().hex}"


def _panel(spark, sf):
    return fx.write_fixture_panel(spark, sf, _scratch(spark, "panel"))


def _plain_prices(df):
    """Stored price rows in the columns of the fixture view (times by UTC)."""
    at = F.to_timestamp_ntz(F.col("run"), F.lit("yyyy-MM-dd'T'HH-mm-ss'Z'"))
    return df.select("sku", at.alias("fetched_at"), F.col("regularPrice").alias("regular_price"), F.col("salePrice").alias("sale_price"),
                     F.col("onSale").alias("on_sale"), F.col("customerReviewCount").alias("review_count"))


def _utc_range():
    import datetime as dt
    return [dt.datetime.fromisoformat(d).replace(tzinfo=dt.timezone.utc) for d in RANGE]


@query("stored_prices_range")
def stored_prices_range(spark, sf):
    """SRC1 + SNK1 + FLT1: prices written per run, read back for a time range."""
    start, end = _utc_range()
    return _plain_prices(loaders.load_prices(_panel(spark, sf).prices(), start, end, sort=False))


@query("stored_snapshot_latest")
def stored_snapshot_latest(spark, sf):
    """SRC1 + FLT3: the latest run of the written prices."""
    return _plain_prices(loaders.load_prices_latest(_panel(spark, sf).prices()))


@query("stored_metadata_current")
def stored_metadata_current(spark, sf):
    """SRC2 + SNK3: the newest of two written versions of the catalog."""
    return _panel(spark, sf).current().select("sku", "name", "manufacturer", "department")


@query("run_log_summary")
def run_log_summary(spark, sf):
    """SRC7: the per-run summary of written run logs (counts as text in some)."""
    from pitpanel.sources.runlogs import runs_summary
    return runs_summary(spark, _panel(spark, sf).path("logs/runs")).select(
        "started_at", "finished_at", "status", "api_calls", "products_fetched", "metadata_changed_rows")


@query("run_logs_of_day")
def run_logs_of_day(spark, sf):
    """SRC8: the run logs of the last day with runs."""
    from pitpanel.sources.runlogs import latest_run, runs_for_day
    logs = _panel(spark, sf).path("logs/runs")
    last = latest_run(spark, logs).first()
    return runs_for_day(spark, logs, last["stamp"][:10] if last else "").select("stamp", "started_at", "status", "products_fetched")


@query("run_log_latest")
def run_log_latest(spark, sf):
    """SRC13: the newest run log."""
    from pitpanel.sources.runlogs import latest_run
    return latest_run(spark, _panel(spark, sf).path("logs/runs")).select("stamp", "status", "api_calls")


@query("file_inventory")
def file_inventory(spark, sf):
    """SRC12: files per prefix and the newest of them, over the written run logs."""
    from pitpanel.sources.inventory import inventory, list_files
    rows = inventory(list_files(spark, _panel(spark, sf).root, "*.json"))
    return rows.select("prefix", "n_files", "rank", F.regexp_extract("path", "run=([^/]+)", 1).alias("run"))


@query("split_list")
def split_list(spark, sf):
    """§2.12 split list + SNK4: the price rows of a comma-separated key list."""
    from pitpanel.sinks.export import parse_keys
    keys = [r["sku"] for r in _top_reviewed(spark, sf, TOP_K).select("sku").collect()]
    return loaders.load_prices(fx.fx_prices(spark, sf), skus=parse_keys(" " + ", ".join(keys) + ","), sort=False)


@query("requested_fields")
def requested_fields(spark, sf):
    """SET4: the field list asked of the catalog source, beside the records of each kind it is asked for."""
    from pitpanel.schemas import show_fields
    kinds = fx.fx_raw(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    fields = F.split(F.lit(show_fields()), ",")
    return kinds.select("event_type", "n", F.size(fields).alias("n_fields"), F.element_at(fields, 1).alias("first"), F.element_at(fields, -1).alias("last"))


@query("intake_inactive")
def intake_inactive(spark, sf):
    """FLT6 + SRC11: pages with inactive records; the rest become price rows."""
    from pitpanel.sources import landed
    base = _scratch(spark, "inactive")
    raw = fx.fx_raw(spark, sf)
    record = F.struct(F.col("event_id").alias("sku"), F.col("value").alias("regularPrice"), (F.col("event_type") != "error").alias("active"))
    pages = raw.groupBy((F.col("event_id") / 100).cast("long").alias("currentPage")).agg(F.collect_list(record).alias("products"))
    pages.write.json(f"{base}/landing")
    recs = landed.records(landed.read_pages(spark, f"{base}/landing", multiline=False))
    return landed.build_prices(recs, F.lit("2026-01-01").cast("timestamp")).select("sku", F.col("regularPrice").alias("regular_price"))


@query("csv_export_kinds")
def csv_export_kinds(spark, sf):
    """SNK4: the other kinds exported as CSV and read back, rows of each."""
    from pitpanel.sinks.export import export
    store, out = _panel(spark, sf), _scratch(spark, "csv-kinds")
    start, end = _utc_range()
    kinds = [("metadata-current", {}), ("runs-summary", {}), ("panel", {"start": start, "end": end})]
    parts = [spark.read.option("header", True).csv(export(store, kind, out, **kw)).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("kind", F.lit(kind))
             for kind, kw in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stored_empty_root")
def stored_empty_root(spark, sf):
    """SRC6: the index before the first run and an empty root are empty typed frames; the key counts beside them."""
    from pitpanel.sources.store import PanelStore
    store = PanelStore(spark, _scratch(spark, "empty"))
    keys = fx.fx_prices(spark, sf).select("sku").distinct()
    known = store.hash_index().join(keys, "sku", "right_outer")
    return known.agg(F.count(F.lit(1)).alias("n_new"), F.count("content_hash").alias("n_known"),
                     F.lit(store.current().count() + store.prices().count() + store.history().count()).alias("n_stored"))


@query("stored_sql_views")
def stored_sql_views(spark, sf):
    """SRC4 through ``PanelStore.sql``: rows and keys of the written prices by year."""
    store = _panel(spark, sf)
    return store.sql("""SELECT CAST(substr(run, 1, 4) AS INT) AS year, count(*) AS n_rows, count(DISTINCT p.sku) AS n_keys,
                               count(DISTINCT m.sku) AS n_in_catalog
                        FROM prices AS p LEFT JOIN metadata_current AS m ON m.sku = p.sku GROUP BY 1""")


@query("csv_export")
def csv_export(spark, sf):
    """SNK4: prices of a range exported as CSV, read back."""
    from pitpanel.sinks.export import export
    start, end = _utc_range()
    path = export(_panel(spark, sf), "prices", _scratch(spark, "csv"), start, end)
    back = spark.read.option("header", True).csv(path)
    return _plain_prices(back).select("sku", "fetched_at", *[F.col(c).cast(t).alias(c) for c, t in (
        ("regular_price", "double"), ("sale_price", "double"), ("on_sale", "boolean"), ("review_count", "long"))])


def _daily_report(spark, sf):
    from pitpanel.operators.monitor import alerts, report_lines
    runs, health = fx.fx_runs(spark, sf, stored=True), _daily_health(spark, sf)
    return report_lines(runs, alerts(runs, health, today=_day_after_last_run(runs), expected_runs=6), health)


def _daily_health(spark, sf):
    from pitpanel.operators.monitor import catalog_health
    from pitpanel.session import materialize
    daily = fx.fx_daily(spark, sf)
    seen = daily.groupBy("sku").agg(F.min("fetched_at").alias("observed_at"))
    return materialize(catalog_health(daily, seen, compare_to="previous_day"), "daily-health")


@query("catalog_health_daily")
def catalog_health_daily(spark, sf):
    """MON5 compared with the calendar day before; churn is the keys first seen that day."""
    h = _daily_health(spark, sf)
    return h.select("day", "n_skus", "n_on_sale", _r("mean_regular").alias("mean_regular"), _r("median_regular").alias("median_regular"),
                    "prev_n_skus", "delta_skus", _r("delta_pct").alias("delta_pct"), "churn")


@query("report_daily")
def report_daily(spark, sf):
    """MON6 + MON4: the whole daily report, catalog and churn sections included."""
    return _daily_report(spark, sf)


@query("report_files")
def report_files(spark, sf):
    """SNK5: the daily report written as text files, read back."""
    from pitpanel.sinks.writers import write_report
    path = _scratch(spark, "report")
    write_report(_daily_report(spark, sf), path, day_col="run_day")
    return spark.read.text(path).select(F.col("report_day").cast("date").cast("timestamp_ntz").alias("run_day"), F.col("value").alias("text"))


@query("report_pages")
def report_pages_q(spark, sf):
    """MON6: whole report pages, headings and time stamp included."""
    from pitpanel.operators.monitor import report_pages
    return report_pages(_daily_report(spark, sf), "2000-01-01T00:00:00Z")


@query("intake_reports")
def intake_reports(spark, sf):
    """ING1 + MON6: the reports that the streaming intake writes after its runs, read back (without
    the lines that hold the time of day at which they were made)."""
    from pitpanel.streaming.intake import stream_intake
    from pitpanel.streaming.reporting import DAILY
    base = _scratch(spark, "reports")
    fx.land_fixture_pages(spark, sf, f"{base}/landing")
    stream_intake(spark, f"{base}/landing", f"{base}/panel", f"{base}/checkpoint", multiline=False).awaitTermination()
    lines = spark.read.text(f"{base}/panel/{DAILY}")
    return lines.where(~F.col("value").rlike("^Made at |^\\| [0-9]")).select(
        F.col("report_day").cast("date").cast("timestamp_ntz").alias("run_day"), F.col("value").alias("text"))


@query("snapshot_latest_keys")
def snapshot_latest_keys(spark, sf):
    """FLT2 with a key list: the latest run of the five most reviewed keys."""
    keys = [r["sku"] for r in _top_reviewed(spark, sf, TOP_K).select("sku").collect()]
    return loaders.load_prices_latest(fx.fx_prices(spark, sf), skus=keys)


@query("prices_range_all_keys")
def prices_range_all_keys(spark, sf):
    """FLT2 with an empty key list: no filter."""
    return loaders.load_prices(fx.fx_prices(spark, sf), start=RANGE[0], end=RANGE[1], skus=[])


@query("updated_since")
def updated_since_q(spark, sf):
    """FLT7: records whose update date, an ISO text, is after a moment."""
    from pitpanel.operators.filters import updated_since
    raw = fx.fx_raw(spark, sf)
    iso = F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return updated_since(raw.withColumn("itemUpdateDate", iso), "2024-01-15 12:00:00+00:00").select("event_id", "itemUpdateDate")


@query("iso_parse")
def iso_parse(spark, sf):
    """§2.12: ISO texts in several forms (T or space, Z or offset, with and without fraction)."""
    from pitpanel.functions.timeparts import parse_iso
    at, kind = F.col("observed_at"), F.col("event_type")
    text = (F.when(kind == "error", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(kind == "view", F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS'+02:00'"))
            .when(kind == "click", F.lit("yesterday"))
            .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS'Z'")))
    return fx.fx_raw(spark, sf).select("event_id", F.unix_micros(parse_iso(text)).alias("micros"))


@query("partition_parts")
def partition_parts_q(spark, sf):
    """§2.12: year, month and day of a run time."""
    from pitpanel.functions.timeparts import partition_parts
    return fx.fx_raw(spark, sf).select("event_id", *partition_parts("observed_at"))


# ---------------------------------------------------------------- clustered tables
def _clustered(spark, *tables):
    """Tables written into one layout, with as many buckets as the session has shuffle partitions."""
    import uuid
    from pitpanel.session import checkpoint_dir
    from pitpanel.sinks.clustered import plan_layout, write_clustered
    path = f"{checkpoint_dir(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}"
    layout = plan_layout(tables, "sku", int(spark.conf.get("spark.sql.shuffle.partitions")), path)
    return [write_clustered(t, layout, f"{path}/table{i}") for i, t in enumerate(tables)]


@query("clustered_panel")
def clustered_panel(spark, sf):
    """JN1 over clustered tables: no exchange of prices or attributes."""
    from pitpanel.operators.colocated import panel
    prices, current = _clustered(spark, fx.fx_prices(spark, sf, stored=True), fx.fx_metadata_active(spark, sf))
    return panel(prices, current, ["name", "manufacturer", "department", "size"])


@query("clustered_panel_historical")
def clustered_panel_historical(spark, sf):
    """JN2 over clustered tables."""
    from pitpanel.operators.colocated import panel_historical
    prices, history = _clustered(spark, fx.fx_prices(spark, sf, stored=True), fx.fx_history(spark, sf, stored=True))
    return panel_historical(prices, history, ATTRS, bucket_days=fx.BUCKET_DAYS)


@query("clustered_changed_rows")
def clustered_changed_rows(spark, sf):
    """SCD1 backfill over clustered snapshots."""
    from pitpanel.operators.colocated import change_log
    return change_log(*_clustered(spark, fx.fx_hashed_snapshots(spark, sf, stored=True)), bucket_days=fx.BUCKET_DAYS)


@query("clustered_index")
def clustered_index(spark, sf):
    """SCD2 over clustered snapshots."""
    from pitpanel.operators.colocated import build_index
    return build_index(*_clustered(spark, fx.fx_hashed_snapshots(spark, sf, stored=True)))
