"""Fixture views: the driver's TPC-H-like tables re-shaped as a panel.

``lineitem`` grouped by (part, month) becomes a price panel with one run
per month; grouped by (part, quarter) it becomes full-state attribute
snapshots whose change log is the metadata history; ``part`` is the
current catalog (sizes up to ``ACTIVE_SIZE`` are the active part of it, so left
and semi joins on active keys see unmatched ones); ``events`` become run logs and
semi-structured raw records.  All are lazy DataFrames over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.functions.canonical import content_hash
from pitpanel.functions.timeparts import floor_to, run_stamp, stamp_to_timestamp
from pitpanel.operators.scd import change_log
from pitpanel.session import materialize, scratch_tables, shuffles_freed
from pitpanel.sinks import writers
from pitpanel.sources.store import PanelStore

SNAPSHOT_ATTRS = ("class", "department")
# the fixture runs are monthly / quarterly: a one-year bucket holds at most
# twelve rows of a key (see operators.sequence.DEFAULT_BUCKET_DAYS)
BUCKET_DAYS = 366
ACTIVE_SIZE = 45


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_prices(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """(sku, fetched_at) snapshots: one run per calendar month.  ``stored=True`` writes them
    once, as the prices of a real panel are (see :func:`fx_history`)."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    sale = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    # group on the numeric key and cast after: the cast is injective, and
    # hashing longs instead of fresh strings per input row is far cheaper
    agg = (li.groupBy("l_partkey", floor_to("l_shipdate", "month").alias("fetched_at"))
           .agg(F.max(unit).alias("regular_price"),
                F.min(sale).alias("sale_price"),
                (F.max("l_discount") >= F.lit(0.05).cast("double")).alias("on_sale"),
                F.count(F.lit(1)).alias("review_count")))
    out = agg.select(F.col("l_partkey").cast("string").alias("sku"), "fetched_at", "regular_price",
                     "sale_price", "on_sale", "review_count")
    return materialize(out, "fx-prices") if stored else out


def fx_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-state attribute snapshots, one run per calendar quarter."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", floor_to("l_shipdate", "quarter").alias("observed_at"), "l_returnflag", "l_linestatus")
    # dealt before they are aggregated: greatest texts are found by sorting, and a group has a line or
    # two, so a partial aggregate would sort all rows once more and spare none
    agg = (li.repartition("l_partkey", "observed_at").groupBy("l_partkey", "observed_at")
           .agg(F.max("l_returnflag").alias("class"),
                F.max("l_linestatus").alias("department")))
    return agg.select(F.col("l_partkey").cast("string").alias("sku"), "observed_at", "class", "department")


def fx_hashed_snapshots(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Snapshots with the content hash over every attribute and the key (``stored``: written once)."""
    snaps = fx_snapshots(spark, sf_dir).withColumn("content_hash", content_hash(["sku", *SNAPSHOT_ATTRS]))
    return materialize(snaps, "fx-snapshots") if stored else snaps


def fx_history(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Change log: snapshot rows whose content differs from the key's
    previous snapshot (first sightings included).

    ``stored=True`` writes it once below the shared checkpoint folder and
    reads it back -- the history is a stored table in a real panel, and
    operators that read their input twice should scan it, not re-derive it.
    """
    log = change_log(fx_hashed_snapshots(spark, sf_dir, stored), key="sku", ts="observed_at",
                     hash_col="content_hash", bucket_days=BUCKET_DAYS)
    out = log.select("sku", "observed_at", *SNAPSHOT_ATTRS)
    return materialize(out, "fx-history") if stored else out


def fx_metadata_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current catalog: every part."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").cast("string").alias("sku"),
                       F.col("p_name").alias("name"), F.col("p_brand").alias("manufacturer"),
                       F.col("p_type").alias("department"), F.col("p_size").alias("size"))


def fx_metadata_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The active catalog, where keys without a match are what a query is about."""
    return fx_metadata_current(spark, sf_dir).where(F.col("size") <= ACTIVE_SIZE)


def fx_runs(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Pipeline runs: one per (day, event type); 'error' events are failed runs.

    ``stored=True`` writes the (one row per run) table once, as run logs are
    stored files in a real panel; reports that read it many times scan it."""
    ev = table(spark, sf_dir, "events")
    runs = (ev.groupBy(floor_to("ts", "day").alias("run_day"), F.col("event_type").alias("run_id"))
            .agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
                 F.count(F.lit(1)).alias("products_fetched"),
                 F.count_if(F.col("value") > 50).alias("metadata_changed_rows"),
                 F.count_distinct("user_id").alias("api_calls"))
            .withColumn("status", F.when(F.col("run_id") == "error", "error").otherwise("ok")))
    return materialize(runs, "fx-runs") if stored else runs


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi-structured records (JSON text in ``props``)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").cast("string").alias("sku"),
                     F.col("ts").alias("observed_at"), "event_type", "value", "props")


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily panel: users as keys, the day's events of each as its prices (written once).

    Prices are whole units: their means and medians are then the same doubles in every
    engine, and so are the decimals that a report prints."""
    ev = table(spark, sf_dir, "events")
    out = (ev.groupBy("user_id", floor_to("ts", "day").alias("fetched_at"))
           .agg(F.round(F.max("value")).alias("regular_price"), F.round(F.min("value")).alias("sale_price"), (F.count("value") > 1).alias("on_sale")))
    return materialize(out.select(F.col("user_id").cast("string").alias("sku"), "fetched_at", "regular_price", "sale_price", "on_sale"), "fx-daily")


def write_fixture_panel(spark: SparkSession, sf_dir: str, root: str) -> PanelStore:
    """The fixture's prices (one run a month), its catalog (first the active part, then a newer
    version: all of it) and run logs (one a day and event type), written by the sinks below ``root``."""
    store = PanelStore(spark, root)
    p = fx_prices(spark, sf_dir).withColumn("run", run_stamp("fetched_at"))
    writers.write_runs(p.select("sku", F.col("regular_price").alias("regularPrice"), F.col("sale_price").alias("salePrice"), F.col("on_sale").alias("onSale"),
                                F.col("review_count").alias("customerReviewCount"), stamp_to_timestamp("run").alias("fetched_at"), "run"), store.path("prices"))
    for version, catalog in (("2026-01-01T00-00-00Z", fx_metadata_active(spark, sf_dir)), ("2026-01-02T00-00-00Z", fx_metadata_current(spark, sf_dir))):
        writers.write_version(catalog.drop("size").withColumn("version", F.lit(version)), store.path("metadata/current"))
    by_day = Window.partitionBy("run_day").orderBy("run_id")       # a day's few runs
    runs = fx_runs(spark, sf_dir).withColumn("hour", F.lpad(F.row_number().over(by_day).cast("string"), 2, "0"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
    logs = runs.select(F.concat(F.date_format("run_day", "yyyy-MM-dd'T'"), "hour", F.lit("-00-00Z")).alias("run"), iso("started_at"), iso("finished_at"),
                       "status", "products_fetched", "metadata_changed_rows", F.col("api_calls").cast("string").alias("api_calls"))
    logs.repartition("run").write.mode("overwrite").partitionBy("run").json(store.path("logs/runs"))
    return store


def land_fixture_pages(spark: SparkSession, sf_dir: str, landing: str, where=None) -> None:
    """Write the quarterly snapshots as landed API pages, one run per
    quarter: envelopes of at most 100 consecutive keys (``sku // 100``, so
    no group grows with the catalog), one envelope per line, under
    ``landing/run=<stamp>/``; ``where`` picks runs by ``observed_at``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", floor_to("l_shipdate", "quarter").alias("observed_at"), (F.col("l_partkey") / 100).cast("long").alias("page"),
        "l_returnflag", "l_linestatus")
    if where is not None:
        li = li.where(where)
    # dealt by quarter and page once: the snapshots (as :func:`fx_snapshots`) and their pages need no other exchange;
    # the most selective key comes first, since these aggregates sort
    snaps = (li.repartition("observed_at", "page").groupBy("l_partkey", "observed_at", "page")
             .agg(F.max("l_returnflag").alias("class"), F.max("l_linestatus").alias("department")))
    # fields of a record that are null are not written, so only those with values are made
    record = F.struct(F.col("l_partkey").alias("sku"), "class", "department", F.lit(True).alias("active"))
    with shuffles_freed(spark), scratch_tables(spark) as put:
        pages = put(snaps.groupBy("page", "observed_at").agg(F.collect_list(record).alias("products"), F.count(F.lit(1)).alias("n")), "fx-pages")
        totals = pages.groupBy("observed_at").agg(F.count(F.lit(1)).alias("totalPages"), F.sum("n").alias("total"))
        env = pages.join(F.broadcast(totals), on="observed_at").select(
            run_stamp(F.col("observed_at").cast("timestamp")).alias("run"),
            (F.col("page") + 1).alias("currentPage"), "totalPages", "total", "products")
        writers.by_run(env).write.mode("overwrite").partitionBy("run").option("compression", "gzip").json(landing)
