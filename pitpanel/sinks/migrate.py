"""One-time rewrite of a panel in the original single-machine layout into
this package's layout, so new runs can be appended with the writers.

Both layouts read through :class:`PanelStore`, but they cannot share one
root: Spark's partition discovery rejects a table whose directories mix
``day=`` leaves with ``day=/run=`` leaves.  The rewrite is a plain Spark job
per table (every run's rows go to their ``run=`` partition, written in
parallel); it is idempotent thanks to dynamic partition overwrite.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pitpanel.functions.timeparts import run_stamp
from pitpanel.sources.store import PanelStore


def _by_run(df, ts: str):
    t = F.col(ts)
    return (df.drop("year", "month", "day", "run")
            .withColumn("year", F.year(t)).withColumn("month", F.month(t))
            .withColumn("day", F.dayofmonth(t)).withColumn("run", run_stamp(t)))


def migrate_original_layout(spark: SparkSession, src: str, dst: str) -> None:
    """Rewrite prices, history, current and index from ``src`` to ``dst``."""
    old, new = PanelStore(spark, src), PanelStore(spark, dst)

    def write_runs(df, ts, rel):
        (_by_run(df, ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy("year", "month", "day", "run").parquet(new.path(rel)))

    write_runs(old.prices(), "fetched_at", "prices")
    write_runs(old.history(), "observed_at", "metadata/history")
    current = old.current()
    version = current.agg(F.max("observed_at")).first()[0]
    if version is not None:
        stamp = version.strftime("%Y-%m-%dT%H-%M-%SZ")
        for df, rel in [(current, "metadata/current"), (old.hash_index(), "metadata/index")]:
            (df.withColumn("version", F.lit(stamp)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
             .partitionBy("version").parquet(new.path(rel)))
