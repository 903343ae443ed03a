"""Writing the panel's files.

Every per-run write is keyed by the run stamp (a ``run`` or ``version``
partition) and uses dynamic partition overwrite, so re-running a run --
e.g. after an executor or driver failure -- rewrites exactly the same
partitions instead of appending duplicates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.scalars import flatten_nested


def stamp(run_ts: _dt.datetime) -> str:
    """Run identifier used in paths, e.g. ``2026-04-22T07-50-57Z`` (UTC)."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(_dt.timezone.utc)
    return run_ts.strftime("%Y-%m-%dT%H-%M-%SZ")


def _run_parts(df: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    ts = run_ts.astimezone(_dt.timezone.utc) if run_ts.tzinfo else run_ts
    return (df.withColumn("year", F.lit(ts.year)).withColumn("month", F.lit(ts.month))
            .withColumn("day", F.lit(ts.day)).withColumn("run", F.lit(stamp(run_ts))))


def _writer(df: DataFrame, files_per_partition: int | None):
    out = df.coalesce(files_per_partition) if files_per_partition else df
    return (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd"))


def write_run_partition(df: DataFrame, path: str, run_ts: _dt.datetime,
                        files: int | None = None) -> None:
    """Write one run's rows under ``year/month/day/run`` (idempotent).

    ``files`` caps output files (e.g. 1 for a small snapshot); leave it
    ``None`` at scale so every task writes its own file in parallel.
    """
    _writer(_run_parts(df, run_ts), files).partitionBy("year", "month", "day", "run").parquet(path)


def run_folder(run: str) -> list[str]:
    """Folder names of a run stamp below a per-run table."""
    return [f"year={int(run[:4])}", f"month={int(run[5:7])}", f"day={int(run[8:10])}", f"run={run}"]


def by_run(df: DataFrame) -> DataFrame:
    """Rows brought together by their ``run`` stamp before a write partitioned by it, so that the number of
    files follows the data and not runs times tasks: AQE divides a large run among tasks, and small
    ones share a task."""
    return df.hint("rebalance", F.col("run"))


def write_runs(df: DataFrame, path: str) -> None:
    """Write rows carrying a ``run`` stamp under ``year/month/day/run``
    (partition values from the UTC stamp itself; idempotent)."""
    part = lambda at, n: F.substring("run", at, n).cast("int")
    parts = by_run(df).withColumn("year", part(1, 4)).withColumn("month", part(6, 2)).withColumn("day", part(9, 2))
    _writer(parts, None).partitionBy("year", "month", "day", "run").parquet(path)


def write_version(df: DataFrame, path: str, run_ts: _dt.datetime | None = None, files: int | None = None) -> None:
    """Write a full-state table as a new ``version`` partition (idempotent); without
    ``run_ts``, rows carry their ``version``."""
    if run_ts is not None:
        df = df.withColumn("version", F.lit(stamp(run_ts)))
    _writer(df, files).partitionBy("version").parquet(path)


def write_run_log(df: DataFrame, runs_dir: str, run_ts: _dt.datetime) -> None:
    """Write a one-row run-log DataFrame as JSON under ``run=<stamp>``."""
    (df.coalesce(1).withColumn("run", F.lit(stamp(run_ts))).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("run").json(runs_dir))


def write_report(lines: DataFrame, path: str, day_col: str = "day") -> None:
    """Daily report lines, or whole pages, as text files, one folder per day (idempotent)."""
    order = [c for c in ("section", "line_no") if c in lines.columns]
    ordered = lines.withColumn("report_day", F.date_format(day_col, "yyyy-MM-dd")) \
                   .repartition("report_day").sortWithinPartitions("report_day", *order)
    (ordered.select("report_day", "text").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("report_day").text(path))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header; nested columns become JSON text."""
    flatten_nested(df).write.mode("overwrite").option("header", True).csv(path)
