"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every pitpanel job assumes.  AQE re-plans joins at runtime
# (broadcast only after the real shuffle size is known, skew splitting for
# sort-merge joins, partition coalescing for small stages).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "pitpanel",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with pitpanel's defaults (explicit ``conf`` wins).

    ``shuffle_partitions`` should be sized so one shuffle partition holds
    roughly 128-256 MB at the target scale; AQE coalesces it downward.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir).  Only when neither is set -- local tests -- a private
    folder is created and registered, so ``DataFrame.checkpoint()`` works; on any other
    master its absence is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="pitpanel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def materialize(df, name: str = "table", **options):
    """Write ``df`` once as parquet below the shared checkpoint folder and
    return a DataFrame reading it back; ``options`` go to the writer.

    Used for small intermediate tables that several branches of a plan
    reuse: the upstream scans run once, the lineage is cut, and the files
    live on shared storage, so losing an executor loses nothing.  (An eager
    ``DataFrame.checkpoint()`` would compute its input twice unless it was
    cached first.)
    """
    return _stored(df, _scratch_path(df.sparkSession, name), **options)


def _scratch_path(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/pitpanel-{name}-{uuid.uuid4().hex}"


def _stored(df, path: str, **options):
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable]:
    """A :func:`materialize` for tables that only the block reads: their files are removed when it ends,
    whether it succeeds or not."""
    paths = []

    def put(df, name: str, **options):
        paths.append(_scratch_path(spark, name))
        return _stored(df, paths[-1], **options)

    try:
        yield put
    finally:
        for path in paths:
            try:
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            except Exception as e:      # what is left takes disk, and harms nothing else
                warnings.warn(f"a scratch table was not removed: {e!r}", stacklevel=2)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """In the block, the shuffle files of each write leave the executors' disks when the write ends.

    Spark keeps them until the driver's garbage collector finds their plans, and a driver with little
    else to do hardly collects: a chain of writes then holds the shuffles of all of them at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
