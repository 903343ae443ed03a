"""Reading the panel's files: prices, attribute history, current state,
hash index.  Layout under a data root (any Hadoop path)::

    prices/year=YYYY/month=M/day=D/run=<stamp>/part-*.parquet     append per run
    metadata/history/year=YYYY/month=M/day=D/run=<stamp>/...      changed rows per run
    metadata/index_delta/year=.../run=<stamp>/...                 keys that a run changed, brought back or left out
    metadata/index/version=<stamp>/...                            hash index at some runs
    metadata/current/version=<stamp>/...                          newest attributes of every key at those runs
    published/<n>.json                                            which of these folders readers see
    logs/runs/run=<stamp>/part-*.json                             one run log per run

The index and the current attributes of any run are folded on read from the newest full
table that is not newer and the rows written since (:meth:`PanelStore.state`), so what a run writes
follows what it changed.  :mod:`pitpanel.sources.ledger` tells which runs are published; without
its records (a panel written by other means) all folders are read, and the newest ``version``
of a full table is the state.

Data in the original single-machine layout reads as well: one parquet file
per run directly under ``prices/year=/month=/day=``, history files named
``day=DD.parquet`` under ``year=/month=``, and unversioned current / index
files.  Missing partition columns read as null and the readers fall back
accordingly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel import schemas
from pitpanel.sources.ledger import CURRENT, DELTA, HISTORY, INDEX, PRICES, Ledger, stamp_of


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Hadoop path exists (one metadata call, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes below a Hadoop path, 0 where there is none (metadata calls only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


_RUN_PARTS = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
                           T.StructField("day", T.IntegerType()), T.StructField("run", T.StringType())])
_VERSION = T.StructType([T.StructField("version", T.StringType())])


def _with(schema: T.StructType, extra: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + extra.fields)


class PanelStore:
    """Typed, lazy readers over a panel data root."""

    def __init__(self, spark: SparkSession, root: str, ledger: Ledger | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._ledger = ledger       # a fixed record, else the newest

    def ledger(self) -> Ledger | None:
        return self._ledger or Ledger.read(self.spark, self.root)

    def _published(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of a per-run table, those of hidden folders left out."""
        df, ledger = self._read(table, _with(schema, _RUN_PARTS)), self.ledger()
        return ledger.visible(df, table) if ledger else df

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _read(self, rel: str, schema: T.StructType) -> DataFrame:
        p = self.path(rel)
        if not path_exists(self.spark, p):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(p)

    def prices(self) -> DataFrame:
        """All price snapshots; ``year/month/day/run`` are partition columns."""
        return self._published(PRICES, schemas.PRICES)

    def history(self) -> DataFrame:
        """The attribute change log (only changed rows of each run)."""
        return self._published(HISTORY, schemas.METADATA)

    def index_deltas(self) -> DataFrame:
        """Index rows of the keys that a run changed, brought back or (``present`` is false) left out."""
        return self._published(DELTA, schemas.INDEX_STATE)

    def state(self, until: str | None = None, before: str | None = None) -> DataFrame:
        """The hash index as of the newest run (not after ``until``, or before ``before``), with ``present``:
        whether that run holds the key.

        The newest row of each key, of the full table and the rows written since: one partially
        aggregated group-by.  A present key was last seen by that run.
        """
        ledger = self.ledger()
        at = ledger and ledger.newest(until, before)
        if at is None:
            return empty(self.spark, schemas.INDEX_STATE)
        rows = self.index_deltas().where(F.col("run") <= at)
        folder = ledger.base(at) or max((v for v in self.versions(INDEX) if v <= at and v not in ledger.hidden.get(INDEX, [])), default=None)
        if folder is not None:
            base = self._read(INDEX, _with(schemas.INDEX_STATE, _VERSION)).where(F.col("version") == folder)
            seen = F.date_trunc("second", "last_seen") == ledger.time(stamp_of(folder)) if stamp_of(folder) in ledger.runs else F.lit(False)
            base = base.withColumn("present", F.coalesce("present", seen)).withColumn("run", F.lit(stamp_of(folder)))
            rows = rows.where(F.col("run") > stamp_of(folder)).unionByName(base.drop("version"), allowMissingColumns=True)
        values = ["content_hash", "first_seen", "last_seen", "present"]
        newest = rows.groupBy("sku").agg(F.max_by(F.struct(*values), "run").alias("s")).select("sku", "s.*")
        return newest.withColumn("last_seen", F.when(F.col("present"), ledger.time(at)).otherwise(F.col("last_seen")))

    def full_index(self, folder: str) -> DataFrame:
        """A full index table as it was written."""
        return self._read(INDEX, _with(schemas.INDEX_STATE, _VERSION)).where(F.col("version") == folder).drop("version")

    def attributes(self, until: str | None = None, state: DataFrame | None = None) -> DataFrame:
        """The newest attributes of every key as of a run, and whether that run holds the key (from ``state``,
        the index at that run, where it is at hand)."""
        ledger = self.ledger()
        at = ledger.newest(until)
        folder = ledger.base(at)
        rows = self.history().where(F.col("run") <= at).drop("year", "month", "day")
        if folder is not None:
            base = self._read(CURRENT, _with(schemas.ATTRIBUTE_STATE, _VERSION)).where(F.col("version") == folder).drop("version")
            if stamp_of(folder) == at:
                return base
            rows = rows.where(F.col("run") > stamp_of(folder)).unionByName(base.drop("present").withColumn("run", F.lit(stamp_of(folder))))
        columns = [f.name for f in schemas.METADATA.fields]
        newest = rows.groupBy("sku").agg(F.max_by(F.struct(*[f"`{c}`" for c in columns if c != "sku"]), "run").alias("s")).select("sku", "s.*")
        index = self.state(until=at) if state is None else state
        return newest.join(index.select("sku", "present"), "sku").select(*[f"`{c}`" for c in columns], "present")

    def _latest_version(self, rel: str, schema: T.StructType, before: str | None = None) -> DataFrame:
        df = self._read(rel, _with(schema, _VERSION))
        if before is not None:
            df = df.where(F.col("version") < before)
        # the newest version id comes from partition values alone; as a
        # literal it prunes the scan to that version's directory
        newest = df.select(F.max("version")).first()[0]
        if newest is None:
            # an unversioned table (a single file overwritten per run)
            return df.drop("version")
        return df.where(F.col("version") == F.lit(newest)).drop("version")

    def versions(self, rel: str) -> list[str]:
        """``version`` ids of a full-state table, from its folder names (one per run)."""
        spark = self.spark
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(rel))
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removeprefix("version=") for n in names if n.startswith("version="))

    def latest_version(self, rel: str) -> str | None:
        """Newest ``version`` id of a full-state table (None if absent)."""
        return max(self.versions(rel), default=None)

    def current(self, until: str | None = None) -> DataFrame:
        """Attributes of the keys in the newest run (not after ``until``), observed then (empty typed
        frame if there is none)."""
        ledger = self.ledger()
        if ledger is None:
            return self._latest_version(CURRENT, schemas.METADATA)
        at = ledger.newest(until)
        if at is None:
            return empty(self.spark, schemas.METADATA)
        if not ledger.deltas and ledger.base(at) is None:
            return self._latest_version(CURRENT, schemas.METADATA)
        return self.attributes(at).where("present").drop("present").withColumn("observed_at", ledger.time(at))

    def hash_index(self, before: str | None = None, until: str | None = None) -> DataFrame:
        """The hash index after the newest run, after the newest one older than run ``before``, or
        after run ``until``."""
        if self.ledger() is None:
            return self._latest_version(INDEX, schemas.HASH_INDEX, before)
        return self.state(until=until, before=before).drop("present")

    def register_views(self) -> None:
        """``prices``, ``metadata_current``, ``metadata_history`` temp views
        for ad-hoc ``spark.sql``."""
        self.prices().createOrReplaceTempView("prices")
        self.current().createOrReplaceTempView("metadata_current")
        self.history().createOrReplaceTempView("metadata_history")

    def sql(self, text: str) -> DataFrame:
        """Run ad-hoc SQL over the three views.  Spark SQL accepts the
        usual panel SQL (``USING``, ``FILTER``, ``GROUP BY 1``, scalar
        subqueries, ``INTERVAL``); ``SELECT * EXCEPT (..)`` replaces
        ``EXCLUDE``, and as-of joins use :mod:`pitpanel.operators.asof`."""
        self.register_views()
        return self.spark.sql(text)
