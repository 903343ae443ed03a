"""Tables clustered into key buckets, so that joins and windows by key need no exchange.

Tables of one :class:`Layout` are written into the same number of buckets by a hash of the
key (Spark's bucketed tables, one file a bucket); scans then report that
partitioning, and whatever groups, orders or joins by the key works inside a bucket.

A bucket is read by one task, so a key may not fill one.  Keys with more rows in any table
than ``HOT`` buckets of it hold on average are *hot*: there are at most ``buckets / HOT`` of them
for each table, whatever the data.  They are kept in a plain folder beside the buckets and
handled by the operators that split a key's rows (:mod:`pitpanel.operators.sequence`,
broadcast of a few catalog rows).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT = 4     # average buckets that a key's rows must exceed to be hot
_SPEC = T.StructType([T.StructField("key", T.StringType()), T.StructField("buckets", T.IntegerType()), T.StructField("schema", T.StringType())])


def _q(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Layout:
    """The key, the number of buckets and the hot keys (one column ``key``)."""
    key: str
    buckets: int
    hot_keys: DataFrame


@dataclass(frozen=True)
class Clustered:
    """A table: ``cold`` rows in buckets by ``key``, rows of hot keys and of null keys in ``hot``."""
    key: str
    buckets: int
    cold: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)


def plan_layout(tables: Sequence[DataFrame], key: str, buckets: int, path: str) -> Layout:
    """The layout of some tables; the hot keys are written below ``path``.

    One partially aggregated count by key for each table.  Size ``buckets`` so that a bucket
    of the largest table fits a task (total bytes / 256 MB).
    """
    spark = tables[0].sparkSession
    found = []
    for i, table in enumerate(tables):
        known = table.where(_q(key).isNotNull())
        total = known.count()
        # more than this many rows: fewer than buckets / HOT keys can have them
        found.append(known.groupBy(_q(key)).count().where(F.col("count") > HOT * total / buckets).select(_q(key)))
    hot = reduce(DataFrame.union, found).distinct()
    hot.write.mode("overwrite").parquet(f"{path}/hot_keys")
    return Layout(key, buckets, spark.read.schema(hot.schema).parquet(f"{path}/hot_keys"))


def write_clustered(df: DataFrame, layout: Layout, path: str) -> Clustered:
    """Write ``df`` below ``path`` in ``layout``, and open it."""
    spark, key = df.sparkSession, layout.key
    mark = F.broadcast(layout.hot_keys.select(_q(key)).withColumn("__hot", F.lit(True)))    # at most buckets / HOT keys a table
    marked = df.join(mark, on=key, how="left").select(*[_q(c) for c in df.columns], (F.col("__hot").isNotNull() | _q(key).isNull()).alias("__hot"))
    marked.where("__hot").drop("__hot").write.mode("overwrite").parquet(f"{path}/hot")
    # dealt by the bucket hash before the write: each task writes one file of one bucket
    cold = marked.where("not __hot").drop("__hot").repartition(layout.buckets, _q(key))
    name = f"clustered_{uuid.uuid4().hex}"
    cold.write.mode("overwrite").format("parquet").bucketBy(layout.buckets, key).sortBy(key).option("path", f"{path}/cold").saveAsTable(name)
    spark.createDataFrame([(key, layout.buckets, df.schema.json())], _SPEC).coalesce(1).write.mode("overwrite").json(f"{path}/spec")
    return Clustered(key, layout.buckets, spark.table(name), spark.read.schema(df.schema).parquet(f"{path}/hot"))


def open_clustered(spark: SparkSession, path: str) -> Clustered:
    """A table that :func:`write_clustered` wrote, in this or an earlier session."""
    import json
    spec = spark.read.schema(_SPEC).json(f"{path}/spec").first()
    schema = T.StructType.fromJson(json.loads(spec["schema"]))
    name = f"clustered_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    key = spec["key"].replace("`", "``")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {spec['buckets']} BUCKETS "
              f"LOCATION '{path}/cold'")
    return Clustered(spec["key"], spec["buckets"], spark.table(name), spark.read.schema(schema).parquet(f"{path}/hot"))
