"""Artifact inventory: files per top-level prefix and the newest of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``path, prefix, length, modified`` of every file below ``root``.

    The ``binaryFile`` source lists files in parallel; ``content`` is never
    selected, so no file body is read.
    """
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root))
    # strip everything up to and including the root (quoted literally, so
    # any character in the path is safe; the scheme prefix may differ)
    bare = root.split("://")[-1].split(":", 1)[-1] if root.startswith("file:") else root.split("://")[-1]
    rel = F.regexp_replace(F.col("path"), r"^.*?\Q" + bare + r"\E/", "")
    return files.select(rel.alias("path"), F.split(rel, "/").getItem(0).alias("prefix"),
                        "length", F.col("modificationTime").alias("modified"))


def inventory(files: DataFrame, newest: int = 10) -> DataFrame:
    """Per prefix: file count and the ``newest`` files by path.

    The ranking filter becomes a WindowGroupLimit, applied before the
    shuffle, so each task forwards at most ``newest`` files per prefix.
    """
    counts = files.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_files"))
    w = Window.partitionBy("prefix").orderBy(F.col("path").desc())
    top = files.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= newest)
    return top.join(counts, on="prefix", how="inner").select("prefix", "n_files", "rank", "path", "length")
