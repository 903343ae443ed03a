"""Source audits: filter counts, value summaries, schema inventory,
page overlap / disjointness and table profiles -- all single-pass
aggregations, nothing gathered on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.joins import join_null_safe
from pitpanel.operators.sequence import DEFAULT_BUCKET_DAYS, with_neighbor
from pitpanel.operators.stats import exact_median
from pitpanel.session import materialize

_ALL = "__all"


def filter_counts(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    """One row: ``n_total`` and a count per named filter (Column or SQL text)."""
    aggs = [F.count(F.lit(1)).alias("n_total")]
    for name, cond in filters.items():
        c = F.expr(cond) if isinstance(cond, str) else cond
        aggs.append(F.count_if(c).alias(name))
    return df.agg(*aggs)


def value_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``min / median / max`` (and count) of ``value``, optionally grouped.

    The median is :func:`exact_median` (bounded memory per group)."""
    aggs = [F.count(value).alias("n"), F.min(value).alias("min_value"),
            F.max(value).alias("max_value")]
    med = exact_median(df, value, by, out="median_value")
    if by:
        return join_null_safe(df.groupBy(*by).agg(*aggs), med, by, how="left")
    return df.agg(*aggs).select("*", med.select("median_value").scalar().alias("median_value"))


def _keys(json_col: str):
    return F.map_keys(F.from_json(F.col(json_col), "map<string,string>"))


def schema_inventory(df: DataFrame, json_col: str) -> DataFrame:
    """Union of field names over JSON records: ``field, n_records``."""
    return (df.select(F.explode(_keys(json_col)).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_records")))


# fixed names of JSON types, by the first letters of a variant's schema
_TYPES = (("OBJECT", "object"), ("ARRAY", "array"), ("BIGINT", "integer"), ("DECIMAL", "number"), ("DOUBLE", "number"),
          ("BOOLEAN", "boolean"), ("VOID", "null"))


def typed_inventory(df: DataFrame, json_col: str) -> DataFrame:
    """Every path of JSON records, all levels, with its types: ``path, type, n_values``.

    The root is ``$``; array elements share a path (``$.tags[].n``).  Each level is one more ``explode`` of
    the objects and arrays of the level above, until there are none (a job that stops at the first row).
    Counts are partially aggregated; texts that do not parse don't count.
    """
    spark = df.sparkSession
    out = level = df.select(F.lit("$").alias("path"), F.try_parse_json(json_col).alias("v")).where("v is not null")
    while not (nested := level.where(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)"))).isEmpty():
        kids = nested.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("key"), F.col("value")))
        level = kids.select(F.concat("path", F.coalesce(F.concat(F.lit("."), "key"), F.lit("[]"))).alias("path"), F.col("value").alias("v"))
        out = out.unionByName(level)
    kind = F.schema_of_variant("v")
    named = F.lit("string")
    for start, name in _TYPES:
        named = F.when(kind.startswith(start), name).otherwise(named)
    return out.groupBy("path", named.alias("type")).agg(F.count(F.lit(1)).alias("n_values"))


def record_width(df: DataFrame, json_col: str) -> DataFrame:
    """Distribution of fields per record: ``n_fields, n_records``."""
    return (df.select(F.size(_keys(json_col)).alias("n_fields"))
            .groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_records")))


def run_overlap(prices: DataFrame, key: str = "sku", ts: str = "fetched_at", bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Key overlap of each run with the run before it.

    Rows: ``ts, prev_ts, n_keys, n_prev_keys, n_overlap``.  Every row learns when its key was seen
    before (a skew-safe ``lag``); a key overlaps where that was the run before.  The run list is one
    row per run (a few per day), so it is broadcast by construction.
    """
    seen = with_neighbor(prices.select(key, ts), key, ts, [ts], direction="prev", bucket_days=bucket_days, out="__p")
    before = seen.groupBy(ts, F.col("__p")[ts].alias("__before")).agg(F.count(F.lit(1)).alias("__n"))
    # a run's keys by the run that saw them last: a row per pair of runs, written once, then read by both branches
    before = materialize(before, "run-pairs")
    sizes = before.groupBy(ts).agg(F.sum("__n").alias("n_keys"))
    seq = with_neighbor(sizes.withColumn(_ALL, F.lit(0)), _ALL, ts, [ts, "n_keys"],
                        direction="prev", bucket_days=366, out="__p")
    pairs = seq.select(ts, F.col("__p")[ts].alias("prev_ts"), "n_keys",
                       F.col("__p")["n_keys"].alias("n_prev_keys"))
    overlap = before.select(ts, F.col("__before").alias("prev_ts"), F.col("__n").alias("n_overlap"))
    return (pairs.join(overlap, on=[ts, "prev_ts"], how="left")
            .withColumn("n_overlap", F.when(F.col("prev_ts").isNull(), F.lit(None))
                        .otherwise(F.coalesce(F.col("n_overlap"), F.lit(0))).cast("long")))


def page_disjointness(df: DataFrame, run: str, page: str, key: str) -> DataFrame:
    """Per run: keys seen and keys seen on more than one page.

    Pages of one sweep should be disjoint; a key on several pages means the
    catalog shifted while paging.  Two partially aggregated group-bys."""
    per_key = df.groupBy(run, key).agg(F.count_distinct(page).alias("__pages"))
    return per_key.groupBy(run).agg(F.count(F.lit(1)).alias("n_keys"),
                                     F.count_if(F.col("__pages") > 1).alias("n_keys_on_several_pages"))


def duplicate_keys(df: DataFrame, run: str, key: str) -> DataFrame:
    """``run, key, n`` for keys appearing more than once in a run."""
    return df.groupBy(run, key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: ``column, data_type, null_count, n_rows`` in one pass."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("data_type"),
                              F.col(f"__null_{i}").alias("null_count"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows), F.col("__n").alias("n_rows"))


def first_row_profile(df: DataFrame, order_by: Sequence[str], width: int = 80) -> DataFrame:
    """The first row (by ``order_by``) as ``column, value`` rows, values as
    text cut to ``width`` characters.  ``orderBy().limit(1)`` keeps one row
    per task before the final pick, so nothing large is gathered."""
    from pitpanel.functions.scalars import profile_text
    first = df.orderBy(*order_by).limit(1)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), profile_text(F.col(f"`{c}`"), width).alias("value"))
                      for c in df.columns])
    return first.select(F.inline(pairs))
