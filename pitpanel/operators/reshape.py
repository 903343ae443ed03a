"""Reshape: relative-price matrix over a fixed choice set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relative_prices(prices: DataFrame, choice: DataFrame, k: int, key: str = "sku",
                    ts: str = "fetched_at", value: str = "sale_price",
                    rank_col: str = "rank") -> DataFrame:
    """Pivot ``ts x choice-set member`` of ``value`` and divide by the
    baseline member (rank 1).

    ``choice`` holds ``key`` and a 1-based ``rank_col`` (1..k) for a small,
    fixed choice set; ``k`` fixes the output columns, so the schema never
    depends on the data and the choice set (at most ``k`` rows) is
    broadcast.  Output columns are named by rank --
    ``p1..pk`` and ``rel_2..rel_k`` -- so the schema does not depend on the
    data.  A duplicate ``(ts, member)`` cell is an error, not silently
    aggregated.
    """
    ranks = list(range(1, k + 1))
    j = prices.join(F.broadcast(choice.select(key, rank_col)), on=key, how="inner")
    aggs = []
    for r in ranks:
        hit = F.col(rank_col) == r
        aggs.append(F.max(F.when(hit, F.col(value))).alias(f"p{r}"))
        aggs.append(F.count_if(hit).alias(f"__n{r}"))
    wide = j.groupBy(ts).agg(*aggs)
    cells = []
    for r in ranks:
        dup = F.col(f"__n{r}") > 1
        cells.append(F.when(dup, F.raise_error(F.lit(f"duplicate cell for rank {r}")))
                     .otherwise(F.col(f"p{r}")).cast("double").alias(f"p{r}"))
    base = F.col(f"p{ranks[0]}") if ranks else F.lit(None)
    # a free baseline has no ratio: null
    rels = [F.try_divide(F.col(f"p{r}"), base).alias(f"rel_{r}") for r in ranks[1:]]
    return wide.select(ts, *cells).select(ts, *[f"p{r}" for r in ranks], *rels)
