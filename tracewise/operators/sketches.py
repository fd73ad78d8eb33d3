"""Mergeable profiles: distinct and quantile sketches per day, merged over any range of days.

The sketches are Spark's own HyperLogLog and KLL aggregates: one pass with
map-side combine and no Expand, whatever the number of columns. Stored day rows
answer any later range without reading events again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12                # HyperLogLog: relative standard error about 1.04 / sqrt(2 ** LG_K) = 1.6 %
DISTINCT_BOUND = 0.05    # three standard errors
KLL_K = 400
RANK_BOUND = 0.02        # rank error of a quantile, normalised


def day_sketches(events: DataFrame, distinct: list[str], quantiles: list[str] = (), time: str = "event_ts") -> DataFrame:
    """One row per day (null times are a day of their own): n rows, ``d_<c>`` and ``q_<c>`` sketches.

    ``quantiles`` are whole numbers or timestamps (taken as microseconds). Null
    values are counted by no sketch; a column without values has an empty one.
    """
    kinds = dict(events.dtypes)

    def number(c):
        return F.unix_micros(F.col(c)) if kinds[c].startswith("timestamp") else F.col(c).cast("long")

    return events.groupBy(F.to_date(time).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"d_{c}") for c in distinct],
        *[F.kll_sketch_agg_bigint(number(c), F.lit(KLL_K)).alias(f"q_{c}") for c in quantiles])


def merged(sketches: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The day rows of a range (both ends included, open where None) merged into one row of the same columns."""
    if first_day is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last_day).cast("date"))
    return sketches.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.hll_union_agg(c).alias(c) for c in sketches.columns if c.startswith("d_")],
        *[F.kll_merge_agg_bigint(c).alias(c) for c in sketches.columns if c.startswith("q_")])


def distinct_estimates(one: DataFrame) -> DataFrame:
    """column, n_estimated per distinct sketch of a merged row."""
    pairs = [F.struct(F.lit(c[2:]).alias("column"), F.hll_sketch_estimate(c).alias("n_estimated"))
             for c in one.columns if c.startswith("d_")]
    return one.select(F.inline(F.array(*pairs)))


def quantile_estimates(one: DataFrame, shares: list[float]) -> DataFrame:
    """column, share, value per quantile sketch of a merged row (timestamps as microseconds)."""
    rows = [F.struct(F.lit(c[2:]).alias("column"), F.lit(float(s)).alias("share"),
                     F.kll_sketch_get_quantile_bigint(c, F.lit(float(s))).alias("value"))
            for c in one.columns if c.startswith("q_") for s in shares]
    return one.select(F.inline(F.array(*rows)))
