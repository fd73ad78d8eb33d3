"""Profiling aggregates over raw, bronze and the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cardinality_profile(raw: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """six distinct counts in one pass (one over the parsed time).

    Exact mode expands each row once per distinct column; ``approximate=True``
    switches to HyperLogLog++ sketches that merge map-side (no Expand).
    """
    def dc(c):
        return F.approx_count_distinct(c, rsd) if approximate else F.count_distinct(c)
    return raw.agg(
        dc(F.col("id")).alias("n_id"),
        dc(F.try_to_timestamp(F.col("time"))).alias("n_time"),
        dc(F.col("role")).alias("n_role"),
        dc(F.col("type")).alias("n_type"),
        dc(F.col("uid")).alias("n_uid"),
        dc(F.col("uidType")).alias("n_uid_type"),
    )


def events_per_entity(bronze: DataFrame) -> DataFrame:
    """events per entity, busiest first."""
    return (bronze.groupBy("entity_id").agg(F.count(F.lit(0)).alias("num_events"))
            .orderBy(F.desc("num_events"), F.asc("entity_id")))


def events_per_month(events: DataFrame) -> DataFrame:
    """events per calendar month, latest first."""
    month = F.date_trunc("month", F.col("event_ts"))
    return (events.groupBy(month.alias("event_month")).agg(F.count(F.lit(0)).alias("event_count"))
            .orderBy(F.desc("event_month")))


def events_per_day_in_month(events: DataFrame, month: str) -> DataFrame:
    """events per day inside one month (the month is a parameter, T5).

    The month filter is written as a range on ``event_ts`` so it can reach the scan.
    """
    start = F.to_timestamp(F.lit(month))
    end = F.expr(f"to_timestamp('{month}') + INTERVAL 1 MONTH")
    day = F.date_trunc("day", F.col("event_ts"))
    return (events.filter((F.col("event_ts") >= start) & (F.col("event_ts") < end))
            .groupBy(day.alias("event_day")).agg(F.count(F.lit(0)).alias("event_count"))
            .orderBy(F.desc("event_day")))


def relationship_profile(edges: DataFrame) -> DataFrame:
    """edges per relationship."""
    return (edges.groupBy("relationship").agg(F.count(F.lit(0)).alias("events"))
            .orderBy(F.desc("events"), F.asc("relationship")))
