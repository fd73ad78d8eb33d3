"""Raw -> bronze: rename, parse the event time, keep the nested params."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BRONZE_COLUMNS = ["id", "event_ts", "role", "event_type", "entity_id", "entity_type", "metadata"]
METADATA_FIELDS = ["errorCode", "itemSource", "itemType", "newpath", "oldpath", "path", "run",
                   "token", "trigger", "uidOwner", "user"]


def to_bronze(raw: DataFrame) -> DataFrame:
    """Stateless projection, batch or streaming.

    ``try_to_timestamp``: an unparseable time becomes null instead of failing
    the job under ANSI mode.
    """
    return raw.select(
        F.col("id"),
        F.try_to_timestamp(F.col("time")).alias("event_ts"),
        F.col("role"),
        F.col("type").alias("event_type"),
        F.col("uid").alias("entity_id"),
        F.col("uidType").alias("entity_type"),
        F.col("params").alias("metadata"),
    )


def flatten_metadata(bronze: DataFrame) -> DataFrame:
    """Bronze with ``metadata`` spread into top-level columns (for flat outputs)."""
    cols = [c for c in bronze.columns if c != "metadata"]
    return bronze.select(*cols, *[F.col(f"metadata.{f}").alias(f) for f in METADATA_FIELDS])


def entity_time_lookup(bronze: DataFrame, entity_id: str, start: str, end: str) -> DataFrame:
    """Point lookup on the entity plus an inclusive time range.

    Both predicates are plain column comparisons, so they reach the parquet scan
    as pushed filters (row-group min/max skipping) and partition pruning.
    """
    return bronze.filter(
        (F.col("entity_id") == F.lit(entity_id))
        & F.col("event_ts").between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)))
    )
