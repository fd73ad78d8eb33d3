"""Derive the pipeline's raw inputs from the driver's ``events`` table.

The test tables hold no user-behaviour log, so a fixed projection of ``events``
(see FIXTURES.md §2) stands in for it. It is a pure per-row projection: its work
grows with ``events`` and it runs as one narrow stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import FILE_TYPES, SHARE_ACCESS, SHARE_LINK, SHARE_TYPES
from tracewise.sources.json_logs import PARAMS_SCHEMA

# FIXED VALUES of the fixture mapping: event type chosen by event_id % 12.
TYPE_BY_MOD12 = (
    "login_attempt", "login_succeeded", "login_failed", "file_accessed", "file_accessed",
    "file_written", "file_updated", "file_created", "file_deleted", "shared_link",
    "public_share_accessed", "session_closed",
)
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Parameters that go with the fixture data (2024-01-01 .. 2024-01-30).
CUTOFF = "2024-01-23 00:00:00"
BATCH_START = "2024-01-23 00:00:00"
LOOKBACK_DAYS = 7
TOP_K = 10


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_logs_from_events(events: DataFrame) -> DataFrame:
    """events -> raw log rows with the declared nested ``params`` struct."""
    e = F.col("event_id")
    u = F.col("user_id")
    etype = F.element_at(F.array(*[F.lit(t) for t in TYPE_BY_MOD12]), (e % 12 + 1).cast("int"))
    base = events.select(
        e.alias("id"), u.alias("u"), F.col("ts"),
        etype.alias("type"),
    )
    e, u, t = F.col("id"), F.col("u"), F.col("type")
    is_share = t.isin(*SHARE_TYPES)
    item_source = F.when(is_share, (e + u * 3) % 25)
    folder = F.concat(F.when(e % 2 == 0, F.lit("/")).otherwise(F.lit("")), F.lit("dir"),
                      ((e * 3 + u * u) % 37).cast("string"), F.lit("/f"), e.cast("string"))
    path = F.when(t.isin(*FILE_TYPES),
                  F.when(e % 97 == 0, F.lit("/")).when(e % 89 == 0, F.lit(None)).otherwise(folder))
    params = F.struct(
        F.when(e % 7 == 0, F.lit(404)).when(e % 5 == 0, F.lit(200)).cast("bigint").alias("errorCode"),
        item_source.cast("bigint").alias("itemSource"),
        F.when(item_source.isNotNull(),
               F.when(item_source < 15, F.lit("file")).otherwise(F.lit("folder"))).alias("itemType"),
        F.lit(None).cast("string").alias("newpath"),
        F.lit(None).cast("string").alias("oldpath"),
        path.cast("string").alias("path"),
        F.lit(None).cast("boolean").alias("run"),
        F.when(is_share & (e % 17 != 0), F.concat(F.lit("u"), ((e * 7 + u) % 20).cast("string"))).alias("token"),
        F.lit(None).cast("bigint").alias("trigger"),
        F.when(t == SHARE_LINK, F.concat(F.lit("u"), u.cast("string")))
         .when(t == SHARE_ACCESS, F.concat(F.lit("u"), ((u + 1) % 150).cast("string"))).alias("uidOwner"),
        F.lit(None).cast("string").alias("user"),
    ).cast(PARAMS_SCHEMA)
    return base.select(
        e.alias("id"),
        (u % 2 == 0).alias("isLocalIP"),
        params.alias("params"),
        F.when(u % 5 == 0, F.lit("management")).when(u % 5 == 1, F.lit("consulting"))
         .otherwise(F.lit("staff")).alias("role"),
        F.date_format(F.col("ts"), ISO_TEXT).alias("time"),
        t.alias("type"),
        F.concat(F.lit("u"), u.cast("string")).alias("uid"),
        F.when(e % 13 == 0, F.lit("ip")).otherwise(F.lit("name")).alias("uidType"),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs_from_events(load_table(spark, sf_dir, "events"))


def api_log_lines_from_events(events: DataFrame) -> DataFrame:
    """events -> blank-separated API log lines (one ``value`` column).

    ``10.0.8.1 02:00:00:00:00:08 u8 [01/Jan/2024:00:00:07 +0000] "GET /api/error HTTP/1.1" 500 69``
    """
    u = F.col("user_id")
    mac_tail = F.lpad(F.lower(F.hex(u % 256)), 2, "0")
    code = F.get_json_object(F.col("props"), "$.k")
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0."), F.expr("user_id div 256").cast("string"), F.lit("."), (u % 256).cast("string")),
        F.concat(F.lit("02:00:00:00:00:"), mac_tail),
        F.concat(F.lit("u"), u.cast("string")),
        F.concat(F.lit("["), F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss")),
        F.lit("+0000]"),
        F.concat(F.lit('"GET /api/'), F.col("event_type"), F.lit(' HTTP/1.1"')),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")),
        code,
    )
    return events.select(line.alias("value"))


def api_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_log_lines_from_events(load_table(spark, sf_dir, "events"))
