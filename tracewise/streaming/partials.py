"""Day partials of the gold features, kept up to date by micro-batches.

A partial is what one batch adds to one user and day. Login partials are counts and the
first and last event; file partials keep one row per (user, day, folder, relationship,
event id), so that distinct counts stay exact when an id comes again on another day or
in another batch. Partials merge by minimum, maximum, sum and distinct: any order of batches
gives the same features, and a replayed batch overwrites its own folder.

Features of a time range are sums over whole days plus the raw rows of the range's first
and last day. Partials lie in folders by a hash bucket of the user, so refreshing the users
that a batch touched reads only their buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import LOGIN_TYPES, NAMED_ENTITY
from tracewise.operators import features as feat
from tracewise.operators.silver import silver_edges

BUCKETS = 64               # folders per batch that partials are dealt into by user


def user_bucket(user: Column) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(BUCKETS)).cast("int")


def login_partials(events: DataFrame) -> DataFrame:
    """entity_id, day, min_ts, max_ts, failed, attempts."""
    ev = events.filter((F.col("entity_type") == NAMED_ENTITY) & F.col("event_type").isin(*LOGIN_TYPES))
    return ev.groupBy("entity_id", F.to_date("event_ts").alias("day")).agg(
        F.min("event_ts").alias("min_ts"), F.max("event_ts").alias("max_ts"),
        F.count(F.when(F.col("event_type") == "login_failed", F.col("id"))).alias("failed"),
        F.count(F.when(F.col("event_type") == "login_attempt", F.col("id"))).alias("attempts"))


def file_partials(edges: DataFrame) -> DataFrame:
    """src, day, dst, relationship, id, min_ts, max_ts."""
    return (edges.filter(F.col("relationship").like("file%")).groupBy("src", F.to_date("event_ts").alias("day"), "dst", "relationship", "id")
            .agg(F.min("event_ts").alias("min_ts"), F.max("event_ts").alias("max_ts")))


def merged_logins(partials: DataFrame, end: datetime | None = None) -> DataFrame:
    """F8 / F13 from login partials; with ``end`` every duration runs to that time (rolling), else to the user's last event."""
    g = partials.groupBy("entity_id").agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("_last"),
                                          F.sum("failed").alias("TotalFailedAttempts"), F.sum("attempts").alias("TotalLoginAttempts"))
    return feat.login_rates(g.withColumn("max_ts", F.col("_last") if end is None else F.lit(end)).drop("_last"))


def merged_files(partials: DataFrame, system_folders: DataFrame, end: datetime | None = None) -> DataFrame:
    """F10 / F14 from file partials: distinct event ids per user in two aggregates."""
    folders = F.broadcast(system_folders.select(F.col("id").alias("_sys")).distinct())      # at most top-k rows
    rows = partials.join(folders, F.col("dst") == F.col("_sys"), "left")
    per_id = rows.groupBy("src", "id").agg(
        F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"),
        *[F.max((F.col("_sys").isNotNull() if system else F.col("_sys").isNull()) & F.col("relationship").isin(*kinds)).alias(name)
          for name, (system, kinds) in feat.FILE_FLAGS.items()])
    counted = [F.count(F.when(F.col(name), F.col("id"))).alias(name) for name in feat.FILE_FLAGS]
    g = per_id.groupBy("src").agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("_last"), *counted)
    return feat.file_rates(g.withColumn("max_ts", F.col("_last") if end is None else F.lit(end)).drop("_last"))


def in_range(stored: DataFrame, raw: DataFrame, make: Callable[[DataFrame], DataFrame], lower: datetime | None, upper: datetime) -> DataFrame:
    """Partials of ``lower`` <= event_ts <= ``upper``: whole days from ``stored``, the first and last day from ``raw`` rows."""
    first, last = None if lower is None else lower.date(), upper.date()
    midnight = datetime.combine(last, datetime.min.time())
    edge = (F.col("event_ts") >= F.lit(midnight)) & (F.col("event_ts") <= F.lit(upper))
    whole = F.col("day") < F.lit(last)
    if lower is not None:
        next_day = datetime.combine(first, datetime.min.time()) + timedelta(days=1)
        begun = (F.col("event_ts") >= F.lit(lower)) & (F.col("event_ts") < F.lit(next_day)) & (F.col("event_ts") <= F.lit(upper))
        edge = (edge & (F.col("event_ts") >= F.lit(lower))) | begun
        whole = whole & (F.col("day") > F.lit(first))
    whole, edge = stored.where(whole), raw.where(edge)
    made = make(edge)
    return whole.select(*made.columns).unionByName(made)


class PartialsBatchWriter:
    """The micro-batch function: writes the login and file partials of one batch of bronze events."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            for table, frame, user in (("logins", login_partials(batch_df), "entity_id"), ("files", file_partials(silver_edges(batch_df)), "src")):
                frame = frame.withColumn("bucket", user_bucket(F.col(user)))
                (frame.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
                 .parquet(f"{self.root}/{table}/batch_id={int(batch_id)}"))
        finally:
            batch_df.unpersist()


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def touched_logins(spark: SparkSession, root: str, batch_ids: list[int]) -> DataFrame:
    """F8 of the users that have login partials in the given batches, from all their partials.

    The users' buckets (at most BUCKETS numbers) prune the folders that are read.
    """
    partials = stored(spark, root, "logins")
    fresh = partials.where(F.col("batch_id").isin(batch_ids))
    users = fresh.select("bucket", "entity_id").distinct()
    buckets = [r[0] for r in users.select("bucket").distinct().collect()]
    mine = partials.where(F.col("bucket").isin(buckets)).join(users.select("entity_id"), "entity_id", "left_semi")
    return merged_logins(mine)


def run_partials(spark: SparkSession, bronze_dir: str, root: str, checkpoint: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> None:
    """Drain the bronze files into partials."""
    from tracewise.streaming.medallion import _limited
    reader = _limited(spark.readStream.schema(spark.read.parquet(bronze_dir).schema), max_files_per_trigger, max_bytes_per_trigger)
    q = (reader.parquet(bronze_dir).writeStream.foreachBatch(PartialsBatchWriter(root))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
