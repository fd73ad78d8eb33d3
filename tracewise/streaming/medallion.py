"""Structured Streaming legs of the medallion (J1-J6, B8 streaming form, C7).

Raw -> bronze (J1): a stateless projection from a JSON file source into a
partitioned parquet sink, with a checkpoint; ``availableNow`` drains what is
there and stops (J2), ``awaitTermination`` blocks the caller (J3).

Bronze -> silver (J4): ``foreachBatch`` with a replay-safe writer. Each
micro-batch overwrites its own ``batch_id=<n>`` directory of every table, so
re-running a batch after a failure rewrites the same files. The current state
of a table is the latest row per key over all batch directories (§7.4); a
compaction job folds the settled batches into one clustered base (J6).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.operators.bronze import to_bronze
from tracewise.operators.layout import cluster_write
from tracewise.operators.silver import silver_edges, silver_nodes
from tracewise.operators.upsert import (
    EDGE_KEYS, EVENT_KEYS, NODE_KEYS, NODE_ORDER, latest_per_key, with_default_now,
)
from tracewise.session import _file_system, path_bytes, path_exists
from tracewise.sources.json_logs import RAW_LOG_SCHEMA

#: Partition column of each silver table (its filters prune folders).
PARTITIONED_BY = {"nodes": "entity_type", "edges": "relationship", "events": "entity_type"}
TABLES = {
    "nodes": (NODE_KEYS, NODE_ORDER),
    "edges": (EDGE_KEYS, []),
    "events": (EVENT_KEYS, []),
}


def _limited(reader, max_files: int | None, max_bytes: int | None):
    """A file stream reader with a limit per micro-batch (files or bytes, not both)."""
    if max_files:
        return reader.option("maxFilesPerTrigger", str(max_files))
    return reader.option("maxBytesPerTrigger", str(max_bytes)) if max_bytes else reader


# --------------------------------------------------------------------------- raw -> bronze

def start_raw_to_bronze(spark: SparkSession, raw_dir: str, bronze_dir: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None,
                        max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None):
    """Stream raw JSON files into bronze parquet partitioned by (entity_type, role)."""
    reader = _limited(spark.readStream.schema(RAW_LOG_SCHEMA), max_files_per_trigger, max_bytes_per_trigger)
    bronze = to_bronze(reader.json(raw_dir))
    w = (bronze.writeStream.format("parquet").partitionBy("entity_type", "role")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=available_now)
    return w.start(bronze_dir)


def run_raw_to_bronze(spark: SparkSession, raw_dir: str, bronze_dir: str, checkpoint: str, **kw) -> None:
    """J1 + J2 + J3: drain the source once and wait for the end."""
    q = start_raw_to_bronze(spark, raw_dir, bronze_dir, checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


# --------------------------------------------------------------------------- bronze -> silver

class SilverBatchWriter:
    """The micro-batch function. Writes nodes, edges and events of one batch.

    Uses only the batch frame (and its own session, ``batch_df.sparkSession``),
    never the driver's session object.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()     # three tables are made from one read of the batch
        frames = {
            "nodes": latest_per_key(silver_nodes(batch_df), NODE_KEYS, NODE_ORDER),
            "edges": silver_edges(batch_df),
            "events": latest_per_key(batch_df, EVENT_KEYS),
        }
        try:
            for table, df in frames.items():
                (with_default_now(df).write.mode("overwrite").partitionBy(PARTITIONED_BY[table])
                 .parquet(f"{self.table_path(table)}/batch_id={int(batch_id)}"))
        finally:
            batch_df.unpersist()


def start_bronze_to_silver(spark: SparkSession, bronze_dir: str, silver_root: str, checkpoint: str,
                           max_files_per_trigger: int | None = None, available_now: bool = True,
                           max_bytes_per_trigger: int | None = None):
    schema = spark.read.parquet(bronze_dir).schema
    stream = _limited(spark.readStream.schema(schema), max_files_per_trigger, max_bytes_per_trigger).parquet(bronze_dir)
    return (stream.writeStream.foreachBatch(SilverBatchWriter(silver_root))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=available_now).start())


def run_bronze_to_silver(spark: SparkSession, bronze_dir: str, silver_root: str, checkpoint: str, **kw) -> None:
    q = start_bronze_to_silver(spark, bronze_dir, silver_root, checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def read_batches(spark: SparkSession, silver_root: str, table: str) -> DataFrame:
    """All batch directories of a table, with the ``batch_id`` partition column."""
    return spark.read.parquet(f"{silver_root.rstrip('/')}/{table}")


def current_state(spark: SparkSession, silver_root: str, table: str, base_path: str | None = None) -> DataFrame:
    """Latest row per key over the compacted base (if any) and all later batches."""
    keys, order = TABLES[table]
    batches = read_batches(spark, silver_root, table)
    if base_path:
        base = spark.read.parquet(f"{base_path}/data").withColumn("batch_id", F.lit(-1))
        batches = base.unionByName(batches.filter(F.col("batch_id") > folded_up_to(spark, base_path)))
    latest = latest_per_key(batches, keys, ["batch_id"] + list(order))
    return latest.drop("batch_id")


def folded_up_to(spark: SparkSession, base_path: str) -> int:
    """The highest batch id that a base holds."""
    return int(json.loads(spark.read.text(f"{base_path}/_folded").first()[0])["max_batch_id"])


def compact(spark: SparkSession, silver_root: str, table: str, out_path: str, cluster_cols: list[str],
            target_bytes: int = 16 * 1024 * 1024, base_path: str | None = None) -> str:
    """Fold the batches written since ``base_path`` (or all) into one clustered base at a *new* path.

    Only the previous base and the batches after it are read, so the cost does not
    grow with all history; ``retire_folded`` then removes the folded batches. Records
    the highest folded batch id next to the data; readers switch to the new base by
    path, so nothing that is being read is overwritten.
    """
    batches = read_batches(spark, silver_root, table)
    max_batch = batches.agg(F.max("batch_id")).first()[0]
    if base_path:
        max_batch = max(max_batch, folded_up_to(spark, base_path))
    state = current_state(spark, silver_root, table, base_path)
    size = path_bytes(spark, f"{silver_root.rstrip('/')}/{table}") + (path_bytes(spark, f"{base_path}/data") if base_path else 0)
    cluster_write(state, f"{out_path}/data", cluster_cols, size, mode="zorder", target_bytes=target_bytes)
    spark.createDataFrame([(json.dumps({"table": table, "max_batch_id": int(max_batch)}),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{out_path}/_folded")
    return out_path


def retire_folded(spark: SparkSession, silver_root: str, table: str, base_path: str) -> list[int]:
    """Delete the batch folders that a base holds, all but the newest (which keeps the table's schema); returns their ids."""
    upto = folded_up_to(spark, base_path)
    fs, root = _file_system(spark, f"{silver_root.rstrip('/')}/{table}")
    found = sorted((int(st.getPath().getName().split("=")[1]), st.getPath()) for st in fs.listStatus(root)
                   if st.getPath().getName().startswith("batch_id="))
    gone = [(n, path) for n, path in found[:-1] if n <= upto]
    for _, path in gone:
        fs.delete(path, True)
    return [n for n, _ in gone]


def load_audit(spark: SparkSession, silver_root: str) -> DataFrame:
    """One row per (table, batch): rows written, of which updates of earlier keys, and inserts."""
    out = None
    for table, (keys, _) in TABLES.items():
        if not path_exists(spark, f"{silver_root.rstrip('/')}/{table}"):
            continue
        b = read_batches(spark, silver_root, table)
        first = b.groupBy(*keys).agg(F.min("batch_id").alias("_first"))
        cond = None
        for k in keys:
            c = b[k].eqNullSafe(first[k])
            cond = c if cond is None else cond & c
        j = b.join(first, cond).select(b["batch_id"], F.col("_first"))
        per = j.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count(F.when(F.col("_first") < F.col("batch_id"), 1)).alias("rows_updated"),
        ).withColumn("rows_inserted", F.col("rows_in") - F.col("rows_updated")) \
         .withColumn("table_name", F.lit(table))
        out = per if out is None else out.unionByName(per)
    return out.select("table_name", "batch_id", "rows_in", "rows_updated", "rows_inserted")


# --------------------------------------------------------------------------- inference

class InferenceBatchWriter:
    """The same rolling-feature + scoring function as the batch job, per micro-batch.

    For each micro-batch: rolling features of the batch's users over the stored
    bronze and silver edges, between the lookback and the batch's last event (so a
    replay gives the same rows however many later events are stored by then), with
    the stored system folders, scored by ``scorer(frame) -> (user_id, score)``;
    predictions overwrite ``<root>/batch_id=<n>`` (replay-safe), so the folder
    is also the prediction history (P6).
    """

    def __init__(self, bronze_dir: str, edges_dir: str, folders_dir: str, scorer, root: str, lookback_days: int = 7):
        self.bronze_dir, self.edges_dir, self.folders_dir = bronze_dir, edges_dir, folders_dir
        self.scorer, self.root, self.lookback_days = scorer, root.rstrip("/"), lookback_days

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        from tracewise.operators import anomaly as an
        from tracewise.operators import features as feat
        spark = batch_df.sparkSession
        history = spark.read.parquet(self.bronze_dir)
        edges = spark.read.parquet(self.edges_dir)
        last = batch_df.agg(F.max("event_ts")).first()[0]
        if last is None:
            return
        window = feat.window_for_batch(batch_df, self.lookback_days, last)
        frame = feat.rolling_feature_frame(
            window, feat.login_features(history, window=window),
            feat.file_access_features(edges, spark.read.parquet(self.folders_dir), window=window),
            feat.sharing_features(edges, window=window)).checkpoint()
        pred = an.with_predictions(frame, self.scorer(frame), "user_id")
        pred.write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")


def run_stream_inference(spark: SparkSession, bronze_dir: str, edges_dir: str, folders_dir: str, scorer, out_root: str,
                         checkpoint: str, lookback_days: int = 7, max_files_per_trigger: int | None = None,
                         max_bytes_per_trigger: int | None = None) -> None:
    schema = spark.read.parquet(bronze_dir).schema
    reader = _limited(spark.readStream.schema(schema), max_files_per_trigger, max_bytes_per_trigger)
    q = (reader.parquet(bronze_dir).writeStream
         .foreachBatch(InferenceBatchWriter(bronze_dir, edges_dir, folders_dir, scorer, out_root, lookback_days))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def latest_predictions(spark: SparkSession, out_root: str) -> DataFrame:
    """Current prediction per user: the one from the highest batch id."""
    hist = spark.read.parquet(out_root)
    return latest_per_key(hist, ["user_id"], ["batch_id"]).drop("batch_id")


# --------------------------------------------------------------------------- full refresh

class PipelineRoot:
    """Where a pipeline's tables and checkpoints live, with a full-refresh switch.

    Each refresh generation is a new sub-folder ``gen=<n>`` holding every table
    and every checkpoint of the pipeline. ``full_refresh=True`` starts a new
    generation (old data is left untouched for readers still using it);
    otherwise the latest generation is continued, so streams resume from their
    checkpoints and add only new input.
    """

    def __init__(self, spark: SparkSession, root: str, full_refresh: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        gens = self._generations()
        if full_refresh or not gens:
            self.generation = (max(gens) + 1) if gens else 0
        else:
            self.generation = max(gens)

    def _generations(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("gen="):
                out.append(int(name.split("=", 1)[1]))
        return out

    def table(self, name: str) -> str:
        return f"{self.root}/gen={self.generation}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/gen={self.generation}/checkpoints/{name}"
