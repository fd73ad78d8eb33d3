"""Model versions that outlive a run (M8): an append-only log per model name.

Every change is one numbered JSON file: a version registered, or a version moved to a
stage. A writer reads the log, and commits under the next number by exclusive
creation; if another writer was first, the commit fails and nothing has changed. The
state (stage per version) is derived from the log by a Spark aggregate.

Where the file system creates exclusively (HDFS, stores with conditional writes) so
does the log; a plain local disk only checks first, which is enough for one driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.session import _file_system, path_exists

LOG_SCHEMA = "seq long, action string, version int, model_id string, detector string, params string, artefact string, loss double, stage string"
PRODUCTION, ARCHIVED, NONE = "Production", "Archived", "None"


class VersionConflict(RuntimeError):
    """Another writer has committed under the same number."""


class ModelRegistry:
    """The log of one model name below ``root``."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.folder = f"{root.rstrip('/')}/{name}/log"

    def log(self) -> DataFrame:
        """All entries, one row each."""
        if not path_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(self.folder)

    def last(self) -> tuple[int, int]:
        """(last entry's number, last version); zeros for an empty log."""
        seq, version = self.log().agg(F.max("seq"), F.max("version")).first()
        return seq or 0, version or 0

    def commit(self, after: int, entry: dict) -> int:
        """Append ``entry`` as number ``after`` + 1; VersionConflict if that number is taken."""
        seq = after + 1
        fs, path = _file_system(self.spark, f"{self.folder}/{seq:020d}.json")
        try:
            out = fs.create(path, False)
        except Exception as exc:
            if path_exists(self.spark, path.toString()):
                raise VersionConflict(f"entry {seq} of {self.name} is taken") from exc
            raise
        out.write(bytearray(json.dumps({"seq": seq, **entry}) + "\n", "utf-8"))
        out.close()
        return seq

    def register(self, model_id: str, detector: str, params: str, artefact: str | None = None, loss: float | None = None,
                 last: tuple[int, int] | None = None) -> int:
        """A new version (in no stage); ``last`` is the state that the caller has read."""
        seq, version = last or self.last()
        self.commit(seq, {"action": "register", "version": version + 1, "model_id": model_id, "detector": detector, "params": params,
                          "artefact": artefact, "loss": loss, "stage": NONE})
        return version + 1

    def promote(self, version: int, stage: str = PRODUCTION, last: tuple[int, int] | None = None) -> None:
        """Move a version to a stage; the one that was in Production before counts as archived from then on."""
        seq, newest = last or self.last()
        if not 1 <= version <= newest:
            raise ValueError(f"version {version} of {self.name} is not registered")
        self.commit(seq, {"action": "stage", "version": version, "stage": stage})

    def versions(self) -> DataFrame:
        """name, version, model_id, detector, params, artefact, loss, stage, transitions."""
        log = self.log()
        made = log.where("action = 'register'").drop("seq", "action", "stage")
        moved = log.where("action = 'stage'")
        now = moved.groupBy("version").agg(F.max_by("stage", "seq").alias("_stage"), F.max("seq").alias("_seq"), F.count(F.lit(1)).alias("_n"))
        newest = moved.where(F.col("stage") == PRODUCTION).agg(F.max("seq").alias("_newest"))
        stage = F.when((F.col("_stage") == PRODUCTION) & (F.col("_seq") < F.col("_newest")), ARCHIVED).otherwise(F.coalesce("_stage", F.lit(NONE)))
        return made.join(now, "version", "left").join(F.broadcast(newest)).select(
            F.lit(self.name).alias("name"), "version", "model_id", "detector", "params", "artefact", "loss", stage.alias("stage"),
            F.coalesce("_n", F.lit(0)).cast("long").alias("transitions"))

    def latest(self, stage: str = PRODUCTION) -> dict | None:
        """The newest version in a stage, or None."""
        row = self.versions().where(F.col("stage") == stage).orderBy(F.desc("version")).first()
        return None if row is None else row.asDict()
