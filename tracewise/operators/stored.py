"""Stored tables changed in place (B8, J4) and declared tables.

``upsert_in_place`` rewrites only the partition folders that a batch touches.
``declare_table`` and ``insert_by_name`` give a catalogue table whose columns have
defaults, filled by the insert that leaves them out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tracewise.operators.upsert import latest_per_key, upsert
from tracewise.session import path_exists, remove_path


def _in_partitions(values: list, partition_by: list[str]) -> Column:
    one = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v[c])) for c in partition_by]) for v in values]
    return reduce(lambda a, b: a | b, one)


def upsert_in_place(path: str, source: DataFrame, keys: list[str], partition_by: list[str],
                    order_by: list[str] | None = None) -> None:
    """Upsert ``source`` by ``keys`` into the Parquet table at ``path``, rewriting touched partitions only.

    The partition columns are part of the key, so no row moves between partitions
    and the others keep their files. The new partitions are staged whole below
    ``path`` first; only then does a dynamic overwrite replace the old ones from
    there. A run that finds a finished stage of a lost run repeats its swap, and a
    batch applied again changes no row. One writer at a time. Empty strings
    in partition columns become null, as in any partition folder. The driver
    sees the batch's partition values, at most one per folder.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {partition_by} must be among the keys {keys}")
    spark, staged = source.sparkSession, f"{path.rstrip('/')}/_staged"
    texts = [c for c in partition_by if isinstance(source.schema[c].dataType, StringType)]
    source = source.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})

    def stored(folder: str) -> DataFrame:
        return spark.read.schema(source.schema).parquet(folder).select(*source.columns)

    def swap() -> None:
        (stored(staged).hint("rebalance", *map(F.col, partition_by)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
        remove_path(spark, staged)

    if path_exists(spark, f"{staged}/_SUCCESS"):
        swap()
    touched = source.select(*partition_by).distinct().collect()
    if not touched:
        return
    if path_exists(spark, path):
        rows = upsert(stored(path).where(_in_partitions(touched, partition_by)), source, keys, order_by)
    else:
        rows = latest_per_key(source, keys, order_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
    swap()


def declare_table(spark: SparkSession, name: str, schema: StructType, path: str, defaults: dict[str, str] | None = None,
                  partition_by: list[str] | None = None) -> None:
    """A Parquet table ``name`` at ``path``; ``defaults`` maps columns to SQL expressions. A table that exists stays."""
    defaults = defaults or {}
    unknown = (set(defaults) | set(partition_by or [])) - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
                        for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts} LOCATION '{path}'")


def insert_by_name(rows: DataFrame, name: str) -> None:
    """Append ``rows`` by column name; columns left out get their default (null without one)."""
    rows.sparkSession.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=rows)
