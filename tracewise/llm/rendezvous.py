"""Sharding by weighted rendezvous hashing (native: DataFrame functions only).

Every shard draws a pseudo-random number from (record key, shard number); the
shard with the smallest ``-ln(u) / weight`` takes the record. A record depends on
its key and the shard list alone, so one more shard takes records only into
itself and removing a shard moves only its own records.

Inside a shard, records get gapless slots without sorting a shard in one task:
equal rows are counted first (map-side combine), rows are dealt into blocks by a
content hash, numbered per (shard, block), and shifted by the block's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.common import text_or_empty

HEX_DIGITS = 13           # 52 bits of the digest: exact as a double
RUN = 65536               # copies of one row are spread over runs of this length


def key_text(key: Column) -> Column:
    """Canonical text of a record key; a null key is hashed as the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def draws(key: Column, weights: list[float]) -> Column:
    """Array of (score, shard) for each shard; the smallest score wins, ties go to the lower shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    w = F.array(*[F.lit(float(x)) for x in weights])
    text = key_text(key)

    def draw(i):
        digest = F.md5(F.concat(text, F.lit("#"), i.cast("string")))
        u = (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16 ** HEX_DIGITS))
        return F.struct((-F.ln(u) / F.element_at(w, i + 1)).alias("score"), i.alias("shard"))

    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), draw)


def assign(df: DataFrame, key: str, weights: list[float], grown_weight: float | None = None) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (with one more shard of ``grown_weight``; null when not asked).

    Columns of those names in ``df`` are replaced.
    """
    n = len(weights)
    all_w = weights + ([grown_weight] if grown_weight is not None else [])
    out = df.withColumn("_draws", draws(F.col(key), all_w))
    out = out.withColumn("shard", F.array_min(F.slice("_draws", 1, n))["shard"])
    grown = F.array_min(F.col("_draws"))["shard"] if grown_weight is not None else F.lit(None).cast("int")
    return out.withColumn("grown_shard", grown).drop("_draws")


def with_slots(rows: DataFrame, shard: str, order: list[str], blocks_hex: int = 3) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, as column ``slot``.

    ``order`` must name all columns but the shard that tell rows apart. Blocks are
    the first ``blocks_hex`` hex digits of a digest of those columns (4,096 per
    shard by default), so the work of a shard spreads over many tasks and the
    offsets table is bounded by shards x blocks. Equal rows are counted before
    the shuffle and dealt out again in runs, so a third of all rows being equal
    costs one row until the very end.
    """
    cols = [c for c in rows.columns if c not in ("_n", "_block", "slot")]
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    digest = F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    counted = counted.withColumn("_block", F.substring(digest, 1, blocks_hex))
    sizes = counted.groupBy(shard, "_block").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy(shard, "_block").orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (counted.withColumn("_start", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(offsets, [shard, "_block"]))
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / RUN))))
    last = F.least(F.lit(RUN).cast("long"), F.col("_n") - F.col("_run") * RUN) - 1
    one = runs.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    slot = F.col("_offset") + F.col("_start") + F.col("_run") * RUN + F.col("_i")
    return one.select(*cols, slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, weights: list[float] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text plus 8 (a null text has none), the
    key is ``doc_id``. Null ids share the empty key; rows with one id go to one
    shard; repeated rows get a slot each; an empty table gives no rows; other
    columns of ``docs`` are ignored.
    """
    weights = weights or [1.0] * shards
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = with_slots(assign(rows, "doc_id", weights, 1.0), "shard", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                         "shard", "slot", "grown_shard")
