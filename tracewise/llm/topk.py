"""Exact top-k search: tiled matrix products of query tiles and base tiles.

Vectors are dealt into tiles by a hash of their id and packed into one matrix per
tile. Each (query tile, base tile) pair is one matrix product inside a task, of
which only the k best per query leave it; the partial lists of a query tile meet
in a tree of merges with a fixed fan-in. Nothing larger than two tiles and a
fixed number of top lists is ever in one task, whatever the size of the tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import materialize

LONG_MIN = np.iinfo(np.int64).min
PACKED = "tile int, n int, dim int, bits int, top double, ids binary, mat binary"
PARTIAL = "q_tile int, dim int, b_group int, n int, q_ids binary, ids binary, scores binary"


def _pack(key, tab):
    """One tile: ids ascending, and the matrix in the smallest exact type (float64 beyond 2^31)."""
    ids = tab["vec_id"].to_numpy()
    dim = key[1].as_py()
    vals = np.floor(tab["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    ids, vals = ids[order], vals[order]
    top = float(np.abs(vals).max()) if vals.size else 0.0
    bits = 8 if top < 2 ** 7 else 16 if top < 2 ** 15 else 32 if top < 2 ** 31 else 64
    mat = vals.astype(f"int{bits}") if bits < 64 else vals
    return pa.table({"tile": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                     "dim": pa.array([dim], pa.int32()), "bits": pa.array([bits], pa.int32()),
                     "top": pa.array([top], pa.float64()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                     "mat": pa.array([np.ascontiguousarray(mat).tobytes()], pa.binary())})


def _unpack(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}ids"], np.int64)
    kind = f"int{row[f'{side}bits']}" if row[f"{side}bits"] < 64 else "float64"
    return ids, np.frombuffer(row[f"{side}mat"], kind).reshape(len(ids), row["dim"])


def products(q: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Integer inner products; float64 BLAS where it is exact, Python integers beyond (saturating at long)."""
    if bound < 2.0 ** 53:
        return (q.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in q], object).reshape(q.shape) @ \
        np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    return np.clip(whole, LONG_MIN + 1, np.iinfo(np.int64).max).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k highest scores, ties to the smaller id; LONG_MIN marks no entry. ids ascend or are per row."""
    real = scores[scores != LONG_MIN]
    if scores.shape[1] > 4 * k and ids.ndim == 1 and scores.shape[1] <= 2 ** 16 \
            and max(real.max(initial=0), -real.min(initial=0)) < 2 ** 45:
        # one number orders by score, then by place (ids ascend): partial selection needs no full sort
        rank = np.where(scores == LONG_MIN, LONG_MIN, scores * 2 ** 16 - np.arange(scores.shape[1]))
        keep = np.argpartition(rank, scores.shape[1] - k, axis=1)[:, -k:]
        scores, ids = np.take_along_axis(scores, keep, 1), ids[keep]
    if ids.ndim == 1:
        ids = np.broadcast_to(ids, scores.shape)
    flipped = np.where(scores == LONG_MIN, np.iinfo(np.int64).max, -np.maximum(scores, LONG_MIN + 1))
    order = np.lexsort((ids, flipped), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _partial_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"q_tile": pa.int32(), "dim": pa.int32(), "b_group": pa.int32(), "n": pa.int32(),
             "q_ids": pa.binary(), "ids": pa.binary(), "scores": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], t) for c, t in kinds.items()})


def top_k(vectors: DataFrame, k: int = 20, query_mod: int = 20, scale: int = 64,
          query_tile: int = 1024, base_tile: int = 8192, fan_in: int = 8) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows by integer inner product.

    ``vectors`` has vec_id and embedding; components become floor(scale * x).
    Queries are the rows whose vec_id is divisible by ``query_mod``; candidates
    are all rows with another vec_id. Rows with a null id, a null or empty
    vector, or a null or non-finite component take no part; a row repeated
    exactly counts once; vectors of different length are never compared; ties
    go to the smaller vec_id; fewer than k candidates give fewer rows; an empty
    table gives none; other columns are ignored.
    """
    spark = vectors.sparkSession
    ok = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
          & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    clean = (vectors.where(ok)
             .select(F.col("vec_id").cast("long"), F.size("embedding").alias("dim"),
                     F.transform("embedding", lambda x: x.cast("double") * float(scale)).alias("vec"))
             .distinct())
    clean = materialize(clean, "vectors")
    count = clean.count()
    if count == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_base = -(-count // base_tile)
    queries = clean.where(F.col("vec_id") % query_mod == 0)
    n_query = max(1, -(-queries.count() // query_tile))

    def tiles(df, n, seed):
        t = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
        return df.withColumn("tile", t).groupBy("tile", "dim").applyInArrow(_pack, PACKED)

    base = tiles(clean, n_base, 1).select("dim", F.col("tile").alias("b_tile"), "ids", "bits", "top", "mat")
    asked = tiles(queries, n_query, 2).select(
        "dim", F.col("tile").alias("q_tile"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "bits", "top", "mat")])
    spread = asked.withColumn("b_tile", F.explode(F.sequence(F.lit(0), F.lit(n_base - 1))))
    pairs = spread.join(base, ["dim", "b_tile"])

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q_ids, q = _unpack(row, "q_")
                b_ids, b = _unpack(row, "")
                s = products(q, b, row["dim"] * row["top"] * row["q_top"])
                s[q_ids[:, None] == b_ids[None, :]] = LONG_MIN
                top, who = best(s, b_ids, k)
                yield _partial_rows([{"q_tile": row["q_tile"], "dim": row["dim"], "b_group": row["b_tile"], "n": top.shape[1],
                                      "q_ids": row["q_ids"], "ids": who.astype(np.int64).tobytes(), "scores": top.tobytes()}])

    def merge(key, tab):
        rows = tab.to_pylist()
        nq = len(rows[0]["q_ids"]) // 8
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64).reshape(nq, r["n"]) for r in rows], axis=1)
        scores = np.concatenate([np.frombuffer(r["scores"], np.int64).reshape(nq, r["n"]) for r in rows], axis=1)
        top, who = best(scores, ids, k)
        return pa.Table.from_batches([_partial_rows([{
            "q_tile": key[0].as_py(), "dim": key[1].as_py(), "b_group": key[2].as_py(), "n": top.shape[1],
            "q_ids": rows[0]["q_ids"], "ids": np.ascontiguousarray(who).tobytes(), "scores": np.ascontiguousarray(top).tobytes()}])])

    lists = pairs.select("q_tile", "dim", "b_tile", "q_ids", "q_bits", "q_top", "q_mat", "ids", "bits", "top", "mat") \
        .mapInArrow(search, PARTIAL)
    groups = n_base
    while groups > 1:
        groups = -(-groups // fan_in)
        lists = (lists.withColumn("b_group", F.floor(F.col("b_group") / fan_in).cast("int"))
                 .groupBy("q_tile", "dim", "b_group").applyInArrow(merge, PARTIAL))

    def rows_out(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_ids = np.frombuffer(r["q_ids"], np.int64)
                ids = np.frombuffer(r["ids"], np.int64).reshape(len(q_ids), r["n"])
                scores = np.frombuffer(r["scores"], np.int64).reshape(len(q_ids), r["n"])
                have = scores != LONG_MIN
                rank = np.broadcast_to(np.arange(1, r["n"] + 1, dtype=np.int32), scores.shape)
                yield pa.RecordBatch.from_pydict({
                    "query_id": np.broadcast_to(q_ids[:, None], scores.shape)[have],
                    "rank": rank[have], "vec_id": ids[have], "score": scores[have]})

    return lists.mapInArrow(rows_out, "query_id long, rank int, vec_id long, score long")
