"""Exact k-nearest-neighbour distance (kNN outlier score, M3) without all pairs.

score(x) = Euclidean distance from x to its k-th nearest reference row
(excluding x itself, by id, when x is one of the reference rows).

Plan
----
1. Cells: a k-d tree, fitted on a bounded hash sample of the reference rows, halves
   the widest feature of each part until a cell holds about ``cell_rows`` rows; a hash
   of the id breaks ties, so equal or crowded points spread over many cells. Cells and
   boxes are the fitted model: written once, searched by any number of batches.
2. Boxes, on two levels: per cell the bounding box in every feature, and per group
   of neighbouring cells the box around theirs. There are at most ``MOST_GROUPS``
   groups, however many cells, so their boxes are broadcast; the cells' boxes stay a
   table and are joined by group.
3. Pass 1: each query row goes to the nearest cell of the nearest group; a
   co-grouped numpy kernel returns its k nearest distances inside that cell,
   giving an upper bound r on the k-th distance.
4. Pass 2: the query row visits every other cell whose group's box and own box are
   closer than r (strictly — a cell at distance r cannot improve the bound) and
   brings back distances below r only.
5. The k smallest of all candidates per query.

Each co-group is (cell, query chunk); chunks are sized from query counts per
cell, so one crowded cell never becomes one huge task. Inside a co-group both sides
are cut into small blocks of near rows: a block of queries meets the nearest blocks of
rows first and skips those beyond its bound. Only k rows per (query, visited cell)
leave a task. Exact for any data; work shrinks with the data's geometry and is
quadratic only when no pruning is possible.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.session import ensure_checkpoint_dir

_QUERY_CHUNK_ROWS = 8192
_BLOCK_ROWS = 64           # rows of one side that the kernel takes together
_MOST_BLOCKS = 32          # blocks of rows that meet a block of queries at once
_BOX_NUMBERS = 1 << 20     # distances to boxes that a task holds at once
_OUT_ROWS = 1 << 14        # rows that it emits at once
MOST_GROUPS = 20_000       # boxes that are broadcast at most
MOST_CELLS = 8192          # cells grow beyond ``cell_rows`` rows rather than in number
SAMPLE_PER_CELL = 64       # sampled rows per cell that the tree is fitted on


def _vector(features: list[str]):
    return F.array(*[F.col(c).cast("double") for c in features])


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)


def _tree(v: np.ndarray, tie: np.ndarray, leaves: int) -> tuple[np.ndarray, ...]:
    """k-d tree with ``leaves`` leaves over the sampled rows: dim, value, tie, low and high child of every inner node.

    A part is cut in proportion to its leaves along its widest feature, at a row's (value, tie).
    A negative child is the leaf -1 - child; leaves are numbered in the tree's order.
    """
    nodes: list[list] = []
    done = 0

    def grow(rows: np.ndarray, n: int) -> int:
        nonlocal done
        if n == 1:
            done += 1
            return -done
        left = n // 2
        here, part = len(nodes), v[rows]
        dim = int(np.argmax(part.max(0) - part.min(0))) if len(rows) else 0
        order = rows[np.lexsort((tie[rows], v[rows, dim]))]
        cut = len(rows) * left // n
        nodes.append([dim, v[order[cut], dim], tie[order[cut]], 0, 0] if len(rows) else [0, 0.0, 0, 0, 0])
        nodes[here][3] = grow(order[:cut], left)
        nodes[here][4] = grow(order[cut:], n - left)
        return here

    grow(np.arange(len(v)), leaves)
    return (np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes], float),
            np.array([n[2] for n in nodes], np.int64), np.array([n[3] for n in nodes], np.int64), np.array([n[4] for n in nodes], np.int64))


def _leaf(tree: tuple[np.ndarray, ...], v: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    dim, value, ties, low, high = tree
    at = np.zeros(len(v), np.int64)
    while len(rows := np.flatnonzero(at >= 0)):
        node = at[rows]
        x, y = v[rows, dim[node]], value[node]
        at[rows] = np.where((x < y) | ((x == y) & (tie[rows] < ties[node])), low[node], high[node])
    return -1 - at


def build_cells(reference: DataFrame, ref_id_col: str, features: list[str], cell_rows: int = 8192,
                most_cells: int = MOST_CELLS) -> DataFrame:
    """The fitted model's rows: rid (64-bit hash of the id), v, cell. A write of it fixes the cells.

    Rows with a null or non-finite feature have no distance to any row and are left out.
    The tree is fitted on ``SAMPLE_PER_CELL`` rows per cell, those of the smallest hashes.
    """
    rows = (reference.select(F.xxhash64(F.col(ref_id_col).cast("string")).alias("rid"), _vector(features).alias("v"))
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))))
    n = rows.count()
    cells = max(1, min(most_cells, math.ceil(n / cell_rows)))
    if cells == 1:
        return rows.select("rid", "v", F.lit(0).alias("cell"))
    tie = F.xxhash64("rid")
    share = min(1.0, SAMPLE_PER_CELL * cells / n)
    found = rows.where(F.xxhash64("rid", F.lit(1)) < F.lit(int(share * 2.0 ** 64 - 2.0 ** 63) if share < 1 else 2 ** 63 - 1)).select(
        "v", tie.alias("tie")).limit(4 * SAMPLE_PER_CELL * cells).toPandas()
    sample = np.stack(found["v"].to_numpy()).astype(float) if len(found) else np.zeros((0, len(features)))
    tree = rows.sparkSession.sparkContext.broadcast(_tree(sample, found["tie"].to_numpy().astype(np.int64), cells))

    def place(batches):
        for b in batches:
            cell = _leaf(tree.value, _vectors(b.column("v"), len(features)), b.column("tie").to_numpy())
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("v"), pa.array(cell.astype(np.int32))], ["rid", "v", "cell"])

    return rows.withColumn("tie", tie).mapInArrow(place, "rid long, v array<double>, cell int")


def cell_boxes(cells: DataFrame, dims: int, most_groups: int = MOST_GROUPS) -> DataFrame:
    """cell, lo, hi, grp: the bounding box of every cell and the group of neighbouring cells that it belongs to."""
    last = cells.agg(F.max("cell")).first()[0] or 0
    span = math.ceil((last + 1) / most_groups)
    return _boxes(cells, "cell", "v", "v", dims).select(
        F.expr("cell + 0").alias("cell"), "lo", "hi", F.floor(F.col("cell") / span).cast("int").alias("grp"))


def _boxes(rows: DataFrame, by: str, lo: str, hi: str, dims: int) -> DataFrame:
    return rows.groupBy(by).agg(F.array(*[F.min(F.col(lo)[i]) for i in range(dims)]).alias("lo"),
                                F.array(*[F.max(F.col(hi)[i]) for i in range(dims)]).alias("hi"))


def _gap():
    """Distance from the query vector ``qv`` to the box (lo, hi)."""
    outside = F.zip_with(F.zip_with("lo", "qv", lambda a, q: F.greatest(a - q, F.lit(0.0))),
                         F.zip_with("qv", "hi", lambda q, b: F.greatest(q - b, F.lit(0.0))),
                         lambda x, y: F.greatest(x, y))
    return F.sqrt(F.aggregate(outside, F.lit(0.0), lambda acc, d: acc + d * d))


def _box_dist(q: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Distance from each query row to each box, yielded per block of query rows: (start, (nb, nc))."""
    block = max(1, _BOX_NUMBERS // max(1, len(lo)))
    for s in range(0, q.shape[0], block):
        yield s, np.sqrt(_gap2(q[s:s + block], q[s:s + block], lo, hi))


def _gap2(qlo: np.ndarray, qhi: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance from each box (qlo, qhi) to each box (lo, hi), feature by feature."""
    total = np.zeros((len(qlo), len(lo)))
    for j in range(lo.shape[1]):
        gap = np.maximum(lo[None, :, j] - qhi[:, None, j], qlo[:, None, j] - hi[None, :, j])
        np.maximum(gap, 0, out=gap)
        gap *= gap
        total += gap
    return total


def _blocks(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which stretches of up to _BLOCK_ROWS rows lie close together, and the stretches' starts."""
    parts, done = [np.arange(len(v))], []
    while parts:
        rows = parts.pop()
        if len(rows) <= _BLOCK_ROWS:
            done.append(rows)
            continue
        part = v[rows]
        dim = int(np.argmax(part.max(0) - part.min(0)))
        half = math.ceil(len(rows) / _BLOCK_ROWS / 2) * _BLOCK_ROWS
        split = np.argpartition(part[:, dim], half) if half < len(rows) else np.arange(len(rows))
        parts += [rows[split[half:]], rows[split[:half]]]
    sizes = [len(rows) for rows in done]
    return np.concatenate(done), np.concatenate([[0], np.cumsum(sizes)])


def _boxes_of(v: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(v, starts[:-1], axis=0), np.maximum.reduceat(v, starts[:-1], axis=0)


def _nearest(q: np.ndarray, qid: np.ndarray, bound: np.ndarray, v: np.ndarray, rid: np.ndarray, k: int, exclude_self: bool) -> np.ndarray:
    """The k smallest distances below ``bound`` from each query to the rows (inf where there are fewer), ascending."""
    best = np.full((len(q), k), np.inf)
    usable = np.flatnonzero(np.isfinite(q).all(1))
    if not len(usable) or not len(v):
        return best
    order, starts = _blocks(v)
    v, rid = v[order], rid[order]
    lo, hi = _boxes_of(v, starts)
    v2 = (v * v).sum(1)
    qorder, qstarts = _blocks(q[usable])
    qorder = usable[qorder]
    qlo, qhi = _boxes_of(q[qorder], qstarts)
    for g in range(len(qstarts) - 1):
        mine = qorder[qstarts[g]:qstarts[g + 1]]
        gap = np.sqrt(_gap2(qlo[g:g + 1], qhi[g:g + 1], lo, hi)[0])
        near = np.argsort(gap, kind="stable")
        gap = gap[near]
        top, limit, take, at = best[mine], bound[mine], max(1, math.ceil(2 * k / _BLOCK_ROWS)), 0
        x, own = q[mine], qid[mine]
        x2 = (x * x).sum(1)
        while at < len(near):
            end = min(at + take, at + int(np.searchsorted(gap[at:], limit.max(), "left")))    # blocks at the bound cannot improve it
            if end == at:
                break
            some = np.concatenate([np.arange(starts[b], starts[b + 1]) for b in near[at:end]])
            y, y2 = v[some], v2[some]
            # a matrix product leaves out pairs that lie beyond the bound by more than its rounding error; the rest is exact
            rough = x @ y.T
            rough *= -2
            rough += y2
            i, j = np.nonzero(~(rough > (limit * limit * (1 + 1e-9) + 1e-9 * (x2 + y2.max()) - x2)[:, None]))
            d = np.zeros(len(i))
            for c in range(v.shape[1]):
                diff = x[i, c] - y[j, c]
                d += diff * diff
            np.sqrt(d, out=d)
            nearer = d < limit[i]
            if exclude_self:
                nearer &= own[i] != rid[some[j]]
            i, d = i[nearer], d[nearer]
            if len(i):
                counts = np.bincount(i, minlength=len(mine))
                more = np.full((len(mine), counts.max()), np.inf)
                more[i, np.arange(len(i)) - (np.cumsum(counts) - counts)[i]] = d
                top = np.partition(np.concatenate([top, more], axis=1), k - 1, axis=1)[:, :k]
                limit = np.minimum(limit, top.max(1))
            at, take = end, min(2 * take, _MOST_BLOCKS)
        best[mine] = np.sort(top, axis=1)
    return best


def _kernel(k: int, dims: int, first: bool, exclude_self: bool):
    """Co-group kernel: per query row, its k smallest distances to the cell's rows below its bound ``r``.

    The first pass emits one row per query, (qid, qv, cell, ds), so that the second can
    start from it without joining back to the queries; the second emits (qid, ds) of
    queries that came nearer.
    """
    def fn(queries: pa.Table, refs: pa.Table) -> pa.Table:
        n = queries.num_rows
        found = np.full((n, k), np.inf)
        if n and refs.num_rows:
            bound = np.full(n, np.inf) if first else queries.column("r").to_numpy()
            found = _nearest(_vectors(queries.column("qv").combine_chunks(), dims), queries.column("qid").to_numpy(), bound,
                             _vectors(refs.column("v").combine_chunks(), dims), refs.column("rid").to_numpy(), k, exclude_self)
        kept = np.isfinite(found)
        ends = np.concatenate([[0], np.cumsum(kept.sum(1))]).astype(np.int32)
        ds = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[kept]))
        if first:
            return pa.table({"qid": queries.column("qid"), "qv": queries.column("qv"), "cell": queries.column("cell"), "ds": ds})
        return pa.table({"qid": queries.column("qid"), "ds": ds}).filter(pa.array(kept.any(1)))
    return fn


def _visit(cells: DataFrame, queries: DataFrame, k: int, dims: int, first: bool, exclude_self: bool) -> DataFrame:
    """queries(qid, qv, cell, and r after the first pass) x cells(rid, v, cell) -> rows per query and visited cell."""
    per_cell = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("_nq"))
    chunks = per_cell.select("cell", F.greatest(F.lit(1), F.ceil(F.col("_nq") / _QUERY_CHUNK_ROWS))
                             .cast("int").alias("_chunks"))
    q = (queries.join(chunks, "cell")
         .withColumn("chunk", F.pmod(F.xxhash64("qid"), F.col("_chunks")).cast("int")).drop("_chunks"))
    r = (cells.join(chunks, "cell")
         .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks"))
    schema = "qid long, qv array<double>, cell int, ds array<double>" if first else "qid long, ds array<double>"
    return (q.groupBy("cell", "chunk").cogroup(r.groupBy("cell", "chunk"))
            .applyInArrow(_kernel(k, dims, first, exclude_self), schema))


def knn_scores(points: DataFrame, id_col: str, features: list[str], reference: DataFrame | None = None,
               ref_id_col: str | None = None, k: int = 5, cell_rows: int = 8192,
               exclude_self: bool | None = None, most_groups: int = MOST_GROUPS,
               keep_distances: bool = False) -> DataFrame:
    """(id, score): distance to the k-th nearest reference row.

    ``reference`` defaults to ``points``; then (or with ``exclude_self=True``) a
    row never counts as its own neighbour (matched by id). Scoring new rows
    against a training reference keeps every reference row. Feature values are
    used unscaled, as in the source pipeline. ``keep_distances`` adds the sorted
    k nearest distances, so one run serves every smaller k as well."""
    if exclude_self is None:
        exclude_self = reference is None
    # Inputs are read by several jobs (sizes, quantiles, boxes, two passes):
    # materialise them once instead of recomputing their lineage each time.
    ensure_checkpoint_dir(points.sparkSession)
    same = reference is None
    points = points.checkpoint()
    reference = points if same else reference.checkpoint()
    cells = build_cells(reference, ref_id_col or id_col, features, cell_rows=cell_rows).checkpoint()
    boxes = cell_boxes(cells, len(features), most_groups).checkpoint()
    return search_cells(points, id_col, features, cells, boxes, k, exclude_self, keep_distances)


def search_cells(points: DataFrame, id_col: str, features: list[str], cells: DataFrame, boxes: DataFrame, k: int = 5,
                 exclude_self: bool = False, keep_distances: bool = False) -> DataFrame:
    """(id, score) of stored ``points`` against fitted, stored cells and their boxes."""
    dims = len(features)
    groups = _boxes(boxes.withColumn("cells", F.lit(1)), "grp", "lo", "hi", dims).join(
        boxes.groupBy("grp").agg(F.max("cell").alias("cell"), F.count(F.lit(1)).alias("n")), "grp").toPandas()   # a bounded number of rows
    # a row's code is a 64-bit hash of its id; the same on both sides
    queries = points.select(F.xxhash64(F.col(id_col).cast("string")).alias("qid"), _vector(features).alias("qv"))
    flat = bool(len(groups)) and int(groups["n"].max()) == 1       # every group is one cell: its box is exact
    if len(groups) <= 1 and (flat or not len(groups)):
        d1 = _visit(cells, queries.withColumn("cell", F.lit(0)), k, dims, True, exclude_self)
        merged = d1.select("qid", "ds")   # one cell holds every reference row: pass 1 is exact
        return _scored(points, id_col, merged, k, keep_distances)
    group_ids = groups["grp"].to_numpy()
    lo = np.stack(groups["lo"].to_numpy()).astype("float64")
    hi = np.stack(groups["hi"].to_numpy()).astype("float64")
    bc = points.sparkSession.sparkContext.broadcast((group_ids, groups["cell"].to_numpy(), lo, hi))

    def nearest_group(batches):
        ids, only, blo, bhi = bc.value
        for b in batches:
            if b.num_rows:
                qv = _vectors(b.column("qv"), dims)
                nearest = np.concatenate([np.argmin(d, axis=1) for _, d in _box_dist(qv, blo, bhi)])
                yield pa.RecordBatch.from_arrays([b.column("qid"), b.column("qv"), pa.array(ids[nearest].astype(np.int32)),
                                                  pa.array(only[nearest].astype(np.int32))], ["qid", "qv", "grp", "cell"])

    q1 = queries.mapInArrow(nearest_group, "qid long, qv array<double>, grp int, cell int")
    if not flat:
        q1 = (q1.drop("cell").join(boxes, "grp").groupBy("qid").agg(F.min(F.struct(_gap().alias("gap"), "cell", "qv")).alias("m"))
              .select("qid", F.col("m.qv").alias("qv"), F.col("m.cell").alias("cell")))
    d1 = _visit(cells, q1.select("qid", "qv", "cell"), k, dims, True, exclude_self)
    # pass 2 starts from pass 1's rows (query vector, own cell, bound) and is
    # merged back per query: one written frame read twice
    d1 = d1.checkpoint()
    q2_in = d1.select("qid", "qv", "cell", F.when(F.size("ds") >= k, F.element_at("ds", k))
                      .otherwise(F.lit(float("inf"))).alias("r"))

    def close_groups(batches):
        ids, only, blo, bhi = bc.value
        for b in batches:
            if not b.num_rows:
                continue
            qv, r, own = _vectors(b.column("qv"), dims), b.column("r").to_numpy(), b.column("cell").to_numpy()
            for start, dist in _box_dist(qv, blo, bhi):
                close = dist < r[start:start + dist.shape[0], None]
                if flat:
                    close &= only[None, :] != own[start:start + dist.shape[0], None]
                qi, gi = np.nonzero(close)
                for s in range(0, len(qi), _OUT_ROWS):
                    q, g = qi[s:s + _OUT_ROWS] + start, gi[s:s + _OUT_ROWS]
                    near = b.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays(
                        [near.column("qid"), near.column("qv"), near.column("cell"), near.column("r"), pa.array(ids[g].astype(np.int32)),
                         pa.array(only[g].astype(np.int32))], ["qid", "qv", "own", "r", "grp", "cell"])

    q2 = q2_in.mapInArrow(close_groups, "qid long, qv array<double>, own int, r double, grp int, cell int")
    if not flat:
        q2 = q2.drop("cell").join(boxes, "grp").where((F.col("cell") != F.col("own")) & (_gap() < F.col("r")))
    d2 = _visit(cells, q2.select("qid", "qv", "cell", "r"), k, dims, False, exclude_self)
    # at most k numbers per cell that a query has visited
    nearer = d2.groupBy("qid").agg(F.flatten(F.collect_list("ds")).alias("more"))
    merged = d1.select("qid", "ds").join(nearer, "qid", "left").select(
        "qid", F.when(F.col("more").isNull(), F.col("ds")).otherwise(F.slice(F.array_sort(F.concat("ds", "more")), 1, k)).alias("ds"))
    return _scored(points, id_col, merged, k, keep_distances)


def _scored(points: DataFrame, id_col: str, merged: DataFrame, k: int, keep_distances: bool) -> DataFrame:
    scored = merged.select("qid", F.when(F.size("ds") >= k, F.element_at("ds", k)).alias("score"),
                           F.col("ds").alias("distances"))
    out = (points.select(F.col(id_col), F.xxhash64(F.col(id_col).cast("string")).alias("qid"))
           .join(scored, "qid", "left"))
    return out.select(id_col, "score", "distances") if keep_distances else out.select(id_col, "score")
