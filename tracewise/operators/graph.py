"""Property graph as two DataFrames, with degree, motif and component jobs.

Vertices ``(id, ...)``; edges ``(src, dst, ...)``. Every operation is a
join/aggregate; nothing is collected except two scalars per component round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.session import ensure_checkpoint_dir, remove_path, shared_dir


@dataclass
class Graph:
    """L1: a vertex frame and an edge frame. Jobs on edges alone need no vertices."""
    vertices: DataFrame | None
    edges: DataFrame

    def filter_edges(self, predicate: str) -> "Graph":
        """L2: keep the vertex set, filter edges by a SQL predicate."""
        return Graph(self.vertices, self.edges.filter(F.expr(predicate)))

    @property
    def in_degrees(self) -> DataFrame:
        return in_degrees(self.edges)

    @property
    def out_degrees(self) -> DataFrame:
        return out_degrees(self.edges)

    @property
    def degrees(self) -> DataFrame:
        return degrees(self.edges)


def in_degrees(edges: DataFrame) -> DataFrame:
    """L3: (id, inDegree) for vertices with at least one incoming edge (null ids dropped, T16)."""
    return (edges.filter(F.col("dst").isNotNull()).groupBy(F.col("dst").alias("id"))
            .agg(F.count(F.lit(1)).cast("int").alias("inDegree")))


def out_degrees(edges: DataFrame) -> DataFrame:
    """L4: (id, outDegree)."""
    return (edges.filter(F.col("src").isNotNull()).groupBy(F.col("src").alias("id"))
            .agg(F.count(F.lit(1)).cast("int").alias("outDegree")))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): every edge counts once at each end."""
    ends = edges.select(F.explode(F.array(F.col("src"), F.col("dst"))).alias("id"))
    return (ends.filter(F.col("id").isNotNull()).groupBy("id")
            .agg(F.count(F.lit(1)).cast("int").alias("degree")))


def graph_vertices(nodes: DataFrame) -> DataFrame:
    """One row per vertex id (T17: a share id seen as file and folder is one vertex)."""
    return nodes.groupBy("id").agg(
        F.min("name").alias("name"), F.min("entity_type").alias("entity_type"),
        F.max("entity_role").alias("entity_role"))


def motif_single_edge(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """L6 ``(a)-[e]->(b)``: every edge whose two ends are vertices, flattened."""
    a = vertices.select(F.col("id").alias("a_id"), F.col("entity_type").alias("a_entity_type"))
    b = vertices.select(F.col("id").alias("b_id"), F.col("entity_type").alias("b_entity_type"))
    e = edges.select(F.col("id").alias("e_id"), F.col("src"), F.col("dst"),
                     F.col("relationship").alias("e_relationship"), F.col("event_ts").alias("e_event_ts"))
    return (e.join(a, e["src"] == a["a_id"]).join(b, e["dst"] == b["b_id"])
            .select("a_id", "a_entity_type", "e_id", "e_relationship", "e_event_ts", "b_id", "b_entity_type"))


def motif_reciprocal(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """L6 ``(a)-[e]->(b); (b)-[e2]->(a)``: every pair of opposite edges.

    The result is by definition one row per (e, e2) pair; the join is an
    equi-join on the directed pair (src, dst) = (e2.dst, e2.src), which AQE
    splits when one pair is hot. ``reciprocal_pair_counts`` gives the
    per-pair summary without materialising the pairs.
    """
    e = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).select(
        F.col("src").alias("a_id"), F.col("dst").alias("b_id"), F.col("id").alias("e_id"),
        F.col("relationship").alias("e_relationship"))
    e2 = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).select(
        F.col("src").alias("_b2"), F.col("dst").alias("_a2"), F.col("id").alias("e2_id"),
        F.col("relationship").alias("e2_relationship"))
    pairs = e.join(e2, (e["b_id"] == e2["_b2"]) & (e["a_id"] == e2["_a2"])).drop("_a2", "_b2")
    ids = vertices.select("id")
    return (pairs.join(ids.withColumnRenamed("id", "a_id"), "a_id", "left_semi")
                 .join(ids.withColumnRenamed("id", "b_id"), "b_id", "left_semi")
                 .select("a_id", "e_id", "e_relationship", "b_id", "e2_id", "e2_relationship"))


def reciprocal_pair_counts(edges: DataFrame) -> DataFrame:
    """Per directed pair (a, b) with edges both ways: the number of (e, e2) pairs.

    Pre-aggregates edges per directed pair before the join, so a hot pair is
    one row on each side.
    """
    per = (edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
           .groupBy(F.col("src").alias("a_id"), F.col("dst").alias("b_id"))
           .agg(F.count(F.lit(1)).alias("n_ab")))
    back = per.select(F.col("a_id").alias("b_id"), F.col("b_id").alias("a_id"), F.col("n_ab").alias("n_ba"))
    return per.join(back, ["a_id", "b_id"]).select("a_id", "b_id", (F.col("n_ab") * F.col("n_ba")).alias("n_pairs"))


# --------------------------------------------------------------------------- components

def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected connected components, label = smallest vertex id.

    Edges whose ends are not both vertices are ignored (T16); which ones those are is
    joined as in the rounds of ``edge_components``, so no task holds a hub's edges.
    Vertices without edges are their own component.
    """
    spark = vertices.sparkSession
    ids = vertices.select("id").filter(F.col("id").isNotNull()).distinct()
    cur, path = _cut(_undirected(edges))
    n_edges = cur.count()
    for _ in (0, 1):        # first by the one end, then by the other
        kept, kept_path = _cut(_of_vertices(cur, ids, n_edges).select(F.col("u").alias("hi"), F.col("v").alias("lo")), n_edges)
        remove_path(spark, path)
        cur, path = kept, kept_path
    return (vertices.join(_components_of(cur, path), "id", "left")
            .withColumn("component", F.coalesce(F.col("component"), F.col("id"))))


def edge_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of ``edges`` (src, dst); loops and edges with a null end say nothing."""
    return _components_of(*_cut(_undirected(edges)))


def _components_of(cur: DataFrame, path: str) -> DataFrame:
    """(id, component) of every end of the distinct edges (hi > lo) written at ``path``.

    Alternating large-star / small-star rounds (Kiveris et al., 2014) over the
    edge list until it is stars around the smallest ids. Each half round is an aggregate
    and a join; the neighbours of a hub meet its label where they are (see
    ``_with_label``), so no task holds them all. Each half reads its input several
    times, so an uncut plan would grow geometrically: lineage is cut by writing
    the edges below the session's checkpoint folder, in as many files as they fill
    tasks (see ``_cut``), and what was read is deleted. The loop ends when every
    vertex is a centre or has one edge to one, however many rounds that takes.
    """
    spark = cur.sparkSession
    n_edges, stars = _state(cur, cur.count())
    while not stars:
        half, half_path = _cut(_large_star(cur, n_edges), n_edges)
        nxt, nxt_path = _cut(_small_star(half, n_edges), n_edges)
        remove_path(spark, path)
        remove_path(spark, half_path)
        cur, path = nxt, nxt_path
        n_edges, stars = _state(cur, n_edges)
    return (cur.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
            .unionByName(cur.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()))


def extend_components(labels: DataFrame, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """L7 kept over loads: (id, component) of the stored ``labels`` after new vertices and edges.

    Old edges are not read. Only components that a new edge touches become vertices of a
    small graph, whose labels then replace theirs; the result equals a full run over all
    vertices and edges. Vertices that are known already, repeated edges and a batch
    applied again change nothing; edges with an end that is no vertex by then are ignored
    (T16), so a vertex must not come after its edges. Hubs among the edges and components with over 1/500 of all vertices meet their label by
    broadcast. An empty ``labels`` gives the components of the batch alone.
    """
    ensure_checkpoint_dir(labels.sparkSession)
    old = labels.select("id", "component")
    fresh = vertices.select("id").where("id is not null").distinct().join(old, "id", "left_anti")
    known = old.unionByName(fresh.select("id", F.col("id").alias("component"))).checkpoint()

    def meet(rows: DataFrame) -> DataFrame:
        rows = rows.distinct().checkpoint()
        per = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        label = per.join(known.select(F.col("id").alias("v"), F.col("component").alias("m")), "v")
        return _with_label(rows, label, rows.count())

    ends = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst")
    half = meet(ends.select(F.col("src").alias("v"), F.col("dst").alias("u"))).select(F.col("u").alias("v"), F.col("m").alias("u"))
    links = meet(half).where("u <> m").select(F.least("u", "m").alias("src"), F.greatest("u", "m").alias("dst")).distinct().checkpoint()
    moved = edge_components(links).where("id <> component").select(F.col("id").alias("component"), F.col("component").alias("m"))

    total = known.count()
    large = (known.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HUB_SHARE > F.lit(total))
             .select("component").join(moved, "component", "left"))
    small = known.join(F.broadcast(large.select("component")), "component", "left_anti")
    found = known.join(F.broadcast(large), "component").unionByName(small.join(moved, "component", "left"))
    return found.select("id", F.coalesce("m", "component").alias("component"))


HUB_SHARE = 500     # a vertex with more than 1 / HUB_SHARE of all edges is a hub: at most 2 * HUB_SHARE of them
EDGES_PER_TASK = 100_000


def _tasks(spark: SparkSession, rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-rows // EDGES_PER_TASK))


def _cut(df: DataFrame, most: int | None = None) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read back, and its path.

    Where it has at most ``most`` rows, the tasks are no more than those fill: a round has a
    dozen stages, and with a task for each shuffle partition most of them would be empty.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "component-edges")
    (df if most is None else df.coalesce(_tasks(spark, most))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _undirected(edges: DataFrame) -> DataFrame:
    """Canonical edges: distinct (hi, lo) with hi > lo."""
    e = edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    return e.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")).distinct()


def _of_vertices(edges: DataFrame, ids: DataFrame, n_edges: int) -> DataFrame:
    """Edges (v = hi, u = lo) whose ``hi`` is one of the distinct ``ids``."""
    rows = edges.select(F.col("hi").alias("v"), F.col("lo").alias("u"))
    per = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    known = per.join(ids.select(F.col("id").alias("v"), F.lit(True).alias("_known")), "v", "left")
    return _with_label(rows, known.select("v", F.coalesce("_known", F.lit(False)).alias("m"), "n"), n_edges).where("m").select("v", "u")


def _with_label(rows: DataFrame, labels: DataFrame, n_edges: int) -> DataFrame:
    """``rows`` (v, u) joined with ``labels`` (v, m, n; m not null) on v, n being the rows of v counted by the aggregate.

    Hubs are few whatever the graph, so their labels are broadcast and their rows
    are not shuffled; all others are joined by shuffle, none with more than
    1 / HUB_SHARE of the edges.
    """
    is_hub = F.col("n") * HUB_SHARE > F.lit(n_edges)
    hubs = labels.filter(is_hub).select("v", "m").coalesce(_tasks(rows.sparkSession, n_edges))
    others = labels.filter(~is_hub).select("v", "m")
    met = rows.join(F.broadcast(hubs), "v", "left")
    return met.where("m is not null").unionByName(met.where("m is null").drop("m").join(others, "v"))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """For each v: link every larger neighbour u > v to m(v) = min(v, N(v)). One row per edge, repeats included."""
    both = edges.selectExpr("stack(2, hi, lo, lo, hi) as (v, u)")
    labels = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    larger = edges.select(F.col("lo").alias("v"), F.col("hi").alias("u"))
    return _with_label(larger, labels, n_edges).select(F.col("u").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """For each v: link v and every smaller neighbour u < v to m(v) = min of those; ``n_edges`` is at least the edges."""
    labels = edges.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("n"))
    smaller = edges.select(F.col("hi").alias("v"), F.col("lo").alias("u"))
    linked = _with_label(smaller, labels, n_edges).select(F.greatest("u", "m").alias("hi"), F.least("u", "m").alias("lo"))
    own = labels.select(F.greatest("v", "m").alias("hi"), F.least("v", "m").alias("lo"))
    return linked.unionByName(own).filter(F.col("hi") != F.col("lo")).distinct()


def _state(edges: DataFrame, most: int) -> tuple[int, bool]:
    """Number of distinct edges (hi, lo), of which there are at most ``most``, and whether they are stars around smaller ids.

    They are when no vertex has two edges down, or one edge down and one up; all smaller-id
    neighbours are centres then, and the labels are final.
    """
    ends = edges.selectExpr("stack(2, hi, 1L, 0, lo, 0L, 1) as (v, down, up)")
    per = ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up")).coalesce(_tasks(edges.sparkSession, most))
    got = per.agg(F.sum("down").alias("n"), F.count_if(F.expr("down > 1 or down = 1 and up = 1")).alias("others")).first()
    return got["n"] or 0, got["others"] == 0


def neighbor_avg_degree(edges: DataFrame, id_prefix: str | None = None) -> DataFrame:
    """Mean degree over a vertex's neighbours (one entry per incident edge).

    The per-vertex degree table has one row per id, so the join never multiplies
    rows; a hub only makes its own side long, which AQE splits.
    """
    deg = degrees(edges)
    ok = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    nb = ok.select(F.col("src").alias("id"), F.col("dst").alias("nb")).unionByName(
        ok.select(F.col("dst").alias("id"), F.col("src").alias("nb")))
    if id_prefix:
        nb = nb.filter(F.col("id").startswith(id_prefix))
    return (nb.join(deg.withColumnRenamed("id", "nb"), "nb")
            .groupBy("id").agg(F.avg("degree").alias("avg_neighbor_degree")))
