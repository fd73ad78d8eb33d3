"""Exact Jaccard join of word shingles with signature trees.

1. Every text becomes its set of shingle hashes. Texts with equal sets form a class;
   the join is between classes, so copies cost nothing further.
2. Sets are cut into parts by hash. Two sets that link differ in at most ``d``
   shingles, so of a set's ``d + 1 + spare`` non-empty parts more than ``spare`` are
   equal in both. Each set sends one signature per part; a set of whose signatures at
   most ``spare`` are shared with anyone links with nothing. The others, counted again
   among themselves, fall into blocks (connected components over shared signatures).
   No linked pair is ever apart, and passages that many texts hold chain no strangers.
3. Inside a block a signature tree holds, per node, the OR and AND of its sets' token
   bitmaps and their size range. A dual traversal from (root, root) drops every node
   pair whose largest possible overlap or size ratio cannot reach the threshold; leaf
   pairs that survive are verified on the sets themselves, unless they are connected
   already. Blocks above a tile's size are split into tiles; all tiles meet tile 0, and
   then only the sets outside the block's most common component meet the other tiles,
   a few tiles of them each round, one tile pair at a time.

Signatures are sent packed per batch and hash bucket; of a signature that many sets
of a batch share two entries go to its bucket, the others go on by themselves. Sets travel only for classes in a block of two or more, once.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewise.llm.common import materialize, release, unused
from tracewise.operators.graph import edge_components

U = np.uint64
FAN_OUT = 8
TILE_SHINGLES, TILE_SETS = 500_000, 512
FIRST_SLOTS = 4            # slots of a block's first round of tile pairs; doubled each round
SIGNATURES_PER_BUCKET = 1_000_000
BROADCAST_BYTES = 4 * 2 ** 20
ID_BYTES, SET_BYTES = 72, 145  # of the driver's memory for each row of a broadcast table of ids, and of ``wanted`` in tile_links()
FILTER_BITS = 2 ** 25      # of the filter that is broadcast in place of more ids, at most


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHash(dict):
    """Word -> 64-bit hash, forgotten when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, size: int, words: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``size`` are one shingle, none give none.

    Words are runs of characters other than the ASCII white space, A-Z in lower case.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, U)
    h = np.fromiter(map(words.__getitem__, found), U, len(found))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, U)
    for i in range(n):
        out = mix(out * U(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def set_hashes(x: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    a = np.add.reduce(mix(x + U(11))) if len(x) else U(0)
    b = np.add.reduce(mix(x ^ U(0x5851F42D4C957F2D))) if len(x) else U(0)
    return int(a.astype(np.int64)), int((b + U(len(x))).astype(np.int64))


class Threshold:
    """Link when den * intersection >= num * union; size classes and part counts follow from it."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.num, self.den = num, den

    def needed(self, a: int, b: int) -> int:
        """Smallest linking intersection of sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    @functools.lru_cache(maxsize=None)  # noqa: B019 - one per Python worker
    def edges(self, upto: int) -> list[int]:
        """Size classes [edges[i], edges[i + 1]); a set links into its own class or the next ones only."""
        ratio = max(self.den / self.num, 1.25)
        out = [1]
        while out[-1] <= upto:
            out.append(max(out[-1] + 1, int(np.ceil(out[-1] * ratio)) + 1))
        return out

    def class_of(self, n: int) -> int:
        return int(np.searchsorted(self.edges(1 << max(4, n.bit_length())), n, "right")) - 1

    def parts(self, size_class: int, upto: int) -> tuple[int, int]:
        """(parts, most differing shingles) of pairs whose larger set is in the class."""
        most = self.edges(1 << max(4, (4 * upto + 8).bit_length()))[size_class + 1] - 1
        d = (self.den - self.num) * 2 * most // (self.den + self.num)
        return d + 1 + max(3, d // 4), d

    def signatures(self, x: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Per size class (the set's own and, where a larger set may link, the next) one signature per
        non-empty part, and how many of them the set can do without (negative: it sends empty parts as well)."""
        n = len(x)
        own, content, out = self.class_of(n), mix(x + U(101)), []
        spread = x >> U(17)
        edges = self.edges(1 << max(4, (4 * n + 8).bit_length()))
        for c in (own, own + 1):
            if c > own and n * self.den < self.num * edges[c]:
                break
            k, d = self.parts(c, n)
            part = (spread % U(k)).astype(np.uint16 if k < 65536 else np.int64)
            order = np.argsort(part, kind="stable")
            sorted_part = part[order]
            begin = np.flatnonzero(np.concatenate([[True], sorted_part[1:] != sorted_part[:-1]]))
            sums, which = np.add.reduceat(content[order], begin), sorted_part[begin].astype(U)
            spare = len(begin) - d - 1
            if len(begin) <= d:   # so few filled parts that an empty one may be the only equal one
                empty = np.setdiff1d(np.arange(k, dtype=U), which)
                sums, which = np.concatenate([sums, np.zeros(len(empty), U)]), np.concatenate([which, empty])
            out.append((mix(sums + mix(which + U(c) * U(1 << 40) + U(7))), spare))
        return out


# --------------------------------------------------------------------------- inside a tile


class Forest:
    """Union-find over the sets of a tile; smaller numbers win."""

    def __init__(self, labels: np.ndarray):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels.tolist())]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.root(i), self.root(j)))
        self.up[b] = a

    def roots(self) -> np.ndarray:
        up = np.array(self.up)
        while True:
            nxt = up[up]
            if np.array_equal(nxt, up):
                self.up = up.tolist()
                return up
            up = nxt


def linked(x: np.ndarray, y: np.ndarray, t: Threshold) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
    return common * (t.num + t.den) >= t.num * (len(x) + len(y))


class SignatureTree:
    """Levels of nodes from the leaves (one set each) to a root; a node's children are FAN_OUT neighbours."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        bits = int(min(16384, max(256, 1 << int(4 * np.median(sizes) - 1).bit_length())))
        leaf = np.zeros((len(sets), bits // 8), np.uint8)
        for row, s in zip(leaf, sets, strict=True):
            at = (s >> U(40)) % U(bits)
            np.bitwise_or.at(row, (at >> U(3)).astype(np.intp), (U(1) << (at & U(7))).astype(np.uint8))
        leaf = leaf.view(U)
        self.levels = [(leaf, leaf, sizes, sizes)]
        while len(self.levels[-1][2]) > 1:
            either, both, low, high = self.levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(either, at), np.bitwise_and.reduceat(both, at),
                                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray, t: Threshold) -> np.ndarray:
        """Which node pairs can still hold a linked pair, by size range and largest possible overlap."""
        either, both, low, high = self.levels[level]
        ok = (high[a] * t.den >= t.num * low[b]) & (high[b] * t.den >= t.num * low[a])
        at = np.flatnonzero(ok)
        i, j = a[at], b[at]
        only_a = np.bitwise_count(both[i] & ~either[j]).sum(axis=1, dtype=np.int64)
        only_b = np.bitwise_count(both[j] & ~either[i]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(high[i] - only_a, high[j] - only_b)
        ok[at] = overlap * (t.num + t.den) >= t.num * (low[i] + low[j])
        return ok

    def pairs(self, t: Threshold, step: int = 20_000):
        """Leaf pairs (i < j) that survive the dual traversal, in chunks."""
        stack = [(len(self.levels) - 1, np.array([0]), np.array([0]))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > step:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            keep = self.may_link(level, a, b, t)
            a, b = a[keep], b[keep]
            if level == 0:
                if len(a):
                    yield a, b
                continue
            below = len(self.levels[level - 1][2])
            ca = (a[:, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, :, None])
            cb = (b[:, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, None, :])
            ca, cb = (np.broadcast_to(x, (len(a), FAN_OUT, FAN_OUT)).ravel() for x in (ca, cb))
            real = (ca < below) & (cb < below) & (ca < cb if level == 1 else ca <= cb)
            stack.append((level - 1, ca[real], cb[real]))


def join_tile(sets: list[np.ndarray], t: Threshold, labels: np.ndarray | None = None) -> np.ndarray:
    """For each set the first set that it is connected with by links inside the tile (or by equal labels)."""
    forest = Forest(np.arange(len(sets)) if labels is None else labels)
    if len(sets) < 2:
        return forest.roots()
    order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
    for i, j in zip(order[:-1], order[1:], strict=True):   # neighbours by smallest hash are often copies
        if forest.root(i) != forest.root(j) and linked(sets[i], sets[j], t):
            forest.join(i, j)
    if len(sets) == 2:
        return forest.roots()
    tree, place = SignatureTree([sets[i] for i in order]), np.array(order)
    for a, b in tree.pairs(t):
        i, j, roots = place[a], place[b], forest.roots()
        apart = roots[i] != roots[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            if forest.root(x) != forest.root(y) and linked(sets[x], sets[y], t):
                forest.join(x, y)
    return forest.roots()


# --------------------------------------------------------------------------- Spark jobs

PACKED = "bucket int, kind int, a binary, b binary, c binary, doc_ids array<long>"
FLAT = "kind int, a long, b long, n long, doc_id long"


def _packed(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "kind": pa.int32(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary(), "doc_ids": pa.list_(pa.int64())}
    return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()})


def _flat(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None, doc_ids=None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                       none if n is None else pa.array(n, pa.int64()),
                                       none if doc_ids is None else pa.array(doc_ids, pa.int64())],
                                      ["kind", "a", "b", "n", "doc_id"])


def runs_of(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by signature, and for each place in that order its run's start and length."""
    order = np.argsort(sigs, kind="stable")
    ordered = sigs[order]
    start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(sigs) else np.zeros(0, np.int64)
    length = np.diff(np.append(start, len(sigs)))
    return order, np.repeat(start, length), np.repeat(length, length)


def shared(sigs: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Mask with one entry per signature and set, of the signatures that two or more sets have."""
    order = np.lexsort((names, sigs))
    again = np.zeros(len(sigs), bool)
    again[1:] = (sigs[order][1:] == sigs[order][:-1]) & (names[order][1:] == names[order][:-1])
    kept = order[~again]                     # one entry per signature and set
    place, _, length = runs_of(sigs[kept])
    out = np.zeros(len(sigs), bool)
    out[kept[place][length > 1]] = True
    return out


def met_by_id(rows: DataFrame, ids: DataFrame, key: str, how: str, row_bytes: int = ID_BYTES) -> DataFrame:
    """``rows`` joined (inner, left_semi or left_anti) with ``ids`` where doc_id equals ``key``, null equal to null; ``key`` goes.

    A few ids are broadcast. Of more, a filter of bounded size is: the rows that it lets
    through meet the ids by shuffle, all others stay where they are or are dropped there.
    """
    name = unused([*rows.columns, *ids.columns], "_id")
    ids, on, n = ids.withColumnRenamed(key, name), F.col("doc_id").eqNullSafe(F.col(name)), ids.count()
    if n * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(ids), on, how).drop(name)
    passed, others = sift(rows, ids.select(name), n)
    met = passed.join(ids.hint("shuffle_hash"), on, how).drop(name)
    return met.union(others) if how == "left_anti" else met


def sift(rows: DataFrame, ids: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The ``rows`` whose doc_id may be one of the ``n`` ``ids``, and those whose is none.

    An id sets the bit that its hash names, null like any other, among 16 or more for each id up to FILTER_BITS.
    """
    bits = min(FILTER_BITS, 1 << max(15, (16 * n).bit_length()))
    place, bucket, mask, passed = (unused(rows.columns, c) for c in ("_place", "_bucket", "_mask", "_passed"))

    def placed(id_column: str):
        return F.pmod(F.xxhash64(F.col(id_column).cast("long")), F.lit(bits)).alias(place)

    held = (ids.select(placed(ids.columns[0])).groupBy(F.expr(f"bitmap_bucket_number({place})").alias(bucket))
            .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias(mask)))
    at = rows.select("*", placed("doc_id")).withColumn(bucket, F.expr(f"bitmap_bucket_number({place})"))
    byte = f"cast(conv(hex(substring({mask}, cast(bitmap_bit_position({place}) div 8 as int) + 1, 1)), 16, 10) as int)"
    bit = F.expr(f"coalesce(getbit({byte}, cast(bitmap_bit_position({place}) % 8 as int)) = 1, false)")
    sifted = at.join(F.broadcast(held), bucket, "left").withColumn(passed, bit)
    passes = F.col(passed)
    return tuple(sifted.where(x).drop(place, bucket, mask, passed) for x in (passes, ~passes))


def shingle_classes(docs: DataFrame, size: int, t: Threshold) -> DataFrame:
    """Written table FLAT: kind 0 = a document (a, b: set hashes, n: set size), kind 2 = a shared
    signature a of set hash b (n: signatures that the set can spare, doc_id: its own or the next size class)."""
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    per_byte = 0.5 * (t.den - t.num) * 2 / (t.den + t.num)    # upper guess of signatures per byte of text
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * per_byte / SIGNATURES_PER_BUCKET) + 1)

    def sign(batches):
        words = WordHash()
        for batch in batches:
            for n, part in enumerate(batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                ids, names, other, sizes, seen, rows = part["doc_id"].to_pylist(), [], [], [], set(), []
                sigs, owner, owned, spares, kinds = [], [], [], [], []      # an owner is a set in one size class
                for text in part["text"]:
                    x = shingles(text.as_py(), size, words)
                    a, b = set_hashes(x)
                    names.append(a)
                    other.append(b)
                    sizes.append(len(x))
                    if len(x) and (a, b) not in seen:
                        seen.add((a, b))
                        for c, (got, spare) in enumerate(t.signatures(x)):
                            sigs.append(got)
                            owner.append(np.full(len(got), len(owned), np.int64))
                            owned.append(a)
                            spares.append(spare)
                            kinds.append(c)
                where = (n + ids_hash(ids)) % buckets
                if sigs:
                    s, o = np.concatenate(sigs), np.concatenate(owner)
                    own = np.array([owned, spares, kinds], np.int64)
                    order, start, _ = runs_of(s)
                    spill = np.zeros(len(s), bool)
                    spill[order] = np.arange(len(s)) - start > 1      # two are enough to tell its bucket that it is shared
                    if spill.any():
                        rows.append({"bucket": where, "kind": 2, "a": s[spill].tobytes(), "b": own[:, o[spill]].tobytes()})
                    s, o = s[~spill], o[~spill]
                    to = (s % U(buckets)).astype(np.int64)
                    order = np.argsort(to, kind="stable")
                    cuts = np.searchsorted(to[order], np.arange(buckets + 1))
                    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
                        # in the order of owners: one count per owner says whose they are
                        at = order[cuts[bucket]:cuts[bucket + 1]]
                        counts = np.bincount(o[at], minlength=own.shape[1])
                        rows.append({"bucket": bucket, "kind": 1, "a": s[at].tobytes(), "b": counts.astype(np.uint32)[counts > 0].tobytes(),
                                     "c": own[:, counts > 0].tobytes()})
                rows.append({"bucket": where, "kind": 0, "a": np.array(names, np.int64).tobytes(), "b": np.array(other, np.int64).tobytes(),
                             "c": np.array(sizes, np.int64).tobytes(), "doc_ids": ids})
                yield _packed(rows)

    def chain(key, tab):
        out, sigs, owned = [], [], []
        for r in tab.to_pylist():
            if r["kind"] == 0:
                out.append(_flat(0, *(np.frombuffer(r[c], np.int64) for c in "abc"), r["doc_ids"]))
            elif r["kind"] == 2:
                name, spare, c = np.frombuffer(r["b"], np.int64).reshape(3, -1)
                out.append(_flat(2, np.frombuffer(r["a"], np.int64), name, spare, c))
            else:
                sigs.append(np.frombuffer(r["a"], U))
                owned.append(np.repeat(np.frombuffer(r["c"], np.int64).reshape(3, -1), np.frombuffer(r["b"], np.uint32), axis=1))
        if sigs:
            s, (name, spare, c) = np.concatenate(sigs), np.concatenate(owned, axis=1)
            at = shared(s, name)
            out.append(_flat(2, s[at].astype(np.int64), name[at], spare[at], c[at]))
        return pa.Table.from_batches(out)

    packed = docs.select("doc_id", "text").mapInArrow(sign, PACKED)
    return materialize(packed.groupBy("bucket").applyInArrow(chain, FLAT), "shingle-classes")


def ids_hash(ids: list) -> int:
    return xxhash.xxh32_intdigest(repr(ids[:4]))


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100,
                       tile_shingles: int = TILE_SHINGLES, tile_sets: int = TILE_SETS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when ``den * intersection >= num * union`` of their sets of
    ``size``-word shingles; component_id is the smallest doc_id reachable by links.
    Null, empty and white-space texts have no shingles and link with nothing (their
    own doc_id); texts of any length are read whole; repeated rows are linked copies;
    null ids are reachable but never the smallest unless alone; an empty table gives
    no rows; other columns are ignored.
    """
    found = components_of_sets(docs, size, num, den, tile_shingles, tile_sets)
    return found.select("doc_id", "n_shingles", "component_id")


def components_of_sets(docs: DataFrame, size: int, num: int, den: int, tile_shingles: int = TILE_SHINGLES, tile_sets: int = TILE_SETS) -> DataFrame:
    """jaccard_components() with h1, h2 (the set's hashes) and root (one name per component)."""
    t = Threshold(num, den)
    flat = shingle_classes(docs, size, t)
    nodes = flat.where("kind = 0").select("doc_id", F.col("a").alias("h1"), F.col("b").alias("h2"), "n")
    edges = materialize(block_edges(flat), "block-edges")
    classes = materialize(nodes.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")
    blocks = edge_components(edges).select(F.col("id").alias("h1"), F.col("component").alias("block"))
    members = materialize(classes.join(blocks, "h1"), "members")
    release(docs.sparkSession)
    roots = tile_links(docs, members, size, t, tile_shingles, tile_sets)
    smallest = smallest_ids(members, roots)
    named = classes.join(smallest, ["h1", "h2"], "left").select("h1", "h2", F.coalesce("component_id", "rep").alias("component_id"),
                                                                             F.coalesce("root", "h1").alias("root"))
    named = materialize(named, "components")
    return (nodes.join(named, ["h1", "h2"], "left")
            .select("doc_id", "h1", "h2", "root", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")))


def block_edges(flat: DataFrame, rounds: int = 2) -> DataFrame:
    """Edges (src, dst) over shared signatures, between the sets that share more of them than they can spare.

    Counting again among the sets that are left only leaves out more sets that link
    with nothing, so any number of rounds gives the same links.
    """
    held = flat.where("kind = 2").select(F.col("a").alias("sig"), F.col("b").alias("h1"), F.col("doc_id").alias("size_class"), "n").distinct()
    for _ in range(rounds):
        enough = (held.groupBy("h1", "size_class", "n").agg(F.count(F.lit(1)).alias("_c"))
                  .where(F.col("_c") > F.col("n")).select("h1", "size_class"))
        held = materialize(held.join(enough, ["h1", "size_class"]).select("sig", "h1", "size_class", "n"), "shared")
        lowest = materialize(held.groupBy("sig").agg(F.min("h1").alias("src"), F.count(F.lit(1)).alias("_c"))
                             .where("_c > 1").select("sig", "src"), "lowest")
        held = held.join(lowest, "sig")
        edges = held.where("src <> h1").select("src", F.col("h1").alias("dst")).distinct()
        held = held.select("sig", "h1", "size_class", "n")
    return edges


def smallest_ids(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(h1, h2) -> the smallest doc_id of its component, and the component's root."""
    placed = members.join(roots, "h1").select("h1", "h2", "rep", "root")
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    return placed.join(least, "root").select("h1", "h2", "component_id", "root")


def tile_links(docs: DataFrame, members: DataFrame, size: int, t: Threshold, tile_shingles: int, tile_sets: int) -> DataFrame:
    """h1 -> root: one name per component of verified links, over all members of blocks."""
    spark = docs.sparkSession
    spread = members.groupBy("block").agg(F.sum("n").alias("_w"), F.count(F.lit(1)).alias("_m"))
    spread = spread.select("block", F.greatest(F.ceil(F.col("_w") / tile_shingles), F.ceil(F.col("_m") / tile_sets)).alias("tiles"))
    dealt = materialize(members.join(spread, "block").withColumn("tile", F.pmod(F.xxhash64("h1"), F.col("tiles"))), "dealt")
    weight = dealt.agg(F.sum("n").alias("w")).first()["w"] or 0
    if weight == 0:
        return spark.createDataFrame([], "h1 long, root long")
    # a tile and its block's tile 0 make one unit of work: about one unit per group, and the small blocks' weight besides
    units = spread.where("tiles > 1").agg(F.sum("tiles").alias("u")).first()["u"] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), weight // tile_shingles + 1 + units)

    def load(batches):
        words = WordHash()
        for batch in batches:
            rows = []
            for i, text in enumerate(batch["text"]):
                x = shingles(text.as_py(), size, words)
                if set_hashes(x) == (batch["h1"][i].as_py(), batch["h2"][i].as_py()):
                    rows.append((i, x.tobytes()))
            at = pa.array([i for i, _ in rows], pa.int64())
            kept = batch.take(at)
            yield pa.RecordBatch.from_arrays([*(kept[c] for c in ("h1", "block", "tile", "tiles")),
                                              pa.array([x for _, x in rows], pa.binary())], ["h1", "block", "tile", "tiles", "shingles"])

    wanted = dealt.select(F.col("rep"), "h1", "h2", "block", "tile", "tiles")
    sets = (met_by_id(docs.select("doc_id", "text"), wanted, "rep", "inner", SET_BYTES)
            .select("text", "h1", "h2", "block", "tile", "tiles")
            .mapInArrow(load, "h1 long, block long, tile long, tiles long, shingles binary"))

    def join(key, tab):
        by_tile: dict = {}
        has_label = "label" in tab.column_names
        for r in tab.to_pylist():
            by_tile.setdefault((r["block"], r["i"], r["j"]), {})[r["h1"]] = (np.frombuffer(r["shingles"], U), r["label"] if has_label else 0)
        names, roots = [], []
        for found in by_tile.values():
            own = sorted(found)
            got = join_tile([found[h][0] for h in own], t, np.array([found[h][1] for h in own], np.int64) if has_label else None)
            # rows between sets that had one label before say nothing new
            new = [(h, own[i]) for h, i in zip(own, got.tolist(), strict=True) if not has_label or found[h][1] != found[own[i]][1]]
            names += [h for h, _ in new]
            roots += [r for _, r in new]
        return pa.table({"h1": pa.array(names, pa.int64()), "root": pa.array(roots, pa.int64())})

    # every tile together with its block's tile 0
    first = F.when(F.col("tile") == 0, F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).otherwise(F.array("tile"))
    one = sets.withColumn("j", F.explode(first)).withColumn("i", F.lit(0).cast("long"))
    one = one.withColumn("task", F.pmod(F.xxhash64("block", "i", "j"), F.lit(tasks)).cast("int"))
    links = materialize(one.groupBy("task").applyInArrow(join, "h1 long, root long").distinct(), "links")
    split = dealt.where("tiles > 1")
    if not split.take(1):
        return links
    known, size_of = labels_of(links.join(split.select("h1"), "h1", "left_semi"), split), split.select("h1", "n")
    left = materialize(known.where("tile > 0").select("h1"), "not-met")   # tile 0 has met its whole block
    held, slots = None, FIRST_SLOTS
    while True:
        others = materialize(sets_apart(known.join(left, "h1").join(size_of, "h1"), tile_shingles, tile_sets), "sets-apart")
        if not others.where("slots > 0").take(1):
            break
        if held is None:
            held = materialize(sets.where("tiles > 1").select("h1", "block", "shingles"), "split-sets")
        pairs = held.join(slot_pairs(others, slots), ["h1", "block"])
        more = materialize(pairs.groupBy("block", "i", "j").applyInArrow(join, "h1 long, root long").distinct(), "more-links")
        known = labels_of(more.unionByName(known.where("h1 <> label").select("h1", F.col("label").alias("root"))), split)
        left = materialize(others.where(f"slot is null or slot >= {slots}").select("h1"), "not-met")
        slots *= 2
    rest = links.join(split.select("h1"), "h1", "left_anti")
    return rest.unionByName(known.select("h1", F.col("label").alias("root")))


def sets_apart(open_sets: DataFrame, tile_shingles: int, tile_sets: int) -> DataFrame:
    """The sets (h1, block, tile, label, n) that have not met their whole block, with ``slot`` and ``slots``.

    Of two such sets with different labels one at least is outside its block's most
    common label. Only those sets are dealt into slots, each the size of a tile, and have to
    meet the others; the rest have slot null. ``slots`` is the number of slots of the block.
    """
    sizes = open_sets.groupBy("block", "label").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_w"))
    blocks = sizes.groupBy("block").agg(F.sum("_m").alias("_am"), F.sum("_w").alias("_aw"),
                                        F.max(F.struct("_m", "label", "_w")).alias("_top"))
    m, w = F.col("_am") - F.col("_top._m"), F.col("_aw") - F.col("_top._w")
    blocks = blocks.select("block", F.col("_top.label").alias("_most"), F.greatest(F.ceil(w / tile_shingles), F.ceil(m / tile_sets)).alias("slots"))
    slot = F.when(F.col("label") != F.col("_most"), F.pmod(F.xxhash64("h1", F.lit(1)), F.col("slots")))
    return open_sets.join(blocks, "block").select("h1", "block", "tile", "label", slot.alias("slot"), "slots")


def slot_pairs(others: DataFrame, most: int) -> DataFrame:
    """h1, block, label, i, j: the first ``most`` slots (i) of each block with each of its tiles (j)."""
    others = others.where("slots > 0")
    tiles = others.groupBy("block").agg(F.collect_set("tile").alias("_tiles"))
    used = F.least(F.col("slots"), F.lit(most).cast("long"))
    mine = others.where(f"slot < {most}").join(tiles, "block").select("h1", "block", "label", F.col("slot").alias("i"), F.explode("_tiles").alias("j"))
    theirs = others.select("h1", "block", "label", F.explode(F.sequence(F.lit(0).cast("long"), used - 1)).alias("i"), F.col("tile").alias("j"))
    return mine.unionByName(theirs).distinct()


def labels_of(links: DataFrame, split: DataFrame) -> DataFrame:
    """block, tile, h1, label: components of ``links`` between sets of split blocks."""
    found = edge_components(links.select(F.col("h1").alias("src"), F.col("root").alias("dst")))
    out = materialize(split.select("block", "tile", "h1").join(found.select(F.col("id").alias("h1"), F.col("component").alias("label")), "h1", "left")
                      .withColumn("label", F.coalesce("label", "h1")), "labels")
    release(split.sparkSession)
    return out


def with_set_hashes(docs: DataFrame, size: int, names: tuple[str, str]) -> DataFrame:
    """``docs`` with the two hashes of each text's shingle set; null where it has no words."""
    def run(batches):
        words = WordHash()
        for batch in batches:
            sets = [shingles(t.as_py(), size, words) for t in batch["text"]]
            found = [set_hashes(x) if len(x) else (None, None) for x in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], [*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return docs.mapInArrow(run, schema)


def keep_one_per_group(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: one of its smallest doc_id. All columns pass through.

    Where several rows have one id, each is judged by its own text: a row goes only if its
    component has another row that stays. Rows without words, and rows with a null id, are in
    no group; of rows without words that have one id and one text, one stays.
    """
    found = materialize(components_of_sets(docs, size, num, den), "groups")
    release(docs.sparkSession)
    marks = (found.where("doc_id is not null").groupBy("doc_id")
             .agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone or rows > 1"))
    marks = materialize(marks, "marked-ids")
    again = marks.where("rows > 1").select("doc_id")
    single = met_by_id(docs, marks.select("doc_id"), "doc_id", "left_anti")
    if not again.take(1):
        return single
    # one set per component of the rows that share their id: the least of those that have the component's smallest id
    first = (met_by_id(found, again, "doc_id", "left_semi").where("n_shingles > 0 and doc_id = component_id")
             .groupBy("doc_id", "root").agg(F.min(F.struct("h1", "h2")).alias("_s")))
    a, b = unused(docs.columns, "_set1"), unused(docs.columns, "_set2")
    first = first.select("doc_id", F.col("_s.h1").alias(a), F.col("_s.h2").alias(b))
    shared = with_set_hashes(met_by_id(docs, again, "doc_id", "left_semi"), size, (a, b))
    chosen = shared.where(F.col(a).isNotNull()).join(first, ["doc_id", a, b], "left_semi").dropDuplicates(["doc_id", a, b])
    bare = shared.where(F.col(a).isNull()).dropDuplicates(["doc_id", "text"])
    return single.unionByName(chosen.unionByName(bare).select(*docs.columns))
