"""Document fingerprints by a randomised edit embedding.

A text is walked by a shared random walk: at step ``s`` the walk stands on one
character, writes its class, and moves on if the shared random bit of (class, step)
is one. Two texts that differ by a few edits fall back into step, so the edit
distance shows as Hamming distance between what they wrote (Chakraborty, Goldenberg
and Koucky 2016). A fingerprint samples what was written at shared pseudo-random
steps; the steps of a coarser level are a subset of those of a finer one, and a text
uses the level that leaves it about ``SAMPLES`` steps, so texts of like length are
compared step by step. Candidates meet in bands of sampled steps and are verified.

All characters of a text are walked. Texts of similar length are walked together,
one array step per character place.
"""

from __future__ import annotations

import functools
import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.operators.graph import connected_components
from tracewise.session import ensure_checkpoint_dir

SEED = 19
CLASSES = 256
PERIOD = 4096              # the shared bits repeat after this many steps
SAMPLES = 128              # at most about this many steps are sampled
CHUNK_CHARS = 8_000_000    # characters walked at a time in one task
TOGETHER = 40              # fewer texts of like length are walked one by one


@functools.lru_cache(maxsize=1)
def stays() -> np.ndarray:
    """Steps that the walk spends on a class when it arrives at a step (flat: class * PERIOD + step)."""
    bits = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD), dtype=np.int8)
    bits[:, -1] = 1
    out = np.ones((CLASSES, PERIOD), np.int32)
    for s in range(PERIOD - 2, -1, -1):
        out[:, s] = np.where(bits[:, s] == 1, 1, out[:, s + 1] + 1)
    return out.ravel()


def classes(text: str) -> np.ndarray:
    """Class of each code point, shifted to index stays()."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int32) * PERIOD


def walk(codes: list[np.ndarray], begin: list[int]) -> list[np.ndarray]:
    """For each text the step at which the walk leaves each character, starting at step ``begin``."""
    table, out = stays(), [np.zeros(0, np.int32)] * len(codes)
    quick = table.tolist()
    order = sorted((i for i in range(len(codes)) if len(codes[i])), key=lambda i: -len(codes[i]))
    at = 0
    while at < len(order):
        longest, to = len(codes[order[at]]), at
        while to < len(order) and 4 * len(codes[order[to]]) >= 3 * longest - 256 and (to - at) * longest < 4_000_000:
            to += 1
        group = order[at:to]
        at = to
        if len(group) < TOGETHER:
            for i in group:
                steps = accumulate(codes[i].tolist(), lambda s, c: s + quick[c + (s & (PERIOD - 1))], initial=begin[i])
                out[i] = np.fromiter(steps, np.int32, len(codes[i]) + 1)[1:]
            continue
        grid = np.zeros((len(group), longest), np.int32)
        for row, i in zip(grid, group, strict=True):
            row[:len(codes[i])] = codes[i]
        places = np.ascontiguousarray(grid.T)
        s = np.array([begin[i] for i in group], np.int32)
        for place in places:
            s = s + table.take(place + (s & (PERIOD - 1)))
            place[:] = s
        left = np.ascontiguousarray(places.T)
        for row, i in zip(left, group, strict=True):
            out[i] = row[:len(codes[i])].copy()
    return out


@functools.lru_cache(maxsize=64)
def _sampled(level: int, limit: int) -> np.ndarray:
    s = np.arange(limit, dtype=np.uint64)
    mixed = (s + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.flatnonzero(mixed & np.uint64((1 << level) - 1) == 0)


def sampled(level: int, steps: int) -> np.ndarray:
    """The shared steps of a level below ``steps``; level n + 1 keeps about half of level n."""
    limit = 1 << max(10, steps.bit_length())
    found = _sampled(level, limit)
    return found[:np.searchsorted(found, steps)]


def level_of(steps: int) -> int:
    return max(0, (max(steps, 1) - 1) // SAMPLES).bit_length()


def fingerprint(codes: np.ndarray, left: np.ndarray) -> str:
    """``steps in hex`` ``:`` sampled classes in hex; an empty text gives ``0:``."""
    steps = int(left[-1]) if len(left) else 0
    at = np.searchsorted(left, sampled(level_of(steps), steps), "right")
    return f"{steps:x}:" + (codes[at] // PERIOD).astype(np.uint8).tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal samples, over the longer text's steps at the coarser level; 1 for two empty texts."""
    (sa, xa), (sb, xb) = ((int(f.split(":")[0], 16), np.frombuffer(bytes.fromhex(f.split(":")[1]), np.uint8)) for f in (a, b))
    level = level_of(max(sa, sb))
    xa, xb = (x[np.isin(sampled(level_of(s), s), sampled(level, s), assume_unique=True)] if level_of(s) != level else x
              for s, x in ((sa, xa), (sb, xb)))
    n = max(len(xa), len(xb))
    if n == 0:
        return float(sa == sb and a == b)
    m = min(len(xa), len(xb))
    return float(np.count_nonzero(xa[:m] == xb[:m])) / n


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text (null: empty). Equal texts have equal fingerprints."""
    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                codes = [classes(t or "") for t in part["text"].to_pylist()]
                left = walk(codes, [0] * len(codes))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(map(fingerprint, codes, left), pa.string())],
                                                 ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


BANDS = 36
RUNGS = ((1, 3), (10, 6), (48, 10))    # (samples from which a rung holds, samples in one band)
LIKE = 0.8
TILE = 1024                            # at most about this many texts meet as many others in one group


@functools.lru_cache(maxsize=4096)
def _places(n: int, size: int) -> np.ndarray:
    """For each band the first ``size`` of ``n`` places in that band's shared random order, ascending.

    Two texts take the same places unless a place that only the longer one has comes
    first, so a band agrees about as often as ``size`` places drawn from the longer text.
    """
    order = [np.argsort(np.random.default_rng([SEED, b]).random(8 * SAMPLES)[:n], kind="stable") for b in range(BANDS)]
    return np.sort(np.stack(order)[:, :size], axis=1)


def parse(print_: str) -> tuple[int, np.ndarray]:
    head, body = print_.split(":")
    return int(head, 16), np.frombuffer(bytes.fromhex(body), np.uint8)


def at_level(steps: int, x: np.ndarray, level: int) -> np.ndarray:
    """The samples of a text at its own or a coarser level."""
    own = level_of(steps)
    return x if own == level else x[np.isin(sampled(own, steps), sampled(level, steps), assume_unique=True)]


def bands_of(print_: str, like: float = LIKE) -> list[int]:
    """64-bit band keys of every level and rung at which a text as like as ``like`` could meet this one."""
    steps, x = parse(print_)
    out, level = [], level_of(steps)
    levels = [level]
    if len(sampled(level + 1, steps)) >= like * len(sampled(level + 1, SAMPLES << level)):
        levels.append(level + 1)
    for lv in levels:
        y = at_level(steps, x, lv)
        for k, (start, size) in enumerate(RUNGS):
            end = RUNGS[k + 1][0] / like if k + 1 < len(RUNGS) else float("inf")
            if start <= len(y) < end:
                for b, places in enumerate(_places(len(y), size)):
                    key = hashlib.blake2b(y[places].tobytes(), digest_size=8, key=b"%d:%d:%d" % (lv, k, b)).digest()
                    out.append(int.from_bytes(key, "little", signed=True))
    return out


def linked(left: list[str], right: list[str], like: float = LIKE) -> list[tuple[int, int]]:
    """Places (i, j) of texts with likeness of at least ``like``, enough of them to join all that are linked.

    Every pair is compared; a pair is left out only if earlier ones already connect it.
    """
    a, b = ([(level_of(s), s, x) for s, x in map(parse, side)] for side in (left, right))
    up = list(range(len(a) + len(b)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for la in sorted({t[0] for t in a}):
        for lb in sorted({t[0] for t in b}):
            level = max(la, lb)
            at_b = [j for j, t in enumerate(b) if t[0] == lb]
            ys = [at_level(b[j][1], b[j][2], level) for j in at_b]
            size = np.array([len(y) for y in ys])
            grid = np.full((len(ys), max(1, size.max())), -1, np.int16)
            for row, y in zip(grid, ys, strict=True):
                row[:len(y)] = y
            for i in (i for i, t in enumerate(a) if t[0] == la):
                x = at_level(a[i][1], a[i][2], level)
                m = min(len(x), grid.shape[1])
                equal = np.count_nonzero(grid[:, :m] == x[:m], axis=1)
                longer = np.maximum(size, len(x))
                for k in np.flatnonzero((equal >= like * longer - 1e-9) & (longer > 0)):
                    p, q = root(i), root(len(a) + at_b[k])
                    if p != q:
                        up[p] = q
                        out.append((i, at_b[k]))
    return out


def _verified(pairs: DataFrame, like: float) -> DataFrame:
    """The pairs (cid, other) whose two fingerprints are like enough."""
    def run(batches):
        for batch in batches:
            f, g = batch["fingerprint"].to_pylist(), batch["other_print"].to_pylist()
            keep = pa.array([likeness(x, y) >= like - 1e-9 for x, y in zip(f, g, strict=True)], pa.bool_())
            yield batch.filter(keep).select(["cid", "other"])

    return pairs.select("cid", "other", "fingerprint", "other_print").mapInArrow(run, "cid string, other string")


def near_links(classes_: DataFrame, like: float = LIKE) -> DataFrame:
    """Links (cid, other) that join all texts found to be like enough; ``classes_`` is text_classes().

    Bands of sampled places make candidates. First each text meets the smallest text
    of each of its bands, which a map-side minimum finds however many share the band.
    Texts unlike that one then meet every text of the band in tiles, one tile pair per
    group, so no band is cut and none is held by one task. A link at exactly ``like``
    is found with a chance of about 0.97, from 0.85 of nearly 1.
    """
    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                keys = [bands_of(f, like) for f in part["fingerprint"].to_pylist()]
                cids = np.repeat(np.arange(part.num_rows), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array([k for ks in keys for k in ks], pa.int64()),
                                                  part["cid"].take(pa.array(cids, pa.int64()))], ["band", "cid"])

    banded = classes_.select("cid", "fingerprint").mapInArrow(run, "band long, cid string")
    shared = (banded.groupBy("band").agg(F.min("cid").alias("other"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").checkpoint())
    met = banded.join(shared, "band").where("cid <> other").checkpoint()
    prints = classes_.select("cid", "fingerprint")
    others = prints.select(F.col("cid").alias("other"), F.col("fingerprint").alias("other_print"))
    stars = _verified(met.select("cid", "other").distinct().join(prints, "cid").join(others, "other"), like).checkpoint()
    apart = met.join(stars, ["cid", "other"], "left_anti").select("band", "cid", "n").checkpoint()
    sizes = apart.groupBy("band").agg(F.count(F.lit(1)).alias("n_apart"), F.max("n").alias("n"))
    sizes = sizes.select("band", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"),
                         F.ceil(F.col("n_apart") / TILE).cast("int").alias("lots")).checkpoint()

    def part_of(count):
        return F.pmod(F.xxhash64("cid"), F.col(count)).cast("int")

    def every(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    # the smallest text of a band was compared with all others already, so `met` lacks only rows that are done
    lots = (apart.select("band", "cid").join(sizes, "band").withColumn("lot", part_of("lots"))
            .withColumn("tile", every("tiles")).join(prints, "cid").select("band", "tile", "lot", "cid", "fingerprint"))
    tiles = (met.select("band", "cid").join(sizes, "band").withColumn("tile", part_of("tiles"))
             .withColumn("lot", every("lots")).join(prints, "cid").select(
                 F.col("band").alias("to_band"), F.col("tile").alias("to_tile"), F.col("lot").alias("to_lot"),
                 F.col("cid").alias("other"), F.col("fingerprint").alias("other_print")))

    def meet(left, right):
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({"cid": pa.array([], pa.string()), "other": pa.array([], pa.string())})
        a, b = left["cid"].to_pylist(), right["other"].to_pylist()
        found = [(a[i], b[j]) for i, j in linked(left["fingerprint"].to_pylist(), right["other_print"].to_pylist(), like)
                 if a[i] != b[j]]
        return pa.table({"cid": pa.array([f[0] for f in found], pa.string()), "other": pa.array([f[1] for f in found], pa.string())})

    rest = lots.groupBy("band", "tile", "lot").cogroup(tiles.groupBy("to_band", "to_tile", "to_lot")).applyInArrow(meet, "cid string, other string")
    return stars.unionByName(rest).distinct()


def text_classes(prints: DataFrame) -> DataFrame:
    """cid (md5 of the fingerprint), fingerprint, first_id (smallest doc_id), n_copies: one row per fingerprint."""
    return (prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
            .withColumn("cid", F.md5("fingerprint")))


def link_documents(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """doc_id, n_copies, n_links, component_id for every row of ``docs``.

    n_copies counts the rows with this row's fingerprint, itself included; n_links
    the verified links kept for it (enough to connect its component, not all pairs);
    component_id is the smallest doc_id that links reach. Null and empty texts
    are one class with no links to others. Equal rows give equal rows; rows of one
    id are judged by their texts; a component of null ids only has a null id. An
    empty table gives no rows; other columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    prints = fingerprints(docs).checkpoint()
    classes_ = text_classes(prints).checkpoint()
    links = near_links(classes_, like).checkpoint()
    parts = connected_components(classes_.select(F.col("cid").alias("id")), links.select(F.col("cid").alias("src"),
                                                                                          F.col("other").alias("dst")))
    ends = links.select("cid").unionByName(links.select(F.col("other").alias("cid"))).groupBy("cid").agg(
        F.count(F.lit(1)).alias("n_links"))
    named = classes_.join(parts.withColumnRenamed("id", "cid"), "cid").join(ends, "cid", "left").checkpoint()
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id")).checkpoint()
    named = named.join(firsts, "component").select(
        "fingerprint", "n_copies", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "n_copies", "n_links", "component_id")


def with_next(docs: DataFrame, block_rows: int = 512, most_blocks: int = 20_000) -> DataFrame:
    """Rows in doc_id order, dealt into blocks that end with the first row of the next block.

    Columns: block, border (that extra row), doc_id, text. The last block ends with
    the first row of all. Block edges are approximate percentiles of the ids, so
    the driver holds ``most_blocks`` numbers at most; null ids come first.
    """
    spark = docs.sparkSession
    total = docs.count()
    if total == 0:
        return docs.select(F.lit(0).alias("block"), F.lit(False).alias("border"), "doc_id", "text").limit(0)
    n = min(most_blocks, -(-total // block_rows))
    edges = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20 * n)).first()[0] or []
    edges = sorted({float(e) for e in edges}) if n > 1 else []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    if edges:
        rows = rows.withColumn("_id", F.col("doc_id").cast("double"))
        cut = Bucketizer(splits=[-float("inf"), *edges, float("inf")], inputCol="_id", outputCol="_block", handleInvalid="keep")
        rows = cut.transform(rows.na.fill(-1.7e308, ["_id"])).withColumn("block", F.col("_block").cast("int")).drop("_id", "_block")
    else:
        rows = rows.withColumn("block", F.lit(0))
    firsts = sorted((r["block"], r["first"]["doc_id"], r["first"]["_tie"]) for r in rows.groupBy("block").agg(
        F.min(F.struct("doc_id", "_tie")).alias("first")).collect())
    border = spark.createDataFrame(
        [(firsts[i][0], firsts[i][2], firsts[i - 1][0]) for i in range(len(firsts))],
        "block int, _tie long, _before int")
    joined = rows.join(F.broadcast(border), ["block", "_tie"], "left")
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("border"))
    extra = F.struct(F.col("_before").alias("block"), F.lit(True).alias("border"))
    both = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, extra))
    spread = joined.select(F.explode(both).alias("_at"), "doc_id", "text", "_tie")
    return (spread.select("_at.block", "_at.border", "doc_id", "text", "_tie")
            .repartition(F.col("block")).sortWithinPartitions("block", "border", "doc_id", "_tie").drop("_tie"))


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) of the next text's first."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_with_edits(docs: DataFrame, **blocks: int) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document.

    The next document is that of the following doc_id (after the last: the first;
    null ids come first; equal ids in the order of a text hash). A null text is
    empty; a text under four code points is its own edited text; two empty texts
    have likeness 1; a single document is its own next; an empty table gives no
    rows; other columns are ignored.
    """
    def compare(rows):
        """Results for all rows that have their next row here; rows: (block, border, doc_id, text)."""
        codes = [classes(r[3]) for r in rows]
        left = walk(codes, [0] * len(rows))
        prints = list(map(fingerprint, codes, left))
        have = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
        quarters = {i: len(codes[i]) // 4 for i in have}
        tails = [codes[i + 1][:quarters[i]] for i in have]
        cuts = [len(codes[i]) - quarters[i] for i in have]
        moved = walk(tails, [int(left[i][c - 1]) if c else 0 for i, c in zip(have, cuts, strict=True)])
        out = []
        for i, tail, cut, steps in zip(have, tails, cuts, moved, strict=True):
            edited = edited_text(rows[i][3], rows[i + 1][3])
            print_ = fingerprint(np.concatenate([codes[i][:cut], tail]), np.concatenate([left[i][:cut], steps])) if quarters[i] else prints[i]
            out.append((rows[i][2], len(codes[i]), hashlib.sha256(edited.encode("utf-8")).hexdigest(), prints[i], print_,
                        likeness(prints[i], print_), likeness(prints[i], prints[i + 1])))
        return out

    kinds = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
             ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]

    def as_batch(out):
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    def run(batches):
        held, chars = [], 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("block", "border", "doc_id", "text")), strict=True):
                if row[1] and held and held[-1][1] and held[-1][0] == row[0]:
                    continue                       # copies of the border row: one is enough
                held.append(row)
                chars += len(row[3])
                if chars >= CHUNK_CHARS:
                    yield as_batch(compare(held))
                    held, chars = held[-1:], len(held[-1][3])
        if held:
            yield as_batch(compare(held))

    return with_next(docs, **blocks).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                     "edited_fingerprint string, near_edited double, near_next double")
