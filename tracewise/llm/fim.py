"""Fill-in-middle transformation by in-place block rotation.

A text is cut twice at unit borders (a run of ASCII letters or any other code point is a
unit) into prefix, middle and suffix. The sentinels are inserted into a bytearray that
holds the text, and neighbouring blocks change places by three reversals, so no second
copy of the text is built. Inverting the rotation and taking the sentinels out again
gives back the exact text: it holds no sentinel itself, and none can arise across a
border, because a sentinel's first byte occurs in it once and at its start.

Cuts and form depend on the seed and the doc_id alone; texts never move between tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "1"
PLAIN_FROM = 90        # of 100: texts drawn at or above stay plain
SPM_BELOW = 20         # of 100: transformed texts drawn below put the suffix first
BLOCK = 1 << 16        # bytes that a reversal exchanges at a time


def reverse(view: np.ndarray, start: int, end: int) -> None:
    """Reverse view[start:end] in place; at most two blocks are copied at a time."""
    while end - start > 1:
        width = min(BLOCK, (end - start) // 2)
        head = view[start:start + width][::-1].copy()
        view[start:start + width] = view[end - width:end][::-1].copy()
        view[end - width:end] = head
        start, end = start + width, end - width


def rotate(buffer: bytearray, start: int, border: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, border) and [border, end) by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, start, border)
    reverse(view, border, end)
    reverse(view, start, end)


def unit_starts(raw: bytes) -> np.ndarray:
    """Byte offsets at which units begin: code points that are no letter, and first letters of a run."""
    codes = np.frombuffer(raw, np.uint8)
    low = codes | 32
    letter = (low >= 97) & (low <= 122)
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] = False
    return np.flatnonzero(((codes & 0xC0) != 0x80) & ~inside)


def code_points(raw: bytes) -> int:
    return int(((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80).sum())


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The four numbers that decide cuts, plainness and form; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transform_text(raw: bytes, doc_id: int | None, seed: str = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, prefix code points, middle code points, output) of one UTF-8 text."""
    starts = unit_starts(raw)
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, raw
    borders = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut, end = (int(starts[b]) if b < n else len(raw) for b in borders)
    buffer = bytearray(raw)
    for at, sentinel in ((end, SUFFIX), (cut, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel                      # <P>prefix<M>middle<S>suffix
    suffix_at = end + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    rotate(buffer, 0 if form == "spm" else cut + len(PREFIX), suffix_at, len(buffer))
    return n, form, code_points(raw[:cut]), code_points(raw[cut:end]), bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The exact text again: the rotation is inverted, then the sentinels are taken out."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    suffix_at = buffer.find(SUFFIX)
    after = buffer.find(PREFIX if form == "spm" else MIDDLE, suffix_at)
    rotate(buffer, suffix_at, after, len(buffer))     # <P>prefix<M>middle<S>suffix
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.find(sentinel)
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def transform(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output per row of ``docs``.

    A null text is empty; an empty text, and one that holds a sentinel, stays plain with
    null lengths; texts of any length are cut as wholes; repeated rows give the same
    result each; a null doc_id draws like an id without digits; an empty table gives
    no rows; other columns are ignored.
    """
    def run(batches):
        for batch in batches:
            rows = [transform_text(t, i, seed) for i, t in zip(batch["doc_id"].to_pylist(), batch["raw"].to_pylist(), strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    made = docs.select("doc_id", text_or_empty().cast("binary").alias("raw")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restore(transformed: DataFrame) -> DataFrame:
    """The rows of transform() with ``restored``, rebuilt from ``output`` and ``form`` alone; a null output or form gives null."""
    kept = transformed.drop("restored")
    schema = kept.withColumn("restored", F.lit(b"").cast("binary")).withColumn("output", F.col("output").cast("binary")).schema

    def run(batches):
        for batch in batches:
            texts = [None if o is None or f is None else restore_text(o, f) for o, f in zip(batch["output"].to_pylist(), batch["form"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "restored"])

    made = kept.withColumn("output", F.col("output").cast("binary")).mapInArrow(run, schema)
    return made.withColumn("output", F.col("output").cast("string")).withColumn("restored", F.col("restored").cast("string"))
