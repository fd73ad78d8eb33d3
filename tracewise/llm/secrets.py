"""Secret scans with multipart credential linking.

One pass over each text finds two kinds of things: sure finds (assignments, access
identifiers, hex runs), which are always reported, and weak parts (endpoints, mixed
random-looking runs, account names), which mean nothing alone. Weak parts are
joined by interval with the complementary parts around them, and only those that
meet their complement within a scope (so many characters) are reported:

* ``endpoint``: a URL, host:port or IPv4 address near a sure find or a reported weak secret;
* ``weak_secret``: a mixed-case run with digits (base64, base64url) near an access identifier or
  a user name, or within a line or two (ENDPOINT_SCOPE) of an endpoint;
* ``user``: a user or account assignment near a sure find or a weak secret.

The interval join runs on the sorted spans of a whole batch of texts, laid end to
end with gaps wider than the scope, so no span meets one of another document and
the work is n log n in the spans, however many a document holds. Texts never move.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["assign", "access", "hex", "weak_secret", "endpoint", "user"]
SCOPE = 300
ENDPOINT_SCOPE = 120       # endpoints are common: they complement a weak secret only this close
SPANS = "array<struct<kind:string,start:int,end:int>>"
MARK = "[SECRET]"


@functools.lru_cache(maxsize=1)
def patterns() -> list[tuple[str, re.Pattern]]:
    ascii_any_case = re.ASCII | re.IGNORECASE
    return [
        # the group is checked for its 12 characters afterwards: a failing match still uses up its text
        ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ascii_any_case)),
        ("access", re.compile(r"AKIA[A-Z0-9]{14,}")),
        ("hex", re.compile(r"[0-9a-f]{16,}")),
        ("weak_secret", re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/=_-])")),
        ("endpoint", re.compile(r"https?://[^\s\"'<>]+|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])(?::\d{2,5})?", re.ASCII)),
        ("user", re.compile(r"""(?:user(?:name)?|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{2,64}""", ascii_any_case)),
    ]


def mixed(run: str) -> bool:
    """Upper case, lower case and digits all occur, in pieces too long for hyphenated words: a weak sign of a secret."""
    pieces = run.replace("_", "-").split("-")
    return len(run) >= 8 * len(pieces) and any(c.isupper() for c in run) and any(c.islower() for c in run) and any(c.isdigit() for c in run)


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every sure and weak part, in code points."""
    found = []
    for n, (kind, pattern) in enumerate(patterns()):
        for m in pattern.finditer(text):
            if kind == "assign" and m.end(1) - m.start(1) < 12 or kind == "weak_secret" and not mixed(m.group()):
                continue
            found.append((n, m.start(), m.end()))
    return found


def near(starts: np.ndarray, ends: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray, scope: int) -> np.ndarray:
    """Interval join: does [start, end) have one of the other intervals at most ``scope`` away, not overlapping it?"""
    if not len(starts) or not len(other_starts):
        return np.zeros(len(starts), bool)
    by_end, by_start = np.sort(other_ends), np.sort(other_starts)
    before = np.searchsorted(by_end, starts, "right") - 1
    after = np.searchsorted(by_start, ends, "left")
    return (((before >= 0) & (starts - by_end[np.maximum(before, 0)] <= scope))
            | ((after < len(by_start)) & (by_start[np.minimum(after, len(by_start) - 1)] - ends <= scope)))


def overlaps(starts: np.ndarray, ends: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    if not len(starts) or not len(other_starts):
        return np.zeros(len(starts), bool)
    order = np.argsort(other_starts, kind="stable")
    reach = np.maximum.accumulate(other_ends[order])
    at = np.searchsorted(other_starts[order], ends, "left") - 1
    return (at >= 0) & (reach[np.maximum(at, 0)] > starts)


def link(kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray, scope: int = SCOPE) -> np.ndarray:
    """Mask of the parts to report; coordinates of all texts lie on one line."""
    sure = kinds <= 2
    keep = sure.copy()
    covered = overlaps(starts, ends, starts[sure], ends[sure])
    free = {n: (kinds == n) & ~covered for n in (3, 4, 5)}

    def joined(what, others, scope=scope):
        out = np.zeros(len(kinds), bool)
        out[what] = near(starts[what], ends[what], starts[others], ends[others], scope)
        return out

    keep |= (weak := joined(free[3], (kinds == 1) | free[5]) | joined(free[3], free[4], min(scope, ENDPOINT_SCOPE)))
    anchors = sure | weak
    keep |= joined(free[4], anchors) | joined(free[5], anchors)
    return keep


def scan_batch(texts: list[str], scope: int = SCOPE) -> list[list[tuple[int, int, int]]]:
    """Reported spans of each text, by start and then kind."""
    parts, base, at = [], [], 0
    for n, t in enumerate(texts):
        parts += [(k, a, b, n) for k, a, b in parts_of(t)]
        base.append(at)
        at += len(t) + scope + 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if parts:
        kinds, starts, ends, doc = np.array(parts, np.int64).T
        shift = np.array(base, np.int64)[doc]
        for i in np.flatnonzero(link(kinds, starts + shift, ends + shift, scope)):
            out[doc[i]].append((int(kinds[i]), int(starts[i]), int(ends[i])))
    for spans in out:
        spans.sort(key=lambda s: (s[1], s[0]))
    return out


def _scan(batches, scope: int, mark: str | None, column: str):
    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            texts = part["text"].to_pylist()
            found = scan_batch([t or "" for t in texts], scope)
            spans = pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s] for s in found],
                             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))
            cols = {c: part[c] for c in part.schema.names if c != column}
            if mark is not None:
                cols["text"] = pa.array([t if t is None or not s else redact(t, s, mark) for t, s in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(cols | {column: spans})


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = MARK) -> str:
    """Every reported span replaced by ``mark``; overlapping spans become one mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, scope: int = SCOPE, mark: str | None = None, column: str = "spans") -> DataFrame:
    """``docs`` with ``column`` (kind, start, end by start, then kind); with ``mark`` the spans are cut from ``text``.

    A null text has no spans and stays null; an empty text has none; whole texts of
    any length are read; repeated rows give the same result each; a column named like
    ``column`` is replaced, other columns pass through; an empty table gives no rows.
    """
    kept = docs.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T._parse_datatype_string(SPANS))])
    return kept.mapInArrow(lambda batches: _scan(batches, scope, mark, column), schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) of scan()."""
    def shown(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = scan(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(KINDS[:3]))
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(F.array_join(F.transform(base, shown), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", shown), ",").alias("spans"))
