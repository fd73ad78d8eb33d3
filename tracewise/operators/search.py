"""Model search (M4): a tree-structured Parzen sampler, and candidates evaluated side by side as Spark jobs.

A space names detectors and the numbers that each of them takes. After some random
draws the history is split into its best quarter and the rest; a candidate is drawn
from a Parzen density around the good values, the one with the highest ratio of good
to bad density of several draws (Bergstra et al. 2011). Detectors are drawn by the ratio of
smoothed counts, and a detector's numbers only look at that detector's history.

Candidates are evaluated in rounds of ``parallel``: each on its own thread and in its
own scheduler pool, so that their jobs share the cluster. The next round starts when
all have finished, which makes a seeded search the same on any cluster. The history
is one row per evaluation.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

GOOD_SHARE = 0.25
DRAWS = 24
HISTORY = "model_id string, round int, detector string, params string, artefact string, loss double, status string"


@dataclass(frozen=True)
class Number:
    """A parameter between two bounds, on a linear or logarithmic scale, whole or not."""

    low: float
    high: float
    log: bool = False
    whole: bool = True

    def at(self, unit: float) -> float:
        lo, hi = (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)
        value = lo + min(max(unit, 0.0), 1.0) * (hi - lo)
        value = math.exp(value) if self.log else value
        return int(min(max(round(value), self.low), self.high)) if self.whole else float(value)

    def unit(self, value: float) -> float:
        lo, hi, v = (math.log(self.low), math.log(self.high), math.log(value)) if self.log else (self.low, self.high, value)
        return (v - lo) / (hi - lo) if hi > lo else 0.0


Space = dict[str, dict[str, Number]]
#: What the user detectors can be tuned by.
DETECTORS: Space = {"knn": {"k": Number(1, 32, log=True)}, "ecod": {}, "inne": {"psi": Number(4, 64, log=True)},
                    "iforest": {"psi": Number(16, 512, log=True)}}


def _density(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Parzen mixture on [0, 1]: a kernel per centre, as wide as its gap to the next ones, and a uniform part."""
    if not len(centres):
        return np.ones(len(x))
    c = np.sort(centres)
    gaps = np.diff(np.concatenate([[0.0], c, [1.0]]))
    width = np.clip(np.maximum(gaps[:-1], gaps[1:]), 0.02, 1.0)
    kernels = np.exp(-0.5 * ((x[:, None] - c) / width) ** 2) / (width * math.sqrt(2 * math.pi))
    return (kernels.sum(1) + 1.0) / (len(c) + 1)


def _draw(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray) -> float:
    c = np.sort(good)
    gaps = np.diff(np.concatenate([[0.0], c, [1.0]]))
    pick = rng.integers(0, len(c) + 1, DRAWS)                       # the last one: uniform
    centre = np.append(c, 0.0)[pick]
    width = np.append(np.clip(np.maximum(gaps[:-1], gaps[1:]), 0.02, 1.0), 0.0)[pick]
    x = np.where(pick == len(c), rng.random(DRAWS), np.clip(centre + width * rng.standard_normal(DRAWS), 0.0, 1.0))
    return float(x[np.argmax(_density(x, good) / _density(x, bad))])


def suggest(space: Space, history: list[dict], rng: np.random.Generator, startup: int) -> tuple[str, dict]:
    """The next (detector, parameters); ``history`` rows have detector, params (a dict) and loss (None: failed)."""
    names = sorted(space)
    done = sorted((h for h in history if h["loss"] is not None), key=lambda h: h["loss"])
    if len(history) < startup or not done:
        detector = names[int(rng.integers(len(names)))]
        return detector, {p: n.at(float(rng.random())) for p, n in sorted(space[detector].items())}
    cut = max(1, math.ceil(GOOD_SHARE * len(done)))
    failed = [h for h in history if h["loss"] is None]                  # and those still to run: not the same again
    good, bad = done[:cut], done[cut:] + failed

    def counts(rows):
        found = np.array([1.0 + sum(h["detector"] == n for h in rows) for n in names])
        return found / found.sum()

    share = counts(good) / counts(bad)
    detector = names[int(rng.choice(len(names), p=share / share.sum()))]     # drawn, not the best: no detector is given up
    of = [h for h in done if h["detector"] == detector]             # its numbers are compared among its own runs
    own = max(1, math.ceil(GOOD_SHARE * len(of)))
    params = {}
    for p, n in sorted(space[detector].items()):
        best = np.array([n.unit(h["params"][p]) for h in of[:own]])
        rest = np.array([n.unit(h["params"][p]) for h in of[own:] + [f for f in failed if f["detector"] == detector]])
        params[p] = n.at(_draw(rng, best, rest))
    return detector, params


def search(objective: Callable[[str, str, dict], dict], space: Space, evaluations: int = 50, parallel: int = 10, seed: int = 7,
           startup: int = 10, spark: SparkSession | None = None) -> list[dict]:
    """The history of ``evaluations`` candidates, at most ``parallel`` of them running at a time.

    ``objective(model_id, detector, params)`` returns a dict with ``loss`` (None: nothing to
    compare) and maybe ``artefact``; one that raises counts as failed and the search goes on.
    """
    history: list[dict] = []

    def evaluate(model_id: str, detector: str, params: dict) -> dict:
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", model_id)
        try:
            found = objective(model_id, detector, params)
        except Exception as exc:                                    # noqa: BLE001 - one bad candidate must not end the search
            found = {"loss": None, "status": f"FAILED: {str(exc).splitlines()[0][:200] if str(exc) else type(exc).__name__}"}
        return found

    with ThreadPoolExecutor(parallel) as pool:
        while len(history) < evaluations:
            turn = len(history) // parallel
            drawn: list[tuple[str, dict]] = []
            for i in range(min(parallel, evaluations - len(history))):
                pending = [{"detector": d, "params": p, "loss": None} for d, p in drawn]
                drawn.append(suggest(space, history + pending, np.random.default_rng([seed, len(history) + i]), startup))
            ids = [f"search_{len(history) + i:03d}" for i in range(len(drawn))]
            # each thread gets its own copy of the session's properties, so each candidate its own pool
            running = [pool.submit(inheritable_thread_target(spark)(evaluate) if spark is not None else evaluate, i, d, p) for i, (d, p) in zip(ids, drawn, strict=True)]
            for i, (d, p), r in zip(ids, drawn, running, strict=True):
                found = r.result()
                status = found.get("status") or ("FINISHED" if found["loss"] is not None else "FAILED")
                history.append({"model_id": i, "round": turn, "detector": d, "params": p, "artefact": found.get("artefact"),
                                "loss": found["loss"], "status": status})
    return history


def history_table(spark: SparkSession, history: list[dict]) -> DataFrame:
    """One row per evaluation."""
    return spark.createDataFrame([(h["model_id"], h["round"], h["detector"], json.dumps(h["params"]), h["artefact"], h["loss"], h["status"])
                                  for h in history], HISTORY)
