"""Per-user gold features, historical and rolling, from one implementation
(F8-F11, F13-F16, E1-E5, D8, D11, D13, M1).

Windows
-------
* historical: ``cutoff`` — rows with ``event_ts <= cutoff``; the duration ends at
  each user's own last event.
* rolling: ``RollingWindow`` — the active batch's users and a one-row
  ``bounds`` frame (``max_ts``, ``window_start``) computed by Spark; the
  duration ends at the batch's last event. The bounds row is attached with a
  broadcast cross join of exactly one row, so no value travels through the
  driver. A static lower bound (``batch_start - lookback``) is added as well,
  which is implied by the exact one and lets the parquet scan skip row groups.

Distinct counts
---------------
``COUNT(DISTINCT CASE WHEN cond THEN id END)`` per user is computed in two
stages: group by (user, id) keeping 0/1 flags, then sum the flags per user.
Both stages aggregate map-side before their shuffle and the first shuffle is
keyed by (user, id), so one very active user is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.functions.scalar import prefixed
from tracewise.functions.vocabulary import (
    FEATURES, LOGIN_TYPES, NAMED_ENTITY, SHARE_ACCESS, SHARE_LINK, SHARE_TYPES, USER_PREFIX,
)


@dataclass
class RollingWindow:
    users: DataFrame          # one column ``entity_id`` with prefixed user keys (distinct)
    bounds: DataFrame         # one row: max_ts, window_start
    static_lower: str | None  # literal lower bound implied by ``bounds`` (scan pruning)


def batch_bounds(events: DataFrame, batch_start: str, lookback_days: int) -> DataFrame:
    """F16 + D8: one-row frame with the batch's last event and the window start."""
    batch = events.filter(F.col("event_ts") >= F.to_timestamp(F.lit(batch_start)))
    return (batch.agg(F.max("event_ts").alias("max_ts"))
            .select("max_ts", (F.col("max_ts") - F.expr(f"INTERVAL {int(lookback_days)} DAYS")).alias("window_start")))


def rolling_window(events: DataFrame, batch_start: str, lookback_days: int) -> RollingWindow:
    from tracewise.operators.silver import active_batch_users
    static = f"to_timestamp('{batch_start}') - INTERVAL {int(lookback_days)} DAYS"
    return RollingWindow(users=active_batch_users(events, batch_start),
                         bounds=batch_bounds(events, batch_start, lookback_days),
                         static_lower=static)


def _restrict(df: DataFrame, user_col: Column | None, cutoff: str | None, window: RollingWindow | None,
              restrict_users: bool = True) -> DataFrame:
    """Apply the historical cutoff or the rolling window (semi join on batch users)."""
    if cutoff is not None:
        df = df.filter(F.col("event_ts") <= F.to_timestamp(F.lit(cutoff)))
    if window is not None:
        if window.static_lower:
            df = df.filter(F.col("event_ts") >= F.expr(window.static_lower))
        # the batch's last event bounds the window above: later events, already in the
        # tables when a batch is replayed, must not change its features
        df = (df.crossJoin(F.broadcast(window.bounds.select("max_ts", "window_start")))
                .filter((F.col("event_ts") >= F.col("window_start")) & (F.col("event_ts") <= F.col("max_ts"))))
        if restrict_users:
            keyed = df.withColumn("_user_key", user_col)
            df = keyed.join(window.users.withColumnRenamed("entity_id", "_user_key"), "_user_key", "left_semi") \
                      .drop("_user_key")
    return df


def _duration(max_ts: Column, min_ts: Column) -> Column:
    return (F.datediff(F.to_date(max_ts), F.to_date(min_ts)) + 1).alias("LogDurationInDays")


# --------------------------------------------------------------------------- logins

def login_features(events: DataFrame, cutoff: str | None = None,
                   window: RollingWindow | None = None) -> DataFrame:
    """Login counts and daily rates per entity.

    Rolling mode joins on the *prefixed* user key, so batch users do match their
    events (the source pipeline compared 'user_x' with 'x' and got zeros, T6).
    """
    ev = events.filter((F.col("entity_type") == NAMED_ENTITY) & F.col("event_type").isin(*LOGIN_TYPES))
    ev = _restrict(ev, prefixed(USER_PREFIX, F.col("entity_id")), cutoff, window)
    extra = []
    if window is not None:
        ev = ev.withColumnRenamed("max_ts", "_bmax")
        extra = [F.max("_bmax").alias("_bmax")]
    g = ev.groupBy("entity_id").agg(
        F.min("event_ts").alias("min_ts"),
        F.max("event_ts").alias("_max_ts"),
        F.count(F.when(F.col("event_type") == "login_failed", F.col("id"))).alias("TotalFailedAttempts"),
        F.count(F.when(F.col("event_type") == "login_attempt", F.col("id"))).alias("TotalLoginAttempts"),
        *extra,
    )
    end = F.col("_bmax") if window is not None else F.col("_max_ts")
    return login_rates(g.select("entity_id", "min_ts", end.alias("max_ts"), "TotalFailedAttempts", "TotalLoginAttempts"))


def login_rates(g: DataFrame) -> DataFrame:
    """Duration and daily rates of (entity_id, min_ts, max_ts, TotalFailedAttempts, TotalLoginAttempts)."""
    out = g.select(
        "entity_id", "min_ts", "max_ts", _duration(F.col("max_ts"), F.col("min_ts")),
        "TotalFailedAttempts", "TotalLoginAttempts",
    )
    return out.select(
        "*",
        prefixed(USER_PREFIX, F.col("entity_id")).alias("user_join_key"),
        (F.col("TotalLoginAttempts") / F.col("LogDurationInDays")).alias("AvgLoginAttemptsPerDay"),
        (F.col("TotalFailedAttempts") / F.col("LogDurationInDays")).alias("AvgFailedAttemptsPerDay"),
    )


# --------------------------------------------------------------------------- file access

FILE_FLAGS = {
    "NumTimesWrittenToSysFolder": (True, ("file_written", "file_updated")),
    "NumTimesDeletedSysFolder": (True, ("file_deleted",)),
    "NumTimesAccessedSysFolder": (True, ("file_accessed",)),
    "NumTimesAccessedNormalFolder": (False, ("file_accessed",)),
    "NumTimesDeletedNormalFolder": (False, ("file_deleted",)),
}
FILE_RATES = {
    "NumTimesWrittenToSysFolder": "NumTimesWrittenToSysFolderPerDay",
    "NumTimesDeletedSysFolder": "NumTimesDeletedSysFolderPerDay",
    "NumTimesAccessedSysFolder": "NumTimesAccessedSysFolderPerDay",
    "NumTimesAccessedNormalFolder": "NumTimesAccessedNormalFolderPerDay",
    "NumTimesDeletedNormalFolder": "NumTimesDeletedNormFolderPerDay",
}


def _two_stage(rows: DataFrame, flags: dict[str, Column], window: RollingWindow | None) -> DataFrame:
    """(src, id) -> flags, then src -> sums; plus min/max event time per src."""
    extra = [F.max("max_ts").alias("_bmax")] if window is not None else []
    stage1 = rows.groupBy("src", "id").agg(
        F.min("event_ts").alias("_min"), F.max("event_ts").alias("_max"),
        *[F.max(F.when(cond & F.col("id").isNotNull(), 1).otherwise(0)).alias(name) for name, cond in flags.items()],
        *extra,
    )
    extra2 = [F.max("_bmax").alias("_bmax")] if window is not None else []
    return stage1.groupBy("src").agg(
        F.min("_min").alias("min_ts"), F.max("_max").alias("_max_ts"),
        *[F.sum(name).cast("bigint").alias(name) for name in flags], *extra2,
    )


def file_access_features(edges: DataFrame, system_folders: DataFrame, cutoff: str | None = None,
                         window: RollingWindow | None = None) -> DataFrame:
    """System vs normal folder activity per user, with daily rates.

    ``system_folders`` is a top-k result (at most k rows), so broadcasting it is
    size-safe (E1).
    """
    e = edges.filter(F.col("relationship").like("file%"))
    e = _restrict(e, F.col("src"), cutoff, window)
    sys_ids = F.broadcast(system_folders.select(F.col("id").alias("_sys_id")).distinct())
    e = e.join(sys_ids, e["dst"] == sys_ids["_sys_id"], "left")
    is_sys = F.col("_sys_id").isNotNull()
    flags = {name: (is_sys if sys else ~is_sys) & F.col("relationship").isin(*rels)
             for name, (sys, rels) in FILE_FLAGS.items()}
    agg = _two_stage(e, flags, window)
    end = F.col("_bmax") if window is not None else F.col("_max_ts")
    return file_rates(agg.select("src", "min_ts", end.alias("max_ts"), *FILE_FLAGS.keys()))


def file_rates(agg: DataFrame) -> DataFrame:
    """Duration and daily rates of (src, min_ts, max_ts, the file counts)."""
    out = agg.select(
        F.col("src").alias("id"), F.col("src").alias("user_join_key"), "min_ts", "max_ts",
        _duration(F.col("max_ts"), F.col("min_ts")), *FILE_FLAGS.keys(),
    )
    return out.select("*", *[(F.col(c) / F.col("LogDurationInDays")).alias(r) for c, r in FILE_RATES.items()])


# --------------------------------------------------------------------------- sharing

SHARE_RATES = {
    "NumUsersSharingWith": "NumUsersSharingWithPerDay",
    "NumFilesShared": "NumFilesSharedPerDay",
    "NumFailedFileShares": "NumFailedFileSharesPerDay",
    "NumFailedShareReadAttempts": "NumFailedShareReadAttemptsPerDay",
}


def _owned_places(share_edges: DataFrame) -> DataFrame:
    """Distinct (src, dst, entity_sub_relationship): the (share, token) places of every owner."""
    return (share_edges.select("src", "dst", "entity_sub_relationship")
            .filter(F.col("dst").isNotNull() & F.col("entity_sub_relationship").isNotNull()).distinct())


def _access_places(accesses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct accesses (_a_id, _a_src, _a_dst): those whose id has one place, and those whose id has several."""
    acc = (accesses.filter((F.col("relationship") == SHARE_ACCESS) & F.col("id").isNotNull()
                           & F.col("src").isNotNull() & F.col("dst").isNotNull())
           .select(F.col("id").alias("_a_id"), F.col("src").alias("_a_src"), F.col("dst").alias("_a_dst")).distinct())
    per_id = acc.groupBy("_a_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_a_src", "_a_dst")).alias("_at"))
    return (per_id.filter(F.col("_n") == 1).select("_a_id", "_at._a_src", "_at._a_dst"),
            acc.join(per_id.filter(F.col("_n") > 1).select("_a_id"), "_a_id", "left_semi"))


def _answered(places: DataFrame, answers: DataFrame) -> DataFrame:
    return places.join(answers, (places["dst"] == answers["_a_src"]) & (places["entity_sub_relationship"] == answers["_a_dst"]))


def reciprocal_access_ids(share_edges: DataFrame, accesses: DataFrame) -> DataFrame:
    """Distinct (src, access id) where an access edge answers a share edge:
    ``e.entity_sub_relationship = e2.dst AND e2.src = e.dst`` with e2 an access.

    The result has a row per owner and answer, many more than both inputs, and is
    not shuffled: both sides are distinct, so an access id with one (share, token)
    pair meets an owner once. Only the few ids with several pairs could meet one
    again and are made distinct after the join.
    """
    places = _owned_places(share_edges)
    one, several = _access_places(accesses)
    once = _answered(places, one).select("src", F.col("_a_id").alias("access_id"))
    return once.unionByName(_answered(places, several).select("src", F.col("_a_id").alias("access_id")).distinct())


def reciprocal_access_counts(share_edges: DataFrame, accesses: DataFrame) -> DataFrame:
    """E2 summary: (src, num_reciprocal_accessed_shares), distinct answering accesses per owner.

    Accesses are counted per (share, token) first, so an owner meets one number and
    not the accesses themselves. Only an access id that occurs with several (share,
    token) pairs could be counted twice that way; those few go through the pairs.
    """
    places = _owned_places(share_edges)
    one, several = _access_places(accesses)
    counted = one.groupBy("_a_src", "_a_dst").agg(F.count(F.lit(1)).alias("_accesses"))
    simple = _answered(places, counted).select("src", "_accesses")
    other = _answered(places, several).select("src", "_a_id").distinct().select("src", F.lit(1).cast("long").alias("_accesses"))
    return simple.unionByName(other).groupBy("src").agg(F.sum("_accesses").alias("num_reciprocal_accessed_shares"))


def sharing_features(edges: DataFrame, cutoff: str | None = None,
                     window: RollingWindow | None = None) -> DataFrame:
    """Sharing measures per source vertex.

    The access side of the reciprocal join is cut to the same time window as the
    share side (T22); in rolling mode it is every access in the lookback window,
    not only those whose src is a batch user (T21).
    """
    shares = edges.filter(F.col("relationship").isin(*SHARE_TYPES))
    e = _restrict(shares, F.col("src"), cutoff, window)
    acc = _restrict(edges.filter(F.col("relationship") == SHARE_ACCESS), None, cutoff, window,
                    restrict_users=False)
    rel, st = F.col("relationship"), F.col("status")
    flags = {
        "_has_shared": rel == SHARE_LINK,
        "NumFilesShared": rel == SHARE_LINK,
        "NumFailedFileShares": (rel == SHARE_LINK) & (st != "success"),
        "NumFailedShareReadAttempts": (rel == SHARE_ACCESS) & (st != "success"),
    }
    base = _two_stage(e, flags, window)
    users = (e.filter((rel == SHARE_LINK) & F.col("entity_sub_relationship").isNotNull())
             .select("src", "entity_sub_relationship").distinct()
             .groupBy("src").agg(F.count(F.lit(1)).alias("NumUsersSharingWith")))
    recip = reciprocal_access_counts(e, acc)
    agg = (base.join(users, "src", "left").join(recip, "src", "left")
           .fillna(0, subset=["NumUsersSharingWith", "num_reciprocal_accessed_shares"]))
    end = F.col("_bmax") if window is not None else F.col("_max_ts")
    out = agg.select(
        F.col("src").alias("id"), F.col("src").alias("user_join_key"), "min_ts", end.alias("max_ts"),
        _duration(end, F.col("min_ts")),
        F.when(F.col("num_reciprocal_accessed_shares") > 0, 1).otherwise(0).alias("has_reciprocal_accessed_shares"),
        "num_reciprocal_accessed_shares",
        F.when(F.col("_has_shared") > 0, 1).otherwise(0).alias("HasSharedFiles"),
        "NumUsersSharingWith", "NumFilesShared", "NumFailedFileShares", "NumFailedShareReadAttempts",
    )
    return out.select("*", *[(F.col(c) / F.col("LogDurationInDays")).alias(r) for c, r in SHARE_RATES.items()])


# --------------------------------------------------------------------------- system folders

def top_in_degree(edges: DataFrame, predicate: str = "relationship LIKE 'file%'", k: int = 10,
                  as_of: str | None = None) -> DataFrame:
    """The k most used folders by in-degree; ties broken by id.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: a per-task top-k then a
    k x tasks merge, never a full sort.
    """
    e = edges.filter(F.expr(predicate))
    if as_of is not None:
        e = e.filter(F.col("event_ts") <= F.to_timestamp(F.lit(as_of)))
    deg = (e.filter(F.col("dst").isNotNull()).groupBy(F.col("dst").alias("id"))
           .agg(F.count(F.lit(1)).cast("int").alias("inDegree")))
    return deg.orderBy(F.desc("inDegree"), F.asc("id")).limit(k)


# --------------------------------------------------------------------------- feature frames

def feature_frame(keys: DataFrame, key_col: str, out_key: str, login: DataFrame, files: DataFrame,
                  sharing: DataFrame) -> DataFrame:
    """Key + the 12 model features, nulls replaced by 0.

    Every right side holds at most one row per key, so the chained left joins
    never multiply rows.
    """
    lf = login.select(F.col("user_join_key").alias("_k1"), "AvgLoginAttemptsPerDay", "AvgFailedAttemptsPerDay")
    fp = files.select(F.col("user_join_key").alias("_k2"), *[c for c in FEATURES[2:7]])
    ds = sharing.select(F.col("user_join_key").alias("_k3"), *[c for c in FEATURES[7:]])
    k = F.col(key_col)
    out = (keys.join(lf, k == F.col("_k1"), "left")
               .join(fp, k == F.col("_k2"), "left")
               .join(ds, k == F.col("_k3"), "left")
               .select(k.alias(out_key), *FEATURES))
    return out.fillna(0)


def training_feature_frame(nodes: DataFrame, login: DataFrame, files: DataFrame, sharing: DataFrame) -> DataFrame:
    users = nodes.filter(F.col("entity_type") == "user").select("id")
    return feature_frame(users, "id", "id", login, files, sharing)


def rolling_feature_frame(window: RollingWindow, login: DataFrame, files: DataFrame,
                          sharing: DataFrame) -> DataFrame:
    return feature_frame(window.users, "entity_id", "user_id", login, files, sharing)


def active_user_edges(edges: DataFrame, window: RollingWindow) -> DataFrame:
    """E5: edges of the batch's users inside the lookback window (semi join)."""
    return _restrict(edges, F.col("src"), None, window).drop("max_ts", "window_start")


def feature_non_null_counts(frame: DataFrame) -> DataFrame:
    """non-null count of every column, one pass."""
    return frame.agg(*[F.count(F.col(c)).alias(c) for c in frame.columns])


def failed_login_momentum(events: DataFrame, bounds: DataFrame, days=(7, 14, 30),
                          batch_start: str | None = None) -> DataFrame:
    """Failed logins over the last 7 / 14 / 30 days before the batch's last event, one scan.

    ``batch_start`` (the last event is not before it) adds a constant lower bound,
    which the parquet scan can use.
    """
    longest = max(days)
    ev = events.filter((F.col("entity_type") == NAMED_ENTITY) & (F.col("event_type") == "login_failed"))
    if batch_start is not None:
        ev = ev.filter(F.col("event_ts") >= F.expr(f"to_timestamp('{batch_start}') - INTERVAL {int(longest)} DAYS"))
    ev = (ev.crossJoin(F.broadcast(bounds.select("max_ts")))
          .filter((F.col("event_ts") >= F.col("max_ts") - F.expr(f"INTERVAL {int(longest)} DAYS"))
                  & (F.col("event_ts") <= F.col("max_ts"))))
    return ev.groupBy("entity_id").agg(*[
        F.count(F.when(F.col("event_ts") >= F.col("max_ts") - F.expr(f"INTERVAL {int(d)} DAYS"), 1)).alias(f"failed_{d}d")
        for d in days])


def window_for_batch(batch: DataFrame, lookback_days: int, last=None) -> RollingWindow:
    """Rolling window of one micro-batch: its named users and its own last event.

    ``last`` (that event's time, where the caller has it) becomes a constant lower
    bound for the scans of stored tables.
    """
    users = (batch.filter((F.col("entity_type") == NAMED_ENTITY) & F.col("entity_id").isNotNull())
             .select(prefixed(USER_PREFIX, F.col("entity_id")).alias("entity_id")).distinct())
    bounds = (batch.agg(F.max("event_ts").alias("max_ts"))
              .select("max_ts", (F.col("max_ts") - F.expr(f"INTERVAL {int(lookback_days)} DAYS")).alias("window_start")))
    static = None if last is None else f"to_timestamp('{last}') - INTERVAL {int(lookback_days)} DAYS"
    return RollingWindow(users=users, bounds=bounds, static_lower=static)
