"""Chat formatting by quotation linking.

A message is cut into passages with their quote level (``>`` marks, nested any way).
Own passages (level 0) and quoted ones are normalised and hashed; inside a
conversation a quoted passage is joined with the messages whose own passage has that
hash and that came before. A message answers the latest message that its level-1
passages come from (without any, its deepest known quote decides); following the
answers back gives each message its thread and depth, and the quotes are left out of
its text.

A passage's turns are cut into blocks: inside a block a window finds the latest owner
before each turn, and one row per block carries the owner over from earlier blocks.
Threads are followed by doubling pointers. So neither a huge conversation nor a passage
in every message gathers in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.common import materialize

MARKS = re.compile(r"[ \t]*((?:>[ \t]*)*)(.*)", re.DOTALL)
BLOCK_TURNS = 1024         # turns of a conversation that one window looks through
INTRO = re.compile(r"^(?:on|le|am|el)\b.{0,200}\b(?:wrote|écrit|schrieb|escribió)\s*:\s*$", re.IGNORECASE)


def passages(text: str | None) -> list[tuple[int, str]]:
    """(quote level, passage) in order; lines of one level that follow each other are one passage.

    A blank line ends a passage. A line such as "On Monday Ann wrote:" before a
    quote belongs to the quote and is left out.
    """
    out: list[tuple[int, list[str]]] = []
    lines = []
    for line in (text or "").split("\n"):
        marks, body = MARKS.fullmatch(line).groups()
        lines.append((marks.count(">"), body if marks else line))
    for n, (level, body) in enumerate(lines):
        if INTRO.match(body.strip()) and any(x[0] > level for x in lines[n + 1:n + 3]):
            continue
        if not body.strip():
            out.append((level, []))
        elif out and out[-1][0] == level and out[-1][1]:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return [(level, "\n".join(body)) for level, body in out if body]


def passage_hash(passage: str) -> bytes:
    """Digest of the passage in lower case with single spaces, so that re-wrapped quotes still match."""
    return hashlib.md5(" ".join(passage.lower().split()).encode("utf-8", "surrogatepass")).digest()


def own_text(text: str | None) -> str:
    """The message without quotes: its level-0 passages, a blank line between them."""
    return "\n\n".join(p.strip("\n") for level, p in passages(text) if level == 0)


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own, levels (array), hashes (array): one row per message, passages in order."""
    def run(batches):
        for batch in batches:
            found = [passages(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["turn"], batch["role"],
                 pa.array(["\n\n".join(p for level, p in f if level == 0) for f in found], pa.string()),
                 pa.array([[level for level, _ in f] for f in found], pa.list_(pa.int32())),
                 pa.array([[passage_hash(p) for _, p in f] for f in found], pa.list_(pa.binary()))],
                ["conv_id", "turn", "role", "own", "levels", "hashes"])

    return messages.select("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, turn long, role string, own string, levels array<int>, hashes array<binary>")


def sources(each: DataFrame) -> DataFrame:
    """conv_id, hash, turn, source: the latest earlier turn that owns a passage, per turn that quotes it; null without one."""
    keys = ["conv_id", "hash"]
    line = each.groupBy(*keys, "turn").agg(F.max(F.when(F.col("level") == 0, F.col("turn"))).alias("owner"),
                                           F.max(F.col("level") > 0).alias("quoted"))
    line = line.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    before = Window.partitionBy(*keys, "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    carried = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = line.groupBy(*keys, "block").agg(F.max("owner").alias("owner")).select(*keys, "block", F.max("owner").over(carried).alias("carried"))
    inside = line.withColumn("inside", F.max("owner").over(before)).where("quoted")
    return inside.join(last, [*keys, "block"]).select(*keys, "turn", F.coalesce("inside", "carried").alias("source"))


def link(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of ``parsed`` messages with a key ``message``, for those that quote something.

    (conv_id, turn, reply_to) per turn, and (conv_id, turn, message, n_quotes, n_linked) per message.
    """
    each = parsed.select("conv_id", "turn", "message", F.explode(F.arrays_zip("levels", "hashes")).alias("p"))
    each = each.select("conv_id", "turn", "message", F.col("p.levels").alias("level"), F.col("p.hashes").alias("hash"))
    quoted = each.where("level > 0").groupBy("conv_id", "turn", "message", "hash").agg(F.min("level").alias("level"), F.count(F.lit(1)).alias("times"))
    seen = quoted.join(sources(each), ["conv_id", "hash", "turn"])
    direct = F.max(F.when(F.col("source").isNotNull(), F.struct(-F.col("level"), F.col("source"))))
    per = materialize(seen.groupBy("conv_id", "turn", "message").agg(
        direct.alias("best"), F.sum("times").alias("n_quotes"),
        F.sum(F.when(F.col("source").isNotNull(), F.col("times")).otherwise(0)).alias("n_linked")), "quote-links")
    replies = per.groupBy("conv_id", "turn").agg(F.max("best")["source"].alias("reply_to"))
    return replies, per.drop("best")


def threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread (first message's turn), depth, by doubling pointers until all are at their root.

    ``replies`` has conv_id, turn, reply_to (earlier turn or null); the number of rounds is
    the logarithm of the longest chain, and every round is written to the shared folder.
    """
    root = F.col("reply_to").isNull()
    at = materialize(replies.select("conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"),
                                    F.when(root, 0).otherwise(1).cast("long").alias("depth"), root.alias("done")), "threads")
    while at.where("not done").take(1):
        # only rows that have not reached their root look further; the others are carried over
        above = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"), F.col("done").alias("last"))
        moved = at.where("not done").join(above, ["conv_id", "up"]).select(
            "conv_id", "turn", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("last").alias("done"))
        at = materialize(at.where("done").unionByName(moved), "threads")
    return at.select("conv_id", "turn", F.col("up").alias("thread"), "depth")


def format_conversations(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, thread, turn, depth, reply_to, role, text, n_quotes, n_linked.

    Ordered by (conv_id, thread, turn) the rows are the reply-ordered conversations;
    ``text`` has no quotes. A message without known quotes starts a thread of its own.
    A null or empty text becomes empty; messages with a null conv_id or turn pass
    through, unlinked, each its own thread; rows repeated exactly count once, and of
    other rows with one (conv_id, turn) all are kept, answer the same turn and count
    their own quotes; an empty table
    gives no rows; other columns are ignored.
    """
    parsed = parse(messages).distinct().withColumn("message", F.xxhash64("role", "own", "levels", "hashes"))
    parsed = materialize(parsed, "messages")
    keyed = parsed.where("conv_id is not null and turn is not null")
    replies, counts = link(keyed)
    one = materialize(keyed.select("conv_id", "turn").distinct().join(replies, ["conv_id", "turn"], "left"), "replies")
    found = threads(one).join(one, ["conv_id", "turn"])
    out = (parsed.select("conv_id", "turn", "message", "role", F.col("own").alias("text")).join(found, ["conv_id", "turn"], "left")
           .join(counts, ["conv_id", "turn", "message"], "left"))
    return out.select("conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
                      "reply_to", "role", "text", F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"),
                      F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"))


def as_mail(conversations: DataFrame, depth: int = 2) -> DataFrame:
    """Conversations as a mail thread: each message above quotes of the ``depth`` messages before it, nested.

    Lines get one ``>`` per level. Rows repeated exactly are one message; where a turn
    has several messages, the first by role and text is the one that later turns quote.
    Turns are matched by an equi-join on (conv_id, turn), one row per turn on the quoted
    side, so a long conversation is not gathered; native functions only.
    """
    own = conversations.select("conv_id", "turn", "role", "text").distinct()
    first = own.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("_m"))
    out = own
    for level in range(1, depth + 1):
        marks = ">" * level + " "
        quote = F.concat(F.lit(marks), F.regexp_replace(F.col("_m.text"), "\n", "\n" + marks))
        earlier = first.select("conv_id", (F.col("turn") + level).alias("turn"), quote.alias(f"_q{level}"))
        out = out.join(earlier, ["conv_id", "turn"], "left")
    parts = [F.col("text"), *[F.col(f"_q{level}") for level in range(1, depth + 1)]]
    return out.select("conv_id", "turn", "role", F.concat_ws("\n", *parts).alias("text"))
