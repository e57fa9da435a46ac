"""Exact and stateful deduplication."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import is_blank, norm_key, text_hash
from tidemark.session import cut, dimension, ship

#: A user's next message within the hold is a duplicate; the same text within the window is too.
HOLD_SECONDS = 3 * 60
WINDOW_SECONDS = 24 * 3600
#: Rows of one range of a user's messages, or of several users'.
CHUNK_ROWS = 200_000


def first_per_text(messages: DataFrame, order: Sequence[str], text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """The first message of each normalised text (and further keys) by ``order``.

    A min-aggregate finds the first row's order key with map-side combination, so a text
    that a third of the corpus repeats costs one row per task, not one sorted group. Texts
    meet by their SHA-256. Only texts that occur more than once are looked up again; where
    they are few (counted) they are broadcast and no text moves. Of rows equal in text and order
    the one of least contents stays, so one of exactly repeated rows does.
    """
    key = F.unhex(F.sha2(norm_key(F.col(text)).cast("binary"), 256))
    named = messages.withColumn("__key", key).withColumn("__at", F.struct(*order))
    keys = ["__key", *by]
    firsts = named.groupBy(*keys).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    renamed = cut(firsts.select(*[F.col(k).alias(f"__own_{k}") for k in keys], "__first"), "repeated")
    repeated = dimension(renamed, 200_000)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__own_{k}"))
    single = named.join(repeated, same, "left_anti").select(*messages.columns)
    own = F.struct(*[F.col(f"`{c}`") for c in messages.columns])
    first = named.join(repeated, same & F.col("__at").eqNullSafe(F.col("__first"))).select(*[f"__own_{k}" for k in keys], own.alias("__row"))
    one = first.groupBy(*[f"__own_{k}" for k in keys]).agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return single.unionByName(one.select(*[F.col("__row").getField(c).alias(c) for c in messages.columns]))


def first_values(messages: DataFrame, order: Sequence[str], values: Mapping[str, Column], text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Some values of the first message of each text: all that is needed of it travels, the text doesn't."""
    key = F.unhex(F.sha2(norm_key(F.col(text)).cast("binary"), 256))
    slim = messages.select(key.alias("__key"), *by, F.struct(*order).alias("__at"), F.struct(*[v.alias(n) for n, v in values.items()]).alias("__v"))
    first = slim.groupBy("__key", *by).agg(F.min_by("__v", "__at").alias("__v"))
    return first.select(*by, "__v.*")


def duplicate_probe(messages: DataFrame, key: str, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Each message with its text hash and the smallest key that holds the same text (and ``by``, null matching null).

    Only keys and hashes go through the aggregate; callers drop the text before if they can,
    by passing a column ``text_hash`` (null for a blank text) in its place.
    """
    ready = "text_hash" in messages.columns
    hashed = messages if ready else messages.withColumn("text_hash", text_hash(F.col(text)))
    some = F.col("text_hash").isNotNull() if ready else ~is_blank(F.col(text))
    names = ["text_hash", *by]
    grouped = hashed.where(some).groupBy(*names).agg(F.min(key).alias("first_id"), F.count(F.lit(1)).alias("copies"))
    first = grouped.select(*[F.col(n).alias(f"__own_{n}") for n in names], "first_id", "copies")
    same = F.col("text_hash") == F.col("__own_text_hash")
    for n in by:
        same = same & F.col(n).eqNullSafe(F.col(f"__own_{n}"))
    return hashed.join(first, same, "left").drop(*[f"__own_{n}" for n in names])


def chunked(rows: DataFrame, order: Sequence[str], chunk_rows: int, label: str) -> DataFrame:
    """The rows with ``part``: their place among ranges of ``order`` of about ``chunk_rows`` rows each; written."""
    parts = max(1, math.ceil(rows.count() / chunk_rows))
    return cut(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), label)


def _carried(per_part: DataFrame, value: Column, after: bool = False) -> Column:
    """A value of a user's parts before (or after) each part; ``per_part`` has one row for each."""
    order = Window.partitionBy("user").orderBy("part")
    return value.over(order.rowsBetween(1, Window.unboundedFollowing) if after else order.rowsBetween(Window.unboundedPreceding, -1))


def _ranked(live: DataFrame, chunk_rows: int) -> DataFrame:
    """(user, part, rank, at, id, hash, other): each message's place in its user's order, and that of the next change of text after it."""
    rows = chunked(live.select("user", "at", "id", "hash"), ["user", "at", "id", "hash"], chunk_rows, "dedup-rows")
    order = Window.partitionBy("user", "part").orderBy("at", "id", "hash")
    near = rows.withColumns({"n": F.row_number().over(order), "past": F.lag("hash").over(order)})
    about = rows.groupBy("user", "part").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("at", "id", "hash")).alias("end"))
    before = Window.partitionBy("user").orderBy("part")
    about = about.select("user", "part", F.coalesce(_carried(about, F.sum("size")), F.lit(0)).alias("before"), F.lag("end.hash").over(before).alias("last"))
    placed = near.join(about, ["user", "part"]).withColumn("rank", F.col("before") + F.col("n"))
    changed = ~F.col("hash").eqNullSafe(F.coalesce("past", "last"))
    placed = cut(placed.select("user", "part", "rank", "at", "id", "hash", F.when(changed, F.col("rank")).alias("change")), "dedup-ranked")
    ahead = Window.partitionBy("user", "part").orderBy("rank").rowsBetween(1, Window.unboundedFollowing)
    firsts = placed.groupBy("user", "part").agg(F.min("change").alias("first"))
    firsts = firsts.select("user", "part", _carried(firsts, F.min("first"), after=True).alias("later"))
    run = placed.withColumn("near", F.min("change").over(ahead)).join(firsts, ["user", "part"])
    return run.select("user", "part", "rank", "at", "id", "hash", F.coalesce("near", "later").alias("other"))


def _at_or_after(rows: DataFrame, delays: Mapping[str, int], chunk_rows: int) -> DataFrame:
    """(user, rank, one struct (rank, hash, other) for each delay): the user's first message at least so long after each message.

    Messages and the moments asked for are put in one order and dealt by ranges of it, so a
    user's day of any number of messages is many parts; what a part lacks comes from the user's parts after it.
    """
    events = rows.select("user", "at", F.col("rank").alias("sub"), F.lit("").alias("asked"), F.lit(None).cast("bigint").alias("own"), F.struct("rank", "hash", "other").alias("event"))
    both = events
    for name, delay in delays.items():
        sub = F.lit(0).cast("bigint") if delay > 0 else F.col("rank")  # without a delay: right after the message itself
        both = both.unionByName(rows.select("user", (F.col("at") + delay).alias("at"), sub.alias("sub"), F.lit(name).alias("asked"), F.col("rank").alias("own"), F.lit(None).cast(dict(events.dtypes)["event"]).alias("event")))
    order = ["at", "sub", "asked", "own"]
    dealt = chunked(both, ["user", *order], chunk_rows, "dedup-moments")
    ahead = Window.partitionBy("user", "part").orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    firsts = dealt.groupBy("user", "part").agg(F.min("event").alias("first"))  # of a part's messages the one of least rank
    firsts = firsts.select("user", "part", _carried(firsts, F.min("first"), after=True).alias("later"))
    near = dealt.withColumn("near", F.first("event", ignorenulls=True).over(ahead)).where("asked <> ''").join(firsts, ["user", "part"])
    found = near.select("user", F.col("own").alias("rank"), "asked", F.coalesce("near", "later").alias("found"))
    return found.groupBy("user", "rank").agg(*[F.max(F.when(F.col("asked") == name, F.col("found"))).alias(name) for name in delays])


def _successors(ranked: DataFrame, hold: int, window: int, chunk_rows: int) -> DataFrame:
    """Adds ``next``: the message accepted after this one, if this one is. It depends on no other message's fate."""
    found = _at_or_after(ranked, {"free": hold, "fresh": window}, chunk_rows)
    again = F.when(F.col("fresh").isNotNull(), F.greatest("fresh.rank", "free.rank"))
    following = F.when(F.col("free.hash") != F.col("hash"), F.col("free.rank")).when(F.col("free").isNotNull(), F.least("free.other", again))
    return cut(ranked.join(found, ["user", "rank"]).select("user", "part", "rank", "at", "id", "hash", following.alias("next")), "dedup-next")


def _local_next(users: list, ranks: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The index of each row's successor within its chunk, -1 if it is elsewhere; rows are in the order of user and rank."""
    at = np.arange(len(ranks)) + (following - ranks)
    inside = (following > 0) & (at < len(ranks))
    same = np.array([bool(i) and users[a] == users[j] for i, a, j in zip(inside.tolist(), np.where(inside, at, 0).tolist(), range(len(users)), strict=True)], dtype=bool)
    return np.where(same, at, -1)


def _chunk(group: pa.Table) -> tuple[pa.Table, list, np.ndarray, np.ndarray, np.ndarray]:
    rows = group.sort_by([("user", "ascending"), ("rank", "ascending")])
    users, ranks = rows.column("user").to_pylist(), rows.column("rank").to_numpy()
    following = rows.column("next").fill_null(0).to_numpy()
    return rows, users, ranks, following, _local_next(users, ranks, following)


def _exits(group: pa.Table) -> pa.Table:
    """(user, rank, to): for every row of a chunk where the chain that begins there leaves the chunk."""
    rows, _, ranks, following, local = _chunk(group)
    last = np.where(local >= 0, local, np.arange(len(ranks)))
    while True:  # pointer doubling inside the chunk
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    to = following[last]
    leaves = to > 0
    return pa.table({"user": rows.column("user").filter(pa.array(leaves)), "rank": ranks[leaves], "to": to[leaves]})


def _marked(group: pa.Table) -> pa.Table:
    """A chunk's rows with ``kept``: reached from the user's first message or from an entry."""
    rows, _, ranks, _, local = _chunk(group)
    kept = (rows.column("entry").fill_null(False).to_numpy() | (ranks == 1)).tolist()
    for i, to in enumerate(local.tolist()):
        if kept[i] and to >= 0:
            kept[to] = True
    return pa.table({**{c: rows.column(c) for c in ("user", "part", "rank", "at", "id")}, "kept": pa.array(kept, pa.bool_())})


def _entries(chained: DataFrame) -> DataFrame:
    """(user, rank) of the accepted messages at which a user's chain enters a further chunk.

    Every chunk is passed by following its own exits; the path over a user's chunks is found by
    doubling, in as many rounds as the logarithm of the chunks of the longest user. Only exits
    that begin at a first message or where another exit leads take part.
    """
    user = chained.schema["user"].dataType.simpleString()
    jumps = cut(chained.groupBy("part").applyInArrow(_exits, f"user {user}, rank bigint, to bigint"), "dedup-exits")
    targets = jumps.select("user", F.col("to").alias("rank")).distinct()
    reached = jumps.where("rank = 1").select("user", "rank")
    jumps = cut(jumps.join(targets, ["user", "rank"], "left_semi").unionByName(jumps.where("rank = 1")), "dedup-jumps")
    while not jumps.isEmpty():
        step = jumps.withColumnRenamed("to", "further")
        reached = cut(reached.unionByName(reached.join(step, ["user", "rank"]).select("user", F.col("further").alias("rank"))).distinct(), "dedup-reached")
        over = jumps.select("user", F.col("rank").alias("begin"), F.col("to").alias("rank")).join(step, ["user", "rank"])
        jumps = cut(over.select("user", F.col("begin").alias("rank"), F.col("further").alias("to")), "dedup-jumps")
    return reached.where("rank > 1").withColumn("entry", F.lit(True))


def user_dedup(
    messages: DataFrame,
    key: str,
    user: str,
    text: str,
    seconds: str,
    hold: int = HOLD_SECONDS,
    window: int = WINDOW_SECONDS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(key, verdict): keep, hold or text, from a per-user state machine over event time.

    The state is the last *accepted* message, so this is a fold, not a lag; but which message
    is accepted after an accepted one depends on that one alone: the first one that is at least
    the hold later and has another text or is a window later. These successors are found for
    all messages at once, as of their times, in ranges of about ``chunk_rows`` rows. The accepted
    messages are then the chain from each user's first one, followed within chunks and by pointer
    doubling across them. No user is ever gathered, however steadily they write. Messages
    without user or text are kept and leave no state; ties of time are in the order of the key.
    """
    blank = is_blank(F.col(text)) | F.col(user).isNull()
    rows = messages.select(
        F.col(key).alias("id"),
        F.col(user).alias("user"),
        F.col(seconds).cast("bigint").alias("at"),
        text_hash(F.col(text)).alias("hash"),
        blank.alias("skip"),
    )
    live, skipped = rows.where(~F.col("skip")), rows.where("skip")
    ship(messages.sparkSession)
    chained = _successors(_ranked(live, chunk_rows), hold, window, chunk_rows)
    kinds = dict(chained.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("user", "part", "rank", "at", "id")) + ", kept boolean"
    entered = chained.join(_entries(chained), ["user", "rank"], "left").select(*chained.columns, "entry")
    marked = cut(entered.groupBy("part").applyInArrow(_marked, schema), "dedup-marked")
    kept_at = F.max(F.when(F.col("kept"), F.col("at")))
    before = marked.groupBy("user", "part").agg(kept_at.alias("last"))
    before = before.select("user", "part", _carried(before, F.max("last")).alias("last"))
    order = Window.partitionBy("user", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    since = F.col("at") - F.coalesce("near", "last")
    verdict = F.when(F.col("kept"), "keep").when(since < hold, "hold").otherwise("text")
    told = marked.withColumn("near", kept_at.over(order)).join(before, ["user", "part"]).select("id", verdict.alias("verdict"))
    result = told.unionByName(skipped.select("id", F.lit("keep").alias("verdict")))
    return result.select(F.col("id").alias(key), "verdict")
