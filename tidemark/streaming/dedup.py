"""The per-user dedup state machine over a stream, and its companions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.text import is_blank, text_hash
from tidemark.operators.dedup import HOLD_SECONDS, WINDOW_SECONDS
from tidemark.sources.sinks import merge_buckets, replace_table, upsert


def dedup_stream(
    messages: DataFrame, key: str, user: str, text: str, seconds: str, hold: int = HOLD_SECONDS, window: int = WINDOW_SECONDS, at: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """(key, verdict[, late]) as in the batch operator; the state of a user is the last accepted message.

    Within a micro-batch rows are taken in (time, key) order. Messages without user or text
    have no key to keep state under; they are kept by the stateless branch.

    With an event-time column ``at`` its watermark trails by ``delay``, and a user's state goes
    once the watermark has passed the window since the last accepted message, when it can
    change no verdict. A row older than that message is out of order: it is kept, marked
    ``late``, and changes nothing. Without ``at`` states stay and such rows count as held.
    """
    if at is not None:
        return _expiring(messages, key, user, text, at, hold, window, delay)
    kind = dict(messages.dtypes)[key]
    rows = messages.select(F.col(key).alias("id"), F.col(user).cast("string").alias("user"), F.col(seconds).cast("bigint").alias("at"), text_hash(F.col(text)).alias("hash"), is_blank(F.col(text)).alias("blank"))

    def fold(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else (None, None)
        seen = pd.concat(list(frames)).sort_values(["at", "id"])
        verdicts = []
        for at, own in zip(seen["at"], seen["hash"], strict=True):
            gap = None if last[1] is None else at - last[1]
            if gap is not None and gap < hold:
                verdicts.append("hold")
            elif gap is not None and last[0] == own and gap < window:
                verdicts.append("text")
            else:
                verdicts.append("keep")
                last = (own, int(at))
        state.update(last)
        yield pd.DataFrame({"id": seen["id"], "verdict": verdicts})

    live = rows.where("not blank and user is not null").groupBy("user")
    folded = live.applyInPandasWithState(fold, f"id {kind}, verdict string", "hash string, at bigint", "append", GroupStateTimeout.NoTimeout)
    kept = rows.where("blank or user is null").select("id", F.lit("keep").alias("verdict"))
    return folded.unionByName(kept).withColumnRenamed("id", key)


def _expiring(messages: DataFrame, key: str, user: str, text: str, at: str, hold: int, window: int, delay: str) -> DataFrame:
    kind = dict(messages.dtypes)[key]
    stamped = messages.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", delay)
    rows = stamped.select(F.col(key).alias("id"), F.col(user).cast("string").alias("user"), "__at", F.unix_timestamp("__at").alias("at"), text_hash(F.col(text)).alias("hash"), is_blank(F.col(text)).alias("blank"))

    def fold(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else (None, None)
        seen = pd.concat(list(frames)).sort_values(["at", "id"])
        made = []
        for moment, own in zip(seen["at"], seen["hash"], strict=True):
            gap = None if last[1] is None else int(moment) - last[1]
            late = gap is not None and gap < 0
            verdict = "keep" if gap is None or late else "hold" if gap < hold else "text" if last[0] == own and gap < window else "keep"
            if verdict == "keep" and not late:
                last = (own, int(moment))
            made.append((verdict, late))
        state.update(last)
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, (last[1] + window) * 1000))
        verdicts, lates = zip(*made, strict=True)
        yield pd.DataFrame({"id": seen["id"], "verdict": list(verdicts), "late": list(lates)})

    live = rows.where("not blank and user is not null").groupBy("user")
    folded = live.applyInPandasWithState(fold, f"id {kind}, verdict string, late boolean", "hash string, at bigint", "append", GroupStateTimeout.EventTimeTimeout)
    kept = rows.where("blank or user is null").select("id", F.lit("keep").alias("verdict"), F.lit(False).alias("late"))
    return folded.unionByName(kept).withColumnRenamed("id", key)


def without_banned_live(load: Callable[[], DataFrame], author: str = "username") -> Callable[[DataFrame, int], DataFrame]:
    """A micro-batch step that reads the ban list anew each time, so additions and reloads take effect."""
    from tidemark.operators.gates import without_banned

    return lambda batch, _: without_banned(batch, load(), author)


def upsert_sink(path: str, keys: list[str], order: list[str], buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each micro-batch into a parquet table; replays change nothing.

    The whole table carries a mark of its last batch, renamed with it, and a batch that finds its
    own mark is skipped. In buckets, of which a crash may leave some unwritten, rows keep the number
    of their batch (column ``batch``) and a replay starts from the rows of the others. Keyed,
    null-keyed and repeated rows all end as after the batch's first run.
    With ``buckets`` the table is partitioned by a hash of its keys (column ``bucket``) and a batch
    rewrites only the partitions it touches; without, the whole table, which suits small ones.
    """

    def merge(batch: DataFrame, number: int) -> None:
        from tidemark.sources.sinks import _exists, _mark

        if buckets:
            return merge_buckets(batch, path, keys, order, buckets, number)
        spark = batch.sparkSession
        if _exists(spark, _mark(path, number)):
            return None
        base = spark.read.parquet(path) if _exists(spark, path) else batch.limit(0)
        return replace_table(upsert(base, batch, keys, order), path, number)

    return merge
