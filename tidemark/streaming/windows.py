"""Event-time windows over streams: sessions of a user and sliding totals, closed by watermarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stamped(messages: DataFrame, at: str, delay: str) -> DataFrame:
    rows = messages.where(F.col(at).isNotNull()).withColumn("__at", F.col(at).cast("timestamp"))
    return rows.withWatermark("__at", delay) if messages.isStreaming else rows


def sessions(messages: DataFrame, user: str, at: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(user, began, ended, messages): runs of a user's messages with no pause of over ``gap``, from first to last message.

    Over a stream (append mode) a session is written once, when the watermark, which trails the
    latest time by ``delay``, has passed its last message by ``gap``. A late row within the delay
    still joins or merges sessions; a later one is dropped by the engine from the batch after the one
    that wrote its time's sessions. Over a table all sessions are returned. Rows without user or time are in none.

    Rows combine on the map side into partial sessions, so a user who writes steadily is no hot task.
    """
    rows = _stamped(messages.where(F.col(user).isNotNull()), at, delay)
    made = rows.groupBy(F.session_window("__at", gap).alias("w"), F.col(user).alias("user")).agg(F.min("__at").alias("began"), F.max("__at").alias("ended"), F.count(F.lit(1)).alias("messages"))
    return made.select(F.col("user").alias(user), "began", "ended", "messages")


def sliding(messages: DataFrame, at: str, by: Sequence[str], measures: Mapping[str, Column], width: str = "1 day", slide: str = "12 hours", delay: str = "1 hour") -> DataFrame:
    """(by, start, end, measures): aggregates of windows that begin every ``slide`` from the epoch on; null keys are a key.

    Over a stream (append mode) a window is written once, when the watermark has passed its end,
    and rows of windows written in an earlier batch are dropped; over a table all windows with rows are returned.
    """
    rows = _stamped(messages, at, delay)
    made = rows.groupBy(F.window("__at", width, slide).alias("w"), *by).agg(*[m.alias(n) for n, m in measures.items()])
    return made.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), *measures)
