"""Routing predicates over new and changed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def notifications(new: DataFrame, old: DataFrame, key: str, channels: dict[str, Column], watched: list[str]) -> DataFrame:
    """(key, channel, kind): inserts that satisfy a channel, updates that do and changed a watched column.

    Channel predicates refer to the new row's columns.
    """
    before = old.select(F.col(key).alias("__key"), *[F.col(w).alias(f"__old_{w}") for w in watched])
    joined = new.join(before, F.col(key) == F.col("__key"), "left")
    changed = F.lit(False)
    for name in watched:
        changed = changed | ~F.col(name).eqNullSafe(F.col(f"__old_{name}"))
    kind = F.when(F.col("__key").isNull(), "insert").when(changed, "update")
    hits = F.filter(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(c)) for c, p in channels.items()]), lambda c: c.isNotNull())
    return joined.withColumn("kind", kind).where("kind is not null").select(key, F.explode(hits).alias("channel"), "kind")


def work_queues(rows: DataFrame, notified: Column, approval: Column, sent: Column) -> DataFrame:
    """Adds the delivery queues that a row belongs to."""
    queues = F.array(
        F.when(notified.isNull(), F.lit("pending")),
        F.when(approval & sent.isNull(), F.lit("approved_unsent")),
        F.when(~approval & notified.isNotNull() & sent.isNull(), F.lit("in_review")),
        F.when(sent.isNotNull(), F.lit("sent")),
    )
    return rows.withColumn("queues", F.filter(queues, lambda q: q.isNotNull()))
