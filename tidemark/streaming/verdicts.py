"""Leads joined with verdicts that arrive later, over streams or tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import remove_path


def judged_within(leads: DataFrame, verdicts: DataFrame, key: str, lead_at: str, judged_at: str, verdict: str = "verdict", wait: str = "1 hour", delay: str = "1 hour", default: str = "REVIEW") -> DataFrame:
    """(key, lead_at, verdict, verdicts): every lead with the last verdict of its key in ``[lead_at, lead_at + wait]``.

    ``verdicts`` counts those that came in time; without any the lead gets ``default``. Of
    verdicts of one moment the greatest counts. Leads of one key and time are one row, whose
    ``verdicts`` counts a verdict once for each copy; leads without key or time are left out, and so are
    verdicts without key, time or value.

    Over two streams (append mode) both sides are kept under watermarks that trail by ``delay``. A
    lead is written once, when no verdict in time can come any more; then its state goes. The order
    in which batches bring leads and verdicts doesn't matter within the delay; rows later than it may be dropped. Over
    tables all leads are returned. A lead with many verdicts combines them on the map side.
    Where a batch brings many millions of rows, ``judged_in_batches`` keeps them out of the state.
    """

    def stamped(rows: DataFrame, at: str) -> DataFrame:
        made = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp"))
        return made.withWatermark(at, delay) if rows.isStreaming else made

    own = stamped(leads, lead_at).select(F.col(key).alias("__k"), F.col(lead_at).alias("__l"))
    said = stamped(verdicts.where(F.col(verdict).isNotNull()), judged_at).select(F.col(key).alias("__of"), F.col(judged_at).alias("__j"), F.col(verdict).alias("__v"))
    in_time = F.expr(f"__k = __of AND __j >= __l AND __j <= __l + INTERVAL {wait}")
    met = own.join(said, in_time, "left").select("__k", "__l", F.unix_micros("__j").alias("__us"), "__v")
    last = met.groupBy("__k", "__l").agg(F.max(F.struct("__us", "__v"))["__v"].alias("v"), F.count("__us").alias("n"))
    return last.select(F.col("__k").alias(key), F.col("__l").alias(lead_at), F.coalesce("v", F.lit(default)).alias(verdict), F.col("n").alias("verdicts"))


def judged_in_batches(
    leads: DataFrame,
    verdicts: DataFrame,
    key: str,
    lead_at: str,
    judged_at: str,
    sink: Callable[[DataFrame, int], None],
    path: str,
    verdict: str = "verdict",
    wait: str = "1 hour",
    delay: str = "1 hour",
    default: str = "REVIEW",
) -> DataStreamWriter:
    """A writer that hands ``sink`` each micro-batch's closed leads and number, as ``judged_within`` tells them of two streams.

    A batch moves the watermarks first. Leads whose wait they have passed are then joined as tables are; rows
    whose wait goes on are left for later batches in a table under ``path``, a folder that driver and
    executors share. So neither the join nor the rows kept have to fit in memory, and of a
    batch that reaches over years only the last wait and delay are kept. Each batch writes that
    table anew: batches should be large against what waits, and for small and frequent ones ``judged_within`` is better.

    Rows whose wait had passed before their batch are dropped as late. A batch that runs again starts from the table of the
    batch before it, so with a sink that overwrites what it wrote under the same number nothing changes.
    """
    kind = dict(leads.dtypes)[key]

    def tagged(rows: DataFrame, at: str, said: Column, lead: bool) -> DataFrame:
        made = rows.select(F.col(key).alias("__k"), F.col(at).cast("timestamp").alias("__at"), said.alias("__v"), F.lit(lead).alias("__lead"))
        return made.where("__k is not null and __at is not null")

    def watermark(counts: Column) -> Column:
        own, said = (F.max(F.when(counts & (F.col("__lead") == lead), F.col("__at"))) for lead in (True, False))
        return F.unix_micros(F.when(own.isNotNull() & said.isNotNull(), F.least(own, said)) - F.expr(f"INTERVAL {delay}"))

    def waits(micros: int | None) -> Column:
        return F.lit(True) if micros is None else F.expr(f"__at + INTERVAL {wait}") >= F.timestamp_micros(F.lit(micros))

    def judge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = spark.read.schema(batch.schema).parquet(f"{path}/{number - 1}") if number else batch.limit(0)
        rows = held.withColumn("__old", F.lit(True)).unionByName(batch.withColumn("__old", F.lit(False)))
        # the last row of either side is never behind the watermark, so the kept rows tell the one of the batch before
        before, now = rows.agg(watermark(F.col("__old")).alias("before"), watermark(F.lit(True)).alias("now")).first()
        live = rows.where(waits(before)).drop("__old")
        live.where(waits(now)).write.mode("overwrite").parquet(f"{path}/{number}")
        closing = live.where(F.col("__lead") & ~waits(now)).select("__k", F.col("__at").alias("__began"))
        said = live.where(~F.col("__lead") & (F.col("__at") < F.timestamp_micros(F.lit(now))))
        closed = judged_within(closing, said, "__k", "__began", "__at", "__v", wait, default=default)
        sink(closed.select(F.col("__k").cast(kind).alias(key), F.col("__began").alias(lead_at), F.col("__v").alias(verdict), "verdicts"), number)
        remove_path(spark, f"{path}/{number - 2}")

    nothing = F.lit(None).cast(dict(verdicts.dtypes)[verdict])
    both = tagged(leads, lead_at, nothing, True).unionByName(tagged(verdicts.where(F.col(verdict).isNotNull()), judged_at, F.col(verdict), False))
    return both.writeStream.foreachBatch(judge)
