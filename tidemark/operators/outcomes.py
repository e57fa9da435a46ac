"""Selections and summaries of decisions, and how results of several runs meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut
from tidemark.sources.sinks import latest_wins


def outcome(verdict: Column, is_lead: Column, confirmed: Sequence[str] = ("REAL_LEAD", "REVIEW")) -> Column:
    """confirmed (review included), judged_out or rejected."""
    lead = F.coalesce(is_lead, F.lit(False))
    return F.when(lead & verdict.isin(*confirmed), "confirmed").when(verdict == "MISTAKE", "judged_out").otherwise("rejected")


def stage_of(rationale: Column) -> Column:
    """Where a rejected message ended, by its rationale's marker."""
    return F.when(F.contains(rationale, F.lit("pre-filtered")), "prefilter").when(F.contains(rationale, F.lit("stage1")), "stage1").when(F.contains(rationale, F.lit("extraction failed")), "failed").otherwise("model")


def to_retry(decisions: DataFrame, key: str = "message_id") -> DataFrame:
    """Distinct keys whose extraction failed."""
    return decisions.where(F.contains("rationale", F.lit("extraction failed"))).select(key).distinct()


def with_retries(original: DataFrame, retried: DataFrame, key: str = "message_id") -> DataFrame:
    """Both runs, the retry winning where both have a row."""
    both = original.withColumn("__run", F.lit(0)).unionByName(retried.withColumn("__run", F.lit(1)))
    return latest_wins(both, [key], ["__run"]).drop("__run")


def confidence_summary(rows: DataFrame, high: float = 0.8) -> DataFrame:
    """(total, relevant, high_confidence, avg_confidence, min_confidence) of a glossary or decision table."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("relevant")).alias("relevant"),
        F.count_if(F.col("relevant") & (F.col("confidence") >= high)).alias("high_confidence"),
        F.round(F.avg("confidence"), 4).alias("avg_confidence"),
        F.min("confidence").alias("min_confidence"),
    )


def listing(terms: DataFrame, least: float = 0.0, limit: int | None = None) -> DataFrame:
    """Relevant entries by falling confidence, for display."""
    kept = terms.where(F.col("relevant") & (F.col("confidence") >= least)).orderBy(F.desc("confidence"), "term")
    return kept if limit is None else kept.limit(limit)


def judged(leads: DataFrame, verdicts: DataFrame, key: str = "message_id", default: str = "REVIEW") -> DataFrame:
    """Leads with their judge's last verdict, the default where none came."""
    last = verdicts.groupBy(key).agg(F.max_by("verdict", "judged_at").alias("verdict"))
    return leads.drop("verdict").join(last, key, "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def append_new(rows: DataFrame, path: str, key: str) -> int:
    """Append the rows whose key the JSON-lines folder lacks; returns how many. A rerun adds nothing.

    Of rows that share a key the one of least contents goes in. Rows without a key are told
    apart by all their contents.
    """
    from tidemark.sources.sinks import _exists

    spark = rows.sparkSession

    def named(frame: DataFrame) -> DataFrame:
        said = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
        return frame.withColumns({"__said": said, "__name": F.when(F.col(key).isNotNull(), F.to_json(F.struct(F.col(key).alias("k")))).otherwise(said)})

    new = named(rows)
    if _exists(spark, path):
        new = new.join(named(spark.read.schema(rows.schema).json(path)).select("__name").distinct(), "__name", "left_anti")
    first = new.groupBy("__name").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), "__said").alias("__row"))
    rows = cut(first.select(*[F.col("__row").getField(c).alias(c) for c in rows.columns]), "new-rows")
    count = rows.count()
    if count:
        rows.write.mode("append").json(path)
    return count
