"""Evaluation and usage aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank
from tidemark.session import dimension


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded share, 0 where there is nothing to divide by."""
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), digits)


def confusion(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall, f1."""
    counted = rows.agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    )
    tp = F.col("tp")
    return counted.select(
        "*",
        ratio(tp, tp + F.col("fp")).alias("precision"),
        ratio(tp, tp + F.col("fn")).alias("recall"),
        ratio(tp * 2, tp * 2 + F.col("fp") + F.col("fn")).alias("f1"),
    )


def group_rates(rows: DataFrame, passed: Column, group: str) -> DataFrame:
    """Pass rate per group and, under ``ALL``, in total."""
    counted = rows.rollup(group).agg(F.grouping(group).alias("__all"), F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("passed"))
    name = F.when(F.col("__all") == 1, F.lit("ALL")).otherwise(F.col(group))
    return counted.select(name.alias(group), "n", "passed", ratio(F.col("passed"), F.col("n")).alias("pass_rate"))


def verdict_summary(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    """Counts of each verdict and the precision they imply."""
    v = F.col(verdict)
    counted = rows.agg(F.count_if(v == "REAL_LEAD").alias("real"), F.count_if(v == "MISTAKE").alias("mistake"), F.count_if(v == "REVIEW").alias("review"))
    return counted.select("*", ratio(F.col("real"), F.col("real") + F.col("mistake")).alias("implied_precision"))


def usage(calls: DataFrame, stage: str, units: str, prices: DataFrame | None = None, model: str = "model") -> DataFrame:
    """Calls, units and cost per stage and in total; models without a price cost 0, of several prices the highest counts."""
    priced = calls.withColumn("price", F.lit(1.0)) if prices is None else calls.join(dimension(prices.groupBy(model).agg(F.max("price").alias("price"))), model, "left")
    cost = F.col(units) * F.coalesce("price", F.lit(0.0))
    totals = priced.withColumn("__cost", cost).rollup(stage).agg(F.grouping(stage).alias("__all"), F.count(F.lit(1)).alias("calls"), F.sum(units).alias("units"), F.sum("__cost").alias("cost"))
    return totals.select(F.when(F.col("__all") == 1, F.lit("TOTAL")).otherwise(F.col(stage)).alias("stage"), "calls", "units", "cost")


def graded(decisions: DataFrame, truth: DataFrame, order: Sequence[str], key: str = "message_id", predicted: str = "is_lead", actual: str = "actual") -> DataFrame:
    """Confusion of decisions and truth by key; of repeated decisions the last by ``order`` counts."""
    last = decisions.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(predicted, F.struct(*order, predicted)).alias("__p"))
    known = truth.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(actual).alias("__a"))
    return confusion(last.join(known, key), F.coalesce("__p", F.lit(False)), F.coalesce("__a", F.lit(False)))


def corpus_stats(rows: DataFrame, at: str, user: str, name: str | None = None) -> DataFrame:
    """Messages, first and last time, distinct users and, of a name column, distinct names that aren't blank."""
    names = [F.count_distinct(F.when(~is_blank(F.col(name)), F.col(name))).alias("names")] if name else []
    return rows.agg(F.count(F.lit(1)).alias("messages"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count_distinct(user).alias("users"), *names)


def top_items(rows: DataFrame, items: Column, n: int = 5) -> DataFrame:
    """The commonest list items."""
    return rows.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item").limit(n)
