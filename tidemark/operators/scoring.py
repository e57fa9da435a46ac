"""Scorers: the one external step of a pipeline, and ways to replay or rule it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut


class Scorer(Protocol):
    """Adds a JSON string column ``raw`` (null on failure) to every row it is given."""

    def score(self, rows: DataFrame, stage: str) -> DataFrame: ...


class ReplayScorer:
    """Recorded outputs: a table of (message_id, stage, raw[, at]); of repeated replies the last by ``at`` counts, else the greatest."""

    def __init__(self, recorded: DataFrame, key: str = "message_id") -> None:
        self.recorded, self.key = recorded, key

    def score(self, rows: DataFrame, stage: str) -> DataFrame:
        rank = F.struct("at", "raw") if "at" in self.recorded.columns else F.struct("raw")
        own = self.recorded.where(F.col("stage") == stage).groupBy(F.col("message_id").alias("__id")).agg(F.max(rank).alias("__r"))
        own = own.select("__id", "__r.raw")
        return rows.join(own, F.col(self.key) == F.col("__id"), "left").drop("__id")


class RuleScorer:
    """A column expression as the model."""

    def __init__(self, rules: dict[str, Column]) -> None:
        self.rules = rules

    def score(self, rows: DataFrame, stage: str) -> DataFrame:
        return rows.withColumn("raw", self.rules[stage])


class FunctionScorer:
    """A batch function text list -> JSON list, retried with growing pauses, run as an Arrow UDF.

    ``parallel`` caps the concurrent calls by the number of partitions.
    """

    def __init__(self, call: Callable[[list[str]], list[str | None]], text: str = "text", parallel: int = 8, tries: int = 3, pause: float = 2.0) -> None:
        self.call, self.text, self.parallel, self.tries, self.pause = call, text, parallel, tries, pause

    def score(self, rows: DataFrame, stage: str) -> DataFrame:
        call, tries, pause = self.call, self.tries, self.pause

        @F.pandas_udf("string")
        def run(texts: pd.Series) -> pd.Series:
            import time

            for turn in range(tries):
                try:
                    return pd.Series(call(texts.tolist()), index=texts.index, dtype="object")
                except Exception:  # a remote model may fail in any way; the row then has no answer
                    if turn + 1 < tries:
                        time.sleep(min(30.0, pause**turn))
            return pd.Series([None] * len(texts), index=texts.index, dtype="object")

        return rows.repartition(self.parallel).withColumn("raw", run.asNondeterministic()(F.col(self.text)))


def on_subset(rows: DataFrame, survives: Column, scorer: Scorer, stage: str) -> DataFrame:
    """Scores only the rows that survive; the others get a null ``raw``.

    A UDF inside a CASE branch would run for all rows, so the rows are parted and united.
    """
    passed = scorer.score(rows.where(F.coalesce(survives, F.lit(False))), stage)
    rest = rows.where(~F.coalesce(survives, F.lit(False))).withColumn("raw", F.lit(None).cast("string"))
    return passed.unionByName(rest)


def asked(rows: DataFrame, survives: Column, scorer: Scorer, stage: str) -> DataFrame:
    """``on_subset`` with the survivors written, so that no model is called twice.

    The others aren't copied: they are read again from where ``rows`` come from, so a gate that
    few rows pass costs a write of those few. ``survives`` must not depend on a model whose
    replies aren't written yet.
    """
    passed = F.coalesce(survives, F.lit(False))
    said = cut(scorer.score(rows.where(passed), stage), stage)
    return said.unionByName(rows.where(~passed).withColumn("raw", F.lit(None).cast("string")))
