"""Stored sketches: distinct counts and quantiles per day and group, merged by later queries.

A day's rows are read once. What is stored of a group and day is a HyperLogLog sketch of 4,096
registers and a KLL sketch, some kilobytes together, however many rows there were; any span of
days and any coarser grouping then comes from merging sketches. Both aggregates combine on the
map side, so a group with a third of all rows is no hot task.

The relative standard error of a distinct count is ``HLL_ERROR``; the rank of a quantile is off by
at most ``KLL_RANK_ERROR`` in 99 of 100 cases. Merging adds nothing to either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 12
KLL_SIZE = 400
HLL_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
KLL_RANK_ERROR = 0.0133 * 200 / KLL_SIZE


def daily_sketches(rows: DataFrame, by: Sequence[str], at: str, distinct: str, measure: str) -> DataFrame:
    """(by, day, n, distinct_sketch, value_sketch): one row per group and day.

    Null groups are a group and rows without time a day of their own (null). Null ``distinct``
    values aren't counted; null and NaN measures are in no quantile. ``n`` counts all rows.
    """
    value = F.col(measure).cast("double")
    held = F.when(~F.isnan(value), value)
    return rows.groupBy(*by, F.to_date(at).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(F.col(distinct).cast("string"), LOG_REGISTERS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(held, KLL_SIZE).alias("value_sketch"),
    )


def merged_sketches(stored: DataFrame, by: Sequence[str], quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """(by, n, distinct, quantiles): totals of stored sketches; ``quantiles`` is null where no value was stored."""
    merged = stored.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.kll_merge_agg_double("value_sketch").alias("__kll"),
    )
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    some = F.kll_sketch_get_n_double("__kll") > 0
    return merged.withColumn("quantiles", F.when(some, F.kll_sketch_get_quantile_double("__kll", ranks))).drop("__kll")
