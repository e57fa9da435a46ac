"""Stored sketches merged over days and groups, within their stated errors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import sketches


def test_merged_days_stay_within_the_bounds(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 3).alias("g"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 10 * 86400).alias("at"),
        (F.xxhash64("id") % 30_000).alias("user"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_003)).cast("double") ** 2).alias("value"),
    )
    stored = sketches.daily_sketches(rows, ["g"], "at", "user", "value")
    assert stored.count() == 30 and dict(stored.dtypes)["distinct_sketch"] == dict(stored.dtypes)["value_sketch"] == "binary"
    quantiles = [0.01, 0.5, 0.9, 0.99]
    held = rows.toPandas()
    for by in (["g"], []):
        for r in sketches.merged_sketches(stored, by, quantiles).collect():
            own = held[held["g"] == r["g"]] if by else held
            assert r["n"] == len(own)
            users = own["user"].nunique()
            assert abs(r["distinct"] - users) <= 4 * sketches.HLL_ERROR * users
            ordered = np.sort(own["value"].to_numpy())
            for q, value in zip(quantiles, r["quantiles"], strict=True):
                assert abs(np.searchsorted(ordered, value) / len(ordered) - q) <= 2 * sketches.KLL_RANK_ERROR


def test_edges(spark):
    schema = "g string, at timestamp, user string, value double, day string, n int"
    rows = spark.createDataFrame([("a", None, "u", None, "x", 1), ("a", None, None, float("nan"), "x", 1), (None, None, "u", 2.0, "x", 1), (None, None, "v", 4.0, "x", 1)], schema)
    stored = sketches.daily_sketches(rows, ["g"], "at", "user", "value")
    got = {r["g"]: (r["n"], r["distinct"], r["quantiles"]) for r in sketches.merged_sketches(stored, ["g"], [0.0, 1.0]).collect()}
    assert got == {"a": (2, 1, None), None: (2, 2, [2.0, 4.0])}
    assert sketches.merged_sketches(sketches.daily_sketches(rows.limit(0), ["g"], "at", "user", "value"), ["g"]).count() == 0
