"""Systematic, hashed and chunked samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut


def numbered(rows: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Consecutive numbers from 1 in a global order, without gathering rows in one task.

    Rows are range-partitioned and sorted; each partition's offset is a running sum over
    the partition counts, which are as many as partitions.
    """
    ranged = cut(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["__part"]):
        offsets += [F.lit(row["__part"]), F.lit(before)]
        before += row["n"]
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    offset = F.element_at(F.create_map(*offsets), F.col("__part")) if offsets else F.lit(0)
    return ranged.withColumn(name, (local + offset).cast("bigint")).drop("__part")


def systematic(rows: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Every step-th row, the first ``n``, with step = max(1, N // n)."""
    step = max(1, rows.count() // n)
    marked = numbered(rows, order)
    return marked.where(((F.col("rn") - 1) % step == 0) & (F.col("rn") <= step * n)).drop("rn")


def sample_order(key: str | Column, seed: int = 42) -> Column:
    """A repeatable random order that other systems can compute too: the MD5 of seed and key."""
    value = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")).cast("binary"))


def hashed(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of n rows."""
    return rows.orderBy(sample_order(key, seed), key).limit(n)


def hash_batches(rows: DataFrame, key: str, size: int = 20, batches: int = 30, seed: int = 42) -> DataFrame:
    """A shuffled selection dealt into at most ``batches`` batches of ``size``."""
    chosen = hashed(rows, key, size * batches, seed)
    at = F.row_number().over(Window.orderBy(sample_order(key, seed), key))  # size * batches rows
    return chosen.withColumn("batch", F.floor((at - 1) / size).cast("int"))


def in_order(rows: DataFrame, corpus: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Rows numbered (``rn``) and sorted as their messages come in the corpus: the order that parallel work lost.

    ``corpus`` should hold no more than the key and what it is ordered by.
    """
    places = numbered(corpus, order).groupBy(key).agg(F.min("rn").alias("rn"))
    return rows.join(places, key).orderBy("rn")
