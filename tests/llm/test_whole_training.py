"""Models learn from every labelled row, and totals over blocks equal those over one array."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import blocks, boosted_rules, bt_quality, common, docstats


def corpus(spark, rows):
    """Short documents whose label is told by their statistics, with some noise."""
    i = F.col("id")
    text = F.concat(F.repeat(F.lit("some words here. "), (2 + i * 7 % 11).cast("int")), F.repeat(F.lit("!|# "), (i * 13 % 5).cast("int")), i.cast("string"))
    quality = F.when(i % 10 == 0, i % 3 % 2).otherwise((i * 13 % 5 < 2).cast("int"))
    made = spark.range(0, rows, 1, 3).select(i.alias("doc_id"), text.alias("text"), quality.cast("int").alias("quality"))
    return made.select("doc_id", "text"), made.select("doc_id", "quality"), made.orderBy("doc_id").collect()


def test_order_statistics_are_exact(spark):
    random = np.random.default_rng(3)
    x = np.stack([random.normal(size=3000), random.integers(0, 4, 3000), np.zeros(3000)], axis=1).astype(np.float32)
    ranks = [np.array([0, 17, 1500, 2999]), np.array([750, 751]), np.array([2999])]
    got = blocks.order_statistics(spark.sparkContext.parallelize([x[:1000], x[1000:1001], x[1001:]], 3), ranks)
    for column, asked, values in zip(x.T, ranks, got, strict=True):
        assert (np.sort(column)[asked] == values).all()


def test_op6_learns_from_every_labelled_document(spark):
    docs, labels, rows = corpus(spark, 7000)
    x = np.array([docstats.measure(r["text"].encode())[1] for r in rows], dtype=np.float32).astype(np.float64)
    y = np.array([r["quality"] for r in rows], dtype=np.float64)
    whole = boosted_rules.boost(x, y, {docstats.FEATURES.index(n): way for n, way in boosted_rules.MONOTONE.items()})
    own = boosted_rules.train(docs, labels)
    assert np.abs(own.raw(x) - whole.raw(x)).max() < 1e-9
    assert (own.raw(x)[y == 1] < own.threshold).mean() <= 0.005


def test_op7_minimises_the_loss_of_all_pairs(spark):
    """The slope of the exact loss, over every pair of a good and a bad document, vanishes at the learned weights."""
    docs, labels, rows = corpus(spark, 900)
    held = {r["doc_id"] for r in docs.where(common.fold("doc_id", 3) == 1).collect()}
    rows = [r for r in rows if r["doc_id"] not in held]
    x = np.array([docstats.measure(r["text"].encode())[1] for r in rows], dtype=np.float32).astype(np.float64)
    y = np.array([r["quality"] for r in rows])
    ranker = bt_quality.train(docs, labels)
    wide = ranker.expand(x)
    strength = wide @ ranker.weights
    lose = 1 / (1 + np.exp(strength[y == 1][:, None] - strength[y == 0][None, :]))
    slope = lose.mean(axis=0) @ wide[y == 0] / (y == 0).sum() - lose.mean(axis=1) @ wide[y == 1] / (y == 1).sum()
    assert np.abs(slope + bt_quality.RIDGE * ranker.weights).max() < 2e-5
    assert (strength < ranker.threshold).sum() <= (y == 0).sum() <= (strength <= ranker.threshold + 1e-6).sum()
