"""Repeated rows, null keys, replays and steady users: answers that hold beyond tidy tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import context, dedup, geo, outcomes, scoring
from tidemark.plans import jobs
from tidemark.streaming.dedup import upsert_sink


def test_one_of_exactly_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (1, "A b ", "y"), (2, "a b", "x"), (3, "c", "z"), (4, None, None), (4, None, None)], "id int, text string, w string")
    got = sorted(map(tuple, dedup.first_per_text(rows, ["id"]).collect()), key=str)
    assert got == [(1, "A b ", "y"), (3, "c", "z"), (4, None, None)]


def test_places_that_meet_after_normalising(spark):
    rows = spark.createDataFrame([(1, ["Usa"])], "id int, places array<string>")
    mapping = spark.createDataFrame([("USA", "US"), ("usa ", "US")], "raw_value string, normalized string")
    children = spark.createDataFrame([("US", "x"), ("US", "x")], "parent string, child string")
    assert [r["geo"] for r in geo.expand_geo(rows, mapping, children, "id", "places")[0].collect()] == [["US", "x"]]


def test_payment_without_aliases(spark):
    rows = spark.createDataFrame([(1, ["Pix", "CARD"])], "id int, methods array<string>")
    options = spark.createDataFrame([("pix", None), ("card", ["visa"])], "token string, aliases array<string>")
    tokens, unknown = geo.payment_tokens(rows, options, "id", "methods")
    assert tokens.first()["tokens"] == ["pix", "card"] and unknown.count() == 0
    places = spark.createDataFrame([("pix", ["BR"]), ("pix", ["BR", "PT"])], "token string, countries array<string>")
    assert geo.append_implied(rows.select("id", F.array(F.lit("DE")).alias("geo")), tokens, places, "id").first()["geo"] == ["DE", "BR", "PT"]


def test_repeated_names_and_replies_multiply_nothing(spark):
    messages = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "message_id int, group_id int")
    names = spark.createDataFrame([(7, "g"), (7, "g"), (8, "h")], "group_id int, name string")
    priors = spark.createDataFrame([("g", {"a": 0.5}, 10, "high"), ("g", {"a": 0.7}, 20, "high"), ("h", {"a": 0.1}, 5, "low")], "group string, distribution map<string,double>, total_n int, confidence string")
    got = {r["message_id"]: r["total_n"] for r in context.group_prior(messages, names, priors).collect()}
    assert got == {1: 20, 2: None, 3: None} and context.group_prior(messages, names, priors).count() == 3
    replies = spark.createDataFrame([(1, "s", "old", 1), (1, "s", "new", 2), (1, "t", "x", 3)], "message_id int, stage string, raw string, at int")
    assert [(r["message_id"], r["raw"]) for r in scoring.ReplayScorer(replies).score(messages, "s").orderBy("message_id").collect()] == [(1, "new"), (2, None), (3, None)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_replayed_batches_change_nothing(spark, tmp_path, buckets):
    path = str(tmp_path / "t")
    merge = upsert_sink(path, ["k"], ["v"], buckets=buckets)
    batches = [spark.createDataFrame(rows, "k int, v int") for rows in ([(1, 1), (None, 2), (None, 2), (3, 3)], [(1, 5), (None, 2), (4, 4)])]
    state = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()), key=str)
    merge(batches[0], 0)
    first = state()
    merge(batches[0], 0)
    assert state() == first == [(1, 1), (3, 3), (None, 2), (None, 2)]
    merge(batches[1], 1)
    second = state()
    merge(batches[1], 1)
    assert state() == second == [(1, 5), (3, 3), (4, 4), (None, 2), (None, 2), (None, 2)]


def test_appending_twice_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (None, "d")], "k int, v string")
    path = str(tmp_path / "log")
    assert [outcomes.append_new(rows, path, "k") for _ in range(2)] == [4, 0]
    assert outcomes.append_new(rows.unionByName(spark.createDataFrame([(9, None), (None, "e")], "k int, v string")), path, "k") == 2


def test_stream_writes_scam_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "message_id bigint, text string, at int"
    spark.createDataFrame([(1, "fine", 1), (2, "a scam", 2), (3, None, 3)], kind).write.parquet(source)
    stream = spark.readStream.schema(kind).parquet(source)
    step = lambda f, _: f.withColumns({"verdict": F.lit("REAL"), "n": F.length("text")})
    jobs.serve(stream, [step], upsert_sink(out, ["message_id"], ["at"]), str(tmp_path / "c"), scam=F.contains("text", F.lit("scam"))).awaitTermination()
    assert sorted((r["message_id"], r["verdict"], r["n"]) for r in spark.read.parquet(out).select("message_id", "verdict", "n").na.fill(-1, ["n"]).collect()) == [(1, "REAL", 4), (2, "SCAM", -1), (3, "REAL", -1)]


# the per-user fold --------------------------------------------------------------------------


def fold(rows, hold, window):
    told, last = {}, {}
    for user, at, name, text in sorted(rows):
        held = last.get(user)
        if held and at - held[0] < hold:
            told[name] = "hold"
        elif held and held[1] == text and at - held[0] < window:
            told[name] = "text"
        else:
            told[name], last[user] = "keep", (at, text)
    return told


@pytest.mark.parametrize(("hold", "window", "chunk"), [(180, 86400, 50), (0, 30, 13), (50, 20, 9)])
def test_user_dedup_against_the_fold(spark, hold, window, chunk):
    pick = random.Random(hold)
    rows = []
    for user in range(8):
        at = 0
        for _ in range(pick.choice([1, 3, 40, 200])):
            at += pick.choice([0, 1, 3, 9, 30, 100, 1000])
            rows.append((user, at, len(rows) * 7 % 10007, pick.choice("abc")))
    rows += [(99, k * 20, 20_000 + k, "x") for k in range(300)]
    frame = spark.createDataFrame(rows, "u bigint, at bigint, id bigint, t string").repartition(3)
    got = {r["id"]: r["verdict"] for r in dedup.user_dedup(frame, "id", "u", "t", "at", hold, window, chunk).collect()}
    assert got == fold(rows, hold, window)


def test_a_steady_user_is_many_parts(spark):
    """200,000 messages 100 seconds apart: no part over 10,000 rows, and the fold's answer."""
    rows = spark.range(200_000).select(F.lit(5).alias("u"), (F.col("id") * 100).alias("at"), "id", F.when(F.col("id") % 1000 < 900, "same").otherwise(F.col("id").cast("string")).alias("t"))
    ranked = dedup._ranked(rows.select(F.col("u").alias("user"), "at", "id", F.md5(F.col("t").cast("binary")).alias("hash")), 5000)
    assert ranked.groupBy("part").count().agg(F.max("count")).first()[0] <= 10_000
    made = dedup.user_dedup(rows, "id", "u", "t", "at", chunk_rows=5000).toPandas()
    texts = ["same" if i % 1000 < 900 else str(i) for i in range(200_000)]
    want = fold([(5, i * 100, i, t) for i, t in enumerate(texts)], dedup.HOLD_SECONDS, dedup.WINDOW_SECONDS)
    assert dict(zip(made["id"].tolist(), made["verdict"].tolist(), strict=True)) == want
