"""Author history as of each message against a plain loop."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators import classifiers, context


def _plain(messages, history, last, cap):
    out = []
    for m in messages:
        said = [(-at, text[:cap]) for user, at, text in history if user is not None and at is not None and text and user == m[1] and m[2] is not None and at < m[2]]
        out.append((*m, [text for _, text in sorted(said)[:last]]))
    return sorted(map(str, out))


def test_history_as_of_equals_a_loop(spark):
    draw = random.Random(5)
    users = ["hot"] * 12 + ["a", "b", None, "quiet"]
    moment = lambda: None if draw.random() < 0.05 else draw.randrange(120)
    history = [(draw.choice(users[:-1]), moment(), draw.choice(["", None, "x" * 30, "same", f"t{i}"])) for i in range(260)] + [("hot", 50, "copy")] * 40
    messages = [(i % 170, draw.choice(users), moment(), f"m{i}", i) for i in range(200)] + [(0, "hot", 51, "again", 0)] * 3
    told = spark.createDataFrame(history, "user string, at bigint, text string")
    asked = spark.createDataFrame(messages, "part bigint, user string, at bigint, row string, rank bigint")  # names that the operator uses inside
    for last, cap, chunk in ((10, 3000, 200_000), (10, 3000, 9), (3, 20, 25), (1, 2, 4)):
        made = context.history_as_of(asked, told, "user", "at", last=last, cap=cap, chunk_rows=chunk)
        assert made.columns == [*asked.columns, "earlier"]
        assert sorted(str(tuple(r)) for r in made.collect()) == _plain(messages, history, last, cap)


def test_no_history_and_no_messages(spark):
    told = spark.createDataFrame([("a", 1, "x")], "user string, at bigint, text string")
    assert [r["earlier"] for r in context.history_as_of(told, told.limit(0), "user", "at").collect()] == [[]]
    assert context.history_as_of(told.limit(0), told, "user", "at").count() == 0


def test_messages_see_only_what_was_stored_before(spark):
    stored = spark.createDataFrame([("a", 1, "one"), ("a", 2, "two"), ("a", 3, "three")], "username string, created_at bigint, text string")
    asked = spark.createDataFrame([("a", 3, " now "), ("a", 1, "first"), (None, 9, "nobody"), ("a", 9, None)], "username string, created_at bigint, text string")
    made = classifiers.with_author_texts(asked, stored, as_of=True)
    got = {(r["username"], r["created_at"]): r["combined"].split("\n\n---\n\n") for r in made.collect()}
    assert got == {("a", 3): ["now", "two", "one"], ("a", 1): ["first"], (None, 9): ["nobody"], ("a", 9): ["three", "two", "one"]}
    everything = classifiers.with_author_texts(asked, stored).where(F.col("created_at") == 1).first()
    assert everything["combined"].split("\n\n---\n\n") == ["first", "three", "two", "one"]
