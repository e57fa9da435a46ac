"""Sessions and sliding windows: streams with late rows against loops over the rows that count."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidemark.streaming import windows

SCHEMA = "id bigint, user string, at timestamp"


def _streamed(spark, tmp_path, files, made):
    """Runs ``made`` over a stream of one file a batch; minutes become times."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n, rows in enumerate(files):
        path = folder / f"{n}.json"
        path.write_text("\n".join(f'{{"id": {i}, "user": {f"{chr(34)}{u}{chr(34)}" if u else "null"}, "at": "2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z"}}' for i, (u, m) in enumerate(rows)))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    out = str(tmp_path / "out")
    run = made(source).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out)


def _minutes(column):
    return ((F.unix_timestamp(column) - 1704067200) / 60).cast("int")


def _flat(df):
    return sorted(map(tuple, df.select("user", _minutes("began").alias("b"), _minutes("ended").alias("e"), "messages").collect()))


def test_sessions_of_a_table(spark):
    rows = [("a", 0), ("a", 30), ("a", 61), ("a", 61), ("b", 5), (None, 6)]
    df = spark.createDataFrame([(u, m) for u, m in rows], "user string, m int").withColumn("at", F.timestamp_seconds(F.lit(1704067200) + F.col("m") * 60))
    df = df.unionByName(spark.createDataFrame([("a", None)], "user string, m int").withColumn("at", F.lit(None).cast("timestamp")))
    assert _flat(windows.sessions(df, "user", "at")) == [("a", 0, 30, 2), ("a", 61, 61, 2), ("b", 5, 5, 1)]
    assert windows.sessions(df.limit(0), "user", "at").count() == 0


def test_sessions_close_once_and_take_rows_within_the_delay(spark, tmp_path):
    files = [[("a", 0), ("a", 50), ("b", 10), (None, 3)], [("a", 70), ("a", 25)], [("c", 200)], [("c", 150)], [("a", 20)], [("z", 400)]]
    # a's 25 comes late but within the delay and merges 0, 50 and 70; its 20 comes after the session was written
    made = _streamed(spark, tmp_path, files, lambda s: windows.sessions(s, "user", "at"))
    assert _flat(made) == [("a", 0, 70, 4), ("b", 10, 10, 1), ("c", 150, 150, 1), ("c", 200, 200, 1)]


def test_sliding_windows_close_once(spark, tmp_path):
    files = [[("a", 10), ("a", 70), ("b", 70)], [("a", 50)], [("a", 300)], [("b", 290)], [("a", 100)], [("z", 900)]]
    measures = {"n": F.count(F.lit(1)), "last": F.max("id")}
    made = _streamed(spark, tmp_path, files, lambda s: windows.sliding(s, "at", ["user"], measures, "2 hours", "1 hour"))
    kept = [("a", 10), ("a", 70), ("b", 70), ("a", 50), ("a", 300), ("b", 290)]  # a's 100 comes after its windows were written
    expected = {}
    for user, m in kept:
        for start in (m // 60 * 60, m // 60 * 60 - 60):
            expected[user, start] = expected.get((user, start), 0) + 1
    got = {(r["user"], r["s"]): r["n"] for r in made.select("user", _minutes("start").alias("s"), "n").collect()}
    assert got == expected
