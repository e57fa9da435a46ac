"""Leads and verdicts judged a micro-batch at a time, with what waits in a table."""

from __future__ import annotations

import os
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tests.test_verdicts import LEADS, SAID, SCHEMAS, _clock, _expected, _flat, _line
from tidemark.plans import catalogue
from tidemark.session import shared_dir
from tidemark.streaming.verdicts import judged_in_batches


def _fields(kind, row):
    if kind == "leads":
        return {"id": row[0], "at": None if row[1] is None else _clock(row[1]), "extra": "e"}
    return {"id": row[0], "then": _clock(row[1]), "verdict": row[2], "at": "clash"}


def _judged(spark, folder, batches, delay):
    """Runs the streams of one file a batch as far as they go, again at each call; the rows written so far."""
    sources = {}
    for kind, files in batches.items():
        (folder / kind).mkdir(exist_ok=True)
        for n, rows in enumerate(files):
            path = folder / kind / f"{n}.json"
            path.write_text("\n".join(_line(_fields(kind, r)) for r in rows))
            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        sources[kind] = spark.readStream.schema(SCHEMAS[kind]).option("maxFilesPerTrigger", 1).json(str(folder / kind))
    made = judged_in_batches(sources["leads"], sources["said"], "id", "at", "then", lambda rows, n: rows.write.mode("overwrite").parquet(f"{folder}/out/{n}"), f"{folder}/waiting", delay=delay)
    made.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out/*")


@pytest.mark.parametrize("turned", [False, True])
def test_batches_out_of_order_give_the_answer_of_tables_and_a_replay_adds_nothing(spark, tmp_path, turned):
    batches = {"leads": [LEADS[:4], LEADS[4:8]], "said": [SAID[6:11], SAID[:6]]}
    if turned:
        batches = {k: v[::-1] for k, v in batches.items()}
    batches["leads"].append([*LEADS[8:], (8, 1000)])
    batches["said"].append([SAID[11], (8, 1000, "open")])
    closed = [r for r in _expected(LEADS, SAID) if r[1] + 60 < 1000 - 120]
    assert _flat(_judged(spark, tmp_path, batches, "2 hours")) == closed and len(closed) == 7
    waiting = spark.read.parquet(f"{tmp_path}/waiting/2")
    assert sorted(map(tuple, waiting.select("__k", "__lead").collect())) == [(8, False), (8, True)]
    (tmp_path / "state" / "commits" / "2").unlink()
    (tmp_path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert _flat(_judged(spark, tmp_path, batches, "2 hours")) == closed


def test_many_batches_close_each_lead_once(spark, tmp_path):
    """Rows come up to the delay late, copies of a lead in different batches; a lead on the very edge of the watermark still waits."""
    draw = random.Random(7)
    leads, said = [[] for _ in range(6)], [[] for _ in range(6)]
    for n in range(6):
        for _ in range(20):
            leads[n].append((draw.randrange(12), n * 100 + 60 - draw.randrange(60)))
            said[n] += [(draw.randrange(12), n * 100 + 60 - draw.randrange(60), draw.choice("abc")) for _ in range(3)]
    for n in range(6):
        leads[n].append((90 + n, n * 100 + 60))
        said[n].append((90 + n, n * 100 + 60, "last"))
    leads[5] += [(50, 440), (51, 439)]
    leads[3].append((60, 340))
    leads[4].append((60, 340))
    last = 560 - 60
    every = _expected(sum(leads, []), sum(said, []))
    closed = [r for r in every if r[1] + 60 < last]
    got = _flat(_judged(spark, tmp_path, {"leads": leads, "said": said}, "1 hour"))
    assert got == closed
    assert (51, 439, "REVIEW", 0) in got and (50, 440, "REVIEW", 0) not in got


def test_late_rows_are_dropped_and_nothing_closes_without_a_watermark(spark, tmp_path):
    batches = {"leads": [[(1, 0), (2, 500)], [(3, 5)], [(1, 0), (4, 430)]], "said": [[], [(2, 500, "x")], [(1, 9, "late"), (4, 431, "in"), (9, 600, "z")]]}
    got = _flat(_judged(spark, tmp_path, batches, "10 minutes"))
    # the first batch has no verdict and so no watermark; the second closes 1 and 3; the third's copy of 1 and its verdict are late
    assert got == [(1, 0, "REVIEW", 0), (3, 5, "REVIEW", 0)]


def test_the_query_keeps_what_waits_out_of_the_state(spark, small):
    held = pathlib.Path(shared_dir(spark))
    before = set(held.rglob("stream-*"))
    made = catalogue.QUERIES["judged_within_wait_stream"](spark, small)
    [run] = set(held.rglob("stream-*")) - before
    assert not (run / "state" / "state").exists()
    kept, orders = spark.read.parquet(f"{run}/waiting/0"), spark.read.parquet(f"{small}/orders.parquet")
    assert 0 < kept.where("__lead").count() == orders.count() - made.count() < orders.count()
    last = orders.agg(F.max("o_orderdate").cast("timestamp").alias("last"))
    assert kept.join(last, F.expr("__at + interval 30 days < last - interval 36 hours")).isEmpty()
