"""Leads and verdicts that arrive out of order: the stream gives what the table gives."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.verdicts import judged_within

SCHEMAS = {"leads": "id bigint, at timestamp, extra string", "said": "id bigint, then timestamp, verdict string, at string"}


def _clock(minute):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"


def _line(fields):
    return "{" + ", ".join(f'"{k}": {v if isinstance(v, int) else "null" if v is None else chr(34) + v + chr(34)}' for k, v in fields.items()) + "}"


def _expected(leads, said, wait=60):
    made = []
    for key, at in {x for x in leads if None not in x}:
        copies = leads.count((key, at))
        met = sorted((t, v) for k, t, v in said if k == key and v is not None and t is not None and at <= t <= at + wait)
        made.append((key, at, met[-1][1] if met else "REVIEW", copies * len(met)))
    return sorted(made)


def _flat(df):
    return sorted(map(tuple, df.select("id", ((F.unix_timestamp("at") - 1704067200) / 60).cast("int").alias("m"), "verdict", "verdicts").collect()))


LEADS = [(1, 0), (2, 5), (3, 10), (3, 10), (4, 20), (4, 30), (5, 40), (None, 3), (6, None), (7, 600)]
SAID = [(1, 10, "a"), (1, 60, "b"), (1, 61, "c"), (2, 4, "early"), (3, 15, "x"), (3, 15, "y"), (4, 25, "one"), (4, 85, "two"), (5, 50, None), (None, 3, "n"), (9, 9, "none"), (7, 601, "z")]


def _table(spark, kind, rows):
    if kind == "leads":
        text = spark.createDataFrame([(k, None if m is None else _clock(m), "e") for k, m in rows], "id bigint, at string, extra string")
        return text.withColumn("at", F.to_timestamp("at"))
    text = spark.createDataFrame([(k, _clock(m), v, "clash") for k, m, v in rows], "id bigint, then string, verdict string, at string")
    return text.withColumn("then", F.to_timestamp("then"))


def test_of_tables(spark):
    leads, said = _table(spark, "leads", LEADS), _table(spark, "said", SAID)
    assert _flat(judged_within(leads, said, "id", "at", "then")) == _expected(LEADS, SAID)
    assert _flat(judged_within(leads, said.limit(0), "id", "at", "then")) == _expected(LEADS, [])
    assert judged_within(leads.limit(0), said, "id", "at", "then").count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_batches_out_of_order_give_the_batch_answer(spark, tmp_path, turned):
    """Verdicts before their leads, leads last, and a later file that moves the watermarks past all waits but the last."""
    batches = {"leads": [LEADS[:4], LEADS[4:8]], "said": [SAID[6:11], SAID[:6]]}
    if turned:
        batches = {k: v[::-1] for k, v in batches.items()}
    batches["leads"].append([*LEADS[8:], (8, 1000)])
    batches["said"].append([SAID[11], (8, 1000, "open")])
    sources = {}
    for kind, files in batches.items():
        folder = tmp_path / kind
        folder.mkdir()
        for n, rows in enumerate(files):
            fields = [{"id": r[0], "at": None if r[1] is None else _clock(r[1]), "extra": "e"} if kind == "leads" else {"id": r[0], "then": _clock(r[1]), "verdict": r[2], "at": "clash"} for r in rows]
            path = folder / f"{n}.json"
            path.write_text("\n".join(map(_line, fields)))
            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        sources[kind] = spark.readStream.schema(SCHEMAS[kind]).option("maxFilesPerTrigger", 1).json(str(folder))
    made = judged_within(sources["leads"], sources["said"], "id", "at", "then", delay="2 hours")
    out = str(tmp_path / "out")
    made.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    closed = [r for r in _expected(LEADS, SAID) if r[1] + 60 < 1000 - 120]
    assert _flat(spark.read.parquet(out)) == closed and len(closed) == 7
