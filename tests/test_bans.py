"""The live ban list over micro-batches and a restart, against a fold in arrival order."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import bans

MESSAGES = "id bigint, username string, at timestamp, generation string, price double, tags array<string>"


def _clock(minute):
    return None if minute is None else f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000123Z"


def _put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number}.json"
    path.write_text("\n".join(map(json.dumps, rows)))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def _fold(batches):
    """id -> banned, one batch after the other, within a batch by time."""
    held, made = {}, {}
    for messages, changes in batches:
        rows = [(m[2] is None, m[2] or 0, 1, 0, False, m) for m in messages] + [(False, c[3], 0, c[2], c[1], c) for c in changes if None not in c]
        for _, _, message, generation, ban, row in sorted(rows, key=lambda r: r[:5]):
            name = row[1] if message else row[0]
            if message:
                made[row[0]] = name is not None and held.get(name, (0, False))[1]
            elif generation >= held.get(name, (generation, False))[0]:
                held[name] = (generation, ban)
    return made


BATCHES = [
    ([(1, "ann", 5), (2, "ann", 10), (3, "bob", 10), (4, None, 10), (5, "ann", None)], [("ann", True, 1, 10), ("cy", True, 1, 0)]),
    ([(6, "ann", 3), (7, "bob", 20), (8, "cy", 21), (9, "Cy", 21)], [("bob", True, 2, 20), ("cy", False, 2, 21)]),
    ([(10, "cy", 40), (11, "bob", 29), (12, "ann", 31), (13, "bob", None)], [("cy", True, 1, 35), ("bob", False, 3, 30), (None, True, 3, 30), ("ann", False, 3, 31), ("ann", True, 3, 31)]),
    ([(14, "ann", 50), (15, "bob", 50), (16, "cy", 50)], [("dee", True, 4, 50)]),
]


@pytest.mark.parametrize("spread", [1, 5])
def test_order_and_restart(spark, tmp_path, spread):
    def run():
        made = [spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / name)) for name, schema in (("messages", MESSAGES), ("changes", bans.CHANGES))]
        flagged = bans.flag_banned(*made, "username", "at", spread)
        out = flagged.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        out.trigger(availableNow=True).start().awaitTermination()

    for n, (messages, changes) in enumerate(BATCHES):
        _put(tmp_path / "messages", n, [{"id": i, "username": u, "at": _clock(m), "generation": "x", "price": 0.1, "tags": ["a", None]} for i, u, m in messages])
        _put(tmp_path / "changes", n, [{"username": u, "banned": b, "generation": g, "at": _clock(m)} for u, b, g, m in changes])
        if n in (1, 3):  # a new query, from the checkpoint
            run()
    got = spark.read.parquet(str(tmp_path / "out"))
    rows = got.collect()
    assert {r["id"]: r["banned"] for r in rows} == _fold(BATCHES) and len(rows) == 16
    assert all((r["generation"], r["price"], r["tags"]) == ("x", 0.1, ["a", None]) for r in rows)
    assert got.where((F.unix_micros("at") % 1_000_000) == 123).count() == 14 and got.columns == [*[f.split()[0] for f in MESSAGES.split(", ")], "banned"]


def test_reload_changes(spark):
    old, new = (spark.createDataFrame([(n,) for n in names], "username string") for names in (["a", "b", "b", None], ["b", "c", "c", None]))
    made = bans.reload_changes(old, new, 7, F.timestamp_seconds(F.lit(60)))
    assert dict(made.dtypes) == dict(zip(*[iter(bans.CHANGES.replace(",", "").split())] * 2))  # noqa: B905
    assert sorted((r["username"], r["banned"], r["generation"]) for r in made.collect()) == [("a", False, 7), ("b", True, 7), ("c", True, 7)]
    assert made.count() == 3 and bans.reload_changes(old, new.limit(0), 8, F.current_timestamp()).where("banned").count() == 0
