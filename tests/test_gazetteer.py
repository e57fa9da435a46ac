"""The automaton and the containment join against plain searches."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tidemark.operators import gazetteer, mining


def occurrences(text, forms):
    return sorted((i + len(f) - 1, n) for n, f in enumerate(forms) for i in range(len(text)) if text.startswith(f, i))


def test_automaton_finds_every_occurrence():
    random = np.random.default_rng(1)
    forms = list(dict.fromkeys(["a", "ab", "abab", "bab", "b b", "éa", "🙂", *("".join(random.choice(list("abé "), random.integers(1, 9))) for _ in range(60))]))
    made = gazetteer.Automaton(forms)
    for size in (0, 1, 7, 511, 512, 513, 2000):
        text = "".join(random.choice(list("abé 🙂z"), size))
        ends, which = made.find(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
        assert sorted(zip(ends.tolist(), which.tolist(), strict=True)) == occurrences(text, forms)


def test_automaton_time_does_not_grow_with_the_forms():
    random = np.random.default_rng(2)
    words = ["".join(random.choice(list("abcdefghij"), 8)) for _ in range(10_000)]
    text = np.frombuffer(" ".join(random.choice(words, 40_000)).encode("utf-32-le"), dtype=np.uint32)
    seconds = []
    for many in (100, 10_000):
        made = gazetteer.Automaton(list(dict.fromkeys(words[:many])))
        began = time.perf_counter()
        made.find(text)
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 8 * seconds[0] + 0.5  # a hundred times the forms, and a hundred times the hits


@pytest.mark.parametrize("table_bytes", [64 << 20, 20_000])
def test_join_against_plain_search(spark, table_bytes):
    random = np.random.default_rng(3)
    entries = [{"canonical": f"t{i}", "forms": ["".join(random.choice(list("abC"), random.integers(1, 5))) for _ in range(3)], "category": "c"} for i in range(80)]
    entries.append({"canonical": "odd", "forms": ["é!", "(x)"], "category": "c"})
    texts = [(i, " ".join("".join(random.choice(list("abcA"), random.integers(1, 6))) for _ in range(random.integers(0, 12)))) for i in range(200)]
    texts += [(900, None), (901, ""), (902, "xé!x (X)"), (903, "ab"), (903, "ab"), (None, "ab " * 5000)]
    frame = spark.createDataFrame(texts, "id bigint, text string").selectExpr("id", "text", "'x' AS term", "1 AS at")
    got = sorted(map(tuple, gazetteer.form_hits(frame.repartition(3), gazetteer.forms_of(spark, entries), ["id"], table_bytes=table_bytes).select("id", "term", "form").collect()), key=str)

    def held(low, form):
        form = form.lower()
        plain = all(c.isascii() and (c.isalnum() or c in "_.+ /-") for c in form)
        spots = [i for i in range(len(low)) if low.startswith(form, i)]
        touch = lambda c: c.isascii() and c.isalnum()
        return any(not plain or (not touch(low[i - 1 : i] or " ") and not touch(low[i + len(form) : i + len(form) + 1] or " ")) for i in spots)

    want = []
    for i, text in texts:
        for e in entries:
            form = next((f for f in e["forms"] if held((text or "").lower(), f)), None)
            if form is not None:
                want.append((i, e["canonical"], form))
    assert got == sorted(want, key=str)


def test_join_edges(spark):
    texts = spark.createDataFrame([(1, "Ab"), (2, None)], "id bigint, text string")
    assert gazetteer.form_hits(texts, gazetteer.plain_forms(spark, ["zz"]).limit(0), ["id"]).count() == 0
    bad = spark.createDataFrame([(None, "k", "a", 0, True), ("t", "k", None, 1, True), ("t", "k", "", 2, True), ("t", "k", "AB", 3, True)], gazetteer.FORMS)
    assert [r["form"] for r in gazetteer.form_hits(texts, bad, ["id"]).collect()] == ["AB"]
    assert gazetteer.form_hits(texts.limit(0), bad, ["id"]).count() == 0
    assert mining.phrase_backfill(texts, ["b", "B", "zz"], "id").count() == 2
