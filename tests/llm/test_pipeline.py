"""The pipeline's stages against their operators and brute force."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tidemark.llm import simhash_vp, spaced_seed, subword_lid, temperature_mix, weak_pii


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, small).cache()
        assert docs.columns == before.columns
        ids, held = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in before.collect()}
        if name == "language_id":
            rejected = {r["doc_id"] for r in subword_lid.identify(before, subword_lid.train(before)).where("rejected").collect()}
            assert ids == held - rejected
        elif name == "near_dedup":
            assert ids == {r["component_id"] for r in simhash_vp.near_duplicates(before).collect()} and len(ids) < len(held)
        elif name == "decontaminate":
            assert ids == held - {r["doc_id"] for r in spaced_seed.contamination(before, bench).collect()} and len(ids) < len(held)
        else:
            assert ids == held
            assert sum(weak_pii.detect(before).agg({f"n_{k}": "sum" for k in weak_pii.KINDS}).first()) > 0
            assert sum(weak_pii.detect(docs).agg({f"n_{k}": "sum" for k in weak_pii.KINDS}).first()) == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    direct = Counter(tuple(r) for r in temperature_mix.mix(docs).collect())
    assert Counter(tuple(r) for r in mixed.drop("text", "lang").collect()) == direct
    said = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    assert all(said[r["doc_id"]] == (r["text"], r["lang"]) for r in mixed.collect())
    assert {r[0] for r in direct} <= {r["doc_id"] for r in docs.collect()}


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and {"position", "text"} <= set(out.columns)
    assert not any("@mail" in (r["text"] or "") for r in out.collect())


EDGE = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \n ", "en", None), (4, "The one and only text of this kind, in words.", "en", "b"), (4, "The one and only text of this kind, in words.", "en", "b"),
    (None, "Another text of words that has no id at all.", "en", None), (7, "word " * 30_000, "en", "a"), (8, "mail x@example.com now, please do", "en", "a"), (9, "12 34 !!", "de", "c"),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_edge_rows_and_empty_tables(spark, small, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    names = ("component_id", "rejected", "found", "n_tokens", "__key", "class", "row", "position")
    kind = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in EDGE], kind)
    rows = stage(spark, docs, small).collect()
    kept = Counter(r["doc_id"] for r in rows)
    if name == "mixture":
        assert kept.keys() <= {r[0] for r in EDGE} and {"text", "lang", "position"} <= set(rows[0].asDict())
    else:
        assert list(rows[0].asDict()) == docs.columns and all(r["class"] == names.index("class") for r in rows)
    wanted = {
        "language_id": lambda: not {1, 2, 3, 9} & set(kept) and kept[4] in (0, 2),
        "near_dedup": lambda: kept == Counter({1: 1, 4: 1, None: 1, 7: 1, 8: 1, 9: 1}),
        "decontaminate": lambda: kept == Counter(r[0] for r in EDGE),
        "personal_data": lambda: kept == Counter(r[0] for r in EDGE) and {r["text"] for r in rows if r["doc_id"] == 8} == {"mail [EMAIL] now, please do"},
        "mixture": lambda: kept[4] in (0, 2, 4, 6, 8),
    }
    assert wanted[name]()
    assert stage(spark, docs.limit(0), small).count() == 0
