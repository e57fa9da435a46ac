"""Text vectors and the inverted file against comparison with every row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import retrieve, textindex
from tidemark.session import table


def test_vectors_of_texts(spark):
    rows = spark.createDataFrame([(1, "the same words here"), (2, "here same THE words"), (3, "the same word here"), (4, "quite other things"), (5, None), (6, " \n"), (7, "a " * 30_000)], "id int, text string")
    got = {r["id"]: r["v"] for r in textindex.with_vectors(rows, vector="v").collect()}
    assert got[5] is None and got[6] is None
    v = {i: np.array(x) for i, x in got.items() if x is not None}
    assert all(abs(np.linalg.norm(x) - 1) < 1e-5 for x in v.values())
    assert np.allclose(v[1], v[2]) and v[1] @ v[3] > 0.7 > 0.4 > abs(v[1] @ v[4])


@pytest.mark.parametrize("list_rows", [50_000, 60])
def test_index_recall(spark, small, tmp_path, list_rows):
    """With all lists probed the answer is that of comparing all rows; with a few of them recall stays at 0.9."""
    random = np.random.default_rng(4)
    centres = random.normal(size=(30, 16))
    points = centres[random.integers(30, size=1500)] + 0.35 * random.normal(size=(1500, 16))
    rows = spark.createDataFrame([(i, int(random.integers(3)), p.tolist()) for i, p in enumerate(points)], "vec_id bigint, label int, embedding array<double>")
    textindex.build_index(rows, str(tmp_path / "i"), "vec_id")
    indexed, centroids = textindex.load_index(spark, str(tmp_path / "i"))
    assert indexed.count() == 1500 and 20 <= len(centroids) <= 40
    asked = rows.where("vec_id % 20 = 0")
    whole = {(r["query_id"], r["label"], r["vec_id"]) for r in retrieve.nearest_of_all(rows, asked, per_label=6).collect() if r["query_id"] != r["vec_id"]}
    best = {k for k in whole}
    for probes, least in ((len(centroids), 1.0), (8, 0.9)):
        found = textindex.search(indexed, centroids, asked, per_label=5, probes=probes, key="vec_id", list_rows=list_rows).collect()
        got = {(r["query_id"], r["label"], r["vec_id"]) for r in found}
        assert len(got) == len(found)
        if least == 1.0:
            assert got <= best and len(got) == 75 * 15
            exact = got
        assert len(got & exact) >= least * len(exact)


def test_index_of_texts_finds_near_copies(spark, small):
    """Every document's nearest neighbour of all is also the index's, nine times in ten."""
    docs = textindex.with_vectors(table(spark, small, "documents").select("doc_id", "text")).withColumn("label", F.lit("x")).where("embedding is not null")
    centroids = textindex.fitted_centroids(docs, "doc_id", "embedding")
    indexed = textindex.assigned(docs, centroids).withColumn("list", F.get("lists", F.lit(0)))
    few = textindex.search(indexed, centroids, docs, per_label=1, probes=8, key="doc_id").select("query_id", "distance").collect()
    all_ = textindex.search(indexed, centroids, docs, per_label=1, probes=len(centroids), key="doc_id").select("query_id", "distance").collect()
    want = {r["query_id"]: r["distance"] for r in all_}
    assert np.mean([abs(r["distance"] - want[r["query_id"]]) < 1e-6 for r in few]) >= 0.9


def test_edges_and_blocks(spark):
    kind = "message_id bigint, label boolean, text string"
    rows = spark.createDataFrame([(1, True, "buy one card"), (2, False, "hello there"), (2, False, "hello there"), (3, None, "buy a card"), (4, True, None), (None, True, "buy cards")], kind)
    vectors = textindex.with_vectors(rows)
    centroids = textindex.fitted_centroids(vectors, "message_id", "embedding")
    indexed = textindex.assigned(vectors, centroids).withColumn("list", F.get("lists", F.lit(0)))
    asked = textindex.with_vectors(spark.createDataFrame([(9, True, "buy one card"), (10, None, ""), (None, None, "x")], kind))
    found = textindex.search(indexed, centroids, asked, probes=10)
    assert {(r["query_id"], r["label"], r["message_id"], r["rank"]) for r in found.collect()} >= {(9, True, 1, 1), (9, False, 2, 1), (9, None, 3, 1)}
    block = textindex.few_shot_blocks(found.where("label"), rows.where("message_id = 1")).first()["block"]
    assert block.startswith("SIMILAR EXAMPLES:") and "LEAD:\n  1. buy one card" in block
    empty = textindex.fitted_centroids(vectors.limit(0), "message_id", "embedding")
    assert empty.shape == (0, 0) or len(empty) == 0
