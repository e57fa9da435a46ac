"""Prefix trie, hard negatives and MinHash against brute force, and on edge rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, oph_minhash, prefix_trie
from tidemark.session import cut

DOCS = "doc_id bigint, text string, lang string, c bigint, bucket string, name string, n string"


# 11 --------------------------------------------------------------------------------------


def digest_order(spark, turns):
    """Turns (conv, turn, role, text) in the operator's order: null turns first, ties by digest."""
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    said = [F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    keyed = rows.select("conv_id", "turn", *prefix_trie._digests(*said), said[0].alias("role"), said[1].alias("text")).collect()
    return sorted(keyed, key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["a"], r["b"]))


def brute_trie(turns, block=None, most=None):
    """Node rows of rebuilt conversations, from dictionaries of whole prefixes."""
    own = defaultdict(list)
    for conv, role, text in turns:
        own[conv].append((role, text))
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most if block else 0
        base = c - int(np.fmod(c, block)) if block else c
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:]) if block else tuple(own[c])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, held in members.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(held) - 1) * words
    found = set()
    for p, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(paths[c]) == len(p))))
        found.add((min(held), len(p), min(members[p[:-1]]) if p else None, len(held), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return found


def trie_rows(spark, turns, **rules):
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumns({"x": F.lit("a"), "part": F.lit(1.5), "words": F.lit("b"), "c": F.lit(None)})
    nodes, ends = prefix_trie.prefix_trie(rows, **rules)
    nodes = cut(nodes, "t")
    hashed = {(r["x"], r["y"]): r["ends_sha256"] for r in prefix_trie.end_hashes(ends).collect()}
    held = {(r["x"], r["y"]): r for r in nodes.collect()}
    empty = hashlib.sha256().hexdigest()
    made = set()
    for name, r in held.items():
        above = held[(r["px"], r["py"])]["conv_id"] if r["depth"] else None
        made.add((r["conv_id"], r["depth"], above, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], hashed.get(name, empty)))
    assert len(made) == len(held)
    return made, nodes


@pytest.mark.parametrize("lend", [None, (20, 4)])
def test_op11_against_whole_prefixes(spark, lend):
    random = np.random.default_rng(3)
    said = ["", "a", "b c", "d  e\tf", None]
    turns = [(int(c), int(t), ["user", None, "x"][random.integers(3)], said[random.integers(5)]) for c in range(-30, 60) for t in range(random.integers(0, 6))]
    turns += [(5, None, "user", "null first"), (5, None, "user", "tie"), (5, None, "user", "tie"), (None, 1, "user", "nobody")]
    turns += [(77, t, "user", f"long {t % 7}") for t in range(700)] + [(78, t, "user", f"long {t % 7}") for t in range(650)]
    ordered = [(r["conv_id"], r["role"], r["text"]) for r in digest_order(spark, turns) if r["conv_id"] is not None]
    # small chunks: a long conversation is many parts; few rows held: many partial tables and merges
    made, nodes = trie_rows(spark, turns, lend=lend, chunk_rows=150, local_rows=40, fan_in=2)
    assert made == brute_trie(ordered, *(lend or (None, None)))
    assert nodes.agg(F.max("depth")).first()[0] >= 699


def test_op11_node_texts(spark):
    turns = [(1, 0, "user", "hello"), (1, 1, None, "there you"), (2, 0, "user", "hello")]
    _, nodes = trie_rows(spark, turns)
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["depth"], r["role"], r["text"], r["n_convs"]) for r in prefix_trie.turn_texts(nodes, rows).collect()}
    assert got == {(0, None, None, 2), (1, "user", "hello", 2), (2, "", "there you", 1)}


def test_op11_ends_of_one_node_stream_in_segments(spark):
    """A node where thousands of conversations end, ids apart and negative."""
    ids = [*range(-3000, 3000, 2), 10**12, 5 * 10**15]
    turns = [(i, 0, "user", "same words") for i in ids]
    made, _ = trie_rows(spark, turns)
    whole = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert {r[7] for r in made if r[1] == 1} == {whole}
    assert {r[6] for r in made} == {2 * (len(ids) - 1)}


def test_op11_empty(spark):
    nodes, ends = prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    assert nodes.count() == ends.count() == 0


# 12 --------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, label int, embedding array<double>, region string, part string, slots int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, n, v, "r", "p", 1) for i, n, v in rows], VECTORS)


def brute_negatives(rows, every, positives=5, negatives=3):
    whole = {i: (n, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, n, v in rows}
    width = max(len(v) for _, v in whole.values())
    whole = {i: (n, np.pad(v, (0, width - len(v)))) for i, (n, v) in whole.items()}
    made = set()
    for a, (own, av) in whole.items():
        if a % every:
            continue
        scored = sorted(((-int(v @ av), i, n) for i, (n, v) in whole.items()))
        for ps, p in [(-s, i) for s, i, n in scored if n == own and i != a][:positives]:
            fit = [(i, -s) for s, i, n in scored if n != own and 50 * ps <= -100 * s <= 95 * ps][:negatives]
            made |= {(a, p, r, i, ps, ns) for r, (i, ns) in enumerate(fit, 1)}
    return made


def mined(frame, **rules):
    return [tuple(r) for r in hard_negatives.hard_negatives(frame, **rules).collect()]


@pytest.mark.parametrize("shard", [65_536, 40])
def test_op12_against_brute_force(spark, shard):
    random = np.random.default_rng(8)
    centres = random.normal(size=(12, 6))
    rows = [(i, int(random.integers(4)), (centres[random.integers(12)] + 0.2 * random.normal(size=6)).tolist()) for i in range(600)]
    rows += [(1000 + i, 9, [0.5, 0.5, 0.5, 0.5, 0.0, 0.0]) for i in range(120)]  # equal vectors: a region can't tell them apart
    rows += [(2000, 2, [1.0]), (2010, 3, [0.0] * 6), (2020, 77, [1.0] * 6)]
    frame = vectors(spark, rows).repartition(3)
    made = mined(frame, anchors=F.col("id") % 10 == 0, shard=shard)
    assert len(made) == len(set(made)) and set(made) == brute_negatives(rows, 10)
    assert any(r[0] >= 1000 for r in made)


def test_op12_bounds_in_blocks(spark, monkeypatch):
    random = np.random.default_rng(4)
    rows = [(i, int(random.integers(3)), random.normal(size=4).tolist()) for i in range(300)]
    monkeypatch.setattr(hard_negatives, "BOUND_ROWS", 2)
    made = mined(vectors(spark, rows), anchors=F.col("id") % 10 == 0, shard=20)
    assert len(made) == len(set(made)) and set(made) == brute_negatives(rows, 10)


def test_op12_edges(spark):
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.7, 0.0]), (2, 2, [0.7, 0.0]), (3, 2, [0.6, 0.9])]
    bad = [(4, None, [0.7, 0.0]), (5, 2, None), (6, 2, [float("nan"), 0.0]), (7, 2, [float("inf"), 0.0]), (8, 2, [None, 0.7]), (None, 2, [0.7, 0.0]), (9, 2, []), (10, 2, [1e300, 0.0])]
    made = mined(vectors(spark, good + bad), anchors=F.col("id") == 0)
    assert sorted(made) == [(0, 1, 1, 2, 65536, 256 * 179), (0, 1, 2, 3, 65536, 256 * 153)]
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(50, 1, [1.0])])) == []  # no positive


def test_op12_prunes(spark):
    """The tree reads a part of its rows only, where the vectors have an order."""
    random = np.random.default_rng(5)
    points = random.normal(size=(40, 8))[random.integers(40, size=4000)] + random.normal(size=(4000, 8)) * 0.03
    points = np.floor(256 * points / np.linalg.norm(points, axis=1)[:, None])
    largest = float((points * points).sum(axis=1).max())
    part = hard_negatives.Part(np.arange(4000), np.zeros(4000, dtype=int), points, largest)
    part.search(-1, 0, points[17], [hard_negatives.Wanted(0, -(1 << 62), 1 << 62, True, 5)])
    assert part.scored < 2000


# 13 --------------------------------------------------------------------------------------


def brute_sets(rows, shingle=2):
    found = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(shingle, len(words))
        found.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    return found


def brute_components(rows, shingle=2, percent=80):
    """(doc_id, set size, component) of every row, over all pairs."""
    sets = brute_sets(rows, shingle)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    root[max(top(i), top(j))] = min(top(i), top(j))
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    least = {t: min((d for d in held if d is not None), default=None) for t, held in ids.items()}
    return sorted(((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)), key=str)


def classed(spark, texts, **rules):
    frame = spark.createDataFrame([(i, t, "x", 1, "b", "n", "n") for i, t in texts], DOCS)
    made = oph_minhash.near_duplicates(frame.repartition(3), **rules).collect()
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in made)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in made), key=str)


def chains(count, seed):
    """Families of texts, each a few word changes from one before it, so that many similarities are near the limit."""
    random = np.random.default_rng(seed)
    rows = []
    for family in range(count):
        size = int(random.integers(3, 60))
        texts = [[f"w{family}x{int(x)}" for x in random.integers(0, 200, size)]]
        for _ in range(int(random.integers(2, 14))):
            words = list(texts[random.integers(len(texts))])
            for _ in range(int(random.integers(0, 1 + size // 10))):
                words[random.integers(size)] = f"n{random.integers(1 << 30)}"
            texts.append(words)
        rows += [(len(rows) + i, " ".join(t)) for i, t in enumerate(texts)]
    return rows


def test_op13_against_all_pairs(spark):
    rows = chains(60, 6)
    assert classed(spark, rows) == brute_components(rows)


def test_op13_hot_buckets_lose_no_link(spark):
    """Hundreds of texts share most of a passage, below the limit; some pairs among them are linked. Cells are small."""
    random = np.random.default_rng(7)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        tail = [f"t{i}y{j}" for j in range(25)]
        rows.append((i, " ".join(passage + tail)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join(passage + tail[:-2])))
    random.shuffle(rows)
    rows = [(int(i), str(t)) for i, t in rows]
    want = brute_components(rows)
    assert classed(spark, rows, max_cell=16) == want
    assert classed(spark, rows, bands=40, rows=2, max_cell=40) == want  # coarse bands: everything meets
    assert sum(d != c for d, _, c in want) == 15


def test_op13_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "A"), (5, "a"), (5, "a"), (None, "a"), (None, "alone here"), (6, "a b"), (7, "a b a b"), (8, "B a"), (9, "z " * 30000), (10, "z z"), (11, "é É"), (12, "é é")]
    assert classed(spark, rows) == brute_components(rows)
    assert classed(spark, []) == []
    assert classed(spark, [(None, "x y z"), (3, "x y z"), (2, "x y z")]) == brute_components([(None, "x y z"), (3, "x y z"), (2, "x y z")])


def test_op13_bins_agree_like_the_sets(spark):
    """Densified bins of short sets agree with a chance equal to their similarity."""
    random = np.random.default_rng(1)
    order, _ = oph_minhash._tables(60, 5)
    agreed = []
    for _ in range(400):
        whole = random.integers(0, 1 << 62, 10, dtype=np.uint64)
        one, two = np.unique(whole[:9]), np.unique(whole[1:])
        agreed.append((oph_minhash.densified(one, 300, order) == oph_minhash.densified(two, 300, order)).mean())
    assert abs(np.mean(agreed) - 0.8) < 0.02


def test_op13_shared_counts():
    random = np.random.default_rng(2)
    sets = [np.unique(random.integers(0, 20_000, n, dtype=np.uint64)) for n in (0, 1, 500, 9000, 12_000)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert oph_minhash.shared_counts(sets, sets).tolist() == want


# 9, again ----------------------------------------------------------------------------------


def test_op9_target_binds(spark, small):
    """The exponent is inside (0, 1) on the driver's tables, and an independent bisection finds the same weights."""
    import math

    from tidemark.llm import temperature_mix
    from tidemark.session import table

    docs = table(spark, small, "documents")
    made = temperature_mix.query(spark, small).select("source", "weight").distinct().collect()
    weights = {r["source"]: r["weight"] for r in made}
    tokens = {s: 0 for s in weights}
    for r in docs.select(F.coalesce("source", F.lit("<null>")).alias("s"), "text").collect():
        tokens[r["s"]] += len((r["text"] or "").encode().split())
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items() if n}

    def at(alpha):
        raised = {s: p**alpha for s, p in shares.items()}
        z = sum(raised.values())
        return {s: r / z for s, r in raised.items()}

    def entropy(ws):
        return -sum(w * math.log(w) for w in ws.values())

    wanted = (entropy(shares) + math.log(len(shares))) / 2
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(at(middle)) >= wanted else (low, middle)
    assert 0.01 < low < 0.99
    assert all(abs(weights[s] - w) < 1e-6 for s, w in at(low).items())
    assert any(abs(weights[s] - shares[s]) > 1e-3 for s in shares)


def test_op13_a_large_group_of_near_copies_stays_linear(spark, monkeypatch):
    """Copies are linked with their original alone; some outsiders come near them. Cells hold each copy once a bucket."""
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(300):
        words = list(base)
        words[1 + i % 38] = f"c{i}"
        rows.append((i + 1, " ".join(words)))
    for i in range(6):  # near the group, linked with nothing or with a copy
        words = list(base)
        words[5], words[15 + i], words[33] = "c4", f"o{i}", f"q{i}"
        rows.append((900 + i, " ".join(words)))
    rows.append((5000, " ".join(base)))
    made, found = [], oph_minhash.residual

    def counted(members, *rest):
        cells, keys = found(members, *rest)
        made.append((cells.count(), members.where("n > 2").count()))
        return cells, keys

    monkeypatch.setattr(oph_minhash, "residual", counted)
    want = brute_components(rows)
    assert classed(spark, rows, max_cell=32) == want
    assert made[0][0] <= 1.5 * made[0][1]
