"""Each operator against a brute-force version, its SQL or held-out labels, and on edge rows."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import math
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.util import duck, same_rows
from tidemark.llm import (
    boosted_rules,
    bt_quality,
    docstats,
    perspective,
    queries,
    simhash_vp,
    spaced_seed,
    subword_lid,
    temperature_mix,
    url_cascade,
    warc_split,
    weak_pii,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp string, label string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "x", "y") for i, t in rows], DOCS)


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "a b c d e"), (7, "word " * 30000), (8, "é" * 5000), (9, "🙂 1 x\u00a0y")]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, small, name):
    same_rows(queries.QUERIES[name](spark, small), duck(small, queries.ORACLES[name]))


# 1 ---------------------------------------------------------------------------------------


def test_cascade_is_exact(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 9) = 0")
    levels = url_cascade.build_cascade(universe, listed)
    assert len(levels) > 1
    wrong = universe.where(url_cascade.in_cascade(F.col("key"), levels) != F.expr("pmod(xxhash64(key), 9) = 0"))
    assert wrong.count() == 0
    assert url_cascade.build_cascade(universe, listed, max_filter_bytes=8) is None
    assert url_cascade.build_cascade(universe, listed.where("false")) == []


def test_urls_edges(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/1?x#y", "http://spam-farm.example.net", "x://b.com/fr/", "x://com/de/q", "x://xcom/de/q", "x://?q", "a://http://h/p"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id bigint, url string, key string")
    listed = spark.createDataFrame([("spam-farm.example.net",), (None,)], "key string")
    for bound in (1 << 20, 1):
        got = {r["page_id"]: tuple(r)[1:] for r in url_cascade.judge_urls(pages, listed, max_filter_bytes=bound).collect()}
        assert got[0] == got[1] == got[2] == ("", "", None, "allow", False)
        assert got[3] == ("a.example.org", "/es/1", "example.org/es/", "block", False)
        assert got[4] == ("spam-farm.example.net", "", None, "block", True)
        assert got[5][2:4] == ("com/fr/", "allow") and got[6][2:4] == ("com/de/", "block")
        assert got[7][2:4] == (None, "allow") and got[8][0] == "" and got[9][:2] == ("http:", "//h/p")
    assert url_cascade.judge_urls(pages.limit(0), listed).count() == 0


def test_hosts_of_many_labels(spark):
    deep = "a." * 20000
    rows = [(1, f"http://{deep}bad.example.net/x"), (2, f"http://{deep}example.net/"), (3, "http://bad.example.net"), (4, "http://com/"), (5, f"http://{deep}lone.b.c.d.e/")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, key string")
    listed = spark.createDataFrame([("bad.example.net",), ("com",), ("lone.b.c.d.e",)], "key string")
    for bound in (4 << 20, 0):  # cascade, then the semi join
        got = {r["page_id"]: r["verdict"] for r in url_cascade.judge_urls(pages, listed, max_filter_bytes=bound).collect()}
        assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "block"}


# 2 ---------------------------------------------------------------------------------------


def test_seeds_find_substituted_passages(spark):
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(random.choice(words, 24))) for i in range(40)]
    bench = spark.createDataFrame([(i, t, 0) for i, t in [*items, (99, None), (98, "too short")]], "item_id bigint, text string, doc_id int")
    rows, planted = [(1, None), (2, ""), (3, items[0][1]), (3, items[0][1])], {(3, 0)}
    for i in range(4, 40):
        body = random.choice(words, 200).tolist()
        if i % 2:
            copy = items[i][1].upper().split(" ")
            copy[5] = copy[13] = "replaced"
            body[50:50] = copy
            planted.add((i, i))
        rows.append((i, ", ".join(body)))
    docs = docs_of(spark, rows)
    for size in (spaced_seed.BLOCK_BYTES, 1000):
        found = spaced_seed.contamination(docs, bench, block_bytes=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == planted
        assert len(found) == len(planted) + 1  # the repeated row reports twice
    assert {r["n_matched"] for r in found if r["doc_id"] > 3} == {22}
    kept = spaced_seed.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {d for d, _ in planted}
    assert spaced_seed.contamination(docs, bench.limit(0)).count() == 0


def test_seeds_against_windows(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    grams = defaultdict(set)
    for r in bench.collect():
        words = spaced_seed.tokens(r["text"])
        for i in range(len(words) - 12):
            grams[tuple(words[i : i + 13])].add(r["item_id"])
    expected = set()
    for r in docs.collect():
        words = spaced_seed.tokens(r["text"])
        for i in range(len(words) - 12):
            expected |= {(r["doc_id"], item) for item in grams.get(tuple(words[i : i + 13]), ())}
    found = {(r["doc_id"], r["item_id"]) for r in spaced_seed.query(spark, small).collect()}
    assert expected and expected <= found


# 3 ---------------------------------------------------------------------------------------


def brute_fingerprint(text, shingle=4):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = np.array([brute_fingerprint(t) for _, t in rows], dtype=np.uint64)
    left, right = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    label, names = list(range(len(rows))), {}
    changed = True
    while changed:
        changed = False
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            if label[b] > label[a]:
                label[b] = label[a]
                changed = True
    for (key, _), own in zip(rows, label, strict=True):
        if key is not None:
            names[own] = min(names.get(own, key), key)
    return Counter((key, f"{int(p):016x}", names.get(own)) for (key, _), p, own in zip(rows, prints, label, strict=True))


@pytest.mark.parametrize("max_shard", [4000, 6])
def test_simhash_against_brute_force(spark, max_shard):
    random = np.random.default_rng(8)
    words = [f"v{i}" for i in range(3000)]
    base = [random.choice(words, 300).tolist() for _ in range(12)]
    rows = [(i, t) for i, t in EDGE if i is None or i < 8]
    for i in range(20, 120):
        copy = list(base[i % 12])
        copy[int(random.integers(0, 300))] = "changed"
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join(random.choice(words, 60))) for i in range(200, 240)]
    found = simhash_vp.near_duplicates(docs_of(spark, rows), shard=8, max_shard=max_shard)
    got = Counter(tuple(r)[:3] for r in found.collect())
    assert got == brute_components(rows)
    assert len({c for _, _, c in got}) < 100  # the fixture does hold links


def test_vantage_join_and_shards_lose_no_link(spark):
    random = np.random.default_rng(1)
    base = random.integers(0, 2**63, 1500, dtype=np.int64)
    flips = np.zeros(6000, dtype=np.int64)
    for _ in range(3):
        flips ^= np.int64(1) << random.integers(0, 63, 6000)
    points = np.unique(np.concatenate((base[random.integers(0, 1500, 6000)] ^ flips, base)))
    bits = points.view(np.uint64)
    left, right = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4)
    expected = simhash_vp.components(len(points), left, right)
    join = simhash_vp.VantageJoin(points, 4, 64)
    assert np.array_equal(join.classes(), expected) and join.compared < 0.9 * len(points) ** 2
    frame = spark.createDataFrame([(int(p),) for p in points], "fp bigint")
    stars = simhash_vp.connect(simhash_vp.link_stars(frame, 10_000_000, max_shard=50))
    roots = {r["v"]: r["root"] for r in stars.collect()}
    classes = defaultdict(set)
    for p in points.tolist():
        classes[roots.get(p, p)].add(p)
    wanted = defaultdict(set)
    for p, c in zip(points.tolist(), expected.tolist(), strict=True):
        wanted[c].add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, wanted.values()))


def test_simhash_empty_and_keep(spark):
    docs = docs_of(spark, EDGE)
    assert simhash_vp.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash_vp.keep_first(docs)
    assert kept.columns == docs.columns
    clash = docs.select(*[F.lit(1).alias(c) for c in ("component_id", "fingerprint", "__loser")], "text", "doc_id")
    assert simhash_vp.keep_first(clash).columns == clash.columns and simhash_vp.keep_first(clash).count() == kept.count()
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({1: 1, 4: 1, None: 1, 7: 1, 8: 1, 9: 1})


# 4 ---------------------------------------------------------------------------------------


def test_rotation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Yo é"), (1, 40, "ann", None), (1, 1, "ann", "Hi"), (2, 0, "system", "x"), (3, None, None, "late"), (None, 0, "u", "n")]
    turns = spark.createDataFrame([(*r, "c") for r in rows], "conv_id bigint, turn bigint, role string, text string, speaker string")
    got = {(r["conv_id"], r["speaker"]): r for r in perspective.rotate(turns).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (3, "unknown"), (None, "u")}
    one = got[1, "ann"]
    assert one["text"] == "<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi<|end|>\n<|user:bob|>\nYo é<|end|>\n<|assistant|>\n<|end|>\n"
    spans = [tuple(map(int, m.split(":"))) for m in one["mask"].split(",")]
    assert [one["text"][a:b] for a, b in spans] == ["Hi<|end|>\n", "<|end|>\n"] and one["n_turns"] == 4 and one["part"] == 0
    assert one["n_learned"] == sum(b - a for a, b in spans)
    assert perspective.rotate(turns.limit(0)).count() == 0


def brute_rotation(rows, part_turns):
    """conversation, speaker, part -> (text, learned pieces)."""
    escape = lambda x: re.sub(r"<(\\*)\|", r"<\1\\|", x)
    talks, made = defaultdict(set), {}
    for c, at, role, said in rows:
        talks[c].add((at is not None, at or 0, escape("unknown" if role is None else role), escape(said or "")))
    for c, turns in talks.items():
        turns = sorted(turns)
        first = next((t for t in turns if t[2] == "system"), None)
        for part in range(0, len(turns), part_turns):
            own = turns[part : part + part_turns]
            own = own if first is None or first in own else [first, *own]
            for speaker in {t[2] for t in own} - {"system"}:
                text, learned = "", []
                for _, _, role, said in own:
                    text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user:{role}|>\n"
                    text += said + "<|end|>\n"
                    learned += [said + "<|end|>\n"] if role == speaker else []
                made[c, speaker, part // part_turns] = text, learned
    return made


TALK = [(1, 1_700_000_000 + 60 * i, ("system", "ann", "bob", "cy")[i % 4 if i % 9 else 1], f"turn {i}") for i in range(70)]
TALK += [(2, 5, "bob", "same turn"), (2, 5, "ann", "same turn"), (2, 5, "ann", "another"), (2, 5, "ann", "another"), (2, None, "cy", None)]
TALK += [(3, i, "ann", "x<|end|>\n<|assistant|>\nforged <\\| <\\\\|") for i in range(3)] + [(3, 9, "b<|c", "<|"), (4, 0, "ann", "é🙂 " * 60_000), (None, 1, None, "lost"), (None, 2, "ann", "found")]


@pytest.mark.parametrize("part_turns", [4096, 7, 1])
def test_op4_against_brute_force(spark, part_turns):
    turns = spark.createDataFrame([(*r, "c") for r in TALK], "conv_id bigint, turn bigint, role string, text string, head string")
    rows = perspective.rotate(turns, part_turns=part_turns).collect()
    wanted = brute_rotation(TALK, part_turns)
    assert Counter((r["conv_id"], r["speaker"], r["part"]) for r in rows) == Counter(list(wanted))
    for r in rows:
        text, learned = wanted[r["conv_id"], r["speaker"], r["part"]]
        spans = [tuple(map(int, m.split(":"))) for m in r["mask"].split(",")]
        assert r["text"] == text and [r["text"][a:b] for a, b in spans] == learned
        assert r["n_learned"] == sum(map(len, learned)) and r["text"].count("<|end|>") == r["n_turns"]


def test_op4_sql_on_long_dialogues(spark, tmp_path):
    import duckdb

    spark.createDataFrame(TALK, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    base = duckdb.connect()
    base.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    columns = sorted(base.sql(perspective.ORACLE).columns)
    expected = Counter(base.sql(f"SELECT {', '.join(columns)} FROM ({perspective.ORACLE})").fetchall())
    assert Counter(map(tuple, perspective.query(spark, str(tmp_path)).select(*columns).collect())) == expected


# 5 ---------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark, small):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = subword_lid.query(spark, small).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(truth))
    held = [r for r in rows if r["held_out"]]
    assert held and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_edges(spark, small):
    model = subword_lid.train(spark.read.parquet(f"{small}/documents.parquet"))
    got = {r["doc_id"]: r for r in subword_lid.identify(docs_of(spark, EDGE), model).collect()}
    assert {k for k, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3} and got[1]["score"] == 0
    assert got[None]["held_out"] is False
    unlabelled = docs_of(spark, EDGE).withColumn("lang", F.lit(None).cast("string"))
    none = subword_lid.train(unlabelled)
    assert {r["lang_pred"] for r in subword_lid.identify(unlabelled, none).collect()} == {"und"}
    assert {r["doc_id"] for r in subword_lid.keep_identified(docs_of(spark, [*EDGE, (11, "la " * 9)])).collect()}.isdisjoint({1, 2, 3})


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Ünïcode änd plain wörds, repeated. " * 40
    whole = subword_lid.gram_counts(text)
    monkeypatch.setattr(subword_lid, "CHUNK", 97)
    assert np.array_equal(whole, subword_lid.gram_counts(text))
    words = " " + " ".join(re.findall("[a-zà-ÿ]+", text.lower())) + " "
    assert whole.sum() == 3 * (len(words) - 1) - 1  # the leading border is in no 1-gram
    assert np.array_equal(whole, subword_lid.gram_counts(text.upper().replace(" ", " 7%$ ")))


# 6, 7 ------------------------------------------------------------------------------------


def brute_stats(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def test_document_statistics(spark, small):
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [t for _, t in EDGE]
    texts += ["a b c d e f g h " * 2 + "x", "l\nl\n l\n\n\n", "x\x1cy z\u2003w", "#*$%&|<>"]
    for text in texts:
        assert docstats.measure(text.encode() if text is not None else None)[0] == brute_stats(text)


def test_boosted_rules(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in boosted_rules.query(spark, small).collect()}
    for r in docs.collect():
        n, chars, symbols, dups, repeats = brute_stats(r["text"])
        own = rows[r["doc_id"]]
        assert tuple(own)[1:6] == (n, chars, symbols, dups, repeats)
        assert own["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert not (own["base_failed"] and own["kept"])
    good = [rows[r["doc_id"]] for r in labels.where("quality = 1").collect()]
    assert sum(r["kept"] or r["base_failed"] for r in good) / len(good) > 0.97
    edge = boosted_rules.judge(docs_of(spark, EDGE), None)
    assert {r["doc_id"] for r in edge.where("kept").collect()} == set()
    assert boosted_rules.train(docs, labels.where("false")) is None


def test_boosted_trees_are_monotone_and_flat_scoring_is_right():
    random = np.random.default_rng(0)
    x = random.random((800, 3))
    y = ((np.sin(6 * x[:, 0]) - x[:, 1] + random.normal(0, 0.3, 800)) > 0).astype(float)
    forest = boosted_rules.boost(x, y, {1: -1}, trees=25)
    grid = np.repeat(random.random((50, 3)), 40, axis=0)
    grid[:, 1] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(forest.raw(grid).reshape(50, 40), axis=1) <= 1e-12).all()
    for row, raw in zip(x[:40], forest.raw(x[:40]), strict=True):
        total = forest.start
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] if row[forest.feature[node]] <= forest.cut[node] else forest.right[node]
            total += forest.value[node]
        assert math.isclose(total, raw)
    assert (((forest.raw(x) > 0) == y).mean()) > 0.8


def test_bradley_terry_held_out(spark, small):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = bt_quality.query(spark, small).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert held and sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    docs = docs_of(spark, EDGE)
    one = bt_quality.train(docs, spark.createDataFrame([(4, 1), (7, None), (None, 0)], "doc_id bigint, quality int"))
    assert bt_quality.score(docs, one).count() == len(EDGE)
    assert bt_quality.score(docs.limit(0), one).count() == 0


# 8 ---------------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_pii(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    found.sort()
    joined = ",".join(f"{weak_pii.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return (*[sum(x[1] == k for x in found) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest()), joined


PRIVATE = [
    (11, "mail ab.c@d.e_f@g.hh é😀 x@y.z. 1.2.3.4.5.6.7.8 999.1.1.1 000255.1.1.1 256.1.1.1"),
    (12, "+1 (578) 555-6437 4918187128635271 end"),
    (13, "1 2 3 " * 2000 + "4111 1111 1111 1111, 4111-1111-1111-1111 +49 30 1234567"),
    (14, "1" * 3000 + "@a.b +1+1+1 " + "a@b." + "x@y.zz " * 300),
]


def test_pii_base_spans(spark, small):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = [(i + 1000, t) for i, t in texts] + EDGE + PRIVATE
    found = weak_pii.detect(docs_of(spark, rows))
    got = defaultdict(list)
    for r in found.collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for key, text in rows:
        expected, joined = brute_pii(text)
        for r in got[key]:
            assert tuple(r)[1:6] == expected
            assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    spans = {s.split(":")[0]: s for s in got[12][0]["spans"].split(",")}
    assert spans == {"phone": "phone:0:17", "card": "card:18:34"}


def test_pii_redaction(spark):
    docs = docs_of(spark, EDGE + PRIVATE)
    out = weak_pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[12] == "[PHONE] [CARD] end" and got[1] is None and got[2] == ""
    assert got[7] == EDGE[6][1]
    assert weak_pii.detect(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [0, 5, weak_pii.CHUNK - 1, weak_pii.CHUNK, 5 * weak_pii.CHUNK + 3])
def test_redaction_against_python(spark, size):
    random = np.random.default_rng(size)
    text = "".join(random.choice(list("ab é🙂\n1"), size)) if size else ""
    cuts = random.integers(0, size + 1, (size // 6, 2)) if size else np.zeros((0, 2), dtype=int)
    spans = sorted((int(a), int(k), int(b), True) for (a, b), k in zip(np.sort(cuts, axis=1), random.integers(0, 4, len(cuts)), strict=True) if a < b and b - a < 3 * weak_pii.CHUNK)
    for chosen in (spans, spans[:3], [s for s in spans if s[2] - s[0] < 9], []):
        wanted, at = "", 0
        for start, kind, end, _ in chosen:
            if start >= at:
                wanted += text[at:start] + f"[{weak_pii.KINDS[kind].upper()}]"
            at = max(at, end)
        wanted += text[at:]
        row = spark.createDataFrame([(text, chosen)], "text string, spans array<struct<start:int,kind:int,end:int,base:boolean>>")
        assert row.select(weak_pii.redacted(F.col("text"), F.col("spans")).alias("t")).first()["t"] == wanted


def test_expectation_maximisation_finds_the_bad_labeler():
    random = np.random.default_rng(4)
    truth = random.random(4000) < 0.6
    sides = np.where(truth, 1, -1)
    votes = np.stack([np.where(random.random(4000) < q, sides, -sides) for q in (0.95, 0.9, 0.85, 0.5, 0.9)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    belief = weak_pii.expectation_maximisation(patterns, np.zeros(len(patterns), dtype=int), counts.astype(float))
    by_pattern = {tuple(p): b for p, b in zip(patterns.tolist(), belief.tolist(), strict=True)}
    right = np.mean([(by_pattern[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert right > 0.97


# 9 ---------------------------------------------------------------------------------------


def test_mixture_meets_entropy_and_budget(spark):
    random = np.random.default_rng(2)
    rows = [(i, " ".join(["t"] * int(random.integers(1, 60))), None if i % 50 == 49 else ("big" if i % 4 else f"s{i % 5}")) for i in range(3000)]
    rows += [(5000, None, "big"), (5001, "", "empty"), (5002, " ", None)]
    docs = spark.createDataFrame([(i, t, s, 1, "b") for i, t, s in rows], "doc_id bigint, text string, source string, epoch int, block string")
    made = temperature_mix.mix(docs, target_entropy=0.98, max_epochs=9.0, block_tokens=500).collect()
    tokens = Counter()
    for _, t, s in rows:
        tokens[s or "<null>"] += len(WORDS.findall(t or ""))
    total = sum(tokens.values())
    weights = {r["source"]: r["weight"] for r in made}
    assert set(weights) == {s for s, n in tokens.items() if n}
    assert math.isclose(sum(weights.values()), 1, abs_tol=1e-9)
    entropy = -sum(w * math.log(w) for w in weights.values()) / math.log(len(weights))
    assert 0.98 <= entropy < 0.981
    # brute-force bisection
    low, high = 0.0, 1.0
    shares = [n / total for n in tokens.values() if n]
    for _ in range(60):
        mid = (low + high) / 2
        z = sum(s**mid for s in shares)
        h = -sum(s**mid / z * math.log(s**mid / z) for s in shares) / math.log(len(shares))
        low, high = (mid, high) if h >= 0.98 else (low, mid)
    for s, w in weights.items():
        assert math.isclose(w, (tokens[s] / total) ** low / sum(x**low for x in shares), rel_tol=1e-3)
    used, seen = Counter(), defaultdict(Counter)
    for r in made:
        used[r["source"]] += r["n_tokens"]
        seen[r["source"]][r["doc_id"]] += 1
        assert 0 <= r["position"] < 1
    for s, w in weights.items():
        quota = round(w * total)
        assert quota - 60 <= used[s] <= quota
        full = quota // tokens[s]
        assert all(n in (full, full + 1) for n in seen[s].values()) or full == 0
        if full:
            assert len(seen[s]) == sum((x[2] or "<null>") == s for x in rows)
    again = temperature_mix.mix(docs, target_entropy=0.98, max_epochs=9.0, block_tokens=500).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, made))
    assert temperature_mix.mix(docs.limit(0)).count() == 0


def test_mixture_repetition_limit(spark):
    rows = [(i, "t " * (50 if i < 95 else 1), "a" if i < 95 else "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    made = temperature_mix.mix(docs, target_entropy=1.0, max_epochs=3.0).collect()
    assert 2.9 < max(r["weight"] * 4755 / 5 for r in made if r["source"] == "b") <= 3.0001
    assert max(r["epoch"] for r in made) <= 3


# 10 --------------------------------------------------------------------------------------


@pytest.mark.parametrize("split", [1 << 20, 700])
def test_warc_round_trip(spark, tmp_path, split):
    long = "<p>" + "é🙂" * 60 + "</p>"
    rows = [(1, "http://a/", long), (2, "http://b/\r\nX: y", long), (3, None, long), (4, "u", None), (5, "u", ""), (6, "u", "x" * 99), (7, "u", "x" * 99), (None, "u", "solo" * 50), (9, "u", "y" * 200000), (2, "http://b/", long), (-3, "u", "z" * 100), (10, "u", "z" * 100)]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id bigint, url string, html string, digest string, size int")
    path = str(tmp_path / "warc")
    got = Counter(tuple(r) for r in warc_split.round_trip(pages, path, split).collect())
    expected = Counter()
    firsts = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            firsts[data] = min(firsts.get(data, i), i)
    for i, _, html in rows:
        data = (html or "").encode()
        first = firsts.get(data)
        again = first is not None and first != i
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None, True] += 1
    assert got == expected
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("part-*"))
    assert plain.count(b"WARC/1.1\r\n") == len(rows)
    assert warc_split.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_warc_false_magic_and_ownership():
    records = [warc_split.member(warc_split.record(i, "u", bytes(np.random.default_rng(i).integers(0, 256, 3000, dtype=np.uint8)), "d", 3000, None, False)) for i in range(30)]
    noise = warc_split.member(b"not a record") + warc_split.MAGIC + b"junk" + warc_split.EMPTY_MEMBER
    data = noise.join(records) + noise
    for step in (1, 333, 5000, len(data)):
        if step == 1:
            starts = range(0, 9000)
            data_here = data[:9000]
        else:
            starts, data_here = range(0, len(data), step), data
        found = [r[2] for s in starts for r in warc_split.scan_range(lambda at, n: data_here[at : at + n], len(data_here), s, min(len(data_here), s + step))]
        assert found == list(range(len(found))) and (step == 1 or len(found) == 30)


def test_op2_segments_that_qualify_inside_longer_ones(spark):
    words = [f"w{i}" for i in range(200)]
    item = " ".join(words[:86])
    index = spaced_seed.SeedIndex([(1, item)])

    def document(*runs):
        """Runs of equal and of replaced tokens in turn."""
        made, at = [], 0
        for n, size in enumerate(runs):
            made += words[at : at + size] if n % 2 == 0 else [f"x{at + i}" for i in range(size)]
            at += size
        return " ".join(made)

    assert index.overlaps(document(13))[0][:2] == (1, 13)
    assert index.overlaps(document(13, 8, 13, 8, 13)) == [(1, 26, 0, 34, 0, 34)]
    assert index.overlaps(document(20, 13, 20, 13, 20)) == [(1, 40, 0, 53, 0, 53)]
    assert index.overlaps(document(9, 30, 6, 2, 6)) == [(1, 12, 39, 53, 39, 53)]
    assert index.overlaps(document(9, 30, 9)) == []

    random = np.random.default_rng(3)
    found = 0
    for _ in range(300):
        same = random.random(30) < random.choice([0.5, 0.65, 0.8])
        best = max((int(same[a:b].sum()) for a in range(30) for b in range(a + 1, 31) if same[a:b].sum() >= 0.75 * (b - a)), default=0)
        start, end = index._widest(same)
        assert same[start:end].sum() == best and best >= 0.75 * (end - start)
        text = " ".join(words[i] if x else f"x{i}" for i, x in enumerate(same))
        if any(True for _ in index.diagonals(np.array([index.vocabulary.get(w, 0) for w in text.split()], dtype=np.uint64))):
            assert bool(index.overlaps(text)) == (best >= 10)
            found += best >= 10
    assert found > 50

    docs = spark.createDataFrame([(1, document(13, 8, 13, 8, 13)), (2, document(9, 30, 9))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [r["doc_id"] for r in spaced_seed.contamination(docs, bench).collect()] == [1]
    assert [r["doc_id"] for r in spaced_seed.drop_contaminated(docs, bench).collect()] == [2]


def test_op8_counts_over_a_million_keep_their_proportions():
    x, target = np.ones((2, 1)), np.array([1.0, 0.0])
    weights = weak_pii.fit_classifier(x, target, np.array([9e6, 3e6]))
    assert abs(1 / (1 + np.exp(-weights[0])) - 0.75) < 1e-4


def test_op10_long_urls_are_read_back(spark, tmp_path):
    url = "http://a/" + " \x01" * 200_000
    pages = spark.createDataFrame([(1, url, "x"), (2, "u", "y")], "page_id bigint, url string, html string")
    got = warc_split.round_trip(pages, str(tmp_path / "warc")).collect()
    assert sorted(r["page_id"] for r in got) == [1, 2]


def test_keep_first_decides_texts_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "p"), (5, a, "q"), (5, b, "r"), (6, b, "s"), (7, c, "t"), (8, a, "u"), (None, a, "v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string")
    assert sorted(r["fingerprint"] for r in simhash_vp.keep_first(docs).collect()) == ["p", "r", "t", "v"]


@pytest.mark.parametrize("broadcast_rows", [200_000, 2])
def test_op10_revisits_beyond_the_broadcast(spark, tmp_path, broadcast_rows):
    bodies = {"hot": "h" * 150, "b": "b" * 120, "c": "c" * 300, "d": "d" * 101, "small": "s" * 99}
    rows = [(i, "u", bodies[k]) for i, k in enumerate(["hot"] * 40 + ["b", "c", "d", "small"] * 2 + ["b"])]
    pages = spark.createDataFrame([*rows, (None, "u", bodies["hot"])], "page_id bigint, url string, html string")
    path = str(tmp_path / "warc")
    warc_split.write_archives(pages, path, broadcast_rows=broadcast_rows)
    read = warc_split.read_archives(spark, path, 500).collect()
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]).decode()) for r in read)
    first = {}
    for i, _, html in rows:
        first[html] = min(i, first.get(html, i))
    wanted = Counter()
    for i, _, html in [*rows, (None, "u", bodies["hot"])]:
        again = len(html) >= 100 and first[html] != i
        wanted[i, "revisit" if again else "response", first[html] if again else None, None if again else html] += 1
    assert got == wanted


def test_op10_ranges_share_tasks(spark, tmp_path, monkeypatch):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat("id", F.expr("repeat('x y', 60)")).alias("html"))
    path = str(tmp_path / "warc")
    warc_split.write_archives(pages, path)
    read = warc_split.read_archives(spark, path, 64)
    assert read.count() == 400 and read.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(warc_split, "_reachable", lambda path: False)
    assert warc_split.read_archives(spark, path, 64).count() == 400
    monkeypatch.setattr(warc_split, "WHOLE_FILE_BYTES", 10)
    with pytest.raises(RuntimeError, match="too large"):
        warc_split.read_archives(spark, path, 64)


def mixture_of(spark, sizes, **rules):
    """Tokens by source of the mixture of documents with the given sizes, and the rows."""
    rows = [(i, "t " * n, s) for i, (s, n) in enumerate((s, n) for s, many in sizes.items() for n in many)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    made = temperature_mix.mix(docs, **rules).collect()
    used = Counter()
    for r in made:
        used[r["source"]] += r["n_tokens"]
    return used, made


def test_op9_long_documents_do_not_empty_their_source(spark):
    used, _ = mixture_of(spark, {"a": [1000], "b": [1000], "c": [20, 20]}, target_entropy=0.0, budget_share=0.985)
    assert used["a"] == used["b"] == 1000 and 0 < used["c"] <= 40
    # one huge document doesn't block the others, which are repeated max_epochs times at most
    used, made = mixture_of(spark, {"a": [100_000] + [100] * 30, "b": [1000] * 200}, budget_share=0.02, max_epochs=2.0, target_entropy=0.0)
    share = {r["source"]: r["weight"] for r in made}
    assert 0 < used["a"] <= round(share["a"] * 303_000 * 0.02) and max(r["n_tokens"] for r in made) == 1000
    assert max(Counter(r["doc_id"] for r in made).values()) <= 2


def test_op9_sources_of_one_too_long_document_keep_to_the_budget(spark):
    used, made = mixture_of(spark, {f"s{i}": [1000] for i in range(400)}, budget_share=0.1)
    assert 25 <= len(used) <= 60  # 40 expected
    assert all(r["position"] == 0.5 and r["epoch"] == 0 for r in made)


def test_op9_quotas_are_met_within_the_stated_error(spark):
    random = np.random.default_rng(12)
    sizes = {f"s{i}": random.integers(1, 10 ** int(random.integers(1, 4)), int(random.integers(1, 60))).tolist() for i in range(30)}
    total = sum(map(sum, sizes.values()))
    used, made = mixture_of(spark, sizes, budget_share=0.5, block_tokens=300, max_epochs=50.0)
    weight = {r["source"]: r["weight"] for r in made}
    for s, w in weight.items():
        quota = round(w * total * 0.5)
        fitting = [n for n in sizes[s] if n <= 2 * quota]
        if fitting:
            assert abs(used[s] - quota) <= max(quota / temperature_mix.COARSE, max(fitting) / 2) + 1, s
        seen = Counter(r["doc_id"] for r in made if r["source"] == s)
        assert max(seen.values()) <= quota // max(1, sum(fitting)) + 1


def test_op9_carries_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("*", F.lit("x").alias("block"))
    plain = temperature_mix.mix(docs)
    carried = temperature_mix.mix(docs, carry=("text", "lang"))
    assert carried.columns == [*plain.columns, "text", "lang"]
    assert Counter(map(tuple, carried.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    said = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    assert all(said[r["doc_id"]] == (r["text"], r["lang"]) for r in carried.collect())


def test_op5_gradient_steps_lower_the_loss_and_calibration_is_a_quantile():
    random = np.random.default_rng(9)
    centres = random.dirichlet(np.full(subword_lid.BUCKETS, 0.01), 3)
    truth = random.integers(0, 3, 1200)
    noise = random.dirichlet(np.full(subword_lid.BUCKETS, 0.01), 1200)
    mix = random.choice([0.5, 0.9], 1200)[:, None]
    shares = (mix * centres[truth] + (1 - mix) * noise).astype(np.float32)
    labels = [("aa", "bb", "cc")[k] for k in truth]
    model = subword_lid.fit(shares[:600], labels[:600], reject_share=0.1)
    truth, shares = truth[600:], shares[600:]  # never seen
    logits = (shares @ model.table + model.bias) / model.temperature
    chances = subword_lid.softmax(logits)
    right = chances.argmax(axis=1) == truth
    assert right.mean() > 0.95
    lost = (chances.max(axis=1)[right] < model.threshold).mean()
    assert lost < 0.13  # at most 0.1 of the right answers, but for chance
    assert model.threshold < subword_lid.fit(shares, [("aa", "bb", "cc")[k] for k in truth], reject_share=0.5).threshold
    # the merged table is what a plain softmax regression from the same averages would score
    for row in range(5):
        raised = [math.exp(sum(shares[row, b] * model.table[b, k] for b in np.flatnonzero(shares[row])) / model.temperature + model.bias[k] / model.temperature) for k in range(3)]
        assert np.allclose(chances[row], np.array(raised) / sum(raised), atol=1e-5)


def test_op5_learns_more_languages_than_any_fixed_cap(spark):
    random = np.random.default_rng(10)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)]
    rows = []
    for lang in range(300):
        own = letters[lang * 5 : lang * 5 + 5]
        rows += [(lang * 40 + i, " ".join("".join(random.choice(own, 4)) for _ in range(30)), f"l{lang:03d}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = subword_lid.train(docs)
    assert len(model.languages) == 300


def test_op5_rejects_texts_of_two_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = subword_lid.train(docs)
    assert 0 < model.threshold < 1
    two = spark.createDataFrame([("en", "de"), ("fr", "es")], "a string, b string")
    clean = docs.where("length(text) between 200 and 1500").select("lang", F.col("text").alias("t"))
    first = clean.groupBy("lang").agg(F.min("t").alias("t"))
    mixed = two.join(first.withColumnRenamed("lang", "a"), "a").join(first.select(F.col("lang").alias("b"), F.col("t").alias("u")), "b")
    texts = mixed.select(F.monotonically_increasing_id().alias("doc_id"), F.concat(F.substring("t", 1, 190), F.lit(" "), F.substring("u", 1, 190)).alias("text"))
    scores = [r["score"] for r in subword_lid.identify(texts, model).collect()]
    plain = [r["score"] for r in subword_lid.identify(docs, model).collect() if r["lang_pred"] != "und"]
    assert max(scores) < np.quantile(plain, 0.1)


@pytest.mark.parametrize("name", ["documents", "labels"])
def test_trained_operators_on_empty_tables(spark, small, tmp_path, name):
    for table in ("documents", "labels", "benchmark", "conversations", "pages"):
        rows = spark.read.parquet(f"{small}/{table}.parquet")
        (rows.limit(0) if table == name or name == "documents" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    expected = 0 if name == "documents" else 200
    for query in (subword_lid.query, boosted_rules.query, bt_quality.query):
        assert query(spark, str(tmp_path)).count() == expected
    if name == "documents":
        for query in queries.QUERIES.values():
            assert query(spark, str(tmp_path)).count() == 0


def brute_overlaps(docs, items):
    """(document row, item row) -> equal tokens of the best qualifying segment on a diagonal that a masked window hits."""
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in spaced_seed.MASKS]
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    windows = defaultdict(set)
    for n, (_, text) in enumerate(items):
        words = split(text)
        for k, mask in enumerate(masks if len(words) >= 8 else ()):
            for at in range(len(words) - mask[-1]):
                windows[k, tuple(words[at + i] for i in mask)].add((n, at))
    found = {}
    for d, (_, text) in enumerate(docs):
        words = split(text)
        diagonals = set()
        for k, mask in enumerate(masks if len(words) >= 8 else ()):
            for at in range(len(words) - mask[-1]):
                diagonals |= {(n, at - own) for n, own in windows.get((k, tuple(words[at + i] for i in mask)), ())}
        for n, shift in diagonals:
            own = split(items[n][1])
            same = [words[i + shift] == w if 0 <= i + shift < len(words) else None for i, w in enumerate(own)]
            same = [x for x in same if x is not None]
            sums = np.concatenate(([0], np.cumsum(same)))
            size = np.arange(len(sums))
            equal, length = sums[None, :] - sums[:, None], size[None, :] - size[:, None]
            good = (length > 0) & (equal >= min(10, len(own))) & (4 * equal >= 3 * length)
            if good.any():
                found[d, n] = max(found.get((d, n), 0), int(equal[good].max()))
    return found


def test_op2_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").collect()]
    random = np.random.default_rng(6)
    for n, (_, text) in enumerate(items[:30]):  # passages with a share of their words replaced
        words = text.split()
        lost = random.random(len(words)) < n / 60
        docs.append((10_000 + n, "before it " + " ".join(f"z{i}" if x else w for i, (w, x) in enumerate(zip(words, lost, strict=True))) + " after"))
    items += [(900, "nine words stand here in a row for once"), (901, "seven words are far too few here"), (902, items[0][1]), (903, None)]
    docs += [(20_000, "so nine words stand here in a row for once more"), (20_001, "so nine words stand here in another row for once"), (20_002, "seven words are far too few here"), (20_003, None), (20_004, "")]
    docs.append((20_005, " ".join(["filler"] * 50_000) + " " + items[1][1] + " " + " ".join(["filler"] * 50_000)))
    wanted = {(docs[d][0], items[n][0]) for d, n in brute_overlaps(docs, items)}
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for size in (spaced_seed.BLOCK_BYTES, 2000):
        rows = spaced_seed.contamination(*frames, block_bytes=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == wanted
        assert all(10 <= r["n_matched"] or r["item_id"] == 900 for r in rows) and all(4 * r["n_matched"] >= 3 * r["n_overlap"] for r in rows)
        kept = spaced_seed.drop_contaminated(*frames, block_bytes=size)
        assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in wanted}
    assert (20_000, 900) in wanted and (20_001, 900) not in wanted and (20_005, 1) in wanted and len(wanted) > 20


@pytest.mark.parametrize("length, lost", [(12, 2), (13, 3), (14, 3), (16, 4), (20, 5), (24, 6), (40, 10)])
def test_op2_recall_at_its_limits(length, lost):
    """Over all diagonals: every placement of the substitutions (a sample of them in long items) qualifies as a whole."""
    words = [f"w{i}" for i in range(length)]
    index = spaced_seed.SeedIndex([(1, " ".join(words))])
    if math.comb(length, lost) <= 2000:
        placements = list(itertools.combinations(range(length), lost))
    else:
        random = np.random.default_rng(length)
        placements = [set(random.choice(length, lost, replace=False).tolist()) for _ in range(1000)]
    found = 0
    for gone in placements:
        got = index.overlaps("before it " + " ".join(f"z{i}" if i in gone else w for i, w in enumerate(words)) + " after")
        found += bool(got)
        assert all(r[1] >= 10 and 4 * r[1] >= 3 * (r[3] - r[2]) for r in got)
    assert found >= 0.94 * len(placements)


@pytest.mark.parametrize("period", [1, 2, 7])
def test_op2_repetitive_texts_against_repetitive_items(period):
    item = [f"w{i % period}" for i in range(300)]
    index = spaced_seed.SeedIndex([(1, " ".join(item)), (2, "none of these nine words is in the text")])
    start = time.perf_counter()
    assert index.overlaps(" ".join(f"w{i % period}" for i in range(20_000))) == [(1, 300, 0, 300, 0, 300)]
    assert time.perf_counter() - start < 1
    random = np.random.default_rng(period)
    for size in (40, 90, 400):  # with words replaced, every hit diagonal counts: equal to all pairs
        words = [f"z{i}" if x else f"w{i % period}" for i, x in enumerate(random.random(size) < 0.15)]
        texts, items = [(1, " ".join(words)), (2, " ".join(words[:50] + item[:30]))], [(1, " ".join(item[:60])), (2, " ".join(item[:11]))]
        small_index = spaced_seed.SeedIndex(items)
        got = {(d, n - 1): equal for d, (_, text) in enumerate(texts) for n, equal, *_ in small_index.overlaps(text)}
        assert got == brute_overlaps(texts, items)


def test_op2_both_expansions_give_the_same(monkeypatch):
    random = np.random.default_rng(3)
    items = [(n, " ".join(f"w{x}" for x in random.integers(0, 3, 40))) for n in range(20)]
    index = spaced_seed.SeedIndex(items)
    ids = np.array([index.vocabulary[f"w{x}"] for x in random.integers(0, 3, 2_000)], dtype=np.uint64)

    def pairs():
        return {(item, int(x)) for item, shifts in index.diagonals(ids) for x in shifts}

    whole = pairs()
    for seldom, at_once in ((0, 1 << 20), (10**9, 1 << 20), (10**9, 50)):
        monkeypatch.setattr(spaced_seed, "_SELDOM", seldom)
        monkeypatch.setattr(spaced_seed, "_PAIRS", at_once)
        assert pairs() == whole and whole


@pytest.mark.parametrize("many", [0, 1, 63, 64, 65, 400])
def test_op8_loose_candidates_that_overlap_no_base_span(spark, many):
    random = np.random.default_rng(many)

    def spans(n):
        made = []
        for kind in range(4):
            cuts = np.sort(random.choice(40 * (n + 1), 2 * n, replace=False)).tolist()
            made += [(kind, a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        return made

    base, loose = spans(many), spans(30)
    kind = "array<struct<kind:int,start:int,end:int>>"
    row = spark.createDataFrame([(base, loose)], f"base {kind}, loose {kind}")
    got = row.select(weak_pii.free(F.col("base"), F.col("loose")).alias("x")).first()["x"]
    wanted = [c for c in loose if not any(b[0] == c[0] and b[1] < c[2] and c[1] < b[2] for b in base)]
    assert list(map(tuple, got)) == wanted


def test_op8_gazetteers():
    ending = re.compile(rf"^(?:(?!(?:{weak_pii.UNUSED_COUNTRIES})$)[a-z]{{2}}|{'|'.join(weak_pii.GENERIC_ENDINGS)})$")
    assert all(ending.match(x) for x in ("de", "uk", "com", "museum")) and not any(ending.match(x) for x in ("zz", "xk", "qz", "comm", "aa"))
    code = [re.compile(f"^(?:{c})") for c in weak_pii.CALLING]
    assert code[1].match("49301234567") and code[2].match("380441234567") and code[0].match("12125550100")
    assert not any(c.match("2101234567") for c in code) and not any(c.match("0301234567") for c in code)
    issued = lambda d: any(len(d) in sizes and re.match(f"(?:{p})", d) for p, sizes in weak_pii.ISSUERS)
    assert issued("4111111111111111") and issued("378282246310005") and not issued("37828224631000") and not issued("9111111111111111")


def query_points(spark, sf_dir):
    """The distinct fingerprints that the query pairs."""
    prints = simhash_vp.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return prints.select("fp").distinct().cache()


def test_op3_query_splits_trees_and_compares_few_pairs(spark):
    points = query_points(spark, "/root/testdata/sf0.01")
    n = points.count()
    made = simhash_vp.join_statistics(points, n).agg(F.sum("splits"), F.sum("compared"), F.max("points")).first()
    assert n > 800 and made[0] > 0 and made[1] < 0.2 * n * n and made[2] < n


def test_op3_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert Counter(tuple(r)[:3] for r in simhash_vp.query(spark, folder).collect()) == brute_components(rows)


@pytest.mark.parametrize("max_shard", [200, 20])
def test_op3_hot_shards_are_dealt_by_the_other_bits(spark, max_shard):
    random = np.random.default_rng(21)
    low = np.uint64((1 << 52) - 1)
    loose = random.integers(0, 2**63, 1500, dtype=np.uint64) & low  # equal in the highest block
    ball = [np.uint64(0xABC << 40) ^ np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 30, 3, dtype=np.uint64)) for _ in range(700)]
    near = loose[:300] ^ (np.uint64(1) << random.integers(0, 52, 300, dtype=np.uint64))
    points = np.unique(np.concatenate((loose, np.array(ball, dtype=np.uint64), near)).view(np.int64))
    frame = spark.createDataFrame([(int(p),) for p in points], "fp bigint")
    spread, keys = simhash_vp.cells(frame, len(points), max_shard=max_shard)
    sizes = [r["n"] for r in spread.groupBy(*keys).agg(F.count_distinct("fp").alias("n")).collect()]
    assert max(sizes) <= 2 * max_shard and "sub" in keys  # parts are dealt by hash, so small ones vary
    bits = points.view(np.uint64)
    left, right = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4)
    expected = simhash_vp.components(len(points), left, right)
    stars = simhash_vp.connect(simhash_vp.link_stars(frame, len(points), max_shard=max_shard))
    roots = {r["v"]: r["root"] for r in stars.collect()}
    got = defaultdict(set)
    wanted = defaultdict(set)
    for p, c in zip(points.tolist(), expected.tolist(), strict=True):
        got[roots.get(p, p)].add(p)
        wanted[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_op3_dense_classes_are_not_compared_in_full():
    points = np.arange(1 << 13, dtype=np.int64)  # every point has 13 neighbours at one bit
    join = simhash_vp.VantageJoin(points)
    assert (join.classes() == 0).all() and join.compared < 0.2 * len(points) ** 2 and join.splits > 100


def test_op1_cascade_of_many_keys_against_a_join(spark):
    listed = spark.range(60_000).select(F.concat(F.lit("d"), F.col("id") * 7, F.lit(".example.net")).alias("key"))
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://www."), F.when(F.col("id") % 3 == 0, F.concat(F.lit("d"), F.col("id") * 5, F.lit(".example.net"))).otherwise(F.lit("open.example.com")), F.lit("/x")).alias("url")
    )
    repeated = pages.unionByName(pages.where("page_id < 20"))
    rows = url_cascade.judge_urls(repeated, listed).collect()
    assert len(rows) == 3020
    for r in rows:
        number = r["page_id"] * 5
        assert r["listed"] == (r["page_id"] % 3 == 0 and number % 7 == 0 and number < 420_000)
    assert any(r["listed"] for r in rows)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_keep_first_keeps_one_of_repeated_rows(spark, broadcast_rows):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = a.replace("a30 ", "other ")  # the same id, another text of the same component
    linked = simhash_vp.fingerprint(a.encode()) ^ simhash_vp.fingerprint(near.encode())
    rows = [(1, a, "p"), (1, a, "q"), (1, near, "r"), (2, a, "s"), (3, c, "t"), (3, d, "u"), (3, c, "v"), (4, None, "w"), (4, None, "w"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, class string")
    kept = Counter(r["doc_id"] for r in simhash_vp.keep_first(docs, broadcast_rows=broadcast_rows).collect())
    assert kept == Counter({1: 1 if linked.bit_count() <= 4 else 2, 3: 2, 4: 1, None: 1})
    assert simhash_vp.keep_first(docs.limit(0)).count() == 0


def test_op6_rejects_bad_documents_beyond_the_base_rule(spark, small):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in boosted_rules.query(spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels and not r["base_failed"]]
    bad, good = [r for r in rows if labels[r["doc_id"]] == 0], [r for r in rows if labels[r["doc_id"]] == 1]
    assert len(bad) >= 10 and sum(not r["kept"] for r in bad) > 0.8 * len(bad)
    assert sum(r["kept"] for r in good) > 0.97 * len(good)


def test_op9_placement_against_a_walk_through_the_blocks(spark):
    """Every pass visits all blocks before it repeats one, and positions rise with the tokens before them."""
    rows = [(i, "t " * (1 + i % 7), "a" if i % 3 else "b") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    made = temperature_mix.mix(docs, target_entropy=1.0, max_epochs=5.0, block_tokens=100).collect()
    size = {i: 1 + i % 7 for i in range(600)}
    for source in "ab":
        own = sorted((r for r in made if r["source"] == source), key=lambda r: r["position"])
        total = sum(size[i] for i, _, s in rows if s == source)
        quota = round(own[0]["weight"] * sum(size.values()))
        at, blocks = 0, []
        for r in own:
            assert math.isclose(r["position"], (at + size[r["doc_id"]] / 2) / quota, abs_tol=1e-9) and r["epoch"] == at // total
            at += size[r["doc_id"]]
            if not blocks or blocks[-1] != (r["epoch"], r["block"]):
                blocks.append((r["epoch"], r["block"]))
        assert len(set(blocks)) == len(blocks) and quota - at < 7  # no block is left and entered again


def test_op7_fit_is_the_minimum_of_the_pairwise_loss():
    random = np.random.default_rng(14)
    x = random.normal(size=(60, 3))
    y = (x[:, 0] + 0.5 * random.normal(size=60) > 0).astype(int)
    ranker = bt_quality.fit(x, y, pairs=10**6, rounds=4000)
    wide = ranker.expand(x)
    drawn = np.random.default_rng(5)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    count = len(good) * len(bad)
    pairs = list(zip(drawn.choice(good, count).tolist(), drawn.choice(bad, count).tolist(), strict=True))

    def loss(w):
        return sum(math.log1p(math.exp(-float((wide[i] - wide[j]) @ w))) for i, j in pairs) / count + 0.5e-3 * float(w @ w)

    best = loss(ranker.weights)
    for k in range(len(ranker.weights)):
        step = np.zeros_like(ranker.weights)
        step[k] = 1e-3
        assert loss(ranker.weights + step) >= best - 1e-7 and loss(ranker.weights - step) >= best - 1e-7
        assert abs(loss(ranker.weights + step) - loss(ranker.weights - step)) / 2e-3 < 1e-3
    strength = ranker.strength(x)
    assert (strength < ranker.threshold).sum() == len(bad)
    assert np.mean([strength[i] > strength[j] for i in good for j in bad]) > 0.85
