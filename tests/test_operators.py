"""Hand-written rows for the rules that SQL over the driver's tables doesn't reach."""

from __future__ import annotations

import json
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import normalise, text
from tidemark.operators import context, dedup, gates, mining, pipelines, refine, retrieve, sampling, scoring
from tidemark.sources import readers, sinks
from tidemark.streaming.dedup import upsert_sink, without_banned_live


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_")).select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    say = lambda t: F.lit(t).cast("string")
    assert one(spark, text.ustrip(say("\t a b\n "))) == "a b"
    assert one(spark, text.truncated(say("x" * 201), 200)) == "x" * 197 + "..."
    assert one(spark, text.truncated(say("x" * 200), 200)) == "x" * 200
    assert one(spark, text.contains_any(say(None), ["a"])) is False
    assert one(spark, text.contains_any(say("АБВ каЗИно"), ["казино"])) is True
    assert one(spark, text.contains_any(say("has w77."), [f"w{i}." for i in range(100)])) is True
    assert one(spark, text.clamp01(say("1.7"))) == 1.0 and one(spark, text.clamp01(say("bad"))) == 0.0
    assert one(spark, text.as_list(say(" a, ,b"))) == ["a", "b"] and one(spark, text.as_list(say("a,b"), split=False)) == ["a,b"]
    assert one(spark, text.json_object(say('Sure: ```json\n{"a": {"b": 1}}\n``` ok'))) == '{"a": {"b": 1}}'
    assert one(spark, text.quote_supported(say("The quick, brown fox -- jumps high!"), say("x the quick brown fox jumps low"))) is True
    assert one(spark, text.quote_supported(say("short one"), say("short, two"))) is False
    kinds = {"FTDs": "acronym", "7995": "mcc", "FTD'шник": "mixed", "3DS": "acronym", "Skrill": "proper", "card": "latin_word", "abc": None, "P2P": "acronym", "12": None, "слово": None, "ABCDEFGH": None, "b2b": None}
    for token, kind in kinds.items():
        assert one(spark, text.token_kind(say(token))) == kind, token
    assert one(spark, text.token_norm(say("FTD's"), say("acronym"))) == "FTD"


def test_glossary_hits_need_whole_short_words(spark):
    keys = (("ftd", "FTD"), ("deposit", "Deposit"), ("first deposit", "FTD"))
    hits = lambda t: one(spark, retrieve.glossary_hits(F.lit(t), keys))
    assert hits("ftds and Deposits") == ["Deposit"] and hits("my FTD, first deposit") == ["FTD", "Deposit"] and hits("") == []


def test_gates(spark):
    pack = gates.DomainPack(terms=("psp", "pay"), signals=("need",), stop=("refund",), generic=("pay",))
    rows = spark.createDataFrame([("need a PSP",), ("pay me",), ("need refund",), (None,)], "text string")
    assert [r[0] for r in rows.select(gates.gate(F.col("text"), pack)).collect()] == [True, False, False, False]
    explained = rows.select(gates.explain_gate(F.col("text"), pack).alias("e")).first()["e"]
    assert explained.terms == ["psp"] and explained.signals == ["need"] and explained.stop == []
    assert one(spark, gates.anti_filter_blocks(F.lit("refund psp"), ["refund"], ["psp"])) is False
    assert one(spark, gates.anti_filter_blocks(F.lit("refund psp"), ["refund"], None)) is True
    banned = spark.createDataFrame([("bob",), (None,)], "username string")
    users = spark.createDataFrame([("bob",), ("Bob",), (None,)], "username string")
    assert {r[0] for r in gates.without_banned(users, banned).collect()} == {"Bob", None}
    assert {r[0] for r in without_banned_live(lambda: banned)(users, 0).collect()} == {"Bob", None}
    assert {r[0] for r in gates.ban_set(banned, users, reload=True).collect()} == {"bob", "Bob", None}


def fold(rows, hold, window):
    state, out = {}, {}
    for key, user, body, at in sorted(rows, key=lambda r: (r[3], r[0])):
        own = (body or "").strip().lower()
        if user is None or not own:
            out[key] = "keep"
            continue
        last = state.get(user)
        if last and at - last[1] < hold:
            out[key] = "hold"
        elif last and own == last[0] and at - last[1] < window:
            out[key] = "text"
        else:
            out[key] = "keep"
            state[user] = (own, at)
    return out


def test_dedup_edges(spark):
    minute = 60
    rows = [(1, "a", "Hi ", 0), (2, "a", "hi", 3 * minute), (3, "a", "other", 3 * minute - 1), (4, "a", "hi", 24 * 3600), (5, "a", "hi", 24 * 3600 + 200), (6, None, "hi", 5), (7, "a", "  ", 6), (8, "b", "x", 0), (9, "b", "x", 0)]
    frame = spark.createDataFrame(rows, "id bigint, username string, text string, at bigint")
    got = {r["id"]: r["verdict"] for r in dedup.user_dedup(frame, "id", "username", "text", "at").collect()}
    assert got == fold(rows, 180, 86400)
    kept = frame.where(F.col("id").isin([k for k, v in got.items() if v == "keep"]))
    assert {r["verdict"] for r in dedup.user_dedup(kept, "id", "username", "text", "at").collect()} == {"keep"}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "Y ", "", None]), st.integers(0, 400_000)), max_size=60))
def test_dedup_is_the_fold(spark, rows):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "id bigint, username string, text string, at bigint")
    got = {r["id"]: r["verdict"] for r in dedup.user_dedup(frame, "id", "username", "text", "at").collect()}
    assert got == fold(numbered, 180, 86400)


def test_dedup_long_history(spark):
    frame = spark.range(3000).select(F.col("id"), F.lit("u").alias("username"), (F.col("id") % 7).cast("string").alias("text"), (F.col("id") * 100).alias("at"))
    rows = [tuple(r) for r in frame.select("id", "username", "text", "at").collect()]
    got = {r["id"]: r["verdict"] for r in dedup.user_dedup(frame, "id", "username", "text", "at").collect()}
    assert got == fold(rows, 180, 86400)


def test_replies_and_prior(spark):
    rows = spark.createDataFrame([(1, None, "parent", 0), (1, None, "edited", 1), (2, 1, "child", 2), (3, 9, "orphan", 3), (4, 5, "x", 4), (5, None, "  ", 5)], "id bigint, reply_to bigint, text string, pos int")
    got = {(r["id"], r["pos"]): r["text"] for r in context.merge_replies(rows, "id", "reply_to", order=["pos"]).collect()}
    assert got[2, 2] == "[context] edited\nchild" and got[3, 3] == "orphan" and got[4, 4] == "x"


def test_definitions_and_brands(spark):
    rows = spark.createDataFrame([(1, "FTD (first time deposit) ok"), (2, "ftd: First Time deposit!"), (3, "FTD means a new payer."), (4, "xFTD means nothing at all"), (5, "FTD = cash")], "id bigint, text string")
    got = [(r["pattern"], r["definition"]) for r in mining.self_definitions(rows, ["FTD"], "id").orderBy("id").collect()]
    assert got == [("parenthetical", "first time deposit"), ("colon", "First Time deposit!"), ("en_means", "a new payer")]
    urls = spark.createDataFrame([("see Stripe.com and stripe.io, STRIPE.com",), ("Stripe.com",)], "text string")
    made = mining.mine_brands(urls, {"domain": r"\b([a-zA-Z][\w\-]{2,28})\.(?:com|io)\b"}).collect()
    assert [(r["brand"], r["frequency"], r["contexts"]) for r in made] == [("Stripe", 4, {"domain": 4})]


def test_cluster_and_pool(spark):
    rows = spark.createDataFrame([("Skrill", "proper", 5, ["Skrill"]), ("skrill", "latin_word", 9, ["skrill", "SKRILL"])], "term string, kind string, frequency bigint, surface_forms array<string>")
    made = mining.cluster(mining.pooled(rows.limit(1), rows.where("frequency = 9"))).collect()
    assert [(r["term"], r["kind"], r["frequency"], r["surface_forms"]) for r in made] == [("skrill", "phrase", 14, ["skrill"])]


def test_sense_pruning(spark):
    sense = "array<struct<definition:string,example_message_ids:array<bigint>>>"
    senses = [("first time deposit player", [1, 2]), ("first time deposit of player", [1, 2]), ("first time deposit player", [9]), ("first time deposit player", []), ("other meaning entirely", [1])]
    rows = spark.createDataFrame([("FTD", senses)], f"term string, senses {sense}")
    kept = refine.prune_senses(rows).first()["senses"]
    assert [(s.definition, s.example_message_ids) for s in kept] == [senses[0], senses[2], senses[4]]


def test_extract_fails_closed_and_open(spark):
    pack = gates.DomainPack(signals=("need",))
    rows = spark.createDataFrame([(i, f"i need a provider number {i}") for i in range(4)] + [(9, "need")], "message_id bigint, text string")
    said = [(0, "stage1", "NO."), (1, "stage1", "UNKNOWN"), (2, "stage1", None), (3, "stage1", "yes")]
    said += [(i, "extract", raw) for i, raw in ((1, '{"is_lead": true, "confidence": 0.8, "lead_type": "x"}'), (2, '{"is_lead": false, "lead_type": "x"}'), (3, "broken"))]
    recorded = spark.createDataFrame(said, "message_id bigint, stage string, raw string")
    got = {r["message_id"]: r for r in pipelines.extract(rows, pack, scoring.ReplayScorer(recorded)).collect()}
    assert {k: r["stage"] for k, r in got.items()} == {0: "stage1", 1: "extracted", 2: "not_lead", 3: "error", 9: "skip"}
    assert got[1]["lead_type"] == "x" and got[2]["lead_type"] is None and got[3]["confidence"] == 0.0
    strict = {r["message_id"]: r["stage"] for r in pipelines.extract(rows, pack, scoring.ReplayScorer(recorded), fail_open=False).collect()}
    assert strict[1] == strict[2] == "stage1"


def test_function_scorer_runs_on_survivors_only(spark):
    def call(texts):
        assert all("skip" not in t for t in texts)
        return [json.dumps({"n": len(t)}) for t in texts]

    rows = spark.createDataFrame([("skip me",), ("score me",)], "text string")
    made = scoring.on_subset(rows, ~F.contains("text", F.lit("skip")), scoring.FunctionScorer(call, parallel=1), "s").collect()
    assert {r["text"]: r["raw"] for r in made} == {"skip me": None, "score me": '{"n": 8}'}


def test_traffic_stage(spark):
    types = F.array(F.lit("Infra"), F.lit("unclear"))
    got = one(spark, pipelines.traffic_stage(types, F.lit(True)))
    assert (got.types, got.type, got.is_lead) == (["infra", "unclear"], "infra", False)
    assert one(spark, normalise.collapse_traffic_type(F.array(F.lit("none"), F.lit("infra")))) == "none"


def test_readers(spark, tmp_path):
    csv = tmp_path / "m.csv"
    csv.write_text("﻿Message_ID;Date;Text;user_id\n1;2024-01-02 03:04:05;hello;7\nbad;02.01.2024 10:11;there;x\n3;;;\n", encoding="utf-8")
    rows = readers.read_messages_csv(spark, str(csv), sep=None).orderBy("text").collect()
    assert [(r["message_id"], r["date"], r["user_id"]) for r in rows] == [(1, datetime(2024, 1, 2, 3, 4, 5), 7), (None, datetime(2024, 1, 2, 10, 11), None)]
    lines = tmp_path / "l.txt"
    lines.write_text("# c\n a \n\nb\n")
    assert [r[0] for r in readers.read_lines(spark, str(lines)).collect()] == ["a", "b"]
    jsonl = tmp_path / "j.jsonl"
    jsonl.write_text('{"id": 1, "lead": "Yes"}\nbroken\n{"id": 2}\n')
    truth = readers.truth_of(readers.read_jsonl(spark, str(jsonl), "id bigint, lead string"))
    assert {tuple(r) for r in truth.collect()} == {(1, True), (2, False)}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", True, 0.9, ["a", "b"], "x\ny")], "term string, relevant boolean, confidence double, senses array<string>, note string")
    path = str(tmp_path / "g")
    sinks.store_glossary(rows, path)
    sinks.store_glossary(rows.withColumn("confidence", F.lit(0.5)), path)
    assert [r["confidence"] for r in spark.read.parquet(path).collect()] == [0.5]
    sinks.export_glossary(spark.read.parquet(path), str(tmp_path / "e"), 0.4, first_sense=True)
    assert spark.read.json(str(tmp_path / "e")).first()["senses"] == ["a"]
    sinks.marked_csv(rows, str(tmp_path / "c"))
    text_rows = [r[0] for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert '"t";"true";"0.9";"a; b";"x | y"' in text_rows
    merge = upsert_sink(str(tmp_path / "u"), ["k"], ["v"])
    delta = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "k int, v int")
    merge(delta, 0)
    merge(spark.createDataFrame([(1, 5)], "k int, v int"), 1)
    assert sorted(map(str, map(tuple, spark.read.parquet(str(tmp_path / "u")).collect()))) == ["(1, 5)", "(None, 3)"]
    updated = sinks.update_columns(delta, spark.createDataFrame([(1, 9)], "k int, v int"), "k", ["v"])
    assert sorted(r["v"] for r in updated.collect()) == [3, 9, 9]


def test_numbering_is_global(spark):
    rows = spark.range(1000).repartition(5)
    got = {r["id"]: r["rn"] for r in sampling.numbered(rows, [F.desc("id")]).collect()}
    assert got == {i: 1000 - i for i in range(1000)}


def test_nearest_of_all_asks_every_twentieth_row(spark, tmp_path):
    import numpy as np

    random = np.random.default_rng(5)
    vectors = random.normal(size=(130, 8)).astype("float32")
    vectors[70:90] = vectors[69]  # ties go to the smallest id
    rows = [(i, vectors[i].tolist(), i % 3) for i in range(130)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")

    def expected(per_label):
        made = set()
        for q in range(0, 130, 20):
            far = {}
            for i, v, label in rows:
                dot, a, b = (sum(float(x) * float(y) for x, y in zip(s, t, strict=True)) for s, t in ((vectors[q], v), (vectors[q], vectors[q]), (v, v)))
                far.setdefault(label, []).append((1 - dot / (a**0.5 * b**0.5), i))
            made |= {(q, label, i, r + 1) for label, x in far.items() for r, (_, i) in enumerate(sorted(x)[:per_label])}
        return made

    from tidemark.operators import retrieve
    from tidemark.plans import catalogue

    assert {tuple(r) for r in catalogue.QUERIES["rag_topk"](spark, str(tmp_path)).collect()} == expected(2)
    index = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    made = retrieve.nearest_of_all(index, index.where("vec_id % 20 = 0"), per_label=3, block=3)
    assert {tuple(r) for r in made.collect()} == expected(3)


def test_quotes_of_every_item_equal_the_expression(spark, small, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.functions import text
    from tidemark.operators import quotes
    from tidemark.plans import catalogue

    items = spark.read.parquet(f"{small}/benchmark.parquet")
    extra = [(1000, "ab 12"), (1001, ""), (1002, None), (1003, "Exactly 25 characters! ok?"), (1004, "Ж" * 30)]
    items = items.unionByName(spark.createDataFrame(extra, "item_id bigint, text string"))
    held = [r["text"] for r in items.where("item_id > 2 and item_id < 9").orderBy("item_id").collect()]
    docs = [(n, f"so {t[k : k + size].upper()}; then") for n, (t, k, size) in enumerate((t, k, size) for t in held for k in (0, 7, 20) for size in (13, 24, 25, 26, 40))]
    docs += [(900, None), (901, ""), (902, "x ab, 12"), (903, "exactly 25 characters ok"), (904, "ж" * 26), (905, "Exactly 25 characters okay")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")

    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    pairs = read.crossJoin(F.broadcast(items.withColumnRenamed("text", "q"))).select("doc_id", "item_id", text.quote_supported(F.col("q"), F.col("text")).alias("supported"))
    expected = sorted(map(tuple, pairs.collect()))
    assert sum(x[2] for x in expected if x[1] > 2) > 40
    made = catalogue.QUERIES["quote_support"](spark, str(tmp_path))
    assert sorted(map(tuple, made.collect())) == expected
    parts = quotes.supported(read, items, block_bytes=3000)
    assert sorted(map(tuple, parts.collect())) == expected


def test_long_conversations_are_merged_and_pruned_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.operators import refine
    from tidemark.plans import catalogue

    rows = [(c, t, ("user", "model", f"late{t}")[t % 2 if t < 20 else 2], f"alpha beta gamma {'delta' if t % 3 else 'other words ' + str(t)}") for c, n in ((1, 30), (2, 3), (3, 9)) for t in range(n)]
    rows += [(3, 8, "user", "alpha beta gamma delta"), (3, 8, "user", "unlike all that")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")

    merged = {r["conv_id"]: r for r in catalogue.QUERIES["fusion_merge"](spark, str(tmp_path)).collect()}
    for c in (1, 2, 3):
        said = sorted((t, role) for conv, t, role, _ in rows if conv == c and t % 4 != 3)
        assert merged[c]["rationale"] == " | ".join(f"{t}.5 ({role}): r" for t, role in said)
        assert merged[c]["geo"] == ",".join(dict.fromkeys(g for t, role in said for g in (role, f"g{t % 2}")))
        assert merged[c]["confidence"] == round(sum(t + 0.5 for t, _ in said) / len(said), 3)

    turns = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    sense = F.struct("turn", F.struct(F.col("text").alias("definition"), F.array((F.col("turn") / 2).cast("bigint")).alias("example_message_ids")).alias("s"))
    whole = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(sense)), lambda x: x["s"]).alias("senses"))
    expected = {r["conv_id"]: r["n"] for r in refine.prune_senses(whole).select("conv_id", F.size("senses").alias("n")).collect()}
    assert {r["conv_id"]: r["kept"] for r in catalogue.QUERIES["sense_prune"](spark, str(tmp_path)).collect()} == expected
    assert expected[1] > 15
