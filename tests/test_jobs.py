"""Whole jobs on invented messages."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions.unicode import nfkc, repair_text
from tidemark.operators import gates, outcomes, scoring
from tidemark.plans import jobs
from tidemark.streaming.dedup import upsert_sink

TEXTS = ["we need a PSP for cards now", "PSPs wanted: need Skrill Pay", "Skrill means an e wallet service", "need PSP, skrill or other", "Skrill Pay is down again", "short"]


def messages(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "message_id bigint, text string")


def test_repair():
    assert json.loads(repair_text('Sure! ```json\n[{"a": [1, 2,], "b": "x}"},]```')) == {"a": [1, 2], "b": "x}"}
    assert json.loads(repair_text('{"a": {"b": "cut')) == {"a": {"b": "cut"}}
    assert repair_text("none") is None and repair_text(None) is None and repair_text("[1]") is None and repair_text("[]") is None


def test_nfkc(spark):
    got = spark.createDataFrame([("«ﬁntech»!",), (None,)], "t string").select(nfkc("t").alias("x")).collect()
    assert [r["x"] for r in got] == ["fintech", None]


def test_repaired_replies(spark):
    rows = spark.createDataFrame([('x {"a": 1} y',), ('{"a": [1,}',), ("no",), (None,)], "raw string")
    assert sorted(str(r["raw"]) for r in jobs.repaired(rows).collect()) == ["None", "None", "None", '{"a": 1}']


def test_glossary_dry_run(spark):
    plan = jobs.GlossaryPlan(gazetteer=[{"canonical": "Skrill", "forms": ["Skrill"], "category": "wallet"}], brand_patterns={"down": r"([A-Z][a-z]+) Pay"}, least=2)
    got = {r["term"]: (r["kind"], r["frequency"]) for r in jobs.build_glossary(messages(spark), plan).collect()}
    assert got["PSP"] == ("acronym", 3) and got["Skrill"][1] >= 3 + 4 and got["need"] == ("latin_word", 3)


def test_glossary_with_scorer(spark):
    sense = {"definition": "a payment wallet", "context_clues": [], "example_message_ids": [1, 2]}
    draft = F.when(
        F.col("text").isin("PSP", "Skrill"),
        F.lit(json.dumps({"relevant": True, "confidence": 0.9, "senses": [sense, sense]})),
    ).otherwise(F.lit('{"relevant": false}'))
    rules = {
        "phrases": F.lit('{"phrases": ["need a", "x"]}'),
        "inference": draft,
        "validation": F.when(F.col("term") == "PSP", F.lit('{"issue_severity": "minor"}')),
    }
    got = {r["term"]: r for r in jobs.build_glossary(messages(spark), jobs.GlossaryPlan(least=2), scoring.RuleScorer(rules)).collect()}
    assert round(got["PSP"]["confidence"], 3) == 0.8 and len(got["PSP"]["senses"]) == 1
    assert got["need"]["relevant"] is False and "need a" in got


def test_classify_batch_and_alignment(spark):
    pipe = jobs.Pipeline("cards", gates.DomainPack(signals=("need",)), {"seeker": "REAL_SEEKER"}, ("REAL_SEEKER", "MISTAKE"), aligned=True)
    rules = {
        "stage1": F.lit("YES"),
        "extract": F.lit('{"is_lead": true, "confidence": 0.7, "lead_type": "seeker", "rationale": "r"}'),
        "judge": F.when(F.col("message_id") == 0, '{"verdict": "REAL_SEEKER"}').otherwise('{"verdict": "MISTAKE"}'),
    }
    doubled = messages(spark).unionByName(messages(spark).withColumn("message_id", F.col("message_id") + 100))
    done = spark.createDataFrame([(3,)], "message_id bigint")
    rows = jobs.classify_batch(doubled, pipe, scoring.RuleScorer(rules), done)
    got = {r["message_id"]: r for r in rows.collect()}
    assert set(got) == {0, 1, 2, 4, 5}
    assert got[0]["is_lead"] and got[0]["verdict"] == "REAL_SEEKER"
    assert not got[1]["is_lead"] and got[1]["rationale"].startswith("[type_mismatch: stage3=seeker, stage4=MISTAKE]")
    assert got[5]["stage"] == "skip" and got[2]["stage"] == "prefilter"
    both = jobs.classify_all(messages(spark), [pipe, jobs.Pipeline("other", gates.DomainPack())], scoring.RuleScorer(rules))
    assert both.count() == 12


def test_outcomes(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, "REAL_LEAD", "ok"), (2, True, "REVIEW", "x"), (3, False, "MISTAKE", "y"), (4, False, None, "extraction failed: z")], "message_id bigint, is_lead boolean, verdict string, rationale string")
    assert [r[0] for r in rows.select(outcomes.outcome(F.col("verdict"), F.col("is_lead"))).collect()] == ["confirmed", "confirmed", "judged_out", "rejected"]
    assert [r[0] for r in outcomes.to_retry(rows).collect()] == [4]
    again = outcomes.with_retries(rows, rows.where("message_id = 4").withColumn("rationale", F.lit("fixed")))
    assert {r["message_id"]: r["rationale"] for r in again.collect()}[4] == "fixed" and again.count() == 4
    path = str(tmp_path / "log")
    assert outcomes.append_new(rows.limit(2), path, "message_id") == 2 and outcomes.append_new(rows, path, "message_id") == 2 and outcomes.append_new(rows, path, "message_id") == 0
    said = spark.createDataFrame([(1, "MISTAKE", 1), (1, "REAL_LEAD", 2)], "message_id bigint, verdict string, judged_at int")
    assert {r["message_id"]: r["verdict"] for r in outcomes.judged(rows, said).collect()} == {1: "REAL_LEAD", 2: "REVIEW", 3: "REVIEW", 4: "REVIEW"}


def test_cross_user_duplicates(spark):
    body = "long text " * 12
    rows = spark.createDataFrame([(1, body, True, "a", "REAL"), (2, " " + body.upper(), True, "a", "REAL"), (3, body, True, "b", "REAL"), (4, "brief", True, "a", "REAL")], "message_id bigint, text string, is_lead boolean, lead_type string, verdict string")
    assert {r["message_id"]: r["verdict"] for r in jobs.cross_user_duplicates(rows).collect()} == {1: "REAL", 2: "MISTAKE", 3: "REAL", 4: "REAL"}
    assert {r["message_id"] for r in jobs.cross_user_duplicates(rows, on_duplicate="skip").collect()} == {1, 3, 4}
    untyped = rows.withColumn("lead_type", F.lit(None).cast("string"))
    assert {r["message_id"] for r in jobs.cross_user_duplicates(untyped, on_duplicate="skip").collect()} == {1, 4}


def test_stream_into_upserts(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i in range(2):
        spark.createDataFrame([(1, f"v{i}", i), (10 + i, "new", i)], "message_id bigint, text string, at int").write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("message_id bigint, text string, at int").option("maxFilesPerTrigger", 1).parquet(str(source))
    jobs.serve(stream, [lambda f, _: f.withColumn("n", F.length("text"))], upsert_sink(out, ["message_id"], ["at"]), str(tmp_path / "c")).awaitTermination()
    assert {r["message_id"] for r in spark.read.parquet(out).collect()} == {1, 10, 11}


def test_brands_are_confirmed_and_low_drafts_researched(spark):
    brands = spark.createDataFrame([("Acme", 3), ("Other", 2), ("Odd", 1)], "brand string, frequency int")
    rules = {"brands": F.when(F.col("text") == "Acme", '{"is_brand": true}').when(F.col("text") == "Other", '{"is_brand": false}')}
    assert [tuple(r) for r in jobs.confirmed_brands(brands, scoring.RuleScorer(rules)).collect()] == [("Acme", 3)]
    senses = [("old", ["c"], [1]), ("second", [], [])]
    kind = f"message_id bigint, relevant boolean, confidence double, senses {jobs.SENSES}"
    drafts = spark.createDataFrame([(1, True, 0.4, senses), (2, True, 0.4, senses), (3, True, 0.9, senses), (4, False, 0.1, senses), (5, True, 0.2, [])], kind)
    reply = F.when(F.col("message_id") == 2, '{"accept_web_info": false}').otherwise('{"accept_web_info": true, "definition": "new", "confidence": 1.7}')
    got = {r["message_id"]: r for r in jobs.researched(drafts, scoring.RuleScorer({"research": reply})).collect()}
    assert [s["definition"] for s in got[1]["senses"]] == ["new", "second"] and got[1]["confidence"] == 1.0 and got[1]["senses"][0]["context_clues"] == ["c"]
    assert got[2]["senses"][0]["definition"] == got[3]["senses"][0]["definition"] == got[4]["senses"][0]["definition"] == "old"
    assert [s["definition"] for s in got[5]["senses"]] == ["new"] and got[5]["source_stage"] == "research" and got[2]["source_stage"] == "inference"


def test_confidence_inside_a_sense_counts(spark):
    draft = F.lit('{"relevant": true, "senses": [{"definition": "d", "confidence": "0.7"}]}')
    rows = jobs.build_glossary(messages(spark), jobs.GlossaryPlan(least=2), scoring.RuleScorer({"phrases": F.lit("{}"), "inference": draft, "validation": F.lit(None).cast("string")})).collect()
    assert rows and {r["confidence"] for r in rows} == {0.7}
