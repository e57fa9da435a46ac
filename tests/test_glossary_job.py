"""The whole glossary job: every stage is asked for the right terms, with their evidence."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tests.test_jobs import TEXTS
from tidemark.operators import scoring
from tidemark.plans import jobs

SENSE = {"definition": "a payment wallet", "context_clues": ["pay"], "example_message_ids": [1, 2]}


def _messages(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "message_id bigint, text string")


def _draft(**more):
    return json.dumps({"relevant": True, "confidence": 0.9, "senses": [SENSE], **more})


def _rules(**more):
    return {"phrases": F.lit('{"phrases": []}'), "brands": F.lit('{"is_brand": true}'), "inference": F.lit(_draft()), "validation": F.lit("{}"), **more}


def _built(spark, plan, **rules):
    made = jobs.build_glossary(_messages(spark), plan, scoring.RuleScorer(_rules(**rules)))
    return {r["term"]: r for r in made.collect()}


def test_examples_and_definitions_reach_the_scorer(spark):
    seen = F.to_json(F.struct(F.lit(True).alias("relevant"), F.lit(0.9).alias("confidence"), F.array(F.struct(F.col("prompt").alias("definition"))).alias("senses")))
    got = _built(spark, jobs.GlossaryPlan(least=2), inference=seen)
    skrill = got["Skrill"]
    assert skrill["definitions"] == ["an e wallet service"]
    assert sorted(e["id"] for e in skrill["examples"]) == [1, 2, 3, 4]
    prompt = skrill["senses"][0]["definition"]
    assert prompt.startswith("Term: Skrill (") and "- an e wallet service" in prompt and "[4] Skrill Pay is down again" in prompt
    assert "5" not in [str(e["id"]) for r in got.values() for e in r["examples"]]


def test_only_confirmed_brands_are_terms(spark):
    plan = jobs.GlossaryPlan(brand_patterns={"down": r"([A-Z][a-z]+ Pay)", "need": r"need ([A-Z][a-z]+) Pay"}, least=9)
    assert set(_built(spark, plan)) == {"Skrill Pay", "Skrill"}
    refused = F.when(F.col("text") == "Skrill", F.lit('{"is_brand": true}')).otherwise(F.lit('{"is_brand": false}'))
    assert set(_built(spark, plan, brands=refused)) == {"Skrill"}
    assert _built(spark, plan, brands=F.lit(None).cast("string")) == {}


def test_unsure_drafts_are_researched(spark):
    unsure = F.when(F.col("term") == "PSP", F.lit(_draft(confidence=0.3))).otherwise(F.lit(_draft()))
    reply = {"accept_web_info": True, "definition": "payment provider", "confidence": 0.7}
    got = _built(spark, jobs.GlossaryPlan(least=2), inference=unsure, research=F.lit(json.dumps(reply)))
    assert (got["PSP"]["source_stage"], got["PSP"]["confidence"], got["PSP"]["senses"][0]["definition"]) == ("research", 0.7, "payment provider")
    assert got["Skrill"]["source_stage"] == "inference" and got["Skrill"]["confidence"] == 0.9
    kept = _built(spark, jobs.GlossaryPlan(least=2, research_at_most=None), inference=unsure)
    assert kept["PSP"]["confidence"] == 0.3 and kept["PSP"]["source_stage"] == "inference"


def test_missing_senses_are_added_and_paraphrases_go(spark):
    critique = F.when(F.col("term").isin("PSP", "Skrill"), F.lit('{"issue_severity": "minor", "missing_senses": [{"description": "x"}, {"description": " "}]}')).when(
        F.col("term") == "need", F.lit('{"wrongly_admitted_noise": true, "missing_senses": [{"description": "x"}]}')
    )
    new = {"new_senses": [{"definition": "online casino cashier", "example_message_ids": ["4", "n"]}, {"definition": " "}]}
    judged = F.when(F.col("term") == "PSP", F.lit('{"kept_sense_indices": [1, 7, "x"]}')).otherwise(F.lit('{"kept_sense_indices": [9]}'))
    got = _built(spark, jobs.GlossaryPlan(least=2), validation=critique, enrichment=F.lit(json.dumps(new)), paraphrase=judged)
    skrill, psp = got["Skrill"], got["PSP"]
    assert [s["definition"] for s in skrill["senses"]] == ["a payment wallet", "online casino cashier"]
    assert skrill["senses"][1]["example_message_ids"] == [4] and skrill["source_stage"] == "inference+enrichment"
    assert abs(skrill["confidence"] - 0.9) < 1e-9  # a tenth off for the minor issue, a tenth on for the sense
    assert [s["definition"] for s in psp["senses"]] == ["online casino cashier"] and psp["source_stage"] == "inference"
    assert not got["need"]["relevant"] and len(got["need"]["senses"]) == 1


def test_failed_stages_change_nothing(spark):
    silent = F.lit(None).cast("string")
    got = _built(spark, jobs.GlossaryPlan(least=2), inference=F.lit(_draft(confidence=0.2)), research=silent, validation=silent)
    assert all(r["relevant"] and r["confidence"] == 0.2 and r["source_stage"] == "inference" for r in got.values()) and got
    nothing = jobs.build_glossary(_messages(spark, []), jobs.GlossaryPlan(), scoring.RuleScorer(_rules()))
    assert nothing.count() == 0


def test_lemmas_cluster_the_pools(spark):
    pairs = spark.createDataFrame([("wallets", "wallet"), ("wallet", "wallet"), ("needs", "need"), ("cards", "card")], "form string, lemma string")
    texts = ["wallets here", "a wallet for walls", "wallet, wallets", "terminals only", "terminal"]
    plan = jobs.GlossaryPlan(least=1, lemmas=pairs)
    got = {r["term"]: r["frequency"] for r in jobs.build_glossary(_messages(spark, texts), plan).collect()}
    assert got["wallets"] == 4 and "wallet" not in got and got["terminals"] == 2 and "terminal" not in got
