"""The message classifiers: stage-1 readings, verified gates, provider, traffic and coin-buyer decisions.

Each takes messages and a scorer and adds the decision columns of ``pipelines.opened``. A
model sees only rows that every earlier stage let through, and only those are written, with
its replies, before they are read twice; ``verified`` also writes its gated input once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import patterns
from tidemark.functions.text import any_hit, is_blank, json_object, ustrip
from tidemark.operators import context
from tidemark.operators.gates import DomainPack
from tidemark.operators.pipelines import answered_no, answered_yes, certainty, expected_verdict, extract, opened, resolve_mismatch, traffic_stage
from tidemark.operators.scoring import Scorer, asked
from tidemark.session import cut, dimension

#: Verdicts, roles and reasons that the decisions are written with.
CODEBOOK = {"LEAD": ("REAL_PROVIDER", "CERTAIN", None), "UNCERTAIN": ("REAL_PROVIDER", "UNCERTAIN", "judge_uncertain"), "NOT_LEAD": ("MISTAKE", None, None)}
TRAFFIC_VERDICTS = {"seeking_traffic": "TRAFFIC_LEAD", "traffic_provider": "TRAFFIC_PROVIDER"}
TRAFFIC_ROLES = {"buyer": "seeking_traffic", "seller": "traffic_provider"}
CONTEXT_SEPARATOR, CONTEXT_TEXTS, CONTEXT_CHARS, CONTEXT_CUT = "\n\n---\n\n", 10, 3000, "...[cut]"


def lets_through(raw: Column, mode: str) -> Column:
    """How a yes/no stage reads a reply; null is a failed call.

    ``not_no`` rejects exact negatives alone, ``starts_yes`` needs a leading YES, ``has_yes``
    needs a yes anywhere but lets failures pass, ``no_no`` rejects any NO (even within
    UNKNOWN) and lets failures pass.
    """
    if mode == "not_no":
        return ~answered_no(raw)
    if mode == "starts_yes":
        return answered_yes(raw)
    if mode == "has_yes":
        return raw.isNull() | F.contains(F.lower(raw), F.lit("yes"))
    if mode == "no_no":
        return raw.isNull() | ~F.contains(F.upper(raw), F.lit("NO"))
    raise ValueError(f"no stage-1 reading {mode!r}")


def reply(raw: Column, schema: str) -> Column:
    """The reply's JSON object as a struct; null for a failed call or another reply."""
    return F.from_json(json_object(raw), schema)


def _lead(rows: DataFrame) -> Column:
    return F.coalesce(F.col("is_lead"), F.lit(False))


def second_look(rows: DataFrame, scorer: Scorer, stage: str = "stage1b") -> DataFrame:
    """Leads meet a second, strict yes/no stage; a message whose call failed has no decision and no row."""
    said = asked(rows.withColumn("__lead", _lead(rows)), F.col("__lead"), scorer, stage)
    kept = said.where(~F.col("__lead") | F.col("raw").isNotNull())
    gone = F.col("__lead") & ~answered_yes(F.col("raw"))
    return kept.withColumns(
        {
            "rationale": F.when(gone, F.lit("[rejected by stage1 micro-LLM]")).otherwise(F.col("rationale")),
            "stage": F.when(gone, F.lit("stage1b")).otherwise(F.col("stage")),
            "is_lead": F.col("is_lead") & ~gone,
        }
    ).drop("__lead", "raw")


def buyer(messages: DataFrame, pack: DomainPack, scorer: Scorer, reasons: Sequence[str], blocked: Column | None = None) -> DataFrame:
    """Extraction, the second stage, judge and certainty gate; adds certainty and uncertainty_reason.

    Rows that ``blocked`` names never meet a model: they become decisions against, persisted
    and open to the cascade like any other.
    """
    stop = F.lit(False) if blocked is None else F.coalesce(blocked, F.lit(False))
    marked = messages.withColumn("__stop", stop)
    rows = extract(marked.where(~F.col("__stop")).drop("__stop"), pack, scorer)
    rows = second_look(rows, scorer)
    judged = asked(rows.withColumn("__lead", _lead(rows)), F.col("__lead"), scorer, "judge")
    said = F.upper(ustrip(reply(F.col("raw"), "verdict string")["verdict"]))
    verdict = F.when(said.isin("REAL_LEAD", "MISTAKE"), said).otherwise(F.lit("REVIEW"))
    judged = judged.withColumn("verdict", F.when(F.col("__lead"), verdict)).drop("raw", "__lead")
    gated = asked(judged, F.col("verdict") == "REAL_LEAD", scorer, "certainty")
    answer = reply(F.col("raw"), "certainty string, uncertainty_reason string")
    made = gated.withColumn("__c", certainty(F.col("verdict"), answer["certainty"], answer["uncertainty_reason"], reasons))
    made = made.withColumns({"certainty": F.col("__c.certainty"), "uncertainty_reason": F.col("__c.reason")}).drop("raw", "__c")
    none = F.lit(None).cast("string")
    shut = opened(marked.where("__stop").drop("__stop")).withColumns(
        {"stage": F.lit("blocked"), "is_lead": F.lit(False), "lead_type": F.lit("none"), "rationale": F.lit("[blocked by anti-filter]"), "certainty": none, "uncertainty_reason": none}
    )
    return made.unionByName(shut)


def provider(messages: DataFrame, pack: DomainPack, scorer: Scorer, codebook: bool = False) -> DataFrame:
    """Extraction behind a lenient yes stage, then a judge.

    The plain judge's unknown verdict confirms and its failure asks for review; the codebook's
    answers map to verdict and certainty, and anything else is an uncertain lead.
    """
    rows = extract(messages, pack, scorer, stage1="has_yes")
    judged = asked(rows.withColumn("__lead", _lead(rows)), F.col("__lead"), scorer, "judge")
    said = F.upper(ustrip(reply(F.col("raw"), "verdict string")["verdict"]))
    none = F.lit(None).cast("string")
    if codebook:
        verdict, sure, why = F.lit("REAL_PROVIDER"), F.lit("UNCERTAIN"), F.lit("gate_api_error")
        for answer, (v, c, r) in CODEBOOK.items():
            hit = said == answer
            verdict, sure, why = F.when(hit, F.lit(v)).otherwise(verdict), F.when(hit, F.lit(c).cast("string")).otherwise(sure), F.when(hit, F.lit(r).cast("string")).otherwise(why)
    else:
        failed = json_object(F.col("raw")).isNull()
        verdict, sure, why = F.when(failed, "REVIEW").when(said == "MISTAKE", "MISTAKE").otherwise(F.lit("REAL_PROVIDER")), none, none
    lead = F.col("__lead")
    return judged.withColumns({"verdict": F.when(lead, verdict), "certainty": F.when(lead, sure), "uncertainty_reason": F.when(lead, why)}).drop("raw", "__lead")


def traffic(messages: DataFrame, pack: DomainPack, scorer: Scorer, reasons: Sequence[str], gate: bool = True, enforce: bool = True) -> DataFrame:
    """Extraction behind a stage that any NO ends, traffic-type drop, judge, alignment, resolver or gate, merchant gate.

    A failed judge confirms the extractor. Where they disagree a resolver decides, or without
    ``gate`` the lead is a mistake. Only agreed leads are gated; errors make them uncertain.
    Needs the extraction's ``traffic_type`` (array) in its JSON; adds traffic_type, certainty,
    uncertainty_reason and is_merchant.
    """
    rows = extract(messages, pack, scorer, stage1="no_no", extra="traffic_type array<string>")
    typed = rows.withColumn("__t", traffic_stage(F.coalesce("traffic_type", F.array().cast("array<string>")), _lead(rows), enforce=enforce))
    dropped = _lead(typed) & ~F.col("__t.is_lead")
    rows = typed.withColumns(
        {
            "verdict": F.when(dropped, F.lit("MISTAKE")).otherwise(F.col("verdict")),
            "rationale": F.when(dropped, F.concat(F.lit("[traffic_type="), F.col("__t.type"), F.lit(": not routed] "), F.coalesce("rationale", F.lit("")))).otherwise(F.col("rationale")),
            "stage": F.when(dropped, F.lit("traffic_type")).otherwise(F.col("stage")),
            "is_lead": F.col("is_lead") & ~dropped,
            "traffic_type": F.col("__t.type"),
        }
    ).drop("__t")
    judged = asked(rows.withColumn("__lead", _lead(rows)), F.col("__lead"), scorer, "judge")
    own = expected_verdict(F.col("lead_type"), TRAFFIC_VERDICTS)
    said = F.when(json_object(F.col("raw")).isNull(), own).otherwise(reply(F.col("raw"), "verdict string")["verdict"])
    judged = judged.withColumns({"__said": said, "__agree": F.coalesce(said == own, F.lit(False))}).drop("raw")
    lead = F.col("__lead")
    none = F.lit(None).cast("string")
    if gate:
        resolved = asked(judged, lead, scorer, "gate")
        answer = reply(F.col("raw"), "label string, role string, uncertainty_reason string")
        failed = ~F.coalesce(answer["label"].isin("lead", "not_lead", "uncertain"), F.lit(False))
        known = F.when(answer["uncertainty_reason"].isin(*reasons), answer["uncertainty_reason"])
        sure = F.when(~failed & (answer["label"] == "lead"), "CERTAIN").otherwise(F.lit("UNCERTAIN"))
        why = F.when(failed, "gate_api_error").when(answer["label"] == "lead", none).otherwise(F.coalesce(known, F.when(answer["label"] == "not_lead", "gate_not_lead").otherwise(F.lit("other"))))
        agreed = F.struct(F.lit(True).alias("is_lead"), F.col("lead_type").alias("lead_type"), own.alias("verdict"), sure.alias("certainty"), why.alias("reason"))
        settled = resolve_mismatch(F.col("lead_type"), answer["label"], answer["role"], answer["uncertainty_reason"], failed, TRAFFIC_ROLES, TRAFFIC_VERDICTS, reasons)
        judged = resolved.withColumn("__r", F.when(F.col("__agree"), agreed).otherwise(settled)).drop("raw")
    else:
        judged = judged.withColumn(
            "__r",
            F.struct(
                F.col("__agree").alias("is_lead"), F.col("lead_type").alias("lead_type"), F.when(F.col("__agree"), own).otherwise(F.lit("MISTAKE")).alias("verdict"),
                none.alias("certainty"), none.alias("reason"),
            ),
        )
    judged = judged.withColumns(
        {
            "is_lead": F.when(lead, F.col("__r.is_lead")).otherwise(F.col("is_lead")),
            "lead_type": F.when(lead, F.col("__r.lead_type")).otherwise(F.col("lead_type")),
            "verdict": F.when(lead, F.col("__r.verdict")).otherwise(F.col("verdict")),
            "certainty": F.when(lead, F.col("__r.certainty")),
            "uncertainty_reason": F.when(lead, F.col("__r.reason")),
        }
    ).drop("__r", "__said", "__agree", "__lead")
    wanted = F.col("is_lead") & (F.col("verdict") == "TRAFFIC_LEAD") & (F.col("lead_type") == "seeking_traffic")
    said = asked(judged, wanted, scorer, "merchant")
    word = F.lower(ustrip(F.get_json_object(json_object(F.col("raw")), "$.is_merchant")))
    return said.withColumn("is_merchant", F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))).drop("raw")


def with_author_texts(messages: DataFrame, history: DataFrame, author: str = "username", text: str = "text", at: str = "created_at", as_of: bool = False) -> DataFrame:
    """Adds ``combined``: the text with its author's last ten stored texts, newest first, cut at 3,000 characters.

    With ``as_of`` the messages have ``at`` too and see only what was stored before; without,
    all see the same, the latest. History is then thinned per author within hash buckets
    before its ten are chosen, so a busy author is no hot task.
    """
    from pyspark.sql.window import Window

    if as_of:
        met = context.history_as_of(messages, history, author, at, text, CONTEXT_TEXTS, CONTEXT_CHARS)
        return met.withColumn("combined", _combined(F.col(text), F.col("earlier"))).drop("earlier")

    stored = history.where(F.col(author).isNotNull() & (F.coalesce(F.col(text), F.lit("")) != "")).select(F.col(author).alias("__author"), F.col(at).alias("__at"), F.col(text).alias("__text"))
    order = [F.desc("__at"), "__text"]
    near = Window.partitionBy("__author", F.pmod(F.xxhash64("__text"), F.lit(32))).orderBy(*order)
    thin = stored.withColumn("__r", F.row_number().over(near)).where(F.col("__r") <= CONTEXT_TEXTS)
    last = thin.withColumn("__r", F.row_number().over(Window.partitionBy("__author").orderBy(*order))).where(F.col("__r") <= CONTEXT_TEXTS)
    texts = last.groupBy("__author").agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", "__text"))), lambda x: x["__text"]).alias("__texts"))
    joined = messages.join(texts, F.col(author) == F.col("__author"), "left")
    return joined.withColumn("combined", _combined(F.col(text), F.coalesce("__texts", F.array().cast("array<string>")))).drop("__author", "__texts")


def _combined(text: Column, earlier: Column) -> Column:
    whole = F.array_join(F.concat(F.array(ustrip(text)), earlier), CONTEXT_SEPARATOR)
    return F.when(F.length(whole) > CONTEXT_CHARS, F.concat(F.substring(whole, 1, CONTEXT_CHARS), F.lit(CONTEXT_CUT))).otherwise(whole)


@dataclass(frozen=True)
class Verified:
    """A fail-closed classifier: patterns, a verifying call, an extracting call; any failure means no lead."""

    name: str
    wanted: Sequence[str]
    unwanted: Sequence[str] = ()
    verify: str = "is_lead"
    decide: str = "verdict"
    decided: str = "REAL_LEAD"
    text: str = "text"
    context: bool = False


CASINO = Verified("casino", patterns.CASINO)
ACCOUNTS = Verified("iban", patterns.ACCOUNTS, patterns.NOT_ACCOUNTS, "is_buyer", "judged_as", "buyer", "combined", True)
PROCESSORS = Verified("psp", patterns.PROCESSORS, (), "is_psp", "judged_as", "provider")
COINS = Verified("coins", patterns.COINS, patterns.NOT_COINS)


def verified(messages: DataFrame, kind: Verified, scorer: Scorer) -> DataFrame:
    """Adds is_lead and stage: blank, stopped, no_hits, verify, extract or lead. Patterns read ``kind.text``."""
    said = F.col(kind.text)
    unwanted = any_hit(said, kind.unwanted) if kind.unwanted else F.lit(False)
    wanted = any_hit(said, kind.wanted)
    early = F.when(is_blank(F.col("text")), "blank").when(unwanted & F.lit(kind.context), "stopped").when(~wanted, "no_hits").when(unwanted, "stopped")
    rows = cut(messages.withColumn("__early", early), "gated")
    checked = asked(rows, F.col("__early").isNull(), scorer, f"{kind.name}_verify")
    checked = checked.withColumn("__yes", F.col("__early").isNull() & F.coalesce(F.get_json_object(json_object(F.col("raw")), f"$.{kind.verify}") == "true", F.lit(False))).drop("raw")
    done = asked(checked, F.col("__yes"), scorer, f"{kind.name}_extract")
    lead = F.col("__yes") & F.coalesce(F.get_json_object(json_object(F.col("raw")), f"$.{kind.decide}") == kind.decided, F.lit(False))
    stage = F.coalesce(F.col("__early"), F.when(~F.col("__yes"), "verify").when(~lead, "extract").otherwise(F.lit("lead")))
    return done.withColumns({"is_lead": lead, "stage": stage}).drop("raw", "__early", "__yes")


def coin_buyer(messages: DataFrame, pack: DomainPack, scorer: Scorer, source_id: str = "source_lead_id") -> DataFrame:
    """Extraction and judge; only a REAL_LEAD with a source row counts (review doesn't): that row is relabelled.

    Adds ``relabelled``, and keeps the decision columns of the others.
    """
    ready = F.col(source_id).isNotNull() & ~is_blank(F.col("text"))
    rest = opened(messages.where(~ready)).withColumns({"stage": F.lit("skip"), "is_lead": F.lit(False)})
    rows = extract(messages.where(ready), pack, scorer)
    judged = asked(rows.withColumn("__lead", _lead(rows)), F.col("__lead"), scorer, "judge")
    said = F.upper(ustrip(reply(F.col("raw"), "verdict string")["verdict"]))
    verdict = F.when(F.col("__lead"), F.when(said.isin("REAL_LEAD", "MISTAKE"), said).otherwise(F.lit("REVIEW")))
    made = judged.withColumn("verdict", verdict).drop("raw", "__lead").unionByName(rest)
    return made.withColumn("relabelled", F.coalesce(F.col("is_lead") & (F.col("verdict") == "REAL_LEAD"), F.lit(False)))


def cascade_run(messages: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], key: str = "message_id") -> DataFrame:
    """(key, claimed_by): each step sees what no earlier one claimed. A step returns (key, claimed boolean).

    Only the keys that a step claims are written; while they are few they are broadcast, and no text moves.
    """
    claimed, rest = None, messages
    for name, step in steps:
        hits = cut(step(rest).where("claimed").select(key, F.lit(name).alias("claimed_by")), f"cascade-{name}")
        claimed = hits if claimed is None else claimed.unionByName(hits)
        rest = rest.join(dimension(hits.select(key), 1_000_000), key, "left_anti")
    return claimed.unionByName(rest.select(key, F.lit(None).cast("string").alias("claimed_by")))


def isolated(messages: DataFrame, runs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame | None, dict[str, str]]:
    """(decisions with ``pipeline``, errors by name): a pipeline that fails has no rows and stops no other.

    Each pipeline's decisions are written before the next starts.
    """
    made, errors = None, {}
    for name, run in runs.items():
        try:
            rows = cut(run(messages).withColumn("pipeline", F.lit(name)), f"run-{name}")
        except Exception as failure:  # whatever a model or a task raised
            logging.getLogger(__name__).error("pipeline %s failed: %s", name, failure)
            errors[name] = str(failure).splitlines()[0] if str(failure) else type(failure).__name__
            continue
        made = rows if made is None else made.unionByName(rows, allowMissingColumns=True)
    return made, errors


def merchant(raw: Column, text: Column, aggregators: Sequence[str], fallback: bool | None = True) -> Column:
    """Whether the author is a merchant: aggregator words say no without a call, a failed call gives the fallback."""
    from tidemark.functions.text import contains_any

    label = F.get_json_object(json_object(raw), "$.label")
    return F.when(contains_any(text, aggregators), F.lit(False)).when(label.isNull(), F.lit(fallback).cast("boolean")).otherwise(label == "direct_merchant")
