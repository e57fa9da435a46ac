"""Classification state machines as column expressions over recorded or fresh model outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.normalise import collapse_traffic_type, normalise_traffic_types
from tidemark.functions.text import clamp01, is_blank, json_object, ustrip
from tidemark.operators.gates import DomainPack, gate, long_enough
from tidemark.operators.scoring import Scorer, asked, on_subset
from tidemark.session import cut

def _closed(rows: DataFrame, stage: str, confidence: float, rationale: str) -> DataFrame:
    """Rows that end here as non-leads."""
    return rows.withColumns({"stage": F.lit(stage), "is_lead": F.lit(False), "confidence": F.lit(confidence), "rationale": F.lit(rationale)})


def opened(messages: DataFrame) -> DataFrame:
    """Decision columns, all undecided."""
    none = F.lit(None)
    return messages.withColumns(
        {"stage": none.cast("string"), "is_lead": none.cast("boolean"), "confidence": none.cast("double"), "lead_type": none.cast("string"), "verdict": none.cast("string"), "rationale": none.cast("string")}
    )


def answered_no(raw: Column) -> Column:
    """The strict reading: only an exact negative rejects, so failures and chatter pass."""
    return F.upper(F.regexp_replace(ustrip(F.coalesce(raw, F.lit(""))), r"[.!\"']+", "")).isin("NO", "N", "NOT")


def answered_yes(raw: Column) -> Column:
    """The loose reading: must start with YES."""
    return F.upper(ustrip(F.coalesce(raw, F.lit("")))).startswith("YES")


def extract(messages: DataFrame, pack: DomainPack, scorer: Scorer, text: str = "text", fail_open: bool = True, stage1: str | None = None, extra: str | None = None) -> DataFrame:
    """Length gate, lexical gate, yes/no stage, extraction: one row per message with its ending stage.

    Too short -> skipped; gate -> not a lead with confidence 1; stage 1 rejects only exact
    negatives when ``fail_open`` (else needs a yes), or as ``stage1`` names it (see
    ``classifiers.lets_through``); a failed extraction is not a lead with confidence 0;
    ``lead_type`` survives only for leads. ``extra`` names one more field of the extraction
    (name and type), which becomes a column.
    """
    from tidemark.operators.classifiers import lets_through

    field, kind = extra.split(" ", 1) if extra else (None, None)
    messages = messages.withColumn(field, F.lit(None).cast(kind)) if extra else messages
    why = F.when(~long_enough(F.col(text)), "skip").when(~gate(F.col(text), pack), "prefilter")
    rows = opened(messages).withColumn("__why", why)
    early = rows.where("__why is not null")
    told = F.when(F.col("__why") == "skip", "too short").otherwise("[pre-filtered]")
    early = early.withColumns({"stage": F.col("__why"), "is_lead": F.lit(False), "confidence": F.lit(1.0), "rationale": told}).drop("__why")
    # what a scorer said is written before it is read twice, so no model is called twice
    live = cut(scorer.score(rows.where("__why is null").drop("__why"), "stage1"), "stage1")
    rejects = ~lets_through(F.col("raw"), stage1 or ("not_no" if fail_open else "starts_yes"))
    rejected = _closed(live.where(rejects).drop("raw"), "stage1", 1.0, "[stage1: NO]")
    said = cut(scorer.score(live.where(~rejects).drop("raw"), "extract"), "extract")
    data = F.from_json(json_object(F.col("raw")), "is_lead boolean, confidence string, lead_type string, rationale string" + (f", {extra}" if extra else ""))
    said = said.withColumn("__d", data).drop("raw")
    broken = F.col("__d").isNull() | F.col("__d.is_lead").isNull()
    failed = _closed(said.where(broken).drop("__d"), "error", 0.0, "extraction failed")
    lead = F.col("__d.is_lead")
    decided = said.where(~broken).withColumns(
        {
            "is_lead": lead,
            "confidence": clamp01(F.col("__d.confidence")),
            "lead_type": F.when(lead, F.col("__d.lead_type")),
            "rationale": F.col("__d.rationale"),
            "stage": F.when(lead, "extracted").otherwise("not_lead"),
            **({field: F.col(f"__d.{field}")} if extra else {}),
        }
    )
    return early.unionByName(rejected).unionByName(failed).unionByName(decided.drop("__d"))


def judge(rows: DataFrame, scorer: Scorer, known: Sequence[str] = ("REAL_LEAD", "MISTAKE"), fallback: str = "REVIEW") -> DataFrame:
    """Adds the judge's verdict to leads; an unknown or missing one is the fallback."""
    scored = asked(rows, F.col("is_lead"), scorer, "judge")
    said = F.upper(ustrip(F.get_json_object(json_object(F.col("raw")), "$.verdict")))
    verdict = F.when(said.isin(*known), said).otherwise(F.lit(fallback))
    return scored.withColumn("verdict", F.when(F.col("is_lead"), verdict)).drop("raw")


def certainty(verdict: Column, said: Column, reason: Column, reasons: Sequence[str], default: str = "no_explicit_payment_term", applies: str = "REAL_LEAD") -> Column:
    """(certainty, reason) of a confirmed lead; errors and unknown words are CERTAIN."""
    word = F.upper(ustrip(F.coalesce(said, F.lit("CERTAIN"))))
    unsure = word == "UNCERTAIN"
    valid = F.when(ustrip(reason).isin(*reasons), ustrip(reason))
    made = F.struct(
        F.when(unsure, F.lit("UNCERTAIN")).otherwise(F.lit("CERTAIN")).alias("certainty"),
        F.when(unsure, F.coalesce(valid, F.lit(default))).otherwise(valid).alias("reason"),
    )
    return F.when(verdict == applies, made)


def expected_verdict(lead_type: Column, table: dict[str, str]) -> Column:
    found = F.lit(None).cast("string")
    for kind, verdict in table.items():
        found = F.when(lead_type == kind, F.lit(verdict)).otherwise(found)
    return found


def align(lead_type: Column, verdict: Column, notes: Column, table: dict[str, str]) -> Column:
    """(is_lead, verdict, notes): an extractor and a judge that disagree make a MISTAKE, explained from both."""
    agrees = F.coalesce(expected_verdict(lead_type, table) == verdict, F.lit(False))
    told = F.concat(F.lit("[type_mismatch: stage3="), F.coalesce(lead_type, F.lit("None")), F.lit(", stage4="), F.coalesce(verdict, F.lit("None")), F.lit("] "), F.coalesce(notes, F.lit("")))
    return F.struct(
        agrees.alias("is_lead"),
        F.when(agrees, verdict).otherwise(F.lit("MISTAKE")).alias("verdict"),
        F.when(agrees, notes).otherwise(told).alias("notes"),
    )


def resolve_mismatch(lead_type: Column, label: Column, role: Column, reason: Column, failed: Column, roles: dict[str, str], verdicts: dict[str, str], reasons: Sequence[str]) -> Column:
    """(is_lead, lead_type, verdict, certainty, reason) after a mismatch went to a resolver.

    A failed call keeps the lead but never as certain; ``not_lead`` drops it; otherwise a
    clear role replaces the type, and only a lead with a clear role is certain.
    """
    mapped = expected_verdict(role, roles)
    kind = F.when(failed, lead_type).when(label == "not_lead", lead_type).otherwise(F.coalesce(mapped, lead_type))
    dropped = ~failed & (label == "not_lead")
    certain = ~failed & (label == "lead") & mapped.isNotNull()
    why = F.when(failed, F.lit("gate_api_error")).when(mapped.isNull(), F.lit("role_unclear")).when(reason.isin(*reasons), reason).otherwise(F.lit("other"))
    return F.struct(
        (~dropped).alias("is_lead"),
        kind.alias("lead_type"),
        F.when(dropped, F.lit("MISTAKE")).otherwise(expected_verdict(kind, verdicts)).alias("verdict"),
        F.when(dropped, F.lit(None).cast("string")).when(certain, F.lit("CERTAIN")).otherwise(F.lit("UNCERTAIN")).alias("certainty"),
        F.when(dropped | certain, F.lit(None).cast("string")).otherwise(why).alias("reason"),
    )


def traffic_stage(types: Column, is_lead: Column, dropped: Sequence[str] = ("database", "infra", "none"), enforce: bool = True) -> Column:
    """(types, type, is_lead): leads whose collapsed traffic type isn't routed end here."""
    known = normalise_traffic_types(types)
    one = collapse_traffic_type(known)
    drop = F.coalesce(one.isin(*dropped), F.lit(False)) if enforce else F.lit(False)
    return F.struct(known.alias("types"), one.alias("type"), (is_lead & ~drop).alias("is_lead"))


def panel_vote(panel: DataFrame, key: str = "message_id", judge_consensus_lead: bool = True) -> DataFrame:
    """(key, valid, leads, outcome) from one row per (message, model) with status and is_lead.

    Fewer than two valid votes -> judge; all against -> consensus_not_lead; all for -> judge
    unless the flag is off; otherwise judge.
    """
    ok = (F.col("status") == "ok") & F.col("is_lead").isNotNull()
    votes = panel.groupBy(key).agg(F.count_if(ok).alias("valid"), F.count_if(ok & F.col("is_lead")).alias("leads"))
    outcome = (
        F.when(F.col("valid") < 2, "judge")
        .when(F.col("leads") == 0, "consensus_not_lead")
        .when((F.col("leads") == F.col("valid")) & F.lit(not judge_consensus_lead), "consensus_lead")
        .otherwise("judge")
    )
    return votes.withColumn("outcome", outcome)


def panel_merge(panel: DataFrame, key: str = "message_id", order: str = "position", arrays: Sequence[str] = ("geo",)) -> DataFrame:
    """One row per message from its valid panel rows: ordered unions, mean confidence, joined rationales."""
    said = F.concat(F.col("confidence").cast("string"), F.lit(" ("), F.col("model"), F.lit("): "), F.trim("rationale"))
    rows = panel.where("status = 'ok'").withColumn("__s", F.struct(order, *arrays, said.alias("said")))
    kept = rows.groupBy(key).agg(F.array_sort(F.collect_list("__s")).alias("__p"), F.round(F.avg("confidence"), 3).alias("confidence"))

    def union(name: str) -> Column:
        return F.array_distinct(F.flatten(F.transform("__p", lambda x: x[name]))).alias(name)

    unions = [union(name) for name in arrays]
    return kept.select(key, *unions, "confidence", F.array_join(F.transform("__p", lambda x: x["said"]), " | ").alias("rationale"))


def scam_gate(messages: DataFrame, keywords: Column, scorer: Scorer) -> DataFrame:
    """Keyword hits go to the model; only its yes makes a scam, an error passes."""
    scored = on_subset(messages, keywords, scorer, "scam")
    return scored.withColumn("is_scam", answered_yes(F.col("raw"))).drop("raw")


def cascade(messages: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds the first stage that claims each non-lead message."""
    name = F.lit(None).cast("string")
    for label, holds in reversed(stages):
        name = F.when(F.coalesce(holds, F.lit(False)), F.lit(label)).otherwise(name)
    return messages.withColumn("claimed_by", F.when(F.col("is_lead"), F.lit(None).cast("string")).otherwise(name))


def disposition(messages: DataFrame, duplicate: Column, banned: Column, scam: Column, blocked: Column) -> DataFrame:
    """Ordered gates of a stream: duplicate, then ban, then scam, then anti-filter, else classify."""
    name = F.when(duplicate, "duplicate").when(banned, "banned").when(scam, "scam").when(blocked, "blocked").otherwise("classify")
    return messages.withColumn("disposition", name)


def prompt(template: Sequence[Column | str]) -> Column:
    """A prompt from literal pieces and columns; nulls are empty, blank pieces are left out."""
    parts = [F.lit(p) if isinstance(p, str) else p for p in template]
    return F.concat(*[F.when(is_blank(p), F.lit("")).otherwise(p) for p in parts])
