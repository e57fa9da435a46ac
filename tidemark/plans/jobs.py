"""Whole jobs: building a glossary, classifying a batch, and serving a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import is_blank, json_object, text_hash, truncated, ustrip
from tidemark.functions.unicode import repaired_json
from tidemark.operators import classifiers, dedup, gates, gazetteer, lemmas, mining, pipelines, refine, sampling
from tidemark.operators.scoring import Scorer, on_subset
from tidemark.patterns import DEFINITIONS
from tidemark.session import cut, dimension

SENSES = "array<struct<definition:string,context_clues:array<string>,example_message_ids:array<bigint>>>"
CRITIQUE = "issue_severity string, domain_specific boolean, wrongly_admitted_noise boolean, missing_senses array<struct<description:string>>"
DRAFT = f"relevant boolean, confidence double, reasoning string, senses {SENSES}"


@dataclass(frozen=True)
class GlossaryPlan:
    """Parameters of a glossary build.

    ``lemmas`` is a table (form, lemma); without one, terms cluster by case alone. Drafts of at
    most ``research_at_most`` confidence are researched; null turns that off.
    """

    gazetteer: Sequence[Mapping] = ()
    brand_patterns: Mapping[str, str] = field(default_factory=dict)
    skip: Sequence[str] = ()
    blocklist: Sequence[str] = ()
    least: int = 3
    top: int = 200
    phrase_batches: int = 30
    phrase_batch: int = 20
    lemmas: DataFrame | None = None
    definitions: Sequence[tuple[str, str]] = DEFINITIONS
    examples: int = 15
    example_chars: int = 400
    research_at_most: float | None = 0.5


def candidate_pools(messages: DataFrame, plan: GlossaryPlan, key: str = "message_id", phrases: Sequence[str] = (), scorer: Scorer | None = None) -> DataFrame:
    """Rules, gazetteer, phrases and brands, in that order, then clustered by lemmas or case.

    Without a scorer this is the deterministic half of a build; with one, only brands that it confirms are in.
    """
    rules = mining.candidates(mining.message_tokens(messages, key), plan.least, skip=plan.skip)
    pools = [rules.select("term", "kind", "frequency", "surface_forms")]
    if plan.gazetteer:
        pools.append(mining.gazetteer_scan(messages, plan.gazetteer, key))
    empty = F.array().cast("array<string>")
    if phrases:
        found = mining.phrase_backfill(messages, phrases, key)
        kind = F.when(F.rlike("phrase", F.lit(r"[Ѐ-ӿ]")), "phrase_ru").otherwise("phrase_en")
        pools.append(found.select(F.col("phrase").alias("term"), kind.alias("kind"), "frequency", empty.alias("surface_forms")))
    if plan.brand_patterns:
        brands = mining.mine_brands(messages, plan.brand_patterns, skip=plan.skip)
        if scorer is not None:
            brands = confirmed_brands(cut(brands, "mined-brands"), scorer, key)
        pools.append(brands.select(F.col("brand").alias("term"), F.lit("brand").alias("kind"), "frequency", empty.alias("surface_forms")))
    pooled = mining.pooled(*pools)
    if plan.lemmas is None:
        return mining.cluster(pooled)
    return mining.cluster(lemmas.with_lemma_key(cut(pooled, "pools"), plan.lemmas), F.col("lemma_key"))


def term_evidence(messages: DataFrame, terms: DataFrame, key: str = "message_id", examples: int = 15, chars: int = 400, templates: Sequence[tuple[str, str]] = DEFINITIONS) -> DataFrame:
    """Adds ``examples`` (id, text), ``definitions`` and ``prompt`` to a table of at most some hundred terms.

    One automaton pass finds the messages that hold a term or one of its surface forms as
    words; only ids are sampled, by hash, and the texts of the chosen ones are fetched then and
    shown up to ``chars`` characters. Definitions are the inline ones of the term itself. A term
    that no message holds has none of either.
    """
    spelled = F.array_distinct(F.concat(F.array("term"), F.coalesce("surface_forms", F.array().cast("array<string>"))))
    forms = terms.select("term", "kind", F.posexplode(spelled).alias("at", "form")).select("term", "kind", "form", F.col("at").cast("bigint").alias("at"), F.lit(True).alias("alone"))
    held = gazetteer.form_hits(messages.select(key, "text"), forms, [key], "text").select(F.col("term").alias("norm"), F.col(key).alias("id"))
    chosen = cut(mining.hash_examples(held, examples), "examples")
    met = messages.select(F.col(key).alias("id"), "text").join(dimension(chosen), "id")
    line = truncated(F.replace(ustrip(F.col("text")), F.lit("\n"), F.lit(" ")), chars)
    shown = F.transform(F.array_sort(F.collect_list(F.struct("r", "id", line.alias("text")))), lambda x: F.struct(x["id"].alias("id"), x["text"].alias("text")))
    seen = met.groupBy(F.col("norm").alias("term")).agg(shown.alias("examples"))
    names = [r["term"] for r in terms.select("term").orderBy("term").collect()]
    found = mining.self_definitions(messages, names, key, templates=templates)
    said = found.groupBy("term").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "definition"))), lambda x: x["definition"]).alias("definitions"))
    rows = terms.join(seen, "term", "left").join(said, "term", "left")
    rows = rows.withColumn("definitions", F.coalesce("definitions", F.array().cast("array<string>")))
    rows = rows.withColumn("examples", F.coalesce("examples", F.array().cast(dict(rows.dtypes)["examples"])))
    blocks = [
        F.concat(F.lit("Term: "), "term", F.lit(" ("), "kind", F.lit(", "), F.col("frequency").cast("string"), F.lit(" messages)")),
        F.concat(F.lit("Forms: "), F.array_join("surface_forms", ", ")),
        F.when(F.size("definitions") > 0, F.concat(F.lit("Inline definitions:\n"), F.array_join(F.transform("definitions", lambda x: F.concat(F.lit("- "), x)), "\n"))),
        F.when(F.size("examples") > 0, F.concat(F.lit("Examples:\n"), F.array_join(F.transform("examples", lambda x: F.concat(F.lit("["), x["id"].cast("string"), F.lit("] "), x["text"])), "\n"))),
    ]
    return rows.withColumn("prompt", F.concat_ws("\n", *blocks))


def _asked_if_any(rows: DataFrame, wanted: Column, scorer: Scorer, stage: str) -> DataFrame:
    """``on_subset``, written; where no row is wanted the scorer isn't asked. ``rows`` are written already."""
    wanted = F.coalesce(wanted, F.lit(False))
    if rows.where(wanted).isEmpty():
        return rows.withColumn("raw", F.lit(None).cast("string"))
    return cut(on_subset(rows, wanted, scorer, stage), stage)


def extract_phrases(messages: DataFrame, scorer: Scorer, plan: GlossaryPlan, key: str = "message_id") -> list[str]:
    """Phrases that a model finds in a bounded, shuffled sample of messages (batches x batch size rows)."""
    sample = sampling.hash_batches(messages.select(key, "text"), key, plan.phrase_batch, plan.phrase_batches)
    prompts = sample.groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "text"))), lambda m: F.concat(F.lit("- "), m["text"])), "\n").alias("text"))
    said = scorer.score(prompts.withColumn(key, F.col("batch").cast("bigint")), "phrases")
    found = said.select(F.explode(F.from_json(F.get_json_object(json_object(F.col("raw")), "$.phrases"), "array<string>")).alias("p"))
    kept = found.select(ustrip(F.col("p")).alias("p")).where(F.length("p").between(3, 60)).distinct().orderBy("p")
    return [r["p"] for r in kept.limit(plan.phrase_batch * plan.phrase_batches).collect()]


def confirmed_brands(brands: DataFrame, scorer: Scorer, key: str = "message_id") -> DataFrame:
    """The mined brands that the scorer calls brands (stage ``brands``, JSON ``is_brand``); a failed call confirms none."""
    asked = brands.withColumns({key: F.xxhash64("brand"), "text": F.col("brand")})
    said = cut(scorer.score(asked, "brands"), "brands")
    return said.where(F.lower(F.get_json_object(json_object(F.col("raw")), "$.is_brand")) == "true").select(*brands.columns)


def researched(drafts: DataFrame, scorer: Scorer, at_most: float = 0.5) -> DataFrame:
    """Relevant drafts of low confidence take a researched definition of their first sense, where the reply accepts it.

    The stage ``research`` answers with accept_web_info, definition and confidence; what it
    leaves out stays as drafted. ``source_stage`` tells whose the definition is.
    """
    wanted = refine.wants_research(F.col("relevant"), F.col("confidence"), at_most)
    said = _asked_if_any(drafts.withColumn("__w", F.coalesce(wanted, F.lit(False))), F.col("__w"), scorer, "research")
    answer = F.from_json(json_object(F.col("raw")), "accept_web_info boolean, definition string, confidence string")
    rows = said.withColumn("__a", answer)
    taken = F.col("__w") & F.coalesce(F.col("__a.accept_web_info"), F.lit(False))
    old = F.get("senses", 0)
    first = F.struct(
        F.coalesce(F.nullif(ustrip(F.col("__a.definition")), F.lit("")), old["definition"]).alias("definition"),
        F.coalesce(old["context_clues"], F.array().cast("array<string>")).alias("context_clues"),
        F.coalesce(old["example_message_ids"], F.array().cast("array<bigint>")).alias("example_message_ids"),
    )
    rest = F.when(F.size("senses") > 1, F.slice("senses", 2, F.size("senses"))).otherwise(F.array().cast(SENSES))
    return rows.withColumns(
        {
            "senses": F.when(taken, F.concat(F.array(first).cast(SENSES), rest)).otherwise(F.col("senses")),
            "confidence": F.when(taken, F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__a.confidence").try_cast("double"))), F.col("confidence"))).otherwise(F.col("confidence")),
            "source_stage": F.when(taken, F.lit("research")).otherwise(F.lit("inference")),
        }
    ).drop("__a", "__w", "raw")


def enriched_senses(terms: DataFrame, scorer: Scorer) -> DataFrame:
    """Relevant entries whose critique misses senses are asked for them (stage ``enrichment``, JSON ``new_senses``).

    Needs ``missing`` (descriptions). Senses without a definition are left out, ids that are no
    numbers too; where any sense is added the confidence rises a little. A failed call adds none.
    """
    said = _asked_if_any(terms, F.col("relevant") & (F.size("missing") > 0), scorer, "enrichment")
    reply = F.from_json(json_object(F.col("raw")), "new_senses array<struct<definition:string,context_clues:array<string>,example_message_ids:array<string>>>")["new_senses"]
    none = F.array()

    def sense(s: Column) -> Column:
        ids = F.transform(F.coalesce(s["example_message_ids"], none.cast("array<string>")), lambda i: i.try_cast("bigint"))
        return F.struct(
            ustrip(s["definition"]).alias("definition"),
            F.coalesce(s["context_clues"], none.cast("array<string>")).alias("context_clues"),
            F.filter(ids, lambda i: i.isNotNull()).alias("example_message_ids"),
        )

    added = F.transform(F.filter(F.coalesce(reply, none.cast("array<struct<definition:string,context_clues:array<string>,example_message_ids:array<string>>>")), lambda s: ~is_blank(s["definition"])), sense)
    rows = said.withColumn("__new", added.cast(SENSES))
    more = F.size("__new") > 0
    made = {
        "senses": F.concat("senses", "__new"),
        "confidence": refine.enriched(F.col("confidence"), F.size("__new")),
        "source_stage": F.when(more, F.concat("source_stage", F.lit("+enrichment"))).otherwise(F.col("source_stage")),
    }
    return rows.withColumns(made).drop("__new", "raw")


def distinct_senses(terms: DataFrame, scorer: Scorer) -> DataFrame:
    """Relevant entries of several senses keep those that the scorer calls distinct (stage ``paraphrase``, JSON ``kept_sense_indices``).

    Positions count from 0; those that don't exist are ignored, and without a valid one all senses stay.
    """
    said = _asked_if_any(terms, F.col("relevant") & (F.size("senses") >= 2), scorer, "paraphrase")
    kept = F.from_json(json_object(F.col("raw")), "kept_sense_indices array<string>")["kept_sense_indices"]
    indices = F.transform(kept, lambda i: i.try_cast("int"))
    rows = said.withColumn("__n", F.size("senses")).withColumn("senses", refine.keep_indices(F.col("senses"), indices))
    alone = (F.size("senses") == 1) & (F.col("__n") > 1)
    return rows.withColumn("source_stage", F.when(alone, F.replace("source_stage", F.lit("+enrichment"), F.lit(""))).otherwise(F.col("source_stage"))).drop("__n", "raw")


def build_glossary(messages: DataFrame, plan: GlossaryPlan, scorer: Scorer | None = None, key: str = "message_id") -> DataFrame:
    """(term, kind, frequency, surface_forms[, relevant, confidence, senses, ...]): without a scorer a dry run ends after clustering.

    With one the stages are: phrases, confirmed brands, clustering, evidence of the top
    candidates, inference, research of unsure drafts, validation penalties, missing senses,
    structural and paraphrase pruning, parent/child demotion. From inference on the scorer gets
    a row for each term, keyed by its hash, with ``text`` (the term), ``examples``, ``definitions``
    and ``prompt``, which shows all of them.
    """
    phrases = extract_phrases(messages, scorer, plan, key) if scorer else []
    pooled = candidate_pools(messages, plan, key, phrases, scorer).drop("cluster")
    if scorer is None:
        return pooled
    top = cut(pooled.orderBy(F.desc("frequency"), "term").limit(plan.top), "candidates")
    known = term_evidence(messages, top, key, plan.examples, plan.example_chars, plan.definitions)
    asked = cut(known.withColumn("message_id", F.xxhash64("term")).withColumn("text", F.col("term")), "evidence")
    drafted = cut(scorer.score(asked, "inference"), "drafts").withColumn("d", F.from_json(json_object(F.col("raw")), DRAFT))
    # some models put the confidence inside a sense: the first found there counts where the entry has none
    nested = F.from_json(json_object(F.col("raw")), "senses array<struct<confidence:string>>")["senses"]["confidence"]
    inside = F.get(F.filter(F.transform(nested, lambda c: c.try_cast("double")), lambda c: c.isNotNull()), 0)
    drafted_confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("d.confidence", inside, F.lit(0.0))))
    told = [F.coalesce("d.relevant", F.lit(False)).alias("relevant"), drafted_confidence.alias("confidence"), F.coalesce("d.senses", F.array().cast(SENSES)).alias("senses")]
    drafts = cut(drafted.select(*asked.columns, *told), "drafted")
    if plan.research_at_most is None:
        drafts = drafts.withColumn("source_stage", F.lit("inference"))
    else:
        drafts = cut(researched(drafts, scorer, plan.research_at_most), "researched")
    checked = cut(on_subset(drafts, F.col("relevant"), scorer, "validation"), "checked")
    rows = checked.withColumn("c", F.from_json(json_object(F.col("raw")), CRITIQUE))
    rows = rows.withColumns(
        {
            "severity": F.coalesce("c.issue_severity", F.lit("none")),
            "domain_specific": F.coalesce("c.domain_specific", F.lit(True)),
            "noise": F.coalesce("c.wrongly_admitted_noise", F.lit(False)),
            "missing": F.filter(F.coalesce(F.col("c.missing_senses.description"), F.array().cast("array<string>")), lambda m: ~is_blank(m)),
        }
    ).drop("raw", "c")
    penalised = refine.penalise(rows, plan.blocklist)
    whole = enriched_senses(cut(penalised, "penalised"), scorer)
    pruned = distinct_senses(cut(refine.prune_senses(whole), "pruned"), scorer)
    ids = F.array_distinct(F.flatten(F.transform("senses", lambda s: F.coalesce(s["example_message_ids"], F.array().cast("array<bigint>")))))
    settled = refine.parent_child(cut(pruned.withColumn("ids", ids), "settled"))
    return settled.select("term", "kind", "frequency", "surface_forms", "relevant", "confidence", "senses", "in_favour_of", "source_stage", "examples", "definitions")


@dataclass(frozen=True)
class Pipeline:
    """One classifier: its gate, how its stages fail, and what counts as agreement of extractor and judge."""

    name: str
    pack: gates.DomainPack
    verdicts: Mapping[str, str] = field(default_factory=dict)
    known: Sequence[str] = ("REAL_LEAD", "MISTAKE")
    fail_open: bool = True
    aligned: bool = False
    unknown: str = "REVIEW"


def classify(messages: DataFrame, pipeline: Pipeline, scorer: Scorer) -> DataFrame:
    """Decisions of one pipeline for every message, with ``pipeline`` named."""
    rows = pipelines.judge(pipelines.extract(messages, pipeline.pack, scorer, fail_open=pipeline.fail_open), scorer, pipeline.known, pipeline.unknown)
    if pipeline.aligned:
        settled = pipelines.align(F.col("lead_type"), F.col("verdict"), F.col("rationale"), dict(pipeline.verdicts))
        rows = rows.withColumn("__a", settled)
        lead = F.coalesce(F.col("is_lead"), F.lit(False))
        rows = rows.withColumns(
            {
                "rationale": F.when(lead, F.col("__a.notes")).otherwise(F.col("rationale")),
                "verdict": F.when(lead, F.col("__a.verdict")).otherwise(F.col("verdict")),
                "is_lead": F.when(lead, F.col("__a.is_lead")).otherwise(F.col("is_lead")),
            }
        ).drop("__a")
    return rows.withColumn("pipeline", F.lit(pipeline.name))


def classify_all(messages: DataFrame, chosen: Sequence[Pipeline], scorer: Scorer) -> DataFrame:
    """The decisions of several pipelines, one row per message and pipeline.

    A pipeline sees nothing of the others, and one that fails is logged and has no row; only
    if all fail is that an error.
    """
    made, errors = classifiers.isolated(messages, {p.name: lambda rows, p=p: classify(rows, p, scorer) for p in chosen})
    if made is None:
        raise RuntimeError(f"every pipeline failed: {errors}")
    return made


def classify_batch(messages: DataFrame, pipeline: Pipeline, scorer: Scorer, done: DataFrame | None = None, key: str = "message_id", sample: int | None = None) -> DataFrame:
    """Offline job: exact dedup, optional systematic sample, resume by key, then one pipeline."""
    rows = dedup.first_per_text(messages, [key])
    if sample is not None:
        rows = sampling.systematic(rows, [key], sample)
    if done is not None:
        rows = rows.join(done.select(key).distinct(), key, "left_anti")
    return classify(rows, pipeline, scorer)


def cross_user_duplicates(decisions: DataFrame, key: str = "message_id", least: int = 100, on_duplicate: str = "write_mistake") -> DataFrame:
    """Leads whose text another message of the same type holds already: written as MISTAKE or left out.

    Only repeated texts are looked up, by hash, and while they are few they are broadcast; no
    type is a type like any other.
    """
    long = F.col("is_lead") & (F.length(ustrip(F.col("text"))) > least)
    marked = decisions.withColumns({"__hash": text_hash(F.col("text")), "__long": F.coalesce(long, F.lit(False))})
    held = marked.where("__long").groupBy(F.col("lead_type").alias("__type"), F.col("__hash").alias("__own")).agg(F.min(key).alias("__first"), F.count(F.lit(1)).alias("__n"))
    repeated = cut(held.where("__n > 1").drop("__n"), "repeated-leads")
    joined = marked.join(dimension(repeated, 200_000), F.col("lead_type").eqNullSafe(F.col("__type")) & (F.col("__hash") == F.col("__own")), "left")
    again = F.coalesce(F.col("__long") & (F.col("__first") < F.col(key)), F.lit(False))
    if on_duplicate == "skip":
        return joined.where(~again).select(*decisions.columns)
    made = joined.withColumns({"verdict": F.when(again, "MISTAKE").otherwise(F.col("verdict")), "is_lead": F.col("is_lead") & ~again})
    return made.select(*decisions.columns)


def repaired(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Replies that the cheap extraction can't parse go through the repairer; the others don't leave the JVM."""
    plain = json_object(F.col(raw))
    good = F.try_parse_json(plain).isNotNull()
    fine = rows.where(good).withColumn(raw, plain)
    return fine.unionByName(rows.where(~F.coalesce(good, F.lit(False))).withColumn(raw, repaired_json(F.col(raw))))


def serve(
    messages: DataFrame,
    steps: Sequence[Callable[[DataFrame, int], DataFrame]],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    scam: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """A stream through its ordered per-batch steps (ban list, pipelines, normalisation) into an upserting sink.

    Scam rows skip the steps but are written, with the verdict ``SCAM`` and what columns the
    others gained null. ``every`` is the pause between batches of a stream that goes on; without
    one it ends once all there is has been read.
    """

    def batch(frame: DataFrame, number: int) -> None:
        flagged = frame if scam is None else frame.withColumn("__scam", F.coalesce(scam, F.lit(False)))
        rows = flagged if scam is None else flagged.where("not __scam").drop("__scam")
        for step in steps:
            rows = step(rows, number)
        if scam is not None:
            held = flagged.where("__scam").drop("__scam").withColumn("verdict", F.lit("SCAM"))
            rows = rows.unionByName(held, allowMissingColumns=True)
        sink(rows, number)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
