"""Glossary refinement: validation penalties, sense pruning, parent/child terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import content_words, jaccard

#: Tails that make a compound the same concept as its head.
COMPOUND_TAILS = ("Pay", "Wallet", "Money", "Cash", "Bank", "Bot")
LEXICAL, EVIDENCE, CHILD = 0.55, 0.80, 0.5


def penalise(terms: DataFrame, blocklist: Sequence[str] = (), penalty: float = 0.20) -> DataFrame:
    """Applies a critique: blocklisted terms, rejected ones, then severity penalties.

    Needs term, relevant, confidence, severity, domain_specific, noise.
    """
    blocked = F.lower(F.trim("term")).isin(*blocklist) if blocklist else F.lit(False)
    rejected = ~F.col("domain_specific") | F.col("noise")
    confidence = (
        F.when(blocked, F.least("confidence", F.lit(0.2)))
        .when(rejected, F.least("confidence", F.lit(0.3)))
        .when(F.lower("severity") == "major", F.greatest(F.lit(0.0), F.col("confidence") - penalty))
        .when(F.lower("severity") == "minor", F.greatest(F.lit(0.0), F.col("confidence") - penalty / 2))
        .otherwise(F.col("confidence"))
    )
    return terms.withColumns({"confidence": confidence, "relevant": F.col("relevant") & ~blocked & ~rejected})


def enriched(confidence: Column, added: Column, bump: float = 0.10) -> Column:
    """A modest rise, capped at 1, where senses were added."""
    return F.when(added > 0, F.least(F.lit(1.0), confidence + bump)).otherwise(confidence)


def prune_senses(terms: DataFrame, lexical: float = LEXICAL, evidence: float = EVIDENCE, stop: Sequence[str] = ()) -> DataFrame:
    """Drops each sense that repeats an earlier kept one in wording and in evidence.

    Needs term and senses (array of definition, example_message_ids). Senses of a term are a
    handful, so the sequential decision is a fold over the array. A sense without evidence
    is judged by wording alone.
    """
    marked = F.transform(
        "senses",
        lambda s: F.struct(s["definition"].alias("definition"), s["example_message_ids"].alias("ids"), content_words(s["definition"], stop).alias("words")),
    )

    def step(kept: Column, sense: Column) -> Column:
        def repeats(earlier: Column) -> Column:
            shared = F.size(F.array_intersect(earlier["ids"], sense["ids"])) / F.greatest(F.size(F.array_distinct(sense["ids"])), F.lit(1))
            return (jaccard(earlier["words"], sense["words"]) >= lexical) & ((F.size(sense["ids"]) == 0) | (shared >= evidence))

        return F.when(F.exists(kept, repeats), kept).otherwise(F.concat(kept, F.array(sense)))

    rows = terms.withColumn("__marked", marked)
    kept = F.aggregate("__marked", F.slice("__marked", 1, 0), step)
    bare = F.transform(kept, lambda s: F.struct(s["definition"].alias("definition"), s["ids"].alias("example_message_ids")))
    return rows.withColumn("senses", bare).drop("__marked")


def parent_child(terms: DataFrame, tails: Sequence[str] = COMPOUND_TAILS, explicit: DataFrame | None = None, overlap: float = CHILD) -> DataFrame:
    """Demotes a term whose compound (term + known tail) shares its evidence.

    Needs term, relevant, confidence and ids. The compound's head is computed from its own
    name, so this is an equi join and not a comparison of all pairs.
    """
    tail = "|".join(tails)
    live = terms.where("relevant")
    heads = live.select(
        F.regexp_extract("term", rf"^(.+?)[ \-_.]+(?:{tail})$", 1).alias("head"),
        F.col("term").alias("compound"),
        F.col("ids").alias("compound_ids"),
        F.lit(False).alias("stated"),
    ).where("head <> ''")
    if explicit is not None:
        pairs = explicit.select(F.col(explicit.columns[0]).alias("head"), F.col(explicit.columns[1]).alias("c"))
        stated = pairs.join(live.select(F.col("term").alias("compound"), F.col("ids").alias("compound_ids")), F.col("c") == F.col("compound"))
        heads = heads.unionByName(stated.select("head", "compound", "compound_ids", F.lit(True).alias("stated")))
    mine = F.size(F.array_distinct("ids"))
    share = F.when(mine > 0, F.size(F.array_intersect("ids", "compound_ids")) / mine).otherwise(0.0)
    found = live.select(F.lower("term").alias("low"), "term", "ids").join(heads.withColumn("low", F.lower("head")), "low").withColumn("share", share)
    found = found.where(F.col("stated") | (F.col("share") >= overlap)).groupBy("term").agg(F.min("compound").alias("in_favour_of"))
    joined = terms.join(found, "term", "left")
    gone = F.col("in_favour_of").isNotNull()
    return joined.withColumns({"relevant": F.col("relevant") & ~gone, "confidence": F.when(gone, F.least("confidence", F.lit(0.25))).otherwise(F.col("confidence"))})


def keep_indices(senses: Column, indices: Column) -> Column:
    """Senses at the given positions; all of them if none is valid."""
    kept = F.filter(senses, lambda _, i: F.array_contains(indices, i))
    return F.when(F.size(F.coalesce(kept, F.array())) > 0, kept).otherwise(senses)


def wants_research(relevant: Column, confidence: Column, at_most: float = 0.5) -> Column:
    return relevant & (confidence <= at_most)
