"""The corpus pipeline: five stages over ``documents``, each one operator of ``tidemark.llm``.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of the documents they keep. Every stage gives no rows for an empty table and
leaves extra columns alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import simhash_vp, spaced_seed, subword_lid, temperature_mix, weak_pii
from tidemark.session import cut, release, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go.

    Null texts and texts without a letter have no language and go; so do texts whose best
    language is too uncertain, such as those in two languages. Very long texts count whole,
    rows with equal texts fare alike, and rows with a null id are judged but not learned from.
    """
    return subword_lid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the smallest id.

    Null and wordless texts are one class. Of repeated rows one stays; texts that share an id
    are decided one by one; rows without an id all stay.
    """
    return simhash_vp.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go.

    Null and empty texts hold none and stay, as does everything where the benchmark is empty;
    repeated rows fare alike; very long texts are searched whole.
    """
    return spaced_seed.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays.

    Null texts stay null; overlapping spans make one replacement, named after the first;
    repeated rows are all redacted.
    """
    return weak_pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The occurrences of the documents in the temperature-weighted mixture, with their texts.

    In the order of ``position`` they are the training text. A null source is a source;
    documents without a word ride along with their block; repeated rows are separate
    documents; ties in the hash order fall back to id and length.
    """
    carried = [c for c in ("text", "lang") if c in docs.columns]
    return temperature_mix.mix(docs, carry=carried)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Trained classifiers and Hamming components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each reading what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = cut(stage(spark, docs, sf_dir), name)
        release(docs)  # read by nothing any more
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
