"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    boosted_rules,
    bt_quality,
    hard_negatives,
    oph_minhash,
    perspective,
    prefix_trie,
    simhash_vp,
    spaced_seed,
    subword_lid,
    temperature_mix,
    url_cascade,
    warc_split,
    weak_pii,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_cascade": url_cascade.query,
    "op2_spaced_seed_decontamination": spaced_seed.query,
    "op3_simhash_vantage": simhash_vp.query,
    "op4_perspective_rotation": perspective.query,
    "op5_subword_language": subword_lid.query,
    "op6_boosted_rules": boosted_rules.query,
    "op7_bradley_terry_quality": bt_quality.query,
    "op8_weak_supervision_pii": weak_pii.query,
    "op9_temperature_mix": temperature_mix.query,
    "op10_warc_split": warc_split.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_oph_minhash": oph_minhash.query,
}

ORACLES: dict[str, str] = {
    "op1_url_cascade": url_cascade.oracle(),
    "op4_perspective_rotation": perspective.ORACLE,
    "op10_warc_split": warc_split.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
