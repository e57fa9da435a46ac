"""Built-in packs on invented messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import packs
from tidemark.operators import gates

CASES = [
    (packs.buyers(["psp"]), "Ищу решение для карт", True),
    (packs.buyers(["psp"]), "a PSP arrived", True),
    (packs.buyers(["psp"]), "good morning", False),
    (packs.coin_buyers(), "берём ежедневно", True),
    (packs.providers(["casino", "mid"]), "casino news", False),
    (packs.providers(["casino", "mid"]), "MID for you", True),
    (packs.providers(["mid"]), "We offer a MID, recovery too", False),
    (packs.providers(["mid"], mode="and"), "we offer help", False),
    (packs.traffic(), "продам трафик", True),
    (packs.traffic(), "продам трафик, payout daily", False),
    (packs.cards(["card"], ["topup"]), "Card topup", True),
    (packs.cards(["card"], ["topup"]), "card for p2p обмен", False),
]


def test_gates(spark):
    rows = spark.range(1)
    for pack, text, expected in CASES:
        assert rows.select(gates.gate(F.lit(text), pack)).first()[0] is expected, text


def test_lists_are_clean():
    for name, words in packs.fixed_lists().items():
        assert len(set(words)) == len(words) and all(w == w.lower() and w.strip() for w in words), name


@pytest.mark.parametrize("words", [packs.SEEKING, packs.TRAFFIC])
def test_long_and_short_forms_of_a_gate_agree(spark, words):
    from tidemark.functions.text import contains_any

    texts = spark.createDataFrame([(f"x {w.upper()} y",) for w in words] + [("nothing here",), (None,)], "text string")
    chained = F.lit(False)
    for at in range(0, len(words), 50):
        chained = chained | contains_any(F.col("text"), words[at : at + 50])
    assert texts.where(contains_any(F.col("text"), words) != chained).count() == 0
