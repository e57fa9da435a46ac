"""Lemma rules: held-out forms, the trie against a plain fold, edges, clusters."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators import lemmas, mining

STEMS = "мерчант платеж кошелек банк агент клиент проект процент кредит депозит аккаунт паспорт документ контракт".split()
ENDINGS = ("", "а", "у", "ом", "ов", "ам", "ами", "ах")
VERBS = "play walk talk work jump start want need call deposit".split()


def _table():
    rows = [(s + e, s) for s in STEMS for e in ENDINGS]
    rows += [(v + e, v) for v in VERBS for e in ("", "s", "ed", "ing")]
    return rows + [("went", "go"), ("better", "good"), ("cities", "city"), ("parties", "party"), ("ladies", "lady")]


def _plain_rules(pairs, longest, least):
    counted = Counter()
    for form, lemma in set(pairs):
        shared = max(n for n in range(min(len(form), len(lemma)) + 1) if form[:n] == lemma[:n])
        cut, add = len(form) - shared, lemma[shared:]
        for n in range(cut, min(longest, len(form)) + 1):
            counted[form[len(form) - n :], cut, add] += 1
    best = {}
    for (suffix, cut, add), n in counted.items():
        best[suffix] = min(best.get(suffix, (0, 99, "")), (-n, cut, add))
    return {s: (c, a) for s, (n, c, a) in best.items() if -n >= least}


def _plain_guess(word, rules, longest):
    for n in range(min(longest, len(word)), -1, -1):
        rule = rules.get(word[len(word) - n :])
        if rule and len(word) > rule[0]:
            return word[: len(word) - rule[0]] + rule[1]
    return word


def test_held_out_forms_are_lemmatised(spark):
    table = _table()
    held = [p for i, p in enumerate(table[: len(STEMS) * len(ENDINGS) + 40]) if i % 5 == 2]
    learn = [p for p in table if p not in held]
    pairs = spark.createDataFrame(learn, "form string, lemma string")
    words = spark.createDataFrame([(f,) for f, _ in held] + [("went",), ("bodies",)], "word string")
    got = {r["word"]: (r["lemma"], r["known"]) for r in lemmas.lemmas(words, pairs).collect()}
    assert got["went"] == ("go", True) and got["bodies"] == ("body", False)
    right = sum(got[f][0] == lemma for f, lemma in held)
    assert right / len(held) >= 0.9, [(f, got[f][0]) for f, lemma in held if got[f][0] != lemma]


def test_guesses_equal_a_plain_trie(spark):
    table = _table()
    pairs = spark.createDataFrame(table, "form string, lemma string")
    unseen = [w + e for w in ("робот", "walkie", "studi", "x", "gamer", "слот") for e in ("", "s", "es", "ов", "ами", "ed", "ing")]
    for longest, least in ((5, 2), (2, 1), (3, 4)):
        rules = _plain_rules(table, longest, least)
        got = {r["word"]: r["lemma"] for r in lemmas.lemmas(spark.createDataFrame([(w,) for w in unseen], "word string"), pairs, longest=longest, least=least).collect()}
        assert got == {w: dict(table).get(w) or _plain_guess(w, rules, longest) for w in unseen}
        kept = lemmas.suffix_rules(pairs, longest=longest, least=least).collect()
        assert 0 < len(kept) < len(rules) and all(rules[r["suffix"]] == (r["cut"], r["add"]) for r in kept)


def test_edges_of_lemma_tables(spark):
    pairs = spark.createDataFrame([("A s", None), (None, "x"), ("", "y"), ("Runs", "run"), ("runs", "run"), ("runs", "runs")], "form string, lemma string")
    words = spark.createDataFrame([(None,), (" ",), ("RUNS",), ("runs",), ("other",)], "word string")
    got = sorted(map(tuple, lemmas.lemmas(words, pairs).collect()))
    assert got == [("other", "other", False), ("runs", "run", True)]
    nothing = pairs.limit(0)
    assert lemmas.suffix_rules(nothing).count() == 0 and {r["lemma"] for r in lemmas.lemmas(words, nothing).collect()} == {"runs", "other"}
    terms = spark.createDataFrame([(None, 1), ("  !? ", 2), ("Runs, RUNS other", 3), ("Runs, RUNS other", 4)], "term string, lemma int")
    keys = [(r["lemma"], r["lemma_key"]) for r in lemmas.with_lemma_key(terms, pairs).collect()]
    assert sorted(keys) == [(1, None), (2, "!?"), (3, "run run other"), (4, "run run other")]


def test_inflected_terms_are_one_cluster(spark):
    pairs = spark.createDataFrame(_table(), "form string, lemma string")
    rows = [("мерчант", 5), ("Мерчанта", 3), ("мерчантов", 2), ("робот банка", 4), ("роботов банк", 6), ("city", 1)]
    terms = spark.createDataFrame(rows, "term string, frequency bigint").withColumns({"kind": F.lit("phrase"), "surface_forms": F.array("term")})
    made = mining.cluster(lemmas.with_lemma_key(terms, pairs), F.col("lemma_key"))
    got = {r["cluster"]: (r["term"], r["frequency"], sorted(r["surface_forms"])) for r in made.collect()}
    assert got["мерчант"] == ("мерчант", 10, ["Мерчанта", "мерчант", "мерчантов"])
    assert got["робот банк"][:2] == ("роботов банк", 10) and got["city"][1] == 1 and len(got) == 3
