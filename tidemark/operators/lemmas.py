"""Lemmas of words: known forms from a table, the rest guessed by suffix rules learned from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import norm_key

WORD = r"[A-Za-zЀ-ӿ][A-Za-zЀ-ӿ0-9\-']*"
#: The longest suffix that a rule may look at, and how many forms must speak for a rule.
LONGEST, LEAST = 5, 2


def _shared(form: Column, lemma: Column) -> Column:
    """How many characters both begin with."""
    same = F.filter(F.sequence(F.lit(0), F.least(F.length(form), F.length(lemma))), lambda n: F.left(form, n) == F.left(lemma, n))
    return F.array_max(same)


def _pairs(pairs: DataFrame, form: str, lemma: str) -> DataFrame:
    """(form, lemma) in lower case, one lemma a form: the one that most rows give, of ties the least."""
    clean = pairs.select(norm_key(F.col(form)).alias("form"), norm_key(F.col(lemma)).alias("lemma")).where("form <> '' and lemma <> ''")
    counted = clean.groupBy("form", "lemma").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("form").agg(F.min_by("lemma", F.struct(-F.col("n"), "lemma")).alias("lemma"))


def suffix_rules(pairs: DataFrame, form: str = "form", lemma: str = "lemma", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(suffix, cut, add, support): cut so many characters off a word that ends so, then add these.

    The suffixes of all forms are the nodes of a trie; a node's rule is that of most of its
    forms (of ties the shorter cut, then the lesser ending), if ``least`` of them have it. A node
    whose parent has the same rule is left out, as a word that ends there meets its parent's.
    Every form gives at most ``longest`` + 1 rows, which combine on the map side by suffix and rule.
    """
    known = _pairs(pairs, form, lemma).withColumn("shared", _shared(F.col("form"), F.col("lemma")))
    ruled = known.withColumns({"cut": F.length("form") - F.col("shared"), "add": F.substr("lemma", F.col("shared") + 1)}).where(F.col("cut") <= longest)
    sizes = F.sequence(F.col("cut"), F.least(F.lit(longest), F.length("form")))
    nodes = ruled.select(F.explode(F.transform(sizes, lambda n: F.right("form", n))).alias("suffix"), "cut", "add")
    counted = nodes.groupBy("suffix", "cut", "add").agg(F.count(F.lit(1)).alias("support"))
    best = counted.groupBy("suffix").agg(F.max_by(F.struct("cut", "add", "support"), F.struct("support", -F.col("cut"))).alias("any"), F.max(F.struct("support", -F.col("cut"))).alias("top"))
    tied = counted.join(best, "suffix").where((F.col("support") == F.col("top.support")) & (F.col("cut") == F.col("any.cut")))
    rules = tied.groupBy("suffix", "cut", "support").agg(F.min("add").alias("add")).where(F.col("support") >= least)
    parents = rules.select(F.col("suffix").alias("__up"), F.col("cut").alias("__cut"), F.col("add").alias("__add"))
    up = (F.length("suffix") > 0) & (F.substr("suffix", F.lit(2)) == F.col("__up"))
    told = rules.join(parents, up & (F.col("cut") == F.col("__cut")) & (F.col("add") == F.col("__add")), "left_anti")
    return told.select("suffix", "cut", "add", "support")


def lemmas(words: DataFrame, pairs: DataFrame, word: str = "word", form: str = "form", lemma: str = "lemma", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(word, lemma, known) of every distinct word, in lower case; null and blank words are left out.

    A form of the table has its lemma; another word follows the rule of its longest suffix that
    has one and leaves at least one character, or stays as it is. The work is per distinct
    word: at most ``longest`` + 1 suffixes of each meet the rules by equality.
    """
    asked = words.select(norm_key(F.col(word)).alias("word")).where("word <> ''").distinct()
    known = _pairs(pairs, form, lemma)
    met = asked.join(known.withColumnRenamed("form", "word"), "word", "left")
    rules = suffix_rules(pairs, form, lemma, longest, least)
    suffixes = F.transform(F.sequence(F.lit(0), F.least(F.lit(longest), F.length("word"))), lambda n: F.right("word", n))
    tried = met.where("lemma is null").select("word", F.explode(suffixes).alias("suffix")).join(rules, "suffix").where(F.length("word") > F.col("cut"))
    rule = tried.groupBy("word").agg(F.max_by(F.struct("cut", "add"), F.length("suffix")).alias("rule"))
    guess = F.concat(F.left("word", F.length("word") - F.col("rule.cut")), F.col("rule.add"))
    joined = met.join(rule, "word", "left")
    return joined.select("word", F.coalesce("lemma", guess, "word").alias("lemma"), F.col("lemma").isNotNull().alias("known"))


def with_lemma_key(terms: DataFrame, pairs: DataFrame, term: str = "term", form: str = "form", lemma: str = "lemma", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Adds ``lemma_key``: the lemmas of the term's words in order; the lower-cased, stripped term where it has none.

    Words and rules meet per distinct term, so repeated terms cost no more. A null term has a null key.
    """
    named = terms.select(F.col(term).alias("__term")).where("__term is not null").distinct()
    placed = named.select("__term", F.posexplode(F.regexp_extract_all(F.lower("__term"), F.lit(WORD), F.lit(0))).alias("__at", "word"))
    found = lemmas(placed, pairs, "word", form, lemma, longest, least).select(F.col("word").alias("__word"), "lemma")
    joined = placed.join(found, norm_key(F.col("word")) == F.col("__word"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("__at", "lemma"))), lambda x: x["lemma"])
    keys = joined.groupBy("__term").agg(F.array_join(ordered, " ").alias("lemma_key"))
    rows = terms.join(keys, F.col(term) == F.col("__term"), "left").drop("__term")
    return rows.withColumn("lemma_key", F.coalesce("lemma_key", norm_key(F.col(term))))
