"""URL verdicts: explicit host/path rules first, then an exact Bloom filter cascade.

A cascade alternates two kinds of Bloom filter. Level 1 encodes the listed keys; level 2
encodes those unlisted keys of the corpus that level 1 lets through; level 3 the listed
keys that level 2 lets through; and so on until a level lets nothing wrong through. Since
every key of the corpus took part in the construction, the answer is exact for each of
them, and a page is judged by bit tests alone: no join, no shuffle of pages.

Only the key universe (distinct host suffixes, pre-aggregated on the map side) is shuffled.
The bit arrays grow with the *list*, not with the corpus; their size is computed before
they are gathered and beyond ``max_filter_bytes`` a level (some 16 million listed keys)
membership falls back to a semi join, which is exact too.

Edge cases: a null URL or one without ``://`` has empty host and path, no rule and the
verdict ``allow``; of a very long host only suffixes that the list could hold are tested;
repeated pages each get a row; an empty table gives no rows; an empty
list blocks nothing. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.session import cut, table

#: (action, rule): host and path prefix; a rule holds for the host and its subdomains.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Labels of unwanted sites and the suffixes under which they are listed.
LISTED_LABELS = ("spam-farm", "adult-x", "cheap-pills", "ads-track", "casino-win", "free-bets")
LISTED_SUFFIXES = ("example.com", "example.net", "example.org")
LISTED = tuple(f"{label}.{suffix}" for label in LISTED_LABELS for suffix in LISTED_SUFFIXES)

_LOW32 = 0xFFFFFFFF
#: Bytes of one level's filter, which every task of a scan receives: some 16 million listed keys.
MAX_FILTER_BYTES = 16 << 20


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column; both empty where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule; nulls where none fits."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def host_keys(host: Column, max_labels: int) -> Column:
    """The host and its parent domains of two to ``max_labels`` labels: the keys that the list may hold.

    A host of one label is its own key. Longer suffixes than any listed key can't be listed,
    and without them a host of very many labels costs no square of its length.
    """
    labels = F.split(host, r"\.")
    count = F.size(labels)
    starts = F.sequence(F.greatest(count - F.lit(max_labels - 1), F.lit(1)), F.greatest(count - F.lit(1), F.lit(1)))
    keys = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.lit(max_labels)), "."))
    return F.when(F.length(host) > 0, keys).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` holds its bits, 64 to a word."""

    number: int
    bits: int
    hashes: int
    words: np.ndarray


def _positions(key: Column, number: int, bits: int, hashes: int) -> Column:
    mixed = F.xxhash64(key, F.lit(number))
    low, high = mixed.bitwiseAND(F.lit(_LOW32)), F.shiftrightunsigned(mixed, 32)
    return F.array(*[(low + high * F.lit(i)) % F.lit(bits) for i in range(hashes)])


def _passes(key: Column, level: Level) -> Column:
    """All bits of the key are set. The words are one constant array, which a plan holds once for each level."""
    words = F.lit(level.words)

    def set_at(at: Column) -> Column:
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return F.forall(_positions(key, level.number, level.bits, level.hashes), set_at)


def in_cascade(key: Column, levels: Sequence[Level]) -> Column:
    """Exact membership of a key of the universe: passes level 1 and is not vetoed by the rest."""
    if not levels:
        return F.lit(False)
    listed = F.lit(False)
    for level in reversed(levels):
        listed = _passes(key, level) & ~listed
    return listed


def _shape(keys: int, bits_per_key: float) -> tuple[int, int]:
    bits = max(64, math.ceil(keys * bits_per_key / 64) * 64)
    return bits, max(1, round(bits_per_key * math.log(2)))


def _build(keys: DataFrame, count: int, number: int, bits_per_key: float) -> Level:
    bits, hashes = _shape(count, bits_per_key)
    at = keys.select(F.explode(_positions(F.col("key"), number, bits, hashes)).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    rows = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(bits // 64, dtype=np.int64)  # at most bits / 64 rows, checked by the caller
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return Level(number, bits, hashes, words)


def build_cascade(
    universe: DataFrame,
    listed: DataFrame,
    bits_per_key: tuple[float, float] = (8.0, 3.0),
    max_filter_bytes: int = MAX_FILTER_BYTES,
    max_levels: int = 60,
) -> list[Level] | None:
    """Levels that are exact over ``universe`` (column ``key``) and ``listed``; None beyond the size bound."""
    marked = universe.select("key").withColumn("listed", F.lit(False)).unionByName(listed.select("key").withColumn("listed", F.lit(True)))
    keys = cut(marked.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed")), "url-keys")
    levels: list[Level] = []
    side = True  # which side of the universe the next level encodes
    encoded = keys.where(F.col("listed"))
    while (count := encoded.count()) and len(levels) < max_levels:
        rate = bits_per_key[0] if side else bits_per_key[1]
        if _shape(count, rate)[0] / 8 > max_filter_bytes:
            return None
        level = _build(encoded, count, len(levels) + 1, rate)
        levels.append(level)
        side = not side
        through = F.lit(True)
        for one in levels:
            through = through & _passes(F.col("key"), one)
        encoded = keys.where((F.col("listed") == F.lit(side)) & through)
    if encoded.limit(1).count():
        return None
    return levels


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``keep``, host, path, rule, verdict and listed (the cascade's answer) for every page."""
    host, path = split_url(F.col(url))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    hosts = parts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    most = listed.agg(F.max(F.size(F.split("key", r"\.")))).first()[0]
    keys = host_keys(F.col("host"), max(2, most or 0))
    universe = hosts.select(F.explode(keys).alias("key"))
    levels = build_cascade(universe, listed, max_filter_bytes=max_filter_bytes)
    if levels is None:
        bad = hosts.select("host", F.explode(keys).alias("key")).join(listed.select("key").distinct(), "key", "left_semi")
        bad = bad.select("host").distinct().withColumn("listed", F.lit(True))
        parts = parts.join(bad, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        parts = parts.withColumn("listed", F.exists(keys, lambda k: in_cascade(k, levels)))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return parts.select(*keep, "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(key,) for key in LISTED], "key string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), listed)


def oracle() -> str:
    """The same judgement with the list and the rules as relations."""
    listed = " OR ".join(f"host = '{key}' OR host LIKE '%.{key}'" for key in LISTED)
    cases = {"rule": "", "act": ""}
    for act, text in sorted(RULES, key=lambda r: -len(r[1])):
        name, slash, rest = text.partition("/")
        fits = f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}')"
        cases["rule"] += f"{fits} THEN '{text}' "
        cases["act"] += f"{fits} THEN '{act}' "
    return f"""
WITH cutoff AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path
  FROM cutoff
)
SELECT page_id, host, path,
       CASE {cases["rule"]} END AS rule,
       coalesce(CASE {cases["act"]} END, CASE WHEN {listed} THEN 'block' ELSE 'allow' END) AS verdict,
       ({listed}) AS listed
FROM parts"""
