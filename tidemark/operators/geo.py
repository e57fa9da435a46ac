"""Geography and payment normalisation: lookups by exploded equi joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import norm_key, ustrip
from tidemark.operators.scoring import Scorer
from tidemark.session import cut, dimension


def _exploded(rows: DataFrame, key: str, values: str) -> DataFrame:
    """(id, pos, raw, norm): one row per value; a row without any has one with null norm."""
    items = rows.select(F.col(key).alias("id"), F.posexplode_outer(values).alias("pos", "raw"))
    return items.withColumn("norm", F.nullif(norm_key(F.col("raw")), F.lit("")))


def _listed(name: str, *order: str) -> Column:
    """The non-null values of a group in order."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(*order, F.col(name).alias("v"))))), lambda x: x["v"])


def expand_geo(rows: DataFrame, mapping: DataFrame, expansion: DataFrame, key: str, values: str) -> tuple[DataFrame, DataFrame]:
    """((key, geo), unknown): raw places mapped, then each code followed by its children.

    ``mapping`` is (raw_value, normalized), ``expansion`` (parent, child). Order and repeats
    are kept; unmapped values go to ``unknown`` as (id, raw). A row without a hit has no codes.
    Spellings that meet after normalising are one, under the smallest code; repeated children count once.
    """
    items = _exploded(rows, key, values)
    known = mapping.groupBy(norm_key(F.col("raw_value")).alias("norm")).agg(F.min("normalized").alias("code"))
    hits = items.join(dimension(known), "norm", "left")
    codes = hits.select("id", "pos", "code")
    children = codes.where("code is not null").join(dimension(expansion.select(F.col("parent").alias("code"), "child").distinct()), "code")
    both = codes.select("id", "pos", F.lit("").alias("sub"), F.col("code").alias("v")).unionByName(children.select("id", "pos", F.col("child").alias("sub"), F.col("child").alias("v")))
    geo = both.groupBy(F.col("id").alias(key)).agg(_listed("v", "pos", "sub").alias("geo"))
    unknown = hits.where("code is null and norm is not null").select("id", "raw").distinct()
    return geo, unknown


def learn_places(unknown: DataFrame, mapping: DataFrame, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """((raw_value, normalized) learned, (id, raw) left unknown): a scorer's code counts if the mapping has it already.

    Each distinct place is asked once, with its hash as message id and itself as text; null,
    ``garbage`` and codes that nothing maps to are no answer.
    """
    named = unknown.withColumn("raw_value", norm_key(F.col("raw")))
    asked = named.select("raw_value").distinct().withColumns({"message_id": F.xxhash64("raw_value"), "text": F.col("raw_value")})
    said = cut(scorer.score(asked, "geo"), "places").select("raw_value", F.upper(ustrip(F.col("raw"))).alias("normalized"))
    codes = mapping.select(F.col("normalized")).where("normalized is not null").distinct()
    learned = said.join(dimension(codes), "normalized", "left_semi").select("raw_value", "normalized")
    return learned, named.join(learned, "raw_value", "left_anti").select("id", "raw")


def expand_and_learn(rows: DataFrame, mapping: DataFrame, expansion: DataFrame, key: str, values: str, scorer: Scorer) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(geo, unknown, learned): unmapped places go to a scorer first, and what it knows is mapped in this very run."""
    learned, left = learn_places(expand_geo(rows, mapping, expansion, key, values)[1], mapping, scorer)
    geo, _ = expand_geo(rows, mapping.select("raw_value", "normalized").unionByName(learned), expansion, key, values)
    return geo, left, learned


def payment_tokens(rows: DataFrame, options: DataFrame, key: str, values: str) -> tuple[DataFrame, DataFrame]:
    """((key, tokens), unknown): methods through their aliases, ordered without repeats; a row without a hit has none.

    ``options`` is (token, aliases); an alias that two options share goes to the smaller token,
    and an option without aliases has its own name.
    """
    items = _exploded(rows, key, values)
    exploded = options.select("token", F.explode(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array("token"))).alias("alias"))
    names = exploded.groupBy(F.lower("alias").alias("norm")).agg(F.min("token").alias("token"))
    hits = items.join(dimension(names), "norm", "left")
    first = hits.groupBy("id", "token").agg(F.min("pos").alias("pos"))
    tokens = first.groupBy(F.col("id").alias(key)).agg(_listed("token", "pos").alias("tokens"))
    return tokens, hits.where("token is null and norm is not null").select("id", "raw").distinct()


def append_implied(geo: DataFrame, tokens: DataFrame, countries: DataFrame, key: str) -> DataFrame:
    """Adds countries that the payment methods imply, only those not seen yet.

    ``countries`` is (token, countries).
    """
    known = countries.groupBy("token").agg(F.array_distinct(F.flatten(F.array_sort(F.collect_list("countries")))).alias("countries"))
    items = tokens.select(F.col(key).alias("id"), F.posexplode("tokens").alias("pos", "token")).join(dimension(known), "token")
    implied = items.groupBy(F.col("id").alias("__id")).agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "countries"))), lambda x: x["countries"]))).alias("implied"))
    both = geo.join(implied, F.col(key) == F.col("__id"), "full")
    own = F.coalesce("geo", F.array().cast("array<string>"))
    extra = F.array_except(F.coalesce("implied", F.array().cast("array<string>")), own)
    return both.select(F.coalesce(key, "__id").alias(key), F.concat(own, extra).alias("geo"))
