"""Glossary mining: candidate terms, gazetteer hits, brands, definitions, clusters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import bound, norm_key, quoted, token_kind, token_norm, tokens, ustrip
from tidemark.operators import gazetteer
from tidemark.operators.sampling import sample_order
from tidemark.patterns import DEFINITIONS, ready
from tidemark.session import cut


def message_tokens(messages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Distinct (id, surface) of every message: the unit of term frequency."""
    # outer, as a plain explode adds a filter that reads every text a second time
    return messages.select(F.col(key).alias("id"), F.explode_outer(F.array_distinct(tokens(F.col(text)))).alias("surface")).where(F.col("surface").isNotNull())


def classified(surfaces: DataFrame, skip: Sequence[str] = (), least_word: int = 4, acronym: tuple[int, int] = (2, 6)) -> DataFrame:
    """Adds kind and norm; drops surfaces of no interest.

    Both follow from the surface alone, so callers pass distinct surfaces: the pattern work
    is done per vocabulary entry, not per token.
    """

    def fits(s: Column) -> Column:
        size = F.length(s["norm"])
        fit = s["kind"].isNotNull() & ((s["kind"] != "latin_word") | (size >= least_word))
        fit = fit & ((s["kind"] != "acronym") | size.between(*acronym))
        return fit & ~F.upper(s["norm"]).isin(*[x.upper() for x in skip]) if skip else fit

    # exploding a one-element array (outer, lest its size be a filter) evaluates the patterns once; as a filter they would be pushed down and repeated
    named = F.transform(F.array(token_kind(F.col("surface"))), lambda k: F.struct(k.alias("kind"), token_norm(F.col("surface"), k).alias("norm")))
    return surfaces.select("*", F.explode_outer(F.filter(named, fits)).alias("__k")).where(F.col("__k").isNotNull()).select(*surfaces.columns, "__k.kind", "__k.norm")


def candidates(units: DataFrame, least: int = 3, forms: int = 5, skip: Sequence[str] = ()) -> DataFrame:
    """(term, kind, frequency, surface_forms): frequent terms with their commonest spellings.

    Counts are aggregated per spelling first, on the map side; only those sums are
    classified and meet per term.
    """
    spelled = classified(units.groupBy("surface").agg(F.count(F.lit(1)).alias("n")), skip)
    ranked = spelled.withColumn("at", F.row_number().over(Window.partitionBy("norm").orderBy(F.desc("n"), "surface")))
    top = F.transform(F.array_sort(F.collect_list(F.when(F.col("at") <= forms, F.struct("at", "surface")))), lambda x: x["surface"])
    terms = ranked.groupBy(F.col("norm").alias("term")).agg(F.min("kind").alias("kind"), F.sum("n").alias("frequency"), top.alias("surface_forms"))
    return terms.where(F.col("frequency") >= least)


def kind_summary(terms: DataFrame) -> DataFrame:
    return terms.groupBy("kind").agg(F.count(F.lit(1)).alias("terms"), F.sum("frequency").alias("mentions"))


def hash_examples(units: DataFrame, per_term: int = 25, seed: int = 42) -> DataFrame:
    """(norm, id): at most ``per_term`` messages of each term, by hash: a repeatable uniform sample.

    ``units`` is (id, norm). Candidates are thinned within hash buckets first, so a term that
    most messages hold is never sorted in one task.
    """
    one = units.select("norm", "id").distinct().withColumn("at", sample_order("id", seed))
    bucket = Window.partitionBy("norm", F.pmod(F.col("id"), F.lit(64))).orderBy("at", "id")
    near = one.withColumn("r", F.row_number().over(bucket)).where(F.col("r") <= per_term)
    whole = Window.partitionBy("norm").orderBy("at", "id")
    return near.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= per_term).select("norm", "id", "r")


def gazetteer_join(messages: DataFrame, forms: DataFrame, key: str, text: str = "text", least: int = 1) -> DataFrame:
    """(term, kind, frequency, surface_forms) of a table of forms; one message counts once a term, under its first form.

    ``forms`` is (term, kind, form, at, alone), see ``gazetteer.form_hits``; it may be any size.
    """
    hits = gazetteer.form_hits(messages, forms, [key], text)
    counted = hits.groupBy("term", "kind").agg(F.count(F.lit(1)).alias("frequency"), F.array_sort(F.collect_set("form")).alias("surface_forms"))
    return counted.where(F.col("frequency") >= least)


def gazetteer_scan(messages: DataFrame, entries: Sequence[Mapping], key: str, text: str = "text", least: int = 1) -> DataFrame:
    """``gazetteer_join`` with curated entries (canonical, forms, category)."""
    return gazetteer_join(messages, gazetteer.forms_of(messages.sparkSession, entries), key, text, least)


def phrase_backfill(messages: DataFrame, phrases: Sequence[str], key: str, text: str = "text", least: int = 1, examples: int = 15) -> DataFrame:
    """(phrase, frequency, examples): messages that contain each phrase, with the first ids."""
    hits = gazetteer.form_hits(messages, gazetteer.plain_forms(messages.sparkSession, phrases), [key], text)
    rows = cut(hits.select(F.col(key).alias("id"), F.col("term").alias("phrase")), "phrase-hits")
    counts = rows.groupBy("phrase").agg(F.count(F.lit(1)).alias("frequency"))
    near = Window.partitionBy("phrase", F.pmod(F.col("id"), F.lit(64))).orderBy("id")
    thin = rows.withColumn("r", F.row_number().over(near)).where(F.col("r") <= examples)
    first = thin.groupBy("phrase").agg(F.slice(F.array_sort(F.collect_list("id")), 1, examples).alias("examples"))
    return counts.where(F.col("frequency") >= least).join(first, "phrase")


def mine_brands(messages: DataFrame, patterns: Mapping[str, str], text: str = "text", skip: Sequence[str] = (), least_length: int = 4) -> DataFrame:
    """(brand, frequency, contexts): captured names with their commonest casing; group 1 captures."""

    def captured(name: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
        return F.transform(hits, lambda b: F.struct(F.lit(name).alias("pattern"), b.alias("brand")))

    found = F.concat(*[captured(*p) for p in patterns.items()])
    rows = messages.select(F.explode(found).alias("h")).select("h.*")
    trimmed = F.regexp_replace("brand", r"^[.,;:'\" \t-]+|[.,;:'\" \t-]+$", "")
    rows = rows.withColumn("brand", trimmed).withColumn("key", F.lower(trimmed)).where(F.length("brand") >= least_length)
    if skip:
        rows = rows.where(~F.col("key").isin(*[s.lower() for s in skip]))
    cells = rows.groupBy("key", "brand", "pattern").agg(F.count(F.lit(1)).alias("n"))
    cased = cells.groupBy("key", "brand").agg(F.sum("n").alias("n"))
    names = cased.groupBy("key").agg(F.max_by("brand", F.struct("n", "brand")).alias("brand"))
    labels = cells.groupBy("key", "pattern").agg(F.sum("n").alias("n")).groupBy("key")
    contexts = labels.agg(F.sum("n").alias("frequency"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern", "n")))).alias("contexts"))
    return names.join(contexts, "key").select("brand", "frequency", "contexts")


def self_definitions(messages: DataFrame, terms: Sequence[str], key: str, text: str = "text", templates: Sequence[tuple[str, str]] = DEFINITIONS, per_term: int = 3) -> DataFrame:
    """(term, definition, pattern, id): the first distinct inline definitions of each term.

    Order is message, then template. An automaton finds the terms in the texts, and templates
    meet what surrounds a term only where what follows it looks like one of them, which
    is a Python pattern made once: a common word is in most texts, but seldom defined. So
    templates keep to what Java and Python write alike, and hold ``{term}`` once. A template whose reach is
    known (``_around``) reads pieces of the text, others the whole. Equal definitions meet first
    (min-aggregate); the survivors per term are few.
    """
    asked = [(at, label, template.replace("{{", "{").replace("}}", "}")) for at, (label, template) in enumerate(templates)]
    named = [(t, quoted(t), t, i, False) for i, t in enumerate(dict.fromkeys(terms))]  # the kind carries the pattern
    forms = messages.sparkSession.createDataFrame(named, gazetteer.FORMS)
    hits = gazetteer.form_places(messages.select(F.col(key).alias("id"), F.col(text).alias("text")), forms, ["id"], "text", _around([template for _, template in templates]))
    pairs = hits.select("id", "said", "places", F.struct("term", F.col("kind").alias("quoted")).alias("t"))

    # an expression of its own for each template, which then compiles a pattern only where the term changes
    def first(value: Column, template: str) -> Column:
        return F.call_function("regexp_extract", value, F.replace(F.lit(template), F.lit("{term}"), F.col("t.quoted")), F.lit(1))

    def tried(at: int, label: str, template: str) -> Column:
        whole = first(F.col("said"), ready([template])[0])
        near = F.filter(F.transform("places", lambda p: first(p, ready([r"\A(?s:.)" + template])[0])), lambda d: d != "")
        hit = F.when(F.col("said").isNotNull(), whole).otherwise(F.coalesce(F.get(near, F.lit(0)), F.lit("")))
        return F.struct(F.lit(at).alias("at"), F.lit(label).alias("pattern"), hit.alias("definition"))

    found = F.filter(F.array(*[tried(*a) for a in asked]), lambda s: s["definition"] != "")
    # outer, as a plain explode adds a filter that tries all templates a second time; null definitions go below
    rows = pairs.select("id", "t.term", F.explode_outer(found).alias("s")).select("id", "term", "s.*")
    rows = rows.withColumn("definition", clean_definition(F.col("definition"))).where(F.length("definition") >= 4)
    first = rows.groupBy("term", F.lower("definition").alias("low")).agg(F.min(F.struct("id", "at", "pattern", "definition")).alias("m"))
    ranked = first.select("term", "m.*").withColumn("r", F.row_number().over(Window.partitionBy("term").orderBy("id", "at", "definition")))
    return ranked.where(F.col("r") <= per_term).select("term", "definition", "pattern", "id")


def _sequels(templates: Sequence[str]) -> str:
    """What may follow the term in one of the templates, without word boundaries (Java's and Python's differ) and upper limits."""
    tails = [t.replace("{{", "{").replace("}}", "}").split("{term}")[1] for t in templates]
    return "|".join(f"(?:{re.sub(r'[{](\d+),\d+[}]', r'{\1,}', tail.replace(r'\b', ''))})" for tail in tails)


def _around(templates: Sequence[str]) -> gazetteer.Around:
    """What the templates need of a text around a term.

    Pieces do for templates that begin with words, spaces and word boundaries, whose rest repeats
    nothing but spaces without a limit, and that end with a capture of at least one character.
    """
    plain = [t.replace("{{", "{").replace("}}", "}").split("{term}") for t in templates]
    heads = [re.sub(r"\\b|\\s\+", "", head).lower() for head, _ in plain]
    alone = all(re.search(r"\\(?:b|s\+)$", head) and tail.startswith(r"\b") for head, tail in plain)
    reach = 0
    for (head, tail), word in zip(plain, heads, strict=True):
        rest = re.sub(r"\\s[*+]", "", re.sub(r"\[(?:\\.|[^\]\\])*\]", "x", tail))
        limits = [int(n) for n in re.findall(r"\{(?:\d+,)?(\d+)\}", rest)]
        loose = re.search(r"[*+^$]|\{\d+,\}|\(\?[^:]|\)\{|\\[AzZGBKkQRX1-9]", rest)
        filled = re.search(r"\{[1-9]\d*,\d+\}\??\)", rest)
        if loose or not filled or not re.fullmatch(r"(?:\\b)?\w*(?:\\s\+)?|\\b", head) or bool(word) != head.endswith(r"\s+"):
            return gazetteer.Around(_sequels(templates), alone)
        reach = max(reach, len(rest) + sum(limits))
    return gazetteer.Around(_sequels(templates), alone, reach, tuple(sorted({w for w in heads if w})))


def clean_definition(value: Column) -> Column:
    """Without punctuation at either end, and without a remark in parentheses that closes it."""
    bare = F.btrim(ustrip(value), F.lit(".,;:—-– \t"))
    remark = F.regexp_extract(bare, r"\s*\([^)]*\)\s*$", 0)
    return F.substring(bare, F.lit(1), F.length(bare) - F.length(remark))


def cluster(terms: DataFrame, lemma: Column | None = None, examples: int = 30) -> DataFrame:
    """(cluster, term, kind, frequency, surface_forms[, examples]): candidates merged by lemma key.

    The default key is the lower-cased, stripped term. The most frequent member names the
    cluster; differing kinds make a phrase; forms that differ in case alone are one, in the
    first member's spelling. Where members have ``examples`` (message ids), the first distinct
    ones of the cluster are kept, at most ``examples``.
    """
    key = norm_key(F.col("term")) if lemma is None else lemma
    rank = F.struct(F.col("frequency").alias("f"), F.col("term").alias("t"))
    with_examples = "examples" in terms.columns
    members = F.reverse(F.array_sort(F.collect_list(F.struct("frequency", "term", "surface_forms", *(["examples"] if with_examples else [])))))
    merged = terms.groupBy(key.alias("cluster")).agg(
        F.max_by("term", rank).alias("term"),
        F.when(F.count_distinct("kind") == 1, F.min("kind")).otherwise("phrase").alias("kind"),
        F.sum("frequency").alias("frequency"),
        members.alias("__m"),
    )
    spelled = F.filter(F.flatten(F.transform("__m", lambda m: F.concat(F.array(m["term"]), F.coalesce(m["surface_forms"], F.array().cast("array<string>"))))), lambda s: s != "")
    merged = merged.withColumn("surface_forms", bound(spelled, _first_spellings))
    if with_examples:
        kept = F.array_distinct(F.flatten(F.transform("__m", lambda m: F.coalesce(m["examples"], F.array().cast(dict(terms.dtypes)["examples"])))))
        merged = merged.withColumn("examples", F.slice(kept, 1, examples))
    return merged.drop("__m")


def _first_spellings(forms: Column) -> Column:
    low = F.transform(forms, F.lower)
    return F.filter(forms, lambda f, i: F.array_position(low, F.lower(f)) == i + 1)


def pooled(*pools: DataFrame) -> DataFrame:
    """UNION ALL of candidate pools, each with its ordinal."""
    result = pools[0].withColumn("pool", F.lit(0))
    for i, pool in enumerate(pools[1:], 1):
        result = result.unionByName(pool.withColumn("pool", F.lit(i)))
    return result
