"""Queries of classifiers, sinks with null and repeated keys, prompts and lookups; registered in the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import packs, patterns
from tidemark.functions import text
from tidemark.operators import classifiers, context, dedup, evaluate, gates, geo, outcomes, prompts, refine, sampling, scoring
from tidemark.plans.catalogue import any_of, query
from tidemark.session import spread, table
from tidemark.sources import readers, sinks

NEED = gates.DomainPack(signals=("need",))
REASONS = ("survey_question",)


def _messages(spark, d):
    """Every event as a message; a ninth are too short and a ninth say nothing of interest."""
    said = F.when(F.col("event_id") % 9 == 0, F.lit("short")).when(F.col("event_id") % 9 == 1, F.lit("nothing of interest in here")).otherwise(F.concat(F.lit("we need a provider, message "), F.col("event_id").cast("string")))
    return spread(table(spark, d, "events").select("event_id", "user_id")).select(F.col("event_id").alias("message_id"), said.alias("text"), "user_id")


def _k():
    return F.col("message_id")


_M = "m AS (SELECT event_id AS message_id, event_id AS k, user_id, CASE WHEN event_id % 9 = 0 THEN 'skip' WHEN event_id % 9 = 1 THEN 'prefilter' END AS early FROM events)"


def _says(*cases, modulus: int, otherwise=None):
    """A reply by message id: the n-th of ``cases`` for remainder n; None is a failed call."""
    made = F.lit(otherwise).cast("string")
    for n, value in enumerate(cases):
        made = F.when(_k() % modulus == n, F.lit(value).cast("string")).otherwise(made)
    return made


def _extracted():
    return F.concat(F.lit('{"is_lead": '), (_k() % 4 != 3).cast("string"), F.lit(', "confidence": 0.5, "lead_type": "x"}'))


@query(
    "stage1_readings",
    """WITH m AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'NO.' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'yes, sure' WHEN 3 THEN 'Well: YES' WHEN 4 THEN 'maybe' WHEN 5 THEN ' n ' END AS r FROM events)
SELECT event_id, NOT coalesce(upper(trim(replace(r, '.', ''))) IN ('NO', 'N', 'NOT'), false) AS not_no, coalesce(starts_with(upper(trim(r)), 'YES'), false) AS starts_yes,
r IS NULL OR contains(lower(r), 'yes') AS has_yes, r IS NULL OR NOT contains(upper(r), 'NO') AS no_no FROM m""",
)
def stage1_readings(spark, d):
    raw = F.col("raw")
    rows = _messages(spark, d).withColumn("raw", _says("NO.", "UNKNOWN", "yes, sure", "Well: YES", "maybe", " n ", modulus=7))
    return rows.select(_k().alias("event_id"), *[classifiers.lets_through(raw, mode).alias(mode) for mode in ("not_no", "starts_yes", "has_yes", "no_no")])


_PROVIDER_SQL = f"""WITH {_M}, s AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN k % 5 IN (0, 1) THEN 'stage1' WHEN k % 4 = 3 THEN 'not_lead' ELSE 'extracted' END AS stage FROM m)"""


@query(
    "provider_decisions",
    _PROVIDER_SQL
    + """ SELECT message_id, stage, stage = 'extracted' AS is_lead, CASE WHEN stage = 'extracted' THEN CASE k % 7 WHEN 0 THEN 'REAL_PROVIDER' WHEN 1 THEN 'MISTAKE' WHEN 2 THEN 'REAL_PROVIDER' ELSE 'REVIEW' END END AS verdict FROM s""",
)
def provider_decisions(spark, d):
    rules = {"stage1": _says("NO", "I don't know", None, "well yes", "YES", modulus=5), "extract": _extracted(), "judge": _says('{"verdict": "real_provider"}', '[{"verdict": " MISTAKE "}]', '{"verdict": "other"}', modulus=7)}
    return classifiers.provider(_messages(spark, d), NEED, scoring.RuleScorer(rules)).select("message_id", "stage", "is_lead", "verdict")


@query(
    "provider_codebook",
    _PROVIDER_SQL
    + """ SELECT message_id, CASE WHEN stage = 'extracted' THEN CASE k % 5 WHEN 4 THEN 'MISTAKE' ELSE 'REAL_PROVIDER' END END AS verdict,
CASE WHEN stage = 'extracted' THEN CASE k % 5 WHEN 2 THEN 'CERTAIN' WHEN 4 THEN NULL ELSE 'UNCERTAIN' END END AS certainty,
CASE WHEN stage = 'extracted' AND k % 5 = 3 THEN CASE WHEN k % 2 = 0 THEN 'judge_uncertain' ELSE 'gate_api_error' END END AS uncertainty_reason FROM s""",
)
def provider_codebook(spark, d):
    judge = F.when(_k() % 5 == 2, '{"verdict": "lead"}').when(_k() % 5 == 4, '{"verdict": "NOT_LEAD"}').when(_k() % 2 == 0, '{"verdict": "uncertain"}').otherwise("no idea")
    rules = {"stage1": _says("NO", "I don't know", None, "well yes", "YES", modulus=5), "extract": _extracted(), "judge": judge}
    return classifiers.provider(_messages(spark, d), NEED, scoring.RuleScorer(rules), codebook=True).select("message_id", "verdict", "certainty", "uncertainty_reason")


@query(
    "buyer_decisions",
    f"""WITH {_M}, b AS (SELECT *, user_id % 8 = 0 AS blocked FROM m),
s AS (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN early IS NOT NULL THEN early WHEN k % 5 = 0 THEN 'stage1' WHEN k % 4 = 3 THEN 'not_lead' WHEN k % 6 = 2 THEN 'stage1b' ELSE 'extracted' END AS stage FROM b),
v AS (SELECT *, CASE WHEN stage = 'extracted' THEN CASE k % 3 WHEN 0 THEN 'REAL_LEAD' WHEN 1 THEN 'MISTAKE' ELSE 'REVIEW' END END AS verdict FROM s WHERE NOT (stage IN ('extracted', 'stage1b') AND k % 6 = 4))
SELECT message_id, stage, stage = 'extracted' AS is_lead, verdict, CASE WHEN verdict = 'REAL_LEAD' THEN CASE WHEN k % 2 = 0 THEN 'UNCERTAIN' ELSE 'CERTAIN' END END AS certainty,
CASE WHEN verdict = 'REAL_LEAD' AND k % 2 = 0 THEN CASE WHEN k % 8 = 0 THEN 'survey_question' ELSE 'no_explicit_payment_term' END END AS uncertainty_reason FROM v""",
)
def buyer_decisions(spark, d):
    """Blocked rows stay as decisions against; a failed second stage leaves no row."""
    gate = F.when(_k() % 8 == 0, '{"certainty": "uncertain", "uncertainty_reason": "survey_question"}').when(_k() % 2 == 0, '{"certainty": "UNCERTAIN", "uncertainty_reason": "odd"}')
    rules = {
        "stage1": _says("No.", modulus=5, otherwise="UNKNOWN"),
        "extract": _extracted(),
        "stage1b": F.when(_k() % 6 == 2, "No YES").when(_k() % 6 == 4, F.lit(None).cast("string")).otherwise("yes."),
        "judge": _says('{"verdict": "REAL_LEAD"}', '{"verdict": "mistake"}', "broken", modulus=3),
        "certainty": gate,
    }
    made = classifiers.buyer(_messages(spark, d), NEED, scoring.RuleScorer(rules), REASONS, blocked=F.col("user_id") % 8 == 0)
    return made.select("message_id", "stage", "is_lead", "verdict", "certainty", "uncertainty_reason")


@query(
    "traffic_decisions",
    f"""WITH {_M}, s AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN k % 11 IN (0, 1) THEN 'stage1' WHEN k % 4 = 3 THEN 'not_lead' WHEN k % 5 = 4 THEN 'traffic_type' ELSE 'extracted' END AS stage,
  CASE WHEN k % 2 = 0 THEN 'seeking_traffic' ELSE 'traffic_provider' END AS lt FROM m),
j AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'TRAFFIC_LEAD' ELSE 'TRAFFIC_PROVIDER' END AS own, CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'TRAFFIC_LEAD' ELSE 'MISTAKE' END AS said FROM s),
g AS (SELECT *, stage = 'extracted' AS lead, said IS NULL OR said = own AS agree, CASE k % 7 WHEN 0 THEN 'lead' WHEN 1 THEN 'not_lead' WHEN 2 THEN 'uncertain' WHEN 3 THEN 'lead' END AS label,
  CASE k % 7 WHEN 0 THEN 'seeking_traffic' WHEN 2 THEN 'traffic_provider' END AS mapped, CASE WHEN k % 7 = 2 THEN 'survey_question' END AS why FROM j),
r AS (SELECT *, CASE WHEN NOT lead OR agree OR label IS NULL OR label = 'not_lead' THEN lt ELSE coalesce(mapped, lt) END AS kind, lead AND NOT agree AND label IS NOT DISTINCT FROM 'not_lead' AS dropped FROM g)
SELECT message_id, stage, lead AND NOT dropped AS is_lead, CASE WHEN lead THEN kind WHEN stage = 'traffic_type' THEN lt END AS lead_type,
CASE WHEN stage = 'traffic_type' OR dropped THEN 'MISTAKE' WHEN lead THEN CASE kind WHEN 'seeking_traffic' THEN 'TRAFFIC_LEAD' ELSE 'TRAFFIC_PROVIDER' END END AS verdict,
CASE WHEN NOT lead OR dropped THEN NULL WHEN agree THEN CASE WHEN label = 'lead' THEN 'CERTAIN' ELSE 'UNCERTAIN' END WHEN label = 'lead' AND mapped IS NOT NULL THEN 'CERTAIN' ELSE 'UNCERTAIN' END AS certainty,
CASE WHEN NOT lead OR dropped THEN NULL WHEN label IS NULL THEN 'gate_api_error' WHEN agree THEN CASE label WHEN 'lead' THEN NULL WHEN 'not_lead' THEN 'gate_not_lead' ELSE why END
  WHEN label = 'lead' AND mapped IS NOT NULL THEN NULL WHEN mapped IS NULL THEN 'role_unclear' ELSE coalesce(why, 'other') END AS uncertainty_reason,
CASE WHEN lead AND NOT dropped AND kind = 'seeking_traffic' THEN CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END END AS is_merchant FROM r""",
)
def traffic_decisions(spark, d):
    kind = F.when(_k() % 2 == 0, "seeking_traffic").otherwise("traffic_provider")
    types = F.when(_k() % 5 == 4, '["infra"]').when(_k() % 5 == 3, '["live_traffic", "database"]').otherwise("[]")
    rules = {
        "stage1": _says("NO", "unknown", None, modulus=11, otherwise="YES"),
        "extract": F.concat(F.lit('{"is_lead": '), (_k() % 4 != 3).cast("string"), F.lit(', "confidence": "high", "lead_type": "'), kind, F.lit('", "traffic_type": '), types, F.lit("}")),
        "judge": _says("broken", '{"verdict": "TRAFFIC_LEAD"}', '{"verdict": "MISTAKE"}', modulus=3),
        "gate": _says('{"label": "lead", "role": "buyer"}', '{"label": "not_lead", "role": "none"}', '{"label": "uncertain", "role": "seller", "uncertainty_reason": "survey_question"}', '{"label": "lead", "role": "both"}', '{"label": "odd"}', modulus=7),
        "merchant": _says('{"is_merchant": true}', '{"is_merchant": "False"}', '{"is_merchant": "perhaps"}', modulus=4),
    }
    made = classifiers.traffic(_messages(spark, d), NEED, scoring.RuleScorer(rules), REASONS)
    return made.select("message_id", "stage", "is_lead", "lead_type", "verdict", "certainty", "uncertainty_reason", "is_merchant")


SAID = ("open casino platform", "нужен счёт для компании", "we need usdt for cash", "buying btc, daily volume", "processing and merchant routing", "good morning all", "  ", "cash for a bank account")
_SAID = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(SAID)) + " END"


def _phrases(spark, d):
    rows = spread(table(spark, d, "events").select(F.col("event_id").alias("message_id"), "user_id"))
    said = F.get(F.array(*[F.lit(x) for x in SAID]), (F.col("message_id") % 8).cast("int"))
    return rows.select("message_id", "user_id", said.alias("text"), F.when(_k() % 10 != 0, _k()).alias("source_lead_id"))


#: Which phrase each gate lets through, stops or finds nothing in.
_GATED = {"casino": {0: "hit", 6: "blank"}, "iban": {1: "hit", 2: "stopped", 6: "blank", 7: "stopped"}, "coins": {1: "hit", 2: "stopped", 3: "hit", 4: "hit", 6: "blank"}, "psp": {4: "hit", 6: "blank"}}


def _gated_sql(name: str) -> str:
    cases = " ".join(f"WHEN event_id % 8 = {k} THEN " + ("CASE WHEN event_id % 3 = 0 THEN 'verify' WHEN event_id % 5 = 0 THEN 'extract' ELSE 'lead' END" if v == "hit" else f"'{v}'") for k, v in _GATED[name].items())
    return f"SELECT event_id AS message_id, '{name}' AS gate, CASE {cases} ELSE 'no_hits' END AS stage FROM events"


@query("verified_gates", " UNION ALL ".join(_gated_sql(name) for name in _GATED))
def verified_gates(spark, d):
    """The four fail-closed classifiers over phrases of their fixed patterns."""
    rows = _phrases(spark, d).withColumn("combined", F.col("text")).withColumn("text", F.col("text"))
    result = None
    for kind in (classifiers.CASINO, classifiers.ACCOUNTS, classifiers.COINS, classifiers.PROCESSORS):
        verify = F.when(_k() % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit(f'{{"{kind.verify}": true}}'))
        decide = F.when(_k() % 5 == 0, "{}").otherwise(f'{{"{kind.decide}": "{kind.decided}"}}')
        made = classifiers.verified(rows, kind, scoring.RuleScorer({f"{kind.name}_verify": verify, f"{kind.name}_extract": decide}))
        made = made.select("message_id", F.lit(kind.name).alias("gate"), "stage")
        result = made if result is None else result.unionByName(made)
    return result


@query(
    "cascade_decisions",
    """SELECT event_id AS message_id, CASE WHEN event_id % 8 = 3 AND event_id % 10 <> 0 AND event_id % 4 <> 1 THEN 'coins' WHEN event_id % 8 = 0 THEN 'casino' WHEN event_id % 8 = 1 THEN 'iban' END AS claimed_by FROM events""",
)
def cascade_decisions(spark, d):
    """Coin buyers, then casino, then account seekers, each over what nobody claimed."""
    pack = gates.DomainPack(signals=("buying",))
    rules = {"stage1": F.lit("YES"), "extract": F.lit('{"is_lead": true, "lead_type": "x"}'), "judge": F.when(_k() % 4 == 1, '{"verdict": "odd"}').otherwise('{"verdict": "REAL_LEAD"}')}
    for kind in (classifiers.CASINO, classifiers.ACCOUNTS):
        rules |= {f"{kind.name}_verify": F.lit(f'{{"{kind.verify}": true}}'), f"{kind.name}_extract": F.lit(f'{{"{kind.decide}": "{kind.decided}"}}')}
    scorer = scoring.RuleScorer(rules)
    steps = [
        ("coins", lambda rows: classifiers.coin_buyer(rows, pack, scorer).select("message_id", F.col("relabelled").alias("claimed"))),
        ("casino", lambda rows: classifiers.verified(rows, classifiers.CASINO, scorer).select("message_id", F.col("is_lead").alias("claimed"))),
        ("iban", lambda rows: classifiers.verified(rows.withColumn("combined", F.col("text")), classifiers.ACCOUNTS, scorer).select("message_id", F.col("is_lead").alias("claimed"))),
    ]
    return classifiers.cascade_run(_phrases(spark, d), steps)


@query(
    "author_texts",
    """WITH h AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders),
t AS (SELECT o_custkey, string_agg('order ' || o_orderkey, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY r) AS texts FROM h WHERE r <= 10 GROUP BY o_custkey)
SELECT c_custkey, 'now' || coalesce(chr(10) || chr(10) || '---' || chr(10) || chr(10) || texts, '') AS combined FROM customer LEFT JOIN t ON o_custkey = c_custkey""",
)
def author_texts(spark, d):
    history = table(spark, d, "orders").select(F.col("o_custkey").alias("username"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("text"), F.col("o_orderkey").alias("created_at"))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("username"), F.lit(" now ").alias("text"))
    return classifiers.with_author_texts(rows, history).select(F.col("username").alias("c_custkey"), "combined")


@query(
    "author_texts_as_of",
    """WITH h AS (SELECT source, doc_id // 3 AS at, substr(text, 1, 3000) AS said FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id) WHERE text <> ''),
m AS (SELECT doc_id, source, doc_id // 3 AS at, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS own FROM documents),
near AS (SELECT m.doc_id, h.said, row_number() OVER (PARTITION BY m.doc_id ORDER BY h.at DESC, h.said) AS r FROM m JOIN h ON h.source = m.source AND h.at < m.at),
t AS (SELECT doc_id, string_agg(said, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY r) AS texts FROM near WHERE r <= 10 GROUP BY doc_id),
w AS (SELECT m.doc_id, concat_ws(chr(10) || chr(10) || '---' || chr(10) || chr(10), own, texts) AS whole FROM m LEFT JOIN t ON t.doc_id = m.doc_id)
SELECT doc_id, CASE WHEN length(whole) > 3000 THEN substr(whole, 1, 3000) || '...[cut]' ELSE whole END AS combined FROM w""",
)
def author_texts_as_of(spark, d):
    """Every document with the good documents of its source from before its time; three documents share a moment."""
    docs = spread(table(spark, d, "documents").select("doc_id", "source", "text", F.floor(F.col("doc_id") / 3).alias("created_at")))
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return classifiers.with_author_texts(docs, docs.join(good, "doc_id", "left_semi"), "source", as_of=True).select("doc_id", "combined")


# ---- fixed lists --------------------------------------------------------------------------

_PACKS = {
    "buyers": packs.buyers(["psp"]),
    "coin_buyers": packs.coin_buyers(["psp"]),
    "providers": packs.providers(["psp", "casino"]),
    "providers_and": packs.providers(["psp"], mode="and"),
    "traffic": packs.traffic(["psp"]),
    "cards": packs.cards(["psp"], ["virtual card"]),
}
_SAMPLES = tuple(dict.fromkeys(w for words in packs.fixed_lists().values() for w in words)) + ("psp", "casino", "virtual card", "nothing at all")


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _pack_sql(pack: gates.DomainPack) -> str:
    hit = lambda words: f"len(list_filter({_sql_list(words)}, lambda w: contains(low, w))) > 0" if words else "false"
    joint = "AND" if pack.mode == "and" else "OR"
    return f"(NOT ({hit(pack.stop)}) AND (({hit(pack.usable_terms())}) {joint} ({hit(pack.signals)})))"


@query(
    "pack_gates",
    f"WITH m AS (SELECT p_partkey, lower('x ' || upper({_sql_list(_SAMPLES)}[CAST(p_partkey % {len(_SAMPLES)} AS INT) + 1]) || ' y') AS low FROM part) SELECT p_partkey, "
    + ", ".join(f"{_pack_sql(p)} AS {n}" for n, p in _PACKS.items())
    + " FROM m",
)
def pack_gates(spark, d):
    """Every fixed word in turn, in capitals, against the built-in gates."""
    word = F.get(F.array(*[F.lit(w) for w in _SAMPLES]), (F.col("p_partkey") % len(_SAMPLES)).cast("int"))
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.lit("x "), F.upper(word), F.lit(" y")).alias("text"))
    return rows.select("p_partkey", *[gates.gate(F.col("text"), pack).alias(name) for name, pack in _PACKS.items()])


_STOPPED = (*patterns.BUYER_STOP, "nothing at all")


@query(
    "stopwords_and_aggregators",
    f"""WITH m AS (SELECT p_partkey, {_sql_list(_STOPPED)}[CAST(p_partkey % {len(_STOPPED)} AS INT) + 1] || CASE WHEN p_partkey % 2 = 0 THEN ' with psp' ELSE ' AGGREGATOR' END AS said FROM part)
SELECT p_partkey, len(list_filter({_sql_list(patterns.BUYER_STOP)}, lambda w: contains(lower(said), w))) > 0 AND NOT contains(lower(said), 'psp') AS blocked,
CASE WHEN p_partkey % 2 = 1 THEN false WHEN p_partkey % 3 = 0 THEN true ELSE p_partkey % 3 = 1 END AS is_merchant FROM m""",
)
def stopwords_and_aggregators(spark, d):
    k = F.col("p_partkey")
    said = F.concat(F.get(F.array(*[F.lit(w) for w in _STOPPED]), (k % len(_STOPPED)).cast("int")), F.when(k % 2 == 0, " with psp").otherwise(" AGGREGATOR"))
    rows = table(spark, d, "part").select("p_partkey", said.alias("text"), F.when(k % 3 == 1, '{"label": "direct_merchant"}').when(k % 3 == 2, '{"label": "aggregator"}').alias("raw"))
    return rows.select("p_partkey", gates.anti_filter_blocks(F.col("text"), patterns.BUYER_STOP, ["psp"]).alias("blocked"), classifiers.merchant(F.col("raw"), F.col("text"), packs.AGGREGATORS).alias("is_merchant"))


# ---- keys that are null or repeat ---------------------------------------------------------


@query(
    "narrow_upsert",
    """WITH t AS (SELECT c_custkey AS k, 'old' AS a, c_mktsegment AS b FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT NULL, 'old', 'x'),
d AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey - c_custkey % 3 END AS k, 'new' || (c_custkey % 3) AS a, 'n' AS b, c_custkey AS o FROM customer),
l AS (SELECT k, arg_max(a, o) AS a FROM d WHERE k IS NOT NULL GROUP BY k)
SELECT t.k, coalesce(l.a, t.a) AS a, t.b FROM t LEFT JOIN l ON l.k = t.k UNION ALL SELECT k, a, 'n' FROM l WHERE k NOT IN (SELECT k FROM t WHERE k IS NOT NULL) UNION ALL SELECT k, a, b FROM d WHERE k IS NULL""",
)
def narrow_upsert(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    target = c.where("c_custkey % 2 = 0").select(k.alias("k"), F.lit("old").alias("a"), F.col("c_mktsegment").alias("b")).unionByName(spark.createDataFrame([(None, "old", "x")], "k bigint, a string, b string"))
    delta = c.select(F.when(k % 11 != 0, k - k % 3).alias("k"), F.concat(F.lit("new"), (k % 3).cast("string")).alias("a"), F.lit("n").alias("b"), k.alias("o"))
    return sinks.narrow_upsert(target, delta, ["k"], ["a"], ["o"]).select("k", "a", "b")


@query(
    "update_by_id",
    """WITH l AS (SELECT o_custkey AS k, max(o_orderkey) AS o FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_custkey) SELECT c_custkey, coalesce('order ' || o, c_mktsegment) AS label FROM customer LEFT JOIN l ON k = c_custkey""",
)
def update_by_id(spark, d):
    target = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("label"))
    delta = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("c_custkey"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"), "o_orderkey")
    return sinks.update_columns(target, delta, "c_custkey", ["label"], ["o_orderkey"])


@query(
    "insert_with_null_keys",
    """WITH d AS (SELECT CASE WHEN event_id % 5 <> 0 THEN user_id END AS u, CASE WHEN event_id % 7 <> 0 THEN event_type END AS e, event_id FROM events)
SELECT u, e, min(event_id) AS event_id FROM d WHERE u IS NOT NULL AND e IS NOT NULL AND NOT (u % 3 = 0 AND e = 'click') GROUP BY u, e UNION ALL SELECT * FROM d WHERE u IS NULL OR e IS NULL""",
)
def insert_with_null_keys(spark, d):
    rows = table(spark, d, "events").select(F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("u"), F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("e"), "event_id")
    known = rows.where("u % 3 = 0 and e = 'click'").unionByName(spark.createDataFrame([(None, "click", 0)], "u bigint, e string, event_id bigint"))
    held = table(spark, d, "events").where("user_id % 3 = 0 and event_type = 'click'").select(F.col("user_id").alias("u"), F.col("event_type").alias("e"), "event_id")
    return sinks.insert_if_absent(known.unionByName(held), rows, ["u", "e"], ["event_id"])


@query("probe_with_null_keys", "SELECT event_id, min(event_id) OVER (PARTITION BY event_type, CASE WHEN user_id % 4 <> 0 THEN user_id END) AS first_id FROM events")
def probe_with_null_keys(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("text"), F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("u"))
    return dedup.duplicate_probe(rows, "event_id", by=["u"]).select("event_id", "first_id")


@query(
    "geo_learned",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN n_name ELSE CASE WHEN c_custkey % 4 = 2 THEN 'NATION_1' ELSE '' END END AS geo, c_custkey % 4 = 3 AS unknown FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def geo_learned(spark, d):
    """Nothing named, a nation, a place that the scorer knows, and one that it doesn't."""
    nation = table(spark, d, "nation")
    named = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey") % 4
    places = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lower("n_name"))).when(k == 2, F.array(F.lit(" Gaul "))).otherwise(F.array(F.lit("Atlantis")))
    rows = named.select("c_custkey", places.alias("places"))
    mapping = nation.select(F.col("n_name").alias("raw_value"), F.col("n_name").alias("normalized"))
    scorer = scoring.RuleScorer({"geo": F.when(F.col("text") == "gaul", " nation_1 ").otherwise("ATLANTIS")})
    made, unknown, _ = geo.expand_and_learn(rows, mapping, mapping.select(F.col("normalized").alias("parent"), F.col("raw_value").alias("child")).where("false"), "c_custkey", "places", scorer)
    left = unknown.select(F.col("id").alias("c_custkey"), F.lit(True).alias("unknown"))
    return made.join(left, "c_custkey", "left").select("c_custkey", F.array_join("geo", ",").alias("geo"), F.coalesce("unknown", F.lit(False)).alias("unknown"))


# ---- evaluation, order, samples -----------------------------------------------------------


@query(
    "graded_decisions",
    """WITH p AS (SELECT user_id AS k, arg_max(event_type = 'purchase', event_id) AS p FROM events GROUP BY user_id), a AS (SELECT doc_id AS k, max(quality) = 1 AS a FROM labels GROUP BY doc_id),
c AS (SELECT count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp, count(*) FILTER (WHERE NOT p AND a) AS fn, count(*) FILTER (WHERE NOT p AND NOT a) AS tn FROM p JOIN a USING (k))
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM c""",
)
def graded_decisions(spark, d):
    said = table(spark, d, "events").select(F.col("user_id").alias("message_id"), (F.col("event_type") == "purchase").alias("is_lead"), "event_id")
    truth = table(spark, d, "labels").select(F.col("doc_id").alias("message_id"), (F.col("quality") == 1).alias("actual"))
    return evaluate.graded(said, truth, ["event_id"])


@query("name_stats", "SELECT count(*) AS messages, min(doc_id) AS first_at, max(doc_id) AS last_at, count(DISTINCT lang) AS users, count(DISTINCT source) FILTER (WHERE source <> 'src1') AS names FROM documents")
def name_stats(spark, d):
    rows = table(spark, d, "documents").withColumn("name", F.when(F.col("source") == "src1", F.lit("  ")).otherwise(F.col("source")))
    return evaluate.corpus_stats(rows, "doc_id", "lang", "name")


@query("restored_order", "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents QUALIFY doc_id IN (SELECT doc_id FROM labels)")
def restored_order(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    done = docs.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id")
    return sampling.in_order(done, docs, "doc_id", [F.desc("n_chars"), "doc_id"]).select("doc_id", "rn")


@query("seeded_sample", "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 40")
def seeded_sample(spark, d):
    return sampling.hashed(table(spark, d, "documents").select("doc_id"), "doc_id", 40)


@query("listed_entries", "SELECT p_name AS term, p_size / 50.0 AS confidence FROM part WHERE p_size >= 25 ORDER BY p_size DESC, p_name, p_partkey LIMIT 30")
def listed_entries(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("term"), F.lit(True).alias("relevant"), (F.col("p_size") / F.lit(50.0)).alias("confidence"))
    return outcomes.listing(rows, 0.5, 30).select("term", "confidence")


@query(
    "research_and_pruning",
    """SELECT p_partkey, p_size % 2 = 0 AND p_size <= 25 AS research, CASE p_partkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'a,c' ELSE 'a,b,c' END AS kept, CASE WHEN p_size % 3 = 0 THEN least(1.0, p_size / 50.0 + 0.1) ELSE p_size / 50.0 END AS confidence FROM part""",
)
def research_and_pruning(spark, d):
    k = F.col("p_partkey") % 4
    senses = F.array(*[F.lit(x) for x in "abc"])
    indices = F.when(k == 0, F.array(F.lit(0))).when(k == 1, F.array(F.lit(2), F.lit(0), F.lit(9))).when(k == 2, F.array(F.lit(7))).otherwise(F.array().cast("array<int>"))
    confidence = F.col("p_size") / F.lit(50.0)
    wanted = refine.wants_research(F.col("p_size") % 2 == 0, confidence)
    made = refine.enriched(confidence, F.when(F.col("p_size") % 3 == 0, 1).otherwise(0))
    return table(spark, d, "part").select("p_partkey", wanted.alias("research"), F.array_join(refine.keep_indices(senses, indices), ",").alias("kept"), made.alias("confidence"))


# ---- prompts ------------------------------------------------------------------------------


@query(
    "prompt_blocks",
    """WITH m AS (SELECT doc_id, lang, trim(replace(text, chr(10), ' ')) AS line FROM documents), c AS (SELECT *, CASE WHEN length(line) > 200 THEN substr(line, 1, 197) || '...' ELSE line END AS cut FROM m)
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'SIMILAR EXAMPLES:' || chr(10) || chr(10) || 'NOT LEAD:' || chr(10) || '  1. ' || cut || chr(10) ELSE 'SIMILAR EXAMPLES:' || chr(10) || chr(10) || 'NOT LEAD:' || chr(10) || '  1. ' || cut || chr(10) || '  2. x' || chr(10) || chr(10) || 'LEAD:' || chr(10) || '  1. y' || chr(10) END AS shots,
CASE WHEN doc_id % 2 = 0 THEN '  - ' || lang || ': sense' ELSE '  (no terms)' END AS terms, CASE WHEN doc_id % 2 = 0 THEN '  [msg_id=' || doc_id || ' @anon ?] ' || cut ELSE '  (no context)' END AS context,
CASE doc_id % 4 WHEN 0 THEN 'a group: a: 25.0%, seeking_traffic: 75.0% (4)' WHEN 1 THEN 'group: a: 60.0%, b: 40.0% (5, high)' ELSE '' END || CASE WHEN doc_id % 4 < 2 AND doc_id % 5 = 0 THEN chr(10) || chr(10) ELSE '' END
|| CASE WHEN doc_id % 5 = 0 THEN 'bio: ' || lang ELSE '' END || CASE WHEN doc_id % 4 < 2 OR doc_id % 5 = 0 THEN chr(10) ELSE '' END AS extra FROM c""",
)
def prompt_blocks(spark, d):
    k = F.col("doc_id")
    none = F.array().cast("array<string>")
    shots = prompts.few_shot(F.when(k % 3 == 0, none).when(k % 3 == 1, F.array("text")).otherwise(F.array(F.col("text"), F.lit("x"))), F.when(k % 3 == 2, F.array(F.lit(" y\n"))).otherwise(none))
    entry = F.struct(F.col("lang").alias("term"), F.array(F.struct(F.lit("sense").alias("definition"))).alias("senses"))
    terms = prompts.glossary_block(F.filter(F.array(entry), lambda _: k % 2 == 0))
    said = F.struct(k.alias("message_id"), F.lit("").alias("username"), F.lit(None).cast("string").alias("at"), F.col("text"))
    around = prompts.context_block(F.filter(F.array(said), lambda _: k % 2 == 0))
    mild = F.create_map(F.lit("b"), F.lit(0.4), F.lit("a"), F.lit(0.6))
    heavy = F.create_map(F.lit("seeking_traffic"), F.lit(0.75), F.lit("a"), F.lit(0.25))
    group = prompts.group_block(
        F.when(k % 4 == 0, "a group").when(k % 4 == 1, "group").when(k % 4 == 2, "low").otherwise(" "), F.when(k % 4 == 0, heavy).otherwise(mild), F.when(k % 4 == 0, 4).otherwise(5),
        F.when(k % 4 == 2, "low").otherwise("high"), "{group}: {distribution} ({total}, {confidence})", "{group}: {distribution} ({total})",
    )
    bio = prompts.bio_block(F.when(k % 5 == 0, F.concat(F.lit(" "), F.col("lang"))), "bio: {bio}")
    return table(spark, d, "documents").select("doc_id", shots.alias("shots"), terms.alias("terms"), around.alias("context"), prompts.extra_blocks(group, bio).alias("extra"))


@query(
    "bio_lookup",
    """SELECT o_orderkey, c_mktsegment AS bio FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 <> 0""",
)
def bio_lookup(spark, d):
    users = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("username"), F.col("c_mktsegment").alias("bio"))
    return context.with_bio(table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("username")), users).select("o_orderkey", "bio")


@query(
    "small_functions",
    """WITH m AS (SELECT doc_id, coalesce(source, '') AS s, doc_id % 30 + 1 AS day FROM documents)
SELECT doc_id, substr(trim(replace(' a' || chr(10) || s || chr(10), chr(10), ' ')), 1, 500) AS line, CASE WHEN doc_id % 2 = 0 THEN 'x|' || s ELSE ' x, ' || s || ',' END AS items,
CASE WHEN doc_id % 3 = 0 THEN '2024-03-' || lpad(day::VARCHAR, 2, '0') || ' 04:05:06' WHEN doc_id % 3 = 1 THEN '2024-01-' || lpad(day::VARCHAR, 2, '0') || ' 10:11:00' END AS at, CASE WHEN doc_id % 4 = 0 THEN 0.0 ELSE 1 / 3 END AS jaccard FROM m""",
)
def small_functions(spark, d):
    k, s = F.col("doc_id"), F.coalesce("source", F.lit(""))
    day = F.lpad((k % 30 + 1).cast("string"), 2, "0")
    stamp = F.when(k % 3 == 0, F.concat(F.lit("2024-03-"), day, F.lit(" 04:05:06"))).when(k % 3 == 1, F.concat(day, F.lit(".01.2024 10:11"))).otherwise("soon")
    raw = table(spark, d, "documents").select(k.cast("string").alias("Message_ID"), F.lit("t").alias("Text"), stamp.alias("Date"), "doc_id", "source")
    dated = readers.messages_of(raw.select("Message_ID", "Text", "Date")).select(F.col("message_id").alias("doc_id"), F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("at"))
    items = F.when(k % 2 == 0, F.array_join(text.as_list(F.concat(F.lit(" x, "), s, F.lit(","))), "|")).otherwise(F.array_join(text.as_list(F.concat(F.lit(" x, "), s, F.lit(",")), split=False), "|"))
    words = text.content_words(F.lit("alpha beta of"))
    other = F.when(k % 4 == 0, text.content_words(F.lit("of in"))).otherwise(text.content_words(F.lit("beta gamma")))
    made = raw.select("doc_id", text.one_line(F.concat(F.lit(" a\n"), s, F.lit("\n"))).alias("line"), items.alias("items"), text.jaccard(words, other).alias("jaccard"))
    return made.join(dated, "doc_id")
