"""All queries of the engine by name, each with its SQL counterpart where SQL can express it.

The driver's tables play the roles of messages (documents), threads (conversations), keyed
events, labels, an embedding index, pages and a star schema. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import normalise, text
from tidemark.operators import context, dedup, evaluate, gates, geo, lemmas, mining, outcomes, pipelines, quotes, refine, retrieve, route, sampling, scoring, sketches, textindex
from tidemark.plans import jobs
from tidemark.session import cut, dimension, spread, table
from tidemark.sources import readers, sinks
from tidemark.streaming import bans, verdicts, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TERMS = ("license", "disgusting", "trash", "table of")
SIGNALS = ("stupid", "pathetic", "scum")
STOP = ("apache", "token =")
PACK = gates.DomainPack(terms=TERMS, signals=SIGNALS, stop=STOP, generic=("table of",))
STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def query(name: str, sql: str | None = None):
    """Registers a query and its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def any_of(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# ---- gates --------------------------------------------------------------------------------


@query(
    "flagship_gate",
    f"""
WITH keyed AS (SELECT doc_id, lang, text, lower({STRIP.format('text')}) AS k FROM documents WHERE length({STRIP.format('text')}) >= 20),
firsts AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM keyed)
SELECT lang, count(*) AS messages, count(*) FILTER (WHERE {any_of('lower(text)', TERMS)} OR {any_of('lower(text)', SIGNALS)}) AS passed
FROM firsts WHERE rn = 1 GROUP BY lang""",
)
def flagship_gate(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang").where(gates.long_enough(F.col("text")))
    passed = text.contains_any(F.col("text"), TERMS) | text.contains_any(F.col("text"), SIGNALS)
    first = dedup.first_values(docs, ["doc_id"], {"lang": F.col("lang"), "passed": passed})
    return first.groupBy("lang").agg(F.count(F.lit(1)).alias("messages"), F.count_if("passed").alias("passed"))


@query("length_author_gate", f"SELECT doc_id FROM documents WHERE length({STRIP.format('text')}) >= 20 AND coalesce(source NOT IN ('src1', 'src3'), true)")
def length_author_gate(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return gates.eligible(docs, author="source", excluded=("src1", "src3")).select("doc_id")


@query("any_term_gate", f"SELECT doc_id, {any_of('lower(text)', TERMS)} AS hit FROM documents")
def any_term_gate(spark, d):
    return table(spark, d, "documents").select("doc_id", text.contains_any(F.col("text"), TERMS).alias("hit"))


@query("gate_or", f"SELECT doc_id FROM documents WHERE {any_of('lower(text)', TERMS[:3])} OR {any_of('lower(text)', SIGNALS)}")
def gate_or(spark, d):
    pack = gates.DomainPack(terms=TERMS, signals=SIGNALS, generic=("table of",))
    return table(spark, d, "documents").where(gates.gate(F.col("text"), pack)).select("doc_id")


@query("gate_stop_or", f"SELECT doc_id FROM documents WHERE NOT {any_of('lower(text)', STOP)} AND ({any_of('lower(text)', TERMS[:3])} OR {any_of('lower(text)', SIGNALS)})")
def gate_stop_or(spark, d):
    return table(spark, d, "documents").where(gates.gate(F.col("text"), PACK)).select("doc_id")


@query("gate_and", f"SELECT doc_id FROM documents WHERE {any_of('lower(text)', TERMS[:3])} AND {any_of('lower(text)', SIGNALS)}")
def gate_and(spark, d):
    pack = gates.DomainPack(terms=TERMS[:3], signals=SIGNALS, mode="and")
    return table(spark, d, "documents").where(gates.gate(F.col("text"), pack)).select("doc_id")


@query(
    "matched_terms",
    f"""SELECT doc_id, array_to_string(list_filter({listed(TERMS)}, lambda t: contains(lower(text), t)), ',') AS terms,
       array_to_string(list_filter({listed(SIGNALS)}, lambda t: contains(lower(text), t)), ',') AS signals FROM documents""",
)
def matched_terms(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(text.matched(F.col("text"), TERMS), ",").alias("terms"), F.array_join(text.matched(F.col("text"), SIGNALS), ",").alias("signals"))


@query("anti_filter", f"SELECT doc_id, {any_of('lower(text)', SIGNALS)} AND NOT {any_of('lower(text)', TERMS)} AS blocked FROM documents")
def anti_filter(spark, d):
    return table(spark, d, "documents").select("doc_id", gates.anti_filter_blocks(F.col("text"), SIGNALS, TERMS).alias("blocked"))


PATTERNS = (r"[0-9]{4}", r"licensed? under", r"@[a-z0-9]+\.", r"[*#$%]{3}", r"\| ")


@query("regex_hit_count", "SELECT doc_id, " + " + ".join(f"regexp_matches(text, '{p}')::INT" for p in PATTERNS) + " AS hits FROM documents")
def regex_hit_count(spark, d):
    return table(spark, d, "documents").select("doc_id", text.hit_count(F.col("text"), PATTERNS).alias("hits"))


@query("first_stop_pattern", "SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{p}'" for p in PATTERNS) + " END AS pattern FROM documents")
def first_stop_pattern(spark, d):
    return table(spark, d, "documents").select("doc_id", gates.first_pattern(F.col("text"), PATTERNS).alias("pattern"))


@query(
    "scam_gate_replay",
    f"""SELECT doc_id, {any_of('lower(text)', SIGNALS)} AND coalesce(toxic = 1, false) AS is_scam
FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)""",
)
def scam_gate_replay(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels")
    said = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    recorded = said.select(F.col("doc_id").alias("message_id"), F.lit("scam").alias("stage"), F.when(F.col("toxic") == 1, "YES").otherwise("no").alias("raw"))
    gated = pipelines.scam_gate(docs, text.contains_any(F.col("text"), SIGNALS), scoring.ReplayScorer(recorded, "doc_id"))
    return gated.select("doc_id", "is_scam")


@query("ban_anti_join", "SELECT doc_id FROM documents WHERE source IS NULL OR source NOT IN (SELECT DISTINCT 'src' || (n_nationkey % 7) FROM nation)")
def ban_anti_join(spark, d):
    nation = table(spark, d, "nation").select(F.concat(F.lit("src"), (F.col("n_nationkey") % 7).cast("string")).alias("username"))
    banned = gates.ban_set(nation.where("username < 'src3'"), nation.where("username >= 'src3'"))
    return gates.without_banned(table(spark, d, "documents").select("doc_id", "source"), banned, "source").select("doc_id")


@query("cascade_first_match", f"SELECT doc_id, CASE WHEN {any_of('lower(text)', SIGNALS)} THEN 'signals' WHEN {any_of('lower(text)', TERMS)} THEN 'terms' WHEN n_chars > 2000 THEN 'long' END AS claimed_by FROM documents")
def cascade_first_match(spark, d):
    docs = table(spark, d, "documents").withColumn("is_lead", F.lit(False))
    stages = [("signals", text.contains_any(F.col("text"), SIGNALS)), ("terms", text.contains_any(F.col("text"), TERMS)), ("long", F.col("n_chars") > 2000)]
    return pipelines.cascade(docs, stages).select("doc_id", "claimed_by")


@query(
    "gate_chain_disposition",
    f"""WITH f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(lower({STRIP.format('text')}))) AS first, source, text FROM documents)
SELECT doc_id, CASE WHEN first < doc_id THEN 'duplicate' WHEN source IN ('src2') THEN 'banned' WHEN {any_of('lower(text)', SIGNALS)} THEN 'scam' WHEN {any_of('lower(text)', STOP)} THEN 'blocked' ELSE 'classify' END AS disposition FROM f""",
)
def gate_chain_disposition(spark, d):
    low = F.col("text")
    flags = {"scam": text.contains_any(low, SIGNALS), "stop": text.contains_any(low, STOP), "text_hash": text.text_hash(low)}
    slim = table(spark, d, "documents").select("doc_id", "source", *[v.alias(n) for n, v in flags.items()])  # the text stays behind
    docs = dedup.duplicate_probe(slim, "doc_id")
    made = pipelines.disposition(docs, F.col("first_id") < F.col("doc_id"), F.col("source") == "src2", F.col("scam"), F.col("stop"))
    return made.select("doc_id", "disposition")


# ---- dedup and context --------------------------------------------------------------------


@query("exact_dedup_first", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY lower({STRIP.format('text')})")
def exact_dedup_first(spark, d):
    return dedup.first_values(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], {"doc_id": F.col("doc_id")})


@query("exact_dedup_by_author", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY source, lower({STRIP.format('text')})")
def exact_dedup_by_author(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return dedup.first_values(docs, ["doc_id"], {"doc_id": F.col("doc_id")}, by=["source"]).select("doc_id")


HASHED = f"md5(lower({STRIP.format('text')}))"


@query("hash_dup_groups", f"SELECT {HASHED} AS text_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def hash_dup_groups(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.text_hash(F.col("text")).alias("text_hash"))
    return docs.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query("cross_user_dup", f"SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, {HASHED}) AS first_id FROM documents")
def cross_user_dup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return dedup.duplicate_probe(docs, "doc_id", by=["lang"]).select("doc_id", "first_id")


def _events(spark, d):
    return table(spark, d, "events").withColumn("at", F.unix_timestamp(F.col("ts").cast("timestamp")))


@query(
    "dedup_state_machine",
    STATE_MACHINE := """WITH RECURSIVE rows AS (
  SELECT event_id, user_id, md5(event_type) AS h, CAST(floor(epoch(ts)) AS BIGINT) AS sec, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS rn FROM events
), fold AS (
  SELECT event_id, user_id, rn, 'keep' AS verdict, h AS sh, sec AS sat FROM rows WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.user_id, r.rn,
         CASE WHEN r.sec - f.sat < 10800 THEN 'hold' WHEN r.h = f.sh AND r.sec - f.sat < 86400 THEN 'text' ELSE 'keep' END,
         CASE WHEN r.sec - f.sat < 10800 OR (r.h = f.sh AND r.sec - f.sat < 86400) THEN f.sh ELSE r.h END,
         CASE WHEN r.sec - f.sat < 10800 OR (r.h = f.sh AND r.sec - f.sat < 86400) THEN f.sat ELSE r.sec END
  FROM fold f JOIN rows r ON r.user_id = f.user_id AND r.rn = f.rn + 1
)
SELECT event_id, verdict FROM fold""",
)
def dedup_state_machine(spark, d):
    return dedup.user_dedup(_events(spark, d), "event_id", "user_id", "event_type", "at", hold=180 * 60)


def _stream_path(spark, d, name: str) -> str:
    """A stream reads folders or patterns: a table of one file is matched by a pattern that fits nothing else."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
    single = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    return f"{d}/{name}.parque[t]" if single else f"{d}/{name}.parquet"


@query("dedup_stream", STATE_MACHINE)
def dedup_stream(spark, d):
    """The streaming twin over the same events, one available-now run into the shared folder."""
    from tidemark.streaming.dedup import dedup_stream as streamed

    source = spark.readStream.schema(table(spark, d, "events").schema).parquet(_stream_path(spark, d, "events"))
    rows = source.withColumn("at", F.unix_timestamp(F.col("ts").cast("timestamp")))
    made = streamed(rows, "event_id", "user_id", "event_type", "at", hold=180 * 60)
    return _drained(spark, made, "event_id bigint, verdict string")


def _drained(spark, made, schema: str):
    """What one available-now run of a stream appends in the shared folder."""
    from tidemark.session import scratch_path

    out = scratch_path(spark, "stream")
    run = made.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/rows")


SESSIONS = """WITH gaps AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
islands AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM gaps),
sessions AS (SELECT user_id, epoch_us(min(ts)) AS began_us, epoch_us(max(ts)) AS ended_us, count(*) AS messages FROM islands GROUP BY user_id, island)
SELECT user_id, began_us, ended_us, messages FROM sessions"""


def _micros(rows, *names):
    return rows.withColumns({f"{n}_us": F.unix_micros(n) for n in names}).drop(*names)


@query("user_sessions", SESSIONS)
def user_sessions(spark, d):
    return _micros(windows.sessions(table(spark, d, "events"), "user_id", "ts", "2 hours"), "began", "ended")


@query("user_sessions_stream", SESSIONS + " WHERE ended_us + 7200000000 <= (SELECT epoch_us(max(ts)) - 21600000000 FROM events WHERE user_id IS NOT NULL)")
def user_sessions_stream(spark, d):
    """Sessions that the watermark has closed by the end of the stream: six hours behind the last event."""
    source = spark.readStream.schema(table(spark, d, "events").schema).parquet(_stream_path(spark, d, "events"))
    made = windows.sessions(source, "user_id", "ts", "2 hours", "6 hours")
    return _micros(_drained(spark, made, "user_id bigint, began timestamp, ended timestamp, messages bigint"), "began", "ended")


@query(
    "usage_windows_stream",
    """WITH starts AS (SELECT event_type, value, epoch_us(ts) // 43200000000 * 43200000000 - k * 43200000000 AS start_us FROM events, (SELECT unnest([0, 1]) AS k) WHERE ts IS NOT NULL)
SELECT event_type, start_us, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM starts
WHERE start_us + 86400000000 <= (SELECT epoch_us(max(ts)) - 21600000000 FROM events) GROUP BY event_type, start_us""",
)
def usage_windows_stream(spark, d):
    """Daily totals by kind that begin twice a day, of the windows that the watermark has closed."""
    source = spark.readStream.schema(table(spark, d, "events").schema).parquet(_stream_path(spark, d, "events"))
    measures = {"events": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("bigint"))}
    made = windows.sliding(source, "ts", ["event_type"], measures, "1 day", "12 hours", "6 hours").drop("end")
    return _micros(_drained(spark, made, "event_type string, start timestamp, events bigint, cents bigint"), "start")


ORDER_VERDICTS = """WITH met AS (SELECT o_orderkey, o_orderdate, l_shipdate, l_returnflag FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY)
SELECT o_orderkey, epoch_us(o_orderdate) AS o_orderdate_us, coalesce(arg_max(l_returnflag, (l_shipdate, l_returnflag)), 'REVIEW') AS verdict, count(l_shipdate) AS verdicts FROM met"""


def _flags(lines):
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", F.col("l_returnflag").alias("verdict"))


@query("judged_within_wait", ORDER_VERDICTS + " GROUP BY o_orderkey, o_orderdate")
def judged_within_wait(spark, d):
    """Orders as leads, the flag of the last line shipped within 30 days as verdict."""
    made = verdicts.judged_within(table(spark, d, "orders"), _flags(table(spark, d, "lineitem")), "o_orderkey", "o_orderdate", "l_shipdate", wait="30 DAYS")
    return _micros(made, "o_orderdate")


@query(
    "judged_within_wait_stream",
    ORDER_VERDICTS + """ WHERE o_orderdate + INTERVAL 30 DAY < (SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL 36 HOUR)
GROUP BY o_orderkey, o_orderdate""",
)
def judged_within_wait_stream(spark, d):
    """The same over two streams: the leads whose wait the watermarks have passed; what waits lies in a table."""
    from tidemark.session import scratch_path

    out = scratch_path(spark, "stream")
    leads, lines = (spark.readStream.schema(table(spark, d, n).schema).parquet(_stream_path(spark, d, n)) for n in ("orders", "lineitem"))

    def sink(rows, number):
        rows.write.mode("overwrite").parquet(f"{out}/rows/{number}")

    made = verdicts.judged_in_batches(leads, _flags(lines), "o_orderkey", "o_orderdate", "l_shipdate", sink, f"{out}/waiting", wait="30 DAYS", delay="36 hours")
    made.option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return _micros(spark.read.schema("o_orderkey bigint, o_orderdate timestamp, verdict string, verdicts bigint").parquet(f"{out}/rows/*"), "o_orderdate")


@query(
    "daily_sketches",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n, count(DISTINCT user_id) AS users, true AS users_in_bound, true AS median_in_bound FROM events GROUP BY event_type",
)
def daily_sketches(spark, d):
    """Sketches per day and kind, stored, merged to totals and held against exact counts and ranks (four standard errors)."""
    rows = table(spark, d, "events")
    stored = cut(sketches.daily_sketches(rows, ["event_type"], "ts", "user_id", "value"), "sketches")
    told = sketches.merged_sketches(stored, ["event_type"], [0.5])
    medians = told.select(F.col("event_type").alias("kind"), F.get("quantiles", 0).alias("median"))
    both = rows.select("event_type", "user_id", "value").join(dimension(medians), F.col("event_type").eqNullSafe(F.col("kind")), "left")
    exact = both.groupBy(F.col("event_type").alias("kind")).agg(F.count_distinct("user_id").alias("users"), F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))
    off = 2 * sketches.KLL_RANK_ERROR
    return told.join(exact, F.col("event_type").eqNullSafe(F.col("kind"))).select(
        "event_type",
        "n",
        "users",
        (F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * 4 * sketches.HLL_ERROR)).alias("users_in_bound"),
        ((F.col("below") <= 0.5 + off) & (F.col("upto") >= 0.5 - off)).alias("median_in_bound"),
    )


@query(
    "live_bans_stream",
    """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS u, ts, max(event_type = 'error') AS banned FROM events WHERE event_type IN ('error', 'signup') AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
SELECT e.event_id, epoch_us(e.ts) AS ts_us, coalesce(c.banned, false) AS banned FROM (SELECT * FROM events WHERE event_type NOT IN ('error', 'signup')) e ASOF LEFT JOIN c ON CAST(e.user_id AS VARCHAR) = c.u AND e.ts >= c.ts""",
)
def live_bans_stream(spark, d):
    """A user is banned from an ``error`` event on until a ``signup``: both are changes of the list, the others messages."""
    events = spark.readStream.schema(table(spark, d, "events").schema).parquet(_stream_path(spark, d, "events")).withColumn("user", F.col("user_id").cast("string"))
    listed_at = F.col("event_type").isin("error", "signup")
    changes = events.where(listed_at).select(F.col("user").alias("username"), (F.col("event_type") == "error").alias("banned"), F.lit(1).cast("bigint").alias("generation"), F.col("ts").alias("at"))
    made = bans.flag_banned(events.where(~listed_at).select("event_id", "ts", "user"), changes, "user", "ts", spread=1)  # changes are as many as messages here
    return _micros(_drained(spark, made.drop("user"), "event_id bigint, ts timestamp, banned boolean"), "ts")


@query(
    "reply_merge",
    """WITH parents AS (SELECT conv_id, turn, text FROM conversations)
SELECT c.conv_id, c.turn, CASE WHEN p.text IS NOT NULL AND trim(p.text) <> '' THEN '[context] ' || p.text || chr(10) || coalesce(c.text, '') ELSE c.text END AS text
FROM conversations c LEFT JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""",
)
def reply_merge(spark, d):
    turns = table(spark, d, "conversations")
    keyed = turns.withColumns({"id": F.struct("conv_id", "turn"), "reply_to": F.struct("conv_id", (F.col("turn") - 1).alias("turn"))})
    return context.merge_replies(keyed, "id", "reply_to").select("conv_id", "turn", "text")


def _window_sql(before: int, after: int) -> str:
    ahead = f", lead(turn, 1) OVER w" if after else ""
    back = ", ".join(f"lag(turn, {i}) OVER w" for i in range(before, 0, -1))
    return f"SELECT conv_id, turn, array_to_string(list_filter([{back}{ahead}], lambda x: x IS NOT NULL), ',') AS context FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"


@query("context_window", _window_sql(5, 1))
def context_window(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn")
    made = context.with_context(turns, ["conv_id"], ["turn"], F.col("turn"), 5, 1)
    return made.select("conv_id", "turn", F.array_join(F.col("context").cast("array<string>"), ",").alias("context"))


@query("provider_context", _window_sql(3, 0))
def provider_context(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn")
    made = context.with_context(turns, ["conv_id"], ["turn"], F.col("turn"), 3, 0)
    return made.select("conv_id", "turn", F.array_join(F.col("context").cast("array<string>"), ",").alias("context"))


@query(
    "author_history_cap",
    """SELECT conv_id, turn, substr(coalesce(array_to_string(list_reverse(list(coalesce(text, '')) OVER (PARTITION BY conv_id, role ORDER BY turn ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)), chr(10)), ''), 1, 3000) AS history FROM conversations""",
)
def author_history_cap(spark, d):
    return context.author_history(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "turn", "history")


# ---- mining -------------------------------------------------------------------------------

CORE = "regexp_replace(regexp_replace(s, 's+$', ''), '''+$', '')"
UNITS = f"""
raw AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(text, '[A-Za-zЀ-ӿ0-9][A-Za-zЀ-ӿ0-9''\\-_]*')) AS s FROM documents),
flags AS (SELECT id, s, {CORE} AS core, regexp_matches(s, '[A-Za-z]') AS latin, regexp_matches(s, '[Ѐ-ӿ]') AS cyr, regexp_matches(s, '[0-9]') AS dig, regexp_matches(s, '^[0-9]') AS led FROM raw),
kinds AS (SELECT *, CASE WHEN s IN ('7995','6051','5816','7993','7994','5967','6010','6012') THEN 'mcc' WHEN latin AND cyr THEN 'mixed'
  WHEN led AND latin THEN CASE WHEN regexp_matches(core, '^.[A-Z]{{2,5}}$') THEN 'acronym' END
  WHEN latin AND NOT cyr AND NOT dig AND upper(core) = core AND regexp_matches(core, '[A-Za-z]') AND length(core) BETWEEN 2 AND 6 THEN 'acronym'
  WHEN latin AND NOT cyr AND NOT dig AND regexp_matches(s, '^[A-Z]') AND upper(s) <> s THEN 'proper'
  WHEN latin AND NOT cyr AND NOT dig AND lower(s) = s AND length(s) >= 4 THEN 'latin_word'
  WHEN latin AND dig AND NOT led AND NOT cyr AND upper(s) = s AND length(s) BETWEEN 3 AND 6 THEN 'acronym' END AS kind FROM flags),
units AS (SELECT id, s, kind, CASE WHEN kind = 'acronym' THEN upper(core) ELSE s END AS norm FROM kinds
  WHERE kind IS NOT NULL AND (kind <> 'acronym' OR length(CASE WHEN kind = 'acronym' THEN upper(core) ELSE s END) BETWEEN 2 AND 6)),
spelled AS (SELECT norm, s, count(*) AS n, min(kind) AS kind FROM units GROUP BY norm, s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY n DESC, s) AS pos FROM spelled),
terms AS (SELECT norm AS term, min(kind) AS kind, CAST(sum(n) AS BIGINT) AS frequency, string_agg(CASE WHEN pos <= 5 THEN s END, ',' ORDER BY pos) AS surface_forms
  FROM ranked GROUP BY norm HAVING sum(n) >= 3)"""


def _terms(spark, d):
    return mining.candidates(mining.message_tokens(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id"))


@query("token_candidates", f"WITH {UNITS} SELECT term, kind, frequency, surface_forms FROM terms")
def token_candidates(spark, d):
    return _terms(spark, d).withColumn("surface_forms", F.array_join("surface_forms", ","))


@query("candidate_top20", f"WITH {UNITS} SELECT term, frequency FROM terms ORDER BY frequency DESC, term LIMIT 20")
def candidate_top20(spark, d):
    return _terms(spark, d).select("term", "frequency").orderBy(F.desc("frequency"), "term").limit(20)


@query("kind_summary", f"WITH {UNITS} SELECT kind, count(*) AS terms, CAST(sum(frequency) AS BIGINT) AS mentions FROM terms GROUP BY kind")
def kind_summary(spark, d):
    return mining.kind_summary(_terms(spark, d))


@query(
    "cluster_merge",
    f"""WITH {UNITS} SELECT lower(term) AS cluster, arg_max(term, (frequency, term)) AS term, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'phrase' END AS kind,
CAST(sum(frequency) AS BIGINT) AS frequency FROM terms GROUP BY lower(term)""",
)
def cluster_merge(spark, d):
    return mining.cluster(_terms(spark, d)).select("cluster", "term", "kind", "frequency")


LEMMA_ENDS = ("s", "en", "e", "n")


@query(
    "lemma_clusters",
    f"""WITH {UNITS},
voc AS (SELECT DISTINCT lower(term) AS w FROM terms),
cand AS (SELECT w, substr(w, 1, length(w) - length(e)) AS stem FROM voc, (SELECT unnest({listed(LEMMA_ENDS)}) AS e) WHERE length(w) >= length(e) + 3 AND ends_with(w, e)),
forms AS (SELECT w AS form, max(stem) AS lemma FROM cand WHERE stem IN (SELECT w FROM voc) GROUP BY w),
pairs AS (SELECT form, lemma FROM forms UNION SELECT lemma, lemma FROM forms WHERE lemma NOT IN (SELECT form FROM forms)),
nodes AS (SELECT form, lemma, length(form) - length(lemma) AS cut, unnest(range(length(form) - length(lemma), least(5, length(form)) + 1)) AS n FROM pairs),
counted AS (SELECT right(form, n) AS suffix, cut, count(*) AS support FROM nodes GROUP BY ALL),
rules AS (SELECT suffix, cut FROM counted WHERE support >= 2 QUALIFY row_number() OVER (PARTITION BY suffix ORDER BY support DESC, cut) = 1),
words AS (SELECT term, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (SELECT term, regexp_extract_all(lower(term), '[A-Za-zЀ-ӿ][A-Za-zЀ-ӿ0-9\\-'']*') AS ws FROM terms)),
asked AS (SELECT DISTINCT w FROM words WHERE w NOT IN (SELECT form FROM pairs)),
tried AS (SELECT w, right(w, n) AS suffix FROM (SELECT w, unnest(range(0, least(5, length(w)) + 1)) AS n FROM asked)),
guessed AS (SELECT w, arg_max(substr(w, 1, length(w) - cut), length(suffix)) AS lemma FROM tried JOIN rules USING (suffix) WHERE length(w) > cut GROUP BY w),
keyed AS (SELECT term, string_agg(coalesce(p.lemma, g.lemma, words.w), ' ' ORDER BY pos) AS cluster FROM words LEFT JOIN pairs p ON p.form = words.w LEFT JOIN guessed g ON g.w = words.w GROUP BY term)
SELECT coalesce(k.cluster, lower(t.term)) AS cluster, arg_max(t.term, (frequency, t.term)) AS term, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'phrase' END AS kind,
CAST(sum(frequency) AS BIGINT) AS frequency FROM terms t LEFT JOIN keyed k ON k.term = t.term GROUP BY ALL""",
)
def lemma_clusters(spark, d):
    """Terms clustered by lemmas; the forms that teach the rules are the corpus's own words whose stem is a word too."""
    terms = cut(_terms(spark, d), "terms")
    words = terms.select(F.lower("term").alias("w")).distinct()
    ends = F.filter(F.array(*[F.lit(e) for e in LEMMA_ENDS]), lambda e: F.endswith(F.col("w"), e) & (F.length("w") >= F.length(e) + 3))
    stems = words.select("w", F.explode(ends).alias("e")).select("w", F.left("w", F.length("w") - F.length("e")).alias("stem"))
    forms = stems.join(words.select(F.col("w").alias("stem")), "stem").groupBy(F.col("w").alias("form")).agg(F.max("stem").alias("lemma"))
    themselves = forms.select("lemma").distinct().join(forms.select(F.col("form").alias("lemma")), "lemma", "left_anti")
    pairs = cut(forms.unionByName(themselves.select(F.col("lemma").alias("form"), "lemma")), "lemma-pairs")
    return mining.cluster(lemmas.with_lemma_key(terms, pairs), F.col("lemma_key")).select("cluster", "term", "kind", "frequency")


@query(
    "hash_examples",
    f"""WITH {UNITS}, one AS (SELECT DISTINCT norm, id FROM units WHERE kind = 'acronym'),
sampled AS (SELECT norm, id, CAST(row_number() OVER (PARTITION BY norm ORDER BY md5('42:' || id), id) AS INT) AS r FROM one)
SELECT norm, id, r FROM sampled WHERE r <= 25""",
)
def hash_examples(spark, d):
    units = mining.message_tokens(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id")
    names = mining.classified(units.select("surface").distinct()).where("kind = 'acronym'").select("surface", "norm")
    return mining.hash_examples(units.join(names, "surface"), 25)


PHRASES = ("of the", "and the", "in the", "de la", "der ein")


@query(
    "phrase_backfill",
    f"""WITH hits AS (SELECT doc_id, unnest(list_filter({listed(PHRASES)}, lambda p: contains(lower(text), p))) AS phrase FROM documents)
SELECT phrase, count(*) AS frequency, array_to_string(list_slice(list_sort(list(doc_id)), 1, 15), ',') AS examples FROM hits GROUP BY phrase""",
)
def phrase_backfill(spark, d):
    made = mining.phrase_backfill(spread(table(spark, d, "documents").select("doc_id", "text")), PHRASES, "doc_id")
    return made.withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


GAZETTEER = (
    {"canonical": "Apache", "forms": ["Apache License", "Apache"], "category": "license"},
    {"canonical": "CC", "forms": ["CC BY-NC 4.0", "CC"], "category": "license"},
    {"canonical": "That", "forms": ["that", "this"], "category": "word"},
)


def _form_sql(form: str) -> str:
    return f"regexp_matches(text, '(?i)(^|[^A-Za-z0-9]){form.replace('.', chr(92) + '.')}($|[^A-Za-z0-9])')"


@query(
    "gazetteer_scan",
    "WITH hits AS ("
    + " UNION ALL ".join(
        f"SELECT '{e['canonical']}' AS term, 'gazetteer:{e['category']}' AS kind, CASE " + " ".join(f"WHEN {_form_sql(f)} THEN '{f}'" for f in e["forms"]) + " END AS form FROM documents" for e in GAZETTEER
    )
    + ") SELECT term, kind, count(*) AS frequency, array_to_string(list_sort(list(DISTINCT form)), ',') AS surface_forms FROM hits WHERE form IS NOT NULL GROUP BY term, kind",
)
def gazetteer_scan(spark, d):
    made = mining.gazetteer_scan(spread(table(spark, d, "documents").select("doc_id", "text")), GAZETTEER, "doc_id")
    return made.withColumn("surface_forms", F.array_join("surface_forms", ","))


@query(
    "gazetteer_table",
    r"""WITH spelled AS (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
pairs AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS form FROM spelled),
forms AS (
  SELECT form AS term, 'pair' AS kind, form FROM pairs
  UNION ALL SELECT lower(n_name), 'nation', lower(n_name) FROM nation
  UNION ALL SELECT DISTINCT p_name, 'part', p_name FROM part
), said AS (SELECT doc_id, lower(text) AS low FROM documents WHERE text IS NOT NULL)
SELECT term, kind, count(*) AS frequency FROM said JOIN forms ON contains(low, form) AND regexp_matches(low, '(^|[^a-z0-9])' || form || '($|[^a-z0-9])')
GROUP BY term, kind""",
)
def gazetteer_table(spark, d):
    """Terms from tables: every pair of words of the benchmark, nations and part names, in all documents."""
    words = table(spark, d, "benchmark").select(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("w"))
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat(F.get("w", i - 1), F.lit(" "), F.get("w", i)))).alias("form")).where("form is not null")
    named = [pairs.distinct().withColumn("kind", F.lit("pair"))]
    named.append(table(spark, d, "nation").select(F.lower("n_name").alias("form"), F.lit("nation").alias("kind")))
    named.append(table(spark, d, "part").select(F.col("p_name").alias("form"), F.lit("part").alias("kind")).distinct())
    forms = named[0].unionByName(named[1]).unionByName(named[2])
    forms = forms.select(F.concat("kind", F.lit(":"), "form").alias("term"), "kind", "form", F.lit(0).cast("bigint").alias("at"), F.lit(True).alias("alone"))
    made = mining.gazetteer_join(spread(table(spark, d, "documents").select("doc_id", "text")), forms, "doc_id")
    return made.select(F.get("surface_forms", 0).alias("term"), "kind", "frequency")


BRANDS = {"site": r"([A-Za-z][A-Za-z0-9-]+)\.(?:example|org|com|net)", "mailbox": r"@([A-Za-z][A-Za-z0-9-]*)\."}


@query(
    "brand_domains",
    f"""WITH hits AS (
  SELECT 'site' AS pattern, unnest(regexp_extract_all(said, '{BRANDS['site']}', 1)) AS b FROM (SELECT concat_ws(' ', url, html) AS said FROM pages)
  UNION ALL SELECT 'mailbox', unnest(regexp_extract_all(said, '{BRANDS['mailbox']}', 1)) FROM (SELECT concat_ws(' ', url, html) AS said FROM pages)
), rows AS (SELECT pattern, regexp_replace(b, '^[.,;:''" \t-]+|[.,;:''" \t-]+$', '', 'g') AS b FROM hits),
cells AS (SELECT lower(b) AS k, b, pattern, count(*) AS n FROM rows WHERE length(b) >= 4 AND lower(b) <> 'spam-farm' GROUP BY ALL),
names AS (SELECT k, arg_max(b, (n, b)) AS brand, CAST(sum(n) AS BIGINT) AS frequency FROM (SELECT k, b, sum(n) AS n FROM cells GROUP BY k, b) GROUP BY k)
SELECT brand, frequency FROM names""",
)
def brand_domains(spark, d):
    pages = table(spark, d, "pages").select(F.concat_ws(" ", "url", "html").alias("text"))
    return mining.mine_brands(pages, BRANDS, skip=("Spam-Farm",)).select("brand", "frequency")


DEFINED = ("Nation", "Region")


@query(
    "self_definitions",
    """WITH src AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'In short: Nation means ' || c_mktsegment || ' of ' || c_nationkey || '.' ELSE 'x Region = area ' || (c_custkey % 11) || ' (big). Nation: ' || c_mktsegment || '!' END AS text FROM customer),
hits AS (
  SELECT id, 'Nation' AS term, 6 AS pos, 'en_means' AS pattern, regexp_extract(text, '(?i)Nation\\s+means\\s+([^.\\n]{4,140})', 1) AS def FROM src
  UNION ALL SELECT id, 'Nation', 20, 'colon', regexp_extract(text, '(?i)Nation\\s*:\\s*([A-Za-z][^.\\n]{4,140})', 1) FROM src
  UNION ALL SELECT id, 'Region', 18, 'equals', regexp_extract(text, '(?i)Region\\s*=\\s*([^.\\n]{4,140})', 1) FROM src
), clean AS (SELECT id, term, pos, pattern, regexp_replace(trim(def), '\\s*\\([^)]*\\)\\s*$', '') AS definition FROM hits WHERE def <> ''),
firsts AS (SELECT term, lower(definition) AS k, min((id, pos, pattern, definition)) AS m FROM clean WHERE length(definition) >= 4 GROUP BY term, lower(definition)),
ranked AS (SELECT term, m[4] AS definition, m[3] AS pattern, m[1] AS id, row_number() OVER (PARTITION BY term ORDER BY m[1], m[2], m[4]) AS r FROM firsts)
SELECT term, definition, pattern, id FROM ranked WHERE r <= 3""",
)
def self_definitions(spark, d):
    c = spread(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"))
    even = F.concat(F.lit("In short: Nation means "), "c_mktsegment", F.lit(" of "), F.col("c_nationkey").cast("string"), F.lit("."))
    odd = F.concat(F.lit("x Region = area "), (F.col("c_custkey") % 11).cast("string"), F.lit(" (big). Nation: "), "c_mktsegment", F.lit("!"))
    rows = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, even).otherwise(odd).alias("text"))
    return mining.self_definitions(rows, DEFINED, "id")


KEYS = (("the", "T1"), ("that", "T2"), ("licensed under", "T3"), ("de", "T4"), ("thing", "T2"), ("stupid", "T5"))


def _hit_sql(key: str, term: str) -> str:
    if len(key) <= 3:
        return f"CASE WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){key}($|[^\\p{{L}}\\p{{N}}_])') THEN '{term}' END"
    return f"CASE WHEN contains(lower(text), '{key}') THEN '{term}' END"


_ORDERED = sorted(KEYS, key=lambda kv: -len(kv[0]))


@query(
    "glossary_topk_hits",
    "WITH hits AS (SELECT doc_id, list_filter([" + ", ".join(_hit_sql(*kv) for kv in _ORDERED) + "], lambda x: x IS NOT NULL) AS l FROM documents) "
    "SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:12], ',') AS terms FROM hits",
)
def glossary_topk_hits(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(retrieve.glossary_hits(F.col("text"), KEYS), ",").alias("terms"))


# ---- refinement ---------------------------------------------------------------------------


@query(
    "severity_penalty",
    """WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Business' ELSE 'term' END AS term, 0.1 + (doc_id % 9) / 10.0 AS c, CASE doc_id % 3 WHEN 0 THEN 'major' WHEN 1 THEN 'minor' ELSE 'none' END AS sev, quality = 1 AS dom, toxic = 1 AS noise FROM labels)
SELECT doc_id, CAST(round(CASE WHEN term = 'Business' THEN least(c, 0.2) WHEN NOT dom OR noise THEN least(c, 0.3) WHEN sev = 'major' THEN greatest(0, c - 0.2) WHEN sev = 'minor' THEN greatest(0, c - 0.1) ELSE c END * 1000) AS BIGINT) AS confidence_milli,
term <> 'Business' AND dom AND NOT noise AS relevant FROM t""",
)
def severity_penalty(spark, d):
    labels = table(spark, d, "labels")
    rows = labels.select(
        "doc_id",
        F.when(F.col("doc_id") % 4 == 0, "Business").otherwise("term").alias("term"),
        F.lit(True).alias("relevant"),
        (F.lit(0.1) + (F.col("doc_id") % 9) / 10.0).alias("confidence"),
        F.when(F.col("doc_id") % 3 == 0, "major").when(F.col("doc_id") % 3 == 1, "minor").otherwise("none").alias("severity"),
        (F.col("quality") == 1).alias("domain_specific"),
        (F.col("toxic") == 1).alias("noise"),
    )
    made = refine.penalise(rows, ("business",))
    return made.select("doc_id", F.round(F.col("confidence") * 1000).cast("bigint").alias("confidence_milli"), "relevant")


@query(
    "sense_prune",
    """WITH RECURSIVE t AS (SELECT conv_id, turn // 2 AS evidence, row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn, text) AS rn,
  list_distinct(list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), lambda w: length(w) > 2)) AS words FROM conversations),
fold AS (SELECT conv_id, evidence, rn, [words] AS kept FROM t WHERE rn = 1
  UNION ALL SELECT t.conv_id, t.evidence, t.rn, CASE WHEN len(list_filter(f.kept, lambda k: len(k) > 0 AND len(t.words) > 0 AND len(list_intersect(k, t.words)) / len(list_distinct(list_concat(k, t.words))) >= 0.55)) > 0 THEN f.kept ELSE list_append(f.kept, t.words) END
  FROM fold f JOIN t ON t.conv_id = f.conv_id AND t.evidence = f.evidence AND t.rn = f.rn + 1)
SELECT conv_id, CAST(sum(n) AS BIGINT) AS kept FROM (SELECT conv_id, evidence, max(len(kept)) AS n FROM fold GROUP BY ALL) GROUP BY conv_id""",
)
def sense_prune(spark, d):
    """Senses of one term per conversation: its turns as definitions, turn numbers as evidence.

    A sense has one piece of evidence here and only repeats another with the same one, so
    each piece is pruned by itself and long conversations are no long folds.
    """
    turns = table(spark, d, "conversations").withColumn("evidence", (F.col("turn") / 2).cast("bigint"))
    sense = F.struct("turn", F.struct(F.col("text").alias("definition"), F.array("evidence").alias("example_message_ids")).alias("s"))
    grouped = turns.groupBy("conv_id", "evidence").agg(F.transform(F.array_sort(F.collect_list(sense)), lambda x: x["s"]).alias("senses"))
    return refine.prune_senses(grouped).groupBy("conv_id").agg(F.sum(F.size("senses")).cast("bigint").alias("kept"))


@query(
    "parent_child",
    """WITH t AS (SELECT n_name AS term, [n_nationkey, n_regionkey + 100] AS ids FROM nation UNION ALL SELECT n_name || ' Pay', [n_nationkey, n_regionkey + CASE WHEN n_nationkey % 2 = 0 THEN 100 ELSE 200 END] FROM nation WHERE n_nationkey % 3 = 0
UNION ALL SELECT n_name || ' Shop', [n_nationkey] FROM nation)
SELECT t.term, c.term IS NULL AS relevant, CAST(CASE WHEN c.term IS NULL THEN 80 ELSE 25 END AS BIGINT) AS confidence_percent
FROM t LEFT JOIN t c ON c.term = t.term || ' Pay' AND len(list_intersect(t.ids, c.ids)) / len(t.ids) >= 0.5""",
)
def parent_child(spark, d):
    n = table(spark, d, "nation")
    one = n.select(F.col("n_name").alias("term"), F.array("n_nationkey", F.col("n_regionkey") + 100).alias("ids"))
    pay = n.where("n_nationkey % 3 = 0").select(F.concat("n_name", F.lit(" Pay")).alias("term"), F.array("n_nationkey", F.col("n_regionkey") + F.when(F.col("n_nationkey") % 2 == 0, 100).otherwise(200)).alias("ids"))
    shop = n.select(F.concat("n_name", F.lit(" Shop")).alias("term"), F.array("n_nationkey").alias("ids"))
    terms = one.unionByName(pay).unionByName(shop).withColumns({"relevant": F.lit(True), "confidence": F.lit(0.8)})
    return refine.parent_child(terms).select("term", "relevant", F.round(F.col("confidence") * 100).cast("bigint").alias("confidence_percent"))


# ---- retrieval and sampling ---------------------------------------------------------------

_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"


@query(
    "rag_topk",
    f"""WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
d AS (SELECT query_id, label, vec_id, 1 - {_DOT.format(a='q.e', b='x.embedding')} / (sqrt({_DOT.format(a='q.e', b='q.e')}) * sqrt({_DOT.format(a='x.embedding', b='x.embedding')})) AS dist FROM q, embeddings x)
SELECT query_id, label, vec_id, CAST(row_number() OVER (PARTITION BY query_id, label ORDER BY dist, vec_id) AS INT) AS rank FROM d QUALIFY rank <= 2""",
)
def rag_topk(spark, d):
    """Every row whose id is divisible by 20 is a query."""
    index = table(spark, d, "embeddings")
    return retrieve.nearest_of_all(spread(index), index.where("vec_id % 20 = 0"), per_label=2)


@query(
    "ivf_topk",
    """WITH rows AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
centres AS (SELECT row_number() OVER (ORDER BY vec_id) AS list, v AS c FROM rows WHERE vec_id % 25 = 3),
near AS (SELECT vec_id, list, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(v, c) DESC, list) AS pos FROM rows, centres),
held AS (SELECT list, r.* FROM near JOIN rows r USING (vec_id) WHERE pos = 1),
asked AS (SELECT list, r.vec_id AS query_id, r.v AS q FROM near JOIN rows r USING (vec_id) WHERE pos <= 4 AND vec_id % 20 = 0),
found AS (SELECT query_id, label, vec_id, round(1 - list_cosine_similarity(q, v), 9) AS d FROM asked JOIN held USING (list) WHERE vec_id <> query_id)
SELECT query_id, label, vec_id, CAST(row_number() OVER (PARTITION BY query_id, label ORDER BY d, vec_id) AS INT) AS rank FROM found
QUALIFY row_number() OVER (PARTITION BY query_id, label ORDER BY d, vec_id) <= 2""",
)
def ivf_topk(spark, d):
    """Every twentieth vector against the four nearest lists of an inverted file, re-ranked exactly. The centroids are rows of the table."""
    rows = spread(table(spark, d, "embeddings"))
    chosen = rows.where("vec_id % 25 = 3").select("vec_id", F.col("embedding").cast("array<double>").alias("v")).orderBy("vec_id")
    centroids = textindex.unit_rows(chosen.limit(textindex.LISTS).toArrow().column("v"))
    indexed = textindex.assigned(rows, centroids).withColumn("list", F.get("lists", F.lit(0)))
    found = textindex.search(indexed, centroids, rows.where("vec_id % 20 = 0"), per_label=2, probes=4, key="vec_id")
    return found.select("query_id", "label", "vec_id", "rank")


@query("few_shot_neighbours")
def few_shot_neighbours(spark, d):
    """Few-shot blocks of every twentieth document from its nearest labelled documents, through text vectors and a written index."""
    from tidemark.session import scratch_path

    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    path = scratch_path(spark, "text-index")
    textindex.build_index(textindex.with_vectors(docs.join(labels, "doc_id")), path, "doc_id")
    indexed, centroids = textindex.load_index(spark, path)
    asked = textindex.with_vectors(docs.where("doc_id % 20 = 0"))
    found = textindex.search(indexed, centroids, asked, per_label=3, key="doc_id", label="quality")
    return textindex.few_shot_blocks(found, indexed, "doc_id", positive="1")


@query(
    "systematic_sample",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, greatest(1, count(*) OVER () // 50) AS step FROM documents)
SELECT doc_id FROM n WHERE (rn - 1) % step = 0 AND rn <= step * 50""",
)
def systematic_sample(spark, d):
    return sampling.systematic(table(spark, d, "documents").select("doc_id"), ["doc_id"], 50)


@query(
    "hash_batches",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents)
SELECT doc_id, CAST((rn - 1) // 20 AS INT) AS batch FROM r WHERE rn <= 600""",
)
def hash_batches(spark, d):
    return sampling.hash_batches(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("resume_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, d):
    return sinks.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("sample_semi", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def sample_semi(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_semi")


# ---- evaluation ---------------------------------------------------------------------------

_TOXIC = any_of("lower(text)", SIGNALS)


@query(
    "evaluate_prf",
    f"""WITH c AS (SELECT count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp, count(*) FILTER (WHERE NOT p AND a) AS fn, count(*) FILTER (WHERE NOT p AND NOT a) AS tn
FROM (SELECT {_TOXIC} AS p, toxic = 1 AS a FROM documents JOIN labels USING (doc_id)))
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM c""",
)
def evaluate_prf(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text").join(table(spark, d, "labels"), "doc_id")
    return evaluate.confusion(rows, text.contains_any(F.col("text"), SIGNALS), F.col("toxic") == 1)


@query(
    "group_pass_rate",
    f"""SELECT CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang, count(*) AS n, count(*) FILTER (WHERE {_TOXIC}) AS passed, round(count(*) FILTER (WHERE {_TOXIC}) / count(*), 4) AS pass_rate FROM documents GROUP BY ROLLUP (lang)""",
)
def group_pass_rate(spark, d):
    return evaluate.group_rates(table(spark, d, "documents").select("lang", "text"), text.contains_any(F.col("text"), SIGNALS), "lang")


@query("corpus_stats", "SELECT count(*) AS messages, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at, count(DISTINCT user_id) AS users FROM events")
def corpus_stats(spark, d):
    made = evaluate.corpus_stats(table(spark, d, "events"), "ts", "user_id")
    return made.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_at", "last_at")})


_VERDICT = "CASE WHEN quality = 1 AND toxic = 0 THEN 'REAL_LEAD' WHEN quality = 0 THEN 'MISTAKE' ELSE 'REVIEW' END"


@query(
    "verdict_summary",
    f"""WITH v AS (SELECT {_VERDICT} AS v FROM labels)
SELECT count(*) FILTER (WHERE v = 'REAL_LEAD') AS real, count(*) FILTER (WHERE v = 'MISTAKE') AS mistake, count(*) FILTER (WHERE v = 'REVIEW') AS review,
round(coalesce(count(*) FILTER (WHERE v = 'REAL_LEAD') / nullif(count(*) FILTER (WHERE v <> 'REVIEW'), 0), 0), 4) AS implied_precision FROM v""",
)
def verdict_summary(spark, d):
    return evaluate.verdict_summary(table(spark, d, "labels").withColumn("verdict", F.expr(_VERDICT)))


@query(
    "usage_rollup",
    """SELECT CASE WHEN grouping(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS stage, count(*) AS calls, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS units,
CAST(sum(CAST(floor(value * 100) AS BIGINT) * CASE WHEN user_id % 3 = 0 THEN 2 WHEN user_id % 3 = 1 THEN 5 ELSE 0 END) AS BIGINT) AS cost FROM events GROUP BY ROLLUP (event_type)""",
)
def usage_rollup(spark, d):
    calls = table(spark, d, "events").select("event_type", F.floor(F.col("value") * 100).alias("units"), (F.col("user_id") % 3).alias("model"))
    prices = spark.createDataFrame([(0, 2), (1, 5)], "model bigint, price bigint")
    made = evaluate.usage(calls, "event_type", "units", prices)
    return made.withColumn("cost", F.col("cost").cast("bigint"))


@query("top_items", "SELECT item, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS item FROM part) GROUP BY item ORDER BY n DESC, item LIMIT 5")
def top_items(spark, d):
    return evaluate.top_items(table(spark, d, "part"), F.split("p_type", " "))


# ---- model outputs ------------------------------------------------------------------------

_PANEL = """panel AS (SELECT user_id, event_id % 3 AS model, event_type = 'purchase' OR value > 60 AS is_lead, CASE WHEN event_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status, event_id FROM events)"""


@query(
    "fusion_vote",
    f"""WITH {_PANEL}, v AS (SELECT user_id, count(*) FILTER (WHERE status = 'ok' AND is_lead IS NOT NULL) AS valid, count(*) FILTER (WHERE status = 'ok' AND is_lead) AS leads FROM panel GROUP BY user_id)
SELECT user_id, valid, leads, CASE WHEN valid < 2 THEN 'judge' WHEN leads = 0 THEN 'consensus_not_lead' WHEN leads = valid THEN 'consensus_lead' ELSE 'judge' END AS outcome FROM v""",
)
def fusion_vote(spark, d):
    panel = table(spark, d, "events").select("user_id", ((F.col("event_type") == "purchase") | (F.col("value") > 60)).alias("is_lead"), F.when(F.col("event_id") % 11 == 0, "error").otherwise("ok").alias("status"))
    return pipelines.panel_vote(panel, "user_id", judge_consensus_lead=False)


@query(
    "fusion_merge",
    """WITH p AS (SELECT conv_id, turn, role, CASE WHEN turn % 4 = 3 THEN 'error' ELSE 'ok' END AS status, turn + 0.5 AS confidence FROM conversations),
u AS (SELECT conv_id, turn, role, unnest([role, 'g' || turn % 2]) AS g, unnest([0, 1]) AS sub FROM p WHERE status = 'ok'),
f AS (SELECT conv_id, g, min((turn, role, sub)) AS pos FROM u GROUP BY conv_id, g)
SELECT conv_id, geo, rationale, confidence FROM
(SELECT conv_id, string_agg(g, ',' ORDER BY pos) AS geo FROM f GROUP BY conv_id) JOIN
(SELECT conv_id, string_agg(turn || '.5 (' || role || '): r', ' | ' ORDER BY turn, role) AS rationale, round(avg(confidence), 3) AS confidence FROM p WHERE status = 'ok' GROUP BY conv_id) USING (conv_id)""",
)
def fusion_merge(spark, d):
    turns = table(spark, d, "conversations")
    panel = turns.select(
        "conv_id", F.col("turn").alias("position"), F.col("role").alias("model"), F.when(F.col("turn") % 4 == 3, "error").otherwise("ok").alias("status"),
        (F.col("turn") + 0.5).cast("double").alias("confidence"), F.array("role", F.concat(F.lit("g"), (F.col("turn") % 2).cast("string"))).alias("geo"), F.lit(" r ").alias("rationale"),
    )
    return pipelines.panel_merge(panel, "conv_id").withColumn("geo", F.array_join("geo", ","))


_SEEN = """m AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'card_seeker' WHEN 1 THEN 'card_provider' END AS lt, CASE event_id % 4 WHEN 0 THEN 'REAL_CARD_SEEKER' WHEN 1 THEN 'REAL_CARD_PROVIDER' WHEN 2 THEN 'MISTAKE' END AS v, event_type AS notes FROM events)"""


@query(
    "verdict_alignment",
    f"""WITH {_SEEN}, a AS (SELECT *, coalesce((lt = 'card_seeker' AND v = 'REAL_CARD_SEEKER') OR (lt = 'card_provider' AND v = 'REAL_CARD_PROVIDER'), false) AS ok FROM m)
SELECT event_id, ok AS is_lead, CASE WHEN ok THEN v ELSE 'MISTAKE' END AS verdict, CASE WHEN ok THEN notes ELSE '[type_mismatch: stage3=' || coalesce(lt, 'None') || ', stage4=' || coalesce(v, 'None') || '] ' || coalesce(notes, '') END AS notes FROM a""",
)
def verdict_alignment(spark, d):
    e = F.col("event_id")
    kind = F.when(e % 3 == 0, "card_seeker").when(e % 3 == 1, "card_provider")
    said = F.when(e % 4 == 0, "REAL_CARD_SEEKER").when(e % 4 == 1, "REAL_CARD_PROVIDER").when(e % 4 == 2, "MISTAKE")
    made = pipelines.align(kind, said, F.col("event_type"), {"card_seeker": "REAL_CARD_SEEKER", "card_provider": "REAL_CARD_PROVIDER"})
    return table(spark, d, "events").select("event_id", made.alias("a")).select("event_id", "a.*")


@query(
    "resolver_table",
    """WITH m AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'seeking_traffic' ELSE 'traffic_provider' END AS lt, CASE event_id % 3 WHEN 0 THEN 'lead' WHEN 1 THEN 'not_lead' ELSE 'uncertain' END AS label,
CASE event_id % 5 WHEN 0 THEN 'buyer' WHEN 1 THEN 'seller' ELSE 'both' END AS role, CASE WHEN event_id % 7 < 3 THEN 'survey_question' ELSE 'odd' END AS reason, event_id % 13 = 0 AS failed FROM events),
k AS (SELECT *, CASE role WHEN 'buyer' THEN 'seeking_traffic' WHEN 'seller' THEN 'traffic_provider' END AS mapped FROM m),
t AS (SELECT *, CASE WHEN failed OR label = 'not_lead' THEN lt ELSE coalesce(mapped, lt) END AS kind, NOT failed AND label = 'not_lead' AS dropped, NOT failed AND label = 'lead' AND mapped IS NOT NULL AS certain FROM k)
SELECT event_id, NOT dropped AS is_lead, kind AS lead_type, CASE WHEN dropped THEN 'MISTAKE' WHEN kind = 'seeking_traffic' THEN 'REAL_SEEKER' ELSE 'REAL_PROVIDER' END AS verdict,
CASE WHEN dropped THEN NULL WHEN certain THEN 'CERTAIN' ELSE 'UNCERTAIN' END AS certainty,
CASE WHEN dropped OR certain THEN NULL WHEN failed THEN 'gate_api_error' WHEN mapped IS NULL THEN 'role_unclear' WHEN reason = 'survey_question' THEN reason ELSE 'other' END AS reason FROM t""",
)
def resolver_table(spark, d):
    e = F.col("event_id")
    made = pipelines.resolve_mismatch(
        F.when(e % 2 == 0, "seeking_traffic").otherwise("traffic_provider"),
        F.when(e % 3 == 0, "lead").when(e % 3 == 1, "not_lead").otherwise("uncertain"),
        F.when(e % 5 == 0, "buyer").when(e % 5 == 1, "seller").otherwise("both"),
        F.when(e % 7 < 3, "survey_question").otherwise("odd"),
        e % 13 == 0,
        {"buyer": "seeking_traffic", "seller": "traffic_provider"},
        {"seeking_traffic": "REAL_SEEKER", "traffic_provider": "REAL_PROVIDER"},
        ("survey_question",),
    )
    return table(spark, d, "events").select("event_id", made.alias("a")).select("event_id", "a.*")


@query(
    "certainty_gate",
    """WITH m AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'MISTAKE' ELSE 'REAL_LEAD' END AS v, CASE event_id % 4 WHEN 0 THEN ' uncertain ' WHEN 1 THEN 'CERTAIN' WHEN 2 THEN 'maybe' END AS said, CASE WHEN event_id % 5 = 0 THEN 'survey_question' WHEN event_id % 5 = 1 THEN 'x' END AS r FROM events)
SELECT event_id, CASE WHEN v = 'REAL_LEAD' THEN CASE WHEN upper(trim(coalesce(said, 'CERTAIN'))) = 'UNCERTAIN' THEN 'UNCERTAIN' ELSE 'CERTAIN' END END AS certainty,
CASE WHEN v = 'REAL_LEAD' THEN CASE WHEN upper(trim(coalesce(said, 'CERTAIN'))) = 'UNCERTAIN' THEN CASE WHEN r = 'survey_question' THEN r ELSE 'no_explicit_payment_term' END ELSE CASE WHEN r = 'survey_question' THEN r END END END AS reason FROM m""",
)
def certainty_gate(spark, d):
    e = F.col("event_id")
    made = pipelines.certainty(
        F.when(e % 3 == 0, "MISTAKE").otherwise("REAL_LEAD"),
        F.when(e % 4 == 0, " uncertain ").when(e % 4 == 1, "CERTAIN").when(e % 4 == 2, "maybe"),
        F.when(e % 5 == 0, "survey_question").when(e % 5 == 1, "x"),
        ("survey_question",),
    )
    return table(spark, d, "events").select("event_id", made.alias("a")).select("event_id", "a.certainty", "a.reason")


@query(
    "extract_and_judge",
    f"""WITH m AS (SELECT doc_id, text, length({STRIP.format('text')}) < 20 AS short, NOT {any_of('lower(text)', STOP)} AND ({any_of('lower(text)', TERMS[:3])} OR {any_of('lower(text)', SIGNALS)}) AS g FROM documents)
SELECT doc_id, CASE WHEN short THEN 'skip' WHEN NOT g THEN 'prefilter' WHEN doc_id % 5 = 0 THEN 'stage1' WHEN doc_id % 7 = 0 THEN 'error' WHEN doc_id % 2 = 0 THEN 'extracted' ELSE 'not_lead' END AS stage,
CASE WHEN NOT short AND g AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 2 = 0 THEN CASE doc_id % 3 WHEN 0 THEN 'REAL_LEAD' WHEN 1 THEN 'MISTAKE' ELSE 'REVIEW' END END AS verdict FROM m""",
)
def extract_and_judge(spark, d):
    k = F.col("doc_id")
    scorer = scoring.RuleScorer(
        {
            "stage1": F.when(k % 5 == 0, "No.").when(k % 5 == 1, "UNKNOWN").otherwise("YES"),
            "extract": F.when(k % 7 == 0, "sorry {").otherwise(F.concat(F.lit('```json\n{"is_lead": '), (k % 2 == 0).cast("string"), F.lit(', "confidence": "1.7", "lead_type": "x"}\n``` done'))),
            "judge": F.when(k % 3 == 0, '{"verdict": " real_lead "}').when(k % 3 == 1, '[{"verdict": "MISTAKE"}]').otherwise("{}"),
        }
    )
    rows = pipelines.extract(spread(table(spark, d, "documents").select("doc_id", "text")), PACK, scorer)
    return pipelines.judge(rows, scorer).select("doc_id", "stage", "verdict")


# ---- normalisation ------------------------------------------------------------------------


@query(
    "vertical_normalize",
    """WITH l AS (SELECT p_partkey, list_transform([p_type, CASE p_partkey % 6 WHEN 0 THEN ' Poker ' WHEN 1 THEN 'CASINO' WHEN 2 THEN 'web3' WHEN 3 THEN '  ' WHEN 4 THEN 'SaaS' ELSE 'slots' END, 'casino'], lambda x: lower(trim(x))) AS l FROM part),
m AS (SELECT p_partkey, list_transform(list_filter(l, lambda x: x <> ''), lambda x: CASE WHEN x IN ('casino') THEN 'casino' WHEN x IN ('poker', 'slots') THEN 'casino' WHEN x = 'web3' THEN 'crypto' WHEN x = 'saas' THEN 'subscription' ELSE 'other' END) AS l FROM l)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS verticals FROM m""",
)
def vertical_normalize(spark, d):
    k = F.col("p_partkey") % 6
    other = F.when(k == 0, " Poker ").when(k == 1, "CASINO").when(k == 2, "web3").when(k == 3, "  ").when(k == 4, "SaaS").otherwise("slots")
    made = normalise.normalise_verticals(F.array("p_type", other, F.lit("casino")))
    return table(spark, d, "part").select("p_partkey", F.array_join(made, ",").alias("verticals"))


@query(
    "traffic_type_collapse",
    """WITH m AS (SELECT event_id, list_filter(['Live_Traffic ', 'database', 'INFRA', 'unclear', 'none', 'bogus'], lambda x, i: (event_id >> (i - 1)) & 1 = 1) AS l FROM events),
n AS (SELECT event_id, list_filter(list_transform(l, lambda x: lower(trim(x))), lambda x: x <> 'bogus') AS l FROM m)
SELECT event_id, CASE WHEN len(l) = 0 THEN NULL WHEN list_contains(l, 'none') THEN 'none' WHEN l = ['unclear'] THEN 'unclear' WHEN list_contains(l, 'live_traffic') THEN 'live_traffic' WHEN list_contains(l, 'database') THEN 'database' ELSE 'infra' END AS traffic_type FROM n""",
)
def traffic_type_collapse(spark, d):
    names = ("Live_Traffic ", "database", "INFRA", "unclear", "none", "bogus")
    bits = [F.when(F.shiftright("event_id", i).bitwiseAND(F.lit(1)) == 1, F.lit(n)) for i, n in enumerate(names)]
    types = normalise.normalise_traffic_types(F.filter(F.array(*bits), lambda x: x.isNotNull()))
    return table(spark, d, "events").select("event_id", normalise.collapse_traffic_type(types).alias("traffic_type"))


def _places(spark, d):
    c = table(spark, d, "customer")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    # every customer names its nation, a region and an unknown place, as raw text
    named = c.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("c_custkey") % 5 == F.col("r_regionkey"))
    raw = named.select("c_custkey", F.array(F.concat(F.lit(" "), F.lower("r_name")), F.initcap("n_name"), F.lit("Atlantis"), F.lit(" ")).alias("places"))
    mapping = nation.select(F.col("n_name").alias("raw_value"), F.col("n_name").alias("normalized")).unionByName(region.select(F.col("r_name").alias("raw_value"), F.col("r_name").alias("normalized")))
    expansion = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    return raw, mapping, expansion


@query(
    "geo_normalize_expand",
    """WITH kids AS (SELECT r_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS kids FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey)
SELECT c_custkey, r_name || ',' || kids || ',' || n_name AS geo FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON c_custkey % 5 = r_regionkey JOIN kids USING (r_regionkey)""",
)
def geo_normalize_expand(spark, d):
    made, _ = geo.expand_geo(*_places(spark, d), "c_custkey", "places")
    return made.select("c_custkey", F.array_join("geo", ",").alias("geo"))


@query("geo_unknown_log", "SELECT c_custkey AS id, 'Atlantis' AS raw FROM customer")
def geo_unknown_log(spark, d):
    return geo.expand_geo(*_places(spark, d), "c_custkey", "places")[1]


@query(
    "payment_geo",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'bkash,upi' WHEN 1 THEN 'upi' ELSE 'card,bkash' END AS tokens, CASE o_orderkey % 3 WHEN 0 THEN 'IN,BD' WHEN 1 THEN 'IN' ELSE 'IN,BD' END AS geo FROM orders""",
)
def payment_geo(spark, d):
    k = F.col("o_orderkey") % 3
    said = F.when(k == 0, F.array(F.lit("BKash "), F.lit("unified"), F.lit("upi"))).when(k == 1, F.array(F.lit("nothing"), F.lit("UPI"))).otherwise(F.array(F.lit("visa"), F.lit("b-kash")))
    rows = table(spark, d, "orders").select("o_orderkey", said.alias("methods"))
    options = spark.createDataFrame([("bkash", ["b-kash"]), ("upi", ["unified"]), ("card", ["visa", "unified pay"])], "token string, aliases array<string>")
    countries = spark.createDataFrame([("bkash", ["BD", "IN"]), ("upi", ["IN"])], "token string, countries array<string>")
    tokens, _ = geo.payment_tokens(rows, options, "o_orderkey", "methods")
    base = rows.select("o_orderkey", F.array(F.lit("IN")).alias("geo"))
    made = geo.append_implied(base, tokens, countries, "o_orderkey").join(tokens, "o_orderkey")
    return made.select("o_orderkey", F.array_join("tokens", ",").alias("tokens"), F.array_join("geo", ",").alias("geo"))


_NORM = "trim(regexp_replace(lower({}), '[^a-zA-Z0-9Ѐ-ӿ]+', ' ', 'g'), ' ')"


@query(
    "quote_support",
    f"""WITH q AS (SELECT item_id, {_NORM.format('text')} AS q FROM benchmark), t AS (SELECT doc_id, {_NORM.format('text')} AS t FROM documents)
SELECT doc_id, item_id, contains(t, q) OR (length(q) >= 25 AND len(list_filter(range(1, length(q) - 23), lambda i: contains(t, substr(q, i, 25)))) > 0) AS supported FROM t, q""",
)
def quote_support(spark, d):
    """Every document against every benchmark item."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return quotes.supported(docs, table(spark, d, "benchmark"))


@query("truncate_ellipsis", "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 197) || '...' ELSE text END AS short FROM documents")
def truncate_ellipsis(spark, d):
    return table(spark, d, "documents").select("doc_id", text.truncated(F.col("text"), 200).alias("short"))


@query(
    "ready_notes_format",
    """SELECT doc_id, '[confidence: ' || CASE doc_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END || ' | ' || CASE WHEN doc_id % 2 = 0 THEN 'warmth' ELSE 'overlap' END || '] "' || lang || '" — ' || source AS notes,
CASE doc_id % 3 WHEN 0 THEN 0.9 WHEN 1 THEN 0.6 ELSE 0.3 END::DOUBLE AS confidence FROM documents""",
)
def ready_notes_format(spark, d):
    k = F.col("doc_id")
    label = F.when(k % 3 == 0, "high").when(k % 3 == 1, "medium")
    kind = F.when(k % 2 == 0, "card_seeker").otherwise("card_provider")
    return table(spark, d, "documents").select("doc_id", sinks.ready_notes(label, kind, F.col("lang"), F.col("source")).alias("notes"), text.label_confidence(label).alias("confidence"))


@query(
    "group_prior_block",
    """WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT user_id, sum(n) AS total FROM n GROUP BY user_id)
SELECT user_id, CAST(coalesce(sum(n) FILTER (WHERE event_type IN ('click', 'view')), 0) * 1000 // any_value(total) AS BIGINT) AS share_milli FROM n JOIN t USING (user_id) GROUP BY user_id HAVING any_value(total) >= 5""",
)
def group_prior_block(spark, d):
    counts = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("user_id").agg(F.sum("n").alias("total_n"), F.map_from_entries(F.collect_list(F.struct("event_type", F.col("n").cast("double")))).alias("distribution"))
    priors = totals.select(F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("group"), "distribution", "total_n", F.when(F.col("total_n") >= 5, "high").otherwise("low").alias("confidence"))
    users = counts.select("user_id").distinct()
    names = users.select(F.col("user_id").alias("group_id"), F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("name"))
    made = context.group_prior(users, names, priors, "user_id").where("total_n is not null")
    return made.select("user_id", F.floor(context.prior_share(F.col("distribution"), ("click", "view")) * 1000 / F.col("total_n")).cast("bigint").alias("share_milli"))


# ---- sinks and routing --------------------------------------------------------------------


@query(
    "upsert_latest_wins",
    """WITH r AS (SELECT *, CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS u FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY u, event_type ORDER BY event_id % 2, event_id DESC) AS rn FROM r)
SELECT u, event_type, event_id FROM k WHERE rn = 1 OR u IS NULL""",
)
def upsert_latest_wins(spark, d):
    rows = table(spark, d, "events").select(F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("u"), "event_type", "event_id")
    return sinks.upsert(rows.where("event_id % 2 = 1"), rows.where("event_id % 2 = 0"), ["u", "event_type"], ["event_id"])


@query("insert_if_absent", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def insert_if_absent(spark, d):
    known = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.insert_if_absent(known, table(spark, d, "customer").select("c_custkey"), ["c_custkey"])


@query(
    "notify_routes",
    """WITH n AS (SELECT o_orderkey, o_orderstatus AS new, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN o_orderstatus ELSE 'P' END AS old, o_orderkey % 4 <> 0 AS had, o_orderpriority AS p FROM orders),
k AS (SELECT *, CASE WHEN NOT had THEN 'insert' WHEN new IS DISTINCT FROM old THEN 'update' END AS kind FROM n)
SELECT o_orderkey, 'open' AS channel, kind FROM k WHERE kind IS NOT NULL AND new = 'O' UNION ALL SELECT o_orderkey, 'urgent', kind FROM k WHERE kind IS NOT NULL AND p = '1-URGENT'""",
)
def notify_routes(spark, d):
    new = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    old = new.where("o_orderkey % 4 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 1, F.col("o_orderstatus")).otherwise("P"))
    return route.notifications(new, old, "o_orderkey", {"open": F.col("o_orderstatus") == "O", "urgent": F.col("o_orderpriority") == "1-URGENT"}, ["o_orderstatus"])


@query(
    "work_queues",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 3 = 0 THEN 'pending' END, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 THEN 'approved_unsent' END,
CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN 'in_review' END, CASE WHEN o_orderkey % 5 = 0 THEN 'sent' END) AS queues FROM orders""",
)
def work_queues(spark, d):
    k = F.col("o_orderkey")
    made = route.work_queues(table(spark, d, "orders"), F.when(k % 3 != 0, k), F.col("o_orderstatus") == "F", F.when(k % 5 == 0, k))
    return made.select("o_orderkey", F.array_join("queues", ",").alias("queues"))


@query("truth_labels", "SELECT doc_id AS message_id, quality = 1 AS is_lead FROM labels")
def truth_labels(spark, d):
    said = F.when(F.col("quality") == 1, F.when(F.col("doc_id") % 2 == 0, " YES ").otherwise("lead")).otherwise("0")
    return readers.truth_of(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), said.alias("label")))


@query(
    "glossary_terms",
    """SELECT DISTINCT t AS term FROM (SELECT unnest([lower(trim(p_name)), lower(p_brand)]) AS t FROM part WHERE p_size >= 25) WHERE t NOT IN ('brand#11')""",
)
def glossary_terms(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("term"), F.array("p_brand").alias("surface_forms"), F.lit(True).alias("relevant"), (F.col("p_size") / 50.0).alias("confidence"))
    return readers.glossary_terms(rows.where("false"), rows, 0.5, ("brand#11",))


@query(
    "outcome_selection",
    """WITH m AS (SELECT doc_id, quality = 1 AS lead, CASE doc_id % 3 WHEN 0 THEN 'REAL_LEAD' WHEN 1 THEN 'REVIEW' ELSE 'MISTAKE' END AS v FROM labels)
SELECT doc_id, CASE WHEN lead AND v IN ('REAL_LEAD', 'REVIEW') THEN 'confirmed' WHEN v = 'MISTAKE' THEN 'judged_out' ELSE 'rejected' END AS outcome FROM m""",
)
def outcome_selection(spark, d):
    said = F.when(F.col("doc_id") % 3 == 0, "REAL_LEAD").when(F.col("doc_id") % 3 == 1, "REVIEW").otherwise("MISTAKE")
    return table(spark, d, "labels").select("doc_id", outcomes.outcome(said, F.col("quality") == 1).alias("outcome"))


@query(
    "judged_default_review",
    "SELECT d.doc_id, coalesce(l.v, 'REVIEW') AS verdict FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN max(quality) = 1 THEN 'REAL_LEAD' ELSE 'MISTAKE' END AS v FROM labels GROUP BY doc_id) l USING (doc_id)",
)
def judged_default_review(spark, d):
    said = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "REAL_LEAD").otherwise("MISTAKE").alias("verdict"), F.col("quality").alias("judged_at"))
    leads = table(spark, d, "documents").select("doc_id", F.lit("x").alias("verdict"))
    return outcomes.judged(leads, said, "doc_id").select("doc_id", "verdict")


@query(
    "retry_union",
    """SELECT doc_id AS message_id, CASE WHEN doc_id % 4 = 0 THEN 'fixed' WHEN doc_id % 2 = 0 THEN '[llm] extraction failed: x' ELSE 'fine' END AS rationale FROM labels""",
)
def retry_union(spark, d):
    first = table(spark, d, "labels").select(F.col("doc_id").alias("message_id"), F.when(F.col("doc_id") % 2 == 0, "[llm] extraction failed: x").otherwise("fine").alias("rationale"))
    again = outcomes.to_retry(first).where("message_id % 4 = 0").withColumn("rationale", F.lit("fixed"))
    return outcomes.with_retries(first, again)


@query(
    "glossary_summary",
    """SELECT count(*) AS total, count(*) FILTER (WHERE p_size > 5) AS relevant, count(*) FILTER (WHERE p_size > 5 AND p_size / 50.0 >= 0.8) AS high_confidence,
round(avg(p_size / 50.0), 4) AS avg_confidence, min(p_size / 50.0) AS min_confidence FROM part""",
)
def glossary_summary(spark, d):
    rows = table(spark, d, "part").select((F.col("p_size") > 5).alias("relevant"), (F.col("p_size") / F.lit(50.0)).cast("double").alias("confidence"))
    return outcomes.confidence_summary(rows)


@query(
    "duplicate_leads",
    f"""WITH m AS (SELECT doc_id, lang, length({STRIP.format('text')}) > 100 AS long, {HASHED} AS h FROM documents),
f AS (SELECT *, min(doc_id) FILTER (WHERE long) OVER (PARTITION BY lang, h) AS first FROM m)
SELECT doc_id, CASE WHEN long AND first < doc_id THEN 'MISTAKE' ELSE 'REAL' END AS verdict FROM f""",
)
def duplicate_leads(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), "text", F.col("lang").alias("lead_type"), F.lit(True).alias("is_lead"), F.lit("REAL").alias("verdict"))
    return jobs.cross_user_duplicates(rows).select(F.col("message_id").alias("doc_id"), "verdict")


@query("glossary_dry_run")
def glossary_dry_run(spark, d):
    """All deterministic candidate pools over the documents, clustered."""
    rows = spread(table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), "text"))
    plan = jobs.GlossaryPlan(gazetteer=GAZETTEER, brand_patterns=BRANDS)
    return jobs.build_glossary(rows, plan).withColumn("surface_forms", F.array_join("surface_forms", ","))


JOB_PHRASES = ("of the", "de la", "der ein")


@query(
    "glossary_build",
    f"""WITH {UNITS},
hits AS (SELECT doc_id, unnest(list_filter({listed(JOB_PHRASES)}, lambda p: contains(lower(text), p))) AS phrase FROM documents),
pool AS (SELECT term, kind, frequency FROM terms UNION ALL SELECT phrase, 'phrase_en', count(*) FROM hits GROUP BY phrase),
clustered AS (SELECT arg_max(term, (frequency, term)) AS term, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'phrase' END AS kind, CAST(sum(frequency) AS BIGINT) AS f FROM pool GROUP BY lower(term)),
top AS (SELECT * FROM clustered ORDER BY f DESC, term LIMIT 200),
draft AS (SELECT *, f % 3 <> 0 AS rel, (3 + f % 7) / 10.0 AS conf FROM top),
res AS (SELECT *, rel AND conf <= 0.5 AND f % 2 = 0 AS taken FROM draft),
crit AS (SELECT *, CASE WHEN taken THEN 0.7 ELSE conf END AS c1, rel AND f % 11 = 0 AS noise, f % 5 = 0 AS missing FROM res),
pen AS (SELECT *, rel AND NOT noise AS rel2, CASE WHEN noise THEN least(c1, 0.3) WHEN rel AND f % 4 = 1 THEN greatest(0.0, c1 - 0.2) WHEN rel AND f % 4 = 2 THEN greatest(0.0, c1 - 0.1) ELSE c1 END AS c2 FROM crit),
enr AS (SELECT *, rel2 AND missing AS more FROM pen)
SELECT term, kind, f AS frequency, rel2 AS relevant, CAST(round(CASE WHEN more THEN least(1.0, c2 + 0.1) ELSE c2 END * 1000) AS BIGINT) AS confidence_milli,
CASE WHEN more AND f % 2 = 1 THEN 'extra' || term WHEN more THEN CASE WHEN taken THEN 'web' ELSE 'about' END || term || '|extra' || term WHEN taken THEN 'web' || term ELSE 'about' || term END AS senses,
CASE WHEN taken THEN 'research' ELSE 'inference' END || CASE WHEN more AND f % 2 = 0 THEN '+enrichment' ELSE '' END AS source_stage FROM enr""",
)
def glossary_build(spark, d):
    """The whole glossary job over the documents, with rules in place of the model."""
    rows = spread(table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), "text"))
    f = F.col("frequency")

    def reply(**fields):
        return F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]))

    def sense(word, n):
        return F.array(F.struct(F.concat(F.lit(word), "term").alias("definition"), F.array(F.lit(n)).alias("example_message_ids")))

    gaps = F.when(f % 5 == 0, F.array(F.struct(F.lit("another use").alias("description")))).otherwise(F.array().cast("array<struct<description:string>>"))
    rules = {
        "phrases": F.lit('{"phrases": ["' + '", "'.join(JOB_PHRASES) + '"]}'),
        "inference": reply(relevant=f % 3 != 0, confidence=(3 + f % 7) / F.lit(10.0), senses=sense("about", 1)),
        "research": F.when(f % 2 == 0, reply(accept_web_info=F.lit(True), definition=F.concat(F.lit("web"), "term"), confidence=F.lit(0.7))),
        "validation": reply(issue_severity=F.when(f % 4 == 1, "major").when(f % 4 == 2, "minor").otherwise("none"), wrongly_admitted_noise=f % 11 == 0, missing_senses=gaps),
        "enrichment": reply(new_senses=sense("extra", 2)),
        "paraphrase": F.when(f % 2 == 1, F.lit('{"kept_sense_indices": [1]}')).otherwise(F.lit('{"kept_sense_indices": [0, 1]}')),
    }
    made = jobs.build_glossary(rows, jobs.GlossaryPlan(), scoring.RuleScorer(rules))
    senses = F.array_join(F.transform("senses", lambda s: s["definition"]), "|").alias("senses")
    return made.select("term", "kind", "frequency", "relevant", F.round(F.col("confidence") * 1000).cast("bigint").alias("confidence_milli"), senses, "source_stage")


from tidemark.plans import decisions  # noqa: E402, F401 - registers its queries too
