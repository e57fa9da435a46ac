"""Multi-party perspective rotation of dialogues, in DataFrame functions alone.

For every participant the dialogue is rendered once with that speaker as the assistant and
every other speaker as a named user. Training masks follow the perspective: only the
assistant's own words and its end marker count.

A dialogue is one row for each participant. Turns are grouped by conversation once, before
they are multiplied by the participants found in the group, so the shuffle moves each text
once and nothing is joined. Only a conversation of over ``part_turns`` turns, which no task
should gather, is rendered in parts of that many consecutive turns. Its turns are ranked
through a range partitioning, so no task sorts it whole; a later part repeats the dialogue's
first system turn at its head and has a row for each participant who speaks in it. Part 0 of
a dialogue that needs no parts is the dialogue.

``system`` turns are instructions: they are rendered as such in every perspective and their
speaker takes no perspective. Roles and texts can't forge a turn: ``<|`` inside them gets a
backslash, ``<\\|``, and ``<\\|`` another one, so the change can be undone. Mask spans are
character offsets into ``text``, end exclusive.

Edge cases: a null role speaks as ``unknown``; a null text is empty; a null turn number
sorts first; turns with equal numbers follow role, then text; exactly repeated rows count
once; a conversation with system turns alone has no participant and no row; a null
conversation id is one conversation of its own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sampling import numbered
from tidemark.session import cut, dimension, table

SYSTEM = "system"
#: Turns of a dialogue that one task gathers.
PART_TURNS = 4096
END = "<|end|>\n"


def _render(turns: Column, speaker: Column) -> Column:
    """An array of (text, from, to) per turn; from/to bound what is learned, within the segment."""

    def one(turn: Column) -> Column:
        role = turn["role"]
        head = (
            F.when(role == SYSTEM, F.lit("<|system|>\n"))
            .when(role == speaker, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user:"), role, F.lit("|>\n")))
        )
        own = (role == speaker) & (role != SYSTEM)
        body = F.concat(turn["text"], F.lit(END))
        return F.struct(
            F.concat(head, body).alias("text"),
            F.length(head).alias("skip"),
            own.alias("own"),
        )

    return F.transform(turns, one)


def plain(text: Column) -> Column:
    """The text with a backslash more between any ``<`` and ``|``, so that it holds no marker."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def _parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """(c, part, turns): the distinct turns in order, at most ``part_turns`` to a row but for a repeated system turn."""
    turn = F.struct("turn", "role", "text")
    whole = F.array_sort(F.collect_set(turn)).alias("turns")
    long = cut(rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_turns).select(F.col("c").alias("long_c")), "long-dialogues")
    if long.isEmpty():
        return rows.groupBy("c").agg(whole).select("c", F.lit(0).cast("bigint").alias("part"), "turns")
    names = dimension(long)
    same = F.col("c").eqNullSafe(F.col("long_c"))
    short = rows.join(names, same, "left_anti").groupBy("c").agg(whole).select("c", F.lit(0).cast("bigint").alias("part"), "turns")
    ranked = numbered(rows.join(names, same, "left_semi").distinct(), ["c", "turn", "role", "text"])
    first_system = F.min(F.when(F.col("role") == SYSTEM, turn)).alias("head")
    heads = ranked.groupBy(F.col("c").alias("long_c")).agg(F.min("rn").alias("first"), first_system)
    placed = ranked.join(dimension(heads), same).withColumn("part", F.floor((F.col("rn") - F.col("first")) / F.lit(part_turns)))
    cells = placed.groupBy("c", "part").agg(whole, F.min("head").alias("head"))
    known = F.col("head").isNull() | F.array_contains("turns", F.col("head"))
    return short.unionByName(cells.select("c", "part", F.when(known, F.col("turns")).otherwise(F.concat(F.array("head"), "turns")).alias("turns")))


def rotate(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """(conv, speaker, part, n_turns, text, mask, n_learned): one row per participant, and part if there are several.

    ``mask`` lists ``start:end`` spans, comma-joined; ``n_learned`` counts their characters.
    """
    rows = turns.select(
        F.col(conv).alias("c"),
        F.col(turn).cast("bigint").alias("turn"),
        plain(F.coalesce(F.col(role), F.lit("unknown"))).alias("role"),
        plain(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    parts = _parts(rows, part_turns)
    others = F.filter(F.transform("turns", lambda t: t["role"]), lambda r: r != SYSTEM)
    seen = parts.withColumn("speaker", F.explode(F.array_distinct(others)))
    seen = seen.select("c", "part", "speaker", _render(F.col("turns"), F.col("speaker")).alias("lines"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("learned"))

    def step(state: Column, line: Column) -> Column:
        begin, end = state["at"] + line["skip"], state["at"] + F.length(line["text"])
        span = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        return F.struct(
            end.alias("at"),
            F.when(line["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
            (state["learned"] + F.when(line["own"], end - begin).otherwise(F.lit(0))).alias("learned"),
        )

    folded = F.aggregate("lines", start, step)
    return seen.select("c", "part", "speaker", "lines", folded.alias("mask")).select(
        F.col("c").alias(conv),
        "speaker",
        "part",
        F.size("lines").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["text"]), "").alias("text"),
        F.array_join("mask.spans", ",").alias("mask"),
        F.col("mask.learned").cast("bigint").alias("n_learned"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def _plain_sql(column: str) -> str:
    return rf"regexp_replace({column}, '<(\\*)\|', '<\1\\|', 'g')"


#: For dialogues of at most PART_TURNS turns.
ORACLE = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, {_plain_sql("coalesce(role, 'unknown')")} AS role, {_plain_sql("coalesce(text, '')")} AS body
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> '{SYSTEM}'
), heads AS (
  SELECT t.*, s.speaker,
         CASE WHEN t.role = '{SYSTEM}' THEN '<|system|>' WHEN t.role = s.speaker THEN '<|assistant|>'
              ELSE '<|user:' || t.role || '|>' END || chr(10) AS head,
         t.role = s.speaker AS own
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), lines AS (
  SELECT *, head || body || '<|end|>' || chr(10) AS line FROM heads
), placed AS (
  SELECT *, sum(length(line)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, body) AS stop FROM lines
)
SELECT conv_id, speaker, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(line, '' ORDER BY turn NULLS FIRST, role, body) AS text,
       coalesce(string_agg(CASE WHEN own THEN (stop - length(line) + length(head))::BIGINT || ':' || stop::BIGINT END, ',' ORDER BY turn NULLS FIRST, role, body), '') AS mask,
       CAST(sum(CASE WHEN own THEN length(line) - length(head) ELSE 0 END) AS BIGINT) AS n_learned
FROM placed GROUP BY conv_id, speaker"""
