"""Prefix trie of conversations: mergeable partial tries, hash-keyed tree merges, rollup.

1. Every turn becomes a slim row: a 128-bit digest of role and text, and the text's words.
   Texts move no further.
2. Turns are dealt by ranges of (conversation, turn) into parts of about ``CHUNK_ROWS`` rows,
   so a conversation that holds a third of all turns is many parts. A turn's depth is its
   place within its part plus the sizes of the parts before it.
3. A prefix is named by the exclusive or of its turns' digests, each salted by its depth. That
   name is a running value within a part, started from the parts before it, and the parent's
   name is the own one without the last turn.
4. Each task combines its prefixes into a local node table (members summed, smallest member,
   ends listed by segments of 1,024 neighbouring conversation ids) and emits it whenever it
   holds ``LOCAL_ROWS`` rows. Partial tables meet in rounds: ``FAN_IN`` tasks' tables merge by
   node hash, then ``FAN_IN`` of those, until one is left. A list of ends is never whole in
   one row: a segment holds 1,024 ids at most.
5. The rollup goes up from the leaves by pointer doubling: in round k each node hands the sums
   over the 2^k levels below it to its 2^k-th ancestor, so a chain of 20,000 turns takes 15
   rounds. Contributions to one ancestor are summed before they move.
6. The hash of a node's end list is taken in one stream over its segments in order, which
   SHA-256 demands; memory is one batch.

Edge cases: null roles and texts are empty; a null turn comes first, ties of a turn are in the
order of their digests, repeated rows are repeated turns; rows without a conversation take no
part; negative ids sort as numbers; an empty table has no nodes, not even a root; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches, fold
from tidemark.llm.temperature_mix import token_count
from tidemark.session import cut, table

CHUNK_ROWS = 100_000
LOCAL_ROWS = 50_000
FAN_IN = 16
SEGMENT_BITS = 10
#: The query's rebuilding: of every block of so many ids the first lends up to ``MOST - 1`` turns.
BLOCK, MOST = 20, 4
_NODE = ["x", "y"]
_ABOUT = ["px", "py", "depth", "words", "a", "b"]
_PARTIAL = "x bigint, y bigint, px bigint, py bigint, depth bigint, words bigint, a bigint, b bigint, seg bigint, least bigint, n bigint, ids array<bigint>, part bigint"


def _digests(role: Column, text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(11), role, text).alias("a"), F.xxhash64(F.lit(12), text, role).alias("b")]


def slim_turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turn, a, b, words): all that the trie needs of a turn."""
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = conversations.where(F.col(key).isNotNull())
    return rows.select(F.col(key).cast("bigint").alias("c"), F.col(turn).alias("turn"), *_digests(who, said), token_count(said).alias("words"))


def placed_turns(slim: DataFrame, lend: tuple[int, int] | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(c, part, depth, a, b, words, x, y, size): every turn of every conversation at its depth, and a root row at depth 0.

    With ``lend`` = (block, most), a conversation's first h turns are replaced by those of the
    first conversation of its block of ids, h being the id's crc32 modulo ``most``.
    """
    rows = slim.withColumn("row", F.monotonically_increasing_id())  # tells repeated rows apart; the input is written, so it is stable
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("row")]
    parts = max(1, math.ceil(slim.count() / chunk_rows))
    dealt = cut(rows.repartitionByRange(parts, F.col("c"), *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    numbered = dealt.withColumn("at", F.row_number().over(Window.partitionBy("c", "part").orderBy(*order)))
    sizes = dealt.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy("c").orderBy("part")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = sizes.select("c", "part", before.alias("before"), F.sum("n").over(Window.partitionBy("c")).alias("total"))
    if lend is None:
        empty = F.array().cast("array<struct<r:int,a:bigint,b:bigint,words:bigint>>")
        chunks = chunks.withColumn("h", F.lit(0)).withColumn("lent", empty)
    else:
        block, most = lend
        near = numbered.where((F.col("c") % block == 0) & (F.col("at") < most))
        near = near.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("part", "at"))).where(F.col("r") < most)
        first = near.groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("r", "a", "b", "words"))).alias("first"))
        chunks = chunks.withColumn("h", fold("c", most).cast("int")).withColumn("base", F.col("c") - F.col("c") % block)
        chunks = chunks.join(first, "base", "left").withColumn("lent", F.filter("first", lambda t: t["r"] <= F.col("h")))
        chunks = chunks.drop("base", "first").withColumn("lent", F.coalesce("lent", F.array().cast(dict(first.dtypes)["first"])))
    size = (F.size("lent") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("size")
    own = numbered.join(chunks, ["c", "part"]).where(F.col("before") + F.col("at") > F.col("h"))
    own = own.select("c", "part", (F.col("before") + F.col("at") - F.col("h") + F.size("lent")).alias("depth"), "a", "b", "words", size)
    lead = chunks.where("before = 0").select("c", F.lit(-1).alias("part"), size, F.posexplode(F.concat(F.array(F.lit(None)), F.col("lent"))).alias("depth", "t"))
    lead = lead.select("c", "part", F.col("depth").cast("bigint").alias("depth"), "t.a", "t.b", F.coalesce("t.words", F.lit(0)).alias("words"), "size")
    inner = F.col("depth") > 0  # the root has no turn: its name is zero
    names = [F.when(inner, F.xxhash64(F.lit(seed), "depth", one, two)).otherwise(0) for seed, one, two in ((101, "a", "b"), (102, "b", "a"))]
    return own.unionByName(lead).withColumns({"x": names[0], "y": names[1]})


def prefixes(placed: DataFrame) -> DataFrame:
    """(x, y, px, py, depth, words, a, b, c, end): one row per conversation and prefix; ``placed`` is written."""
    sums = placed.groupBy("c", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    started = sums.select("c", "part", *[F.coalesce(F.bit_xor(n).over(before), F.lit(0)).alias(f"s{n}") for n in _NODE])
    inside = Window.partitionBy("c", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = placed.select("*", *[F.bit_xor(n).over(inside).alias(f"r{n}") for n in _NODE]).join(started, ["c", "part"])
    full = {n: F.col(f"r{n}").bitwiseXOR(F.col(f"s{n}")) for n in _NODE}
    above = [full[n].bitwiseXOR(F.col(n)).alias(f"p{n}") for n in _NODE]
    return run.select(*[full[n].alias(n) for n in _NODE], *above, "depth", "words", "a", "b", "c", (F.col("depth") == F.col("size")).alias("end"))


def _local(held: list[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """The node table of some rows, and their ends by segment."""
    rows = pa.Table.from_batches(held)
    nodes = rows.group_by([*_NODE, *_ABOUT]).aggregate([("c", "min"), ("c", "count")])
    ends = rows.filter(rows.column("end")).select([*_NODE, "c"])
    ends = ends.append_column("seg", pc.shift_right(ends.column("c"), SEGMENT_BITS)).group_by([*_NODE, "seg"]).aggregate([("c", "list")])
    kinds = ((nodes, {"least": "c_min", "n": "c_count"}), (ends, {"ids": "c_list"}))
    for made, renamed in kinds:
        columns = {}
        for name in [*_NODE, *_ABOUT, "seg", "least", "n", "ids"]:
            kind = pa.list_(pa.int64()) if name == "ids" else pa.int64()
            held_as = renamed.get(name, name)
            columns[name] = made.column(held_as).cast(kind) if held_as in made.column_names else pa.nulls(made.num_rows, kind)
        columns["part"] = pa.array([part] * made.num_rows, pa.int64())
        yield from pa.table(columns).to_batches(max_chunksize=10_000)


def partial_tries(rows: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The locally combined tables of every task: nodes (``seg`` null) and segments of ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= local_rows:
                yield from _local(held, part)
                held, count = [], 0
        if count:
            yield from _local(held, part)

    return rows.mapInArrow(run, _PARTIAL)


def merged_tries(partials: DataFrame, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends): rounds of merges of ``fan_in`` tables by node, until there is one."""
    nodes = partials.where("seg is null").drop("seg", "ids")
    ends = partials.where("seg is not null").select(*_NODE, "seg", "ids", "part")
    last = partials.agg(F.max("part")).first()[0] or 0
    while True:
        group = F.floor(F.col("part") / fan_in).alias("part")
        same = [F.max(c).alias(c) for c in _ABOUT]
        nodes = cut(nodes.groupBy(*_NODE, group).agg(*same, F.min("least").alias("least"), F.sum("n").alias("n")), "trie-nodes")
        ends = cut(ends.groupBy(*_NODE, "seg", group).agg(F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids")), "trie-ends")
        last //= fan_in
        if not last:
            return nodes.drop("part"), ends.drop("part")


def rolled_up(nodes: DataFrame) -> DataFrame:
    """(x, y, n_children, n_leaves, saved_tokens) of every node, summed bottom-up by pointer doubling; ``nodes`` is written."""
    kids = nodes.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    own = nodes.join(kids, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
    own = cut(own.select(*_NODE, "px", "py", "depth", "n_children", leaf.alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved")), "trie-own")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    given = [own.select(*_NODE, "leaves", "saved", "n_children")]
    senders = own.where("depth > 0").select(*_NODE, "depth", F.col("px").alias("ax"), F.col("py").alias("ay"), "leaves", "saved")
    deepest, step = own.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:
        handed = senders.groupBy(F.col("ax").alias("x"), F.col("ay").alias("y")).agg(*sums)
        handed = cut(handed, "trie-handed")
        given.append(handed.withColumn("n_children", F.lit(0)))
        if (step := step * 2) <= deepest:
            more = handed.select(*_NODE, F.col("leaves").alias("l"), F.col("saved").alias("s"))
            above = senders.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by"))
            later = senders.where(F.col("depth") >= step).join(more, _NODE, "left").join(above, ["ax", "ay"])
            totals = [(F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a) for a, b in (("leaves", "l"), ("saved", "s"))]
            senders = cut(later.select(*_NODE, "depth", F.col("bx").alias("ax"), F.col("by").alias("ay"), *totals), "trie-senders")
    whole = given[0]
    for part in given[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*_NODE).agg(F.max("n_children").cast("bigint").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def end_hashes(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): SHA-256 of each node's end ids, ascending, joined by commas; segments stream in order."""
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").cast("binary")
    chunks = bounded_batches(ends).select(*_NODE, "seg", joined.alias("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for x, y, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if (x, y) == now:
                    state.update(b",")
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (x, y), hashlib.sha256()
                state.update(said)
            yield _hashed(done)
        if now is not None:
            yield _hashed([(*now, state.hexdigest())])

    return chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "seg").mapInArrow(run, "x bigint, y bigint, ends_sha256 string")


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    names = ["x", "y", "ends_sha256"]
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.string() if i == 2 else pa.int64()) for i, n in enumerate(names)})


def prefix_trie(conversations: DataFrame, key: str = "conv_id", lend: tuple[int, int] | None = None, chunk_rows: int = CHUNK_ROWS, local_rows: int = LOCAL_ROWS, fan_in: int = FAN_IN, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends): the trie's nodes with all sums, and the ids that end at each, in segments.

    Nodes have x, y (the name), px, py (the parent's), a, b (digest of the last turn, for
    ``turn_texts``), ``key`` (the smallest member), depth, words of the last text, n_convs,
    n_children, n_leaves and saved_tokens.
    """
    slim = cut(slim_turns(conversations, key, **columns), "trie-slim")
    placed = cut(placed_turns(slim, lend, chunk_rows), "trie-placed")
    partials = cut(partial_tries(prefixes(placed), local_rows), "trie-partials")
    nodes, ends = merged_tries(partials, fan_in)
    whole = nodes.join(rolled_up(nodes), _NODE)
    return whole.withColumnsRenamed({"least": key, "n": "n_convs"}), ends


def turn_texts(nodes: DataFrame, conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Nodes with role and text of their last turn (null at the root); equal turns meet before they are joined."""
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    named = conversations.select(*_digests(who, said), who.alias("role"), said.alias("text"))
    known = named.groupBy("a", "b").agg(F.min_by(F.struct("role", "text"), F.lit(1)).alias("said"))
    return nodes.join(known, ["a", "b"], "left").select(*nodes.columns, "said.role", "said.text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie(table(spark, sf_dir, "conversations"), lend=(BLOCK, MOST))
    nodes = cut(nodes, "trie-whole")
    parents = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.where("depth > 0").join(parents, ["px", "py"])
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    hashed = inner.unionByName(top).join(end_hashes(ends), _NODE, "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return hashed.select("conv_id", "depth", "parent_conv_id", *counts, F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


#: crc32 of a number's digits, bit by bit (reflected polynomial, fixed value).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda s, d: list_reduce(list_concat([xor(s, d)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

ORACLE = f"""
WITH own AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), lent AS (SELECT c, turns, {_CRC.format("c")} % {MOST} AS h FROM own),
rebuilt AS (
  SELECT l.c, list_concat(coalesce(b.turns[1:l.h], []), l.turns[l.h + 1:]) AS path
  FROM lent l LEFT JOIN own b ON b.c = l.c - l.c % {BLOCK}
), rows AS (SELECT c, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT path[1:depth] AS path, depth, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(path) = depth), '') AS ends
  FROM rows GROUP BY ALL
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    CASE WHEN n.depth = 0 THEN 0 ELSE len(list_filter(regexp_split_to_array(n.path[n.depth].text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS words
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT l.*, coalesce(k.n_children, 0) AS n_children FROM linked l LEFT JOIN kids k USING (conv_id, depth)
), below AS (
  SELECT path[1:up] AS path, up AS depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN below USING (path, depth)
"""
