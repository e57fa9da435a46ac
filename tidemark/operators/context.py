"""Conversation context: neighbouring messages, replies and author history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import is_blank
from tidemark.operators.dedup import chunked
from tidemark.operators.sampling import numbered
from tidemark.session import cut


#: Rows of a group that one task may sort, and rows of a chunk of a larger one.
HOT_ROWS, CHUNK_ROWS = 200_000, 10_000


def _neighbours(messages: DataFrame, group: Sequence[str], order: Sequence[str], payload: Column, before: int, after: int, hot_rows: int, chunk_rows: int) -> DataFrame:
    """Adds ``__past`` and ``__ahead``: payloads of the rows before and after in the group, in order.

    Groups are windows. If one has over ``hot_rows`` rows (counted), all rows are numbered
    through a range partitioning instead and cut into chunks of that order, to which the rows
    at the edges of the next chunks are copied; so no task sorts a whole group.
    """
    largest = messages.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= hot_rows:
        frame = Window.partitionBy(*group).orderBy(*order)
        return messages.withColumns({"__past": F.collect_list(payload).over(frame.rowsBetween(-before, -1)), "__ahead": F.collect_list(payload).over(frame.rowsBetween(1, max(1, after)))})
    size = max(chunk_rows, before + after + 1)
    held = numbered(messages.withColumn("__payload", payload), [*group, *order], "__rn").withColumn("__own", F.floor((F.col("__rn") - 1) / F.lit(size)))
    at = (F.col("__rn") - 1) % F.lit(size)
    copies = F.array(F.col("__own"), F.when(at >= size - before, F.col("__own") + 1), F.when(at < after, F.col("__own") - 1))
    dealt = held.withColumn("__chunk", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    frame = Window.partitionBy("__chunk").orderBy("__rn")
    item = F.struct(F.struct(*group).alias("g"), F.col("__payload").alias("p"))

    def same(found: Column) -> Column:
        return F.transform(F.filter(found, lambda x: x["g"].eqNullSafe(F.struct(*group))), lambda x: x["p"])

    made = dealt.withColumns({"__past": F.collect_list(item).over(frame.rowsBetween(-before, -1)), "__ahead": F.collect_list(item).over(frame.rowsBetween(1, max(1, after)))})
    made = made.where(F.col("__chunk") == F.col("__own")).withColumns({"__past": same(F.col("__past")), "__ahead": same(F.col("__ahead"))})
    return made.drop("__payload", "__rn", "__own", "__chunk")


def with_context(
    messages: DataFrame, group: Sequence[str], order: Sequence[str], payload: Column, before: int = 5, after: int = 1, hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``context``: up to ``before`` preceding and ``after`` following messages of the group."""
    rows = _neighbours(messages, group, order, payload, max(1, before), after, hot_rows, chunk_rows)
    parts = [F.col(name) for name, wanted in (("__past", before), ("__ahead", after)) if wanted]
    return rows.withColumn("context", F.concat(*parts)).drop("__past", "__ahead")


def merge_replies(messages: DataFrame, key: str, parent: str, text: str = "text", order: Sequence[str] = ()) -> DataFrame:
    """Prefixes a reply with its parent's text, where that isn't blank; the last of repeated parents counts."""
    rank = F.struct(*(order or [text]))
    parents = messages.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__parent")).agg(F.max_by(F.col(text), rank).alias("__said"))
    joined = messages.join(parents, F.col(parent) == F.col("__parent"), "left")
    merged = F.when(~is_blank(F.col("__said")), F.concat(F.lit("[context] "), F.col("__said"), F.lit("\n"), F.coalesce(F.col(text), F.lit(""))))
    return joined.withColumn(text, merged.otherwise(F.col(text))).drop("__parent", "__said")


def author_history(
    messages: DataFrame, author: Sequence[str], order: Sequence[str], text: str = "text", last: int = 10, cap: int = 3000, hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``history``: the author's up to ``last`` earlier texts, newest first, joined and cut at ``cap``."""
    said = F.substring(F.coalesce(F.col(text), F.lit("")), 1, cap)
    rows = _neighbours(messages, author, order, said, last, 0, hot_rows, chunk_rows)
    return rows.withColumn("history", F.substring(F.array_join(F.reverse("__past"), "\n"), 1, cap)).drop("__past", "__ahead")


def history_as_of(
    messages: DataFrame, history: DataFrame, author: str, at: str, text: str = "text", last: int = 10, cap: int = 3000, chunk_rows: int = 200_000
) -> DataFrame:
    """Adds ``earlier``: what the author had said before each message, the ``last`` texts of ``history``, newest first.

    Both tables have ``author`` and ``at``; a text of the very moment isn't before it, of ties the
    lesser text counts as newer, and each is cut at ``cap``. Null and empty texts and rows
    without author or time are no history; messages without either have an empty array, and an
    author's null matches nothing. Repeated messages each get their own.

    Texts and messages are put in one order and dealt by ranges of about ``chunk_rows`` rows, so an
    author of any number of messages is many parts. Texts are numbered per author; a part is
    given copies of the few texts before it that its first messages look back to, and a message
    then sees the texts whose numbers are the greatest up to its own.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in messages.columns])
    placed = F.col(author).isNotNull() & F.col(at).isNotNull()
    asks = messages.where(placed).select(F.col(author).alias("user"), F.col(at).alias("at"), F.lit(False).alias("told"), F.lit(None).cast("string").alias("said"), own.alias("row"))
    asks = asks.withColumn("spread", F.xxhash64(F.to_json("row")))
    texts = history.where(placed & (F.col(text) != "")).select(F.col(author).alias("user"), F.col(at).alias("at"), F.left(F.col(text), F.lit(cap)).alias("said"))
    copies = texts.groupBy("user", "at", "said").agg(F.count(F.lit(1)).alias("n"))  # more than ``last`` equal ones are never seen
    told = copies.select("user", "at", F.lit(True).alias("told"), "said", F.lit(None).cast(asks.schema["row"].dataType).alias("row"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(last)))).alias("spread"))
    order = ["at", "told", F.desc("said"), "spread"]
    rows = chunked(asks.unionByName(told), ["user", *order], chunk_rows, "history-rows")
    sizes = rows.groupBy("user", "part").agg(F.count_if("told").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("user").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.select("user", "part", "size", before.alias("before"))
    running = F.count_if("told").over(Window.partitionBy("user", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumn("n", running).join(parts, ["user", "part"]).withColumn("rank", F.col("before") + F.col("n"))
    ranked = cut(ranked.select("user", "part", "told", "said", "row", "rank", (F.col("size") - F.col("n") < last).alias("tail")), "history-ranked")
    tails = ranked.where("told and tail").select("user", "rank", "said")
    asked = parts.where("before > 0").select("user", "part", F.explode(F.sequence(F.greatest(F.col("before") - (last - 1), F.lit(1)), F.col("before"))).alias("rank"))
    nothing = F.lit(None).cast(asks.schema["row"].dataType)
    lent = asked.join(tails, ["user", "rank"]).select("user", "part", F.lit(True).alias("told"), "said", nothing.alias("row"), "rank")
    near = Window.partitionBy("user", "part").orderBy("rank").rangeBetween(1 - last, 0)
    seen = F.collect_list(F.when(F.col("told"), F.struct("rank", "said"))).over(near)
    newest = F.transform(F.sort_array(seen, asc=False), lambda x: x["said"])
    met = ranked.drop("tail").unionByName(lent).withColumn("earlier", newest).where("not told")
    found = met.select(*[F.col("row").getField(c).alias(c) for c in messages.columns], "earlier")
    return found.unionByName(messages.where(~placed).withColumn("earlier", F.array().cast("array<string>")))


def with_bio(messages: DataFrame, users: DataFrame, author: str = "username", name: str = "username", bio: str = "bio") -> DataFrame:
    """Adds the author's bio, null where unknown."""
    known = users.groupBy(F.col(name).alias("__name")).agg(F.max(bio).alias("bio"))
    return messages.join(known, F.col(author) == F.col("__name"), "left").drop("__name")


def group_prior(messages: DataFrame, names: DataFrame, priors: DataFrame, group: str = "group_id") -> DataFrame:
    """Two-hop lookup id -> name -> prior; low-confidence priors are not used.

    ``priors`` has group, distribution (map of shares), total_n and confidence. A group of
    several names has the last in order, a name of several priors that of the largest total, so
    no message is multiplied.
    """
    sure = priors.where("confidence = 'high'")
    known = sure.groupBy(F.col("group").alias("__group")).agg(F.max_by(F.struct("distribution", "total_n"), F.struct("total_n", F.to_json("distribution"))).alias("__p"))
    known = known.select("__group", "__p.distribution", "__p.total_n")
    ids = names.groupBy(F.col("group_id").alias("__id")).agg(F.max("name").alias("__group"))
    joined = messages.join(ids, F.col(group) == F.col("__id"), "left").join(known, "__group", "left")
    return joined.drop("__id", "__group")


def prior_share(distribution: Column, labels: Sequence[str]) -> Column:
    """Summed share of some labels, 0 where missing."""
    total = F.lit(0.0)
    for label in labels:
        total = total + F.coalesce(F.try_element_at(distribution, F.lit(label)), F.lit(0.0))
    return total
