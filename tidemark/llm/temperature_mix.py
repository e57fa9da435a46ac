"""Temperature mixing of sources to target weights, realised as budgeted block permutations.

A source's weight is its token share to the power ``alpha``, normalised. ``alpha`` is found
by bisection in [0, 1]: the largest exponent (least distortion) whose weights reach the
target entropy, raised where needed so that no source is repeated more than ``max_epochs``
times within the budget. The target lies between the entropy that the shares have already and
that of equal weights, ``TARGET_ENTROPY`` of the way up, so it binds on every corpus whose
sources differ in size; a share of the entropy of equal weights may be given instead. Each Spark job tests the end points of sixteen sections at once,
four bisection steps, from two power sums; sources are never gathered on the driver.

Weights become token quotas of the budget. A source's documents are dealt by hash into
blocks of about ``block_tokens`` tokens, of which there are at most about ``max_blocks``
over all sources, and every pass over a source (epoch) visits its blocks in another hash
order, and within a block its documents in another hash order. Whole epochs take all; the
last takes blocks, then documents of the block in which the quota ends, while they fit. The
only per-source ordering is over the small block table; a source with a third of all
documents is just many blocks.

Documents are taken whole, so quotas are met as nearly as documents allow. The one in which
a quota ends is taken if it holds over 1/``COARSE`` of the quota and at least half of it
fits; otherwise the quota is kept to. A realised quota is thus off by at most the larger of
that share and half a document. A document over twice its source's quota can't be part of it
and is passed over, so it blocks no others, which then fill the quota in at most
``max_epochs`` passes. A source that has only such documents gives the one of smallest hash
with the chance quota / size, so that many such sources together keep to the budget.

``position`` in [0, 1) is the occurrence's place within its source's quota: ordering all
rows by it interleaves the sources in proportion to their weights at every prefix.

Edge cases: a null source is the source ``<null>``; null or wordless texts have 0 tokens and
ride along with their block in every pass that takes the whole block; a source without
tokens has weight 0 and no row, nor has one whose quota rounds to 0; repeated rows are
separate documents, but the single document of a source without a fitting one counts once;
ties in hash order fall back to id and length; an empty table gives no rows; other columns
are ignored unless carried.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut, dimension, table

SECTIONS = 16
ROUNDS = 6
TARGET_ENTROPY = 0.5  # share of the way from the corpus's own entropy to that of equal weights
MAX_EPOCHS = 4.0
BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 100_000
NO_SOURCE = "<null>"
COARSE = 16
#: Rows of a small side that may be broadcast, after counting.
BROADCAST_ROWS = 200_000


def token_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def units(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """(doc, source, n_tokens, carried): all that mixing needs of a document, and a struct of ``carry``."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE))
    held = [F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]).alias("carried")] if carry else []
    return docs.select(F.col(key).alias("doc"), name.alias("source"), token_count(F.col(text)).alias("n_tokens"), *held)


def _curve(shares: DataFrame, alphas: list[float]) -> list[tuple[float, float]]:
    """(entropy, largest weight-to-share ratio) of the weights at each exponent, in one job."""
    sums = []
    for a in alphas:
        raised = F.exp(F.lit(a) * F.col("log"))
        sums += [F.sum(raised), F.sum(raised * F.col("log"))]
    row = shares.agg(F.min("log"), *sums).first()
    found = []
    for i, a in enumerate(alphas):
        z, t = row[1 + 2 * i], row[2 + 2 * i]
        found.append((math.log(z) - a * t / z, math.exp((a - 1) * row[0]) / z))
    return found


def solve_alpha(shares: DataFrame, sources: int, epochs_at_one: float, target_entropy: float | None, max_epochs: float) -> float:
    """The exponent; ``shares`` has a column ``log``, the log of each source's token share.

    ``target_entropy`` is a share of the entropy of equal weights; None aims ``TARGET_ENTROPY``
    of the way from the shares' own entropy to it.
    """
    most = math.log(sources) if sources > 1 else 0.0
    if target_entropy is None:
        own = min(most, _curve(shares, [1.0])[0][0])
        wanted = own + TARGET_ENTROPY * (most - own)
    else:
        wanted = target_entropy * most

    def search(fits, prefer_high: bool) -> float:
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            good = [fits(*x) for x in _curve(shares, grid)]
            if prefer_high:  # fits near 0, fails near 1
                last = max((i for i, g in enumerate(good) if g), default=0)
                if last == SECTIONS:
                    return high
                low, high = grid[last], grid[last + 1]
            else:  # fails near 0, fits near 1
                first = min((i for i, g in enumerate(good) if g), default=SECTIONS)
                if first == 0:
                    return low
                low, high = grid[first - 1], grid[first]
        return low if prefer_high else high

    by_entropy = search(lambda h, _: h >= wanted - 1e-12, True)
    by_repeats = search(lambda _, ratio: ratio * epochs_at_one <= max_epochs + 1e-12, False)
    return max(by_entropy, by_repeats)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget_share: float = 1.0,
    target_entropy: float | None = None,
    max_epochs: float = MAX_EPOCHS,
    block_tokens: int = BLOCK_TOKENS,
    max_blocks: int = MAX_BLOCKS,
    seed: int = 11,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(key, source, n_tokens, epoch, block, position, weight, carried columns): one row per occurrence in the mixture.

    The budget is ``budget_share`` times the corpus's tokens. Columns in ``carry`` join the
    rows where they are ordered within their blocks, which moves each occurrence once.
    """
    rows = cut(units(docs, key, text, source), "mix-units")
    totals = cut(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mix-sources")
    whole = totals.agg(F.sum("tokens"), F.sum("docs"), F.count_if(F.col("tokens") > 0)).first()
    total, count, sources = whole[0] or 0, whole[1] or 0, whole[2] or 0
    budget = total * budget_share
    alpha, power = 1.0, 1.0
    live = totals.where(F.col("tokens") > 0).withColumn("log", F.log(F.col("tokens") / F.lit(float(max(1, total)))))
    if sources:
        alpha = solve_alpha(live, sources, budget_share, target_entropy, max_epochs)
        power = live.agg(F.sum(F.exp(F.lit(alpha) * F.col("log")))).first()[0]
    size = max(block_tokens, total / max_blocks)
    per_block = max(block_tokens / 16, count / max_blocks)
    weight = F.exp(F.lit(alpha) * F.col("log")) / F.lit(power)
    quotas = live.select(
        "source",
        "tokens",
        weight.alias("weight"),
        F.round(weight * F.lit(budget)).cast("bigint").alias("quota"),
        F.greatest(F.ceil(F.col("tokens") / F.lit(size)), F.ceil(F.col("docs") / F.lit(per_block)), F.lit(1)).cast("bigint").alias("blocks"),
    )
    quotas = cut(quotas, "mix-quotas")
    block = F.pmod(F.xxhash64("doc", F.lit(seed)), F.col("blocks"))
    fits = F.col("n_tokens") <= F.col("quota") * 2

    def deal(frame: DataFrame) -> DataFrame:
        own = dimension(quotas.select("source", "blocks", "quota"), BROADCAST_ROWS)
        return frame.join(own, "source").where(F.col("quota") > 0).withColumn("block", block)

    blocks = deal(rows).groupBy("source", "block").agg(
        F.sum(F.when(fits, F.col("n_tokens"))).alias("size"), F.min(F.when(~fits, _order("doc", "n_tokens", seed))).alias("over")
    )
    blocks = cut(blocks, "mix-blocks")  # at most about max_blocks rows, and one for each source
    whole = blocks.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("fitting"), F.min("over").alias("over"))
    limits = quotas.join(whole, "source").withColumn("quota", F.least("quota", (F.col("fitting") * F.lit(max_epochs)).cast("bigint")))
    sizes = blocks.where("size is not null").select("source", "block", "size")
    filled = limits.where("fitting > 0")
    epochs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("quota") / F.col("fitting"))))
    passes = sizes.join(filled, "source").select("source", "block", "size", "fitting", "quota", "weight", epochs.alias("epoch"))
    shuffled = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("source", "block", "epoch", F.lit(seed)), "block")
    before = F.sum("size").over(shuffled.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    plan = passes.withColumn("begin", F.col("epoch") * F.col("fitting") + before)
    plan = plan.where((F.col("begin") < F.col("quota")) | ((F.col("size") == 0) & (F.col("begin") <= F.col("quota"))))
    plan = plan.select(F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "begin", F.col("quota").alias("until"), "weight")
    # sources without any fitting document: the one of smallest hash, by chance
    chance = F.pmod(F.xxhash64("source", F.lit(seed + 2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    lone = quotas.join(whole.where("fitting = 0 and over is not null").select("source", "over"), "source")
    lone = lone.where(chance < F.col("quota") / F.col("over.n_tokens")).select(F.col("source").alias("s"), "over", "weight")

    known = units(docs, key, text, source, carry) if carry else rows
    dealt = deal(known)
    taken = dealt.where(fits).join(dimension(plan, BROADCAST_ROWS), (F.col("source") == F.col("s")) & (F.col("block") == F.col("b")))
    inner = Window.partitionBy("source", "block", "epoch").orderBy(F.xxhash64("doc", "epoch", F.lit(seed + 1)), "doc", "n_tokens")
    upto = F.col("begin") + F.sum("n_tokens").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = F.col("upto") <= F.col("until")
    coarse = (F.col("n_tokens") * COARSE > F.col("until")) & (F.col("upto") - F.col("n_tokens") < F.col("until")) & (F.col("upto") * 2 - F.col("n_tokens") <= F.col("until") * 2)
    placed = taken.withColumn("upto", upto).where(inside | coarse)
    middle = F.least((F.col("upto") - F.col("n_tokens") / F.lit(2.0)) / F.greatest(F.col("until"), F.lit(1)), F.lit(1 - 1e-9))
    columns = [F.col("doc").alias(key), "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block", "position", "weight"]
    columns += [F.col("carried").getField(c).alias(c) for c in carry]
    placed = placed.withColumn("position", middle).select(*columns)
    if lone.isEmpty():
        return placed
    first = _order("doc", "n_tokens", seed)
    alone = dealt.where(~fits).join(dimension(lone, BROADCAST_ROWS), (F.col("source") == F.col("s")) & (first == F.col("over")))
    alone = alone.groupBy("doc", "source", "n_tokens", "block", "weight").agg(*([F.min("carried").alias("carried")] if carry else [F.count(F.lit(1)).alias("n")]))
    return placed.unionByName(alone.withColumn("epoch", F.lit(0)).withColumn("position", F.lit(0.5)).select(*columns))


def _order(doc: str, size: str, seed: int) -> Column:
    """What the single document of a source without a fitting one is chosen by."""
    return F.struct(F.xxhash64(doc, F.lit(seed + 3)).alias("hash"), F.col(doc).alias("doc"), F.col(size).alias("n_tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
