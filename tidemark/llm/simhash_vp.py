"""SimHash near-duplicates: exact Hamming links through vantage-point partitions.

1. Every text becomes a 64-bit fingerprint (numpy, one pass, no shuffle).
2. Equal fingerprints collapse to one row with their smallest id before anything is paired,
   so a group of exact copies, however large, is a single point from here on.
3. The distinct fingerprints are dealt into shards by their Hamming distances to fixed
   vantage points. Distances are taken within bit blocks: two fingerprints that differ in at
   most T of 64 bits agree on at least ``m - T`` of ``m`` blocks, so in one of the block sets
   their block distance is 0, and by the triangle inequality their distances to every
   vantage point are equal there. Each point therefore goes into one shard per block set
   (the shards overlap), and no link can cross shards in all of them. With full-width
   distances a radius of 4 covers most of the ring structure (their standard deviation is
   also 4) and every split would copy two thirds of the points; block distances avoid that.
4. Inside a shard a vantage-point tree splits the points at the median distance to one of
   them until ``LEAF`` are left; a branch pair is visited only for the points near the
   boundary, where the triangle bound ``|d(x,v) - d(y,v)| <= T`` allows a link, and not if
   all its points are known to be connected. A shard over ``max_shard`` points is dealt anew
   by the blocks of the bits that its own block set leaves out: five copies for shards a
   thousandth as large. What is still over ``max_shard`` then (very many fingerprints within
   few bits of each other) is cut into parts of half that size and every pair of parts is
   joined, so no task holds more than ``max_shard`` points. Each shard emits a star per
   connected class, never all pairs.
5. Components of the stars come from alternating large-star / small-star rounds, each a
   pair of joins cut to the shared folder.

Edge cases: null and wordless texts have fingerprint zero and link like any other; repeated
rows each get a row; a null id never becomes a component's name unless all its ids are null;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, map_texts
from tidemark.session import cut, dimension, table

SHINGLE = 4
RADIUS = 4
SEED = 42
LEAF = 32
#: Points a shard should hold, and those that one task may hold (8 bytes each).
SHARD, MAX_SHARD = 128, 50_000
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the ASCII-lower-cased text's word shingles, as an unsigned integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        spans = zip(starts, ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    total = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    if pad := -total % 255:
        hashes = np.concatenate((hashes, np.zeros(pad, dtype=np.uint64)))
    rows = hashes.reshape(-1, 255)
    for bit in range(8):  # eight byte lanes at once; 255 rows can't overflow a lane
        lanes = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(counts * 2 > total).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) for every document; fp is the fingerprint as a signed 64-bit integer."""

    def rows(texts: list[bytes | None]) -> list[pa.Array]:
        prints = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return [pa.array(prints.view(np.int64))]

    return map_texts(docs, [key], text, "fp bigint", rows)


def components(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index of each point's connected class."""
    label = np.arange(size)
    while len(left):
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        np.minimum.at(after, label[left], low)
        np.minimum.at(after, label[right], low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    return label


class VantageJoin:
    """All links within ``radius`` bits among points, as stars of connected classes."""

    def __init__(self, points: np.ndarray, radius: int = RADIUS, leaf: int = LEAF) -> None:
        self.points, self.radius, self.leaf = points.view(np.uint64), radius, leaf
        self.label = np.arange(len(points))  # the smallest point known to be connected with each
        self.compared = self.splits = 0

    def classes(self) -> np.ndarray:
        todo: list[tuple[np.ndarray, ...]] = [(np.arange(len(self.points)),)]
        while todo:  # depth first, so branches are connected within before they are joined
            todo += reversed(self._branches(*todo.pop()))
        return self.label

    def _connect(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.label[left], self.label[right]
        apart = a != b
        if not apart.any():
            return
        names, at = np.unique(np.concatenate((a[apart], b[apart])), return_inverse=True)
        half = len(at) // 2
        to = np.arange(len(self.label))
        to[names] = names[components(len(names), at[:half], at[half:])]
        self.label = to[self.label]

    def _connected(self, *groups: np.ndarray) -> bool:
        first = self.label[groups[0][0]]
        return all((self.label[g] == first).all() for g in groups)

    def _compare(self, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, (1 << 18) // max(1, len(b)))
        for at in range(0, len(a), step):
            part = a[at : at + step]
            self.compared += len(part) * len(b)
            apart = np.bitwise_count(self.points[part][:, None] ^ self.points[b][None, :])
            i, j = np.nonzero(apart <= self.radius)
            self._connect(part[i], b[j])

    def _halves(self, a: np.ndarray, b: np.ndarray | None) -> list[tuple[np.ndarray, ...]] | None:
        """The branches inside, outside and across the median distance to one of the points; None if one holds nearly all pairs."""
        groups = (a,) if b is None else (a, b)
        vantage = self.points[a[len(a) // 2]]
        away = [np.bitwise_count(self.points[g] ^ vantage).astype(np.int64) for g in groups]
        whole = np.concatenate(away)
        ring = int(np.median(whole))
        if (whole < ring).sum() > (whole > ring).sum():  # the better balance of the two
            ring -= 1
        pairs = [(g, d <= ring, d > ring - self.radius, d <= ring + self.radius) for g, d in zip(groups, away, strict=True)]
        inner, outer = [g[low] for g, low, _, _ in pairs], [g[~low] for g, low, _, _ in pairs]
        # by the triangle inequality a link across has both ends within the radius of the boundary
        below, above = [g[low & near] for g, low, near, _ in pairs], [g[~low & far] for g, low, _, far in pairs]
        if b is None:
            branches = [(inner[0],), (outer[0],), (below[0], above[0])]
            return branches if 0.1 * len(a) <= len(inner[0]) <= 0.9 * len(a) else None
        branches = [(inner[0], inner[1]), (outer[0], outer[1]), (below[0], above[1]), (above[0], below[1])]
        return branches if max(len(x) * len(y) for x, y in branches) <= 0.9 * len(a) * len(b) else None

    def _branches(self, a: np.ndarray, b: np.ndarray | None = None) -> list[tuple[np.ndarray, ...]]:
        """Links the points within ``a``, or between ``a`` and ``b``, or names the branches in which links may be."""
        if not len(a) or (len(a) < 2 if b is None else not len(b)) or self._connected(*((a,) if b is None else (a, b))):
            return []
        small = len(a) <= self.leaf if b is None else len(a) * len(b) <= 4 * self.leaf * self.leaf
        branches = None if small else self._halves(a, b)
        if branches is None:
            self._compare(a, a if b is None else b)
            return []
        self.splits += 1
        return branches


def _masks(bits: Sequence[int], count: int) -> list[int]:
    """Masks of ``count`` runs of nearly equal size that cover the given bits."""
    edges = [len(bits) * i // count for i in range(count + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(edges, edges[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _plan(points: int, radius: int, shard: int) -> tuple[int, int]:
    """(blocks, vantage points per block set): finer partitions for more points."""
    blocks = radius + 1
    while blocks < radius + 4 and points > shard * 8 * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    wanted = max(1.0, np.log2(max(2.0, points / shard)))
    return blocks, int(min(12 * (blocks - radius), np.ceil(wanted / 1.8)))


def _block_sets(count: int, radius: int, shard: int) -> tuple[list[int], int]:
    """(masks of the block sets, vantage points for each)."""
    blocks, vantages = _plan(count, radius, shard)
    masks = _masks(range(64), blocks)
    return [sum(masks[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)], vantages


def shard_points(points: DataFrame, count: int, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(fp, tree, ring): one row per block set; ring encodes the distances to its vantage points."""
    sets, vantages = _block_sets(count, radius, shard)
    trees = []
    for tree, mask in enumerate(sets):
        away = []
        for j in range(vantages):
            vantage = xxhash.xxh64_intdigest(f"{tree}:{j}".encode(), SEED) & mask
            away.append(F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(vantage)))))
        ring = F.xxhash64(F.lit(tree), *away)
        trees.append(F.struct(F.lit(tree).alias("tree"), ring.alias("ring")))
    spread = points.select("fp", F.explode(F.array(*trees)).alias("at"))
    return spread.select("fp", F.col("at.tree").alias("tree"), F.col("at.ring").alias("ring"))


def _over(spread: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(keys, n) of the shards over ``most`` points, written."""
    return cut(spread.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most), "hot-shards")


def cells(points: DataFrame, count: int, radius: int = RADIUS, shard: int = SHARD, max_shard: int = MAX_SHARD) -> tuple[DataFrame, list[str]]:
    """(rows of fp and cell keys, the keys): every two linked points share a cell of at most about ``max_shard`` points."""
    spread = shard_points(points, count, radius, shard).withColumn("sub", F.lit(-1))
    keys = ["tree", "ring"]
    hot = _over(spread, keys, max_shard)
    if hot.isEmpty():
        return spread, keys
    # once more by blocks of the bits outside the shard's block set: of these, too, one is equal
    finer = [_masks([b for b in range(64) if not mask >> b & 1], radius + 1) for mask in _block_sets(count, radius, shard)[0]]
    own = F.get(F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in finer]), F.col("tree"))
    again = F.transform(own, lambda m, i: F.struct(i.alias("sub"), F.xxhash64("ring", i, F.col("fp").bitwiseAND(m)).alias("ring")))
    once = [F.struct(F.lit(-1).alias("sub"), F.col("ring"))]
    dealt = spread.drop("sub").join(dimension(hot), keys, "left")
    dealt = dealt.select("fp", "tree", F.explode(F.when(F.col("n").isNull(), F.array(*once)).otherwise(again)).alias("at"))
    spread = dealt.select("fp", "tree", F.col("at.ring").alias("ring"), F.col("at.sub").alias("sub"))
    keys = ["tree", "ring", "sub"]
    hot = _over(spread, keys, max_shard)
    if hot.isEmpty():
        return spread, keys
    parts = F.ceil(F.col("n") / F.lit(max_shard / 2.0)).cast("bigint")
    spread = spread.join(dimension(hot), keys, "left")
    mine = F.coalesce(F.pmod(F.xxhash64("fp", F.lit(7)), parts), F.lit(0))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(parts, F.lit(1)) - 1))
    spread = spread.select("fp", *keys, mine.alias("mine"), other.alias("other"))
    return spread.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")}), [*keys, "low", "high"]


def link_stars(points: DataFrame, count: int, radius: int = RADIUS, shard: int = SHARD, max_shard: int = MAX_SHARD) -> DataFrame:
    """(a, b): each fingerprint's link to the smallest of its class within a shard, a > b."""

    def join(group: pa.Table) -> pa.Table:
        fps = np.unique(group.column("fp").to_numpy())
        label = VantageJoin(fps, radius).classes()
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pa.table({"a": fps[moved], "b": fps[label[moved]]})

    spread, keys = cells(points, count, radius, shard, max_shard)
    return spread.groupBy(*keys).applyInArrow(join, "a bigint, b bigint")


def join_statistics(points: DataFrame, count: int, radius: int = RADIUS, shard: int = SHARD, max_shard: int = MAX_SHARD) -> DataFrame:
    """(points, splits, compared) of every shard's tree: what ``link_stars`` does, counted."""

    def count_up(group: pa.Table) -> pa.Table:
        fps = np.unique(group.column("fp").to_numpy())
        join = VantageJoin(fps, radius)
        join.classes()
        return pa.table({"points": [len(fps)], "splits": [join.splits], "compared": [join.compared]})

    spread, keys = cells(points, count, radius, shard, max_shard)
    return spread.groupBy(*keys).applyInArrow(count_up, "points bigint, splits bigint, compared bigint")


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connect(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, root) for every linked point: alternating large-star and small-star until still."""
    now = cut(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).where("v > root").distinct(), "stars")
    seen = None
    for _ in range(rounds):
        both = now.select(F.col("v").alias("u"), F.col("root").alias("v")).unionByName(now.select(F.col("root").alias("u"), "v"))
        large = both.join(_lowest(both), "u").where(F.col("v") > F.col("u"))
        large = large.select("v", F.least("m", "u").alias("root")).where("v > root").distinct()
        down = large.select(F.col("v").alias("u"), F.col("root").alias("v"))
        small = down.join(_lowest(down), "u")
        small = small.select("v", F.col("m").alias("root")).unionByName(small.select(F.col("u").alias("v"), F.col("m").alias("root")))
        now = cut(small.where("v > root").distinct(), "stars")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "root"))).first()
        if mark == seen:
            return now
        seen = mark
    raise RuntimeError("components did not settle")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    shard: int = SHARD,
    max_shard: int = MAX_SHARD,
) -> DataFrame:
    """(key, fingerprint, component_id, copies, linked, class) for every document.

    ``copies`` counts the documents with the same fingerprint, itself included; ``linked``
    tells whether a different fingerprint is within the radius; ``class`` is the smallest
    fingerprint of the component as a signed number, and unlike the smallest id its own even
    where documents of several components share an id.
    """
    prints = cut(fingerprints(docs, key, text, shingle), "prints")
    points = cut(prints.groupBy("fp").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("copies")), "points")
    labels = connect(link_stars(points.select("fp"), points.count(), radius, shard, max_shard))
    roots = labels.select(F.col("root").alias("v"), "root").distinct()
    linked = cut(points.join(labels.unionByName(roots).withColumnRenamed("v", "fp"), "fp").select("fp", "root", "least"), "linked")
    named = linked.groupBy("root").agg(F.min("least").alias("name"))
    classes = linked.join(named, "root").select("fp", "name", "root")
    named_points = points.join(classes.withColumn("linked", F.lit(True)), "fp", "left").select(
        "fp", F.coalesce("name", "least").alias("component_id"), "copies", F.coalesce("linked", F.lit(False)).alias("linked"), F.coalesce("root", "fp").alias("class")
    )
    joined = prints.join(named_points, "fp")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return joined.select(key, hexed.alias("fingerprint"), "component_id", "copies", "linked", "class")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """One document of each component, that of the smallest id; all columns stay.

    Rows without an id name no component and all stay. Texts that share an id are decided one
    by one: of repeated rows, and of rows of one id and component, the one of smallest
    fingerprint and contents stays. Up to ``broadcast_rows`` ids of documents to go are
    broadcast, and no document moves; more are joined by id.
    """
    lost = F.col(key) > F.col("component_id")
    found = near_duplicates(docs, key, text).where(F.col(key).isNotNull())
    found = cut(found.select(key, "fingerprint", "class", lost.alias("lost")), "decisions")
    ids = found.groupBy(key).agg(F.bool_or("lost").alias("some"), F.bool_and("lost").alias("every"), F.count(F.lit(1)).alias("n"))
    ids = cut(ids.where("some or n > 1"), "losers")
    own = [f"`{c}`" for c in docs.columns]
    kept = docs.join(dimension(ids.select(key), broadcast_rows), key, "left_anti").select(*own)
    mixed = ids.where("not every").select(key)
    if mixed.isEmpty():
        return kept

    def hexed(texts: pa.Array) -> pa.Array:
        return pa.array([f"{fingerprint(t.as_py()):016x}" for t in texts], pa.string())

    name = "_" * (1 + max(map(len, docs.columns)))  # no column's name, nor are longer ones
    again = bounded_batches(docs).join(dimension(mixed, broadcast_rows), key, "left_semi").select(
        F.col(key).alias(name), F.struct(*own).alias(f"{name}row"), F.arrow_udf(hexed, "string")(F.col(text).cast("binary")).alias(f"{name}print")
    )
    winners = found.where("not lost").select(F.col(key).alias(name), F.col("fingerprint").alias(f"{name}print"), F.col("class").alias(f"{name}class")).distinct()
    held = again.join(winners, [name, f"{name}print"])
    order = F.struct(f"{name}print", F.to_json(f"{name}row"))
    one = held.groupBy(name, f"{name}class").agg(F.min_by(f"{name}row", order).alias(f"{name}row"))
    return kept.unionByName(one.select(*[F.col(f"{name}row").getField(c).alias(c) for c in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
