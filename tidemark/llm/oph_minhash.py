"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded stars.

1. A text's set of word shingles is hashed once; one permutation deals the hashes into
   ``BANDS * ROWS`` bins and each bin keeps its least value. An empty bin borrows from the
   filled bin that comes first in the bin's own random order, the same for every text: optimal
   densification, by which two texts' bins agree with a chance equal to their similarity, however
   short they are.
2. Equal sets are one class (by a 128-bit digest), so copies cost nothing from here on.
3. ``ROWS`` neighbouring bins make a band; classes with an equal band meet in a bucket. Two sets of
   similarity 0.8 miss each other in all 60 bands of five with a chance of 4e-11.
4. A bucket of n classes gives n - 1 candidate edges, a star around the class that meets the most
   others in all its buckets, never all pairs: of an original and its near copies, which may be
   linked with the original alone, that is the original. The same edge of several bands is one. Sizes rule out most of what can't reach
   the threshold; the others are confirmed on the full sets, which are made again only for the
   classes on such edges.
5. A star can miss a link between two of its tips. Buckets of three or more classes whose members
   are not all in one component by then are therefore joined once more, inside a task, by
   an exact count of shared shingles; that gives one edge for each component that joins another.
   The centre serves as a vantage point: members linked with it need no part in that unless one
   of another component has a similarity to it of at least 0.6, below which, by the triangle
   inequality, no link with them is possible. Buckets with the same members are joined once. In one
   over ``MAX_CELL`` classes the members of the largest component, which need not meet each other, are
   dealt to cells and the others, if they fill at most half a cell, go to each. Otherwise it is cut into
   parts, and every pair of parts is a cell of its own. No task holds more than about ``MAX_CELL``
   sets and nothing is dropped.
6. Components of the confirmed edges get the smallest id.

Edge cases: null, empty and wordless texts have an empty set and are linked with nothing; a text
of fewer words than a shingle is one shingle; repeated rows each get a row; rows without an id
take part but name no component (unless all its ids are null) and are not kept; very long texts
count whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, map_texts
from tidemark.llm.simhash_vp import components, connect
from tidemark.session import cut, dimension, table

SHINGLE = 2
BANDS, ROWS = 60, 5
#: A link: 100 * shared shingles >= PERCENT * shingles of both.
PERCENT = 80
MAX_CELL = 1024
#: Rows of a small side that may be broadcast, after counting.
BROADCAST_ROWS = 200_000
SEED = 42
_WORDS_KEPT = 1_000_000
_COLUMNS = 4096


class WordHashes(dict):
    """64-bit hashes of words, remembered while they are few enough."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, SEED)
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value (64-bit finaliser, fixed constants)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes | None, words: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of the ASCII-lower-cased text."""
    said = (text or b"").lower().split()
    if not said:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter((words[w] for w in said), dtype=np.uint64, count=len(said))
    width = min(shingle, len(said))
    total = np.full(len(said) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(said) - width + 1 + i])
    return np.unique(total)


@lru_cache(maxsize=4)
def _tables(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of bin j in the order of bin i, odd factors of the bins in their band)."""
    random = np.random.default_rng(2026)
    order = random.random((bands * rows, bands * rows), dtype=np.float32)
    return order, random.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def densified(hashes: np.ndarray, bins: int, order: np.ndarray) -> np.ndarray:
    """The least value of every bin; empty bins borrow from the first filled one in their order."""
    moved = mixed(hashes + np.uint64(0x632BE59BD9B4E019))
    at = ((moved >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    least = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, at, moved)
    full = np.zeros(bins, dtype=bool)
    full[at] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        filled = np.flatnonzero(full)
        least[empty] = least[filled[order[np.ix_(empty, filled)].argmin(axis=1)]]
    return least


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of a non-empty set; the band is part of the key."""
    order, factors = _tables(bands, rows)
    weighed = (densified(hashes, bands * rows, order) * factors).reshape(bands, rows).sum(axis=1, dtype=np.uint64)
    return mixed(weighed + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def _class(hashes: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(hashes.tobytes(), SEED)


def _short(cls) -> F.Column:
    """The first eight bytes of a class as a number: what candidates are paired by."""
    return F.conv(F.hex(F.substring(cls, 1, 8)), 16, -10).cast("bigint")


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, n, cls, keys): set size, class (null if empty) and band keys of every document."""

    def made(texts: list[bytes | None]) -> list[pa.Array]:
        words = WordHashes()
        sizes, classes, keys = [], [], []
        for t in texts:
            found = shingle_set(t, words, shingle)
            sizes.append(len(found))
            classes.append(_class(found) if len(found) else None)
            keys.append(band_keys(found, bands, rows) if len(found) else None)
        return [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]

    return map_texts(docs, [key], text, "n bigint, cls binary, keys array<bigint>", made)


def shingle_sets(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(cls, n, h): the full sets of the documents' texts, each once."""

    def made(texts: list[bytes | None]) -> list[pa.Array]:
        words = WordHashes()
        found = [shingle_set(t, words, shingle) for t in texts]
        return [pa.array([_class(f) for f in found], pa.binary()), pa.array(list(map(len, found)), pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))]

    return map_texts(docs, [], text, "cls binary, n bigint, h array<bigint>", made).dropDuplicates(["cls"])


def reaches(shared, one, two, percent: int = PERCENT):
    """Whether the shared shingles are enough, in whole numbers."""
    return 100 * shared >= percent * (one + two - shared)


def buckets(sigs: DataFrame) -> DataFrame:
    """(bucket, n, centre, c): the members of every band bucket of two or more classes, and its centre.

    The centre is the member that meets the most others, all its buckets counted; of equals the smallest.
    """
    single = cut(sigs.where("cls is not null").select("cls", "keys").dropDuplicates(["cls"]), "distinct-sets")
    bands = single.select(_short(F.col("cls")).alias("c"), F.explode(F.array_distinct("keys")).alias("bucket"))
    many = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(bands.join(many, "bucket").select("bucket", "n", "c"), "meetings")
    famed = met.join(met.groupBy("c").agg(F.sum("n").alias("met")), "c")
    centres = famed.groupBy("bucket").agg(F.min_by("c", F.struct(-F.col("met"), F.col("c"))).alias("centre"))
    return met.join(centres, "bucket").select("bucket", "n", "centre", "c")


def sets_of(wanted: DataFrame, sigs: DataFrame, docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(cls, c, n, h): full sets of the classes with the given short numbers ``c``, from one document of each."""
    named = sigs.where("cls is not null").select(key, "cls", _short(F.col("cls")).alias("c"))
    chosen = named.join(dimension(wanted, BROADCAST_ROWS), "c", "left_semi").groupBy("cls").agg(F.min(key).alias("id"))
    chosen = cut(chosen, "chosen-classes")
    ids = dimension(chosen.select("id").distinct(), BROADCAST_ROWS)
    # null ids match: a class may have no other
    texts = bounded_batches(docs).select(F.col(key).alias("__id"), F.col(text).alias("text")).join(ids, F.col("__id").eqNullSafe(F.col("id")), "left_semi")
    made = shingle_sets(texts, "text", shingle).join(chosen.select("cls"), "cls", "left_semi")
    return made.select("cls", _short(F.col("cls")).alias("c"), "n", "h")


def graded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, c, d, grade) of the pairs of short numbers (c, d): 2 for a link, 1 if a set linked with one may still be linked with the other.

    By the triangle inequality of the Jaccard distance that takes a similarity of at least
    twice the limit less one; pairs that can't reach it by their sizes are left out before sets move.
    """
    about = sets.select("cls", "c", "n")
    sized = pairs.join(about.withColumnsRenamed({"cls": "a", "n": "na"}), "c").join(about.select(F.col("c").alias("d"), F.col("cls").alias("b"), F.col("n").alias("nb")), "d")
    least = max(0, 2 * percent - 100)
    sized = sized.where(reaches(F.least("na", "nb"), F.col("na"), F.col("nb"), least) & (F.col("a") != F.col("b"))).select("a", "b", "c", "d", "na", "nb")
    left = sets.select(F.col("cls").alias("a"), F.col("h").alias("ha"))
    right = sets.select(F.col("cls").alias("b"), F.col("h").alias("hb"))
    both = sized.join(left, "a").join(right, "b").select("a", "b", "c", "d", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("shared"))
    grade = F.when(reaches(F.col("shared"), F.col("na"), F.col("nb"), percent), 2).when(reaches(F.col("shared"), F.col("na"), F.col("nb"), least), 1)
    return both.select("a", "b", "c", "d", grade.alias("grade")).where("grade is not null")


def shared_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` shares with each of ``two``; only shingles of both count."""
    both = np.intersect1d(np.unique(np.concatenate(one)), np.unique(np.concatenate(two)), assume_unique=True)
    counts = np.zeros((len(one), len(two)), dtype=np.float32)
    for start in range(0, len(both), _COLUMNS):
        columns = both[start : start + _COLUMNS]

        def present(sets: list[np.ndarray], columns=columns) -> np.ndarray:
            held = np.zeros((len(sets), len(columns)), dtype=np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(columns, s)
                at[at == len(columns)] = 0
                held[i, at[columns[at] == s]] = 1.0
            return held

        counts += present(one) @ present(two).T
    return counts.astype(np.int64)


def residual(members: DataFrame, labels: DataFrame, sets: DataFrame, grades: DataFrame, max_cell: int) -> tuple[DataFrame, list[str]]:
    """(cells of bucket members with their sets, their keys): the members among which links may be that the stars don't show.

    A bucket's members that are linked with its centre take part only if one of another
    component is near enough to the centre to be linked with them.
    """
    known = sets.select("c", "cls").join(labels.withColumnRenamed("v", "cls"), "cls", "left")
    known = known.groupBy("c").agg(F.min(F.xxhash64(F.coalesce("root", "cls"))).alias("group"))
    near = grades.groupBy("c", F.col("d").alias("centre")).agg(F.max("grade").alias("grade"))
    named = members.where("n > 2").join(known, "c").join(near, ["c", "centre"], "left").drop("n")
    named = named.withColumn("grade", F.when(F.col("c") == F.col("centre"), 2).otherwise(F.coalesce("grade", F.lit(0))))
    own, middle = F.when(F.col("c") == F.col("centre"), F.col("group")), F.when(F.col("grade") == 1, F.col("group"))
    reach = named.groupBy("bucket").agg(F.max(own).alias("own"), F.min(middle).alias("low"), F.max(middle).alias("high"))
    reach = reach.select("bucket", F.coalesce((F.col("low") != F.col("own")) | (F.col("high") != F.col("own")), F.lit(False)).alias("reach"))
    named = cut(named.join(reach, "bucket").where("grade < 2 or reach").select("bucket", "c", "group"), "residual-members")
    sized = named.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("who"))
    about = sized.groupBy("bucket").agg(F.count(F.lit(1)).alias("groups"), F.sum("m").alias("n"), F.bit_xor("who").alias("who"), F.max("m").alias("most"), F.max_by("group", F.struct("m", "group")).alias("main"))
    apart = cut(about.where("groups > 1").groupBy("n", "who").agg(F.min(F.struct("bucket", "main", "most")).alias("b")).select("n", "b.*"), "residual")
    half = max_cell / 2.0
    few = F.col("n") - F.col("most") <= F.lit(half)  # outside the largest component
    parts = F.when(F.col("n") <= max_cell, 1).when(few, F.ceil(F.col("most") / F.lit(half))).otherwise(F.ceil(F.col("n") / F.lit(half))).cast("bigint")
    chosen = apart.select("bucket", "main", few.alias("few"), parts.alias("parts"))
    spread = named.select("bucket", "c", "group").join(dimension(chosen, BROADCAST_ROWS), "bucket")
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("c", F.lit(7)), "parts"))
    cells = F.when(F.col("few") & (F.col("group") == F.col("main")), F.array("mine")).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    spread = spread.select("bucket", "c", "group", "few", "mine", F.explode(cells).alias("other"))
    keys = ["bucket", "low", "high"]
    spread = spread.withColumns({"low": F.when(F.col("few"), F.col("other")).otherwise(F.least("mine", "other")), "high": F.when(F.col("few"), F.col("other")).otherwise(F.greatest("mine", "other"))})
    return spread.join(sets, "c").select(*keys, "cls", "group", "n", "h"), keys


def residual_stars(members: DataFrame, labels: DataFrame, sets: DataFrame, grades: DataFrame, percent: int, max_cell: int = MAX_CELL) -> DataFrame:
    """(a, b): stars of the known components that a link inside a residual bucket joins."""
    cells, keys = residual(members, labels, sets, grades, max_cell)

    def join(group: pa.Table) -> pa.Table:
        classes, sizes = group.column("cls").to_pylist(), group.column("n").to_numpy()
        held = group.column("h").combine_chunks() if isinstance(group.column("h"), pa.ChunkedArray) else group.column("h")
        flat, ends = held.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(sizes)))
        own = [flat[x:y] for x, y in zip(ends, ends[1:], strict=False)]
        names, of, at = np.unique(group.column("group").to_numpy(), return_index=True, return_inverse=True)
        rest = np.flatnonzero(at != np.bincount(at).argmax())  # every pair across components has a member outside the largest
        if not len(rest):
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        shared = shared_counts([own[i] for i in rest], own)
        left, right = np.nonzero(reaches(shared, sizes[rest, None], sizes[None, :], percent) & (at[rest, None] != at[None, :]))
        left = rest[left]
        label = components(len(names), at[left], at[right])
        moved = np.flatnonzero(label != np.arange(len(names)))  # one edge for each known component that joins another
        return pa.table({"a": pa.array([classes[of[i]] for i in moved], pa.binary()), "b": pa.array([classes[of[label[i]]] for i in moved], pa.binary())})

    return cells.groupBy(*keys).applyInArrow(join, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every document."""
    sigs = cut(signatures(docs, key, text, shingle, bands, rows), "signatures")
    members = cut(buckets(sigs), "buckets")
    pairs = cut(members.where("c != centre").select("c", F.col("centre").alias("d")).distinct(), "star-edges")
    wanted = cut(pairs.select("c").union(pairs.select("d")).distinct(), "paired")
    sets = cut(sets_of(wanted, sigs, docs, key, text, shingle), "sets")
    grades = cut(graded(pairs, sets, percent), "grades")
    stars = grades.where("grade = 2").select("a", "b")
    labels = connect(stars)
    roots = labels.select(F.col("root").alias("v"), "root").distinct()
    more = cut(residual_stars(members, cut(labels.unionByName(roots), "labels"), sets, grades, percent, max_cell), "more-links")
    if not more.isEmpty():
        labels = connect(stars.unionByName(more))
        roots = labels.select(F.col("root").alias("v"), "root").distinct()
    least = cut(sigs.where("cls is not null").groupBy("cls").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("copies")), "classes")
    linked = labels.unionByName(roots).withColumnRenamed("v", "cls").join(least, "cls")
    names = linked.groupBy("root").agg(F.min("least").alias("name"))
    named = linked.join(names, "root").select("cls", "name")
    copied = least.where("copies > 1").join(named.select("cls"), "cls", "left_anti").select("cls", F.col("least").alias("name"))
    # a class of one document that is linked with nothing needs no lookup
    joined = sigs.select(key, "n", "cls").join(dimension(cut(named.unionByName(copied), "names"), BROADCAST_ROWS), "cls", "left")
    component = F.coalesce(F.col("name"), F.col(key))
    return joined.select(key, F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
