"""Text vectors and an inverted-file index: nearest labelled examples of a text.

A text's vector is a sum of signed hashed features (words and their letter trigrams), each word
damped by the square root of its count, at unit length: a sparse random projection that needs no
training and is the same on every executor.

The index assigns every row to the nearest of a bounded number of centroids, which are fitted on a
bounded hash sample (``SAMPLE`` rows). A query looks into the lists of its ``probes`` nearest
centroids and compares with every row there, so what it finds is exact within those lists; with
as many probes as lists it is exact. A list over ``LIST_ROWS`` rows is cut into pieces, so no
task holds more.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.prompts import few_shot
from tidemark.session import cut, ship

DIMENSIONS = 128
SAMPLE, LISTS, ROUNDS = 20_000, 1024, 8
LIST_ROWS = 50_000
PROBES = 8
_REMEMBERED = 200_000
#: Distances that a task holds at once; rows of an Arrow batch, which may hold whole texts.
CELLS, BATCH_ROWS = 1 << 20, 1000
#: Digits of a distance that count, so that equal vectors tie.
DIGITS = 9


class WordVectors(dict):
    """Vectors of words, remembered while they are few enough."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= _REMEMBERED:
            self.clear()
        marked = f"<{word}>"
        features = [marked, *(marked[i : i + 3] for i in range(len(marked) - 2))]
        made = np.zeros(self.size, dtype=np.float32)
        for i, feature in enumerate(features):
            value = zlib.crc32(feature.encode("utf-8", "surrogatepass"))  # the same in every process
            made[(value >> 8) % self.size] += (1.0 if value & 1 else -1.0) * (2.0 if i == 0 else 1.0)
        self[word] = made
        return made


@lru_cache(maxsize=2)
def _words(size: int) -> WordVectors:
    """One memory of words for all batches of a worker."""
    return WordVectors(size)


def text_vector(text: str | None, words: WordVectors) -> np.ndarray | None:
    """The text's unit vector, None for a text without a word."""
    counts = Counter((text or "").lower().split())
    if not counts:
        return None
    total = np.zeros(words.size, dtype=np.float64)
    for word, n in counts.items():
        total += math.sqrt(n) * words[word]
    length = float(np.sqrt((total * total).sum()))
    return (total / length).astype(np.float32) if length else None


def _bounded(spark: SparkSession) -> None:
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def with_vectors(rows: DataFrame, text: str = "text", vector: str = "embedding", size: int = DIMENSIONS) -> DataFrame:
    """Adds the texts' vectors; null for null, empty and wordless texts. Very long texts count whole."""
    _bounded(rows.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        words = _words(size)
        return pa.array([text_vector(t.as_py(), words) for t in texts], pa.list_(pa.float32()))

    return rows.withColumn(vector, F.arrow_udf(run, "array<float>")(F.col(text)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None]


def _rows(vectors: pa.Array) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of unit length."""
    return _unit(_rows(vectors)) if len(vectors) else np.zeros((0, 0))


def _usable(vector: Column, size: int) -> Column:
    """A vector of ``size`` finite numbers that aren't all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & ~bad & F.exists(vector, lambda x: x != 0)


def fitted_centroids(rows: DataFrame, key: str, vector: str, lists: int | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of spherical k-means over a hash sample of at most ``sample`` rows; by default the square root of all rows, ``LISTS`` at most."""
    lists = max(1, min(LISTS, lists or math.isqrt(rows.count())))
    held = cut(rows.select(key, vector).orderBy(F.xxhash64(key, F.lit(3)), key).limit(sample), "index-sample")
    size = held.agg(F.mode(F.size(vector))).first()[0] or 0
    picked = held.where(_usable(F.col(vector), size)).orderBy(key).select(F.col(vector).cast("array<double>").alias("v")).toArrow()
    if not picked.num_rows:
        return np.zeros((0, max(0, size)))
    points = _unit(_rows(picked.column("v")))
    centres = points[:lists].copy()
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        full = np.bincount(nearest, minlength=len(centres)) > 0
        centres[full] = _unit(sums[full])
    return centres


def assigned(rows: DataFrame, centroids: np.ndarray, vector: str = "embedding", to: int = 1, name: str = "lists") -> DataFrame:
    """Adds ``name``: the numbers of the ``to`` nearest centroids, nearest first; rows without a usable vector go."""
    _bounded(rows.sparkSession)
    to = min(to, len(centroids))
    step = max(1, CELLS // max(1, len(centroids)))

    def run(vectors: pa.Array) -> pa.Array:
        points, chosen = _unit(_rows(vectors)), []
        for low in range(0, len(points), step):
            near = -(points[low : low + step] @ centroids.T)
            chosen += list(np.argsort(near, axis=1, kind="stable")[:, :to].astype(np.int32))
        return pa.array(chosen, pa.list_(pa.int32()))

    usable = rows.where(_usable(F.col(vector), centroids.shape[1]))
    return usable.withColumn(name, F.arrow_udf(run, "array<int>")(F.col(vector).cast("array<double>")))


def build_index(rows: DataFrame, path: str, key: str = "message_id", vector: str = "embedding", lists: int | None = None, centroids: np.ndarray | None = None) -> None:
    """Write every row with its list to ``path``, partitioned by list, and the centroids beside, where readers of the rows don't look."""
    spark = rows.sparkSession
    made = fitted_centroids(rows, key, vector, lists) if centroids is None else _unit(np.asarray(centroids, dtype=np.float64))
    indexed = assigned(rows, made, vector).withColumn("list", F.get("lists", F.lit(0))).drop("lists")
    # the lists' rows meet, in as many files as a long list needs
    indexed.hint("rebalance", F.col("list")).write.mode("overwrite").partitionBy("list").parquet(path)
    named = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(made)], "list int, centroid array<double>")
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/_centroids")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """(rows with ``list``, centroids) of a written index; the centroids are at most ``LISTS`` rows."""
    held = spark.read.parquet(f"{path}/_centroids").orderBy("list").toArrow()
    return spark.read.parquet(path), _rows(held.column("centroid")) if held.num_rows else np.zeros((0, 0))


_FOUND = "query_id bigint, label string, k bigint, distance double"


def search(indexed: DataFrame, centroids: np.ndarray, queries: DataFrame, per_label: int = 5, probes: int = PROBES, key: str = "message_id", vector: str = "embedding", label: str = "label", list_rows: int = LIST_ROWS) -> DataFrame:
    """(query_id, label, key, distance, rank): each query's nearest rows per label within its ``probes`` nearest lists.

    A task holds one piece of a list and streams the queries sent to it; a query's own row (equal
    key) is no example. Ties of distance, rounded to ``DIGITS`` digits, go to the smaller key.
    """
    pieces = indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(list_rows)).cast("int").alias("pieces"))  # at most LISTS rows
    rows = indexed.where(F.col(key).isNotNull()).join(F.broadcast(pieces), "list")
    rows = rows.select("list", F.pmod(F.xxhash64(key), "pieces").cast("int").alias("piece"), F.lit(0).alias("kind"), F.col(key).cast("bigint").alias("k"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    asked = assigned(queries.where(F.col(key).isNotNull()), centroids, vector, probes).select(F.col(key).cast("bigint").alias("k"), F.col(vector).cast("array<double>").alias("v"), F.explode("lists").alias("list"))
    asked = asked.join(F.broadcast(pieces), "list").select("k", "v", "list", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    both = rows.unionByName(asked.select("list", "piece", F.lit(1).alias("kind"), "k", F.lit(None).cast("string").alias("label"), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for batch in batches:
            names = np.column_stack([batch.column(c).to_numpy() for c in ("list", "piece", "kind")])
            edges = np.flatnonzero((np.diff(names, axis=0) != 0).any(axis=1)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(names)], strict=True):
                at, kind = tuple(names[start, :2].tolist()), int(names[start, 2])
                piece = batch.slice(start, end - start)
                if at != now:
                    now, held, ready = at, [], None
                if kind == 0:
                    held.append((piece.column("k").to_numpy(), piece.column("label").to_pylist(), _unit(_rows(piece.column("v")))))
                    continue
                if not held and ready is None:
                    continue
                ready = ready or _by_label(held)
                held = []
                yield from _nearest(ready, piece.column("k").to_numpy(), _unit(_rows(piece.column("v"))), per_label)

    found = both.repartition("list", "piece").sortWithinPartitions("list", "piece", "kind").mapInArrow(run, _FOUND)
    ranked = Window.partitionBy("query_id", "label").orderBy("distance", "k")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= per_label)
    return best.select("query_id", F.col("label").cast(indexed.schema[label].dataType).alias("label"), F.col("k").alias(key), "distance", "rank")


def _by_label(held: list[tuple]) -> list[tuple[str | None, np.ndarray, np.ndarray]]:
    keys, points = np.concatenate([h[0] for h in held]), np.concatenate([h[2] for h in held])
    labels = [name for h in held for name in h[1]]
    groups: dict[str | None, list[int]] = {}
    for at in np.argsort(keys, kind="stable").tolist():
        groups.setdefault(labels[at], []).append(at)
    return [(name, keys[at], points[at]) for name, at in groups.items()]


def _nearest(groups: list[tuple], queries: np.ndarray, vectors: np.ndarray, many: int) -> Iterator[pa.RecordBatch]:
    for name, keys, points in groups:
        step = min(256, max(1, CELLS // len(keys)))
        for low in range(0, len(queries), step):
            far = np.round(1.0 - vectors[low : low + step] @ points.T, DIGITS)
            far[queries[low : low + step, None] == keys[None, :]] = np.inf
            kept = np.argsort(far, axis=1, kind="stable")[:, :many]  # keys ascend, so of equal distances the smaller key is first
            own = np.repeat(queries[low : low + step], kept.shape[1])
            away = np.take_along_axis(far, kept, axis=1).ravel()
            fine = np.isfinite(away)
            columns = [pa.array(own[fine]), pa.array([name] * int(fine.sum()), pa.string()), pa.array(keys[kept].ravel()[fine]), pa.array(away[fine])]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "label", "k", "distance"])


def few_shot_blocks(found: DataFrame, indexed: DataFrame, key: str = "message_id", text: str = "text", positive: str = "true") -> DataFrame:
    """(query_id, block): each query's neighbours as the examples of a prompt, the label ``positive`` against all others, nearest first."""
    said = indexed.select(F.col(key), F.col(text).alias("__said"))
    ordered = F.array_sort(F.collect_list(F.struct("distance", key, F.coalesce(F.col("label").cast("string") == positive, F.lit(False)).alias("yes"), F.col("__said").alias("said"))))
    grouped = found.join(said, key).groupBy("query_id").agg(ordered.alias("e"))

    def of(yes: bool) -> Column:
        return F.transform(F.filter("e", lambda x: x["yes"] == yes), lambda x: x["said"])

    return grouped.select("query_id", few_shot(of(False), of(True)).alias("block"))
