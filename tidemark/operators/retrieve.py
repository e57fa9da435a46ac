"""Lexicon lookup and nearest labelled examples."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import bound, spaced_words, term_hit
from tidemark.session import cut

#: Queries sent to the executors at once, and cells (query, label, rank) that a worker keeps for them.
QUERY_BLOCK, KEPT_CELLS = 16_384, 4_000_000
#: Distance of vectors that have none (null, zero, another length, not a number): after all others.
_NONE = float(np.finfo(np.float64).max)


def glossary_hits(text: Column, keys: Sequence[tuple[str, str]], limit: int = 12) -> Column:
    """Terms whose key (surface form) the text holds, longest key first, without repeats."""
    ordered = sorted(dict.fromkeys(keys), key=lambda kv: -len(kv[0]))
    entries = F.array(*[F.struct(F.lit(k.lower()).alias("key"), F.lit(t).alias("term")) for k, t in ordered])
    low = F.lower(F.coalesce(text, F.lit("")))
    both = F.struct(low.alias("low"), spaced_words(low).alias("spaced"))
    found = bound(both, lambda s: F.filter(entries, lambda e: term_hit(s["low"], s["spaced"], e["key"])))
    return F.slice(F.array_distinct(F.transform(found, lambda e: e["term"])), 1, limit)


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def nearest(index: DataFrame, queries: Sequence[tuple[int, Sequence[float]]], per_label: int = 5, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(query_id, label, key, rank): the nearest examples per label for a stated set of query vectors.

    Queries travel as literals; every index row meets them in the scan. Each partition of
    the index keeps its own best before anything is ranked globally.
    """
    asked = F.array(*[F.struct(F.lit(i).alias("query_id"), F.lit([float(x) for x in v]).alias("q")) for i, v in queries])
    rows = index.select(F.col(key).alias("k"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"), F.explode(asked).alias("a"))
    near = rows.select("a.query_id", "label", "k", cosine_distance(F.col("a.q"), F.col("v")).alias("d"))
    local = Window.partitionBy("query_id", "label", F.pmod(F.xxhash64("k"), F.lit(32))).orderBy("d", "k")
    thin = near.withColumn("r", F.row_number().over(local)).where(F.col("r") <= per_label)
    ranked = thin.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "label").orderBy("d", "k")))
    return ranked.where(F.col("rank") <= per_label).select("query_id", "label", F.col("k").alias(key), "rank")


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products, summed in order of the dimensions, so equal vectors get equal sums in any batch."""
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, np.ascontiguousarray(b.T), strict=True):
        total += x[:, None] * y
    return total


def _norms(a: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for x in a.T:
        total += x * x
    return np.sqrt(total)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows as doubles; a row that isn't a vector of ``size`` numbers is all NaN."""
    made = np.full((len(vectors), size), np.nan)
    fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(vectors), size), False))
    flat = vectors.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    made[fits] = flat.reshape(-1, size)
    return made


class _Nearest:
    """The nearest index rows per label of a block of query vectors, kept up batch by batch."""

    def __init__(self, queries: np.ndarray, per_label: int) -> None:
        self.queries, self.norms, self.per_label = queries, _norms(queries), per_label
        self.kept: dict[object, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, keys: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        groups: dict[object, list[int]] = {}
        for at in np.argsort(keys, kind="stable").tolist():  # of equal distances the first is the smallest key
            groups.setdefault(labels[at], []).append(at)
        for label, rows in groups.items():
            for low in range(0, len(rows), 2048):
                self._add(label, keys[rows[low : low + 2048]], vectors[rows[low : low + 2048]])

    def _add(self, label: object, keys: np.ndarray, vectors: np.ndarray) -> None:
        norms, many = _norms(vectors), min(self.per_label, len(keys))
        near, ids = np.empty((len(self.queries), many)), np.empty((len(self.queries), many), dtype=np.int64)
        for low in range(0, len(self.queries), 64):
            part = slice(low, low + 64)
            with np.errstate(all="ignore"):
                far = 1.0 - _dots(self.queries[part], vectors) / (self.norms[part, None] * norms)
            far[~np.isfinite(far)] = _NONE
            row = np.arange(len(far))
            for rank in range(many):
                at = far.argmin(axis=1)
                near[part, rank], ids[part, rank] = far[row, at], keys[at]
                far[row, at] = np.inf
        if label in self.kept:
            near, ids = np.concatenate((self.kept[label][0], near), axis=1), np.concatenate((self.kept[label][1], ids), axis=1)
            order = np.lexsort((ids, near), axis=1)[:, : self.per_label]
            near, ids = np.take_along_axis(near, order, axis=1), np.take_along_axis(ids, order, axis=1)
        self.kept[label] = near, ids


def nearest_of_all(index: DataFrame, queries: DataFrame, per_label: int = 5, key: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, label, key, rank): the nearest examples per label for every row of ``queries``, compared with every index row.

    Queries go out in blocks of at most about ``block`` rows, one pass over the index each; a
    worker keeps its partition's best. With more than one block each is ranked and written
    before the next is fetched, so the driver holds one. The work is queries times index rows.
    Keys are whole numbers; a row without a key is neither query nor example.
    """
    index = index.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    asked = queries.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    labels = index.select("label").distinct().count()
    blocks = max(1, math.ceil(asked.count() / max(1, min(block, KEPT_CELLS // max(1, labels * per_label)))))
    schema = f"query_id bigint, label {index.schema['label'].dataType.simpleString()}, k bigint, d double"

    def best(ids: np.ndarray, vectors: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, label_type = _Nearest(vectors, per_label), None
            for batch in batches:
                if batch.num_rows:
                    label_type = batch.column(1).type
                    found.add(batch.column(0).to_numpy(), batch.column(1).to_pylist(), _matrix(batch.column(2), vectors.shape[1]))
            for name, (near, keys) in found.kept.items():
                made = [pa.array(np.repeat(ids, keys.shape[1])), pa.array([name] * keys.size, label_type), pa.array(keys.ravel()), pa.array(near.ravel())]
                yield pa.RecordBatch.from_arrays(made, names=["query_id", "label", "k", "d"])

        near = index.mapInArrow(run, schema)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "label").orderBy("d", "k")))
        return ranked.where(F.col("rank") <= per_label).select("query_id", "label", F.col("k").alias(key), "rank")

    result = None
    for i in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).toArrow()
        vectors = part.column("v").combine_chunks()
        size = pc.max(pc.list_value_length(vectors)).as_py() or 1
        made = best(part.column("query_id").to_numpy(), _matrix(vectors, size))
        made = cut(made, "nearest") if blocks > 1 else made
        result = made if result is None else result.unionByName(made)
    return result
