"""Benchmark decontamination with spaced seeds.

A seed mask looks at some positions of a token window and ignores the others, so a window
still hashes to the benchmark's value when words at ignored positions were replaced. Hashes
of all benchmark windows form an index; every training document streams past it once: hash
join on the window values, then a check of the tokens around each hit along its diagonal
that tolerates further substitutions.

The index is the only thing sent to executors. Its size is bounded: the benchmark is
measured first and beyond ``block_bytes`` it is cut into blocks by hash of the item id, one
corpus pass per block. Each pass is written before the next block is fetched, so the driver
and the workers hold one. Documents are never shuffled, so a passage that a third of them
share costs no more than any other. Repetitive texts against repetitive items stay within memory
that grows with the two lengths: see ``SeedIndex.diagonals``.

Result: one row per (document, item) whose verified overlap has at least ``min_matched``
equal tokens (all of them for a shorter item) and a share of at least ``min_identity``; clean
documents have no row. Of a
diagonal counts the segment with the highest score (+1 equal, -1.5 different) or, where that
one misses a limit, the one with the most equal tokens of all segments of sufficient
identity: a part that qualifies alone isn't lost in a longer one that doesn't.

Edge cases: null or empty texts and items match nothing; items under the longest mask's span
(eight tokens) are too short to be evidence and match nothing, items of eight or nine must match
whole; of ties between equal overlaps the first position
wins; repeated documents and repeated items each report; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.session import cut, table

#: 1: the position counts, 0: it may differ.
#: Of the placements of as many substitutions as the limits below allow, at least 0.94 leave one of these a window (12 to 20 tokens).
MASKS = ("11101011", "111111", "10110111", "11001111", "1110111")
MIN_MATCHED = 10
MIN_IDENTITY = 0.75
BLOCK_BYTES = 4 << 20
_WORD = re.compile(r"\w+")
_MISS = -1.5
#: Windows that a document repeats more often are expanded by shifts, not pairs; both give the same diagonals.
_SELDOM = 64
_PAIRS = 1 << 20
_CELLS = 1 << 20


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower()) if text else []


class SeedIndex:
    """Window hashes of a block of benchmark items, with the tokens needed to verify hits."""

    def __init__(
        self,
        items: list[tuple[int, str | None]],
        masks: tuple[str, ...] = MASKS,
        min_matched: int = MIN_MATCHED,
        min_identity: float = MIN_IDENTITY,
    ) -> None:
        self.min_matched, self.min_identity, self.limit = min_matched, min_identity, Fraction(str(min_identity))
        self.spans = [len(mask) for mask in masks]
        self.span = max(self.spans)
        self.at = [np.flatnonzero([c == "1" for c in mask]) for mask in masks]
        random = np.random.default_rng(2024)
        self.factors = [random.integers(1, 2**63, len(at), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for at in self.at]
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        hashes: list[np.ndarray] = []
        where: list[np.ndarray] = []
        for item_id, text in items:
            words = tokens(text)
            if item_id is None or len(words) < self.span:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.uint64)
            for seed in range(len(masks)):
                found = self._windows(ids, seed)
                hashes.append(found)
                where.append(np.stack((np.full(len(found), len(self.items)), np.arange(len(found))), axis=1))
            self.items.append((item_id, ids))
        flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.longest = max((len(ids) for _, ids in self.items), default=0)
        self.where = (np.concatenate(where) if where else np.empty((0, 2), dtype=np.int64))[order].astype(np.int32)
        self.bits = max(16, int(math.log2(len(flat) + 1)) + 5)
        self.maybe = np.zeros(1 << self.bits, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def _windows(self, ids: np.ndarray, seed: int) -> np.ndarray:
        """The hash of every window's counted positions under one mask."""
        size = len(ids) - self.spans[seed] + 1
        total = np.full(size, seed, dtype=np.uint64)
        for at, factor in zip(self.at[seed].tolist(), self.factors[seed], strict=True):
            total += ids[at : at + size] * factor
        return total ^ (total >> np.uint64(29))

    def _hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the document that are in the index, as (position, first entry, number of entries)."""
        found = []
        for seed in range(len(self.at)):
            windows = self._windows(ids, seed)
            likely = np.flatnonzero(self.maybe[(windows >> np.uint64(64 - self.bits)).astype(np.int64)])
            if len(likely):
                low = np.searchsorted(self.hashes, windows[likely], "left")
                many = np.searchsorted(self.hashes, windows[likely], "right") - low
                found.append(np.stack((likely, low, many))[:, many > 0])
        at, low, many = np.concatenate(found, axis=1) if found else np.empty((3, 0), dtype=np.int64)
        return at, low, many

    def diagonals(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, diagonals that a window hits, ascending); an item may come more than once.

        A window that the document holds seldom is paired with all its index entries, a bounded
        number of pairs at a time. The places of one that it repeats are shifted as a whole, once an
        entry, into the item's diagonals, so memory grows with document and item, not their product.
        """
        at, low, many = self._hits(ids)
        if not len(at):
            return
        entries, group, places = np.unique(low, return_inverse=True, return_counts=True)
        often = places > _SELDOM
        seldom = ~often[group]
        at_once, first, size = at[seldom], low[seldom], many[seldom]
        width = len(ids) + self.longest + 1
        for part in np.split(np.arange(len(at_once)), np.flatnonzero(np.diff(np.cumsum(size) // _PAIRS)) + 1):
            n = size[part]
            entry = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, own = self.where[entry].astype(np.int64).T
            codes = np.unique(item * width + np.repeat(at_once[part], n) - own + self.longest)
            items = codes // width
            for same in np.split(np.arange(len(codes)), np.flatnonzero(np.diff(items)) + 1):
                if len(same):
                    yield int(items[same[0]]), codes[same] % width - self.longest
        if not often.any():
            return
        ends = np.searchsorted(self.hashes, self.hashes[entries[often]], "right")
        held = np.concatenate([np.arange(a, b) for a, b in zip(entries[often], ends, strict=True)])
        names = np.repeat(np.flatnonzero(often), ends - entries[often])
        order = np.lexsort((names, self.where[held, 0]))
        held, names = held[order], names[order]
        by_group = np.argsort(group, kind="stable")
        starts = np.cumsum(places) - places
        for part in np.split(np.arange(len(held)), np.flatnonzero(np.diff(self.where[held, 0])) + 1):
            item = int(self.where[held[part[0]], 0])
            size = len(self.items[item][1])
            marks = np.zeros(len(ids) + size, dtype=bool)
            for one in np.split(part, np.flatnonzero(np.diff(names[part])) + 1):
                g = names[one[0]]
                repeated = np.zeros(len(ids), dtype=bool)
                repeated[at[by_group[starts[g] : starts[g] + places[g]]]] = True
                for own in self.where[held[one], 1].tolist():
                    marks[size - own : size - own + len(ids)] |= repeated
            yield item, np.flatnonzero(marks) - size

    def _widest(self, same: np.ndarray) -> tuple[int, int]:
        """The segment with the most equal tokens of all whose identity suffices, without different tokens at its ends.

        Its end fixes the best start: the first at which the surplus of equal tokens over the
        limit is no higher than at the end. Whole numbers keep the comparison exact.
        """
        count = np.concatenate(([0], np.cumsum(same)))
        surplus = count * self.limit.denominator - np.arange(len(count)) * self.limit.numerator
        start = np.searchsorted(-np.minimum.accumulate(surplus), -surplus)
        end = int(np.argmax(count - count[start]))
        inside = np.flatnonzero(same[start[end] : end])
        return (int(start[end] + inside[0]), int(start[end] + inside[-1]) + 1) if len(inside) else (0, 0)

    def _best_on(self, same: np.ndarray, least: int) -> tuple[int, int, int]:
        """(equal tokens, start, end) of a diagonal's best segment; no tokens where none qualifies."""
        run = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, _MISS))))
        gain = run - np.minimum.accumulate(run)
        end = int(np.argmax(gain))
        start = int(np.flatnonzero(run[: end + 1] == run[: end + 1].min())[-1])
        equal = int(same[start:end].sum())
        if equal < max(least, self.min_identity * (end - start)) and same.sum() >= least:
            start, end = self._widest(same)
            equal = int(same[start:end].sum())
        return (equal, start, end) if equal >= least and equal >= self.min_identity * (end - start) else (0, 0, 0)

    def overlaps(self, text: str | None) -> list[tuple[int, int, int, int, int, int]]:
        """(item, equal tokens, doc start, doc end, item start, item end) of verified overlaps, best per item.

        A diagonal is looked at only while it is long enough, and holds enough equal tokens, to
        beat the best one found for its item; the longest come first. A repetitive item that a
        repetitive text holds whole is thus settled by its first diagonal.
        """
        words = tokens(text)
        if len(words) < self.span or not self.items:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.uint64, count=len(words))
        edged = None
        best: dict[int, tuple[int, int, int, int]] = {}
        for item, shifts in self.diagonals(ids):
            own = self.items[item][1]
            least = min(self.min_matched, len(own))
            if edged is None:
                edge = np.zeros(self.longest, dtype=np.uint64)
                edged = np.concatenate((edge, ids, edge))
            length = np.minimum(len(own), len(ids) - shifts) - np.maximum(0, -shifts)
            order = np.lexsort((shifts, -length))
            order = order[length[order] >= least]
            step = max(1, _CELLS // len(own))
            while len(order):
                top, at = best.get(item, (0, 0))[:2]
                order = order[(length[order] > top) | ((length[order] == top) & (shifts[order] < at))]
                chunk, order = shifts[order[:step]], order[step:]
                same = edged[(chunk + self.longest)[:, None] + np.arange(len(own))] == own
                total = same.sum(axis=1)
                for i in np.lexsort((chunk, -total)).tolist():
                    top, at = best.get(item, (0, 0))[:2]
                    if total[i] < max(least, top):
                        break
                    if total[i] > top or chunk[i] < at:
                        equal, start, end = self._best_on(same[i], least)
                        if equal > top or (equal == top > 0 and chunk[i] < at):
                            best[item] = (equal, int(chunk[i]), start, end)
        return [(self.items[item][0], equal, start + shift, end + shift, start, end) for item, (equal, shift, start, end) in sorted(best.items())]


def seed_indexes(benchmark: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES, **rules) -> tuple[int, Iterator[SeedIndex]]:
    """How many blocks of at most about ``block_bytes`` of benchmark text there are, and one index for each, made when asked for."""
    items = benchmark.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))

    def made() -> Iterator[SeedIndex]:
        for i in range(blocks):
            part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i) if blocks > 1 else items
            yield SeedIndex([(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()], **rules)

    return blocks, made()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
    **rules,
) -> DataFrame:
    """(key, item_id, n_matched, n_overlap, doc_start, doc_end, item_start, item_end), offsets in tokens."""
    source = bounded_batches(docs).select(key, F.col(text).alias("__text"))
    kind = source.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id bigint, n_matched int, n_overlap int, doc_start int, doc_end int, item_start int, item_end int"
    names = [part.strip().split(" ")[0].strip("`") for part in schema.split(",")]

    def scan(index: SeedIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found = [], []
                for i, value in enumerate(batch.column(1)):
                    for item, equal, a, b, c, d in index.overlaps(value.as_py()):
                        rows.append(i)
                        found.append((item, equal, b - a, a, b, c, d))
                if rows:
                    made = [pa.array(x, pa.int64() if n == 0 else pa.int32()) for n, x in enumerate(zip(*found, strict=True))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *made], names=names)

        return source.mapInArrow(run, schema)

    blocks, indexes = seed_indexes(benchmark, item_key, text, block_bytes, **rules)
    result = None
    for index in indexes:
        found = cut(scan(index), "seed-pass") if blocks > 1 else scan(index)
        result = found if result is None else result.unionByName(found)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, **rules) -> DataFrame:
    """The documents without a verified overlap; all columns stay, nothing is shuffled."""

    def without(kept: DataFrame, index: SeedIndex) -> DataFrame:
        def clean(texts: pa.Array) -> pa.Array:
            return pa.array([not index.overlaps(t.as_py()) for t in texts], pa.bool_())

        return kept.where(F.arrow_udf(clean, "boolean")(F.col(text)))

    kept = bounded_batches(docs)
    blocks, indexes = seed_indexes(benchmark, text=text, block_bytes=block_bytes, **rules)
    for index in indexes:
        kept = cut(without(kept, index), "seed-pass") if blocks > 1 else without(kept, index)
    return kept


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
