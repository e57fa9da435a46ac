"""Statistics of a whole text that the quality operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_SPACES = b" \t\n\v\f\r"
_random = np.random.default_rng(99)
_FACTORS = _random.integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

FEATURES = (
    "log_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "bang_share",
    "pipe_share",
    "distinct_share",
    "top_word_share",
    "stop_share",
    "line_words",
    "non_ascii_share",
    "upper_word_share",
)
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def _drop(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def points(text: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but continuations."""
    return len(text) - _drop(text, bytes(range(0x80, 0xC0)))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of eight that occur twice or more in the text, the first included."""
    size = len(ids) - WINDOW + 1
    if size < 2:
        return 0
    wide = ids.astype(np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for i in range(WINDOW):
        total += wide[i : i + size] * _FACTORS[i]
    ranked = np.sort(total)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    # equal hashes are candidates; equal words decide
    hit = np.flatnonzero(np.isin(total, twice))
    windows = np.lib.stride_tricks.sliding_window_view(wide, WINDOW)[hit]
    _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    starts = hit[counts[inverse.ravel()] > 1]
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), features) of a UTF-8 text."""
    text = text or b""
    words = text.split()
    n = len(words)
    chars = points(text)
    word_chars = chars - _drop(text, _SPACES)
    symbols = _drop(text, SYMBOLS)
    seen: set[bytes] = set()
    dups = lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    repeats = repeated_words(ids)
    base = (n, word_chars, symbols, dups, repeats)
    if not n:
        return base, [0.0] * len(FEATURES)
    counts = np.bincount(ids)
    upper = _drop(text, _UPPER)
    upper_words = sum(1 for w in number if w.isupper() and len(w) > 1)
    features = [
        float(np.log1p(n)),
        min(word_chars / n, 40.0),
        symbols / max(1, word_chars),
        dups / max(1, lines),
        repeats / n,
        upper / max(1, word_chars),
        _drop(text, _DIGITS) / max(1, word_chars),
        text.count(b"!") / max(1, word_chars),
        text.count(b"|") / max(1, word_chars),
        len(number) / n ** 0.8,
        float(counts.max()) / n,
        text.count(b".") / n,
        min(n / max(1, lines), 400.0),
        _drop(text, bytes(range(0xC0, 0x100))) / max(1, chars),
        upper_words / len(number),
    ]
    return base, features


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, the five counts, x array<float>) of every document, in one map pass; what was measured before is returned as it is."""
    if "x" in docs.columns and text not in docs.columns:
        return docs

    def rows(texts: list[bytes | None]) -> list[pa.Array]:
        found = [measure(t) for t in texts]
        base = np.array([b for b, _ in found], dtype=np.int64)
        return [pa.array(base[:, i]) for i in range(len(COUNTS))] + [pa.array([f for _, f in found], pa.list_(pa.float32()))]

    return map_texts(docs, [key], text, ", ".join([*(f"{c} bigint" for c in COUNTS), "x array<float>"]), rows)


def labelled(seen: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(label, x) of all measured documents with a label; sorted inside partitions, so that equal runs meet equal blocks."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("__id")).agg(F.max(label).cast("double").alias("label"))
    return seen.join(known, F.col(key) == F.col("__id")).sortWithinPartitions(key, "x").select("label", "x")


def vectors(column: pa.Array) -> np.ndarray:
    """Feature lists of an Arrow batch as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))
