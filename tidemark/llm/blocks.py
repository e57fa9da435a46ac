"""Labelled rows as numpy blocks that stay on the executors, for models fitted on all of them.

A fit is a series of Spark jobs: every block makes sums of a bounded size, sums are added up
in a tree, and only totals reach the driver, which decides and sends a few kilobytes back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row

BLOCK_ROWS = 1 << 14
#: Rows of a task; a fit has hundreds of short jobs, so their tasks grow with the rows, not with the cores.
TASK_ROWS = 1 << 16
_DIGIT = 8


def to_blocks(rows: DataFrame, count: int, width: int) -> RDD:
    """(x, y) blocks of ``rows`` (label, x array<float>), ``count`` of them, kept in memory or on the executors' disks."""

    def packed(found: Iterator[Row]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, y = [], []
        for label, own in found:
            x.append(own)
            y.append(label)
            if len(y) == BLOCK_ROWS:
                yield np.array(x, dtype=np.float32), np.array(y, dtype=np.float64)
                x, y = [], []
        if y:
            yield np.array(x, dtype=np.float32).reshape(-1, width), np.array(y, dtype=np.float64)

    tasks = max(1, -(-count // TASK_ROWS))
    return rows.select("label", "x").coalesce(tasks).rdd.mapPartitions(packed).persist(StorageLevel.MEMORY_AND_DISK)


def added(parts: RDD) -> Sequence[np.ndarray]:
    """The sum of tuples of arrays, place by place."""

    def plus(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> Sequence[np.ndarray]:
        return tuple(p + q for p, q in zip(a, b, strict=True))

    return parts.treeReduce(plus)


def ordered(values: np.ndarray) -> np.ndarray:
    """float32 as uint32 of the same order; both zeros are one."""
    bits = (values.astype(np.float32) + np.float32(0)).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))


def _value(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >> 31, keys & np.uint32(0x7FFFFFFF), ~keys).astype(np.uint32).view(np.float32)


def order_statistics(columns: RDD, ranks: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The exact values at ``ranks`` (from 0) of each column, over blocks of shape (rows, columns), as float32.

    Four passes find a value's bits eight at a time: each counts the rows that agree with a
    value so far by their next digit.
    """
    found = [np.zeros(len(r), dtype=np.uint32) for r in ranks]
    left = [np.array(r, dtype=np.int64) for r in ranks]
    for shift in range(32 - _DIGIT, -1, -_DIGIT):
        known = [np.unique(f) for f in found]

        def counted(block: np.ndarray, known: list[np.ndarray] = known, shift: int = shift) -> tuple[np.ndarray, ...]:
            made = []
            for prefixes, column in zip(known, block.T, strict=True):
                keys = ordered(column).astype(np.uint64)
                high = (keys >> np.uint64(shift + _DIGIT)).astype(np.uint32)
                at = np.minimum(np.searchsorted(prefixes, high), len(prefixes) - 1)
                cell = at * (1 << _DIGIT) + ((keys >> np.uint64(shift)) & np.uint64((1 << _DIGIT) - 1)).astype(np.int64)
                made.append(np.bincount(cell[prefixes[at] == high], minlength=len(prefixes) << _DIGIT))
            return tuple(made)

        for c, total in enumerate(added(columns.map(counted))):
            below = np.cumsum(total.reshape(-1, 1 << _DIGIT), axis=1)[np.searchsorted(known[c], found[c])]
            digit = (below <= left[c][:, None]).sum(axis=1)
            left[c] -= np.where(digit > 0, below[np.arange(len(digit)), digit - 1], 0)
            found[c] = (found[c] << np.uint32(_DIGIT)) | digit.astype(np.uint32)
    return [_value(f) for f in found]


def quantile_ranks(count: int, parts: int) -> np.ndarray:
    """Ranks of the lower quantiles that cut ``count`` values into ``parts``; as numpy's method "lower"."""
    return np.floor(np.linspace(0, 1, parts + 1)[1:-1] * (count - 1)).astype(np.int64)
