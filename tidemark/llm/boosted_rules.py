"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

Fixed base rules judge first (too short, too repetitive). What passes them is judged by
boosted depth-limited trees with logistic loss, fitted on all labelled documents: bins are cut
at exact quantiles, and for each level of a tree every block of rows on the executors sends its
sums by node, feature and bin, never rows. The trees are flattened into node arrays that score
all rows of a batch level by level. For chosen features the trees are monotone: more repetition, symbols, capitals or
duplicate lines can never raise a document's score. A split that breaks the order of its
children is refused, and children inherit bounds so that deeper splits can't break it.

The threshold keeps at least ``keep_share`` of the labelled good documents, so the rules err
on the side of keeping. Every document is measured whole, in one map pass without a shuffle;
the query stores the fifteen numbers and the counts, from which it learns and judges.

Edge cases: null and empty texts have no words and fail the base rule; repeated rows each
get a row; labels that are null or whose document is missing are not learned from; without
labels of both kinds only the base rules judge; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.blocks import added, order_statistics, quantile_ranks, to_blocks
from tidemark.llm.docstats import COUNTS, FEATURES, labelled, measured, vectors
from tidemark.session import cut, release, table

BINS = 48
UNIT = float(1 << 32)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: -1: the score may only fall as the feature grows.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "bang_share": -1, "pipe_share": -1, "upper_word_share": -1, "top_word_share": -1}


@dataclass
class Forest:
    """Flattened trees: node i of a tree goes to left[i] where x[feature[i]] <= cut[i], else to right[i]; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int
    threshold: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of all rows: every tree walked level by level over the whole batch."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                split = self.feature[at]
                down = x[rows, np.maximum(split, 0)] <= self.cut[at]
                at = np.where(split < 0, at, np.where(down, self.left[at], self.right[at]))
            total += self.value[at]
        return total


@dataclass
class Tree:
    """A tree over bins: node i goes left where the feature's bin is at most bins[i]; a leaf has feature -1."""

    feature: list[int]
    bins: list[int]
    left: list[int]
    right: list[int]
    value: list[float]

    def leaf(self) -> int:
        for column, empty in ((self.feature, -1), (self.bins, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            column.append(empty)
        return len(self.feature) - 1

    def walk(self, binned: np.ndarray, depth: int) -> np.ndarray:
        """The node at which every row arrives."""
        feature, bins, left, right = (np.array(v, dtype=np.int64) for v in (self.feature, self.bins, self.left, self.right))
        at, rows = np.zeros(len(binned), dtype=np.int64), np.arange(len(binned))
        for _ in range(depth):
            split = feature[at]
            down = binned[rows, np.maximum(split, 0)] <= bins[at]
            at = np.where(split < 0, at, np.where(down, left[at], right[at]))
        return at


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8)


def node_sums(binned: np.ndarray, y: np.ndarray, logit: np.ndarray, tree: Tree, nodes: list[int], depth: int, width: int) -> np.ndarray:
    """Slopes, curvatures and rows by (node, feature, bin).

    Slopes and curvatures are whole multiples of 2^-32, so a total doesn't depend on the order of its blocks.
    """
    chance = 1 / (1 + np.exp(-logit))
    slope, curve = np.rint((y - chance) * UNIT), np.rint(np.maximum(chance * (1 - chance), 1e-6) * UNIT)
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    own = place[tree.walk(binned, depth)]
    inside = own >= 0
    own, slope, curve, binned = own[inside], slope[inside], curve[inside], binned[inside]
    made = np.zeros((3, binned.shape[1], len(nodes) * width), dtype=np.int64)
    for f in range(binned.shape[1]):
        cell = own * width + binned[:, f]
        made[0, f] = np.bincount(cell, slope, len(nodes) * width)
        made[1, f] = np.bincount(cell, curve, len(nodes) * width)
        made[2, f] = np.bincount(cell, minlength=len(nodes) * width)
    return made.reshape(3, binned.shape[1], len(nodes), width)


class Rows:
    """Training rows of one process: bins, labels and what the trees so far say."""

    def __init__(self, x: np.ndarray, y: np.ndarray, edges: list[np.ndarray], start: float) -> None:
        self.state = (_binned(x, edges), y, np.full(len(y), start))

    def sums(self, *asked) -> np.ndarray:
        return node_sums(*self.state, *asked)

    def add(self, tree: Tree, depth: int) -> None:
        self.state = _advanced(self.state, tree, depth)


class SparkRows:
    """The same for all blocks of an RDD; every finished tree makes the next state from the last one."""

    def __init__(self, blocks: RDD, edges: list[np.ndarray], start: float) -> None:
        self.state = blocks.map(lambda b: (_binned(b[0], edges), b[1], np.full(len(b[1]), start))).persist(StorageLevel.MEMORY_AND_DISK)
        self.last = None

    def sums(self, *asked) -> np.ndarray:
        return added(self.state.map(lambda s: (node_sums(*s, *asked),)))[0]

    def add(self, tree: Tree, depth: int) -> None:
        if self.last is not None:
            self.last.unpersist()
        self.last, self.state = self.state, self.state.map(lambda s: _advanced(s, tree, depth)).persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        for held in (self.state, self.last):
            if held is not None:
                held.unpersist()


def _advanced(state: tuple, tree: Tree, depth: int) -> tuple:
    binned, y, logit = state
    return binned, y, logit + np.array(tree.value)[tree.walk(binned, depth)]


def boost(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], bins: int = BINS, **grown) -> Forest:
    """``plant`` for rows in memory."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]
    start = _start(float(y.mean()))
    return plant(Rows(x, y, edges, start), edges, start, monotone, **grown)


def _start(share: float) -> float:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def plant(
    rows: Rows | SparkRows,
    edges: list[np.ndarray],
    start: float,
    monotone: dict[int, int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    least: int = 20,
    ridge: float = 1.0,
) -> Forest:
    """Second-order boosting over feature bins; a level of a tree takes one look at all rows."""
    width = max(len(e) for e in edges) + 1
    flat: list[list[float]] = []
    roots: list[int] = []
    for _ in range(trees):
        tree = Tree([], [], [], [], [])
        todo = [(tree.leaf(), -np.inf, np.inf)]
        for level in range(depth):
            total = rows.sums(tree, [node for node, _, _ in todo], depth, width)
            below = []
            for i, (node, low, high) in enumerate(todo):
                g, h = total[0, 0, i].sum() / UNIT, total[1, 0, i].sum() / UNIT
                own = float(np.clip(g / (h + ridge), low, high))
                tree.value[node] = rate * own
                size = total[2, 0, i].sum()
                best = None
                for f in range(len(edges)) if size >= 2 * least else ():
                    cells = len(edges[f]) + 1
                    if cells < 2:
                        continue
                    gl, hl = (np.cumsum(total[k, f, i, :cells])[:-1] / UNIT for k in (0, 1))
                    nl = np.cumsum(total[2, f, i, :cells])[:-1]
                    vl = np.clip(gl / (hl + ridge), low, high)
                    vr = np.clip((g - gl) / (h - hl + ridge), low, high)
                    worth = gl * vl - 0.5 * (hl + ridge) * vl**2 + (g - gl) * vr - 0.5 * (h - hl + ridge) * vr**2
                    worth -= g * own - 0.5 * (h + ridge) * own**2
                    bad = (nl < least) | (size - nl < least)
                    if direction := monotone.get(f, 0):
                        bad |= direction * (vr - vl) < 0
                    worth[bad] = -np.inf
                    k = int(np.argmax(worth))
                    if worth[k] > 1e-3 and (best is None or worth[k] > best[0]):
                        best = (worth[k], f, k, float(vl[k]), float(vr[k]))
                if best is None:
                    continue
                _, f, k, vl, vr = best
                middle = (vl + vr) / 2
                bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[monotone.get(f, 0)]
                tree.feature[node], tree.bins[node] = f, k
                tree.left[node], tree.right[node] = tree.leaf(), tree.leaf()
                for child, value, (lo, hi) in zip((tree.left[node], tree.right[node]), (vl, vr), bounds, strict=True):
                    tree.value[child] = rate * float(np.clip(value, lo, hi))
                    below.append((child, lo, hi))
            todo = below
            if not todo:
                break
        rows.add(tree, depth)
        roots.append(len(flat))
        for f, k, left, right, value in zip(tree.feature, tree.bins, tree.left, tree.right, tree.value, strict=True):
            at = len(flat)
            flat.append([f, float(edges[f][k]), roots[-1] + left, roots[-1] + right, 0.0] if f >= 0 else [-1, 0.0, at, at, value])
    nodes = np.array(flat)
    whole = nodes[:, [0, 2, 3]].astype(np.int64)
    return Forest(whole[:, 0], nodes[:, 1], whole[:, 1], whole[:, 2], nodes[:, 4], np.array(roots), start, depth)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (F.lit(100) * n_repeat_words > F.lit(MAX_REPEAT_PERCENT) * n_words)


def train(docs: DataFrame, labels: DataFrame, keep_share: float = 0.995, key: str = "doc_id", text: str = "text", label: str = "quality") -> Forest | None:
    """A forest fitted on all labelled documents; None without labels of both kinds. ``docs`` may be measured already."""
    known = cut(labelled(measured(docs, key, text), labels, key, label), "labelled")
    count, share, kinds, good = known.agg(F.count(F.lit(1)), F.avg("label"), F.count_distinct("label"), F.count(F.when(F.col("label") == 1, 1))).first()
    if kinds < 2:
        release(known)
        return None
    blocks = to_blocks(known, count, len(FEATURES))
    edges = [np.unique(e).astype(np.float64) for e in order_statistics(blocks.map(lambda b: b[0]), [quantile_ranks(count, BINS)] * len(FEATURES))]
    rows = SparkRows(blocks, edges, _start(share))
    forest = plant(rows, edges, _start(share), {FEATURES.index(name): way for name, way in MONOTONE.items()})
    rows.close()
    forest.threshold = min(0.0, _lower(blocks, forest, good, 1 - keep_share)) if good else 0.0
    blocks.unpersist()
    release(known)
    return forest


def _lower(blocks: RDD, forest: Forest, good: int, share: float) -> float:
    """A score that at most ``share`` of the good documents are below."""
    raw = blocks.map(lambda b: forest.raw(b[0][b[1] == 1].astype(np.float64))[:, None])
    value = order_statistics(raw, [np.array([int(share * (good - 1))])])[0][0]
    return float(np.nextafter(value, np.float32(-np.inf)))  # scores are doubles, the statistic is rounded


def judge(docs: DataFrame, forest: Forest | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule_score) for every document."""
    seen = measured(docs, key, text).select(key, *COUNTS, "x")
    names = [key, *COUNTS, "rule_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.raw(vectors(batch.column("x"))) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=names)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in seen.schema if f.name != "x"]
    scored = seen.mapInArrow(run, ", ".join([*kept, "rule_score double"]))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    good = F.col("rule_score") >= F.lit(forest.threshold if forest else 0.0)
    return scored.select(key, *COUNTS, failed.alias("base_failed"), (~failed & good).alias("kept"), "rule_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cut(measured(table(spark, sf_dir, "documents").select("doc_id", "text")), "measured")
    return judge(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))
