"""Quality classifier by Bradley-Terry ranking: document scores learned from preference pairs.

Each training pair prefers a document labelled good over one labelled bad. The probability
that i beats j is the sigmoid of ``w . (f_i - f_j)``; ``w`` minimises the logistic loss over
all pairs of a good and a bad labelled document. Features are document statistics and their quantile steps, which lets
the linear ranking bend. The ranking has no origin, so a threshold is placed at the score
quantile that splits the labelled documents in the labels' proportion; the reported score is the
probability of beating a document at that threshold.

Every labelled document outside the held-out fold is learned from. A pair enters the loss only
by its two strengths, so sums over all pairs need the strengths' counts in narrow cells, and a
Newton step is two looks at the rows: blocks on the executors send counts, then sums of
features weighted by a function of the strength. All documents are measured whole, in one map
pass without a shuffle, and scored from what the query stored of that.

Edge cases: null and empty texts are scored as texts without words; labels that are null,
or whose id is null or missing from the documents, are not learned from; with one label
kind only every score is that kind's; repeated rows each get a row; labels, lang, source
and id are never inputs; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.blocks import added, order_statistics, quantile_ranks, to_blocks
from tidemark.llm.common import fold
from tidemark.llm.docstats import FEATURES, labelled, measured, vectors
from tidemark.session import cut, release, table

PAIRS = 60000
STEPS = 10
RIDGE = 1e-3
#: Cells of a strength for the loss and its slope; for the pairs' part of the curvature.
CELLS, COARSE = 2048, 256
FOLDS, HELD = 3, 1


@dataclass
class Ranker:
    edges: list[np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        steps = [(x[:, i : i + 1] > e[None, :]) for i, e in enumerate(self.edges)]
        plain = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.concatenate([plain, *steps], axis=1).astype(np.float64)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, rounds: int = 400, ridge: float = RIDGE) -> Ranker:
    """For a few rows in memory: minimise the logistic loss of drawn pairs by gradient descent with momentum."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, steps + 1)[1:-1])) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
    # besides quantiles, a step at "any at all" catches rare symptoms
    edges = [np.unique(np.concatenate((e, [c.min()]))) if len(c) else e for e, c in zip(edges, x.T, strict=True)]
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(x.shape[1])
    ranker = Ranker(edges, mean, scale, np.zeros(0), 0.0)
    wide = ranker.expand(x)
    ranker.weights = np.zeros(wide.shape[1])
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    if not len(good) or not len(bad):
        ranker.threshold = -30.0 if len(good) else 30.0
        return ranker
    random = np.random.default_rng(5)
    count = min(pairs, len(good) * len(bad))
    apart = wide[random.choice(good, count)] - wide[random.choice(bad, count)]
    speed = np.zeros_like(ranker.weights)
    for _ in range(rounds):
        lose = 1 / (1 + np.exp(np.clip(apart @ ranker.weights, -30, 30)))
        slope = apart.T @ lose / count - ridge * ranker.weights
        speed = 0.9 * speed + slope
        ranker.weights = ranker.weights + 0.5 * speed
    strength = np.sort(wide @ ranker.weights)
    at = len(bad)  # the quantile of the bad share: as many below as there are bad labels
    ranker.threshold = float((strength[at - 1] + strength[min(at, len(strength) - 1)]) / 2)
    return ranker


@dataclass
class Cells:
    """Strengths in equal cells between bounds that no strength can leave."""

    low: float
    step: float

    @staticmethod
    def of(ranker: Ranker) -> Cells:
        plain, steps = ranker.weights[: len(ranker.mean)], ranker.weights[len(ranker.mean) :]
        reach = 4 * np.abs(plain).sum()  # plain features are clipped at 4, steps are 0 or 1
        low, high = np.minimum(steps, 0).sum() - reach, np.maximum(steps, 0).sum() + reach
        return Cells(float(low), max(float(high - low), 1e-9) / (CELLS - 1))

    def split(self, strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The grid point below, and how far a strength is towards the next one."""
        at = (strength - self.low) / self.step
        cell = np.clip(at.astype(np.int64), 0, CELLS - 2)
        return cell, np.clip(at - cell, 0, 1)

    def counts(self, strength: np.ndarray) -> np.ndarray:
        cell, share = self.split(strength)
        return np.bincount(cell, 1 - share, CELLS) + np.bincount(cell + 1, share, CELLS)

    def read(self, values: np.ndarray, strength: np.ndarray) -> np.ndarray:
        cell, share = self.split(strength)
        return values[cell] * (1 - share) + values[cell + 1] * share


def fit_all(blocks: RDD, good: int, bad: int, ridge: float = RIDGE, rounds: int = 50) -> Ranker:
    """Minimise the mean logistic loss over all pairs of blocks (x, y) by damped Newton steps."""
    count, width = good + bad, len(FEATURES)
    ranks = np.unique(np.concatenate(([0], quantile_ranks(count, STEPS))))
    edges = [np.unique(e).astype(np.float64) for e in order_statistics(blocks.map(lambda b: b[0]), [ranks] * width)]
    (total,) = added(blocks.map(lambda b: (b[0].astype(np.float64).sum(axis=0),)))
    mean = total / count
    (spread,) = added(blocks.map(lambda b: (((b[0] - mean) ** 2).sum(axis=0),)))
    ranker = Ranker(edges, mean, np.maximum(np.sqrt(spread / count), 1e-6), np.zeros(width + sum(map(len, edges))), 0.0)
    if not good or not bad:
        ranker.threshold = -30.0 if good else 30.0
        return ranker

    def placed(weights: np.ndarray) -> tuple[float, Ranker, Cells, np.ndarray, np.ndarray, np.ndarray]:
        """The loss at ``weights``, with what the next step needs: counts of good and bad strengths, and all pairs of cells."""
        own = Ranker(edges, mean, ranker.scale, weights, 0.0)
        cells = Cells.of(own)

        def counted(block: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            strength = own.strength(block[0].astype(np.float64))
            return cells.counts(strength[block[1] == 1]), cells.counts(strength[block[1] != 1])

        won, lost = (c / n for c, n in zip(added(blocks.map(counted)), (good, bad), strict=True))
        grid = np.arange(CELLS) * cells.step
        behind = grid[None, :] - grid[:, None]  # by how much the second cell is above the first
        return float(won @ np.logaddexp(0, behind) @ lost + ridge / 2 * weights @ weights), own, cells, won, lost, behind

    at = placed(ranker.weights)
    for _ in range(rounds):
        loss, own, cells, won, lost, behind = at
        chance = 1 / (1 + np.exp(-np.clip(behind, -500, 500)))
        curve = chance * (1 - chance)
        slopes, bends = (-(chance @ lost), won @ chance), (curve @ lost, won @ curve)

        def weighed(block: tuple[np.ndarray, np.ndarray], own: Ranker = own, cells: Cells = cells, slopes: tuple = slopes, bends: tuple = bends) -> tuple[np.ndarray, ...]:
            made = []
            for n, wanted in enumerate((block[1] == 1, block[1] != 1)):
                wide = own.expand(block[0][wanted].astype(np.float64))
                strength = wide @ own.weights
                coarse = cells.split(strength)[0] * COARSE // CELLS
                order = np.argsort(coarse, kind="stable")
                sums = np.zeros((COARSE, wide.shape[1]))
                kinds, first = np.unique(coarse[order], return_index=True)
                if len(kinds):
                    sums[kinds] = np.add.reduceat(wide[order], first, axis=0)
                bend = cells.read(bends[n], strength)
                made += [cells.read(slopes[n], strength) @ wide, (wide * bend[:, None]).T @ wide, sums]
            return tuple(made)

        g1, h1, f1, g0, h0, f0 = added(blocks.map(weighed))
        slope = g1 / good + g0 / bad + ridge * own.weights
        if np.abs(slope).max() < 1e-6:
            break
        middle = (np.arange(COARSE) + 0.5) * (CELLS // COARSE) * cells.step
        pair = 1 / (1 + np.exp(-np.clip(middle[None, :] - middle[:, None], -500, 500)))
        across = (f1 / good).T @ (pair * (1 - pair)) @ (f0 / bad)
        alone = h1 / good + h0 / bad + ridge * np.eye(len(slope))
        # coarse cells may leave a direction of no or negative curvature; without the pairs' part it bends upwards in all
        lowest = np.linalg.eigvalsh(alone - across - across.T)[0]
        whole = alone - across - across.T + max(0.0, ridge - lowest) * np.eye(len(slope))
        step = np.linalg.solve(whole, slope)
        size, then = 1.0, placed(own.weights - step)
        while then[0] > loss - 1e-4 * size * (slope @ step) and size > 1e-3:
            size /= 4
            then = placed(own.weights - size * step)
        if then[0] >= loss:
            break
        at = then
    ranker = at[1]
    # the quantile of the bad share: as many below as there are bad labels
    around = np.array([bad - 1, min(bad, count - 1)])
    strength = order_statistics(blocks.map(lambda b: ranker.strength(b[0].astype(np.float64))[:, None]), [around])[0]
    ranker.threshold = float(strength.astype(np.float64).mean())
    return ranker


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Ranker:
    """A ranker fitted on all labelled documents outside the held-out fold; ``docs`` may be measured already."""
    known = cut(labelled(measured(docs, key, text), labels.where(fold(key, FOLDS) != HELD), key, label), "labelled")
    count, good = known.agg(F.count(F.lit(1)), F.count(F.when(F.col("label") == 1, 1))).first()
    if not count:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    blocks = to_blocks(known, count, len(FEATURES))
    ranker = fit_all(blocks, good, count - good)
    blocks.unpersist()
    release(known)
    return ranker


def score(docs: DataFrame, ranker: Ranker, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every document."""
    seen = measured(docs, key, text).select(key, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranker.score(vectors(batch.column(1))))], names=[key, "score"])

    scored = seen.mapInArrow(run, f"`{key}` {dict(seen.dtypes)[key]}, score double")
    held = F.coalesce(fold(key, FOLDS) == HELD, F.lit(False))
    return scored.select(key, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cut(measured(table(spark, sf_dir, "documents").select("doc_id", "text")), "measured")
    return score(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))
