"""Hard-negative mining with vantage-point trees over norm-augmented vectors.

Vectors are quantised to integers, so scores (inner products) are exact. Each row gets one
more component that lifts its norm to the largest one; anchors get zero there. Then

    distance(anchor, row)^2 = |anchor|^2 + largest^2 - 2 * score

so the highest score is the nearest row, and a score window is a distance annulus.

* **Regions.** A vantage-point tree over a bounded hash sample of the rows (``SAMPLE``) cuts
  the space into at most ``REGIONS`` regions; every row is routed to one, and a region of more
  than ``SHARD`` rows (equal vectors can't be told apart) is dealt by hash into parts. Each
  part's least and greatest distances to ``PIVOTS`` sample rows are kept: they bound, through
  the triangle inequality, its distances to any anchor. That table is sent to all tasks in
  blocks of at most ``BOUND_ROWS`` parts.
* **Search.** A task holds one part, builds its vantage-point tree and streams the anchors sent to
  it, ``BLOCK`` at a time. Leaves are visited in slabs of some ``SLAB`` rows, those nearest to the block
  first, while they can hold a row that belongs among the best k of one of its anchors; leaves
  wholly outside its annuli are not read. The scores of a slab are one product of matrices.
* **Rounds.** The k rows of an anchor's own label in its nearest part bound the search for its
  positives in the others. The positives' scores then give each anchor its windows, and a part
  is visited if its bounds meet one of them.

The anchors (a stated query set) meet all rows: no list of candidates is capped. Where bounds
exclude little, as for vectors in no order at all, every anchor visits every part, in blocks.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component, take
no part, nor do vectors with a component of 2^21 or more after quantising (no exact products);
shorter vectors are filled with zeros; repeated rows count once, and of rows that share an id
the one with the smallest label, then vector, stands; an empty table gives no rows; a label of
one row has no positives, hence no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut, dimension, ship, table

SCALE = 256
LIMIT = 1 << 21
POSITIVES, NEGATIVES = 5, 3
ANCHORS = 50
#: A negative's score is between these percentages of the positive's.
LOW, HIGH = 50, 95
SAMPLE, REGIONS, PIVOTS = 8192, 1024, 16
SHARD, LEAST_SHARD, LEAF = 65_536, 2048, 128
BOUND_ROWS = 20_000
BATCH = 2000
#: Anchors and rows whose scores are taken at once; columns of a slab that share a maximum; a slab's scores over those looked at singly.
BLOCK, SLAB, GROUP, FEW = 512, 1024, 16, 50
#: Parts for each core where the table has enough rows: regions differ in size.
WAVES = 3
_ROW = "id bigint, label bigint, v array<int>"


def quantised(rows: DataFrame, key: str = "vec_id", label: str | Column = "label", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, label, v): the rows that take part, repeated ones once."""
    kind = F.col(label) if isinstance(label, str) else label
    raised = F.transform(F.col(vector), lambda x: x.cast("double") * scale)
    good = F.forall(raised, lambda x: F.coalesce(x.between(-LIMIT, LIMIT - 1), F.lit(False)))  # NaN is above all numbers
    kept = rows.where(F.col(key).isNotNull() & kind.isNotNull() & F.col(vector).isNotNull() & good)
    floor = F.transform(raised, lambda x: F.floor(x).cast("int"))
    return kept.select(F.col(key).cast("bigint").alias("id"), kind.cast("bigint").alias("label"), floor.alias("v"))


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of rows that share an id the one with the smallest label, then vector; only ids that repeat move their vectors."""
    repeated = cut(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    again = dimension(repeated)
    one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return cut(rows.join(again, "id", "left_anti").unionByName(one.select("id", "r.label", "r.v")), "vectors")


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of equal width, zeros where one is shorter."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    full = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    full[row, column] = flat
    return full


def augmented(points: np.ndarray, largest: float) -> np.ndarray:
    """One component more, which lifts every row's squared norm to ``largest``."""
    return np.column_stack((points, np.sqrt(np.maximum(0.0, largest - (points * points).sum(axis=1)))))


def _away(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances of every point to every row of ``to``."""
    square = (points * points).sum(axis=1)[:, None] + (to * to).sum(axis=1)[None, :] - 2.0 * points @ to.T
    return np.sqrt(np.maximum(0.0, square))


class VantageTree:
    """Points in leaves, with each leaf's range of distances to the vantage points on its path.

    A node splits its points at the median distance to one of them until ``leaf`` are left or
    all are equally far. An anchor's distances to the vantage points bound its distances to a
    leaf from below and above by the triangle inequality.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF, most_leaves: int | None = None) -> None:
        self.points = points
        vantages: list[int] = []
        self.nodes: list[tuple[int, float, int, int]] = []  # vantage, radius, child inside, child outside; negative: a leaf
        self.leaves: list[np.ndarray] = []
        ranges: list[list[tuple[int, float, float]]] = []
        if most_leaves:
            leaf = max(leaf, math.ceil(len(points) / most_leaves))
        todo: list[tuple[np.ndarray, list, int, int]] = [(np.arange(len(points)), [], -1, 0)]
        while todo:
            at, path, parent, side = todo.pop()
            name = None
            if len(at) > leaf:
                vantage = int(at[len(at) // 2])
                away = _away(points[at], points[vantage][None, :])[:, 0]
                radius = float(np.median(away))
                if radius >= away.max():  # half are as far as the farthest: those are outside
                    radius = float(np.nextafter(radius, -np.inf))
                inside = away <= radius
                if inside.any():
                    name = len(self.nodes)
                    vantages.append(vantage)
                    self.nodes.append((vantage, radius, 0, 0))
                    for part, kept in ((0, inside), (1, ~inside)):
                        held = away[kept]
                        todo.append((at[kept], [*path, (name, float(held.min()), float(held.max()))], name, part))
            if name is None:
                name = -1 - len(self.leaves)
                self.leaves.append(at)
                ranges.append(path)
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = name
                self.nodes[parent] = tuple(node)
        self.vantages = points[vantages] if vantages else np.empty((0, points.shape[1]))
        shape = (len(self.leaves), max(map(len, ranges)))
        self.path, self.least, self.most = np.zeros(shape, dtype=np.int64), np.full(shape, -np.inf), np.full(shape, np.inf)
        for i, path in enumerate(ranges):
            for at, step in enumerate(path):
                self.path[i, at], self.least[i, at], self.most[i, at] = step

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest possible distance of every anchor to each leaf's points."""
        away = _away(anchors, self.vantages)
        low, high = np.zeros((len(anchors), len(self.leaves))), np.full((len(anchors), len(self.leaves)), np.inf)
        for step in range(self.path.shape[1] if len(self.vantages) else 0):
            here = away[:, self.path[:, step]]
            np.maximum(low, self.least[:, step] - here, out=low)
            np.maximum(low, here - self.most[:, step], out=low)
            np.minimum(high, here + self.most[:, step], out=high)
        return low, high

    def route(self, points: np.ndarray) -> np.ndarray:
        """The leaf to which each point belongs."""
        found = np.zeros(len(points), dtype=np.int64)
        todo = [(0 if self.nodes else -1, np.arange(len(points)))]
        while todo:
            name, at = todo.pop()
            if name < 0:
                found[at] = -1 - name
            elif len(at):
                vantage, radius, inside, outside = self.nodes[name]
                near = _away(points[at], self.points[vantage][None, :])[:, 0] <= radius
                todo += [(inside, at[near]), (outside, at[~near])]
        return found


def distance_bounds(away: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the distance to each group, from the anchor's distances to points and the groups' ranges of distances to them."""
    if not least.shape[1]:
        return np.zeros(len(least)), np.full(len(least), np.inf)
    low = np.maximum(least - away, away - most).max(axis=1)
    return np.maximum(0.0, low), (most + away).min(axis=1)


@dataclass(frozen=True)
class Wanted:
    """What an anchor wants of a part: the best ``k`` rows of its own or of other labels with scores from ``low`` to ``high``."""

    slot: int
    low: float
    high: float
    same: bool
    k: int


class Part:
    """One part's rows, their tree, and the nearest-first search through it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, largest: float) -> None:
        order = np.lexsort((labels, ids))
        self.ids, self.labels, points = ids[order], labels[order], points[order]
        self.largest = largest
        self.tree = VantageTree(augmented(points, largest))
        # no sum of products exceeds the largest squared norm, and floats hold whole numbers below 2^24
        self.points = points.astype(np.float32 if largest < 1 << 24 else np.float64)
        self.scored = 0  # scores taken

    def search(self, own_id: int, own_label: int, anchor: np.ndarray, wanted: Sequence[Wanted]) -> list[tuple[int, int, int]]:
        """(slot, row, score) of the best rows of every window of one anchor."""
        low, high = np.array([[w.low for w in wanted]], dtype=np.float64), np.array([[w.high for w in wanted]], dtype=np.float64)
        _, slots, rows, scores = self.search_block(np.array([own_id]), np.array([own_label]), anchor[None, :], low, high, wanted[0].same, wanted[0].k)
        return [(wanted[s].slot, row, score) for s, row, score in zip(slots.tolist(), rows.tolist(), scores.tolist(), strict=True)]

    def search_block(self, own_ids: np.ndarray, own_labels: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, row, score) of the best ``k`` rows of every window; ``low`` and ``high`` have a row for each anchor.

        A window whose ``low`` is infinite is none.
        """
        square = (anchors * anchors).sum(axis=1)[:, None] + self.largest
        slack = 1e-7 * (np.sqrt(square) + 1.0)
        near, far = self.tree.bounds(np.column_stack((anchors, np.zeros(len(anchors)))))
        # a distance's score, with room for rounding
        top = np.floor((square - np.maximum(0.0, near - slack) ** 2) / 2.0 + 1e-6)
        bottom = np.where(np.isfinite(far), np.ceil((square - (far + slack) ** 2) / 2.0 - 1e-6), -np.inf)
        best = np.full((*low.shape, k), -np.inf)
        row = np.full((*low.shape, k), len(self.ids))  # rows are in the order of ids
        least = low.copy()  # what a score must reach, for each window
        asked = anchors.astype(self.points.dtype)
        for leaves in self._slabs(top, high):
            live = (top[:, leaves].max(axis=1)[:, None] >= least) & (bottom[:, leaves].min(axis=1)[:, None] <= high)
            a = np.flatnonzero(live.any(axis=1))
            if not len(a):
                continue
            leaves = leaves[(top[np.ix_(a, leaves)] >= least[a].min(axis=1)[:, None]).any(axis=0)]
            at = np.sort(np.concatenate([self.tree.leaves[leaf] for leaf in leaves.tolist()]))
            scores = asked[a] @ self.points[at].T
            self.scored += scores.size
            # most slabs hold few scores that any window of their anchor could take: those are looked at one by one
            few = np.flatnonzero(scores >= np.where(live[a], least[a], np.inf).min(axis=1)[:, None].astype(scores.dtype))
            if len(few) * FEW <= scores.size:
                r, c = np.divmod(few, len(at))
                fits = (self.labels[at[c]] == own_labels[a[r]]) == same
                if same:
                    fits &= self.ids[at[c]] != own_ids[a[r]]
                r, c = r[fits], c[fits]
                score = scores[r, c].astype(np.float64)
                for w in range(low.shape[1]):
                    fits = (score >= least[a[r], w]) & (score <= high[a[r], w])
                    self._merge(a[r[fits]], at[c[fits]], score[fits], w, best, row, least)
                continue
            away = (self.labels[at] == own_labels[a][:, None]) != same
            if same:
                away |= self.ids[at] == own_ids[a][:, None]
            scores[away] = -np.inf
            for w in range(low.shape[1]):
                b = np.flatnonzero(live[a, w])
                if len(b):
                    r, c, score = self._highest(scores if len(b) == len(a) else scores[b], least[a[b], w], high[a[b], w], k)
                    self._merge(a[b[r]], at[c], score, w, best, row, least)
        anchor, window, place = np.nonzero(best > -np.inf)
        return anchor, window, row[anchor, window, place], best[anchor, window, place].astype(np.int64)

    def _slabs(self, top: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
        """The leaves, those first that are nearest to the anchors' windows, some ``SLAB`` rows at a time."""
        order = np.argsort(-np.minimum(top, high.max(axis=1)[:, None]).mean(axis=0), kind="stable")
        rows = np.cumsum([len(self.tree.leaves[leaf]) for leaf in order.tolist()])
        yield from np.split(order, np.flatnonzero(np.diff((rows - 1) // SLAB)) + 1)

    @staticmethod
    def _highest(scores: np.ndarray, least: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, score) of some scores from ``least`` to ``high``, among them the best k of every row."""
        if (scores.max(axis=1) > high).any():
            scores = np.where(scores <= high[:, None], scores, -np.inf)
        groups = scores.shape[1] // GROUP
        if groups >= k:  # the k-th largest maximum of groups of columns is a bound that k scores reach
            most = scores[:, : groups * GROUP].reshape(len(scores), GROUP, groups).max(axis=1)
            least = np.maximum(least, np.partition(most, groups - k, axis=1)[:, groups - k])
        fits = scores >= least[:, None].astype(scores.dtype)
        if np.count_nonzero(fits) > 4 * k * len(scores):  # of many equal scores the first k do
            equal = fits & (scores == least[:, None])
            fits &= ~equal | (np.cumsum(equal, axis=1, dtype=np.int32) <= k)
        r, c = np.nonzero(fits)
        return r, c, scores[r, c].astype(np.float64)

    @staticmethod
    def _merge(whose: np.ndarray, at: np.ndarray, score: np.ndarray, w: int, best: np.ndarray, row: np.ndarray, least: np.ndarray) -> None:
        """Puts scores of anchors ``whose`` among the best of their window ``w``, where they belong there."""
        if not len(whose):
            return
        n, k = np.unique(whose), best.shape[2]
        whose = np.concatenate((whose, np.repeat(n, k)))
        score = np.concatenate((score, best[n, w].ravel()))
        at = np.concatenate((at, row[n, w].ravel()))
        order = np.lexsort((at, -score, whose))
        chosen = order[np.searchsorted(whose[order], n)[:, None] + np.arange(k)]  # every anchor has its former k at least
        best[n, w], row[n, w] = score[chosen], at[chosen]
        least[n, w] = np.maximum(least[n, w], best[n, w, k - 1])


@dataclass(frozen=True)
class Space:
    """The routing tree and pivots of a corpus: bounded by ``SAMPLE`` rows whatever its size."""

    width: int
    largest: float
    tree: VantageTree
    pivots: np.ndarray


def fitted_space(rows: DataFrame, shards: int) -> Space:
    """Width, largest norm and a routing tree over a hash sample of at most ``SAMPLE`` rows."""
    norm = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x)
    about = rows.agg(F.max(F.size("v")), F.max(norm)).first()
    width, largest = about[0] or 0, float(about[1] or 0)
    picked = rows.orderBy(F.xxhash64("id", "label", F.lit(5)), "id", "label", "v").limit(SAMPLE).select("v").toArrow()
    points = augmented(matrix(picked.column(0), width), largest) if picked.num_rows else np.zeros((0, width + 1))
    tree = VantageTree(points, 1, most_leaves=max(1, min(shards, REGIONS)))
    return Space(width, largest, tree, points[:PIVOTS])


def dealt_parts(rows: DataFrame, space: Space, shard: int) -> tuple[DataFrame, DataFrame]:
    """(rows with region and part, bounds): every row in its region, regions over ``shard`` rows in parts.

    ``bounds`` has the ranges of distances to the pivots for every part. ``task`` numbers the parts.
    """
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = augmented(matrix(batch.column(2), space.width), space.largest)
            away = pa.array(list(_away(points, space.pivots)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(space.tree.route(points)), away], names=["id", "label", "v", "region", "away"])

    routed = cut(rows.mapInArrow(run, f"{_ROW}, region bigint, away array<double>"), "routed")
    sizes = routed.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / F.lit(shard)).cast("bigint")
    before = Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)  # at most REGIONS rows
    many = sizes.select("region", parts.alias("parts")).withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)))
    dealt = routed.join(F.broadcast(many), "region").withColumn("part", F.pmod(F.xxhash64("id", "label", "v"), "parts"))
    dealt = dealt.withColumn("task", (F.col("first") + F.col("part")).cast("int")).drop("parts", "first")
    dealt = cut(dealt, "dealt")
    ends = [f(F.get("away", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(len(space.pivots)) for f in (F.min, F.max)]
    ranges = dealt.groupBy("region", "part", "task").agg(*(ends or [F.count(F.lit(1)).alias("n")]))
    least = F.array(*[F.col(f"min{i}") for i in range(len(space.pivots))])
    most = F.array(*[F.col(f"max{i}") for i in range(len(space.pivots))])
    return dealt.drop("away"), cut(ranges.select("region", "part", "task", least.cast("array<double>").alias("least"), most.cast("array<double>").alias("most")), "bounds")


def _bound_blocks(bounds: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(names, least, most) of the parts, ``BOUND_ROWS`` at a time."""
    count = bounds.count()
    blocks = max(1, math.ceil(count / BOUND_ROWS))
    for i in range(blocks):
        held = (bounds.where(F.pmod(F.xxhash64("region", "part"), F.lit(blocks)) == i) if blocks > 1 else bounds).orderBy("region", "part").toArrow()
        if held.num_rows:
            names = np.column_stack([held.column(c).to_numpy() for c in ("region", "part", "task")])
            yield names, np.array(held.column("least").to_pylist()), np.array(held.column("most").to_pylist())


_VISIT = "anchor bigint, own bigint, av array<int>, slots array<struct<slot:int,low:bigint,high:bigint>>, region bigint, part bigint, task int"


def visits(anchors: DataFrame, bounds: DataFrame, space: Space, nearest: bool = False) -> DataFrame:
    """The parts that each anchor must visit: those whose bounds meet one of its windows, or (of each block) the one that may be nearest.

    ``anchors`` is (anchor, own, av, slots, seen): ``seen`` are parts visited already.
    """
    made = None
    for names, least, most in _bound_blocks(bounds):

        def run(batches: Iterator[pa.RecordBatch], names=names, least=least, most=most) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = matrix(batch.column("av"), space.width)
                away = _away(np.column_stack((points, np.zeros(len(points)))), space.pivots)
                slots, seen = batch.column("slots").to_pylist(), batch.column("seen").to_pylist()
                known = {tuple(n[:2]): j for j, n in enumerate(names.tolist())}
                rows, to = [], []
                for i in range(len(points)):
                    near, far = distance_bounds(away[i], least, most)
                    square = float(points[i] @ points[i]) + space.largest
                    slack = 1e-7 * (math.sqrt(square) + 1.0)
                    if nearest:
                        chosen = np.argmin(near)[None]
                    else:
                        top = np.floor((square - np.maximum(0.0, near - slack) ** 2) / 2.0 + 1e-6)
                        bottom = np.where(np.isfinite(far), np.ceil((square - (far + slack) ** 2) / 2.0 - 1e-6), -np.inf)
                        meets = np.zeros(len(names), dtype=bool)
                        for s in slots[i]:
                            meets |= (top >= s["low"]) & (bottom <= s["high"])
                        for s in seen[i]:
                            if (at := known.get((s["region"], s["part"]))) is not None:
                                meets[at] = False
                        chosen = np.flatnonzero(meets)
                    rows += [i] * len(chosen)
                    to += chosen.tolist()
                    if len(rows) >= BATCH:
                        yield _sent(batch, rows, names[to])
                        rows, to = [], []
                if rows:
                    yield _sent(batch, rows, names[to])

        found = anchors.mapInArrow(run, _VISIT)
        made = found if made is None else made.unionByName(found)
    return made if made is not None else anchors.sparkSession.createDataFrame([], _VISIT)


def _sent(batch: pa.RecordBatch, rows: list[int], to: np.ndarray) -> pa.RecordBatch:
    taken = batch.select(["anchor", "own", "av", "slots"]).take(pa.array(rows))
    return pa.RecordBatch.from_arrays([*taken.columns, pa.array(to[:, 0]), pa.array(to[:, 1]), pa.array(to[:, 2], pa.int32())], names=["anchor", "own", "av", "slots", "region", "part", "task"])


def _windows(slots: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, low, high), a row for each anchor; the low end of missing windows is infinite."""
    sizes = slots.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    shape = (len(sizes), max(1, int(sizes.max())))
    slot, low, high = np.zeros(shape, dtype=np.int32), np.full(shape, np.inf), np.full(shape, -np.inf)
    for into, name in ((slot, "slot"), (low, "low"), (high, "high")):
        into[row, column] = slots.flatten().field(name).to_numpy()
    return slot, low, high


_FOUND = "anchor bigint, own bigint, slot int, id bigint, label bigint, score bigint, region bigint, part bigint"


def searched(dealt: DataFrame, sent: DataFrame, space: Space, tasks: int, same: bool, k: int) -> DataFrame:
    """The best k rows of every window in every visited part.

    A part is a task. Its rows come first and make the tree; its anchors stream past.
    """
    no_slots = F.lit(None).cast("array<struct<slot:int,low:bigint,high:bigint>>")
    rows = dealt.select("region", "part", "task", F.lit(0).alias("kind"), "id", "label", "v", no_slots.alias("slots"))
    asked = sent.select("region", "part", "task", F.lit(1).alias("kind"), F.col("anchor").alias("id"), F.col("own").alias("label"), F.col("av").alias("v"), "slots")
    both = rows.join(F.broadcast(sent.select("task").distinct()), "task", "left_semi").select(*rows.columns).unionByName(asked)
    names = [c.split(" ")[0] for c in _FOUND.split(", ")]
    types = [pa.int32() if n == "slot" else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, part = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("region", "part", "kind")])
            edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                region, at, kind = keys[start].tolist()
                if kind == 0:
                    if now != (region, at):
                        now, held, part = (region, at), [], None
                    piece = batch.slice(start, end - start)
                    held.append((piece.column("id").to_numpy(), piece.column("label").to_numpy(), matrix(piece.column("v"), space.width)))
                    continue
                if part is None:
                    part = Part(*[np.concatenate(x) for x in zip(*held, strict=True)], space.largest)
                    held = []
                for first in range(start, end, BLOCK):
                    piece = batch.slice(first, min(BLOCK, end - first))
                    ids, own = piece.column("id").to_numpy(), piece.column("label").to_numpy()
                    slot, low, high = _windows(piece.column("slots"))
                    a, w, row, score = part.search_block(ids, own, matrix(piece.column("v"), space.width), low, high, same, k)
                    if len(a):
                        here = [np.full(len(a), region), np.full(len(a), at)]
                        found = [ids[a], own[a], slot[a, w], part.ids[row], part.labels[row], score, *here]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types, strict=True)], names=names)

    return both.repartitionById(max(1, tasks), "task").sortWithinPartitions("region", "part", "kind").mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("anchor", "own", "slot").orderBy(F.desc("score"), "id", "label")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    key: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    anchors: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = (LOW, HIGH),
    shard: int = SHARD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors (all rows by default).

    A shard holds at most about ``shard`` rows; small tables get ``WAVES`` for each core.
    """
    spark = rows.sparkSession
    ready = one_per_id(cut(quantised(rows, key, label, vector), "vectors"))
    count = ready.count()
    cores = spark.sparkContext.defaultParallelism
    shards = max(math.ceil(count / shard), min(WAVES * cores, math.ceil(count / LEAST_SHARD)), 1)
    space = fitted_space(ready, shards)
    dealt, bounds = dealt_parts(ready, space, shard)
    tasks = bounds.count()
    whole = F.array(F.struct(F.lit(0).alias("slot"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    chosen = F.col("id") % ANCHORS == 0 if anchors is None else anchors
    asked = cut(ready.where(chosen).select(F.col("id").alias("anchor"), F.col("label").alias("own"), F.col("v").alias("av")), "anchors")
    nowhere = F.array().cast("array<struct<region:bigint,part:bigint>>")
    home = cut(visits(asked.select("*", whole.alias("slots"), nowhere.alias("seen")), bounds, space, nearest=True), "home")
    first = cut(searched(dealt, home, space, tasks, True, positives), "first")
    # the weakest of a full set bounds the others; the part need not be searched again
    ranked = _best(first, positives)
    least = ranked.groupBy("anchor", "own").agg(F.when(F.count(F.lit(1)) == positives, F.min("score")).alias("least"))
    seen = home.groupBy("anchor", "own").agg(F.collect_list(F.struct("region", "part")).alias("seen"))  # one for each block of bounds
    bounded = asked.join(seen, ["anchor", "own"]).join(least, ["anchor", "own"], "left")
    slots = F.array(F.struct(F.lit(0).alias("slot"), F.coalesce("least", F.lit(-(1 << 62))).alias("low"), F.lit(1 << 62).alias("high")))
    others = bounded.select("anchor", "own", "av", slots.alias("slots"), "seen")
    rest = searched(dealt, cut(visits(others, bounds, space), "visits"), space, tasks, True, positives)
    best = cut(_best(first.unionByName(rest), positives), "positives")
    low = F.ceil(F.col("score") * percent[0] / F.lit(100)).cast("bigint")
    high = F.floor(F.col("score") * percent[1] / F.lit(100)).cast("bigint")
    window = F.struct(F.col("rank").alias("slot"), low.alias("low"), high.alias("high"))
    wanted = best.withColumn("w", window).where("w.low <= w.high").groupBy("anchor", "own").agg(F.array_sort(F.collect_list("w")).alias("slots"))
    sent = asked.join(wanted, ["anchor", "own"]).select("anchor", "own", "av", "slots", nowhere.alias("seen"))
    found = _best(searched(dealt, cut(visits(sent, bounds, space), "visits"), space, tasks, False, negatives), negatives)
    pairs = found.select("anchor", "own", F.col("slot").alias("at"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.select("anchor", "own", F.col("rank").alias("at"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    made = pairs.join(named, ["anchor", "own", "at"])
    return made.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), label=moved)


ORACLE = f"""
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id AS id, r.label, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM good a, good r WHERE a.vec_id % {ANCHORS} = 0 AND r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> own AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= {NEGATIVES}
"""
