"""Boosted trees of a search, grown by tasks that keep their rows.

The trees are those of MLlib's ``GBTClassifier`` for the same seed: the same thresholds,
rows, features of a node, gains and leaves. MLlib starts two stages for every level of
every tree and cannot add trees to a finished fit. Here the rows are put into bins once
for all fits of a search, one byte a value, and a fit is one stage: its tasks hold the
bins and the margins of their rows, sum a node's cells in numpy and exchange only those
sums. Up to ``TASK_ROWS`` rows a fit is one task, with as many fits side by side as there
are cores; beyond, its partitions are dealt over the tasks of a barrier stage.
"""

from __future__ import annotations

import base64
import math
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, BarrierTaskContext, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import store

# The functions of this module travel to the executors with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Trees without gain on the validation rows after which boosting ends.
PATIENCE = 30
# Rows of a fit that one task may hold, at some 100 bytes each, before the cluster's other cores share in it.
# An exchange between tasks takes Spark a second (it looks for the answer once a second), so few tasks are best.
TASK_ROWS = 6_000_000
# Rows whose cells are summed at a time, and values below which all features are summed in one go.
STEP_ROWS = 1_000_000
SMALL_NODE = 1 << 16
# Bytes of sums that all tasks of a fit together exchange at a time.
EXCHANGED = 16 << 20
# MLlib's fixed values: memory of the nodes that are split together, rows that thresholds are found on, least impurity.
GROUP_BYTES = 256 << 20
THRESHOLD_ROWS = 10_000
EPSILON = 2.0**-52

BLOCKS = "part int, piece int, n int, labels binary, bins binary"


def kept_trees(curve: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The tree of the least loss so far once ``patience`` more trees brought none below it, and whether that came about."""
    best, at = math.inf, 1
    for k, loss in enumerate(curve, 1):
        if loss < best:
            best, at = loss, k
        elif k - at >= patience:
            return at, True
    return at, False


# --- the random numbers of Java and Spark ----------------------------------------------

WORD = (1 << 64) - 1


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


def _murmur(data: bytes, seed: int) -> int:
    def rotated(x: int, by: int) -> int:
        return (x << by | x >> (32 - by)) & 0xFFFFFFFF

    h = seed
    for i in range(0, len(data), 4):
        k = rotated(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15)
        h = rotated(h ^ k * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    """The first state of Spark's ``XORShiftRandom``."""
    data = (seed & WORD).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


class XorShift:
    """Spark's ``XORShiftRandom``, number by number."""

    def __init__(self, seed: int):
        self.state = hashed_seed(seed)

    def bits(self, n: int) -> int:
        s = self.state
        s ^= s << 21 & WORD
        s ^= s >> 35
        self.state = s = s ^ (s << 4 & WORD)
        return s & (1 << n) - 1

    def uniform(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


class JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return _signed(self.state >> 16, 32)

    def long(self) -> int:
        return _signed((self.int() << 32) + self.int(), 64)


LANE = 256


class Uniforms:
    """The numbers of :class:`XorShift` for many rows at once.

    A step is linear over bits, so its 256th, 512th, ... power is a table look-up by
    bytes. The sequence is cut into lanes of 256 steps, whose first states are found by
    doubling; then all lanes take each step together.
    """

    def __init__(self):
        images = np.uint64(1) << np.arange(64, dtype=np.uint64)
        self._step(images, np.empty_like(images))
        self.jumps = [self._table(images)]
        for _ in range(LANE.bit_length() - 1):
            self.jumps = [self._squared(self.jumps[0])]

    @staticmethod
    def _step(state: np.ndarray, spare: np.ndarray) -> None:
        np.left_shift(state, np.uint64(21), out=spare)
        state ^= spare
        np.right_shift(state, np.uint64(35), out=spare)
        state ^= spare
        np.left_shift(state, np.uint64(4), out=spare)
        state ^= spare

    @staticmethod
    def _table(images: np.ndarray) -> np.ndarray:
        """What becomes of each byte at each place, from what becomes of each bit."""
        table = np.zeros((8, 256), np.uint64)
        for bit in range(8):
            has = np.arange(256) >> bit & 1 == 1
            table[:, has] ^= images[bit::8, None]
        return table

    @staticmethod
    def _applied(table: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = np.zeros_like(state)
        for place in range(8):
            out ^= table[place][(state >> np.uint64(8 * place) & np.uint64(255)).astype(np.intp)]
        return out

    def _squared(self, table: np.ndarray) -> np.ndarray:
        bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
        return self._table(self._applied(table, self._applied(table, bits)))

    def __call__(self, seed: int, n: int) -> np.ndarray:
        """The first ``n`` numbers between 0 and 1 that follow from a seed."""
        lanes = -(-2 * n // LANE)
        state = np.array([hashed_seed(seed)], np.uint64)
        k = 0
        while len(state) < lanes:
            if k == len(self.jumps):
                self.jumps.append(self._squared(self.jumps[-1]))
            state = np.concatenate([state, self._applied(self.jumps[k], state)])
            k += 1
        state = state[:lanes].copy()
        spare, out = np.empty_like(state), np.empty((LANE // 2, lanes))
        for row in out:
            self._step(state, spare)
            high = (state & np.uint64((1 << 26) - 1)) << np.uint64(27)
            self._step(state, spare)
            np.multiply(high + (state & np.uint64((1 << 27) - 1)), 2.0**-53, out=row)
        return out.T.ravel()[:n]


def drawn_features(draw: JavaRandom, features: int, per_node: int) -> list[int]:
    """The features a node may be split by: a reservoir sample, in the order of its places."""
    chosen = list(range(per_node))
    if per_node < features:
        random = XorShift(draw.long())
        for item in range(per_node, features):
            place = int(random.uniform() * (item + 1))
            if place < per_node:
                chosen[place] = item
    return chosen


# --- thresholds and bins ---------------------------------------------------------------


def thresholds(sample: np.ndarray, rows: int, bins: int) -> list[np.ndarray]:
    """MLlib's thresholds of each feature, from a sample (or all) of ``rows`` rows."""
    most = min(bins, rows) - 1
    expected = min(max(bins * bins, THRESHOLD_ROWS) / rows, 1.0) * rows
    out = []
    for values in sample.T:
        some, counts = np.unique(values[values != 0.0], return_counts=True)
        counts = counts.astype(float)
        seen = counts.sum()
        if len(some) and expected - seen > EPSILON * seen * 100:
            at = np.searchsorted(some, 0.0)
            some, counts = np.insert(some, at, 0.0), np.insert(counts, at, expected - seen)
        middles = (some[:-1] + some[1:]) / 2.0
        if len(middles) > most:
            chosen, stride = [], expected / (most + 1)
            target, before = stride, counts[0]
            for k, count in enumerate(counts[1:].tolist()):
                if abs(before - target) < abs(before + count - target):
                    chosen.append(k)
                    target += stride
                before += count
            middles = middles[chosen]
        out.append(middles)
    return out


def _binned(limits: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = np.uint8 if max(map(len, limits)) < 256 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for piece, batch in enumerate(b for b in batches if b.num_rows):
            x, y = (batch.column(c) for c in ("x", "label"))
            x, y = x.flatten().to_numpy().reshape(len(x), -1), y.to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():
                raise ValueError("a feature that is not a finite number")
            if not np.isin(y, [0.0, 1.0]).all():
                raise ValueError("a label that is neither 0 nor 1")
            bins = np.stack([np.searchsorted(t, v) for t, v in zip(limits, x.T)]).astype(kind)
            row = {"part": part, "piece": piece, "n": len(y), "labels": y.astype(np.int8).tobytes(), "bins": bins.tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                *((c, pa.int32()) for c in ("part", "piece", "n")), ("labels", pa.binary()), ("bins", pa.binary())
            ]))

    return run


class Dealt(NamedTuple):
    """Binned rows of a search, keyed by the task of a fit that holds them."""

    rows: RDD
    tasks: int
    at_once: int
    splits: list[int]


def slots(context) -> int:
    """Tasks that the cluster runs at once."""
    java = context._jsc.sc()
    return max(1, java.maxNumConcurrentTasks(java.resourceProfileManager().defaultResourceProfile()))


def gangs(context) -> bool:
    """Whether stages may start all their tasks at once, which Spark refuses while executors come and go."""
    asked = context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true"
    return not asked or context.master == "local" or context.master.startswith("local[")


def deal(train: DataFrame, val: DataFrame, vector: str, bins: int, seed: int) -> Dealt | None:
    """Bin all rows once and deal the partitions over the tasks of a fit; None where a fit needs a barrier stage that Spark refuses."""
    context = train.sparkSession.sparkContext
    points = [df.select(F.col("label").cast("double").alias("label"), vector_to_array(vector).alias("x")) for df in (train, val)]
    rows = points[0].count()
    if not rows:
        raise ValueError("no rows to learn from")
    free, least = slots(context), -(-rows // TASK_ROWS)
    if least > 1 and not gangs(context):
        return None
    sample = points[0].select("x")
    share = max(bins * bins, THRESHOLD_ROWS) / rows
    if share < 1:
        picked = sample._jdf.toJavaRDD().sample(False, share, _signed(XorShift(seed).bits(32), 32))
        sample = DataFrame(sample.sparkSession._jsparkSession.createDataFrame(picked, sample._jdf.schema()), sample.sparkSession)
    limits = thresholds(np.array([r.x for r in sample.collect()], float), rows, bins)
    # Each part by itself: partitions are numbered as MLlib numbers them.
    stored = [store(p.mapInArrow(_binned(limits), BLOCKS)).withColumn("is_val", F.lit(k == 1)) for k, p in enumerate(points)]
    blocks = stored[0].unionByName(stored[1])
    sizes = blocks.groupBy("is_val", "part").agg(F.sum("n").alias("n")).collect()
    at_once = max(1, free // least) if least > 1 else free
    tasks = 1 if least == 1 else min(free // at_once, sum(not r.is_val for r in sizes))
    # The largest parts first, each to the task that holds least.
    task, held = {}, {kind: [0] * tasks for kind in (False, True)}
    for r in sorted(sizes, key=lambda r: (-r.n, r.is_val, r.part)):
        at = held[r.is_val].index(min(held[r.is_val]))
        held[r.is_val][at] += r.n
        task[r.is_val, r.part] = at
    keyed = blocks.rdd.map(lambda r: (task[r.is_val, r.part], (r.is_val, r.part, r.piece, r.n, bytes(r.labels), bytes(r.bins))))
    return Dealt(keyed.partitionBy(tasks, int), tasks, at_once, [len(t) for t in limits])


# --- growing ---------------------------------------------------------------------------


class Part:
    """The rows of a partition: bins by feature, labels as -1 and 1, margins so far."""

    def __init__(self, number: int, blocks: Sequence[tuple[int, bytes, bytes]], features: int):
        self.number = number
        self.sign = np.concatenate([np.frombuffer(y, np.int8) for _, y, _ in blocks]) * 2.0 - 1.0
        kind = np.uint8 if len(blocks[0][2]) == blocks[0][0] * features else np.int32
        self.bins = np.concatenate([np.frombuffer(x, kind).reshape(features, n) for n, _, x in blocks], axis=1)
        self.margin = np.zeros(len(self.sign))


class Node(NamedTuple):
    """A node still to be split: its place in the tree, (count, sum, sum of squares) once known, rows and targets by part."""

    number: int
    level: int
    stats: np.ndarray | None
    rows: list[tuple[np.ndarray, np.ndarray]]


class Tree(NamedTuple):
    """Feature (-1 at leaves), last bin that goes left, left child (the right one comes next) and value of each node."""

    feature: list[int]
    last: list[int]
    left: list[int]
    value: list[float]

    def add(self, stats: np.ndarray | None = None) -> int:
        for column, x in zip(self, (-1, 0, 0, _mean(stats))):
            column.append(x)
        return len(self.feature) - 1

    def values(self, bins: np.ndarray) -> np.ndarray:
        """What each row is given."""
        out = np.full(bins.shape[1], self.value[0])
        pending: list = [(0, None)] if self.feature[0] >= 0 else []
        while pending:
            node, rows = pending.pop()
            own = bins[self.feature[node]]
            goes_left = (own if rows is None else own.take(rows)) <= self.last[node]
            for child, goes in ((self.left[node], goes_left), (self.left[node] + 1, ~goes_left)):
                at = np.flatnonzero(goes)
                at = at if rows is None else rows.take(at)
                if self.feature[child] >= 0:
                    pending.append((child, at))
                else:
                    out[at] = self.value[child]
        return out


def _mean(stats: np.ndarray | None) -> float:
    return float(stats[1] / stats[0]) if stats is not None and stats[0] else 0.0


def _variance(stats: np.ndarray) -> np.ndarray:
    n, total, squares = stats
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (squares - total * total / n) / n)


def _cells(parts: Sequence[Part], node: Node, features: Sequence[int], width: int) -> np.ndarray:
    """Count, sum and sum of squares of a node's rows by feature and bin; part by part, as they come."""
    out = np.zeros((3, max(1, len(features)), width))
    for part, (rows, targets) in zip(parts, node.rows):
        for a in range(0, len(rows), STEP_ROWS):
            some, y = rows[a : a + STEP_ROWS], targets[a : a + STEP_ROWS]
            weights = (None, y, y * y)
            if not features:
                keys = np.zeros(len(some), np.intp)
                for k, w in enumerate(weights):
                    out[k] += np.bincount(keys, w, width)
            elif len(some) * len(features) <= SMALL_NODE:
                keys = (part.bins[np.ix_(features, some)] + np.arange(0, len(features) * width, width)[:, None]).ravel()
                for k, w in enumerate(weights):
                    w = None if w is None else np.broadcast_to(w, (len(features), len(w))).ravel()
                    out[k] += np.bincount(keys, w, len(features) * width).reshape(-1, width)
            else:
                for i, f in enumerate(features):
                    keys = part.bins[f].take(some).astype(np.intp)
                    for k, w in enumerate(weights):
                        out[k, i] += np.bincount(keys, w, width)
    return out


def _best(cells: np.ndarray, splits: np.ndarray, stats: np.ndarray | None, params: dict) -> tuple:
    """The first split of the greatest gain as (gain, place of the feature, last bin, left and right sums), and the node's sums."""
    if not len(splits):
        return (-math.inf,), cells[:, 0, 0]
    sums = np.cumsum(cells, axis=2)
    left = sums[:, :, :-1]
    right = sums[:, :, -1:] - left
    stats = left[:, 0, 0] + right[:, 0, 0] if stats is None else stats
    n_left, n_right = left[0], right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        n = n_left + n_right
        gain = _variance(stats) - n_left / n * _variance(left) - n_right / n * _variance(right)
    least = params["minInstancesPerNode"]
    out = (np.arange(left.shape[2]) >= splits[:, None]) | (n_left < least) | (n_right < least) | (gain < params["minInfoGain"])
    gain[out] = -math.inf
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    return (gain[i, j], i, j, left[:, i, j], right[:, i, j]), stats


Gather = Callable[[np.ndarray], np.ndarray]


def grow(parts: Sequence[Part], root: Node, splits: Sequence[int], params: dict, seed: int, gather: Gather, tasks: int) -> Tree:
    """One regression tree by variance; nodes are taken from a stack in groups, as MLlib does."""
    tree, draw, stack = Tree([], [], [], []), JavaRandom(seed), [root]
    tree.add()
    width, share = max(splits) + 1, params["featureSubsetStrategy"]
    per_node = len(splits) if share == "all" else math.ceil(float(share) * len(splits))
    while stack:
        group, used = [], 0
        while stack:
            chosen = drawn_features(draw, len(splits), per_node)
            size = 24 * sum(splits[f] + 1 for f in chosen)
            if used and used + size > GROUP_BYTES:
                break
            group.append((stack.pop(), [f for f in chosen if splits[f]]))
            used += size
        together = max(1, EXCHANGED // (24 * tasks * per_node * width))
        for a in range(0, len(group), together):
            some = group[a : a + together]
            cells = [_cells(parts, node, features, width) for node, features in some]
            whole = gather(np.concatenate([c.ravel() for c in cells]))
            for (node, features), own in zip(some, cells):
                found, whole = whole[: own.size].reshape(own.shape), whole[own.size :]
                (gain, *split), stats = _best(found, np.array([splits[f] for f in features]), node.stats, params)
                tree.value[node.number] = _mean(stats)
                if gain <= 0 or node.level == params["maxDepth"]:
                    continue
                _divide(parts, tree, node, features[split[0]], int(split[1]), split[2:], params["maxDepth"], stack)
    return tree


def _divide(parts: Sequence[Part], tree: Tree, node: Node, feature: int, last: int, stats: Sequence[np.ndarray], depth: int, stack: list[Node]) -> None:
    """Give a node its children; those that may be split go on the stack with their rows."""
    children = [tree.add(s) for s in stats]
    tree.feature[node.number], tree.last[node.number], tree.left[node.number] = feature, last, children[0]
    open_ = [node.level + 1 < depth and abs(_variance(s)) >= EPSILON for s in stats]
    if any(open_):
        goes_left = [part.bins[feature].take(rows) <= last for part, (rows, _) in zip(parts, node.rows)]
        for number, s, is_open, is_left in zip(children, stats, open_, (True, False)):
            if is_open:
                places = [np.flatnonzero(g if is_left else ~g) for g in goes_left]
                own = [(rows.take(at), y.take(at)) for at, (rows, y) in zip(places, node.rows)]
                stack.append(Node(number, node.level + 1, s, own))


def _residuals(part: Part) -> np.ndarray:
    """What the next tree is fitted to. Arrow's exponential is the C library's, which Java's all but always equals; numpy's is not."""
    return 4.0 * part.sign / (1.0 + pc.exp(pa.array(2.0 * part.sign * part.margin)).to_numpy())


def boosted(
    blocks: Iterable[tuple], params: dict, splits: Sequence[int], seed: int, patience: int, first: int, gather: Gather, tasks: int
) -> list[float]:
    """The validation log loss after each tree, for as many trees as the doubling numbers of ``first`` on take to find the end."""
    found: dict[tuple[bool, int], list] = {}
    for is_val, part, piece, *block in blocks:
        found.setdefault((is_val, part), []).append((piece, *block))
    sets: dict[bool, list[Part]] = {False: [], True: []}
    for is_val, part in sorted(found):
        own = [block[1:] for block in sorted(found.pop((is_val, part)))]
        sets[is_val].append(Part(part, own, len(splits)))
    train, val = sets[False], sets[True]
    uniforms, rate = Uniforms(), params["subsamplingRate"]
    curve: list[float] = []
    while True:
        many = min(params["maxIter"], max(first, 2 * len(curve)))
        losses = np.zeros(many - len(curve) + 1)
        losses[-1] = sum(len(p.sign) for p in val)
        for k in range(len(curve), many):
            held = []
            for p in train:
                y = p.sign if k == 0 else _residuals(p)
                n = len(y)
                rows = np.arange(n, dtype=np.int32) if rate == 1.0 else np.flatnonzero(uniforms(seed + k + p.number + 1, n) < rate).astype(np.int32)
                held.append((rows, y.take(rows)))
            tree = grow(train, Node(0, 0, None, held), splits, params, seed + k, gather, tasks)
            for p in (*train, *val):
                p.margin += tree.values(p.bins) * (params["stepSize"] if k else 1.0)
            losses[k - len(curve)] = sum(float(np.logaddexp(0.0, -2.0 * p.sign * p.margin).sum()) for p in val)
        *sums, rows = gather(losses)
        curve += [float(s / rows) if rows else math.nan for s in sums]
        if kept_trees(curve, patience)[1] or many == params["maxIter"]:
            return curve


def fit(dealt: Dealt, params: dict, seed: int, patience: int, first: int) -> list[float]:
    """Boost in one stage; see :func:`boosted`."""
    splits, tasks = dealt.splits, dealt.tasks

    def alone(rows: Iterator[tuple]) -> Iterator[list[float]]:
        yield boosted((r[1] for r in rows), params, splits, seed, patience, first, lambda x: x, 1)

    def together(rows: Iterator[tuple]) -> Iterator[list[float]]:
        context = BarrierTaskContext.get()

        def gather(own: np.ndarray) -> np.ndarray:
            said = context.allGather(base64.b64encode(zlib.compress(own.tobytes(), 1)).decode())
            return sum(np.frombuffer(zlib.decompress(base64.b64decode(m))) for m in said)

        curve = boosted((r[1] for r in rows), params, splits, seed, patience, first, gather, tasks)
        if context.partitionId() == 0:
            yield curve

    stage = dealt.rows.mapPartitions(alone) if tasks == 1 else dealt.rows.barrier().mapPartitions(together)
    return stage.collect()[0]
