"""Growth of forests from binned rows: large nodes by counts, small ones from their own rows.

Spark ML sums the split statistics of every node over all tasks, however few
rows a node has, so deep levels cost far more than their rows.  Here only nodes
of more than ``NODE_ROWS`` rows are split that way, level by level.  The rows of
each smaller node are then dealt to one group, which holds no more than that,
and the rest of the tree below it is grown there.  Feature values are dealt as
the numbers of their bins.

What is grown is what Spark ML's estimator with the same parameters grows:
Poisson bagging, a fresh draw of features a node, best drop of variance or Gini
impurity over binned splits, smallest leaf and depth limit.

A forest stays a stored table of one row a tree.  Rows are scored there: blocks
of them meet each tree in some task, and the trees' values are added by block.
Neither the driver nor a task holds more than one tree.  The same table is
written in the form in which Spark ML saves its models, and is loaded as its
model only for who asks for that.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.ml.util import MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_at_exit, reach, scratch_path
from ..sources.sinks import materialize

# Most rows of a node that is grown in one group; rows of a task that deals
# them, and (row, tree) pairs of a task that grows.
NODE_ROWS = 1 << 19
ROWS_PER_TASK = 1 << 13
PAIRS_PER_TASK = 1 << 18
# Rows and nodes whose splits are counted at once: their cells stay in the cache.
PIECE_ROWS = 1 << 13
PIECE_NODES = 1 << 7
# (row, tree) pairs of a task that scores.
PAIRS_SCORED = 1 << 21
# Levels that rows go down before those in a leaf are left out.
WALKED_LEVELS = 4
# Nodes listed at once for Spark ML's form.
LISTED_NODES = 1 << 16
# Ranks that the split points of a feature of many values are chosen from.
RANKS = 1024

NODE = {
    "tree": pa.int32(), "node": pa.int64(), "n": pa.float64(), "s": pa.float64(), "q": pa.float64(),
    "feature": pa.int32(), "bin": pa.int32(), "gain": pa.float64(), "n_left": pa.float64(),
}
NODE_DDL = (
    "tree int, node long, n double, s double, q double, feature int, bin int, gain double, n_left double"
)
DEALT = "tree int, node long, bins binary, times binary, label binary"
PACKED = {k: pa.binary() for k in ("n", "s", "q", "gain", "value", "feature", "bin", "left")}
PACKED_KINDS = {"feature": np.int16, "bin": np.uint8, "left": np.int32}
PACKED_DDL = "tree int, " + ", ".join(f"{k} binary" for k in PACKED)
NUMBERED = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
    "rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


@dataclass(frozen=True)
class Growth:
    """What the growth of a forest depends on besides the rows.

    ``weights`` are those of the classes of a binary label.
    """

    trees: int
    seed: int
    depth: int
    leaf: int
    features: int
    subset: int
    bins: int
    memory_mb: int
    weights: tuple[float, float] | None = None

    def sums(self, n, s):
        """(weight, value sum) of nodes with ``n`` rows and label sum ``s``."""
        if self.weights is None:
            return n, s
        return self.weights[0] * (n - s) + self.weights[1] * s, self.weights[1] * s


def mixed(*keys) -> np.ndarray:
    """64 well mixed bits for each combination of integer keys (splitmix64)."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for key in keys:
            h = (np.asarray(key).astype(np.uint64) ^ h) + np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
# By the first 12 bits of a draw; 255 where those do not settle it.
FIRST_BITS = np.searchsorted(POISSON, np.arange(4097) / 4096, side="right").astype(np.uint8)
FIRST_BITS = np.where(FIRST_BITS[:-1] == FIRST_BITS[1:], FIRST_BITS[:-1], np.uint8(255))


def drawn(growth: Growth, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often a tree takes each row: Poisson with mean 1, fixed by seed, tree and row."""
    bits = mixed(growth.seed, tree, ids)
    times = FIRST_BITS.take(bits >> np.uint64(52))
    rest = np.flatnonzero(times == 255)
    uniform = (bits[rest] >> np.uint64(11)) * 2.0**-53
    times[rest] = np.searchsorted(POISSON, uniform, side="right")
    return times


def chosen(growth: Growth, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The features that each node may split by, in order."""
    if growth.subset == growth.features:
        return np.tile(np.arange(growth.features), (len(node), 1))
    draws = mixed(growth.seed + 1, tree, node)[:, None]
    keys = mixed(draws, np.arange(growth.features)[None, :])
    return np.sort(np.argpartition(keys, growth.subset - 1, axis=1)[:, : growth.subset], axis=1)


def histograms(growth: Growth, at, size: int, bins, pairs, features) -> np.ndarray:
    """(node, feature, bin): rows, and label sums as imaginary parts, of ``size`` nodes.

    ``at`` is each row's node.  Both sums are added in one pass a feature, whose
    indices fit the cache.
    """
    sums = np.zeros((size, growth.subset, growth.bins), complex)
    cells, flat = sums.reshape(-1), bins.reshape(-1)
    base = at * (growth.subset * growth.bins)
    start = np.arange(len(at)) * growth.features
    for feature in np.ascontiguousarray(features.T):
        places = feature.take(at, mode="clip")
        places += start
        found = base + flat.take(places, mode="clip")
        np.add.at(cells, found, pairs)
        base += growth.bins
    return sums


def paired(times, label) -> np.ndarray:
    """How often rows are taken, and their label sums as imaginary parts."""
    pairs = np.empty(len(times), complex)
    pairs.real = times
    pairs.imag = pairs.real * label
    return pairs


def purity(growth: Growth, n, s):
    """Weight, and value sum squared over it; not a number where there are no rows."""
    weight, value = growth.sums(n, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        return weight, value * value / weight


def impurity(growth: Growth, n, s, q):
    """Variance, or Gini impurity of two classes."""
    weight, pure = purity(growth, n, s)
    whole = growth.sums(n, s)[1] if growth.weights else q
    return np.maximum((whole - pure) / weight, 0.0) * (2 if growth.weights else 1)


def best_splits(growth: Growth, sums: np.ndarray, features, n, s, q):
    """(feature, last bin on the left, gain, rows on the left) of each node; feature -1 where none gains.

    Only cuts behind a bin with rows that leave enough on both sides are
    weighed; one behind an empty bin is that behind the last bin before it.
    """
    size, subset, bins = sums.shape
    left = np.cumsum(sums, axis=2)
    able = (left.real >= growth.leaf) & (left.real <= n[:, None, None] - growth.leaf) & (sums.real > 0)
    able[..., -1] = False
    cuts = np.flatnonzero(able)
    node = cuts // (subset * bins)
    counts = np.bincount(node, minlength=size)
    some = np.flatnonzero(counts)
    feature, cut, best, n_left = np.full(size, -1), np.full(size, -1), np.full(size, -1.0), np.zeros(size)
    if not len(some):
        return feature, cut, best, n_left
    left = left.reshape(-1).take(cuts)
    right_n, right_s = n[node] - left.real, s[node] - left.imag
    gain = purity(growth, left.real, left.imag)[1] + purity(growth, right_n, right_s)[1]
    counts = counts[some]
    most = np.maximum.reduceat(gain, np.cumsum(counts) - counts)
    # The first of equals, by feature and bin.
    tops = np.flatnonzero(gain == np.repeat(most, counts))
    tops = tops[np.searchsorted(node[tops], some)]
    weight, before = purity(growth, n[some], s[some])
    drop = (most - before) / weight * (2 if growth.weights else 1)
    gains = drop > 1e-12 * np.maximum(impurity(growth, n[some], s[some], q[some]), 1e-3)
    some, tops = some[gains], tops[gains]
    slot, last = np.divmod(cuts[tops] - some * (subset * bins), bins)
    feature[some], cut[some], best[some], n_left[some] = features[some, slot], last, drop[gains], left.real[tops]
    return feature, cut, best, n_left


def level_of(node: np.ndarray) -> np.ndarray:
    """Nodes are numbered 1, then 2n and 2n + 1 below n."""
    return np.frexp(np.asarray(node).astype(np.float64))[1] - 1


def pieces(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of nodes that lie side by side and are split at once."""
    ends = np.cumsum(counts)
    start = 0
    while start < len(counts):
        done = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, done + PIECE_ROWS, side="right"))
        stop = min(max(stop, start + 1), start + PIECE_NODES)
        yield start, stop
        start = stop


def subtree(growth: Growth, tree: int, root: int, bins, times, label) -> dict[str, np.ndarray]:
    """Columns of ``NODE``: all nodes from ``root`` down, grown level by level from its rows.

    The rows of a node lie side by side on every level.  Its bins move only
    when it may split.
    """
    found = []
    pairs = paired(times, label)
    # Labels of classes are 0 and 1, so their squares' sums are their sums.
    square = None if growth.weights else pairs.imag * label
    order, bins = np.arange(len(times)), np.ascontiguousarray(bins)
    nodes, counts = np.array([root], np.int64), np.array([len(times)])
    while len(nodes):
        size = len(nodes)
        first = np.cumsum(counts) - counts
        n, s = np.add.reduceat(pairs.real, first), np.add.reduceat(pairs.imag, first)
        q = s if square is None else np.add.reduceat(square, first)
        feature, cut, gain = np.full(size, -1), np.full(size, -1), np.full(size, -1.0)
        left = np.zeros(size)
        able = (n >= 2 * growth.leaf) & (impurity(growth, n, s, q) > 1e-15) & (level_of(nodes) < growth.depth)
        if able.any():
            # Only rows of nodes that may split go on.
            if not able.all():
                rows = np.flatnonzero(np.repeat(able, counts))
                order, pairs = order.take(rows, mode="clip"), pairs.take(rows, mode="clip")
                square = None if square is None else square.take(rows, mode="clip")
                counts = counts[able]
            bins = bins.take(order, axis=0, mode="clip")
            ends = np.cumsum(counts)
            features = chosen(growth, np.array([tree]), nodes[able])
            best = []
            for a, b in pieces(counts):
                at, own = np.repeat(np.arange(b - a), counts[a:b]), features[a:b]
                begin = int(ends[a] - counts[a])
                sums = 0.0
                for low in range(0, len(at), PIECE_ROWS):
                    part, rows = slice(low, low + PIECE_ROWS), slice(begin + low, min(begin + low + PIECE_ROWS, ends[b - 1]))
                    sums = sums + histograms(growth, at[part], b - a, bins[rows], pairs[rows], own)
                part = [v[able][a:b] for v in (n, s, q)]
                best.append(best_splits(growth, sums, own, *part))
            feature[able], cut[able], gain[able], left[able] = (np.concatenate(c) for c in zip(*best))
        found.append([np.full(size, tree), nodes, n, s, q, feature, cut, gain, left])
        split = feature >= 0
        if not split.any():
            break
        own = split[able]
        rows = np.arange(len(order)) if own.all() else np.flatnonzero(np.repeat(own, counts))
        counts, feature, cut = counts[own], feature[split], cut[split]
        at = np.repeat(np.arange(len(counts)), counts)
        right = bins.reshape(-1).take(rows * growth.features + feature.take(at, mode="clip"), mode="clip") > cut.take(at, mode="clip")
        goes_right = np.add.reduceat(right.astype(np.int64), np.cumsum(counts) - counts)
        # Left children of all nodes come first, then the right ones; rows keep their order.
        order = np.concatenate([rows[~right], rows[right]])
        counts = np.concatenate([counts - goes_right, goes_right])
        nodes = np.concatenate([2 * nodes[split], 2 * nodes[split] + 1])
        pairs, square = pairs.take(order, mode="clip"), None if square is None else square.take(order, mode="clip")
    return {k: np.concatenate(c) for k, c in zip(NODE, zip(*found))}


class Top:
    """Splits of the large nodes, by tree; leads rows to the node they are in."""

    def __init__(self, rows: list[dict]):
        self.splits: dict[int, dict] = {}
        for r in rows:
            if r["feature"] >= 0:
                self.splits.setdefault(r["tree"], {})[r["node"]] = r["feature"], r["bin"]
        self.tables: dict[int, tuple] = {}

    def reached(self, tree: int) -> np.ndarray:
        """The nodes of a tree down to the children of the large ones, children side by side."""
        return self._table(tree)[0]

    def _table(self, tree: int) -> tuple:
        if tree not in self.tables:
            own, nodes, steps = self.splits.get(tree, {}), [1], []
            for k, node in enumerate(nodes):
                # Rows stay in a node without a split: no bin is above 255.
                steps.append((*own[node], len(nodes)) if node in own else (0, 255, k))
                nodes += [2 * node, 2 * node + 1] if node in own else []
            nodes = np.array(nodes, np.int64)
            feature, cut, left = (np.array(c, np.int64) for c in zip(*steps))
            self.tables[tree] = nodes, feature, cut.astype(np.uint8), left, int(level_of(nodes[-1]))
        return self.tables[tree]

    def lead(self, tree: int, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each of ``rows`` the place of its node among those reached."""
        _, feature, cut, left, depth = self._table(tree)
        at, flat, start = np.zeros(len(rows), np.int64), bins.reshape(-1), rows * bins.shape[1]
        for _ in range(depth):
            right = flat.take(start + feature.take(at)) > cut.take(at)
            at = left.take(at) + right
        return at


def unpacked(batch: pa.RecordBatch, features: int):
    """(row ids, labels, bins) of stored rows."""
    bins = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, features)
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), bins


def split_points(data: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` split points for each feature.

    A feature of few values is split between any two of them.  Others are split
    at ranks, where a value that fills many bins counts for one, so that the
    rest are still told apart.
    """
    distinct = data.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if distinct[c] <= bins]
    known = data.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first() if few else {}
    few = [c for c in few if len(known[c]) <= bins]
    many = [c for c in columns if c not in few]
    ranks = data.approxQuantile(many, [k / RANKS for k in range(RANKS + 1)], 1 / (4 * RANKS)) if many else []
    points = {}
    for c in few:
        values = np.array(known[c])
        points[c] = (values[:-1] + values[1:]) / 2
    for c, found in zip(many, ranks):
        values, weight = np.unique(found, return_counts=True)
        weight = weight.astype(float)
        for _ in range(8):
            weight = np.minimum(weight, weight.sum() / bins)
        group = np.ceil(np.cumsum(weight) / weight.sum() * bins - 1e-9)
        last = np.flatnonzero(np.diff(group))
        points[c] = values[last][: bins - 1]
    return [points[c] for c in columns]


def binned_rows(data: DataFrame, label: str, features: str, size: int, bins: int) -> tuple[DataFrame, list, int]:
    """Stored (id, label, bins), the split points and the number of rows."""
    columns = [f"x{k}" for k in range(size)]
    # The array of a vector is made once, not for each of its elements.
    arrays = data.select(F.col(label).cast("double").alias("label"), vector_to_array(F.col(features)).alias("x"))
    rows = data.count()
    spread = materialize(arrays.repartition(max(1, -(-rows // ROWS_PER_TASK))), "arrays")
    points = split_points(spread.select(*[F.col("x")[k].alias(c) for k, c in enumerate(columns)]), columns, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            found = np.stack([np.searchsorted(p, x[:, k]) for k, p in enumerate(points)], axis=1).astype(np.uint8)
            packed = pa.array([r.tobytes() for r in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["label", "bins"])

    found = spread.mapInArrow(run, "label double, bins binary")
    stored = materialize(found.select(F.monotonically_increasing_id().alias("id"), "label", "bins"), "binned")
    return stored, points, rows


def large_nodes(stored: DataFrame, growth: Growth, rows: int, limit: int) -> list[dict]:
    """Rows of ``NODE`` of all nodes that more than ``limit`` rows reach, and their splits.

    Tasks count their rows by node, feature and bin; counts are added and the
    best split is found by node.  Only that comes to the driver.
    """
    found: list[dict] = []
    open_nodes = [(t, 1) for t in range(growth.trees)] if rows > limit else []
    at_once = max(1, (growth.memory_mb << 20) // (growth.subset * growth.bins * 16))
    while open_nodes:
        below = []
        for start in range(0, len(open_nodes), at_once):
            taken = open_nodes[start : start + at_once]
            top = Top(found)

            def count(batches, taken=taken, top=top):
                own = {}
                for k, (t, node) in enumerate(taken):
                    own.setdefault(t, {})[node] = k
                features = chosen(growth, *np.array(taken, np.int64).T)
                shape = (len(taken), growth.subset, growth.bins)
                sums, squares = np.zeros(shape, complex), np.zeros(len(taken))
                places = {t: np.array([nodes.get(n, -1) for n in top.reached(t).tolist()]) for t, nodes in own.items()}
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    ids, label, bins = unpacked(batch, growth.features)
                    for t, nodes in own.items():
                        times = drawn(growth, t, ids)
                        rows = np.flatnonzero(times)
                        place = places[t].take(top.lead(t, bins, rows))
                        hit = np.flatnonzero(place >= 0)
                        if not len(hit):
                            continue
                        first = min(nodes.values())
                        rows, place = rows.take(hit), place.take(hit) - first
                        part = slice(first, first + len(nodes))
                        y = label.take(rows)
                        pairs = paired(times.take(rows), y)
                        sums[part] += histograms(growth, place, len(nodes), bins.take(rows, axis=0), pairs, features[part])
                        squares[part] += np.bincount(place, pairs.imag * y, len(nodes))
                for k, (t, node) in enumerate(taken):
                    if sums[k].any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([t], pa.int32()),
                                pa.array([node], pa.int64()),
                                pa.array([sums[k].tobytes()], pa.binary()),
                                pa.array([squares[k]]),
                            ],
                            ["tree", "node", "sums", "q"],
                        )

            def split(table: pa.Table) -> pa.Table:
                tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
                sums = sum(np.frombuffer(b, complex) for b in table.column("sums").to_pylist())
                sums = sums.reshape(1, growth.subset, growth.bins)
                n, s = sums.real[:, 0].sum(axis=1), sums.imag[:, 0].sum(axis=1)
                q = np.array([sum(table.column("q").to_pylist())])
                features = chosen(growth, np.array([tree]), np.array([node]))
                own = best_splits(growth, sums, features, n, s, q)
                if level_of(np.array([node]))[0] >= growth.depth or impurity(growth, n, s, q)[0] <= 1e-15:
                    own = (np.array([-1]), np.array([-1]), np.array([-1.0]), np.zeros(1))
                columns = ([tree], [node], n, s, q, *own)
                return pa.table({k: pa.array(c).cast(kind) for (k, kind), c in zip(NODE.items(), columns)})

            counted = stored.mapInArrow(count, "tree int, node long, sums binary, q double")
            rows_of = counted.groupBy("tree", "node").applyInArrow(split, NODE_DDL).collect()
            below += [r.asDict() for r in rows_of]
        found += below
        open_nodes = sorted(
            (r["tree"], child)
            for r in below
            if r["feature"] >= 0
            for child, n in ((2 * r["node"], r["n_left"]), (2 * r["node"] + 1, r["n"] - r["n_left"]))
            if n > limit
        )
    return found


def grown_nodes(stored: DataFrame, growth: Growth, rows: int, limit: int) -> DataFrame:
    """Columns of ``NODE`` for every node of every tree."""
    spark = stored.sparkSession
    large = large_nodes(stored, growth, rows, limit)
    top, ends = Top(large), {}
    for r in large:
        if r["feature"] < 0:
            ends.setdefault(r["tree"], []).append(r["node"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, label, bins = unpacked(batch, growth.features)
            for t in range(growth.trees):
                times, reached = drawn(growth, t, ids), top.reached(t)
                rows = np.flatnonzero(times)
                at = top.lead(t, bins, rows)
                # Small keys are sorted by their digits; rows of a node keep their order.
                order = np.argsort(at.astype(np.uint16) if len(reached) <= 1 << 16 else at, kind="stable")
                counts = np.bincount(at, minlength=len(reached))
                if t in ends:
                    closed = np.isin(reached, ends[t])
                    order = order[~closed.take(at.take(order))]
                    counts[closed] = 0
                some = np.flatnonzero(counts)
                if not len(some):
                    continue
                rows, stops = rows.take(order), np.concatenate([[0], np.cumsum(counts[some])])

                def parts(values, stops=stops) -> pa.Array:
                    width = values.strides[0]
                    return pa.Array.from_buffers(
                        pa.binary(), len(stops) - 1, [None, pa.py_buffer((stops * width).astype(np.int32)), pa.py_buffer(values)]
                    )

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), t, np.int32)),
                        pa.array(reached[some]),
                        *[parts(values.take(rows, axis=0)) for values in (bins, times, label)],
                    ],
                    ["tree", "node", "bins", "times", "label"],
                )

    def grow(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        bins, times, label = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
            for c, kind in (("bins", np.uint8), ("times", np.uint8), ("label", np.float64))
        )
        found = subtree(growth, tree, node, bins.reshape(-1, growth.features), times, label)
        return pa.table({k: pa.array(found[k]).cast(kind) for k, kind in NODE.items()})

    tasks = max(1, -(-rows * growth.trees // PAIRS_PER_TASK))
    dealt = stored.mapInArrow(deal, DEALT).repartition(tasks, "tree", "node")
    small = dealt.groupBy("tree", "node").applyInArrow(grow, NODE_DDL)
    return small.unionByName(spark.createDataFrame([tuple(r[k] for k in NODE) for r in large], NODE_DDL))


def pruned(node: np.ndarray, inner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes that stay, inner ones): leaves side by side with one prediction become one, as Spark ML has it.

    ``node`` is in order.
    """
    inner, stays, level = inner.copy(), np.ones(len(node), bool), level_of(node)
    for depth in range(int(level[-1]) - 1, -1, -1):
        own = np.flatnonzero(inner & (level == depth))
        left = np.searchsorted(node, 2 * node[own])
        same = ~inner[left] & ~inner[left + 1] & (value[left] == value[left + 1])
        inner[own[same]] = False
        stays[left[same]] = stays[left[same] + 1] = False
    return stays, inner


def packed(nodes: DataFrame, growth: Growth) -> DataFrame:
    """One row a tree: columns of its nodes as bytes, parents before their children, a right child behind its left one."""

    def run(table: pa.Table) -> pa.Table:
        c = {k: table.column(k).to_numpy() for k in NODE}
        order = np.argsort(c["node"])
        c = {k: v[order] for k, v in c.items()}
        weight, positive = growth.sums(c["n"], c["s"])
        label = (2 * positive > weight) if growth.weights else positive / weight
        stays, inner = pruned(c["node"], c["feature"] >= 0, label)
        c = {k: v[stays] for k, v in c.items()}
        inner = inner[stays]
        columns = {
            **{k: c[k] for k in ("n", "s", "q")},
            "gain": np.where(inner, c["gain"], -1.0),
            # The mean, or the probability of class 1.
            "value": (positive / weight)[stays],
            "feature": np.where(inner, c["feature"], -1),
            "bin": np.where(inner, c["bin"], 0),
            "left": np.where(inner, np.searchsorted(c["node"], 2 * c["node"]), -1),
        }
        data = {k: pa.array([v.astype(PACKED_KINDS.get(k, np.float64)).tobytes()], pa.binary()) for k, v in columns.items()}
        return pa.table({"tree": pa.array([c["tree"][0]], pa.int32()), **data})

    return nodes.groupBy("tree").applyInArrow(run, PACKED_DDL)


def unpacked_trees(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(tree, its columns) of packed trees."""
    for k in range(batch.num_rows):
        own = {c: batch.column(c)[k].as_py() for c in columns}
        kinds = {c: PACKED_KINDS.get(c, np.float64) for c in columns}
        yield batch.column("tree")[k].as_py(), {c: np.frombuffer(v, kinds[c]) for c, v in own.items()}


def numbered(trees: DataFrame, weights: tuple | None, points: list[np.ndarray], first: int) -> DataFrame:
    """Nodes of packed trees as Spark ML's models list them; trees are numbered from ``first``."""
    # Split points of all features in a row, and where each feature's begin.
    starts = np.cumsum([0, *map(len, points)])[:-1]
    cuts = np.concatenate([np.zeros(0), *points])

    def struct(**fields) -> pa.StructArray:
        return pa.StructArray.from_arrays(list(fields.values()), list(fields))

    def lists(ends, values) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))

    def part(tree: int, start: int, c: dict[str, np.ndarray]) -> pa.RecordBatch:
        size, inner = len(c["n"]), c["feature"] >= 0
        if weights:
            stats = np.stack([weights[0] * (c["n"] - c["s"]), weights[1] * c["s"]], axis=1)
            value = stats.argmax(axis=1).astype(float)
            share = c["value"]
            spread = 2 * share * (1 - share)
        else:
            stats, value = np.stack([c["n"], c["s"], c["q"]], axis=1), c["value"]
            spread = np.maximum((c["q"] - c["s"] * c["value"]) / c["n"], 0.0)
        feature, left = c["feature"].astype(np.int32), c["left"]
        split = struct(
            featureIndex=pa.array(feature),
            leftCategoriesOrThreshold=lists(
                np.concatenate([[0], np.cumsum(inner)]), cuts[starts[feature[inner]] + c["bin"][inner]]
            ),
            numCategories=pa.array(np.full(size, -1), pa.int32()),
        )
        data = struct(
            id=pa.array(np.arange(start, start + size), pa.int32()),
            prediction=pa.array(value),
            impurity=pa.array(spread),
            impurityStats=lists(np.arange(size + 1) * stats.shape[1], stats.ravel()),
            rawCount=pa.array(c["n"].astype(np.int64)),
            gain=pa.array(c["gain"]),
            leftChild=pa.array(left),
            rightChild=pa.array(np.where(inner, left + 1, -1), pa.int32()),
            split=split,
        )
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, tree - first), pa.int32()), data], ["treeID", "nodeData"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, c in unpacked_trees(batch, *PACKED):
                for low in range(0, len(c["n"]), LISTED_NODES):
                    yield part(tree, low, {k: v[low : low + LISTED_NODES] for k, v in c.items()})

    return trees.mapInArrow(run, NUMBERED)


def subset_size(estimator, features: int) -> int:
    """Features a node, as Spark ML reads ``featureSubsetStrategy``."""
    name = estimator.getFeatureSubsetStrategy()
    if name == "auto":
        classes = isinstance(estimator, RandomForestClassifier)
        name = "all" if estimator.getNumTrees() == 1 else "sqrt" if classes else "onethird"
    shares = {"all": features, "sqrt": math.sqrt(features), "onethird": features / 3, "log2": math.log2(features)}
    share = shares[name] if name in shares else int(name) if name.isdigit() else float(name) * features
    return max(1, min(features, math.ceil(share)))


def _write_model(estimator, nodes: DataFrame, size: int, trees: int, path: str) -> None:
    """Spark ML's saved form of a model of these nodes."""
    spark = nodes.sparkSession
    classes = isinstance(estimator, RandomForestClassifier)
    family = "classification.{}Classification" if classes else "regression.{}Regression"
    estimator = estimator.copy().setNumTrees(trees)

    def metadata(name: str, **more) -> str:
        own = {p.name: v for p, v in estimator._paramMap.items()}
        default = {p.name: v for p, v in estimator._defaultParamMap.items()}
        if name == "DecisionTree":
            forest = {"numTrees", "featureSubsetStrategy", "bootstrap", "subsamplingRate"}
            own, default = ({k: v for k, v in d.items() if k not in forest} for d in (own, default))
        return json.dumps(
            {
                "class": f"org.apache.spark.ml.{family.format(name)}Model",
                "timestamp": 0,
                "sparkVersion": spark.version,
                "uid": f"{estimator.uid}{more.pop('suffix', '')}",
                "paramMap": own,
                "defaultParamMap": default,
                **more,
            }
        )

    whole = {"numFeatures": size, **({"numClasses": 2} if classes else {})}
    text = metadata("RandomForest", **whole, numTrees=trees)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(k, metadata("DecisionTree", suffix=f"_{k}", **whole), 1.0) for k in range(trees)]
    each = spark.createDataFrame(each, "_1 int, _2 string, _3 double")
    each.coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes.write.parquet(f"{path}/data")


class Part(Transformer, MLWritable):
    """Some trees of a grown forest, as a stage that saves and scores as Spark ML's model of them."""

    def __init__(self, grown: Grown, estimator, first: int):
        super().__init__()
        self.grown, self.estimator, self.first, self.loaded = grown, estimator, first, None
        self._resetUid(estimator.uid)

    @property
    def trees(self) -> int:
        return self.estimator.getNumTrees()

    def save_model(self, path: str) -> None:
        g = self.grown
        own = g.trees.where(F.col("tree").between(self.first, self.first + self.trees - 1))
        # A task lists some megabytes of trees.
        own = own.repartition(max(1, min(self.trees, g.nodes * self.trees // (g.count * LISTED_NODES))), "tree")
        listed = numbered(own, g.weights, g.points, self.first)
        _write_model(self.estimator, listed, len(g.points), self.trees, path)

    # Params reads all attributes but properties when a stage is made.
    @property
    def model(self):
        """Spark ML's model, by way of its saved form; the driver holds it."""
        if self.loaded is None:
            self.loaded = self._load()
        return self.loaded

    def _load(self):
        classes = isinstance(self.estimator, RandomForestClassifier)
        kind = RandomForestClassificationModel if classes else RandomForestRegressionModel
        spark = self.grown.trees.sparkSession
        path = scratch_path(spark, "forest")
        delete_at_exit(spark, path)
        self.save_model(path)
        return kind.load(path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)

    def write(self) -> MLWriter:
        return PartWriter(self)


class PartWriter(MLWriter):
    def __init__(self, part: Part):
        super().__init__()
        self.part = part

    def saveImpl(self, path: str) -> None:
        self.part.save_model(path)


@dataclass(frozen=True)
class Grown:
    """A forest as a stored table of packed trees, and what is known of it as a whole.

    ``shift``: the value of a tree is taken as a whole number of 2 ** -shift, so
    that sums over the trees are exact in any order.
    """

    trees: DataFrame
    count: int
    nodes: int
    shift: int
    points: list
    importances: list
    weights: tuple | None = None

    def record(self) -> dict:
        """All but the table, as plain values."""
        own = {k: getattr(self, k) for k in ("count", "nodes", "shift", "importances", "weights")}
        return {**own, "points": [[float(v) for v in p] for p in self.points]}

    @classmethod
    def of(cls, trees: DataFrame, record: dict) -> Grown:
        points = [np.array(p, np.float64) for p in record["points"]]
        return cls(trees, **{**record, "points": points})

    @classmethod
    def summed(cls, trees: DataFrame, growth: Growth, points: list) -> Grown:
        """The same of trees just grown: a row a tree comes to the driver."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, c in unpacked_trees(batch, "n", "s", "gain", "value", "feature"):
                    inner = c["feature"] >= 0
                    share = growth.sums(c["n"], c["s"])[0][inner] * c["gain"][inner]
                    share = np.bincount(c["feature"][inner], share, growth.features)
                    columns = [[tree], [len(inner)], [np.abs(c["value"]).max()], [share.tolist()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(columns, (pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())))],
                        ["tree", "nodes", "most", "shares"],
                    )

        rows = sorted(trees.mapInArrow(run, "tree int, nodes long, most double, shares array<double>").collect())
        # As Spark ML: each tree's shares add up to 1, and so do all trees'.
        total = sum(np.array(r["shares"]) / (sum(r["shares"]) or 1.0) for r in rows)
        bits = math.frexp(max(r["most"] for r in rows))[1] + len(rows).bit_length()
        return cls(
            trees, len(rows), sum(r["nodes"] for r in rows), 62 - bits, points,
            (total / (total.sum() or 1.0)).tolist(), growth.weights,
        )

    def scores(self, rows: DataFrame, column: str) -> DataFrame:
        """(id, ``column``): the mean of the trees for stored rows of (id, features).

        Rows go as blocks of bin numbers to every tree.  A task takes the trees
        dealt to it one after the other, each before the blocks that meet it.
        """
        points, size, shift, count = self.points, len(self.points), self.shift, self.count
        reach(rows.sparkSession)

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    ids = batch.column(0).to_numpy()
                    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                    bins = np.stack([np.searchsorted(p, x[:, k]) for k, p in enumerate(points)], axis=1).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[:1]), pa.array([len(ids)], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in (ids, bins)]],
                        ["block", "n", "ids", "bins"],
                    )

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    tree = batch.slice(k, 1)
                    if tree.column("block")[0].as_py() is None:
                        own = next(unpacked_trees(tree, "value", "feature", "bin", "left"))[1]
                        worth = np.rint(np.ldexp(own["value"], shift)).astype(np.int64)
                        # Rows stay in a leaf: no bin is above 255.
                        leaf = own["feature"] < 0
                        feature = np.where(leaf, 0, own["feature"]).astype(np.int64)
                        cut = np.where(leaf, 255, own["bin"]).astype(np.uint8)
                        left = np.where(leaf, np.arange(len(leaf)), own["left"])
                        continue
                    bins = np.frombuffer(tree.column("bins")[0].as_py(), np.uint8)
                    ends = np.zeros(len(bins) // size, np.int64)
                    rows, at = np.arange(len(ends)), ends
                    while len(rows):
                        start = rows * size
                        for _ in range(WALKED_LEVELS):
                            right = bins.take(start + feature.take(at, mode="clip"), mode="clip") > cut.take(at, mode="clip")
                            at = left.take(at, mode="clip") + right
                        ends[rows] = at
                        moving = np.flatnonzero(~leaf.take(at, mode="clip"))
                        rows, at = rows.take(moving), at.take(moving)
                    values = pa.array([worth.take(ends).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([tree.column("block"), values], ["block", "sums"])

        def add(table: pa.Table) -> pa.Table:
            ids = next(v for v in table.column("ids").to_pylist() if v is not None)
            total = sum(np.frombuffer(v, np.int64) for v in table.column("sums").to_pylist() if v is not None)
            mean = np.ldexp(total.astype(np.float64), -shift) / count
            return pa.table({"id": pa.array(np.frombuffer(ids, np.int64)), column: pa.array(mean)})

        vectors = rows.select("id", vector_to_array(F.col("features")).alias("x"))
        blocks = materialize(vectors.mapInArrow(block, "block long, n long, ids binary, bins binary"), "blocks")
        pairs = (blocks.agg(F.sum("n")).first()[0] or 0) * count
        met = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tree"), "bins").unionByName(
            self.trees.select("tree", "value", "feature", F.col("bin"), "left"), allowMissingColumns=True
        )
        tasks = max(1, min(2 * count, -(-pairs // PAIRS_SCORED)))
        dealt = met.repartition(tasks, "tree").sortWithinPartitions("tree", F.col("block").asc_nulls_first())
        sums = dealt.mapInArrow(walk, "block long, sums binary")
        both = sums.unionByName(blocks.select("block", "ids"), allowMissingColumns=True)
        return both.groupBy("block").applyInArrow(add, f"id long, `{column}` double")


def grow(estimators: list, data: DataFrame, node_rows: int | None = None) -> list[Part]:
    """Parts of one forest, one for each of ``estimators``, which differ in number of trees, seed and output columns only.

    ``data`` is kept or stored, as several passes read it.
    """
    spark, one = data.sparkSession, estimators[0]
    reach(spark)
    features, label = one.getFeaturesCol(), one.getLabelCol()
    size = len(data.select(features).first()[0])
    sizes = [e.getNumTrees() for e in estimators]
    growth = Growth(
        trees=sum(sizes),
        seed=one.getSeed(),
        depth=one.getMaxDepth(),
        leaf=one.getMinInstancesPerNode(),
        features=size,
        subset=subset_size(one, size),
        bins=one.getMaxBins(),
        memory_mb=one.getMaxMemoryInMB(),
    )
    if isinstance(one, RandomForestClassifier):
        weight = F.col(one.getWeightCol()) if one.isDefined("weightCol") and one.getWeightCol() else F.lit(1.0)
        weights = {r[0]: r[1] for r in data.groupBy(F.col(label).cast("int")).agg(F.avg(weight.cast("double"))).collect()}
        growth = replace(growth, weights=(weights.get(0, 1.0), weights.get(1, 1.0)))
    stored, points, rows = binned_rows(data, label, features, size, growth.bins)
    nodes = grown_nodes(stored, growth, rows, NODE_ROWS if node_rows is None else node_rows)
    grown = Grown.summed(materialize(packed(nodes, growth), "trees"), growth, points)
    return [Part(grown, e, sum(sizes[:k])) for k, e in enumerate(estimators)]


def grow_forest(estimators: list, data: DataFrame, node_rows: int | None = None) -> list:
    """The same as Spark ML's models, which the driver holds."""
    parts = grow(estimators, data, node_rows)
    with ThreadPoolExecutor(len(parts)) as pool:
        running = [pool.submit(inheritable_thread_target(data.sparkSession)(lambda p: p.model), p) for p in parts]
        return [r.result() for r in running]
