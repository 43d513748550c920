"""Random forest with balanced bootstrap samples, all trees grown together from shared passes.

* **Bootstrap**: a row's weight in a tree is Poisson(1), read off a 32-bit hash of the row's key and the tree's
  number, so every pass, task and retry sees the same sample without storing it.
* **Balanced subsample**: each tree has its own class weights, total weight / (2 x weight of the class) in its sample.
* **Growth**: nodes are split by the largest weighted Gini decrease among sqrt(features) features, chosen by a hash of tree, node and
  feature (further ones in that order while none gives a valid split); both sides keep ``min_rows`` different rows.
  One Spark pass sums class weights and rows by (node, feature, bin) for the open nodes of all trees.  Nodes of at most
  ``SMALL_ROWS`` rows meet in one task each and are grown to the end there.

Sums are integers, so the same rows give the same forest, whatever their order and partitions.  Repeated keys share their
weights.  The model has at most 2 x rows / ``min_rows`` nodes a tree; raise ``min_rows`` with the rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import nan_to_null
from ledgerline.operators.trees import _bins_of, _matrix, _written, bin_edges
from ledgerline.session import ship_package

SMALL_ROWS = 50_000
#: Shares of Poisson(1) up to 0, 1, 2, ... in units of 2**-32; a weight is the number of them at or below the hash.
POISSON = [int(round(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2**32)) for k in range(11)]
_M = 0xFFFFFFFF


@dataclass(frozen=True)
class ForestParams:
    trees: int = 400
    min_rows: int = 20
    bins: int = 255
    seed: int = 42


def mixed(value: np.ndarray, number: int) -> np.ndarray:
    """32-bit hash of 32-bit numbers and a number."""
    u = (np.asarray(value, np.uint64) ^ np.uint64(number * 2654435761 & _M)) * np.uint64(2246822519) & np.uint64(_M)
    u = (u ^ (u >> np.uint64(15))) * np.uint64(3266489917) & np.uint64(_M)
    return u ^ (u >> np.uint64(16))


def bootstrap_weights(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    return np.searchsorted(np.array(POISSON, np.uint64), mixed(key, tree + 1000 * seed), side="right").astype(np.int64)


@dataclass
class Node:
    feature: int = -1
    bin: int = 0
    left: int = -1
    right: int = -1
    c0: int = 0  # weights of the classes, and different rows
    c1: int = 0
    rows: int = 0
    path: str = "1"
    done: bool = False


@dataclass
class Forest:
    features: list[str]
    edges: list[list[float]]
    class_weights: list[tuple[float, float]]
    trees: list[list[Node]] = field(default_factory=list)

    def share(self, tree: int, node: Node) -> float:
        """Weighted share of class 1."""
        a, b = (w * c for w, c in zip(self.class_weights[tree], (node.c0, node.c1)))
        return b / (a + b) if a + b else 0.5

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, left, right, w0, w1, rows, share): leaves have no feature."""
        rows = [
            (t, i, self.features[x.feature] if x.feature >= 0 else None, float(self.edges[x.feature][x.bin]) if x.feature >= 0 else None, x.left, x.right, x.c0, x.c1, x.rows, self.share(t, x))
            for t, nodes in enumerate(self.trees) for i, x in enumerate(nodes)
        ]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, left int, right int, w0 long, w1 long, rows long, share double")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``p_up`` (mean share over the trees) and ``prediction``; missing values count as 0."""
        ship_package(df.sparkSession)
        routes = [(_Routes(nodes), np.array([self.share(t, x) for x in nodes])) for t, nodes in enumerate(self.trees)]
        shared = df.sparkSession.sparkContext.broadcast((routes, [np.array(e) for e in self.edges]))  # the model
        kept = [c for c in df.columns if c not in ("p_up", "prediction")]
        names = self.features
        source = df.select(*kept, *[F.coalesce(nan_to_null(c), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(names)])
        schema = T.StructType([*df.select(*kept).schema.fields]).add("p_up", "double").add("prediction", "double")

        def run(batches):
            trees, edges = shared.value
            for batch in batches:
                bins = _bins_of([batch.column(len(kept) + i).to_numpy() for i in range(len(names))], edges, batch.num_rows)
                p = np.zeros(batch.num_rows)
                for routes_, share in trees:
                    p += share[routes_.leaf(bins)]
                p /= max(len(trees), 1)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(p), pa.array((p > 0.5).astype(float))], names=schema.names)

        return source.mapInArrow(run, schema)

    def save(self, spark: SparkSession, path: str) -> str:
        """The model as tables below ``path``."""
        rows = [(t, i, x.feature, x.bin, x.left, x.right, x.c0, x.c1, x.rows, x.path) for t, nodes in enumerate(self.trees) for i, x in enumerate(nodes)]
        schema = "tree int, node int, feature int, bin int, left int, right int, c0 long, c1 long, rows long, path string"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(t, a, b) for t, (a, b) in enumerate(self.class_weights)]
        spark.createDataFrame(rows, "tree int, w0 double, w1 double").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
        rows = [(i, name, [float(e) for e in edges]) for i, (name, edges) in enumerate(zip(self.features, self.edges))]
        spark.createDataFrame(rows, "feature int, name string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        """A saved forest; the driver receives its nodes."""
        listed = spark.read.parquet(f"{path}/features").orderBy("feature").collect()
        weights = [(r["w0"], r["w1"]) for r in spark.read.parquet(f"{path}/weights").orderBy("tree").collect()]
        out = cls([r["name"] for r in listed], [list(r["edges"]) for r in listed], weights, [[] for _ in weights])
        for r in sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: (r["tree"], r["node"])):
            out.trees[r["tree"]].append(Node(r["feature"], r["bin"], r["left"], r["right"], r["c0"], r["c1"], r["rows"], r["path"], True))
        return out


class _Routes:
    """The nodes of one tree as arrays."""

    def __init__(self, nodes: list[Node]):
        self.feature, self.bin, self.left, self.right = (np.array([getattr(x, c) for x in nodes]) for c in ("feature", "bin", "left", "right"))

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        while True:
            go = np.flatnonzero(self.left[at] >= 0)
            if not len(go):
                return at
            here = at[go]
            at[go] = np.where(bins[go, self.feature[here]] > self.bin[here], self.right[here], self.left[here])


def feature_order(tree: int, path: str, n: int, seed: int) -> list[int]:
    """All features in the order in which a node looks at them."""
    place = zlib.crc32(f"{tree}:{path}".encode())
    return sorted(range(n), key=lambda f: (int(mixed(np.array([place]), f + 7919 * (seed + 1))[0]), f))


def best_split(sums, order: list[int], weights: tuple[float, float], min_rows: int) -> tuple[int, int] | None:
    """(feature, bin) of the best valid split; ``sums(feature)`` gives class weights and rows by bin."""
    looked, best = 0, (0.0, -1, 0)
    for feature in order:
        if looked >= max(int(math.sqrt(len(order))), 1) and best[1] >= 0:
            break
        looked += 1
        c0, c1, n = (np.cumsum(x) for x in sums(feature))
        a, b = c0 * weights[0], c1 * weights[1]
        part = lambda x, y: (x * x + y * y) / np.maximum(x + y, 1e-300)
        gain = (part(a, b) + part(a[-1] - a, b[-1] - b) - part(a[-1], b[-1]))[:-1]
        valid = (n[:-1] >= min_rows) & (n[-1] - n[:-1] >= min_rows)
        gain = np.where(valid, gain, 0.0)
        at = int(np.argmax(gain))
        if gain[at] > max(best[0], 1e-9 * max(a[-1] + b[-1], 1)):
            best = (float(gain[at]), feature, at)
    return (best[1], best[2]) if best[1] >= 0 else None


def _divided(nodes: list[Node], node: int, split: tuple[int, int] | None, inside) -> None:
    """Close a node, with its children if it is split; ``inside`` are their class weights and rows."""
    own = nodes[node]
    own.done = True
    if split is None:
        return
    own.feature, own.bin = split
    own.left, own.right = len(nodes), len(nodes) + 1
    for sums, mark in zip(inside, "01"):
        nodes.append(Node(c0=int(sums[0]), c1=int(sums[1]), rows=int(sums[2]), path=own.path + mark))


def grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: str, weights: tuple[float, float], params: ForestParams) -> list[Node]:
    """The part of a tree below a node, from the node's rows."""
    n = bins.shape[1]
    nodes = [Node(c0=int(w[y == 0].sum()), c1=int(w[y == 1].sum()), rows=len(y), path=path)]
    open_ = [(0, np.arange(len(y)))]
    while open_:
        node, rows = open_.pop()
        own = nodes[node]
        if own.rows < 2 * params.min_rows or not own.c0 or not own.c1:
            own.done = True
            continue
        each = (w[rows] * (y[rows] == 0), w[rows] * (y[rows] == 1), np.ones(len(rows)))
        sums = lambda f: [np.bincount(bins[rows, f], weights=x, minlength=256) for x in each]  # noqa: B023, E731
        split = best_split(sums, feature_order(tree, own.path, n, params.seed), weights, params.min_rows)
        if split is None:
            own.done = True
            continue
        beyond = bins[rows, split[0]] > split[1]
        inside = [[x[side].sum() for x in each] for side in (~beyond, beyond)]
        _divided(nodes, node, split, inside)
        open_ += [(own.left, rows[~beyond]), (own.right, rows[beyond])]
    return nodes


_PART = "slot int, place int, feature int, bin int, left int, right int, c0 long, c1 long, rows long, path string"


def _routed(batch: pa.RecordBatch, n: int, trees: list[list[Node]], wanted: dict[tuple[int, int], int], seed: int):
    """(tree, slot, bins, y, weight) of the rows of each tree's wanted nodes."""
    bins, y, key = _matrix(batch.column(0), n), batch.column(1).to_numpy(), batch.column(2).to_numpy()
    for t, nodes in enumerate(trees):
        slots = np.full(len(nodes), -1)
        for (tree, node), slot in wanted.items():
            if tree == t:
                slots[node] = slot
        if (slots < 0).all():
            continue
        w = bootstrap_weights(key, t, seed)
        slot = slots[_Routes(nodes).leaf(bins)]
        use = (w > 0) & (slot >= 0)
        if use.any():
            yield t, slot[use], bins[use], y[use], w[use]


def _pass_sums(rows: DataFrame, n: int, trees, wanted, seed: int) -> np.ndarray:
    """Class weights and rows (3 x slots x features x 256) of the wanted nodes."""
    shape = (3, len(wanted), n, 256)

    def run(batches):
        held = np.zeros((3, len(wanted) * n * 256), np.int64)
        for batch in batches:
            for _, slot, bins, y, w in _routed(batch, n, trees, wanted, seed):
                cell = ((slot * n * 256)[:, None] + np.arange(n) * 256 + bins).ravel()
                for k, x in enumerate((w * (y == 0), w * (y == 1), np.ones(len(w)))):
                    held[k] += np.bincount(cell, weights=np.repeat(x, n), minlength=held.shape[1]).astype(np.int64)
        used = np.flatnonzero(held[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(held[k][used]) for k in range(3))], names=["cell", "c0", "c1", "n"])

    found = rows.mapInArrow(run, "cell long, c0 long, c1 long, n long").groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "n")]).toArrow()
    out = np.zeros((3, int(np.prod(shape[1:]))), np.int64)
    for k, name in enumerate(("c0", "c1", "n")):
        out[k][found.column("cell").to_numpy()] = found.column(name).to_numpy()
    return out.reshape(shape)


def _pass_parts(rows: DataFrame, n: int, trees, wanted, class_weights, params: ForestParams) -> dict[int, list[Node]]:
    """The parts below all wanted nodes, each grown in one task."""
    place = {slot: (tree, trees[tree][node].path) for (tree, node), slot in wanted.items()}

    def routed(batches):
        for batch in batches:
            for _, slot, bins, y, w in _routed(batch, n, trees, wanted, params.seed):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot.astype(np.int32)), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(y.astype(np.int32)), pa.array(w)], names=["slot", "bins", "y", "w"]
                )

    def finish(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        tree, path = place[slot]
        nodes = grown(_matrix(table.column("bins").combine_chunks(), n), table.column("y").to_numpy(), table.column("w").to_numpy(), tree, path, class_weights[tree], params)
        columns = [pa.array([slot] * len(nodes), pa.int32()), pa.array(range(len(nodes)), pa.int32())]
        columns += [pa.array([getattr(x, c) for x in nodes], pa.int32()) for c in ("feature", "bin", "left", "right")]
        columns += [pa.array([getattr(x, c) for x in nodes], pa.int64()) for c in ("c0", "c1", "rows")]
        return pa.table([*columns, pa.array([x.path for x in nodes])], names=["slot", "place", "feature", "bin", "left", "right", "c0", "c1", "rows", "path"])

    found = rows.mapInArrow(routed, "slot int, bins binary, y int, w long").groupBy("slot").applyInArrow(finish, _PART).collect()
    out: dict[int, list[Node]] = {}
    for r in sorted(found, key=lambda r: (r["slot"], r["place"])):
        out.setdefault(r["slot"], []).append(Node(r["feature"], r["bin"], r["left"], r["right"], r["c0"], r["c1"], r["rows"], r["path"], True))
    return out


def row_key(key: Sequence[str]) -> F.Column:
    return F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in key]).cast("binary"))


def bootstrap_totals(rows: DataFrame, label: str, key: Sequence[str], trees: int, seed: int) -> DataFrame:
    """(tree, rows, w0, w1): different rows and class weights of every tree's sample."""

    def run(batches):
        for batch in batches:
            y, key_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = []
            for t in range(trees):
                w = bootstrap_weights(key_, t, seed)
                out.append((t, int((w > 0).sum()), int(w[y == 0].sum()), int(w[y == 1].sum())))
            columns = [pa.array([r[0] for r in out], pa.int32())] + [pa.array([r[k] for r in out], pa.int64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "rows", "w0", "w1"])

    ship_package(rows.sparkSession)
    source = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("int"), row_key(key))
    sums = source.mapInArrow(run, "tree int, rows long, w0 long, w1 long")
    return sums.groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("rows", "w0", "w1")])


def balanced(w0: int, w1: int) -> tuple[float, float]:
    """Class weights of a sample; a class without rows weighs nothing."""
    total = w0 + w1
    return (total / (2.0 * w0) if w0 else 0.0, total / (2.0 * w1) if w1 else 0.0)


def fit_forest(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str], params: ForestParams = ForestParams()) -> Forest:
    """A forest for a 0/1 ``label``; ``key`` names the columns that tell rows apart.  Rows without a label are left out."""
    features, n = list(features), len(list(features))
    train = train.where(F.col(label).isNotNull())
    edges = bin_edges(train, features, params.bins)
    totals = {r["tree"]: r for r in bootstrap_totals(train, label, key, params.trees, params.seed).collect()}  # one row a tree
    model = Forest(features, edges, [balanced(totals[t]["w0"], totals[t]["w1"]) if t in totals else (1.0, 1.0) for t in range(params.trees)])
    model.trees = [[Node(c0=totals[t]["w0"], c1=totals[t]["w1"], rows=totals[t]["rows"], path="1")] if t in totals else [Node(done=True)] for t in range(params.trees)]
    own = [np.array(e) for e in edges]

    def bin_rows(batches):
        for batch in batches:
            bins = _bins_of([batch.column(i).to_numpy() for i in range(n)], own, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), batch.column(n), batch.column(n + 1)], names=["bins", "y", "key"])

    source = train.select(*[F.coalesce(nan_to_null(c), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("y"), row_key(key).alias("key"))
    rows = _written(source.mapInArrow(bin_rows, "bins binary, y int, key long"), "forest-rows")
    while True:
        for nodes in model.trees:
            for x in nodes:  # too small, or of one class
                x.done = x.done or x.rows < 2 * params.min_rows or not x.c0 or not x.c1
        open_ = [(t, i) for t, nodes in enumerate(model.trees) for i, x in enumerate(nodes) if not x.done]
        if not open_:
            return model
        small = {x: s for s, x in enumerate(o for o in open_ if model.trees[o[0]][o[1]].rows <= SMALL_ROWS)}
        large = [o for o in open_ if o not in small]
        parts = _pass_parts(rows, n, model.trees, small, model.class_weights, params) if small else {}
        # as many nodes a pass as fit the driver: 64 nodes' sums at a time
        for a in range(0, len(large), 64):
            some = {x: s for s, x in enumerate(large[a : a + 64])}
            sums = _pass_sums(rows, n, model.trees, some, params.seed)
            for (t, i), s in some.items():
                order = feature_order(t, model.trees[t][i].path, n, params.seed)
                split = best_split(lambda f: sums[:, s, f], order, model.class_weights[t], params.min_rows)  # noqa: B023
                inside = None
                if split is not None:
                    low = sums[:, s, split[0], : split[1] + 1].sum(axis=1)
                    inside = (low, sums[:, s, split[0]].sum(axis=1) - low)
                _divided(model.trees[t], i, split, inside)
        for (t, i), s in small.items():
            nodes, part = model.trees[t], parts[s]
            place = [i, *range(len(nodes), len(nodes) + len(part) - 1)]
            nodes.extend(Node() for _ in part[1:])
            for at, x in zip(place, part):
                x.left, x.right = (place[c] if c >= 0 else -1 for c in (x.left, x.right))
                nodes[at] = x
