"""Histogram gradient boosting: trees grown best leaf first from shared histograms.

* ``bin_edges``: quantiles of every feature from one aggregate; a value's bin is the number of edges below it.
* ``binned``: stored rows of one byte a feature, read by every later pass.
* ``fit_boosting``: each pass is one Spark job over all rows.  A task finds its rows' nodes and sums gradients, hessians
  and row counts by (node, feature, bin); Spark adds the tasks' sums up.  The driver only sees these sums: at most
  leaves x features x bins of them.  A pass evaluates all nodes that best-first growth may need next.  A node of at most
  ``SMALL_ROWS`` rows is finished in one pass: its rows meet in one task, which grows its part of the tree by the same sums.
  If the root is such a node and its rows lie together already, one pass grows the trees of ``store_every`` rounds.

Gradients and hessians are rounded to multiples of 2**-24 and added as integers, so sums do not depend on the order
of rows, tasks or retries: the same rows give the same trees.  Of equal gains the earlier leaf, the
earlier feature and the smaller bin win.

A tree is the list of its splits: split ``s`` moves the rows of a leaf beyond a bin to the new leaf ``s + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import nan_to_null
from ledgerline.session import ensure_checkpoint_dir, ship_package

SCALE = 1 << 24
#: Partitions up to which the tasks' sums go straight to the driver; more are first added up by a shuffle.
DIRECT_PARTITIONS = 16
#: Rows of a node (one byte a feature each) that one task grows to the end.
SMALL_ROWS = 50_000


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 250
    leaves: int = 15
    rate: float = 0.04
    l2: float = 0.2
    min_rows: int = 20
    bins: int = 255
    store_every: int = 25  # rounds after which the rows' scores are written again


@dataclass(frozen=True)
class Split:
    leaf: int
    feature: int
    bin: int
    gain: float


@dataclass
class Tree:
    splits: list[Split]
    values: list[float]  # what each leaf adds to the score

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins`` (rows x features)."""
        leaf = np.zeros(len(bins), np.int64)
        for s, split in enumerate(self.splits):
            leaf[(leaf == split.leaf) & (bins[:, split.feature] > split.bin)] = s + 1
        return leaf


@dataclass
class BoostedTrees:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(round, step, leaf, feature, bin, threshold, gain) of all splits: rows beyond the threshold leave the leaf for leaf ``step``."""
        rows = [
            (r, s + 1, x.leaf, self.features[x.feature], x.bin, float(self.edges[x.feature][x.bin]), x.gain)
            for r, tree in enumerate(self.trees) for s, x in enumerate(tree.splits)
        ]
        return spark.createDataFrame(rows, "round int, step int, leaf int, feature string, bin int, threshold double, gain double")

    def leaf_values(self, spark: SparkSession) -> DataFrame:
        """(round, leaf, value)."""
        rows = [(r, i, v) for r, tree in enumerate(self.trees) for i, v in enumerate(tree.values)]
        return spark.createDataFrame(rows, "round int, leaf int, value double")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``raw_score``, ``p_up`` and ``prediction``; missing values count as 0."""
        names, edges, base, trees = self.features, [np.array(e) for e in self.edges], self.base, self.trees
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((edges, base, trees))  # rounds x leaves numbers
        kept = [c for c in df.columns if c not in ("raw_score", "p_up", "prediction")]
        source = df.select(*kept, *[F.coalesce(nan_to_null(c), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(names)])
        schema = T.StructType([*df.select(*kept).schema.fields]).add("raw_score", "double").add("p_up", "double").add("prediction", "double")

        def run(batches):
            edges_, base_, trees_ = shared.value
            for batch in batches:
                bins = _bins_of([batch.column(len(kept) + i).to_numpy() for i in range(len(names))], edges_, batch.num_rows)
                raw = np.full(batch.num_rows, base_)
                for tree in trees_:
                    raw += np.array(tree.values)[tree.leaves(bins)]
                p = 1.0 / (1.0 + np.exp(-raw))
                columns = [*batch.columns[: len(kept)], pa.array(raw), pa.array(p), pa.array((p > 0.5).astype(float))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return source.mapInArrow(run, schema)

    def save(self, spark: SparkSession, path: str) -> str:
        """The model as tables below ``path``."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/splits")
        self.leaf_values(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/values")
        rows = [(i, name, [float(e) for e in edges], self.base, len(self.trees)) for i, (name, edges) in enumerate(zip(self.features, self.edges))]
        spark.createDataFrame(rows, "feature int, name string, edges array<double>, base double, rounds int").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        listed = spark.read.parquet(f"{path}/features").orderBy("feature").collect()  # one row a feature
        out = cls([r["name"] for r in listed], [r["edges"] for r in listed], listed[0]["base"], [Tree([], []) for _ in range(listed[0]["rounds"])])
        place = {name: i for i, name in enumerate(out.features)}
        for r in spark.read.parquet(f"{path}/splits").orderBy("round", "step").collect():  # at most rounds x leaves rows
            out.trees[r["round"]].splits.append(Split(r["leaf"], place[r["feature"]], r["bin"], r["gain"]))
        for r in spark.read.parquet(f"{path}/values").orderBy("round", "leaf").collect():
            out.trees[r["round"]].values.append(r["value"])
        return out


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Distinct values at the ranks i / ``bins`` of every feature, without its largest value.

    One aggregate of mergeable quantile sketches; exact up to 1,000,000 rows, beyond that within a millionth of the ranks.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    columns = [F.percentile_approx(F.coalesce(nan_to_null(c), F.lit(0.0)), shares, 1_000_000) for c in features]
    most = [F.max(F.coalesce(nan_to_null(c), F.lit(0.0))) for c in features]
    row = df.agg(*[c.alias(f"q{i}") for i, c in enumerate(columns)], *[c.alias(f"m{i}") for i, c in enumerate(most)]).first()
    return [sorted({v for v in (row[f"q{i}"] or []) if v < row[f"m{i}"]}) for i in range(len(features))]


def _bins_of(values: list[np.ndarray], edges: list[np.ndarray], rows: int) -> np.ndarray:
    out = np.zeros((rows, len(values)), np.uint8)
    for i, (x, e) in enumerate(zip(values, edges)):
        out[:, i] = np.searchsorted(e, x, side="left")
    return out


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def binned(df: DataFrame, features: Sequence[str], label: str, edges: list[list[float]], base: float) -> DataFrame:
    """Stored rows (bins: one byte a feature, y, score)."""
    own = [np.array(e) for e in edges]
    n = len(features)
    source = df.select(*[F.coalesce(nan_to_null(c), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("_y"))
    schema = T.StructType().add("bins", "binary").add("y", "integer").add("score", "double")

    def run(batches):
        for batch in batches:
            bins = _bins_of([batch.column(i).to_numpy() for i in range(n)], own, batch.num_rows)
            rows = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, batch.column(n), pa.array(np.full(batch.num_rows, base))], names=schema.names)

    ship_package(df.sparkSession)
    return _written(source.mapInArrow(run, schema), "binned-rows")


@dataclass
class _Node:
    """A node of the growing tree; ``best`` is None until it is evaluated, and has a gain of 0 if nothing may be split."""

    left: int = -1
    right: int = -1
    best: tuple[float, int, int] | None = None  # gain, feature, bin
    total: tuple[int, int] = (0, 0)  # gradient, hessian
    rows: int = 0


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, params: BoostParams) -> tuple[float, int, int]:
    """(gain, feature, bin) of a node's best split from its sums (features x bins); gain 0 if there is none."""
    total_g, total_h, total_n = int(g[0].sum()), int(h[0].sum()), int(n[0].sum())
    gl, hl, nl = (np.cumsum(x, axis=1)[:, :-1] for x in (g, h, n))
    part = lambda a, b: (a / SCALE) ** 2 / (b / SCALE + params.l2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = part(gl, hl) + part(total_g - gl, total_h - hl) - part(total_g, total_h)
    gain = np.where((nl >= params.min_rows) & (total_n - nl >= params.min_rows), gain, 0.0)
    at = int(np.argmax(gain))  # the first of equal ones
    feature, bin_ = divmod(at, gain.shape[1])
    return (float(gain[feature, bin_]), feature, bin_) if gain[feature, bin_] > 0 else (0.0, 0, 0)


def _grow(nodes: list[_Node], leaves: int) -> tuple[list[tuple[int, int]] | None, list[int]]:
    """Best-first order over evaluated nodes.

    Returns the splits as (leaf, node) and each leaf's node; or None and the nodes to
    evaluate next: those the growth waits for, and the children of others that it may split.
    """
    frontier, splits = [0], []
    while len(frontier) < leaves:
        waiting = [x for x in frontier if nodes[x].best is None]
        if waiting:
            more = [c for x in frontier if nodes[x].best is not None and nodes[x].best[0] > 0 for c in (nodes[x].left, nodes[x].right) if nodes[c].best is None]
            return None, waiting + more
        leaf = max(range(len(frontier)), key=lambda i: (nodes[frontier[i]].best[0], -i))
        node = frontier[leaf]
        if nodes[node].best[0] <= 0:
            break
        splits.append((leaf, node))
        frontier[leaf] = nodes[node].left
        frontier.append(nodes[node].right)
    return splits, frontier


def _scores(score: np.ndarray, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    score = score.copy()
    for tree in trees:
        score += np.array(tree.values)[tree.leaves(bins)]
    return score


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), n)


def _evaluate(nodes: list[_Node], node: int, g: np.ndarray, h: np.ndarray, n: np.ndarray, params: BoostParams) -> None:
    """Set a node's best split from its sums, and add its children."""
    own = nodes[node]
    own.best, own.total, own.rows = best_split(g, h, n, params), (int(g[0].sum()), int(h[0].sum())), int(n[0].sum())
    if own.best[0] > 0:
        _, feature, bin_ = own.best
        inside = [int(x[feature, : bin_ + 1].sum()) for x in (g, h, n)]
        own.left, own.right = len(nodes), len(nodes) + 1
        nodes.append(_Node(total=(inside[0], inside[1]), rows=inside[2]))
        nodes.append(_Node(total=(own.total[0] - inside[0], own.total[1] - inside[1]), rows=own.rows - inside[2]))


def _histograms(bins: np.ndarray, g: np.ndarray, h: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
    """Gradient, hessian and row sums (3 x slots x features x 256); float64 holds these integers exactly."""
    n = bins.shape[1]
    cell = ((slot * n * 256)[:, None] + np.arange(n) * 256 + bins).ravel()
    sums = [np.bincount(cell, weights=np.repeat(w, n), minlength=slots * n * 256) for w in (g, h, np.ones(len(bins)))]
    return np.stack(sums).astype(np.int64).reshape(3, slots, n, 256)


class _Router:
    """Finds the wanted node of every row of a batch, and the row's gradient and hessian."""

    def __init__(self, n: int, trees: list[Tree], nodes: list[_Node], wanted: list[int]):
        self.n, self.trees = n, trees
        self.slot = np.full(len(nodes), -1)
        self.slot[wanted] = np.arange(len(wanted))
        self.feature, self.bin = (np.array([x.best[k] if x.best else 0 for x in nodes]) for k in (1, 2))
        self.left, self.right = np.array([x.left for x in nodes]), np.array([x.right for x in nodes])

    def route(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bins, gradient, hessian, slot) of the rows in wanted nodes."""
        bins = _matrix(batch.column(0), self.n)
        score = _scores(batch.column(2).to_numpy(), bins, self.trees)
        p = 1.0 / (1.0 + np.exp(-score))
        at = np.zeros(len(bins), np.int64)
        while True:
            go = np.flatnonzero((self.left[at] >= 0) & (self.slot[at] < 0))
            if not len(go):
                break
            beyond = bins[go, self.feature[at[go]]] > self.bin[at[go]]
            at[go] = np.where(beyond, self.right[at[go]], self.left[at[go]])
        use = self.slot[at] >= 0
        y = batch.column(1).to_numpy()
        return bins[use], np.round((y - p) * SCALE)[use], np.round(p * (1.0 - p) * SCALE)[use], self.slot[at[use]]


def _sums(rows: DataFrame, partitions: int, router: _Router, wanted: list[int]) -> np.ndarray:
    """Sums of the ``wanted`` nodes (3 x nodes x features x 256), from one pass over all rows."""
    shape = (3, len(wanted), router.n, 256)

    def run(batches):
        held = np.zeros(shape, np.int64)
        for batch in batches:
            held += _histograms(*router.route(batch), len(wanted))
        flat = held.reshape(3, -1)
        used = np.flatnonzero(flat[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(flat[k][used]) for k in range(3))], names=["cell", "g", "h", "n"])

    sums = rows.mapInArrow(run, "cell long, g long, h long, n long")
    if partitions > DIRECT_PARTITIONS:
        sums = sums.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
    found = sums.toArrow()
    out = np.zeros((3, int(np.prod(shape[1:]))), np.int64)
    for k, name in enumerate(("g", "h", "n")):
        np.add.at(out[k], found.column("cell").to_numpy(), found.column(name).to_numpy())
    return out.reshape(shape)


def _grown(bins: np.ndarray, g: np.ndarray, h: np.ndarray, params: BoostParams) -> list[_Node]:
    """The part of the tree below a node, as far as best-first growth could go inside it."""
    nodes, rows = [_Node()], {0: np.arange(len(bins))}
    while True:
        splits, rest = _grow(nodes, params.leaves)
        if splits is not None:
            return nodes
        for node in rest:
            own = rows.pop(node)
            sums = _histograms(bins[own], g[own], h[own], np.zeros(len(own), np.int64), 1)[:, 0]
            _evaluate(nodes, node, *sums, params)
            if nodes[node].best[0] > 0:
                beyond = bins[own, nodes[node].best[1]] > nodes[node].best[2]
                rows[nodes[node].left], rows[nodes[node].right] = own[~beyond], own[beyond]


_PART = "slot int, evaluated boolean, gain double, feature int, bin int, left int, right int, g long, h long, rows long, place int"


def _part(slot: int, nodes: list[_Node]) -> pa.Table:
    best = [x.best or (0.0, 0, 0) for x in nodes]
    columns = {
        "slot": pa.array([slot] * len(nodes), pa.int32()), "evaluated": pa.array([x.best is not None for x in nodes]), "gain": pa.array([b[0] for b in best], pa.float64()),
        "feature": pa.array([b[1] for b in best], pa.int32()), "bin": pa.array([b[2] for b in best], pa.int32()), "left": pa.array([x.left for x in nodes], pa.int32()), "right": pa.array([x.right for x in nodes], pa.int32()),
        "g": pa.array([x.total[0] for x in nodes], pa.int64()), "h": pa.array([x.total[1] for x in nodes], pa.int64()), "rows": pa.array([x.rows for x in nodes], pa.int64()), "place": pa.array(range(len(nodes)), pa.int32()),
    }
    return pa.table(columns)


def _parts(rows: DataFrame, partitions: int, router: _Router, params: BoostParams) -> dict[int, list[_Node]]:
    """The parts of the tree below all wanted nodes, by slot; each node's rows meet in one task."""
    n = router.n

    def grown(slot: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> pa.Table:
        return _part(slot, _grown(bins, g, h, params))

    if partitions == 1:  # the rows have met already

        def run(batches):
            held = list(zip(*[router.route(batch) for batch in batches]))
            bins, g, h, slot = (np.concatenate(x) for x in held) if held else (np.zeros((0, n), np.uint8), *[np.zeros(0)] * 3)
            for k in np.unique(slot).astype(int).tolist():
                yield from grown(k, bins[slot == k], g[slot == k], h[slot == k]).to_batches()

        found = rows.mapInArrow(run, _PART)
    else:

        def routed(batches):
            for batch in batches:
                bins, g, h, slot = router.route(batch)
                columns = [pa.array(slot.astype(np.int32)), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(g.astype(np.int64)), pa.array(h.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["slot", "bins", "g", "h"])

        def finish(table: pa.Table) -> pa.Table:
            bins = _matrix(table.column("bins").combine_chunks(), n)
            return grown(table.column("slot")[0].as_py(), bins, table.column("g").to_numpy().astype(float), table.column("h").to_numpy().astype(float))

        found = rows.mapInArrow(routed, "slot int, bins binary, g long, h long").groupBy("slot").applyInArrow(finish, _PART)
    return _listed(found)


def _listed(parts: DataFrame) -> dict[int, list[_Node]]:
    """The nodes of every slot of ``_PART`` rows."""
    out: dict[int, list[_Node]] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["slot"], r["place"])):  # a few rows for each leaf
        best = (r["gain"], r["feature"], r["bin"]) if r["evaluated"] else None
        out.setdefault(r["slot"], []).append(_Node(r["left"], r["right"], best, (r["g"], r["h"]), r["rows"]))
    return out


def _graft(nodes: list[_Node], node: int, part: list[_Node]) -> None:
    """Put a part, whose first node is ``node``, into the tree."""
    place = [node, *range(len(nodes), len(nodes) + len(part) - 1)]
    nodes.extend(_Node() for _ in part[1:])
    for i, x in zip(place, part):
        nodes[i] = _Node(place[x.left] if x.left >= 0 else -1, place[x.right] if x.right >= 0 else -1, x.best, x.total, x.rows)


def _tree(rows: DataFrame, partitions: int, count: int, n: int, done: list[Tree], params: BoostParams) -> Tree:
    nodes = [_Node(rows=count)]
    while True:
        splits, rest = _grow(nodes, params.leaves)
        if splits is not None:
            break
        small = [x for x in rest if nodes[x].rows <= SMALL_ROWS]
        large = [x for x in rest if nodes[x].rows > SMALL_ROWS]
        if large:
            sums = _sums(rows, partitions, _Router(n, done, nodes, large), large)
        if small:
            parts = _parts(rows, partitions, _Router(n, done, nodes, small), params)
            for slot, node in enumerate(small):
                _graft(nodes, node, parts[slot])
        for i, node in enumerate(large):
            _evaluate(nodes, node, *sums[:, i], params)
    return _finished(nodes, splits, rest, params)


def _finished(nodes: list[_Node], splits: list[tuple[int, int]], rest: list[int], params: BoostParams) -> Tree:
    """The tree of a growth's splits and leaves."""
    value = lambda total: params.rate * (total[0] / SCALE) / (total[1] / SCALE + params.l2) if total[1] else 0.0
    return Tree([Split(leaf, nodes[x].best[1], nodes[x].best[2], nodes[x].best[0]) for leaf, x in splits], [value(nodes[x].total) for x in rest])


def _small_rounds(rows: DataFrame, n: int, rounds: int, params: BoostParams) -> list[Tree]:
    """The trees of the next rounds over at most ``SMALL_ROWS`` rows in one partition, from one pass."""

    def run(batches):
        held = list(zip(*[(_matrix(b.column(0), n), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]))
        if not held:
            return
        bins, y, score = (np.concatenate(x) for x in held)
        for r in range(rounds):
            p = 1.0 / (1.0 + np.exp(-score))
            nodes = _grown(bins, np.round((y - p) * SCALE), np.round(p * (1.0 - p) * SCALE), params)
            yield from _part(r, nodes).to_batches()
            tree = _finished(nodes, *_grow(nodes, params.leaves), params)
            if not tree.splits and not tree.values[0]:
                return
            score = _scores(score, bins, [tree])

    found = _listed(rows.mapInArrow(run, _PART))
    return [_finished(nodes, *_grow(nodes, params.leaves), params) for _, nodes in sorted(found.items())]


def fit_boosting(train: DataFrame, features: Sequence[str], label: str, params: BoostParams = BoostParams(), partitions: int | None = None) -> BoostedTrees:
    """Boosted trees for a 0/1 ``label``; rows without a label are left out, one class only gives a constant."""
    if not 2 <= params.bins <= 256:
        raise ValueError("2 to 256 bins")
    features = list(features)
    train = train.where(F.col(label).isNotNull())
    if partitions:
        train = train.repartition(partitions)
    n, up = train.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    up = min(max(up or 0, 1e-9), max(n - 1e-9, 1e-9))
    base = float(np.log(up / max(n - up, 1e-9)))
    model = BoostedTrees(features, bin_edges(train, features, params.bins), base)
    if not n or not features:
        return model
    rows = binned(train, features, label, model.edges, base)
    split = rows.rdd.getNumPartitions()
    if split == 1 and n <= SMALL_ROWS:
        while len(model.trees) < params.rounds:
            trees = _small_rounds(rows, len(features), min(params.store_every, params.rounds - len(model.trees)), params)
            model.trees += trees
            if not trees[-1].splits and not trees[-1].values[0]:
                break
            if len(model.trees) < params.rounds:
                rows = _rescored(rows, len(features), trees)
        return model
    fresh: list[Tree] = []
    for _ in range(params.rounds):
        tree = _tree(rows, split, n, len(features), fresh, params)
        model.trees.append(tree)
        fresh.append(tree)
        if not tree.splits and not tree.values[0]:
            break
        if len(fresh) == params.store_every:
            rows, fresh = _rescored(rows, len(features), fresh), []
    return model


def _rescored(rows: DataFrame, n: int, trees: list[Tree]) -> DataFrame:
    def run(batches):
        for batch in batches:
            score = _scores(batch.column(2).to_numpy(), _matrix(batch.column(0), n), trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["bins", "y", "score"])

    return _written(rows.mapInArrow(run, rows.schema), "binned-rows")
