"""Extremely randomised trees, grown level by level over distributed rows.

All trees grow at once.  For the nodes of a level Spark finds the range of every feature
in every node, a cut is drawn in that range from a seeded hash for a few features of the
node, Spark counts the classes on both sides of each drawn cut, and the cut with the least
impurity divides the node.  Rows are never moved or copied: a task finds the node of a row
by following the trees so far, and sums per node before anything is shuffled.  What the
driver holds is the model and one level's sums, whatever the number of rows.

Every tree sees all rows.  Rows with a null or NaN feature or a null label are left out of
the fit; a null or NaN feature scores as if it were below every cut."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.operators.neighbours import complete
from tabulyte.session import written

SEED = 42


@dataclass
class Trees:
    """Nodes of complete binary trees, numbered from 1, children 2k and 2k + 1.  A node
    without a feature (-1) is a leaf; `rates` are the class shares of every node reached."""

    feature: np.ndarray  # trees x nodes
    cut: np.ndarray
    rates: np.ndarray  # trees x nodes x classes

    @staticmethod
    def empty(trees: int, depth: int, classes: int) -> Trees:
        nodes = 1 << (depth + 1)
        return Trees(np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes, classes)))

    def nodes_of(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The node that each row has come to."""
        node, feature, cut = np.ones(len(x), np.int64), self.feature[tree], self.cut[tree]
        rows = np.arange(len(x))
        while True:
            f = feature[node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            if not len(rows):
                return node
            node[rows] = 2 * node[rows] + (x[rows, f] >= cut[node[rows]])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), self.rates.shape[2]))
        for t in range(len(self.feature)):
            total += self.rates[t, self.nodes_of(x, t)]
        return total / len(self.feature)


def uniform(*parts) -> float:
    """A number in (0, 1) that the parts fix."""
    digest = hashlib.blake2b(":".join(map(str, parts)).encode(), digest_size=8).digest()
    return (int.from_bytes(digest, "little") + 0.5) / 2.0**64


def drawn(seed: int, tree: int, node: int, ranges: dict[int, tuple[float, float]], count: int) -> dict[int, float]:
    """A cut in the range of `count` features of a node, chosen in a seeded order; features
    with one value only are passed over."""
    order = sorted((f for f, (lo, hi) in ranges.items() if lo < hi), key=lambda f: uniform(seed, tree, node, f, "order"))
    out = {}
    for f in order[:count]:
        lo, hi = ranges[f]
        at = lo + (hi - lo) * uniform(seed, tree, node, f, "cut")
        out[f] = at if lo < at <= hi else hi  # rounding must leave a row below
    return out


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            yield b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width), b.column("y").to_numpy(zero_copy_only=False)


def _ranges(rows: DataFrame, model: Trees, level: range, width: int, classes: int):
    """Least and greatest value of every feature, and the rows of each class, per open node."""
    shared, trees, first = rows.sparkSession.sparkContext.broadcast(model), len(model.feature), level.start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.full((trees, len(level), width), np.inf), np.full((trees, len(level), width), -np.inf)
        n = np.zeros((trees, len(level), classes), np.int64)
        for x, y in _batches(batches, width):
            for t in range(trees):
                node = shared.value.nodes_of(x, t) - first
                here = np.flatnonzero(node >= 0)
                if not len(here):
                    continue
                order = here[np.argsort(node[here], kind="stable")]
                found, start = np.unique(node[order], return_index=True)
                lo[t, found] = np.minimum(lo[t, found], np.minimum.reduceat(x[order], start, axis=0))
                hi[t, found] = np.maximum(hi[t, found], np.maximum.reduceat(x[order], start, axis=0))
                np.add.at(n[t], (node[here], y[here]), 1)
        t, k = np.nonzero(n.sum(2))
        lists = lambda v, kind: pa.array(v[t, k].tolist(), pa.list_(kind))
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(k + first, pa.int32()), lists(lo, pa.float64()), lists(hi, pa.float64()), lists(n, pa.int64())], ["tree", "node", "lo", "hi", "n"])

    partial = rows.mapInArrow(run, "tree int, node int, lo array<double>, hi array<double>, n array<long>")
    each = lambda f, c, size: F.array(*[f(F.get(c, F.lit(i))) for i in range(size)]).alias(c)
    return partial.groupBy("tree", "node").agg(each(F.min, "lo", width), each(F.max, "hi", width), each(F.sum, "n", classes)).collect()


def _below(rows: DataFrame, model: Trees, cuts: dict[tuple[int, int], dict[int, float]], first: int, width: int, classes: int):
    """Rows of each class below each drawn cut: {(tree, node, feature): counts}."""
    keys = [(t, k, f) for (t, k), at in cuts.items() for f in at]
    shared = rows.sparkSession.sparkContext.broadcast((model, cuts))
    place = {key: i for i, key in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cuts = shared.value
        by_tree: dict[int, list] = {}
        for (t, k), at in cuts.items():
            by_tree.setdefault(t, []).append((k, at))
        n = np.zeros((len(place), classes), np.int64)
        for x, y in _batches(batches, width):
            for t, nodes in by_tree.items():
                node = model.nodes_of(x, t)
                order = np.argsort(node, kind="stable")
                ordered = node[order]
                for k, at in nodes:
                    rows_ = order[np.searchsorted(ordered, k) : np.searchsorted(ordered, k, side="right")]
                    for f, c in at.items():
                        n[place[t, k, f]] += np.bincount(y[rows_[x[rows_, f] < c]], minlength=classes)
        used = np.flatnonzero(n.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used].tolist(), pa.list_(pa.int64()))], ["key", "n"])

    sums = rows.mapInArrow(run, "key int, n array<long>").groupBy("key").agg(F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(classes)]).alias("n"))
    return {keys[r["key"]]: np.array(r["n"]) for r in sums.collect()}


def _impurity(n: np.ndarray) -> float:
    """Gini impurity times the rows."""
    total = n.sum()
    return float(total - (n * n).sum() / total) if total else 0.0


def fit_extra_trees(
    df: DataFrame, features: Sequence[str], label: str, trees: int = 150, depth: int = 6, classes: int = 2, per_node: int | None = None,
    least_rows: int = 1, seed: int = SEED,
) -> Trees:
    """Trees over labels 0 .. classes - 1; `per_node` features are tried at a node, the root
    of their number by default.  A side of a cut keeps at least `least_rows` rows."""
    width, per_node = len(features), per_node or max(1, round(math.sqrt(len(features))))
    known = complete(df, features).filter(F.col(label).isNotNull())
    rows = written(known.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("int").alias("y")), "trees")
    model = Trees.empty(trees, depth, classes)
    for level in range(depth + 1):
        nodes = range(1 << level, 2 << level)
        found = _ranges(rows, model, nodes, width, classes)
        counts = {(r["tree"], r["node"]): np.array(r["n"]) for r in found}
        for (t, k), n in counts.items():
            model.rates[t, k] = n / n.sum()
        cuts = {}
        for r in found if level < depth else ():
            n = counts[r["tree"], r["node"]]
            if np.count_nonzero(n) > 1 and n.sum() >= 2 * least_rows:
                at = drawn(seed, r["tree"], r["node"], dict(enumerate(zip(r["lo"], r["hi"]))), per_node)
                if at:
                    cuts[r["tree"], r["node"]] = at
        if not cuts:
            break
        below = _below(rows, model, cuts, nodes.start, width, classes)
        for (t, k), at in cuts.items():
            n, best = counts[t, k], None
            for f, c in at.items():
                left = below.get((t, k, f), np.zeros_like(n))
                if min(left.sum(), (n - left).sum()) >= least_rows:
                    loss = _impurity(left) + _impurity(n - left)
                    if best is None or (loss, f) < best[:2]:
                        best = (loss, f, c)
            if best:
                model.feature[t, k], model.cut[t, k] = best[1], best[2]
    return model


def score_trees(model: Trees, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns with the probability of class 1 (`p`) and the likeliest class (`pred`)."""
    shared, width = df.sparkSession.sparkContext.broadcast(model), len(features)
    held = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            p = shared.value.probabilities(x)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(p[:, 1]), pa.array(p.argmax(1), pa.int32())], ["row", "p", "pred"])

    kind = held.schema["row"].dataType.simpleString()
    return held.mapInArrow(run, f"row {kind}, p double, pred int").select("row.*", "p", "pred")
