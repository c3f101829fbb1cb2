"""Isolation forest: trees on small hash samples, scores in parallel."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from tabulyte.operators.ordering import thinned
from tabulyte.operators.sampling import top_per_group

TREE_ROWS = 256


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def tree_samples(df: DataFrame, id_col: str, features: Sequence[str], trees: int, seed: int) -> DataFrame:
    """256 hash-chosen rows per tree, out of a pool whose size depends on the
    number of trees only."""
    pool = (
        thinned(df, [id_col], 2 * trees * TREE_ROWS, seed)
        .select(id_col, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
        .orderBy(F.xxhash64(id_col, F.lit(seed)), id_col)
        .limit(trees * TREE_ROWS)
    )
    dealt = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return top_per_group(dealt, ["tree"], [F.xxhash64(id_col, "tree", F.lit(seed)), F.col(id_col)], TREE_ROWS)


def grow_forest(samples: DataFrame, seed: int) -> DataFrame:
    """Node rows of every tree, grown in parallel."""
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("rank")["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        deepest = math.ceil(math.log2(max(len(x), 2)))
        nodes = []

        def split(rows: np.ndarray, depth: int) -> int:
            me = len(nodes)
            nodes.append(None)
            spread = np.nonzero(rows.max(axis=0) > rows.min(axis=0))[0]
            if depth >= deepest or len(rows) <= 1 or not len(spread):
                nodes[me] = (tree, me, -1, 0.0, -1, -1, depth + average_path(len(rows)))
                return me
            a = int(rng.choice(spread))
            at = float(rng.uniform(rows[:, a].min(), rows[:, a].max()))
            low = rows[:, a] < at
            left = split(rows[low], depth + 1) if low.any() else -1
            if left < 0:
                nodes[me] = (tree, me, -1, 0.0, -1, -1, depth + average_path(len(rows)))
                return me
            right = split(rows[~low], depth + 1)
            nodes[me] = (tree, me, a, at, left, right, 0.0)
            return me

        split(x, 0)
        return pd.DataFrame(nodes, columns=["tree", "node", "axis", "cut", "left", "right", "path"])

    return samples.groupBy("tree").applyInPandas(
        grow, "tree int, node int, axis int, cut double, left int, right int, path double"
    )


def isolation_scores(df: DataFrame, id_col: str, features: Sequence[str], trees: int = 100, seed: int = 42) -> DataFrame:
    """`(id, score)`: near 1 is isolated fast, below 0.5 is ordinary.

    The forest has at most 511 nodes per tree whatever the table size, so it is
    gathered once and broadcast.
    """
    samples = tree_samples(df, id_col, features, trees, seed)
    table = grow_forest(samples, seed).toPandas().sort_values(["tree", "node"])
    forest = [tuple(g[c].to_numpy() for c in ("axis", "cut", "left", "right", "path")) for _, g in table.groupby("tree")]
    used = samples.filter("tree = 0").count()
    shared = df.sparkSession.sparkContext.broadcast((forest, average_path(used)))

    @F.pandas_udf(DoubleType())
    def score(x: pd.Series) -> pd.Series:
        trees_, usual = shared.value
        m = np.stack(x.to_numpy())
        total = np.zeros(len(m))
        for axis, cut, left, right, path in trees_:
            node = np.zeros(len(m), dtype=int)
            while True:
                inner = np.nonzero(axis[node] >= 0)[0]
                if not len(inner):
                    break
                n = node[inner]
                node[inner] = np.where(m[inner, axis[n]] < cut[n], left[n], right[n])
            total += path[node]
        return pd.Series(2.0 ** (-(total / len(trees_)) / (usual or 1.0)))

    return df.select(F.col(id_col).alias("id"), score(F.array(*[F.col(c).cast("double") for c in features])).alias("score"))
