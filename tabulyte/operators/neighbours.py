"""Exact nearest neighbours and what is built on them.

Identical rows collapse to one weighted point, so copies cannot crowd a group.
Points are dealt to the leaves of a space partition that is cut level by level, each
leaf that is still too large on a bounded sample of its own rows, so leaves keep their
size however many points there are.  The tree is a table: every inner node lists the
boxes of its children.

The search is best-first, in rounds.  A point first searches its own leaf, which bounds
the distance of its k-th neighbour.  Then, in each round, points with nodes left that are
nearer than their bound go to the nearest few of them: an inner node answers with its
children, a leaf with its nearest points, and the bound shrinks.  A point is done when no
node is left within its bound.  Visitors of a crowded leaf are spread over several copies
of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import count
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.operators.ordering import quantiles
from tabulyte.session import discarded, written

LEAF_ROWS = 2048
#: Children of a node at most, and sample rows per child.
FAN, SAMPLE_PER_LEAF = 256, 16
VISITORS_PER_TASK = 20_000
#: Questions for the children of a node that go to Python at once; each has up to FAN answers.
ASKS_PER_TASK = 4_000
#: Nodes a point goes to in the first round; four times as many in each further one.
FIRST_VISITS = 3


def complete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows in which every feature is a number."""
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.filter(reduce(and_, [known(c) for c in features]))


def weighted_points(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """One row per distinct feature vector: smallest id, number of rows, vector.

    Rows with a null or NaN feature have no distance to others and are left out.
    """
    rows = complete(df, features).select(id_col, *[F.col(c).cast("double").alias(c) for c in features])
    return rows.groupBy(*features).agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("w")).select(
        "id", "w", F.array(*features).alias("x")
    )


def _cut(rows: np.ndarray):
    """Axis, value and share of the rows below it: the widest axis that its median
    divides well, or else the best divided one.  Where the median is the smallest value
    (many equal values), the cut is at the next larger one."""
    low = rows.min(axis=0)
    at = np.median(rows, axis=0)
    above = np.where(rows > low, rows, np.inf).min(axis=0)
    at = np.where(at > low, at, above)
    share = (rows < at).mean(axis=0)
    share[~np.isfinite(at)] = 0.0
    good = np.minimum(share, 1 - share)
    width = rows.max(axis=0) - low
    a = int(np.argmax(np.where(good >= 0.25, width, -1.0))) if (good >= 0.25).any() else int(np.argmax(good))
    return a, float(at[a]), float(share[a])


def _cut_space(sample: np.ndarray, leaves: int):
    """Axis, cut and children of each node; a leaf has child -1 and its number."""
    axis, cut, left, right, leaf = [], [], [], [], []
    number = count()

    def grow(rows: np.ndarray, want: int) -> int:
        me = len(axis)
        for store, v in ((axis, -1), (cut, 0.0), (left, -1), (right, -1), (leaf, -1)):
            store.append(v)
        if want > 1 and len(rows) >= 2:
            a, at, share = _cut(rows)
            if 0.0 < share < 1.0:
                low = rows[:, a] < at
                axis[me], cut[me] = a, at
                below = min(max(round(want * share), 1), want - 1)
                left[me] = grow(rows[low], below)
                right[me] = grow(rows[~low], want - below)
                return me
        leaf[me] = next(number)
        return me

    grow(sample, leaves)
    return tuple(np.array(v) for v in (axis, cut, left, right, leaf))


def _leaf_of(x: np.ndarray, tree) -> np.ndarray:
    axis, cut, left, right, leaf = tree
    node = np.zeros(len(x), dtype=int)
    while True:
        open_ = left[node] >= 0
        if not open_.any():
            return leaf[node]
        n = node[open_]
        rows = np.nonzero(open_)[0]
        goes_left = x[rows, axis[n]] < cut[n]
        node[open_] = np.where(goes_left, left[n], right[n])


def _nearest(query: np.ndarray, points: np.ndarray, weights: np.ndarray, k: int, own: np.ndarray | None):
    """For a block of queries, the nearest points until their weights reach k, as
    arrays of query row, point row, distance and weight.  Of points at the last
    distance, the first k stay, whatever their weights.

    `own` gives each query's own row among the points: it counts one copy less,
    and is left out when no other copy remains.
    """
    d = np.sqrt(np.maximum(((query[:, None, :] - points[None, :, :]) ** 2).sum(axis=2), 0.0))
    few = min(len(points), k + 1)
    far = np.partition(d, few - 1, axis=1)[:, few - 1 : few] if few < len(points) else np.full((len(d), 1), np.inf)
    row, near = np.nonzero(d <= far)
    dist = d[row, near]
    order = np.lexsort((near, dist, row))
    row, near, dist = row[order], near[order], dist[order]
    w = weights[near]
    if own is not None:
        w = w - (near == own[row])
        row, near, dist, w = row[w > 0], near[w > 0], dist[w > 0], w[w > 0]
    if not len(row):
        return row, near, dist, w
    before = np.cumsum(w) - w
    tie = np.concatenate([[True], (row[1:] != row[:-1]) | (dist[1:] != dist[:-1])])
    first = np.maximum.accumulate(np.where(tie, np.arange(len(row)), 0))
    start = np.searchsorted(row, row)
    use = (before[first] - before[start] < k) & (np.arange(len(row)) - first < k)
    return row[use], near[use], dist[use], w[use]


def _neighbour_rows(query, qid, points, pid, weights, k, bound) -> pd.DataFrame:
    """The nearest points of all queries of one task within their bounds."""
    parts = []
    for rows in _slices(len(query), points):
        r, j, d, w = _nearest(query[rows], points, weights, k, None)
        part = pd.DataFrame({"id": qid[rows][r], "nb": pid[j], "d": d, "w": w})
        parts.append(part[part["d"].to_numpy() <= bound[rows][r]])
    return pd.concat(parts, ignore_index=True)


NEIGHBOUR = "id bigint, nb bigint, d double, w bigint"


def _slices(rows: int, points: np.ndarray):
    """Query slices whose distance block stays within a few dozen megabytes."""
    step = max(1, 4_000_000 // max(points.size, 1))
    return [np.arange(at, min(at + step, rows)) for at in range(0, rows, step)]


def knn(points: DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """`(id, nb, d, w)`: nearest points of each point until they stand for k rows.

    `w` is the number of rows taken from the neighbour; they add up to k, or to
    all other rows when there are fewer.  Ties go to the smaller id of a point.
    """
    return _first_k(_candidates(written(points, "points"), k, leaf_rows), k)


def knn_rows(df: DataFrame, id_col: str, features: Sequence[str], k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """`(id, nb, d)`: the k nearest other rows of every row, ties to the smaller id.

    Copies are rows of their own, at distance 0.  Rows with a null or NaN feature
    neither have nor are neighbours.  The search runs on distinct vectors; at most
    k + 1 rows of a vector can be among the nearest of another.
    """
    points = written(weighted_points(df, id_col, features), "points")
    vector = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    members = written(
        complete(df, features).select(F.col(id_col).alias("row"), vector).join(points.select(F.col("id").alias("v"), "x"), "x").select("v", "row"), "members")
    some = members.withColumn("_n", F.row_number().over(W.partitionBy("v").orderBy("row"))).filter(F.col("_n") <= k + 1).drop("_n")
    near = _candidates(points, k, leaf_rows).select("id", "nb", "d")
    # a vector is its own neighbour once, however many copies it has
    near = near.filter("id <> nb").unionByName(points.select("id", F.col("id").alias("nb"), F.lit(0.0).alias("d")))
    rows = near.join(some, F.col("nb") == F.col("v")).select("id", "d", "row")
    rows = rows.withColumn("_n", F.row_number().over(W.partitionBy("id").orderBy("d", "row"))).filter(F.col("_n") <= k + 1)
    lists = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "row"))).alias("near"))
    own = members.join(lists, F.col("v") == F.col("id")).select(F.col("row").alias("id"), "near")
    others = F.slice(F.filter("near", lambda n: n["row"] != F.col("id")), 1, k)
    return own.select("id", F.explode(others).alias("n")).select("id", F.col("n.row").alias("nb"), F.col("n.d").alias("d"))


def _child(node, number):
    return node * (FAN + 1) + number + 1


def _split(placed: DataFrame, big: DataFrame, leaf_rows: int) -> DataFrame:
    """`placed` with the rows of the leaves in `big` (leaf, rows) dealt to new leaves."""
    want = F.least(F.lit(FAN), F.ceil(F.col("rows") / leaf_rows)).cast("int")
    spot = F.pmod(F.xxhash64("id", F.lit(42)), F.lit(1 << 30)) / float(1 << 30)
    sizes = big.select(F.col("leaf").alias("_leaf"), "rows", want.alias("want"))
    sample = placed.join(sizes, F.col("leaf") == F.col("_leaf")).filter(spot * F.col("rows") < F.col("want") * SAMPLE_PER_LEAF + 64)
    tree = "leaf bigint, axis array<int>, cut array<double>, left array<int>, right array<int>, number array<int>"

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        parts = _cut_space(np.stack(pdf["x"].to_numpy()), int(pdf["want"].iloc[0]))
        return pd.DataFrame([[pdf["leaf"].iloc[0], *[p.tolist() for p in parts]]], columns=["leaf", "axis", "cut", "left", "right", "number"])

    trees = written(sample.select("leaf", "want", "id", "x").groupBy("leaf").applyInPandas(cut, tree), "trees")
    # the cuts of a leaf travel once for many of its rows, not with every row
    groups = big.select("leaf", F.ceil(F.col("rows") / VISITORS_PER_TASK).cast("int").alias("parts"))
    rows, cuts = _by_parts(placed, trees, groups, "leaf")

    def deal(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(tree):
            return pd.DataFrame({"id": [], "w": [], "x": [], "leaf": []})
        one = tree.iloc[0]
        parts = [np.asarray(one[c]) for c in ("axis", "cut", "left", "right", "number")]
        leaf = _child(int(one["leaf"]), _leaf_of(np.stack(rows["x"].to_numpy()), parts))
        return rows[["id", "w", "x"]].assign(leaf=leaf)

    dealt = rows.select("id", "w", "x", "leaf", "part").groupBy("leaf", "part").cogroup(cuts.groupBy("leaf", "part")).applyInPandas(
        deal, "id bigint, w bigint, x array<double>, leaf bigint")
    return written(placed.join(big.select("leaf"), "leaf", "left_anti").select(*dealt.columns).unionByName(dealt), "placed")


def _by_parts(many: DataFrame, one: DataFrame, groups: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `many` dealt to the parts of their key, and the row of the key in `one`
    once per part; `groups` has (key, parts)."""
    dealt = many.join(groups, key).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    copies = one.join(groups, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return dealt, copies


def _partition(points: DataFrame, leaf_rows: int) -> tuple[DataFrame, int]:
    """Points with their leaf: 0, or a child of a child ... of the root 0; and the number
    of levels below the root."""
    placed, depth = points.select("id", "w", "x", F.lit(0).cast("bigint").alias("leaf")), 0
    while True:
        sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"))
        big = sizes.filter(F.col("rows") > 2 * leaf_rows)
        if big.isEmpty():  # points differ, so every split divides and this ends
            return placed, depth
        after = _split(placed, big, leaf_rows)
        if depth:
            discarded(placed)
        placed, depth = after, depth + 1


BOX = "array<struct<node: bigint, lo: array<double>, hi: array<double>>>"
NEAR = "array<struct<d: double, nb: bigint, w: bigint>>"
NODES = "array<struct<gap: double, node: bigint>>"
STATE = f"id bigint, x array<double>, home bigint, bound double, near {NEAR}, todo {NODES}"


def _corners(rows: DataFrame, key: str, lo: str, hi: str, dims: int) -> DataFrame:
    side = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(dims)])
    return rows.groupBy(F.col(key).alias("node")).agg(side(F.min, lo).alias("lo"), side(F.max, hi).alias("hi"))


def _tree(nodes: DataFrame, dims: int) -> DataFrame:
    """`(node, children)` of every inner node above the leaves (node, lo, hi); a child has
    its number and its box."""
    levels = []
    while True:
        below = nodes.filter("node > 0").withColumn("parent", F.floor((F.col("node") - 1) / (FAN + 1)))
        # leaves lie at several depths: the parents of the deepest level come first
        deep = below.agg(F.max("parent")).first()[0]
        if deep is None:
            return written(reduce(DataFrame.unionByName, levels), "tree")
        ready = below.filter(F.col("parent") >= _first_of_level(deep))
        levels.append(ready.groupBy("parent").agg(F.sort_array(F.collect_list(F.struct("node", "lo", "hi"))).alias("children")).withColumnRenamed("parent", "node"))
        nodes = written(nodes.join(ready.select("node"), "node", "left_anti").unionByName(_corners(ready, "parent", "lo", "hi", dims)), "boxes")


def _first_of_level(node: int) -> int:
    """The smallest possible number of a node on the level of this one."""
    first = 0
    while _child(first, 0) <= node:
        first = _child(first, 0)
    return first


def _lists(row: np.ndarray, n: int, **fields: np.ndarray) -> pa.Array:
    """A list per row number 0 .. n - 1 of structs; the entries come ordered by row."""
    at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields)))


def _gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distances of points to boxes, in slices of points: the first point and the block."""
    step = max(1, 4_000_000 // lo.size)
    for at in range(0, len(x), step):
        y = x[at : at + step, None, :]
        yield at, np.sqrt((np.maximum(np.maximum(lo[None] - y, y - hi[None]), 0.0) ** 2).sum(axis=2))


def _boxes(children) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array([c["node"] for c in children]), np.stack([c["lo"] for c in children]), np.stack([c["hi"] for c in children])


def _started(placed: DataFrame, root, k: int) -> DataFrame:
    """Every point with its nearest in its own leaf, their bound, and the children of the
    root within it.  `root` has at most FAN boxes, or none where all is one leaf."""

    def search(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy())
        table = table.take(pa.array(order)).combine_chunks()
        ids, w = table.column("id").to_numpy(), table.column("w").to_numpy()
        vectors = table.column("x").combine_chunks()
        x = vectors.flatten().to_numpy().reshape(len(ids), -1)
        parts = [(rows, _nearest(x[rows], x, w, k, rows)) for rows in _slices(len(x), x)]
        row, near, dist, weight = [np.concatenate(c) for c in zip(*[(rows[r], j, d, v) for rows, (r, j, d, v) in parts])]
        reach = np.bincount(row, weight, len(ids)) >= k
        bound = np.full(len(ids), -np.inf)
        np.maximum.at(bound, row, dist)
        bound = np.where(reach, bound, np.inf)
        home = table.column("leaf").to_numpy()
        todo = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        if root is not None:
            number, lo, hi = _boxes(root)
            for at, gap in _gaps(x, lo, hi):
                part = slice(at, at + len(gap))
                r, c = np.nonzero((gap <= bound[part, None]) & (number[None] != home[part, None]))
                order = np.lexsort((number[c], gap[r, c], r))
                todo.append((at + r[order], gap[r, c][order], number[c][order]))
        at, gap, node = [np.concatenate(c) for c in zip(*todo)]
        return pa.table({
            "id": table.column("id"), "x": vectors, "home": table.column("leaf"), "bound": pa.array(bound),
            "near": _lists(row, len(ids), d=dist, nb=ids[near], w=weight), "todo": _lists(at, len(ids), gap=gap, node=node),
        })

    return placed.groupBy("leaf").applyInArrow(search, STATE)


def _candidates(points: DataFrame, k: int, leaf_rows: int) -> DataFrame:
    """All points that can be among the k nearest rows of each point, with ties."""
    placed, depth = _partition(points, leaf_rows)
    tree = root = None
    if depth:
        dims = placed.select(F.size("x")).first()[0]
        boxes = _corners(placed, "leaf", "x", "x", dims)
        if depth > 1:
            tree = _tree(written(boxes, "boxes"), dims)
        root = tree.filter("node = 0").first()["children"] if tree else boxes.collect()  # at most FAN boxes
    state = written(_started(placed, root, k), "search")
    done, visits = [], FIRST_VISITS
    while True:
        done.append(state.filter(F.size("todo") == 0).select("id", "near"))
        open_ = state.filter(F.size("todo") > 0)
        if not depth or open_.isEmpty():
            break
        state = written(_round(open_, placed, tree, k, visits), "search")
        visits *= 4
    near = reduce(DataFrame.unionByName, done).select("id", F.explode("near").alias("n"))
    return near.select("id", "n.nb", "n.d", "n.w")


def _bounded(state: DataFrame, k: int) -> DataFrame:
    """Put `_new` neighbours into `near` and drop what lies beyond the k-th row: `bound`
    is its distance.  Of points at that distance the first k stay."""
    merged = F.array_sort(F.concat("near", F.coalesce("_new", F.array().cast(NEAR))))
    start = F.struct(F.lit(0).cast("bigint").alias("rows"), F.lit(float("inf")).alias("d"))
    reached = F.aggregate("_all", start, lambda a, n: F.when(a["rows"] >= k, a).otherwise(F.struct((a["rows"] + n["w"]).alias("rows"), n["d"].alias("d"))))
    state = state.withColumn("_all", merged).withColumn("_end", reached)
    state = state.withColumn("bound", F.when(F.col("_end.rows") >= k, F.col("_end.d")).otherwise(F.lit(float("inf"))))
    nearer = F.size(F.filter("_all", lambda n: n["d"] < F.col("bound")))
    within = F.slice(F.filter("_all", lambda n: n["d"] <= F.col("bound")), 1, nearer + k)
    todo = F.filter("todo", lambda t: t["gap"] <= F.col("bound"))
    return state.withColumns({"near": within, "todo": todo}).select("id", "x", "home", "bound", "near", "todo")


def _opened(asks: DataFrame, tree: DataFrame) -> DataFrame:
    """Children, within the bound, of the inner nodes that points ask for."""

    def measure(some: pd.DataFrame, inner: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"id": [], "gap": [], "node": []})]
        if len(some) and len(inner):
            number, lo, hi = _boxes(inner["children"].iloc[0])
            found = []
            for at, gap in _gaps(np.stack(some["x"].to_numpy()), lo, hi):
                part = some.iloc[at : at + len(gap)]
                r, c = np.nonzero((gap <= part["bound"].to_numpy()[:, None]) & (number[None] != part["home"].to_numpy()[:, None]))
                found.append(pd.DataFrame({"id": part["id"].to_numpy()[r], "gap": gap[r, c], "node": number[c]}))
        return pd.concat(found, ignore_index=True)

    # the boxes of a node travel once for many questions, not with each
    crowds = asks.join(tree.select("node"), "node").groupBy("node").agg(F.ceil(F.count(F.lit(1)) / ASKS_PER_TASK).cast("int").alias("parts"))
    rows, inner = _by_parts(asks, tree, crowds, "node")
    return rows.select("id", "x", "home", "bound", "node", "part").groupBy("node", "part").cogroup(inner.groupBy("node", "part")).applyInPandas(
        measure, "id bigint, gap double, node bigint")


def _merged(state: DataFrame, opened: DataFrame) -> DataFrame:
    """The states with further nodes to visit, nearest first."""
    more = opened.groupBy("id").agg(F.collect_list(F.struct("gap", "node")).alias("_more"))
    later = F.array_sort(F.concat("todo", F.coalesce("_more", F.array().cast(NODES))))
    return state.join(more, "id", "left").withColumn("todo", later).drop("_more")


def _round(state: DataFrame, placed: DataFrame, tree: DataFrame | None, k: int, visits: int) -> DataFrame:
    """The states after a visit to the nearest `visits` nodes that are left; without a
    tree all of them are leaves."""
    asks = state.select("id", "x", "home", "bound", F.explode(F.slice("todo", 1, visits)).alias("t")).select("id", "x", "home", "bound", F.col("t.node").alias("node"))
    asks = written(asks, "asks")
    leaves = asks.join(tree.select("node"), "node", "left_anti") if tree else asks
    guests = leaves.withColumnRenamed("node", "leaf")
    crowds = guests.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / VISITORS_PER_TASK).cast("int").alias("parts"))
    guests = guests.join(crowds, "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    hosts = placed.join(crowds, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def receive(key: tuple, guest: pd.DataFrame, host: pd.DataFrame) -> pd.DataFrame:
        if not len(guest) or not len(host):
            return pd.DataFrame({"id": [], "nb": [], "d": [], "w": []})
        host = host.sort_values("id").reset_index(drop=True)
        x, w, ids = np.stack(host["x"].to_numpy()), host["w"].to_numpy(), host["id"].to_numpy()
        q, qid, far = np.stack(guest["x"].to_numpy()), guest["id"].to_numpy(), guest["bound"].to_numpy()
        return _neighbour_rows(q, qid, x, ids, w, k, far)

    found = guests.select("id", "x", "bound", "leaf", "part").groupBy("leaf", "part").cogroup(
        hosts.select("id", "x", "w", "leaf", "part").groupBy("leaf", "part")
    ).applyInPandas(receive, NEIGHBOUR)
    new = found.groupBy("id").agg(F.collect_list(F.struct("d", "nb", "w")).alias("_new"))
    rest = state.withColumn("todo", F.filter("todo", lambda _, i: i >= visits))
    if tree:
        rest = _merged(rest, _opened(asks, tree))
    return _bounded(rest.join(new, "id", "left"), k)


def _first_k(candidates: DataFrame, k: int) -> DataFrame:
    """Keep the nearest candidates of each point until they stand for k rows."""
    nearest = W.partitionBy("id").orderBy("d", "nb")
    before = F.coalesce(F.sum("w").over(nearest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        candidates.withColumn("_before", before).filter(F.col("_before") < k)
        .select("id", "nb", "d", F.least("w", k - F.col("_before")).alias("w"))
    )


def local_outlier_factor(df: DataFrame, id_col: str, features: Sequence[str], k: int = 25) -> DataFrame:
    """`(id, lof)` per row: density of the neighbours over the density of the point."""
    points = weighted_points(df, id_col, features)
    near = written(knn(points, k), "neighbours")
    reach = near.groupBy("id").agg(F.max("d").alias("kdist"))
    mean = lambda c: F.sum(c * F.col("w")) / F.sum("w")
    density = (
        near.join(reach.select(F.col("id").alias("nb"), "kdist"), "nb")
        .groupBy("id").agg((1 / (mean(F.greatest("kdist", "d")) + 1e-10)).alias("lrd"))
    )
    factor = (
        near.join(density.select(F.col("id").alias("nb"), F.col("lrd").alias("_nb_lrd")), "nb")
        .groupBy("id").agg(mean(F.col("_nb_lrd")).alias("_m"))
        .join(density, "id").select("id", (F.col("_m") / F.col("lrd")).alias("lof"))
    )
    by_vector = points.join(factor, "id").select("x", "lof")
    rows = df.select(F.col(id_col).alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    return rows.join(by_vector, "x").select("id", "lof")


def flag_top(scores: DataFrame, col: str, flags: Mapping[str, float]) -> DataFrame:
    """Flag the scores above the (1 - share) quantile, for each named share."""
    limits = quantiles(scores, col, {n: 1 - share for n, share in flags.items()})
    one = limits.select(F.struct(*flags)).scalar()
    return scores.withColumn("_q", one).withColumns({n: F.col(col) > F.col(f"_q.{n}") for n in flags}).drop("_q")


def smote(df: DataFrame, id_col: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add minority rows until both classes of a 0/1 label have the same size.

    A synthetic row lies between a minority row and one of its k nearest ones; how
    many a row gives, which neighbour and how far are fixed by hashes of its id.
    """
    rows = complete(df, features).select(id_col, *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias(label))
    sizes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    minor = min(sizes, key=lambda c: (sizes[c], -c))
    need = max(sizes.values()) - sizes[minor]
    few = rows.filter(F.col(label) == minor)
    if need == 0 or sizes[minor] < 2:
        return rows.withColumn("synthetic", F.lit(False))
    from tabulyte.operators.ordering import positions

    few = written(few, "minority")
    vector = F.array(*features)
    near = knn_rows(few, id_col, features, k).join(few.select(F.col(id_col).alias("nb"), vector.alias("nx")), "nb")
    lists = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "nb", "nx"))).alias("near")).withColumnRenamed("id", "_near_id")
    each, extra = divmod(need, sizes[minor])
    ranked = positions(few.withColumn("_h", F.xxhash64(id_col, F.lit(seed))), ["_h", id_col], name="_pos")
    gives = ranked.withColumn("_copies", F.lit(each) + (F.col("_pos") <= extra).cast("bigint")).filter("_copies > 0")
    base = gives.join(lists, F.col(id_col) == F.col("_near_id"))
    made = base.withColumn("_j", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    pick = F.element_at("near", (F.pmod(F.xxhash64(id_col, "_j", F.lit(seed)), F.size("near")) + 1).cast("int"))
    share = F.pmod(F.xxhash64(id_col, "_j", F.lit(seed + 1)), F.lit(1_000_000)) / 1_000_000.0
    made = made.withColumns({"_nb": pick, "_t": share})
    synthetic = made.select(
        id_col, *[(F.col(c) + F.col("_t") * (F.col("_nb.nx")[i] - F.col(c))).alias(c) for i, c in enumerate(features)],
        F.lit(minor).alias(label), F.lit(True).alias("synthetic"),
    )
    return rows.withColumn("synthetic", F.lit(False)).unionByName(synthetic)


def consensus(a: DataFrame, b: DataFrame, flag_a: str, flag_b: str) -> DataFrame:
    """Rows with how many of the two methods flag them."""
    votes: Column = F.col(flag_a).cast("int") + F.col(flag_b).cast("int")
    return a.select("id", flag_a).join(b.select("id", flag_b), "id").withColumn("votes", votes)
