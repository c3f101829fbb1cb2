"""Linear recurrences over orders of any length: `y = q * y_before + x`.

A recursion looks sequential, but the rows of a short block compose to one affine map:
what the block adds, and the power of q that it multiplies what came before with.
Inside a block of bounded length the recursion is a running sum of scaled values; the
maps of all blocks form a recurrence of the same kind, a block's length shorter, and so
on until one block is left.  No series, however long, meets in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tabulyte.operators.ordering import positions
from tabulyte.session import written

BLOCK = 256
#: Powers of q inside a block stay above exp(-SPREAD), so their inverses are finite.
SPREAD = 300.0


def _inside(rows: DataFrame, keys: Sequence[str], q: Mapping[str, float], block: int) -> DataFrame:
    """Values of the recurrence inside blocks of `_i`, as if each began at zero."""
    rows = rows.withColumns({"_block": F.floor(F.col("_i") / block), "_r": F.col("_i") % block})
    so_far = W.partitionBy(*keys, "_block").orderBy("_r").rowsBetween(W.unboundedPreceding, 0)
    scaled = {f"_s_{n}": F.col(n) * F.pow(F.lit(1 / f), F.col("_r")) for n, f in q.items()}
    rows = rows.withColumns(scaled)
    return rows.withColumns({n: F.sum(f"_s_{n}").over(so_far) * F.pow(F.lit(f), F.col("_r")) for n, f in q.items()}).drop(*scaled)


def scan(rows: DataFrame, keys: Sequence[str], q: Mapping[str, float]) -> DataFrame:
    """Replace each column named in `q` by its recurrence in the order of `_i`, which
    counts the rows of a key from 0 without gaps."""
    small = {n: f for n, f in q.items() if -math.log(f) > SPREAD / 2} if all(f > 0 for f in q.values()) else dict(q)
    if small:  # the square of such a factor adds nothing to a double: one step back is all
        before = W.partitionBy(*keys).orderBy("_i")
        near = rows.withColumns({n: F.col(n) + f * F.coalesce(F.lag(n).over(before), F.lit(0.0)) for n, f in small.items()})
        rest = {n: f for n, f in q.items() if n not in small}
        return scan(near, keys, rest) if rest else near
    if not q:
        return rows
    block = max(2, min(BLOCK, *[int(SPREAD / -math.log(f)) for f in q.values()]))
    inside = written(_inside(rows, keys, q, block), "recurrence")
    # of every full block what it adds to the rows after it
    maps = inside.filter(F.col("_r") == block - 1).select(*keys, F.col("_block").alias("_i"), *q)
    if maps.isEmpty():
        return inside.drop("_block", "_r")
    ends = scan(maps, keys, {n: f**block for n, f in q.items()})
    carried = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], (F.col("_i") + 1).alias("_after"), *[F.col(n).alias(f"_c_{n}") for n in q])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block") == F.col("_after")]
    joined = inside.join(carried, same, "left")
    full = {n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0.0)) * F.pow(F.lit(f), F.col("_r") + 1) for n, f in q.items()}
    return joined.withColumns(full).drop("_block", "_r", "_after", *[f"_k_{k}" for k in keys], *[f"_c_{n}" for n in q])


def exponential_means(df: DataFrame, keys: Sequence[str], order: str, means: Mapping[str, tuple[str, float]]) -> DataFrame:
    """`y = a * x + (1 - a) * y_before` per key, from y = x at the first row: for each name
    the column x and the weight a in (0, 1).  All columns must hold values in the same
    rows; rows without stay out and get a null mean.  Rows of a key are told apart by `order`."""
    known = [F.col(c).isNotNull() for c in dict.fromkeys(c for c, _ in means.values())]
    all_known = known[0]
    for k in known[1:]:
        all_known &= k
    placed = positions(df.filter(all_known), [order], keys, name="_i").withColumn("_i", F.col("_i") - 1)
    start = {n: F.col(c).cast("double") * F.when(F.col("_i") == 0, F.lit(1.0)).otherwise(F.lit(a)) for n, (c, a) in means.items()}
    out = scan(placed.withColumns(start), keys, {n: 1 - a for n, (_, a) in means.items()}).drop("_i")
    gaps = df.filter(~all_known).withColumns({n: F.lit(None).cast("double") for n in means})
    return out.select(*df.columns, *means).unionByName(gaps.select(*df.columns, *means))
