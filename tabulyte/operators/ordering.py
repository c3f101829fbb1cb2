"""Ordered computations over tables of any size.

A window without a partition key, or with a hot one, sends its rows to one
task.  Here the order is cut into blocks of roughly equal size, as many as the
session has shuffle partitions: the cut points are every n-th value of a sample
of bounded size chosen by hash, so each evaluation finds the same ones.  A running value is then the value inside the block combined
with the value carried in from the earlier blocks of the same key, and the
carried table has at most one row per key and block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.session import written

SAMPLE_PER_BLOCK = 24
MAX_BLOCKS = 16_384

_COMBINE = {
    "sum": lambda inside, carried: inside + F.coalesce(carried, F.lit(0)),
    "max": lambda inside, carried: F.greatest(inside, carried),
    "min": lambda inside, carried: F.least(inside, carried),
    "product": lambda inside, carried: inside * F.coalesce(carried, F.lit(1.0)),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "product": F.product}
#: Up to so many rows an order is one block: sorting them in a task is quicker than cutting.
ONE_BLOCK = 65_536


def _block_count(df: DataFrame) -> int:
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(2, min(int(setting), MAX_BLOCKS))


def thinned(df: DataFrame, cols: Sequence[str], target: int, seed: int = 42) -> DataFrame:
    """About `target` rows, or all of a smaller table, chosen by a hash of `cols`.

    The share to keep follows from the exact row count, so every task filters its
    own rows, nothing is gathered to choose them, and a repeat finds the same ones.
    """
    hash_range = 1 << 31
    n = df.agg(F.count(F.lit(1))).scalar()
    spot = F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(hash_range))
    return df.withColumn("_n", n).filter(spot * F.col("_n").cast("double") < float(target * hash_range)).drop("_n")


def with_blocks(df: DataFrame, order: Sequence[str], name: str = "_block", keys: Sequence[str] = ()) -> DataFrame:
    """Add the number of the block of the order that each row falls in.

    The sample hashes the order together with the keys, so a value that many keys
    share is not drawn with all of them.
    """
    blocks = _block_count(df)
    group = max(2, int(blocks**0.5))
    key = F.struct(*[F.col(c) for c in order])
    drawn = list(dict.fromkeys([*order, *keys]))
    sample = thinned(df.select(*drawn), drawn, blocks * SAMPLE_PER_BLOCK)
    cuts = sample.agg(F.sort_array(F.collect_list(key)).alias("k")).withColumn(
        "step", F.greatest(F.lit(1), F.floor(F.size("k") / blocks)).cast("int")
    )
    cuts = cuts.select(F.filter("k", lambda _, i: i % F.col("step") == F.col("step") - 1).alias("fine"))
    cuts = cuts.select(
        F.struct("fine", F.filter("fine", lambda _, i: i % group == 0).alias("coarse"))
    ).scalar()
    at_or_below = lambda arr: F.size(F.filter(arr, lambda b: b <= F.col("_key")))
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("_key", key)
        .withColumn("_coarse", at_or_below(F.col("_cuts.coarse")))
        .withColumn(
            name,
            F.when(F.col("_coarse") == 0, F.lit(0)).otherwise(
                (F.col("_coarse") - 1) * group
                + at_or_below(
                    F.slice(F.col("_cuts.fine"), (F.col("_coarse") - 1) * group + 1, F.lit(group))
                )
            ),
        )
        .drop("_cuts", "_key", "_coarse")
    )


Measures = Mapping[str, tuple[str, str | Column]]


def running(
    df: DataFrame,
    order: Sequence[str],
    out: Measures,
    keys: Sequence[str] = (),
    reverse: bool = False,
    totals: bool = False,
    ahead: Measures | None = None,
) -> DataFrame:
    """Running `sum`, `max`, `min` or `product` in the given order, inclusive of the row.

    `order` must identify a row within its keys (aggregate to distinct values
    first, or add an id).  `reverse` accumulates from the far end, as do the
    measures in `ahead`, which share the blocks and the shuffle of `out`;
    `totals` adds `<name>_total`, the value over the whole key.  The input is written
    once to the shared folder: the count, the sample, the blocks and the rows inside
    them all read that table and not the plan behind it.
    """
    keys = list(keys)
    part = [*keys, "_block"]
    measures = {n: (a, c, reverse) for n, (a, c) in out.items()}
    measures.update({n: (a, c, True) for n, (a, c) in (ahead or {}).items()})
    wanted = df.columns
    df = df.select("*", *[_as_column(c).alias(f"_v_{n}") for n, (_, c, _) in measures.items()])
    table = written(df, "ordered")
    small = table.count() <= ONE_BLOCK
    blocked = table.withColumn("_block", F.lit(0)) if small else with_blocks(table, order, keys=keys)

    def toward(backward: bool, c: str) -> Column:
        return F.col(c).desc() if backward else F.col(c).asc()

    def within(backward: bool):
        w = W.partitionBy(*part).orderBy(*[toward(backward, c) for c in order])
        return w.rowsBetween(W.unboundedPreceding, 0)

    def before(backward: bool):
        return W.partitionBy(*keys).orderBy(toward(backward, "_block")).rowsBetween(W.unboundedPreceding, -1)

    inside = blocked.select(
        "*", *[_AGG[a](f"_v_{n}").over(within(back)).alias(f"_i_{n}") for n, (a, _, back) in measures.items()]
    )
    if small:
        whole = W.partitionBy(*part)
        inside = inside.select("*", *[_AGG[a](f"_v_{n}").over(whole).alias(f"{n}_total") for n, (a, _, _) in measures.items() if totals])
        kept = [F.col(c) for c in wanted if c not in measures]
        return inside.select(*kept, *[F.col(f"_i_{n}").alias(n) for n in measures], *[f"{n}_total" for n in measures if totals])
    per_block = blocked.groupBy(*part).agg(
        *[_AGG[a](f"_v_{n}").alias(f"_b_{n}") for n, (a, _, _) in measures.items()]
    )
    carried = per_block.select(
        *[F.col(c).alias(f"_k_{c}") for c in part],
        *[_AGG[a](f"_b_{n}").over(before(back)).alias(f"_c_{n}") for n, (a, _, back) in measures.items()],
        *[
            _AGG[a](f"_b_{n}").over(W.partitionBy(*keys)).alias(f"{n}_total")
            for n, (a, _, _) in measures.items()
            if totals
        ],
    )
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    match.append(F.col("_block") == F.col("_k__block"))
    joined = inside.join(carried, match, "left")
    combined = [_COMBINE[a](F.col(f"_i_{n}"), F.col(f"_c_{n}")).alias(n) for n, (a, _, _) in measures.items()]
    kept = [F.col(c) for c in wanted if c not in measures]
    return joined.select(*kept, *combined, *[f"{n}_total" for n in measures if totals])


def positions(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "pos",
    reverse: bool = False,
    totals: bool = False,
) -> DataFrame:
    """1-based row number in the given order, within `keys`."""
    return running(df, order, {name: ("sum", F.lit(1))}, keys, reverse, totals)


def value_counts(
    df: DataFrame, value: str, keys: Sequence[str] = (), **weights: Column
) -> DataFrame:
    """Distinct non-null values with their row counts and optional summed weights."""
    extra = [F.sum(c).alias(n) for n, c in weights.items()]
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )


def ranked_values(
    df: DataFrame, value: str, keys: Sequence[str] = (), **weights: Column
) -> DataFrame:
    """Distinct values with count `n`, cumulative count `cum`, group size
    `cum_total`, average-tie rank `avg_rank`, and the running sums of weights."""
    counts = value_counts(df, value, keys, **weights)
    out = {"cum": ("sum", "n")}
    out.update({f"cum_{n}": ("sum", n) for n in weights})
    ranked = running(counts, [value], out, keys, totals=True)
    return ranked.withColumn("avg_rank", F.col("cum") - (F.col("n") - 1) / 2.0)


def quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, from distinct values."""
    ranked = running(
        value_counts(df, value, keys), [value], {"_cum": ("sum", "n")}, keys, totals=True
    )
    at = lambda p: (F.col("_cum_total") - 1) * F.lit(float(p))
    aggs = []
    for name, p in probs.items():
        aggs += [
            F.min(F.when(F.col("_cum") > F.floor(at(p)), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > F.ceil(at(p)), F.col(value))).alias(f"_hi_{name}"),
        ]
    summed = ranked.groupBy(*keys).agg(F.max("_cum_total").alias("_cum_total"), *aggs)
    exprs = [
        (
            F.col(f"_lo_{n}")
            + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (at(p) - F.floor(at(p)))
        ).alias(n)
        for n, p in probs.items()
    ]
    return summed.select(*keys, *exprs)


def melt(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form `(ids, feature, value)` of numeric columns."""
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot(list(ids), list(cols), "feature", "value")


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
