"""Least squares on a series' own past, from lag Gram matrices.

A regression on lags needs only the sums of products of its columns.  A series is cut
into blocks of rows in time order, each with the few rows before it that its lags reach
back to; a block gives one matrix, Spark adds the matrices of a series, and every lag
order is solved from the one sum.  What reaches a single task is a matrix and the first
or last few values of a series, never the series.

Rows without a value are left out.  A series too short for its lags gives null results."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.operators.ordering import positions
from tabulyte.session import written

BLOCK = 65_536


def gram(rows: DataFrame, keys: Sequence[str], value: str, lags: Column, block: int = BLOCK) -> DataFrame:
    """Per key the matrix of sums of products of the columns

        difference, level before it, differences 1 .. lags before it, 1

    over all rows that have them, in order of `_i` (1 .. `_i_total`): `lags`, `n`, `m`
    (row-wise, ordered) and the first and last `lags + 1` values, in order."""
    placed = rows.select(*keys, F.col(value).cast("double").alias("_x"), "_i", F.col("_i_total").alias("n"), lags.cast("int").alias("lags"))
    placed = written(placed.withColumn("_i", F.col("_i") - 1), "series")
    ends = placed.filter((F.col("_i") <= F.col("lags")) | (F.col("_i") >= F.col("n") - F.col("lags") - 1))
    end = lambda use: F.transform(F.sort_array(F.collect_list(F.when(use, F.struct("_i", "_x")))), lambda v: v["_x"])
    ends = ends.groupBy(*keys, "n", "lags").agg(end(F.col("_i") <= F.col("lags")).alias("first"), end(F.col("_i") >= F.col("n") - F.col("lags") - 1).alias("last"))
    own = F.floor(F.col("_i") / block).cast("long")
    reaches = F.col("_i") % block >= block - F.col("lags") - 2
    dealt = placed.withColumn("_block", F.explode(F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))))
    dealt = dealt.filter(F.col("_block") <= F.floor((F.col("n") - 1) / block))
    key_type = {k: rows.schema[k].dataType.simpleString() for k in keys}

    def products(table: pa.Table) -> pa.Table:
        i = table.column("_i").to_numpy()
        order = np.argsort(i)
        x, k = table.column("_x").to_numpy()[order], table.column("lags")[0].as_py()
        begin = table.column("_block")[0].as_py() * block
        d = np.diff(x)
        at = i[order][1:]  # the row of each difference
        use = np.flatnonzero((at >= begin) & (at > k))
        cols = [d[use], x[use], *[d[use - j] for j in range(1, k + 1)], np.ones(len(use))]
        v = np.column_stack(cols) if len(use) else np.zeros((0, k + 3))
        m = (v.T @ v).ravel()
        head = {c: table.column(c).slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(m), np.int64))) for c in keys}
        return pa.table({**head, "at": pa.array(np.arange(len(m), dtype=np.int32)), "v": pa.array(m)})

    fields = ", ".join(f"`{k}` {t}" for k, t in key_type.items())
    sums = dealt.groupBy(*keys, "_block").applyInArrow(products, f"{fields}, at int, v double").groupBy(*keys, "at").agg(F.sum("v").alias("v"))
    matrix = sums.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda e: e["v"]).alias("m"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return ends.join(matrix.withColumnsRenamed({k: f"_k_{k}" for k in keys}), same).drop(*[f"_k_{k}" for k in keys])


def solved(m: np.ndarray, use: Sequence[int]) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients of column 0 on the columns `use`, the squared error, and the inverse of
    their matrix; columns are scaled to one another first."""
    scale = np.sqrt(np.diag(m))
    scale = np.where(scale > 0, scale, 1.0)
    s = m / np.outer(scale, scale)
    use = list(use)
    inverse = np.linalg.pinv(s[np.ix_(use, use)], rcond=1e-11, hermitian=True)  # columns may depend on each other
    beta = inverse @ s[use, 0]
    sse = max(float(s[0, 0] - s[use, 0] @ beta), 0.0) * scale[0] ** 2
    return beta * scale[0] / scale[use], sse, inverse / np.outer(scale[use], scale[use])


def on_gram(df: DataFrame, keys: Sequence[str], time: str, value: str, lags: Callable[[Column], Column], fit, fields: str, centred: bool = False, block: int = BLOCK) -> DataFrame:
    """`fit(row of gram)` gives the result rows of each key as a frame."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, time, F.col(value).cast("double").alias("_value"))
    rows = positions(rows, [time], keys, name="_i", totals=True)
    if centred:
        mean = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.avg("_value").alias("_mean"))
        rows = rows.join(mean, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]).withColumn("_value", F.col("_value") - F.col("_mean"))
    sums = gram(rows, keys, "_value", lags(F.col("_i_total")), block)
    names = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for b in batches:
            for _, r in b.iterrows():
                out = fit(r)
                for i, k in enumerate(keys):
                    out.insert(i, k, r[k])
                yield out

    return sums.mapInPandas(run, f"{names}, {fields}")


def most_lags(n: Column) -> Column:
    """The usual upper bound 12 (n/100)^(1/4), and no more than half of the rows allow."""
    return F.greatest(F.lit(0), F.least(F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2) - 2)).cast("int")


def _short_rows(first: np.ndarray, lags: int, skip: int) -> np.ndarray:
    """Regression rows of the order `lags` that the matrix of `skip` lags leaves out."""
    d = np.diff(first)
    return np.array([[d[j], first[j], *[d[j - i] for i in range(1, lags + 1)], *[0.0] * (skip - lags), 1.0] for j in range(lags, min(skip, len(d)))]).reshape(-1, skip + 3)


def unit_root(row, constant: bool = True) -> tuple[float, int, int] | None:
    """Augmented Dickey-Fuller statistic, the lags chosen by AIC over the same rows, and
    the rows used; None for a series that allows no such regression."""
    n, k = int(row["n"]), int(row["lags"])
    m = np.asarray(row["m"], float).reshape(k + 3, k + 3)
    tail = [k + 2] if constant else []
    use = lambda p: [1, *range(2, 2 + p), *tail]
    count = n - 1 - k
    best, least = None, math.inf
    for p in range(k + 1):
        if count <= len(use(p)):
            break
        try:
            _, sse, _ = solved(m, use(p))
        except np.linalg.LinAlgError:
            break
        aic = count * (math.log(2 * math.pi * sse / count) + 1) + 2 * len(use(p)) if sse > 0 else -math.inf
        if aic < least:
            best, least = p, aic
    if best is None or least == -math.inf:
        return None
    extra = _short_rows(np.asarray(row["first"], float), best, k)
    beta, sse, inverse = solved(m + extra.T @ extra, use(best))
    used = n - 1 - best
    return float(beta[0] / math.sqrt(sse / (used - len(use(best))) * inverse[0, 0])), best, used


def autoregression(row, lags: int, horizon: int) -> pd.DataFrame:
    """Forecasts of the level from an autoregression of its first differences."""
    n, steps = int(row["n"]), np.arange(1, horizon + 1)
    count = n - 1 - lags
    nothing = pd.DataFrame({"step": steps, "forecast": np.nan, "sigma": np.nan}).astype({"forecast": object, "sigma": object}).assign(forecast=None, sigma=None)
    if count <= lags:
        return nothing
    m = np.asarray(row["m"], float).reshape(lags + 3, lags + 3)
    try:
        beta, sse, _ = solved(m, range(2, 2 + lags))
    except np.linalg.LinAlgError:
        return nothing
    last = np.asarray(row["last"], float)
    past, level, out = list(np.diff(last)[-lags:]), last[-1], []
    for _ in steps:
        past.append(float(beta @ past[: -lags - 1 : -1]))
        level += past[-1]
        out.append(level)
    return pd.DataFrame({"step": steps, "forecast": out, "sigma": math.sqrt(sse / count)})
