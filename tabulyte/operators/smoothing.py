"""Additive trend and season by exponential smoothing, for series of any length.

With its weights fixed, one step of the smoothing is an affine map of the state (level,
slope and the seasons from the current one on).  The maps of a block of rows compose to
one, whose linear part is a power of the step's matrix and whose constant part is the
state that the block reaches from zero.  So the state at the start of every block follows
from one value per block, and all blocks then measure their squared errors at once, for
every set of weights.  The best set is refined on a finer grid around it.

A series of at most one block is smoothed in the task that holds it."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.operators.ordering import positions
from tabulyte.session import written

BLOCK = 65_536
GRID, ROUNDS = 5, 4
LOW, HIGH = 0.02, 0.98
_CELLS = 4_000_000  # numbers of a stack of matrices


def weights_around(centre: Sequence[float] | None, width: float, seasonal: bool) -> np.ndarray:
    """Sets of weights (level, slope, season): a grid over all, or around a set."""
    axes = []
    for k in range(3):
        if k == 2 and not seasonal:
            axes.append(np.zeros(1))
        elif centre is None:
            axes.append(np.linspace(LOW, HIGH, GRID))
        else:
            axes.append(np.unique(np.clip(np.linspace(centre[k] - width, centre[k] + width, GRID), LOW / 4, 1 - LOW / 4)))
    return np.stack([v.ravel() for v in np.meshgrid(*axes, indexing="ij")], axis=1)


def first_state(head: np.ndarray, period: int) -> np.ndarray:
    """Level, slope and seasons from the first two periods; without them one season of 0."""
    if period < 2 or len(head) < 2 * period:
        return np.array([head[0], head[1] - head[0] if len(head) > 1 else 0.0, 0.0])
    level = head[:period].mean()
    return np.concatenate([[level, (head[period : 2 * period].mean() - level) / period], head[:period] - level])


def run(x: np.ndarray, state: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared one-step errors and the states after the values, for every set of weights;
    `state` has a row per set."""
    a, b, g = weights.T
    level, slope, season = state[:, 0].copy(), state[:, 1].copy(), state[:, 2:].T.copy()
    width, sse = len(season), np.zeros(len(weights))
    for t, v in enumerate(x):
        s = season[t % width]
        ahead = level + slope
        err = v - ahead - s
        sse += err * err
        new = a * (v - s) + (1 - a) * ahead
        slope = b * (new - level) + (1 - b) * slope
        season[t % width] = g * (v - new) + (1 - g) * s
        level = new
    return sse, np.concatenate([level[:, None], slope[:, None], np.roll(season, -(len(x) % width), axis=0).T], axis=1)


def step_matrices(weights: np.ndarray, size: int) -> np.ndarray:
    """The linear part of one step, for states of `size` numbers."""
    a, b, g = weights.T
    m = np.zeros((len(weights), size, size))
    level = np.stack([1 - a, 1 - a, -a], axis=1)
    m[:, 0, :3] = level
    m[:, 1, :3] = b[:, None] * level
    m[:, 1, 0] -= b
    m[:, 1, 1] += 1 - b
    if size > 3:
        m[:, np.arange(2, size - 1), np.arange(3, size)] = 1
    m[:, size - 1, :3] += -g[:, None] * level
    m[:, size - 1, 2] += 1 - g
    return m


def after(weights: np.ndarray, state: np.ndarray, steps: int) -> np.ndarray:
    """States after so many steps without any input."""
    out, size = np.empty_like(state), state.shape[1]
    chunk = max(1, _CELLS // size**2)
    for at in range(0, len(weights), chunk):
        part = slice(at, at + chunk)
        power = np.linalg.matrix_power(step_matrices(weights[part], size), steps)
        out[part] = np.einsum("cij,cj->ci", power, state[part])
    return out


def _search(measure, seasonal: bool) -> tuple[np.ndarray, float, np.ndarray]:
    """The best weights, their squared error and the state they end in; `measure` gives
    errors and end states of a set of weights."""
    centre, width = None, (HIGH - LOW) / (GRID - 1) / 2
    best, least, end = None, math.inf, None
    for _ in range(ROUNDS):
        weights = weights_around(centre, width, seasonal)
        sse, ends = measure(weights)
        i = int(np.argmin(np.where(np.isfinite(sse), sse, math.inf)))
        if best is None or sse[i] < least:
            best, least, end = weights[i], float(sse[i]), ends[i]
        centre, width = best, width / 2
    return best, least, end


def ahead(end: np.ndarray, horizon: int) -> np.ndarray:
    steps = np.arange(1, horizon + 1)
    return end[0] + end[1] * steps + end[2:][(steps - 1) % len(end[2:])]


def smooth_forecast(x: np.ndarray, period: int, horizon: int) -> tuple[np.ndarray, float]:
    """Forecast and root mean squared one-step error of one series in memory."""
    start = first_state(x, period)
    _, sse, end = _search(lambda w: run(x, np.tile(start, (len(w), 1)), w), len(start) > 3)
    return ahead(end, horizon), math.sqrt(sse / len(x))


FORECAST = "step int, forecast double, lower double, upper double, rmse double"


def _forecast_rows(values: np.ndarray, rmse: float) -> pd.DataFrame:
    return pd.DataFrame({"step": np.arange(1, len(values) + 1), "forecast": values, "lower": values - 1.96 * rmse, "upper": values + 1.96 * rmse, "rmse": rmse})


def holt_winters(df: DataFrame, keys: Sequence[str], time: str, value: str, period: int, horizon: int, block: int = BLOCK) -> DataFrame:
    """Forecasts per key with a band of 1.96 errors; rows without a value are left out."""
    known = df.filter(F.col(value).isNotNull()).select(*keys, time, F.col(value).cast("double").alias("_x"))
    names = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def keyed(key: Sequence, out: pd.DataFrame) -> pd.DataFrame:
        for i, k in enumerate(keys):
            out.insert(i, k, key[i])
        return out

    longest = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if longest <= block:
        def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return keyed(key, _forecast_rows(*smooth_forecast(pdf.sort_values(time)["_x"].to_numpy(), period, horizon)))

        return known.groupBy(*keys).applyInPandas(whole, f"{names}, {FORECAST}")
    return _blocked(known, keys, time, period, horizon, block, names, keyed)


def _blocked(known: DataFrame, keys: Sequence[str], time: str, period: int, horizon: int, block: int, names: str, keyed) -> DataFrame:
    """The same over blocks: three passes in each round of weights."""
    placed = positions(known, [time], keys, name="_i", totals=True).select(*keys, F.lit(0).alias("_pad"), (F.col("_i") - 1).alias("_i"), F.col("_i_total").alias("_n"), "_x")
    placed = written(placed.drop("_pad").withColumn("_block", F.floor(F.col("_i") / block).cast("long")), "series")
    heads = placed.filter(F.col("_i") < 2 * max(period, 1)).groupBy(*keys, "_n").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_x"))), lambda v: v["_x"]).alias("head"))
    models = written(heads.withColumns({"centre": F.lit(None).cast("array<double>"), "least": F.lit(float("inf")), "end": F.lit(None).cast("array<double>")}), "models")
    width = (HIGH - LOW) / (GRID - 1) / 2

    def setting(row, width: float) -> tuple[np.ndarray, np.ndarray]:
        start = first_state(np.asarray(row["head"], float), period)
        centre = row["centre"]
        return start, weights_around(None if centre is None or len(centre) == 0 else list(centre), width, len(start) > 3)

    for _ in range(ROUNDS):
        def zero(table: pa.Table) -> pa.Table:
            x, first = _ordered(table)
            start, weights = setting(first, width)
            _, end = run(x, np.zeros((len(weights), len(start))), weights)
            return _one(table, keys, {"_block": pa.array([first["_block"]], pa.int64()), "end": pa.array([end.ravel().tolist()], pa.list_(pa.float64())), "rows": pa.array([len(x)], pa.int64())})

        def chained(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_block")
            start, weights = setting(pdf.iloc[0], width)
            state, states = np.tile(start, (len(weights), 1)), []
            for end, rows in zip(pdf["end"], pdf["rows"]):
                states.append(state.ravel())
                state = after(weights, state, int(rows)) + np.asarray(end).reshape(state.shape)
            return keyed(key, pd.DataFrame({"_block": pdf["_block"].to_numpy(), "start": states}))

        def errors(table: pa.Table) -> pa.Table:
            x, first = _ordered(table)
            _, weights = setting(first, width)
            sse, end = run(x, np.asarray(first["start"], float).reshape(len(weights), -1), weights)
            last = first["_block"] == (first["_n"] - 1) // block
            return _one(table, keys, {"sse": pa.array([sse.tolist()], pa.list_(pa.float64())), "ends": pa.array([end.ravel().tolist() if last else None], pa.list_(pa.float64()))})

        def best(key: tuple, pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
            row = model.iloc[0]
            start, weights = setting(row, width)
            sse = np.sum(np.stack(pdf["sse"].to_numpy()), axis=0)
            ends = np.asarray(pdf["ends"].dropna().iloc[0], float).reshape(len(weights), len(start))
            i = int(np.argmin(np.where(np.isfinite(sse), sse, math.inf)))
            better = sse[i] < row["least"]
            return keyed(key, pd.DataFrame([{"_n": row["_n"], "head": row["head"], "centre": weights[i] if better else row["centre"],
                                             "least": sse[i] if better else row["least"], "end": ends[i] if better else row["end"]}]))

        carried = models.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "head", "centre")
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        rows = placed.join(carried, same).drop(*[f"_k_{k}" for k in keys])
        ends = rows.groupBy(*keys, "_block").applyInArrow(zero, f"{names}, _block long, end array<double>, rows long")
        chain = ends.join(carried, same).drop(*[f"_k_{k}" for k in keys])
        starts = written(chain.groupBy(*keys).applyInPandas(chained, f"{names}, _block long, start array<double>"), "starts")
        started = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b"), "start")
        rows = rows.join(started, [*same, F.col("_block") == F.col("_b")]).drop("_b", *[f"_k_{k}" for k in keys])
        sums = written(rows.groupBy(*keys, "_block").applyInArrow(errors, f"{names}, sse array<double>, ends array<double>"), "errors")
        schema = f"{names}, _n long, head array<double>, centre array<double>, least double, end array<double>"
        models = written(sums.groupBy(*keys).cogroup(models.groupBy(*keys)).applyInPandas(best, schema), "models")
        width /= 2

    def result(batches):
        for b in batches:
            for _, r in b.iterrows():
                yield keyed([r[k] for k in keys], _forecast_rows(ahead(np.asarray(r["end"], float), horizon), math.sqrt(r["least"] / r["_n"])))

    return models.mapInPandas(result, f"{names}, {FORECAST}")


def _ordered(table: pa.Table) -> tuple[np.ndarray, dict]:
    """The values of a block in order, and its first row's other columns."""
    order = np.argsort(table.column("_i").to_numpy())
    return table.column("_x").to_numpy()[order], {c: table.column(c)[0].as_py() for c in table.column_names}


def _one(table: pa.Table, keys: Sequence[str], columns: dict[str, pa.Array]) -> pa.Table:
    return pa.table({**{k: table.column(k).slice(0, 1) for k in keys}, **columns})
