"""Survival curves and hazards.

All row-level work is grouped sums per distinct duration; running sums and products over
the durations use blocked orders, so there may be as many durations as rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabulyte.functions.dist import chi2_p, digamma, trigamma
from tabulyte.operators.ordering import running
from tabulyte.session import written


def _life_table(df: DataFrame, time: str, event: str, keys: Sequence[str] = ()) -> DataFrame:
    table = df.groupBy(*keys, time).agg(
        F.sum(F.col(event).cast("bigint")).alias("events"), F.count(F.lit(1)).alias("rows")
    )
    return running(table, [time], {"at_risk": ("sum", "rows")}, keys, reverse=True)


def kaplan_meier(df: DataFrame, time: str, event: str, keys: Sequence[str] = ()) -> DataFrame:
    """Survival after each distinct duration, per group."""
    table = _life_table(df, time, event, keys)
    stay = 1 - F.col("events") / F.col("at_risk")
    return running(table, [time], {"survival": ("product", stay)}, keys).select(*keys, time, "at_risk", "events", "survival")


def logrank(df: DataFrame, time: str, event: str, group: str) -> DataFrame:
    """Log-rank test of group 1 against group 0."""
    table = df.groupBy(time).agg(
        F.sum(F.col(event).cast("bigint")).alias("d"), F.count(F.lit(1)).alias("n"),
        F.sum((F.col(event) * F.col(group)).cast("bigint")).alias("d1"),
        F.sum(F.col(group).cast("bigint")).alias("n1"),
    )
    risk = running(table, [time], {"r": ("sum", "n"), "r1": ("sum", "n1")}, reverse=True)
    share = F.col("r1") / F.col("r")
    variance = F.when(
        F.col("r") > 1, F.col("d") * share * (1 - share) * (F.col("r") - F.col("d")) / (F.col("r") - 1)
    ).otherwise(0.0)
    s = risk.filter("d > 0").agg(
        F.sum("d1").alias("observed"), F.sum(F.col("d") * share).alias("expected"), F.sum(variance).alias("variance")
    )
    s = s.withColumn("chi2", F.try_divide(F.pow(F.col("observed") - F.col("expected"), 2), F.col("variance")))
    return s.withColumn("p_value", chi2_p("chi2", F.lit(1.0)))


def efron_terms(d, s0, s1, s2, e0, e1, e2):
    """Gradient and information of tied event times, without the sums over ties: arrays
    with a row per time (d, s0, e0: n; s1, e1: n x p; s2, e2: n x p x p).

    The l-th of d tied events sees the risk set less l/d of the event rows.  The
    sums of 1/(a-l) and 1/(a-l)² over l are differences of digamma and trigamma.
    """
    q, a = d / e0, s0 * d / e0
    low, high = np.maximum(a - d + 1, 1e-12), a + 1
    t1, t2 = digamma(high) - digamma(low), trigamma(low) - trigamma(high)
    one, part = q * t1, q / d * (a * t1 - d)
    one2, part2 = q * q * t2, q * q / d * (a * t2 - t1)
    both2 = q * q / (d * d) * (a * a * t2 - 2 * a * t1 + d)
    mean = s1 * one[:, None] - e1 * part[:, None]
    outer = lambda x, y: x[:, :, None] * y[:, None, :]
    each = lambda v: v[:, None, None]
    info = (
        s2 * each(one) - e2 * each(part)
        - (outer(s1, s1) * each(one2) - (outer(s1, e1) + outer(e1, s1)) * each(part2) + outer(e1, e1) * each(both2))
    )
    return mean, info


def cox(
    df: DataFrame, time: str, event: str, features: Sequence[str], penalty: float = 0.1,
    steps: int = 25, tolerance: float = 1e-8,
) -> DataFrame:
    """Proportional hazards with Efron ties and a ridge penalty on standardised
    features: `(feature, coef, hazard_ratio, converged)` on the original scale.

    Each Newton step is one grouped pass over the rows and a blocked running sum over the
    distinct durations; the driver sees one gradient and one p-by-p matrix.  `converged`
    says whether the last step moved less than `tolerance`.
    """
    p = len(features)
    stats = df.agg(*[g(c).alias(f"{n}{i}") for i, c in enumerate(features)
                     for n, g in (("m", F.avg), ("s", F.stddev_samp))], F.count(F.lit(1)).alias("n")).first()
    mean = np.array([stats[f"m{i}"] for i in range(p)], dtype=float)
    std = np.array([stats[f"s{i}"] or 1.0 for i in range(p)], dtype=float)
    z = [(F.col(c) - F.lit(float(mean[i]))) / F.lit(float(std[i])) for i, c in enumerate(features)]
    rows = df.select(F.col(time).alias("t"), F.col(event).cast("double").alias("e"),
                     *[c.alias(f"z{i}") for i, c in enumerate(z)])
    rows = written(rows, "cox")  # each step reads it again
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    risk_names = ["s0", *[f"s1_{i}" for i in range(p)], *[f"s2_{i}_{j}" for i, j in upper]]

    def contributions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            of = lambda name: b[name].to_numpy(float)
            vector = lambda head: np.column_stack([of(f"{head}_{i}") for i in range(p)])
            square = lambda head: np.stack([np.column_stack([of(f"{head}_{min(i, j)}_{max(i, j)}") for j in range(p)]) for i in range(p)], axis=1)
            mean_, info = efron_terms(of("d"), of("s0"), vector("s1"), square("s2"), of("e0"), vector("e1"), square("e2"))
            grad = vector("x") - mean_
            yield pd.DataFrame({**{f"g_{i}": [grad[:, i].sum()] for i in range(p)}, **{f"h_{i}_{j}": [info[:, i, j].sum()] for i, j in upper}})

    beta = np.zeros(p)
    converged = False
    for _ in range(steps):
        weight = F.exp(sum((F.lit(float(beta[i])) * F.col(f"z{i}") for i in range(p)), F.lit(0.0)))
        w = rows.withColumn("w", weight)
        parts = {"0": F.col("w")}
        parts.update({f"1_{i}": F.col("w") * F.col(f"z{i}") for i in range(p)})
        parts.update({f"2_{i}_{j}": F.col("w") * F.col(f"z{i}") * F.col(f"z{j}") for i, j in upper})
        per_time = w.groupBy("t").agg(
            F.sum("e").alias("d"),
            *[F.sum(c).alias(f"r{n}") for n, c in parts.items()],
            *[F.sum(c * F.col("e")).alias(f"e{n}") for n, c in parts.items()],
            *[F.sum(F.col("e") * F.col(f"z{i}")).alias(f"x_{i}") for i in range(p)],
        )
        risk = running(per_time, ["t"], {n: ("sum", f"r{n[1:]}") for n in risk_names}, reverse=True)
        schema = ", ".join(f"{n} double" for n in [*[f"g_{i}" for i in range(p)], *[f"h_{i}_{j}" for i, j in upper]])
        total = risk.filter("d > 0").mapInPandas(contributions, schema).groupBy().sum().first()
        n = float(stats["n"])
        grad = np.array([total[f"sum(g_{i})"] for i in range(p)]) / n - penalty * beta
        info = np.zeros((p, p))
        for i, j in upper:
            info[i, j] = info[j, i] = total[f"sum(h_{i}_{j})"] / n
        move = np.linalg.solve(info + penalty * np.eye(p), grad)
        beta = beta + move
        converged = bool(np.abs(move).max() < tolerance)
        if converged:
            break
    coef = beta / std
    return df.sparkSession.createDataFrame(
        [(c, float(coef[i]), float(np.exp(coef[i])), converged) for i, c in enumerate(features)],
        "feature string, coef double, hazard_ratio double, converged boolean",
    )
