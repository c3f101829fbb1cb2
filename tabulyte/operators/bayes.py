"""Beta posteriors of rates under a uniform prior."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.functions import dist
from tabulyte.functions.maths import grid

DRAWS = 100_000


def beta_posterior(df: DataFrame, event: Column, keys: Sequence[str] = ()) -> DataFrame:
    """`Beta(1+k, 1+n-k)` per group: mean and equal-tailed 95% interval."""
    s = df.groupBy(*keys).agg(F.count_if(event).alias("k"), F.count(event).alias("n"))
    return posterior_of_counts(s, keys)


def posterior_of_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    a, b = F.col("k") + 1, F.col("n") - F.col("k") + 1
    s = counts.select(*keys, "k", "n", a.alias("alpha"), b.alias("beta"), (a / (a + b)).alias("mean"))
    return s.withColumn("lower", dist.beta_ppf(F.lit(0.025), "alpha", "beta")).withColumn(
        "upper", dist.beta_ppf(F.lit(0.975), "alpha", "beta")
    )


def rate_draws(df: DataFrame, group: Column, event: Column, draws: int = DRAWS, seed: int = 42) -> DataFrame:
    """Posterior draws of the rate inside and outside a group.

    The four counts come from one pass; the draws are made in parallel, each
    slice seeded by its first number so that a repeated task repeats them.
    """
    counts = df.agg(F.struct(
        F.count_if(group & event).alias("k1"), F.count_if(group).alias("n1"),
        F.count_if(~group & event).alias("k0"), F.count_if(~group).alias("n0"),
    )).scalar()
    spec = df.sparkSession.range(0, draws, 1, 8).withColumn("_c", counts).select("id", "_c.*")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            rng = np.random.default_rng([seed, int(b["id"].iloc[0])])
            side = lambda k, n: rng.beta(1.0 + b[k].to_numpy(), 1.0 + b[n].to_numpy() - b[k].to_numpy())
            yield pd.DataFrame({"rate_in": side("k1", "n1"), "rate_out": side("k0", "n0")})

    return spec.mapInPandas(draw, "rate_in double, rate_out double")


def prob_greater(draws: DataFrame) -> DataFrame:
    return draws.agg(F.avg((F.col("rate_in") > F.col("rate_out")).cast("double")).alias("probability"))


def relative_risk(draws: DataFrame) -> DataFrame:
    """Mean and 95% interval of the ratio of rates over a fixed number of draws."""
    ratio = F.col("rate_in") / F.col("rate_out")
    return draws.agg(
        F.avg(ratio).alias("mean"), F.percentile(ratio, F.lit(0.025)).alias("lower"),
        F.percentile(ratio, F.lit(0.975)).alias("upper"),
    )


def thresholds(df: DataFrame, value: str, event: Column, cuts: Sequence[float]) -> DataFrame:
    """Rows and events below and above each cut, and the posterior mean rates.

    One pass counts the rows between neighbouring cuts, apart from those equal
    to a cut; the rest is sums over the few steps.
    """
    cuts = sorted(float(c) for c in cuts)
    below = sum(((F.col(value) >= c).cast("int") for c in cuts), F.lit(0))
    on_cut = F.col(value).isin(cuts)
    steps = df.filter(F.col(value).isNotNull()).groupBy(below.alias("step"), on_cut.alias("on_cut")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(event).alias("k")
    )
    lit_cuts = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(c).alias("cut")) for i, c in enumerate(cuts)])
    long = steps.withColumn("c", F.explode(lit_cuts))
    under = F.col("step") < F.col("c.i")
    over = (F.col("step") > F.col("c.i")) | ((F.col("step") == F.col("c.i")) & ~F.col("on_cut"))
    count = lambda side, what: F.coalesce(F.sum(F.when(side, F.col(what))), F.lit(0))
    s = long.groupBy(F.col("c.cut").alias("cut")).agg(
        count(under, "n").alias("n_below"), count(under, "k").alias("k_below"),
        count(over, "n").alias("n_above"), count(over, "k").alias("k_above"), F.sum("n").alias("_n"),
    )
    return s.withColumns({
        "rate_below": (F.col("k_below") + 1) / (F.col("n_below") + 2),
        "rate_above": (F.col("k_above") + 1) / (F.col("n_above") + 2),
        "p_above": (F.col("n_above") + 1) / (F.col("_n") + 2),
    }).drop("_n")


def density_grid(posterior: DataFrame, key: str, points: int = 201) -> DataFrame:
    """Posterior density of each group on an even grid inside (0, 1)."""
    xs = grid(posterior.sparkSession, 0.0, 1.0, points, "x").filter("x > 0 AND x < 1")
    array = xs.agg(F.sort_array(F.collect_list("x"))).scalar()
    rows = posterior.select(key, "alpha", "beta", dist.log_beta("alpha", "beta").alias("_lb"))
    long = rows.withColumn("_xs", array).select("*", F.explode("_xs").alias("x"))
    log_density = (F.col("alpha") - 1) * F.ln("x") + (F.col("beta") - 1) * F.log1p(-F.col("x")) - F.col("_lb")
    return long.select(key, "x", F.exp(log_density).alias("density"))
