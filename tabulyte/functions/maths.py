"""Numeric expressions and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def neglog10(p: str | Column, floor: float = 1e-300) -> Column:
    c = F.col(p) if isinstance(p, str) else p
    return -F.log10(F.greatest(c, F.lit(floor)))


def clip(c: str | Column, lo: float, hi: float) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.least(F.greatest(col, F.lit(lo)), F.lit(hi))


def grid(spark: SparkSession, lo: float, hi: float, points: int, name: str = "x") -> DataFrame:
    """Evenly spaced points, both ends included; the number of points is fixed."""
    step = (hi - lo) / (points - 1)
    return spark.range(points).select(
        F.col("id").alias("i"), (F.lit(float(lo)) + F.col("id") * F.lit(float(step))).alias(name)
    )


def hundredth_below(c: str | Column) -> Column:
    """The largest integer k with k / 100 <= value, exact on the grid itself."""
    col = F.col(c) if isinstance(c, str) else c
    k = F.floor(col * 100)
    return F.when(col >= (k + 1) / 100.0, k + 1).when(col < k / 100.0, k - 1).otherwise(k)


# Coefficients of algorithm AS 241 for the normal quantile.
CENTRE_NUM = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
              4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
CENTRE_DEN = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
              3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
NEAR_NUM = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
            1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
NEAR_DEN = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1,
            1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
FAR_NUM = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
           2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
FAR_DEN = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4,
           1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def _polynomial(x: Column, coefficients) -> Column:
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * x + F.lit(c)
    return total


def normal_quantile(p: str | Column) -> Column:
    """Inverse of the standard normal distribution as a column expression."""
    c = F.col(p) if isinstance(p, str) else p
    q = c - 0.5
    r = F.lit(0.180625) - q * q
    centre = q * _polynomial(r, CENTRE_NUM) / _polynomial(r, CENTRE_DEN)
    t = F.sqrt(-F.ln(F.least(c, 1 - c)))
    near = _polynomial(t - 1.6, NEAR_NUM) / _polynomial(t - 1.6, NEAR_DEN)
    far = _polynomial(t - 5.0, FAR_NUM) / _polynomial(t - 5.0, FAR_DEN)
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * F.when(t <= 5, near).otherwise(far))
