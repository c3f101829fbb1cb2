"""Tail probabilities as SQL, for the checks of the tests' p-values: series of positive
terms, long enough for the arguments that the given tables lead to."""

from __future__ import annotations


def chi2_tail(x: str, df: str) -> str:
    """Upper tail of a chi-square value."""
    a, h = f"(({df}) / 2.0)", f"(({x}) / 2.0)"
    below = f"list_sum(list_transform(range(0, 2000), lambda n: exp(({a} + n) * ln({h}) - {h} - lgamma({a} + n + 1))))"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1.0 WHEN {h} > 700 + {df} THEN 0.0 ELSE greatest(1.0 - {below}, 0.0) END"


def normal_tails(z: str) -> str:
    """Both tails of a standard normal value."""
    return chi2_tail(f"({z}) * ({z})", "1")


def _beta_series(a: str, b: str, x: str, y: str) -> str:
    return f"list_sum(list_transform(range(0, 4000), lambda n: exp(lgamma({a} + {b} + n) - lgamma({b}) - lgamma({a} + 1 + n) + ({a} + n) * ln({x}) + {b} * ln({y}))))"


def beta_lower(a: str, b: str, x: str, y: str) -> str:
    """Regularised incomplete beta at x = 1 - y, from the end where its series is short."""
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 0.0 WHEN {y} <= 0 THEN 1.0 WHEN {x} < 0.99
      THEN {_beta_series(a, b, x, y)} ELSE 1.0 - {_beta_series(b, a, y, x)} END"""


def t_tails(t: str, df: str) -> str:
    """Both tails of Student's t."""
    square = f"(({t}) * ({t}))"
    return beta_lower(f"({df} / 2.0)", "0.5", f"({df} / ({df} + {square}))", f"({square} / ({df} + {square}))")


def f_tail(f: str, d1: str, d2: str) -> str:
    """Upper tail of an F value."""
    return beta_lower(f"({d2} / 2.0)", f"({d1} / 2.0)", f"({d2} / ({d2} + {d1} * {f}))", f"({d1} * {f} / ({d2} + {d1} * {f}))")


def kolmogorov_tail(x: str) -> str:
    terms = f"list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * ({x}) * ({x}))))"
    return f"CASE WHEN {x} < 0.2 THEN 1.0 ELSE least(greatest({terms}, 0.0), 1.0) END"


def with_p(sql: str, tail: str) -> str:
    return f"SELECT *, {tail} AS p_value FROM ({sql})"
