"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from tabulyte.plans.registry import PLANS, SQL

MODULES = ("sources", "cleaning", "aggregates", "scalars", "joins_sets", "windows", "inference", "evaluation", "texts", "time_series", "anomalies", "learning")

for _name in MODULES:
    import_module(f"{__name__}.{_name}")


def queries():
    return dict(PLANS)


def oracle_sql():
    return dict(SQL)
