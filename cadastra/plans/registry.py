"""All queries of the address and territory engine."""

from __future__ import annotations

from cadastra.plans.derive import Tables
from cadastra.plans.queries import REGISTERED


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, (f, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}
