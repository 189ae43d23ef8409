"""Registered queries: Spark implementation + DuckDB oracle SQL per operator.

Every query reads the driver tables of one scale-factor directory (through
the fixture views of :mod:`cardwatch.fixtures`) and returns a DataFrame
whose column names equal those of its oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.fixtures import Fixtures, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn
    return deco


def _load_all():
    # Import the modules that register queries.
    from cardwatch.plans import q_fraud, q_scd, q_cdc, q_cursor, q_sources, q_run  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
