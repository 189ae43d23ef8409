"""cardwatch: a Spark-native daily card-operations warehouse.

Dimensions are kept as type-2 history, facts are insert-only, and a
rule-based fraud report is built from the whole history. Every operator
is a pure ``DataFrame -> DataFrame`` transformation; state is published
as Parquet snapshots (see :mod:`cardwatch.plans.state`).
"""

__all__ = ["schemas"]
