"""Which side of a join may be broadcast: decided by counted rows, not by the size of files.

Spark broadcasts a side whose files (or measured shuffle) lie below a size in compressed bytes;
millions of alike rows can, and each broadcast passes whole through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows up to which a table-sized side of a join is left to Spark; beyond, the join is a shuffle join.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """``df`` as a side of joins, marked for a shuffle join if ``like`` (default ``df``) has more than :data:`BROADCAST_ROWS` rows.

    One small job, which stops at that many rows. The mark counts on either side of a join and
    holds through projections, filters and aggregates, up to the next join or union.
    """
    rows = (df if like is None else like).select().limit(BROADCAST_ROWS + 1).count()
    return df.hint("merge") if rows > BROADCAST_ROWS else df
