"""Insert-only facts (FCT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators import sides


def new_facts(fact: DataFrame, stg: DataFrame, key: str, keep=()) -> DataFrame:
    """Staged rows whose business key is not in the fact table yet.

    Changes to existing keys are ignored; duplicates inside the day's
    file are all kept (the match looks at the state before the load);
    a NULL key never matches, so it is always inserted. ``keep``: staged
    columns to pass on besides those of the fact table.
    """
    # only fact keys that occur in the day's rows matter: the (large) fact
    # table is semi-joined against the day's keys, not aggregated whole. The
    # day's smallest and largest key go into the scan, which skips every part (written in
    # ranges of the key, see state.KEY_RANGES) that lies outside.
    from cardwatch.operators.scd2 import restrict
    low, high, n_rows = stg.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if n_rows > sides.BROADCAST_ROWS:
        stg = stg.hint("merge")
    known = restrict(fact.where(F.col(key).between(low, high)).select(key), stg, [key])
    return stg.join(known, key, "left_anti").select(*fact.columns, *keep)


def insert_fact(fact: DataFrame, stg: DataFrame, key: str) -> DataFrame:
    return fact.unionByName(new_facts(fact, stg, key))
