"""Change capture against a high-water mark (CDC-1..6).

Scalars are 1-row aggregates: the watermark is fetched as a literal (so
the capture filter is pushed to the source scan), other scalars are
scalar subqueries (``DataFrame.scalar()``), evaluated once per query.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.sides import sized
from cardwatch.schemas import high, low, ts_lit


def watermark(meta: DataFrame, db: str, table: str) -> DataFrame:
    """CDC-1: ``select coalesce(last_update_dt, 1900-01-01) from meta where ...``.

    One row, column ``watermark``: NULL when no row matches, and a
    runtime error when more than one does (a scalar subquery's rules).
    """
    hit = meta.where((F.col("table_db") == db) & (F.col("table_name") == table))
    agg = hit.agg(F.count(F.lit(1)).alias("_n"),
                  F.max(F.coalesce(F.col("last_update_dt"), low())).alias("_w"))
    return agg.select(
        F.when(F.col("_n") > 1, F.raise_error(F.lit(
            f"SCALAR_SUBQUERY_TOO_MANY_ROWS: more than one watermark row for {db}.{table}")))
        .when(F.col("_n") == 1, F.col("_w")).cast("timestamp_ntz").alias("watermark"))


def watermark_literal(wm: DataFrame) -> Column:
    """The 1-row watermark as a literal, so ``update_dt > W`` reaches the scan.

    Fetching one row of an aggregate is a proven size bound; a duplicate
    meta row fails here, as the scalar subquery would.
    """
    value = wm.first()["watermark"]
    return ts_lit(value) if value is not None else F.lit(None).cast("timestamp_ntz")


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Rows of ``df`` where ``col NOT IN (select other_col from other)`` is TRUE.

    SQL's null-aware NOT IN, planned as a plain anti join instead of a
    broadcast null-aware one (which needs the whole key set in memory, or degrades to a nested loop under OR):
    an empty list passes everything; a NULL in the list passes nothing;
    a NULL probe passes only an empty list. Whether the list is empty or has a NULL is
    asked first, one row each (column statistics answer the second for most files); then the keys are
    restricted to those of ``df``, so the list is streamed once and never aggregated.
    """
    from cardwatch.operators.scd2 import restrict
    keys = other.select(F.col(other_col).alias("_k"))
    if keys.isEmpty():
        return df
    if not keys.where(F.col("_k").isNull()).isEmpty():
        return df.where(F.lit(False))
    df = sized(df)
    held = restrict(keys, df.select(F.col(col).alias("_k")), ["_k"])
    return df.where(F.col(col).isNotNull()).join(held, F.col(col) == F.col("_k"), "left_anti")


def capture_incremental(src: DataFrame, wm: DataFrame, hist: DataFrame, key: str,
                        columns: dict[str, str], run_ts: Column,
                        src_key: str | None = None) -> DataFrame:
    """CDC-2..4: rows updated after the watermark, OR seed rows (created on
    1900-01-01) whose key is NOT IN the history; projected to the staging
    columns (``columns`` = staging name -> source name), ``update_dt`` = run time.

    The OR is split into two disjoint branches (updated / not updated) so
    that the NOT IN stays a plain anti join.
    """
    src_key = src_key or key
    updated = F.col("update_dt") > watermark_literal(wm)
    inc = src.where(updated)
    seed = src.where(~F.coalesce(updated, F.lit(False)) & (F.col("create_dt") == low()))
    seed = not_in(seed, src_key, hist, key)
    out = [F.col(s).alias(t) for t, s in columns.items() if t != "update_dt"]
    return inc.unionByName(seed).select(*out, run_ts.alias("update_dt"))


def key_snapshot(src: DataFrame, src_key: str, key: str) -> DataFrame:
    """CDC-5: every key present in the source right now."""
    return src.select(F.col(src_key).alias(key))


def day_max(stg_transactions: DataFrame, name: str = "day_max") -> DataFrame:
    """Latest operation time of the day's file (1 row, NULL for an empty day)."""
    return stg_transactions.agg(F.max("trans_date").alias(name))


def advance_watermark(meta: DataFrame, stg_transactions: DataFrame, db: str, table: str) -> DataFrame:
    """CDC-6: set ``last_update_dt`` to the day's latest operation when there is one.

    Only existing rows are updated; no row is ever inserted.
    """
    mx = day_max(stg_transactions, "_mx").scalar()
    hit = (F.col("table_db") == db) & (F.col("table_name") == table) & mx.isNotNull()
    return meta.select("table_db", "table_name",
                       F.when(hit, mx).otherwise(F.col("last_update_dt")).alias("last_update_dt"))


# ---- a cursor per source table (keyed profile) -----------------------------------

def cursor(meta: DataFrame, db: str, table: str):
    """The largest ``update_dt`` that was captured from the table; None if no row says so."""
    return watermark(meta.where(F.col("last_update_dt").isNotNull()), db, table).first()["watermark"]


def capture_since(src: DataFrame, at, overlap: str, hist: DataFrame, key: str, attrs, columns: dict[str, str],
                  run_ts: Column, src_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(staged rows, 1 row ``cursor``) of a source table whose cursor stands ``at`` (None: never captured).

    Without a cursor every row is staged. With one: the rows changed since ``overlap`` before
    it (transactions that committed late carry an earlier time), without those up to the
    cursor that the history holds as they are, open and unflagged; and rows without a change
    time whose key the history does not have. The new cursor is the largest change time seen, never
    the time of another table's rows.
    """
    src_key = src_key or key
    moved = F.max("update_dt").alias("cursor")
    out = [F.col(s).alias(t) for t, s in columns.items() if t != "update_dt"]
    if at is None:
        return src.select(*out, run_ts.alias("update_dt")), src.agg(moved)
    since = ts_lit(at)
    recent = src.where(F.col("update_dt") > since - F.expr(f"INTERVAL {overlap}"))
    old = recent.where(F.col("update_dt") <= since).select(*out)
    held = hist.where((F.col("effective_to") == high()) & (F.col("deleted_flg") == 0)).select(
        F.col(key).alias("_k"), *[F.col(a).alias(f"_h_{a}") for a in attrs])
    same = reduce(and_, [F.col(a).eqNullSafe(F.col(f"_h_{a}")) for a in attrs], F.col(key) == F.col("_k"))
    new = recent.where(F.col("update_dt") > since).select(*out)
    untimed = src.where(F.col("update_dt").isNull()).join(
        hist.select(F.col(key).alias("_k")), F.col(src_key) == F.col("_k"), "left_anti").select(*out)
    staged = new.unionByName(old.join(held, same, "left_anti")).unionByName(untimed)
    return staged.withColumn("update_dt", run_ts), recent.agg(F.greatest(F.max("update_dt"), since).alias("cursor"))


def advance_cursors(meta: DataFrame, moved: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``meta`` with the cursor of each (db, table): its row is created by the first capture."""
    rest = meta
    for db, table in moved:
        rest = rest.where(~((F.col("table_db") == db) & (F.col("table_name") == table)))
    for (db, table), at in moved.items():
        rest = rest.unionByName(at.select(F.lit(db).alias("table_db"), F.lit(table).alias("table_name"), F.col("cursor").alias("last_update_dt")))
    return rest
