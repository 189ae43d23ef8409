"""Change capture: watermark cases, null-aware NOT IN, plans without nested loops."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators import cdc

RUN_TEXT = "2024-01-31 03:36:00"


def _meta(spark, rows):
    return spark.createDataFrame(rows, S.META)


def test_watermark_cases(spark):
    d = dt.datetime(2024, 1, 10)
    assert cdc.watermark(_meta(spark, [("wh", "transactions", d)]), "wh", "transactions").first()[0] == d
    assert (cdc.watermark(_meta(spark, [("wh", "transactions", None)]), "wh", "transactions").first()[0]
            == dt.datetime(1900, 1, 1))
    assert cdc.watermark(_meta(spark, []), "wh", "transactions").first()[0] is None
    two = _meta(spark, [("wh", "transactions", d), ("wh", "transactions", d)])
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        cdc.watermark(two, "wh", "transactions").first()


@pytest.mark.parametrize("listed,expected", [
    ([], ["a", "b", None]),            # empty list: everything passes, NULL too
    (["a"], ["b"]),                    # NULL probe fails against a non-empty list
    (["a", None], []),                 # a NULL in the list: nothing passes
])
def test_not_in_is_null_aware(spark, listed, expected):
    probe = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([(v,) for v in listed], "k2 string")
    got = [r.k for r in cdc.not_in(probe, "k", other, "k2").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_capture_plans_no_nested_loop(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("client_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.STG_CLIENTS.fields[1:8]],
        S.low().alias("create_dt"), S.ts_lit("2024-01-05 00:00:00").alias("update_dt"))
    hist = src.limit(10).select("client_id")
    wm = cdc.watermark(_meta(spark, [("wh", "transactions", dt.datetime(2024, 1, 1))]), "wh", "transactions")
    out = cdc.capture_incremental(src, wm, hist, "client_id",
                                  {c: c for c in S.STG_CLIENTS.fieldNames()}, S.ts_lit(RUN_TEXT))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert out.count() == 150   # every row was updated after the watermark


def test_advance_watermark_updates_only(spark):
    meta = _meta(spark, [("wh", "transactions", None), ("wh", "other", None)])
    tx = spark.createDataFrame([("1", dt.datetime(2024, 1, 30), None, None, None, None, None)],
                               S.STG_TRANSACTIONS)
    out = {r.table_name: r.last_update_dt for r in cdc.advance_watermark(meta, tx, "wh", "transactions").collect()}
    assert out == {"transactions": dt.datetime(2024, 1, 30), "other": None}
    empty = tx.where("false")
    assert cdc.advance_watermark(meta, empty, "wh", "transactions").where(
        "last_update_dt is not null").count() == 0
    assert cdc.advance_watermark(_meta(spark, []), tx, "wh", "transactions").count() == 0


# ---- a cursor per source table -----------------------------------------------------

HI, OLD = dt.datetime(9999, 12, 31), dt.datetime(2020, 1, 1)
CARD_COLUMNS = {"card_num": "card_num", "account_num": "account", "create_dt": "create_dt", "update_dt": "update_dt"}


def _cards(spark, *rows):
    return spark.createDataFrame([(k, a, OLD, u) for k, a, u in rows], S.SRC_CARDS)


def _capture(spark, src, at, hist):
    got, cursor = cdc.capture_since(src, at, "2 hours", spark.createDataFrame(hist, S.HIST_CARDS), "card_num", S.CARD_ATTRS, CARD_COLUMNS, S.ts_lit(RUN_TEXT))
    return sorted((r.card_num, r.account_num) for r in got.collect()), cursor.first()[0]


def test_capture_since_a_cursor(spark):
    at = lambda h: dt.datetime(2024, 1, 10, h)
    src = _cards(spark, ("new", "A1", at(12)), ("late", "A2", at(9)), ("same", "A3", at(9)), ("moved", "A4", at(9)), ("gone", "A5", at(9)),
                 ("old", "A6", at(7)), ("known", "A7", None), ("unknown", "A8", None))
    hist = [("same", "A3", 0, OLD, HI), ("moved", "A0", 0, OLD, HI), ("gone", "A5", 1, OLD, HI), ("known", "A0", 0, OLD, HI)]
    # nothing captured yet: every row; the cursor starts at the latest change
    rows, cursor = _capture(spark, src, None, hist)
    assert len(rows) == 8 and cursor == at(12)
    # from 10 o'clock with two hours of overlap: what the history holds as it is stays out, what is older too
    rows, cursor = _capture(spark, src, at(10), hist)
    assert rows == [("gone", "A5"), ("late", "A2"), ("moved", "A4"), ("new", "A1"), ("unknown", "A8")] and cursor == at(12)
    rows, cursor = _capture(spark, _cards(spark, ("old", "A6", at(7))), at(10), hist)
    assert rows == [] and cursor == at(10)
    assert _capture(spark, _cards(spark), None, [])[1] is None


def test_cursor_rows_are_created_and_moved(spark):
    day = lambda d: spark.createDataFrame([(d,)], "cursor timestamp_ntz")
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)
    meta = _meta(spark, [("wh", "transactions", None)])
    assert cdc.cursor(meta, "bank", "cards") is None
    meta = cdc.advance_cursors(meta, {("bank", "cards"): day(first), ("bank", "clients"): day(None)})
    assert cdc.cursor(meta, "bank", "cards") == first and cdc.cursor(meta, "bank", "clients") is None
    meta = cdc.advance_cursors(meta, {("bank", "cards"): day(second)})
    assert sorted(tuple(r) for r in meta.where("table_name = 'cards'").collect()) == [("bank", "cards", second)]
    assert meta.count() == 3 and cdc.advance_cursors(meta, {}).count() == 3


def test_a_keyed_run_with_cursors_starts_on_an_empty_warehouse(spark, scratch):
    """The reference's watermark never starts without a row; a cursor is created by the first capture."""
    from cardwatch.plans import state
    from cardwatch.plans.daily import DayInputs, run_day
    root = f"{scratch}/wh"
    empty = {n: S.empty(spark, s) for n, s in (("terminals", S.STG_TERMINALS), ("blacklist", S.FACT_BLACKLIST), ("transactions", S.STG_TRANSACTIONS))}

    def run(day, *cards):
        run_day(spark, root, str(day), DayInputs(S.empty(spark, S.SRC_CLIENTS), S.empty(spark, S.SRC_ACCOUNTS), _cards(spark, *cards), **empty),
                f"2024-01-{day + 1:02d} 03:36:00", profile="keyed", capture="cursor", report_scope="day", work_dir=f"{scratch}/work")
        return sorted((r.card_num, r.account_num, r.deleted_flg, r.effective_to == HI) for r in state.read_table(spark, root, "hist_cards").collect())

    at = lambda d: dt.datetime(2024, 1, d, 12)
    assert run(1, ("k1", "A1", at(1)), ("k2", "A2", None)) == [("k1", "A1", 0, True), ("k2", "A2", 0, True)]
    assert cdc.cursor(state.read_table(spark, root, "meta"), "bank", "cards") == at(1)
    assert run(2, ("k1", "A9", at(2)), ("k2", "A2", None)) == [("k1", "A1", 0, False), ("k1", "A9", 0, True), ("k2", "A2", 0, True)]
    with pytest.raises(ValueError, match="keyed"):
        run_day(spark, root, "3", None, RUN_TEXT, profile="reference", capture="cursor")
    with pytest.raises(ValueError, match="keyed"):
        run_day(spark, root, "3", None, RUN_TEXT, profile="reference", report_scope="day")
