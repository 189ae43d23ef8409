"""Three consecutive daily runs on a tiny warehouse (reference profile).

Expected rows reasoned from the daily statements: the watermark follows
the day's last operation, and a terminal missing from the file is
flagged, closed and restored again on every run (one more row a day).
"""

import datetime as dt

from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.plans import state
from cardwatch.plans.daily import DayInputs, run_day

OLD = dt.datetime(1900, 1, 1)


def _inputs(spark, day, terminals):
    ts = lambda h: dt.datetime(2021, 3, day, h)
    clients = spark.createDataFrame(
        [("c1", "Ivanov", "Ivan", "P", OLD, "PP1", dt.datetime(2030, 1, 1), "ph1", OLD, ts(1))],
        S.SRC_CLIENTS)
    accounts = spark.createDataFrame([("A1", dt.datetime(2030, 1, 1), "c1", OLD, ts(1))], S.SRC_ACCOUNTS)
    cards = spark.createDataFrame([("K1", "A1", OLD, ts(1))], S.SRC_CARDS)
    tm = spark.createDataFrame(terminals, S.STG_TERMINALS)
    tx = spark.createDataFrame([(f"{day}-1", ts(10), None, "K1", "PAY", "SUCCESS", "T1"),
                                (f"{day}-2", ts(12), None, "K1", "PAY", "SUCCESS", "T1")],
                               S.STG_TRANSACTIONS)
    bl = spark.createDataFrame([], S.FACT_BLACKLIST)
    return DayInputs(clients, accounts, cards, tm, bl, tx)


def test_three_days(spark, scratch):
    root = f"{scratch}/wh"
    state.publish(spark, root, "0", replace={
        "meta": spark.createDataFrame([("wh", "transactions", None)], S.META)})
    t1 = ("T1", "ATM", "Moscow", "a1")
    t2 = ("T2", "POS", "Kazan", "a2")
    days = {1: [t1, t2], 2: [t1], 3: [t1]}
    t2_rows = {}
    for day, terms in days.items():
        run_day(spark, root, str(day), _inputs(spark, day, terms), f"2021-03-{day + 1:02d} 03:36:00",
                work_dir=f"{scratch}/work{day}")
        meta = state.read_table(spark, root, "meta").first()
        assert meta.last_update_dt == dt.datetime(2021, 3, day, 12)
        tm = state.read_table(spark, root, "hist_terminals")
        t2_rows[day] = sorted((r.deleted_flg, r.effective_from, r.effective_to)
                              for r in tm.where(F.col("terminal_id") == "T2").collect())
    d2, d3 = dt.datetime(2021, 3, 2, 12), dt.datetime(2021, 3, 3, 12)
    hi = dt.datetime(9999, 12, 31)
    assert t2_rows[1] == [(0, OLD, hi)]
    assert t2_rows[2] == sorted([(1, OLD, d2 - dt.timedelta(days=1)), (0, d2, hi)])
    assert t2_rows[3] == sorted([(1, OLD, d3 - dt.timedelta(days=1)), (1, d2, d3 - dt.timedelta(days=1)),
                                 (0, d3, hi)])
    # facts are appended once per run, never rewritten
    assert state.read_table(spark, root, "fact_transactions").count() == 6
    assert len(state.current(spark, root)["tables"]["fact_transactions"]) == 3
