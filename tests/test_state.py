"""Published state: pointer switch, appended parts, reset, and a first daily run."""

import datetime as dt

import pytest

from cardwatch import schemas as S
from cardwatch.plans import state
from cardwatch.plans.daily import DayInputs, run_day

OLD = dt.datetime(1900, 1, 1)


def test_publish_switches_pointer_last(spark, scratch):
    root = f"{scratch}/wh"
    meta = spark.createDataFrame([("wh", "transactions", None)], S.META)
    state.publish(spark, root, "1", replace={"meta": meta})
    assert state.read_table(spark, root, "meta").count() == 1

    run = state.Run(spark, root, "2")
    run.replace("meta", meta.unionByName(meta))
    # not committed: readers still see run 1
    assert state.read_table(spark, root, "meta").count() == 1
    with pytest.raises(RuntimeError):
        try:
            run.append("fact_blacklist", spark.createDataFrame([(None, "P1")], S.FACT_BLACKLIST))
            raise RuntimeError("the run fails before its commit")
        finally:
            assert state.current(spark, root)["run_id"] == "1"
    assert state.read_table(spark, root, "fact_blacklist").count() == 0


def test_append_parts_and_reset_keeps_watermark(spark, scratch):
    root = f"{scratch}/wh"
    bl = spark.createDataFrame([(OLD, "P1")], S.FACT_BLACKLIST)
    meta = spark.createDataFrame([("wh", "transactions", dt.datetime(2024, 1, 1))], S.META)
    state.publish(spark, root, "1", replace={"meta": meta}, append={"fact_blacklist": bl})
    state.publish(spark, root, "2", append={"fact_blacklist": bl})
    assert state.read_table(spark, root, "fact_blacklist").count() == 2
    assert len(state.current(spark, root)["tables"]["fact_blacklist"]) == 2
    state.reset(spark, root, "3")
    assert state.read_table(spark, root, "fact_blacklist").count() == 0
    assert state.read_table(spark, root, "meta").count() == 1      # kept, as in the reference


def test_rerun_replaces_and_older_runs_are_refused(spark, scratch):
    root = f"{scratch}/wh"
    row = lambda p: spark.createDataFrame([(OLD, p)], S.FACT_BLACKLIST)
    passports = lambda: sorted(r.passport_num for r in state.read_table(spark, root, "fact_blacklist").collect())
    state.publish(spark, root, "d1", append={"fact_blacklist": row("P1")})
    state.publish(spark, root, "d2", append={"fact_blacklist": row("P2")})
    failed = state.Run(spark, root, "d2")           # a rerun that stops before its commit
    failed.append("fact_blacklist", row("P9"))
    assert passports() == ["P1", "P2"]
    state.publish(spark, root, "d2", append={"fact_blacklist": row("P3")})
    assert passports() == ["P1", "P3"]
    with pytest.raises(ValueError, match="d1"):
        state.Run(spark, root, "d1")
    assert len(state.remove_superseded(spark, root)) == 2      # the failed and the replaced attempt
    assert passports() == ["P1", "P3"]
    state.reset(spark, root, "reset")
    state.publish(spark, root, "d1", append={"fact_blacklist": row("P1")})
    assert passports() == ["P1"]


def test_first_run_on_empty_warehouse(spark, scratch):
    """No meta row: the watermark is NULL, so only rows created on 1900-01-01 are captured."""
    root = f"{scratch}/wh"
    clients = spark.createDataFrame([
        ("c1", "Ivanov", "Ivan", "P", OLD, "PP1", dt.datetime(2030, 1, 1), "ph1", OLD, dt.datetime(2024, 1, 5)),
        ("c2", "Petrov", "Petr", "P", OLD, "PP2", dt.datetime(2020, 1, 1), "ph2",
         dt.datetime(2023, 5, 1), dt.datetime(2024, 1, 5)),
    ], S.SRC_CLIENTS)
    accounts = spark.createDataFrame([("A1", dt.datetime(2030, 1, 1), "c1", OLD, None)], S.SRC_ACCOUNTS)
    cards = spark.createDataFrame([("K1", "A1", OLD, None)], S.SRC_CARDS)
    terminals = spark.createDataFrame([("T1", "ATM", "Moscow", "a1"), ("T2", "POS", "Kazan", "a2")],
                                      S.STG_TERMINALS)
    tx = spark.createDataFrame([
        ("1", dt.datetime(2024, 1, 30, 10), None, "K1", "PAY", "SUCCESS", "T1"),
        ("2", dt.datetime(2024, 1, 30, 11), None, "K1", "PAY", "SUCCESS", "T2"),
    ], S.STG_TRANSACTIONS)
    bl = spark.createDataFrame([], S.FACT_BLACKLIST)
    out = run_day(spark, root, "1", DayInputs(clients, accounts, cards, terminals, bl, tx),
                  "2024-01-31 03:36:00", work_dir=f"{scratch}/work")
    hist = {r.client_id for r in state.read_table(spark, root, "hist_clients").collect()}
    assert hist == {"c1"}                      # c2 was created later and the watermark never started
    rep = state.read_table(spark, root, "rep_fraud").collect()
    # K1 -> c1: next operation in another city one hour later (rule 3)
    assert [(r.passport, r.event_type) for r in rep] == [("PP1", 3)]
    assert rep[0].report_dt == dt.datetime(2024, 1, 30, 11)
    assert state.read_table(spark, root, "meta").count() == 0     # an update never inserts
    assert out["state"]["run_id"] == "1"


def test_retention_keeps_the_published_state_below_a_folder_named_like_a_run(spark, scratch):
    root = f"{scratch}/run=5/wh"
    row = lambda p: spark.createDataFrame([(OLD, p)], S.FACT_BLACKLIST)
    meta = spark.createDataFrame([("wh", "transactions", None)], S.META)
    state.publish(spark, root, "1", replace={"meta": meta}, append={"fact_blacklist": row("P1")})
    state.publish(spark, root, "2", replace={"meta": meta})
    state.Run(spark, root, "3").append("fact_blacklist", row("P9"))     # never committed
    removed = state.remove_superseded(spark, root + "/")
    assert len(removed) == 1 and "fact_blacklist/run=3" in removed[0]     # the first meta is the base of run 2
    assert state.read_table(spark, root, "meta").count() == 1 and state.read_table(spark, root, "fact_blacklist").count() == 1
    state.publish(spark, root, "4", replace={"meta": meta})
    assert len(state.remove_superseded(spark, root)) == 1
    assert state.read_table(spark, root, "meta").count() == 1


def test_one_profile_a_root(spark, scratch):
    root = f"{scratch}/wh"
    run = state.Run(spark, root, "1", "keyed")
    run.replace("meta", S.empty(spark, S.META))
    run.commit()
    assert state.current(spark, root)["profile"] == "keyed"
    with pytest.raises(ValueError, match="keyed profile"):
        state.Run(spark, root, "2", "reference")
    state.publish(spark, root, "2", replace={"meta": S.empty(spark, S.META)})
    assert state.current(spark, root)["profile"] == "keyed"     # a run that names none keeps it
    state.reset(spark, root, "r")
    state.Run(spark, root, "3", "reference")


def test_ledger_is_published_with_the_run_and_kept_by_a_reset(spark, scratch):
    root = f"{scratch}/wh"
    run = state.Run(spark, root, "1")
    run.record_files([("a.txt", 10, "20240101")])
    assert state.read_table(spark, root, "loaded_files").count() == 0
    run.commit()
    again = state.Run(spark, root, "1")         # the same run once more: its own files are not yet loaded
    assert again.loaded_files() == set()
    assert state.Run(spark, root, "2").loaded_files() == {("a.txt", 10)}
    state.reset(spark, root, "r")
    assert state.Run(spark, root, "3").loaded_files() == {("a.txt", 10)}
    state.reset(spark, root, "r2", keep=("meta",))
    assert state.Run(spark, root, "3").loaded_files() == set()


def test_a_days_keys_are_looked_up_in_few_row_groups(spark, scratch):
    """Facts lie in sorted ranges of the key: the day's bounds exclude most row groups by their statistics."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from cardwatch.operators.facts import new_facts
    root, cols = f"{scratch}/wh", S.FACT_TRANSACTIONS
    ids = lambda a, b: S.conform(spark.range(a, b).select(F.format_string("%08d", F.col("id")).alias("trans_id"), *[
        F.lit(None).alias(f.name) for f in cols if f.name != "trans_id"]), cols)
    for day in range(5):
        run = state.Run(spark, root, str(day))
        run.append("fact_transactions", ids(day * 4000, day * 4000 + 4000).orderBy(F.rand(1)))
        run.commit()
    fact = state.read_table(spark, root, "fact_transactions")
    stg = ids(19_900, 20_100)
    new = new_facts(fact, stg, "trans_id")
    assert sorted(r.trans_id for r in new.select("trans_id").collect()) == [f"{i:08d}" for i in range(20_000, 20_100)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trans_id,00019900)" in plan and "LessThanOrEqual(trans_id,00020099)" in plan
    groups, hit = 0, 0
    for path in glob.glob(f"{root}/fact_transactions/**/*.parquet", recursive=True):
        meta = pq.read_metadata(path)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            groups += 1
            hit += stats.max >= "00019900" and stats.min <= "00020099"
    assert groups >= 5 and hit <= groups / 4
    assert new_facts(fact, stg.limit(0), "trans_id").count() == 0
    nulls = stg.limit(2).withColumn("trans_id", F.lit(None).cast("string"))
    assert new_facts(fact, nulls, "trans_id").count() == 2
