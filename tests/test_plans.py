"""Plan shape: no nested loops, one exchange of the operations in the as-of join, no earlier facts in a day's report, hot path exact."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import compare, duck_connection

from cardwatch.fixtures import Fixtures
from cardwatch.operators import fraud
from cardwatch.plans.state import materializer
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_has_no_nested_loop(spark):
    plan = _plan(entry.entry(spark))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert plan.count("\n") > 20


def _above(plan: str, leaf: str) -> list[list[str]]:
    """Per scan of ``leaf``, the operators above it in the plan's tree."""
    out, stack = [], []
    for line in plan.splitlines():
        body = re.sub(r"^[\s:|+-]*(?:\*\(\d+\) )?", "", line)
        depth = len(line) - len(re.sub(r"^[\s:|+-]*", "", line))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if leaf in line:
            out.append([b for _, b in stack])
        stack.append((depth, body))
    return out


def _exchanges(operators: list[str]) -> list[str]:
    return [o for o in operators if o.startswith("Exchange")]


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _stored(spark, fx, scratch, name, source=None):
    path = f"{scratch}/{name}"
    fx[source or name].write.parquet(path)
    return spark.read.parquet(path)


def test_as_of_join_exchanges_the_operations_once(spark, scratch, no_broadcast):
    """Only the checked broadcast of the terminals and one exchange on the card, whatever Spark would broadcast by itself."""
    fx = Fixtures(spark, SF_SMALL)
    dims = {d: _stored(spark, fx, scratch, f"fx_{d}_versions") for d in ("terminals", "cards", "accounts", "clients")}
    tx = _stored(spark, fx, scratch, "facts_here", "fx_transactions")
    df = fraud.enrich(**dims, transactions=tx, blacklist=fx["fx_blacklist_src"], as_of=True)
    above = _above(_plan(df), "facts_here")
    assert len(above) == 1 and [re.search(r"hashpartitioning\((\w+)", e)[1] for e in _exchanges(above[0])] == ["card_num"]


def test_a_days_report_reads_no_earlier_operations(spark, scratch):
    fx = Fixtures(spark, SF_SMALL)
    dims = {d: _stored(spark, fx, scratch, f"fx_{d}_versions") for d in ("terminals", "cards", "accounts", "clients")}
    tx = _stored(spark, fx, scratch, "all_facts", "fx_transactions")
    mat = materializer(spark, scratch)
    early, late = (mat(tx.where(f"trans_date {op} timestamp_ntz'2024-01-20'")) for op in ("<", ">="))
    carry = fraud.carry_from_history(transactions=early, blacklist=fx["fx_blacklist_src"], materialize=mat, **dims)
    old = early.inputFiles()[0].rsplit("/", 2)[1]
    out = fraud.day_report(day_transactions=late, stg_transactions=late, blacklist=fx["fx_blacklist_src"], carry_cards=carry[0], carry_passports=carry[1], **dims)
    for df in out:
        files = {f.rsplit("/", 2)[1] for f in df.inputFiles()}
        assert old not in files and "all_facts" not in files


def test_reports_of_the_days_add_up_to_the_whole_report(spark, scratch):
    """Four days (one without a row), the same versions: each event once, and the last times agree."""
    fx = Fixtures(spark, SF_SMALL)
    dims = {d: _stored(spark, fx, scratch, f"fx_{d}_versions") for d in ("terminals", "cards", "accounts", "clients")}
    bl, mat = fx["fx_blacklist_src"], materializer(spark, scratch)
    # cards of their own and NULL cards, so that rows without a passport follow one another over the days
    tx = mat(fx["fx_transactions"].withColumn("card_num", F.when(F.col("trans_id").cast("bigint") % 11 == 0, F.lit(None)).otherwise(F.col("card_num"))))
    bounds = ["1900-01-01", "2024-01-09", "2024-01-17", "2024-01-17", "2024-02-01"]
    parts = [mat(tx.where(f"trans_date >= timestamp_ntz'{a}' and trans_date < timestamp_ntz'{b}'")) for a, b in zip(bounds, bounds[1:])]
    carry = fraud.carry_from_history(transactions=parts[0].limit(0), blacklist=bl, materialize=mat, **dims)
    got, carried = set(), 0
    for i, part in enumerate(parts):
        report, *carry = fraud.day_report(day_transactions=part, stg_transactions=part, blacklist=bl, carry_cards=carry[0], carry_passports=carry[1],
                                          max_gap="3 days", materialize=mat, **dims)
        rows = {(r.passport, r.fio, r.phone, r.event_type) for r in report.collect()}
        carried += i == 2 and len(rows)
        got |= rows
    whole = fraud.fraud_report(transactions=tx, stg_transactions=tx, blacklist=bl, max_gap="3 days", as_of=True, materialize=mat, **dims).collect()
    assert got == {(r.passport, r.fio, r.phone, r.event_type) for r in whole} and {3} <= {r.event_type for r in whole} and carried == 0
    last = {r.passport_num: r.event_dt for r in carry[1].collect()}
    assert {(r.passport, r.event_dt) for r in whole} <= set(last.items())


def test_report_scans_only_needed_columns(spark):
    df = entry.entry(spark)
    text = df._jdf.queryExecution().executedPlan().toString()
    # the events scan reads the columns the transaction view uses; props is never read
    assert "ReadSchema" in text and "props" not in text


def test_report_hot_card_path_matches_oracle(spark):
    """With a tiny hot threshold every card is split into time buckets."""
    spark.conf.set("cardwatch.lead.hotRows", "20")
    try:
        qs, orc = entry.queries(), entry.oracle_sql()
        for name in ("fraud_report", "frd_rule_city_hop_60min"):
            ok, msg = compare(spark, name, SF_SMALL, qs, orc, duck_connection(SF_SMALL))
            assert ok, msg
    finally:
        spark.conf.unset("cardwatch.lead.hotRows")
