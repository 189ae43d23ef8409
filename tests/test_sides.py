"""Table-sized sides of joins do not pass through the driver, however small their files are."""

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators import cdc, facts, fraud, scd2
from cardwatch.plans.state import materializer

N = 100_500
RUN = "2024-01-31 03:36:00"


def _client_columns(phone="'p'"):
    return ["string(id) client_id", "'L' last_name", "'F' first_name", "'M' patronymic", "cast('1980-01-01' as timestamp_ntz) date_of_birth",
            "concat('P', id) passport_num", "cast('2030-01-01' as timestamp_ntz) passport_valid_to", f"{phone} phone"]


VERSION = ["0 deleted_flg", "cast('2020-01-01' as timestamp_ntz) effective_from", "cast('9999-12-31' as timestamp_ntz) effective_to"]
STAMPS = ["cast('2020-01-01' as timestamp_ntz) create_dt", "cast('2024-01-20' as timestamp_ntz) update_dt"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    mat = materializer(spark, str(tmp_path_factory.mktemp("sides")))
    ids = spark.range(N)
    return {"clients": mat(S.conform(ids.selectExpr(*_client_columns(), *VERSION), S.HIST_CLIENTS)),
            "accounts": mat(S.conform(ids.selectExpr("concat('A', id) account_num", "cast('2030-01-01' as timestamp_ntz) valid_to", "string(id) client", *VERSION), S.HIST_ACCOUNTS)),
            "cards": mat(S.conform(ids.selectExpr("concat('C', id) card_num", "concat('A', id) account_num", *VERSION), S.HIST_CARDS)),
            "terminals": mat(S.conform(spark.range(5).selectExpr("concat('T', id) terminal_id", "'ATM' terminal_type", "concat('city ', id) terminal_city", "'x' terminal_address", *VERSION), S.HIST_TERMINALS)),
            "blacklist": mat(S.conform(ids.where("id % 1000 = 0").selectExpr("cast('2020-01-01' as timestamp_ntz) entry_dt", "concat('P', id) passport_num"), S.FACT_BLACKLIST)),
            "tx": mat(S.conform(ids.selectExpr("string(id) trans_id", "cast('2024-01-30' as timestamp_ntz) trans_date", "1 amt", "concat('C', id) card_num", "'x' oper_type", "'y' oper_result",
                                               "concat('T', id % 5) terminal"), S.FACT_TRANSACTIONS)),
            "stg_clients": mat(S.conform(ids.selectExpr(*_client_columns("if(id % 1000 = 3, 'moved', 'p')"), *STAMPS), S.STG_CLIENTS))}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


class Watch:
    """A ``materialize`` that keeps the plans it runs."""

    def __init__(self, spark, folder):
        self.mat, self.plans = materializer(spark, folder), []

    def __call__(self, df):
        self.plans.append(_plan(df))
        return self.mat(df)


def _broadcasts(*plans):
    return [line for p in plans for line in p.splitlines() if "BroadcastExchange" in line]


def test_keyed_day_shuffles_table_sized_sides(spark, scratch, tables):
    watch, now = Watch(spark, scratch), S.ts_lit(RUN)
    gone = tables["stg_clients"].where("client_id % 1000 <> 7").select("client_id")
    out = scd2.apply_day(tables["clients"], tables["stg_clients"], gone, S.CLIENTS, now, profile="keyed", materialize=watch)
    few = [p for p in _plan(out).splitlines() if "BroadcastExchange" in p]       # at most the few keys that are gone
    assert not _broadcasts(*watch.plans) and len(few) <= 1
    moved, left = len(range(3, N, 1000)), len(range(7, N, 1000))
    got = out.groupBy("deleted_flg", (F.col("effective_to") == S.high()).alias("open")).count().collect()
    assert {(r.deleted_flg, r.open): r["count"] for r in got} == {(0, True): N - left, (0, False): moved + left, (1, True): left}


def test_capture_and_facts_shuffle_table_sized_sides(spark, tables):
    seed, hist = tables["stg_clients"], tables["clients"].where("client_id % 2 = 0")
    out = cdc.not_in(seed, "client_id", hist, "client_id")
    assert not _broadcasts(_plan(out)) and out.count() == len(range(1, N, 2))
    new = facts.new_facts(tables["tx"].where("trans_id % 2 = 0"), tables["tx"], "trans_id")
    assert not _broadcasts(_plan(new)) and new.count() == len(range(1, N, 2))


def test_as_of_reports_shuffle_table_sized_sides(spark, scratch, tables):
    dims = [tables[d] for d in ("cards", "accounts", "clients", "blacklist")]
    line = fraud.card_timeline(*dims)
    assert len(_broadcasts(_plan(line))) <= 1 and line.count() == N       # the few passports of the blacklist
    watch = Watch(spark, scratch)
    carry = fraud.carry_from_history(tables["terminals"], tables["tx"], *dims, watch)
    later = watch(tables["tx"].withColumn("trans_date", F.lit("2024-01-31").cast(S.TS)).withColumn("trans_id", F.concat(F.lit("n"), "trans_id")))
    report, cards, passports = fraud.day_report(tables["terminals"], later, *dims, later, *carry, materialize=watch)
    plans = [*watch.plans, _plan(report), _plan(cards), _plan(passports)]
    # the counted broadcast of five terminals and the few passports are all that is broadcast
    assert all(len(_broadcasts(p)) <= 2 for p in plans) and not _broadcasts(_plan(report))
    assert report.where("event_type = 1").count() == len(range(0, N, 1000)) and cards.count() == N


def test_reference_day_and_report_shuffle_table_sized_sides(spark, scratch, tables):
    watch, now = Watch(spark, scratch), S.ts_lit(RUN)
    out = scd2.apply_day(tables["clients"], tables["stg_clients"], tables["stg_clients"].select("client_id"), S.CLIENTS, now, materialize=watch)
    assert out.count() >= N
    few = [b for p in watch.plans for b in _broadcasts(p)]      # of keys that are new, values hit and rows flagged: few rows or none
    assert len(few) <= 4
    dims = [tables[d] for d in ("cards", "accounts", "clients", "blacklist")]
    report = fraud.fraud_report(tables["terminals"], tables["tx"], *dims, tables["tx"], materialize=watch)
    assert report.where("event_type = 1").count() == len(range(0, N, 1000))
    assert len(_broadcasts(_plan(fraud.card_profiles(*dims)))) <= 1 and len(_broadcasts(_plan(report))) <= 1


def test_keyed_day_passes_over_the_history_three_times(spark, scratch):
    """For the staged keys, for the keys that are gone, and to rewrite it."""
    ids = spark.range(50)
    S.conform(ids.selectExpr(*_client_columns(), *VERSION), S.HIST_CLIENTS).write.parquet(f"{scratch}/h")
    hist, watch = spark.read.parquet(f"{scratch}/h"), Watch(spark, f"{scratch}/w")
    stg = watch.mat(S.conform(spark.range(60).selectExpr(*_client_columns("if(id % 10 = 3, 'moved', 'p')"), *STAMPS), S.STG_CLIENTS))
    out = scd2.apply_day(hist, stg, stg.where("client_id <> '7'").select("client_id"), S.CLIENTS, S.ts_lit(RUN), profile="keyed", materialize=watch)
    scans = sum(f"{scratch}/h]" in line for p in [*watch.plans, _plan(out)] for line in p.splitlines() if "FileScan" in line)
    assert scans == 3
    # 50 versions, ten new keys, five changed, one tombstone
    assert out.count() == 66 and out.where("deleted_flg = 1").count() == 1 and out.where(F.col("effective_to") == S.high()).count() == 60
