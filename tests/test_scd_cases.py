"""Hand-written SCD2 cases with expected rows reasoned from the daily job's statements."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators import scd2
from cardwatch.plans.state import materializer

RUN = "2024-01-31 03:36:00"
RUN_TS = dt.datetime(2024, 1, 31, 3, 36)
CLOSED = dt.datetime(2024, 1, 30, 3, 36)        # run time - 1 day
HI = dt.datetime(9999, 12, 31)
OLD = dt.datetime(2020, 1, 1)
DOB = dt.datetime(1980, 1, 1)
PPV = dt.datetime(2030, 1, 1)


def _client(cid, last, first, pp, phone, flag=0, frm=OLD, to=HI):
    return (cid, last, first, "P", DOB, pp, PPV, phone, flag, frm, to)


def _stg(cid, last, first, pp, phone, create=OLD):
    return (cid, last, first, "P", DOB, pp, PPV, phone, create, RUN_TS)


def _scenario(spark):
    hist = spark.createDataFrame([
        _client("c1", "Ivanov", "Ivan", "PP1", "ph1"),
        _client("c2", "Petrov", "Petr", "PP2", "ph2"),
        _client("c3", "Ivanov", "Sergey", "PP3", "ph3"),     # shares c1's last name
        _client("c5", "Kuznetsov", "Kuzma", "PP5", "ph5"),   # gone from the source
    ], S.HIST_CLIENTS)
    stg = spark.createDataFrame([
        _stg("c1", "Ivanov", "Ivan", "PP1", "ph1-new"),     # phone only
        _stg("c2", "Sidorov", "Petr", "PP2", "ph2"),        # new, unknown last name
        _stg("c4", "Smirnov", "Anna", "PP4", "ph4", create=dt.datetime(2024, 1, 20)),  # new key
    ], S.STG_CLIENTS)
    # every key the source still holds (c3 unchanged, c5 gone)
    keys = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",)], "client_id string")
    return hist, stg, keys


def _rows(df):
    return sorted((r.client_id, r.last_name, r.phone, r.deleted_flg, r.effective_from, r.effective_to)
                  for r in df.collect())


def test_reference_profile_clients(spark):
    hist, stg, keys = _scenario(spark)
    out = scd2.apply_day(hist, stg, keys, S.CLIENTS, S.ts_lit(RUN), profile="reference")
    assert _rows(out) == sorted([
        # phone change: new version inserted, then every "Ivanov" row closed (c3 too)
        ("c1", "Ivanov", "ph1", 0, OLD, CLOSED),
        ("c1", "Ivanov", "ph1-new", 0, RUN_TS, CLOSED),
        ("c3", "Ivanov", "ph3", 0, OLD, CLOSED),
        # unknown new last name: correct new version, old closed
        ("c2", "Petrov", "ph2", 0, OLD, CLOSED),
        ("c2", "Sidorov", "ph2", 0, RUN_TS, HI),
        # new key from its create date
        ("c4", "Smirnov", "ph4", 0, dt.datetime(2024, 1, 20), HI),
        # delete: flagged from run time, then restored with an inverted interval
        ("c5", "Kuznetsov", "ph5", 1, RUN_TS, HI),
        ("c5", "Kuznetsov", "ph5", 0, RUN_TS, CLOSED),
    ])


def test_cards_never_get_a_second_version(spark):
    hist = spark.createDataFrame([("x1", "a1", 0, OLD, HI)], S.HIST_CARDS)
    stg = spark.createDataFrame([("x1", "a2", OLD, RUN_TS)], S.STG_CARDS)
    out = scd2.apply_day(hist, stg, stg.select("card_num"), S.CARDS, S.ts_lit(RUN))
    rows = [(r.card_num, r.account_num, r.effective_to) for r in out.collect()]
    assert rows == [("x1", "a1", CLOSED)]     # closed, and no open version left


def test_keyed_profile_is_proper_scd2(spark):
    hist, stg, keys = _scenario(spark)
    run = S.ts_lit(RUN)
    out = scd2.apply_day(hist, stg, keys, S.CLIENTS, run, profile="keyed")
    assert _rows(out) == sorted([
        ("c1", "Ivanov", "ph1", 0, OLD, RUN_TS),
        ("c1", "Ivanov", "ph1-new", 0, RUN_TS, HI),
        ("c2", "Petrov", "ph2", 0, OLD, RUN_TS),
        ("c2", "Sidorov", "ph2", 0, RUN_TS, HI),
        ("c3", "Ivanov", "ph3", 0, OLD, HI),                 # untouched
        ("c4", "Smirnov", "ph4", 0, dt.datetime(2024, 1, 20), HI),
        ("c5", "Kuznetsov", "ph5", 0, OLD, RUN_TS),          # closed ...
        ("c5", "Kuznetsov", "ph5", 1, RUN_TS, HI),           # ... and tombstoned
    ])
    # half-open: a version ends where the next one starts
    # at most one open unflagged version per key
    open_rows = (out.where((F.col("effective_to") == S.high()) & (F.col("deleted_flg") == 0))
                 .groupBy("client_id").count().where("count > 1"))
    assert open_rows.count() == 0
    # the same day again changes nothing
    again = scd2.apply_day(out, stg, keys, S.CLIENTS, run, profile="keyed")
    assert _rows(again) == _rows(out)


def test_keyed_profile_keeps_an_entity_staged_twice(spark):
    hist = S.empty(spark, S.HIST_ACCOUNTS)
    stg = spark.createDataFrame([("a1", PPV, "c1", OLD, OLD), ("a1", PPV, "c2", OLD, RUN_TS), (None, PPV, "c3", OLD, OLD)], S.STG_ACCOUNTS)
    out = scd2.apply_day(hist, stg, stg.select("account_num"), S.ACCOUNTS, S.ts_lit(RUN), profile="keyed")
    assert [(r.account_num, r.client, r.effective_to) for r in out.collect()] == [("a1", "c2", HI)]
    # an open row equal to the staged one stays open, others of the key close
    dirty = spark.createDataFrame([("a1", PPV, "c1", 0, OLD, HI), ("a1", PPV, "c2", 0, OLD, HI)], S.HIST_ACCOUNTS)
    out = scd2.apply_day(dirty, stg, stg.select("account_num"), S.ACCOUNTS, S.ts_lit(RUN), profile="keyed")
    assert sorted((r.client, r.effective_to) for r in out.collect()) == [("c1", RUN_TS), ("c2", HI)]


def test_null_key_is_always_new(spark):
    hist = spark.createDataFrame([("a1", PPV, "c1", 0, OLD, HI)], S.HIST_ACCOUNTS)
    stg = spark.createDataFrame([(None, PPV, "c9", OLD, RUN_TS)], S.STG_ACCOUNTS)
    new = scd2.insert_new(hist, stg, S.ACCOUNTS, scd2.spec_for(S.ACCOUNTS))
    assert new.count() == 1


def test_first_unique_version_counts_peers(spark):
    rows = [("k1", "a", 0, OLD, HI), ("k1", "b", 0, OLD, HI),         # tie on the first start
            ("k2", "a", 0, OLD, HI), ("k2", "b", 0, RUN_TS, HI),      # unique first start
            ("k3", "a", 0, None, HI)]                                 # only a NULL start
    h = spark.createDataFrame(rows, S.HIST_CARDS)
    keys = sorted(r.card_num for r in scd2.first_unique_version_keys(h, "card_num").collect())
    assert keys == ["k2", "k3"]


# ---- the day taken together equals the statements one by one -----------------------------------

DAYS = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)]


@pytest.mark.parametrize("name, seed", [("clients", 0), ("clients", 1), ("accounts", 0), ("terminals", 1)])
def test_the_day_together_equals_the_statements_one_by_one(spark, scratch, monkeypatch, name, seed):
    """Keys staged twice, NULL keys and values, values shared by many, rows flagged before, several open versions."""
    if seed == 1:
        monkeypatch.setattr(scd2, "SMALL_DELTA", 3)
    r = random.Random(f"{name}{seed}")
    dim, hi = S.DIMS[name], S.HIGH_DATE

    def value(field):
        if field.name == dim.key:
            return r.choice([None, *[f"k{i}" for i in range(12)]]) if r.random() < 0.9 else f"k{r.randrange(20, 30)}"
        if isinstance(field.dataType, S.T.TimestampNTZType):
            return r.choice(DAYS)
        return r.choice([None, "a", "b", "c", "d", "e", f"{field.name}{r.randrange(8)}"])

    fields = [f for f in dim.schema if f.name in dim.columns]
    hist = [tuple(value(f) for f in fields) + (r.choice([0, 0, 0, 1]), r.choice(DAYS), r.choice([hi, hi, dt.datetime(2024, 1, 3)])) for _ in range(40)]
    stg = [tuple(value(f) for f in fields) + (r.choice(DAYS), dt.datetime(2024, 1, 31)) for _ in range(18)]
    stg += stg[:3]
    keys = [(k,) for k in {x[0] for x in stg} | {f"k{i}" for i in range(0, 12, 2)}]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    frame = lambda rows, ddl: materializer(spark, scratch)(spark.createDataFrame(rows, ddl))
    h = frame(hist, dim.schema)
    s = frame(stg, names + ", create_dt timestamp_ntz, update_dt timestamp_ntz")
    k = frame(keys, f"{dim.key} string")
    day = spark.sql("select timestamp_ntz'2024-01-30 10:00:00' as m")
    for stop in ("insert_changed", "restore")[1 - seed:]:
        got, want = (sorted(map(repr, f(h, s, k, dim, S.ts_lit("2024-01-31 03:36:00"), day, stop_after=stop, materialize=materializer(spark, scratch)).collect()))
                     for f in (scd2.apply_day, scd2.apply_statements))
        assert got == want, stop
