"""Property tests against brute force on small random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwatch import schemas as S
from cardwatch.operators import scd2
from cardwatch.operators.sequence import lead_columns

KEYS = st.sampled_from(["a", "b", "c", None])
DAYS = st.sampled_from([None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)])
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(hist_keys=st.lists(KEYS, max_size=5), stg_rows=st.lists(st.tuples(KEYS, st.sampled_from(["x", "y"])), max_size=6))
def test_insert_new_is_anti_join_with_duplicates_and_nulls(spark, hist_keys, stg_rows):
    hist = spark.createDataFrame([(k, "x", 0, None, None) for k in hist_keys], S.HIST_CARDS)
    stg = spark.createDataFrame([(k, a, None, None) for k, a in stg_rows], S.STG_CARDS)
    spec = scd2.REFERENCE["terminals"]        # plain from/to, no lead
    got = sorted((r.card_num or "", r.account_num) for r in scd2.insert_new(hist, stg, S.CARDS, spec).collect())
    known = {k for k in hist_keys if k is not None}
    want = sorted((k or "", a) for k, a in stg_rows if k is None or k not in known)
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, DAYS), max_size=8))
def test_first_unique_version_is_min_start_unique(spark, rows):
    h = spark.createDataFrame([(k, "x", 0, d, None) for k, d in rows], S.HIST_CARDS)
    got = sorted(r.card_num for r in scd2.first_unique_version_keys(h, "card_num").collect())
    want = []
    for k in {k for k, _ in rows if k is not None}:
        starts = [d for kk, d in rows if kk == k]
        nonnull = [d for d in starts if d is not None]
        first = min(nonnull) if nonnull else None
        if sum(1 for d in starts if d == first) == 1:
            want.append(k)
    assert got == sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, DAYS, st.integers(0, 3)), min_size=1, max_size=10, unique_by=lambda r: (r[0], r[1], r[2])),
       hot=st.sampled_from([1, 2, 1000]))
def test_lead_matches_brute_force(spark, rows, hot):
    df = spark.createDataFrame([(k, d, i, f"v{i}") for k, d, i in rows], "k string, d timestamp_ntz, i int, v string")
    out = lead_columns(df, ["k"], ["d", "i"], ["v"], hot_rows=hot)
    got = sorted(((r.k or ""), str(r.d), r.i, r.next_v) for r in out.collect())
    want = []
    for k in {r[0] for r in rows}:
        seq = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1] is None, r[1] or dt.datetime.min, r[2]))
        for a, b in zip(seq, seq[1:] + [None]):
            want.append(((k or ""), str(a[1]), a[2], None if b is None else f"v{b[2]}"))
    assert got == sorted(want)
