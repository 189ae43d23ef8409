"""SCD2 queries (SCD-1..8) per dimension, reference and keyed profiles.

Each ``scd_<step>_<dim>`` query returns the whole history of the
dimension after the daily steps up to ``<step>`` (statement order of the
daily job), starting from ``fx_<dim>_hist`` with today's staged rows.
The oracle SQL spells the same steps as a chain of DuckDB CTEs.
"""

from __future__ import annotations

import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.catalog import register
from cardwatch.functions.columns import changed
from cardwatch.operators import scd2
from cardwatch.plans.inputs import run_ts, staged
from cardwatch.plans.q_cdc import CAPTURE_SQL, KEYS_SQL
from cardwatch.plans.state import materializer

RUN = "timestamp '2024-01-31 03:36:00'"
HI = "timestamp '9999-12-31 00:00:00'"
LO = "timestamp '1900-01-01 00:00:00'"
DAY = "(select max(trans_date) from fx_transactions)"

# What each statement of the daily job matches on, written out for the oracle.
_RULES = {
    "clients": SimpleNamespace(new_from="create_dt", new_to="high", change_match=("last_name", "passport_num", "passport_valid_to", "phone"),
                               close_on="last_name", close_guarded=("last_name",), flag_on="last_name", clock="run"),
    "accounts": SimpleNamespace(new_from="create_dt", new_to="lead", change_match=("valid_to", "client"),
                                close_on="client", close_guarded=("valid_to",), flag_on="client", clock="run"),
    "cards": SimpleNamespace(new_from="create_dt", new_to="lead", change_match=("card_num",),
                             close_on="account_num", close_guarded=("account_num",), flag_on="account_num", clock="run"),
    "terminals": SimpleNamespace(new_from="low", new_to="high", change_match=("terminal_type", "terminal_city", "terminal_address"),
                                 close_on="terminal_address", close_guarded=("terminal_address",), flag_on="terminal_address", clock="day"),
}


def day_history(fx, dim_name: str, stop_after: str, profile: str = "reference"):
    dim = S.DIMS[dim_name]
    hist, stg, keys, day = staged(fx, dim_name)
    mat = materializer(fx.spark)
    return scd2.apply_day(hist, stg, keys, dim, run_ts(), day, profile=profile,
                          stop_after=stop_after, materialize=mat)


# ---- oracle SQL: reference profile -------------------------------------------

def _stg_sql(dim_name):
    return "select * from fx_terminals_src" if dim_name == "terminals" else CAPTURE_SQL[dim_name]


def _cols(dim, p=""):
    return ", ".join(f"{p}{c}" for c in dim.columns)


_CTE_NAMES = re.compile(r"\b(stg|keys|one|gone|h\d(?:_\d)?|n\d(?:_\d)?|ct|ft|k8|r8)\b")


def prefixed(sql: str, prefix: str) -> tuple[str, str]:
    """Split ``with ... select * from X`` into (CTE list, X) with CTE names prefixed."""
    body, last = sql[len("with "):].rsplit("\nselect * from ", 1)
    ren = lambda t: _CTE_NAMES.sub(lambda m: prefix + m.group(1), t)
    return ren(body), ren(last.strip())


def reference_sql(dim_name: str, stop_after: str) -> str:
    dim, spec = S.DIMS[dim_name], _RULES[dim_name]
    k, attrs = dim.key, dim.attrs
    bank = spec.clock == "run"
    start = RUN if bank else DAY
    end = f"{start} - interval 1 day"
    ctes = [f"stg as ({_stg_sql(dim_name)})", f"keys as ({KEYS_SQL[dim_name]})",
            f"h0 as materialized (select * from fx_{dim_name}_hist)"]
    # SCD-1
    eff_from = "s.create_dt" if spec.new_from == "create_dt" else LO
    if spec.new_to == "lead":
        order = ", ".join(f"s.{c} asc nulls last" for c in ("create_dt", *attrs, "update_dt"))
        eff_to = f"coalesce(lead(s.create_dt) over (partition by s.{k} order by {order}) - interval 1 day, {HI})"
    else:
        eff_to = HI
    ctes.append(f"""n1 as (select {_cols(dim, 's.')}, 0 deleted_flg, {eff_from} effective_from, {eff_to} effective_to
  from stg s where not exists (select 1 from h0 t where t.{k} = s.{k}))""")
    ctes.append("h1 as materialized (select * from h0 union all select * from n1)")
    last = "h1"
    if stop_after != "insert_new":
        # SCD-4, one merge per match column, each seeing the previous one
        diff = " or ".join(f"s.{a} is distinct from t.{a}" for a in attrs)
        for i, m in enumerate(spec.change_match):
            n, h = f"n2_{i}", f"h2_{i}"
            ctes.append(f"""{n} as (select {_cols(dim, 's.')}, 0 deleted_flg, {start} effective_from, {HI} effective_to
  from stg s left join {last} t on s.{k} = t.{k}
  where (t.{k} is null or (t.effective_to = {HI} and ({diff})))
    and not exists (select 1 from {last} x where x.{m} = s.{m}))""")
            ctes.append(f"{h} as materialized (select * from {last} union all select * from {n})")
            last = h
    if stop_after not in ("insert_new", "insert_changed"):
        # SCD-5
        arms = []
        for a in attrs:
            arm = f"t.{a} <> s.{a}"
            arms.append(f"(t.effective_to = {HI} and {arm})" if a in spec.close_guarded else arm)
        c = spec.close_on
        ctes.append(f"""ct as (select distinct t.{c} from {last} t join stg s on t.{k} = s.{k}
  where {' or '.join(arms)})""")
        ctes.append(f"""h3 as materialized (select {_cols(dim)}, deleted_flg, effective_from,
  case when {c} in (select {c} from ct) then {end} else effective_to end effective_to from {last})""")
        last = "h3"
    if stop_after in ("flag_deleted", "restore"):
        # SCD-6
        f = spec.flag_on
        ctes.append(f"""ft as (select distinct t.{f} from {last} t
  where t.deleted_flg = 0 and t.effective_to = {HI} and not exists (select 1 from keys k where k.{k} = t.{k}))""")
        hit = f"{f} in (select {f} from ft)"
        new_from = f"case when {hit} then {RUN} else effective_from end" if bank else "effective_from"
        new_to = f"case when {hit} then {HI if bank else end} else effective_to end"
        ctes.append(f"""h4 as materialized (select {_cols(dim)}, case when {hit} then 1 else deleted_flg end deleted_flg,
  {new_from} effective_from, {new_to} effective_to from {last})""")
        last = "h4"
    if stop_after == "restore":
        # SCD-7 + SCD-8
        ctes.append(f"""k8 as (select {k} from (select {k}, count({k}) over (partition by {k} order by effective_from asc nulls last) cnt
  from {last}) where cnt < 2)""")
        r_from, r_to = ("effective_from", end) if bank else (DAY, HI)
        ctes.append(f"""r8 as (select distinct {_cols(dim)}, 0 deleted_flg, {r_from} effective_from, {r_to} effective_to
  from {last} where deleted_flg = 1 and {k} in (select {k} from k8))""")
        ctes.append(f"h5 as (select * from {last} union all select * from r8)")
        last = "h5"
    return "with " + ",\n".join(ctes) + f"\nselect * from {last}"


# ---- oracle SQL: keyed profile -------------------------------------------------

def keyed_sql(dim_name: str, stop_after: str) -> str:
    dim, spec = S.DIMS[dim_name], _RULES[dim_name]
    k, attrs = dim.key, dim.attrs
    bank = spec.clock == "run"
    start = RUN if bank else DAY
    end = start         # half-open versions
    eff_from = "s.create_dt" if spec.new_from == "create_dt" else LO
    by = ("update_dt", "create_dt", *attrs) if bank else attrs
    order = ", ".join(f"{c} desc nulls last" for c in by)
    # one staged row per key: the greatest by (update_dt, create_dt, attributes)
    one = (f"one as (select * from (select *, row_number() over (partition by {k} order by {order}) rn "
           f"from stg where {k} is not null) where rn = 1)")
    ctes = [f"stg as ({_stg_sql(dim_name)})", f"keys as ({KEYS_SQL[dim_name]})",
            f"h0 as materialized (select * from fx_{dim_name}_hist)", one,
            f"""n1 as (select {_cols(dim, 's.')}, 0 deleted_flg, {eff_from} effective_from, {HI} effective_to
  from one s where not exists (select 1 from h0 t where t.{k} = s.{k}))""",
            "h1 as materialized (select * from h0 union all select * from n1)"]
    last = "h1"
    if stop_after != "insert_new":
        same = " and ".join(f"s.{a} is not distinct from t.{a}" for a in attrs)
        ctes.append(f"""n2 as (select {_cols(dim, 's.')}, 0 deleted_flg, {start} effective_from, {HI} effective_to
  from one s where exists (select 1 from h1 t where t.{k} = s.{k})
    and not exists (select 1 from h1 t where t.{k} = s.{k} and t.effective_to = {HI}
                    and t.deleted_flg = 0 and {same}))""")
        diff = " or ".join(f"t.{a} is distinct from s.{a}" for a in attrs)
        if stop_after == "insert_changed":
            ctes.append("h2 as (select * from h1 union all select * from n2)")
        else:
            ctes.append(f"""h2 as materialized (select {_cols(dim, 't.')}, t.deleted_flg, t.effective_from,
  case when s.{k} is not null and t.effective_to = {HI} and (t.deleted_flg = 1 or {diff}) then {end} else t.effective_to end effective_to
  from h1 t left join one s on t.{k} = s.{k} union all select * from n2)""")
        last = "h2"
    if stop_after in ("flag_deleted", "restore"):
        ctes.append(f"""gone as (select * from {last} t where t.deleted_flg = 0 and t.effective_to = {HI}
  and t.{k} is not null and not exists (select 1 from keys x where x.{k} = t.{k}))""")
        ctes.append(f"""h3 as (select {_cols(dim)}, deleted_flg, effective_from,
  case when deleted_flg = 0 and effective_to = {HI} and {k} in (select {k} from gone) then {end}
       else effective_to end effective_to from {last}
  union all select {_cols(dim)}, 1, {start}, {HI} from gone)""")
        last = "h3"
    return "with " + ",\n".join(ctes) + f"\nselect * from {last}"


# ---- registration ---------------------------------------------------------------

def _dim_query(dim_name, step, profile):
    def q(fx):
        return day_history(fx, dim_name, step, profile)
    q.__doc__ = f"{dim_name} history after the daily steps up to {step} ({profile} profile)."
    return q


_REF_STEPS = {"insert_new": "scd_insert_new", "insert_changed": "scd_insert_changed",
              "close": "scd_close", "flag_deleted": "scd_flag_deleted", "restore": "scd_restore"}
_KEYED_STEPS = {"insert_changed": "scd_insert_changed", "close": "scd_close",
                "flag_deleted": "scd_flag_deleted"}

for _d in ("clients", "accounts", "cards", "terminals"):
    for _step, _prefix in _REF_STEPS.items():
        register(f"{_prefix}_{_d}", reference_sql(_d, _step))(_dim_query(_d, _step, "reference"))
    for _step, _prefix in _KEYED_STEPS.items():
        register(f"{_prefix}_{_d}_keyed", keyed_sql(_d, _step))(_dim_query(_d, _step, "keyed"))


# ---- single building blocks --------------------------------------------------------

_CHANGED_SQL = "\n".join([
    "select s.client_id, t.effective_from,",
    "       (" + " or ".join(f"s.{a} is distinct from t.{a}" for a in S.CLIENT_ATTRS) + ") is_changed",
    "from stg s join fx_clients_hist t on s.client_id = t.client_id",
    f"where t.effective_to = {HI}"])


@register("scd_changed_nullsafe", f"with stg as ({CAPTURE_SQL['clients']})\n{_CHANGED_SQL}")
def scd_changed_nullsafe(fx):
    """SCD-2: null-safe change test of staged clients against their open versions."""
    hist, stg, _, _ = staged(fx, "clients")
    s, t = stg.alias("s"), hist.where(scd2.is_open()).alias("t")
    return (s.join(t, F.col("s.client_id") == F.col("t.client_id"))
            .select(F.col("s.client_id"), F.col("t.effective_from"),
                    changed(S.CLIENT_ATTRS, "s", "t").alias("is_changed")))


_VE_ORDER = ", ".join(f"{c} asc nulls last" for c in ("effective_from", *S.CLIENT_ATTRS, "deleted_flg", "effective_to"))


@register("scd_version_end", f"""
select client_id, effective_from, effective_to, phone,
       coalesce(lead(effective_from) over (partition by client_id order by {_VE_ORDER}) - interval 1 day,
                {HI}) version_end
from fx_clients_hist""")
def scd_version_end(fx):
    """SCD-3: each version ends the day before the next version of its key starts."""
    h = fx["fx_clients_hist"]
    out = scd2.version_end(h, "client_id", "effective_from",
                           (*S.CLIENT_ATTRS, "deleted_flg", "effective_to"))
    return out.select("client_id", "effective_from", "effective_to", "phone", "version_end")


@register("scd_first_unique_version", reference_sql("clients", "flag_deleted").rsplit("\nselect", 1)[0] + """,
firsts as (select client_id from (select client_id,
    count(client_id) over (partition by client_id order by effective_from asc nulls last) cnt from h4)
  where cnt < 2 and client_id is not null)
select distinct client_id from firsts""")
def scd_first_unique_version(fx):
    """SCD-7: clients whose earliest version start is held by one row (after today's flags)."""
    h = day_history(fx, "clients", "flag_deleted")
    return scd2.first_unique_version_keys(h, "client_id")
