"""Fraud-report queries (FRD-1..11) over the fixture warehouse state.

State before the report: dimension histories ``fx_*_hist``, the fact
``fx_transactions`` (also the day's staging, whose latest time is the
report date) and today's blacklist ``fx_blacklist_src``.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cardwatch.catalog import register
from cardwatch.functions.columns import full_name
from cardwatch.operators import fraud as frd
from cardwatch.plans.state import materializer


def _state(fx):
    return dict(terminals=fx["fx_terminals_hist"], transactions=fx["fx_transactions"],
                cards=fx["fx_cards_hist"], accounts=fx["fx_accounts_hist"],
                clients=fx["fx_clients_hist"], blacklist=fx["fx_blacklist_src"])


# ---- oracle SQL building blocks (DuckDB dialect) ---------------------------

_ORDER = ("trans_date, trans_id, tm_effective_from, c_effective_from, terminal_city, "
          "passport_num, last_name, first_name, patronymic, phone, passport_valid_to, deleted_flg")
ORDER_SQL = ", ".join(f"{c.strip()} asc nulls last" for c in _ORDER.split(","))

ENRICH_SQL = """
enriched as (
  select t.trans_id, t.trans_date, t.card_num, t.terminal, tm.terminal_city,
         tm.effective_from tm_effective_from,
         c.client_id, c.last_name, c.first_name, c.patronymic, c.date_of_birth, c.passport_num,
         c.passport_valid_to, c.phone, c.deleted_flg, c.effective_from c_effective_from,
         coalesce(c.passport_num in (select passport_num from fx_blacklist_src), false) blacklisted
  from fx_terminals_hist tm
  join fx_transactions t on tm.terminal_id = t.terminal
  left join fx_cards_hist cd on t.card_num = cd.card_num
  left join fx_accounts_hist a on cd.account_num = a.account_num
  left join fx_clients_hist c on a.client = c.client_id
)"""

ENRICH_ASOF_SQL = """
enriched as (
  select t.trans_id, t.trans_date, t.card_num, t.terminal, tm.terminal_city,
         tm.effective_from tm_effective_from,
         c.client_id, c.last_name, c.first_name, c.patronymic, c.date_of_birth, c.passport_num,
         c.passport_valid_to, c.phone, c.deleted_flg, c.effective_from c_effective_from,
         coalesce(c.passport_num in (select passport_num from fx_blacklist_src), false) blacklisted
  from fx_terminals_hist tm
  join fx_transactions t on tm.terminal_id = t.terminal
       and t.trans_date >= tm.effective_from and t.trans_date < tm.effective_to
  left join fx_cards_hist cd on t.card_num = cd.card_num
       and t.trans_date >= cd.effective_from and t.trans_date < cd.effective_to
  left join fx_accounts_hist a on cd.account_num = a.account_num
       and t.trans_date >= a.effective_from and t.trans_date < a.effective_to
  left join fx_clients_hist c on a.client = c.client_id
       and t.trans_date >= c.effective_from and t.trans_date < c.effective_to
)"""


def _seq_sql(enrich=ENRICH_SQL, gap="60 day"):
    return enrich + f""",
seq as (
  select e.*,
         lead(terminal_city) over w next_terminal_city,
         lead(trans_date) over w next_trans_date
  from enriched e
  window w as (partition by card_num order by {ORDER_SQL})
),
typed as (
  select s.*,
         case when passport_valid_to < trans_date or blacklisted then 1
              when deleted_flg = 1 then 2
              when next_terminal_city <> terminal_city
                   and next_trans_date < trans_date + interval {gap} then 3
              else 0 end event_type,
         max(trans_date) over (partition by passport_num) event_dt
  from seq s
)"""


def _events_sql(enrich=ENRICH_SQL, gap="60 day"):
    return "with " + _seq_sql(enrich, gap) + """,
events as (
  select distinct event_dt, passport_num, last_name, first_name, patronymic, phone, event_type,
         (select max(trans_date) from fx_transactions) report_dt
  from typed where event_type > 0
)"""


def state_enrich_sql(tm, tx, cd, ac, cl, bl, enrich=ENRICH_SQL):
    """ENRICH_SQL over other state tables (e.g. CTEs of the state after a run)."""
    return (enrich.replace("from fx_terminals_hist tm", f"from {tm} tm")
            .replace("join fx_transactions t on", f"join {tx} t on")
            .replace("left join fx_cards_hist cd", f"left join {cd} cd")
            .replace("left join fx_accounts_hist a", f"left join {ac} a")
            .replace("left join fx_clients_hist c", f"left join {cl} c")
            .replace("select passport_num from fx_blacklist_src", f"select passport_num from {bl}"))


def _report_sql(enrich=ENRICH_SQL, gap="60 day"):
    return _events_sql(enrich, gap) + """
select event_dt, passport_num passport,
       coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') fio,
       phone, event_type, report_dt
from events"""


# ---- queries ---------------------------------------------------------------

@register("fraud_report", _report_sql())
def fraud_report(fx):
    """FRD-11 flagship: the whole report, reference semantics (all versions)."""
    return frd.fraud_report(**_state(fx), stg_transactions=fx["fx_transactions"], materialize=materializer(fx.spark))


@register("fraud_report_keyed", _report_sql(ENRICH_ASOF_SQL, "60 minute"))
def fraud_report_keyed(fx):
    """FRD-11, keyed profile: versions valid at the operation time, 60-minute hop."""
    return frd.fraud_report(**_state(fx), stg_transactions=fx["fx_transactions"],
                            max_gap="60 minutes", as_of=True, materialize=materializer(fx.spark))


_ENRICH_COLS = ("trans_id, trans_date, card_num, terminal, terminal_city, tm_effective_from, client_id, "
                "last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, "
                "phone, deleted_flg, c_effective_from, blacklisted")


@register("frd_enrich", f"with {ENRICH_SQL} select {_ENRICH_COLS} from enriched")
def frd_enrich(fx):
    """FRD-1: operations joined to every version of terminal, card, account, client."""
    return frd.enrich(**_state(fx)).select(*[c.strip() for c in _ENRICH_COLS.split(",")])


@register("frd_enrich_asof", f"with {ENRICH_ASOF_SQL} select {_ENRICH_COLS} from enriched")
def frd_enrich_asof(fx):
    """FRD-1 as-of: each dimension joined at the version valid at trans_date."""
    return frd.enrich(**_state(fx), as_of=True).select(*[c.strip() for c in _ENRICH_COLS.split(",")])


def _versions(fx):
    """The state with closed versions, holes and moves."""
    return dict(_state(fx), **{d: fx[f"fx_{d}_versions"] for d in ("terminals", "cards", "accounts", "clients")})


_VERSIONS_SQL = re.sub(r"fx_(terminals|cards|accounts|clients)_hist", r"fx_\1_versions", ENRICH_ASOF_SQL)


@register("frd_enrich_asof_versions", f"with {_VERSIONS_SQL} select {_ENRICH_COLS} from enriched")
def frd_enrich_asof_versions(fx):
    """FRD-1 as-of over histories with closed versions and holes: a card moves between accounts, an account between clients."""
    return frd.enrich(**_versions(fx), as_of=True).select(*[c.strip() for c in _ENRICH_COLS.split(",")])


@register("fraud_report_keyed_versions", _report_sql(_VERSIONS_SQL, "60 minute"))
def fraud_report_keyed_versions(fx):
    """FRD-11, keyed profile, over histories with closed versions and holes."""
    return frd.fraud_report(**_versions(fx), stg_transactions=fx["fx_transactions"],
                            max_gap="60 minutes", as_of=True, materialize=materializer(fx.spark))


_DAY0 = "(select date_trunc('day', max(trans_date)) from fx_transactions)"


@register("fraud_report_day_keyed", "with " + _seq_sql(_VERSIONS_SQL, "60 minute") + f"""
select distinct event_dt, passport_num passport,
       coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') fio,
       phone, event_type, (select max(trans_date) from fx_transactions) report_dt
from typed where event_type > 0 and (trans_date >= {_DAY0} or (event_type = 3 and next_trans_date >= {_DAY0}))""")
def fraud_report_day_keyed(fx):
    """FRD-11 for the last day's operations; of the days before, only the carried state is read."""
    st, mat, tx = _versions(fx), materializer(fx.spark), fx["fx_transactions"]
    start = tx.agg(F.date_trunc("day", F.max("trans_date")).cast("timestamp_ntz")).scalar()
    carry = frd.carry_from_history(**dict(st, transactions=tx.where(F.col("trans_date") < start)), materialize=mat)
    st.pop("transactions")
    day = mat(tx.where(F.col("trans_date") >= start))
    return frd.day_report(day_transactions=day, stg_transactions=day, carry_cards=carry[0], carry_passports=carry[1],
                          max_gap="60 minutes", materialize=mat, **st)[0]


@register("frd_rule_passport", f"""with {ENRICH_SQL}
select trans_id, card_num, client_id, passport_num, passport_valid_to, trans_date, blacklisted
from enriched where passport_valid_to < trans_date or blacklisted""")
def frd_rule_passport(fx):
    """FRD-2: rows whose passport was expired at operation time or is blacklisted."""
    e = frd.enrich(**_state(fx))
    return e.where(frd.rule_passport(e)).select(
        "trans_id", "card_num", "client_id", "passport_num", "passport_valid_to", "trans_date",
        "blacklisted")


@register("frd_rule_closed", f"""with {ENRICH_SQL}
select trans_id, card_num, client_id, deleted_flg from enriched where deleted_flg = 1""")
def frd_rule_closed(fx):
    """FRD-3: rows whose client version is flagged deleted."""
    e = frd.enrich(**_state(fx))
    return e.where(frd.rule_closed(e)).select("trans_id", "card_num", "client_id", "deleted_flg")


def _hop_sql(gap):
    return "with " + _seq_sql(ENRICH_SQL, gap) + f"""
select trans_id, card_num, trans_date, terminal_city, next_terminal_city, next_trans_date, passport_num
from typed where next_terminal_city <> terminal_city and next_trans_date < trans_date + interval {gap}"""


def _sequence(fx):
    """Enriched operations with the next one of the card; the rows per card are counted before the fan-out."""
    st = _state(fx)
    profiles = frd.card_profiles(st["cards"], st["accounts"], st["clients"])
    return frd.with_next_operation(frd.enrich(**st), tx=st["transactions"].select("card_num"), profiles=profiles)


def _hop(fx, gap):
    seq = _sequence(fx)
    return seq.where(frd.rule_city_hop(seq, gap)).select(
        "trans_id", "card_num", "trans_date", "terminal_city", "next_terminal_city",
        "next_trans_date", "passport_num")


@register("frd_rule_city_hop_60d", _hop_sql("60 day"))
def frd_rule_city_hop_60d(fx):
    """FRD-4: next operation of the card in another city less than 60 days later."""
    return _hop(fx, "60 days")


@register("frd_rule_city_hop_60min", _hop_sql("60 minute"))
def frd_rule_city_hop_60min(fx):
    """FRD-4 with a 60-minute gap."""
    return _hop(fx, "60 minutes")


@register("frd_event_type", "with " + _seq_sql() + """
select event_type, count(*) n_rows from typed group by event_type""")
def frd_event_type(fx):
    """FRD-5: rule priority per enriched row, counted by resulting type."""
    seq = _sequence(fx)
    return (seq.select(frd.event_type(seq).alias("event_type"))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows")))


@register("frd_last_event", f"""with {ENRICH_SQL}
select passport_num, max(trans_date) event_dt from enriched group by passport_num""")
def frd_last_event(fx):
    """FRD-6: latest operation per passport over all enriched rows."""
    st = _state(fx)
    tx = frd.transactions_at_terminals(st["terminals"], st["transactions"])
    prof = frd.card_profiles(st["cards"], st["accounts"], st["clients"])
    return frd.last_event_by_passport(tx, prof)


@register("frd_report_date", "select max(trans_date) report_dt from fx_transactions")
def frd_report_date(fx):
    """FRD-7: report date = latest operation of the day's staging."""
    return frd.report_date(fx["fx_transactions"])


@register("frd_full_name", """
select client_id, effective_from, effective_to,
       coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') fio
from fx_clients_hist""")
def frd_full_name(fx):
    """FRD-8: full name where a NULL part reads as empty text."""
    return fx["fx_clients_hist"].select(
        "client_id", "effective_from", "effective_to",
        full_name("last_name", "first_name", "patronymic").alias("fio"))


@register("frd_dedupe_events", _events_sql() + " select * from events")
def frd_dedupe_events(fx):
    """FRD-9: distinct event rows of type > 0, before the name is assembled."""
    return frd.report_events(**_state(fx), stg_transactions=fx["fx_transactions"])
