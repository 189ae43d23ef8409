"""Whole-run queries (SNK-1..4, E1-E3): seed a published state from the
fixture views, run one day through :func:`run_day`, read the result back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.catalog import register
from cardwatch.fixtures import RUN_TS
from cardwatch.plans import q_fraud, q_scd
from cardwatch.plans.daily import DayInputs, run_day
from cardwatch.plans.q_sources import scratch
from cardwatch.plans.state import Run, read_table, reset


def seed_state(fx, root: str) -> dict:
    """Run "0": the warehouse as it stood before today (tables written concurrently)."""
    run = Run(fx.spark, root, "0")
    writes = [(run.replace, f"hist_{d}", fx[f"fx_{d}_hist"])
              for d in ("clients", "accounts", "cards", "terminals")]
    writes += [(run.append, "fact_transactions", fx["fx_transactions_hist"]),
               (run.append, "fact_blacklist", fx["fx_blacklist_hist"]),
               (run.replace, "meta", fx["fx_meta"]),
               (run.replace, "rep_fraud", S.empty(fx.spark, S.REP_FRAUD))]
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        list(pool.map(lambda w: w[0](w[1], w[2]), writes))
    return run.commit()


def day_inputs(fx) -> DayInputs:
    return DayInputs(clients=fx["fx_clients_src"], accounts=fx["fx_accounts_src"],
                     cards=fx["fx_cards_src"], terminals=fx["fx_terminals_src"],
                     blacklist=fx["fx_blacklist_src"], transactions=fx["fx_transactions"])


def _after_run_sql(profile: str = "reference") -> str:
    ctes = []
    names = {}
    for d, p in (("clients", "cli_"), ("accounts", "acc_"), ("cards", "crd_"), ("terminals", "trm_")):
        dim_sql = (q_scd.reference_sql(d, "restore") if profile == "reference"
                   else q_scd.keyed_sql(d, "flag_deleted"))
        body, last = q_scd.prefixed(dim_sql, p)
        ctes.append(body)
        names[d] = last
    ctes.append("""tx_after as (select * from fx_transactions_hist union all select * from fx_transactions s
  where not exists (select 1 from fx_transactions_hist t where t.trans_id = s.trans_id))""")
    ctes.append("""bl_after as (select * from fx_blacklist_hist union all select * from fx_blacklist_src s
  where not exists (select 1 from fx_blacklist_hist t where t.passport_num = s.passport_num))""")
    keyed = profile == "keyed"
    enrich = q_fraud.state_enrich_sql(names["terminals"], "tx_after", names["cards"],
                                      names["accounts"], names["clients"], "bl_after",
                                      q_fraud.ENRICH_ASOF_SQL if keyed else q_fraud.ENRICH_SQL)
    report = q_fraud._report_sql(enrich, "60 minute" if keyed else "60 day")
    return "with " + ",\n".join(ctes) + ",\n" + report[len("with "):].lstrip()


@register("run_publish", _after_run_sql())
def run_publish(fx):
    """E1-E3 + SNK-3: one daily run over the seeded state; the published report."""
    root = scratch(fx.spark, "warehouse")
    seed_state(fx, root)
    run_day(fx.spark, root, "1", day_inputs(fx), RUN_TS, work_dir=f"{root}/_work")
    return read_table(fx.spark, root, "rep_fraud")


@register("run_publish_keyed", _after_run_sql("keyed"))
def run_publish_keyed(fx):
    """E1-E3 in the keyed profile: SCD2 by key, as-of report, 60-minute city hop."""
    root = scratch(fx.spark, "warehouse")
    seed_state(fx, root)
    run_day(fx.spark, root, "1", day_inputs(fx), RUN_TS, profile="keyed", max_gap="60 minutes",
            work_dir=f"{root}/_work")
    return read_table(fx.spark, root, "rep_fraud")


@register("run_rerun", _after_run_sql())
def run_rerun(fx):
    """SNK-2/3: the same business date run twice publishes what one run does."""
    root = scratch(fx.spark, "warehouse")
    seed_state(fx, root)
    for _ in range(2):
        run_day(fx.spark, root, "1", day_inputs(fx), RUN_TS, work_dir=f"{root}/_work")
    return read_table(fx.spark, root, "rep_fraud")


@register("run_rerun_keyed", _after_run_sql("keyed"))
def run_rerun_keyed(fx):
    """SNK-2/3, keyed profile: the same business date run twice publishes what one run does."""
    root = scratch(fx.spark, "warehouse")
    seed_state(fx, root)
    for _ in range(2):
        run_day(fx.spark, root, "1", day_inputs(fx), RUN_TS, profile="keyed", max_gap="60 minutes",
                work_dir=f"{root}/_work")
    return read_table(fx.spark, root, "rep_fraud")


# Run times of the three days: each after its last operation.
_DAYS = ("2024-01-11 03:36:00", "2024-01-21 03:36:00", "2024-01-31 03:36:00")


def _three_days_sql() -> str:
    """Keyed versions day after day, each day's operations with the versions of that day, then one
    sequence over all of them: an operation is reported on its own day by rules 1 and 2, on the day of the next one by rule 3."""
    ctes, hist, bl = [], {d: f"fx_{d}_hist" for d in S.DIMS}, "(select * from fx_blacklist_hist)"
    for n, run_at in enumerate(_DAYS, 1):
        wm = "fx_meta" if n == 1 else f"(select 'wh' table_db, 'transactions' table_name, (select max(trans_date) from d{n - 1}_transactions) last_update_dt)"
        for d in S.DIMS:
            body, last = q_scd.prefixed(q_scd.keyed_sql(d, "flag_deleted"), f"{d[:3]}{n}_")
            body = (body.replace(f"fx_{d}_src", f"d{n}_{d}_src").replace(f"fx_{d}_hist", hist[d]).replace(q_scd.RUN, f"timestamp '{run_at}'")
                    .replace("from fx_transactions)", f"from d{n}_transactions)").replace("from fx_meta", f"from {wm} m"))
            ctes.append(body)
            hist[d] = last
        ctes.append(f"""bl{n} as (select * from {bl} union all select * from d{n}_blacklist_src s
  where not exists (select 1 from {bl} t where t.passport_num = s.passport_num))""")
        bl = f"bl{n}"
        ctes.append(q_fraud.state_enrich_sql(hist["terminals"], f"d{n}_transactions", hist["cards"], hist["accounts"],
                                             hist["clients"], bl, q_fraud.ENRICH_ASOF_SQL).strip().replace("enriched as", f"rows{n} as", 1))
    ctes.append("every as (" + " union all ".join(f"select {n} as d, * from rows{n}" for n in (1, 2, 3)) + ")")
    ctes.append(f"""seq as (select e.*, lead(d) over w next_d, lead(terminal_city) over w next_city, lead(trans_date) over w next_date
  from every e window w as (partition by card_num order by {q_fraud.ORDER_SQL}))""")
    ctes.append("""typed as (select s.*, case when passport_valid_to < trans_date or blacklisted then 1 when deleted_flg = 1 then 2
  when next_city <> terminal_city and next_date < trans_date + interval 60 minute then 3 else 0 end event_type from seq s)""")
    ctes.append("reported as (select t.*, case when event_type = 3 then next_d else d end rd from typed t where event_type > 0)")
    ctes.append("last_seen as (select r.rd, e.passport_num, max(e.trans_date) event_dt from (values (1), (2), (3)) r(rd) join every e on e.d <= r.rd group by all)")
    ctes.append("days as (" + " union all ".join(f"select {n} as rd, max(trans_date) report_dt from d{n}_transactions" for n in (1, 2, 3)) + ")")
    return "with " + ",\n".join(ctes) + """
select distinct l.event_dt, r.passport_num passport,
       coalesce(last_name, '') || ' ' || coalesce(first_name, '') || ' ' || coalesce(patronymic, '') fio, phone, event_type, days.report_dt
from reported r join last_seen l on l.rd = r.rd and l.passport_num is not distinct from r.passport_num join days on days.rd = r.rd"""


@register("run_three_days_keyed", _three_days_sql())
def run_three_days_keyed(fx):
    """E1-E3, keyed, three days in a row: entities vanish and come back, some keys are staged twice,
    each day reports its own rows from the state that the day before left."""
    root = scratch(fx.spark, "warehouse")
    run = Run(fx.spark, root, "0")
    for d in S.DIMS:
        run.replace(f"hist_{d}", fx[f"fx_{d}_hist"])
    run.replace("meta", fx["fx_meta"])
    run.append("fact_blacklist", fx["fx_blacklist_hist"])
    run.commit()
    for n, run_at in enumerate(_DAYS, 1):
        inputs = DayInputs(**{name: fx[f"d{n}_{name}_src"] for name in ("clients", "accounts", "cards", "terminals", "blacklist")},
                           transactions=fx[f"d{n}_transactions"])
        run_day(fx.spark, root, str(n), inputs, run_at, profile="keyed", max_gap="60 minutes", report_scope="day", work_dir=f"{root}/_work")
    return read_table(fx.spark, root, "rep_fraud")


_SEEDED = {"hist_clients": "fx_clients_hist", "hist_accounts": "fx_accounts_hist", "hist_cards": "fx_cards_hist",
           "hist_terminals": "fx_terminals_hist", "fact_transactions": "fx_transactions_hist",
           "fact_blacklist": "fx_blacklist_hist", "meta": "fx_meta"}


@register("run_reset", "\nunion all\n".join(
    f"select '{n}' table_name, " + (f"(select count(*) from {_SEEDED[n]})" if n in _SEEDED else "cast(0 as bigint)") + " n_before, "
    + ("(select count(*) from fx_meta)" if n == "meta" else "cast(0 as bigint)") + " n_after" for n in S.WAREHOUSE_TABLES))
def run_reset(fx):
    """SNK-4: rows of every table before and after the reset; only the watermark (and the ledger of files) stays."""
    root = scratch(fx.spark, "warehouse")
    seed_state(fx, root)

    def counts(name):
        parts = [read_table(fx.spark, root, n).agg(F.count(F.lit(1)).alias(name)).select(F.lit(n).alias("table_name"), name) for n in S.WAREHOUSE_TABLES]
        return reduce(DataFrame.unionByName, parts)

    before = counts("n_before")      # its paths are those of the state before
    reset(fx.spark, root, "reset")
    return before.join(counts("n_after"), "table_name")
