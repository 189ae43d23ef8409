"""Change-capture and fact queries (CDC-1..6, FCT-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.catalog import register
from cardwatch.fixtures import META_DB, META_TABLE
from cardwatch.operators import cdc, facts
from cardwatch.plans.inputs import staged

RUN = "timestamp '2024-01-31 03:36:00'"
LO = "timestamp '1900-01-01 00:00:00'"
WM = (f"(select coalesce(last_update_dt, {LO}) from fx_meta "
      f"where table_db = '{META_DB}' and table_name = '{META_TABLE}')")

CAPTURE_SQL = {
    "clients": f"""select client_id, last_name, first_name, patronymic, date_of_birth, passport_num,
       passport_valid_to, phone, create_dt, {RUN} update_dt
from fx_clients_src
where update_dt > {WM}
   or create_dt = {LO} and client_id not in (select client_id from fx_clients_hist)""",
    "accounts": f"""select account account_num, valid_to, client, create_dt, {RUN} update_dt
from fx_accounts_src
where update_dt > {WM}
   or create_dt = {LO} and account not in (select account_num from fx_accounts_hist)""",
    "cards": f"""select card_num, account account_num, create_dt, {RUN} update_dt
from fx_cards_src
where update_dt > {WM}
   or create_dt = {LO} and card_num not in (select card_num from fx_cards_hist)""",
}

KEYS_SQL = {
    "clients": "select client_id from fx_clients_src",
    "accounts": "select account account_num from fx_accounts_src",
    "cards": "select card_num from fx_cards_src",
    "terminals": "select terminal_id from fx_terminals_src",
}


def _capture_query(dim_name):
    def q(fx):
        return staged(fx, dim_name)[1]
    q.__doc__ = f"CDC-2..4: staged {dim_name} (updated after the watermark, or unseen seed rows)."
    return q


for _d in ("clients", "accounts", "cards"):
    register(f"cdc_capture_{_d}", CAPTURE_SQL[_d])(_capture_query(_d))


@register("cdc_watermark_cases", f"""
select 'date' meta_case, (select coalesce(last_update_dt, {LO}) from fx_meta
                          where table_db = 'wh' and table_name = 'transactions') watermark
union all
select 'null_date', (select coalesce(last_update_dt, {LO}) from
                     (select table_db, table_name, cast(null as timestamp) last_update_dt from fx_meta) m
                     where table_db = 'wh' and table_name = 'transactions')
union all
select 'no_row', (select coalesce(last_update_dt, {LO}) from fx_meta
                  where table_db = 'wh' and table_name = 'no such table')
union all
select 'after_load', (select max(trans_date) from fx_transactions_hist)""")
def cdc_watermark_cases(fx):
    """CDC-1: watermark with a dated row, a NULL-dated row, no row, and the row that the
    loaded facts leave behind."""
    meta = fx["fx_meta"]
    null_meta = meta.withColumn("last_update_dt", F.lit(None).cast("timestamp_ntz"))
    return (cdc.watermark(meta, "wh", "transactions").select(F.lit("date").alias("meta_case"), "watermark")
            .unionByName(cdc.watermark(null_meta, "wh", "transactions")
                         .select(F.lit("null_date").alias("meta_case"), "watermark"))
            .unionByName(cdc.watermark(meta, "wh", "no such table")
                         .select(F.lit("no_row").alias("meta_case"), "watermark"))
            .unionByName(cdc.watermark(cdc.advance_watermark(meta, fx["fx_transactions_hist"], "wh", "transactions"),
                                       "wh", "transactions")
                         .select(F.lit("after_load").alias("meta_case"), "watermark")))


@register("cdc_key_snapshot", """
select 'clients' dim, client_id entity_key from fx_clients_src
union all select 'accounts', account from fx_accounts_src
union all select 'cards', card_num from fx_cards_src
union all select 'terminals', terminal_id from fx_terminals_src""")
def cdc_key_snapshot(fx):
    """CDC-5: every key present in each source right now."""
    out = None
    for d in ("clients", "accounts", "cards", "terminals"):
        keys = staged(fx, d)[2]
        part = keys.select(F.lit(d).alias("dim"), F.col(keys.columns[0]).alias("entity_key"))
        out = part if out is None else out.unionByName(part)
    return out


@register("cdc_advance_watermark", """
select table_db, table_name,
       case when table_db = 'wh' and table_name = 'transactions'
                 and (select max(trans_date) from fx_transactions) is not null
            then (select max(trans_date) from fx_transactions) else last_update_dt end last_update_dt
from fx_meta""")
def cdc_advance_watermark(fx):
    """CDC-6: watermark moved to the day's latest operation (update only)."""
    return cdc.advance_watermark(fx["fx_meta"], fx["fx_transactions"], META_DB, META_TABLE)


@register("fct_insert_transactions", """
select * from fx_transactions_hist
union all
select * from fx_transactions s
where not exists (select 1 from fx_transactions_hist t where t.trans_id = s.trans_id)""")
def fct_insert_transactions(fx):
    """FCT-1: transactions appended by business key trans_id."""
    return facts.insert_fact(fx["fx_transactions_hist"], fx["fx_transactions"], "trans_id")


@register("fct_insert_blacklist", """
select * from fx_blacklist_hist
union all
select * from fx_blacklist_src s
where not exists (select 1 from fx_blacklist_hist t where t.passport_num = s.passport_num)""")
def fct_insert_blacklist(fx):
    """FCT-1: blacklist entries appended by passport number."""
    return facts.insert_fact(fx["fx_blacklist_hist"], fx["fx_blacklist_src"], "passport_num")
