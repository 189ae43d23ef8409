"""Warehouse-shaped views derived from the driver's Parquet tables.

One SQL text per view serves both engines: Spark runs it through
``spark.sql`` with the base tables passed as DataFrames, and the DuckDB
oracle gets the same bodies as CTEs. ``{TS}`` is the zone-free timestamp
type name of the engine (``timestamp_ntz`` in Spark, ``timestamp`` in
DuckDB). All views grow with the scale factor of the input tables.

``*_src`` = what the operational source shows today, ``*_hist`` = the
warehouse state before today's run.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Literal run time of the simulated daily run (replaces the wall clock).
RUN_TS = "2024-01-31 03:36:00"
META_DB, META_TABLE = "wh", "transactions"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

VIEWS: dict[str, str] = {
    "fx_transactions": """
select cast(event_id as string) trans_id, ts trans_date, cast(value as decimal(10,2)) amt,
       'C' || cast(user_id as string) card_num, event_type oper_type,
       case when event_type = 'error' then 'REJECT' else 'SUCCESS' end oper_result,
       'T' || cast(event_id % (select count(*) from {supplier}) as string) terminal
from {events}""",
    "fx_transactions_hist": """
select * from {fx_transactions} where cast(trans_id as bigint) % 4 <> 0""",
    "fx_terminals_src": """
select 'T' || cast(s_suppkey as string) terminal_id,
       case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end terminal_type,
       n_name terminal_city, s_name terminal_address
from {supplier} join {nation} on s_nationkey = n_nationkey
where s_suppkey % 7 <> 6""",
    "fx_terminals_hist": """
select 'T' || cast(s_suppkey as string) terminal_id,
       case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end terminal_type,
       case when s_suppkey % 5 = 3 then 'OLD CITY' else n_name end terminal_city,
       case when s_suppkey % 5 = 4 then 'OLD ' || s_name else s_name end terminal_address,
       0 deleted_flg, {TS} '1900-01-01 00:00:00' effective_from, {TS} '9999-12-31 00:00:00' effective_to
from {supplier} join {nation} on s_nationkey = n_nationkey
where s_suppkey % 8 <> 5""",
    "fx_clients_all": """
select c_custkey k, cast(c_custkey as string) client_id,
       'L' || cast(c_custkey % 40 as string) last_name, c_name first_name,
       case when c_custkey % 10 = 0 then null else 'P' || cast(c_nationkey as string) end patronymic,
       cast('1980-0' || cast(1 + c_custkey % 9 as string) || '-15 00:00:00' as {TS}) date_of_birth,
       'PP' || cast(c_custkey as string) passport_num,
       case when c_custkey % 9 = 4 then null
            else cast('2024-0' || cast(1 + c_custkey % 3 as string) || '-' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || ' 00:00:00' as {TS}) end passport_valid_to,
       '+7' || lpad(cast(c_custkey as string), 10, '0') phone,
       case when c_custkey % 2 = 0 then {TS} '1900-01-01 00:00:00'
            else cast('2023-12-' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || ' 00:00:00' as {TS}) end create_dt,
       case when c_custkey % 5 = 0 then null
            else cast('2024-01-' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || ' 12:00:00' as {TS}) end update_dt
from {customer}""",
    "fx_clients_src": """
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone, create_dt, update_dt
from {fx_clients_all} where k % 29 <> 0""",
    "fx_clients_hist": """
select client_id, case when k % 17 = 0 then 'OLD' || client_id else last_name end last_name,
       case when k % 21 = 0 then 'Former name' else first_name end first_name, patronymic, date_of_birth, passport_num,
       case when k % 31 = 0 then {TS} '2023-06-01 00:00:00' else passport_valid_to end passport_valid_to,
       case when k % 23 = 0 then null when k % 19 = 0 then 'old ' || phone else phone end phone,
       case when k % 8 = 6 then 1 else 0 end deleted_flg,
       create_dt effective_from, {TS} '9999-12-31 00:00:00' effective_to
from {fx_clients_all} where k % 13 <> 0
union all
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, 'closed ' || phone,
       0, {TS} '1899-01-01 00:00:00', {TS} '1899-12-31 00:00:00'
from {fx_clients_all} where k % 37 = 0 and k % 13 <> 0""",
    "fx_accounts_src": """
select 'A' || client_id account,
       case when k % 19 = 5 and k % 13 <> 1 then {TS} '2033-05-01 00:00:00' else cast('2030-0' || cast(1 + k % 9 as string) || '-01 00:00:00' as {TS}) end valid_to,
       client_id client, create_dt, update_dt
from {fx_clients_all} where k % 29 <> 1""",
    "fx_accounts_hist": """
select 'A' || client_id account_num,
       case when k % 17 = 2 then {TS} '2025-01-01 00:00:00' else cast('2030-0' || cast(1 + k % 9 as string) || '-01 00:00:00' as {TS}) end valid_to,
       client_id client, 0 deleted_flg, create_dt effective_from, {TS} '9999-12-31 00:00:00' effective_to
from {fx_clients_all} where k % 13 <> 1""",
    "fx_cards_src": """
select 'C' || client_id card_num, 'A' || client_id account, create_dt, update_dt
from {fx_clients_all} where k % 29 <> 2""",
    "fx_cards_hist": """
select 'C' || client_id card_num, case when k % 17 = 3 then 'A_OLD' else 'A' || client_id end account_num,
       0 deleted_flg, create_dt effective_from, {TS} '9999-12-31 00:00:00' effective_to
from {fx_clients_all} where k % 13 <> 2""",
    # Histories with closed versions, holes and moves, for the as-of joins.
    "fx_terminals_versions": """
select terminal_id, terminal_type, case when moved = 1 and part = 1 then 'EARLIER ' || terminal_city else terminal_city end terminal_city,
       terminal_address, 0 deleted_flg,
       case when part = 1 then {TS} '1900-01-01 00:00:00' else {TS} '2024-01-16 08:00:00' end effective_from,
       case when part = 1 then {TS} '2024-01-16 08:00:00' else {TS} '9999-12-31 00:00:00' end effective_to
from (select *, case when terminal_address like '%2' or terminal_address like '%5' then 1 else 0 end moved from {fx_terminals_hist}) t
cross join (select 1 part union all select 2 part) p""",
    "fx_cards_versions": """
select 'C' || client_id card_num, 'A' || client_id account_num, 0 deleted_flg, create_dt effective_from,
       case when k % 6 = 0 then {TS} '2024-01-12 06:30:00' else {TS} '9999-12-31 00:00:00' end effective_to
from {fx_clients_all} where k % 13 <> 2
union all
select 'C' || client_id, 'A' || cast(k + 1 as string), 0, {TS} '2024-01-12 06:30:00', {TS} '9999-12-31 00:00:00'
from {fx_clients_all} where k % 13 <> 2 and k % 6 = 0""",
    "fx_accounts_versions": """
select 'A' || client_id account_num, {TS} '2030-01-01 00:00:00' valid_to, client_id client, 0 deleted_flg, create_dt effective_from,
       case when k % 5 = 0 then {TS} '2024-01-15 00:00:00' when k % 23 = 1 then create_dt else {TS} '9999-12-31 00:00:00' end effective_to
from {fx_clients_all} where k % 13 <> 1
union all
select 'A' || client_id, {TS} '2031-01-01 00:00:00', cast(k + 2 as string), 0, {TS} '2024-01-15 00:00:00', {TS} '9999-12-31 00:00:00'
from {fx_clients_all} where k % 13 <> 1 and k % 5 = 0""",
    "fx_clients_versions": """
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone,
       case when k % 8 = 6 then 1 else 0 end deleted_flg, create_dt effective_from,
       case when k % 4 = 1 then {TS} '2024-01-18 00:00:00' when k % 9 = 2 then {TS} '2024-01-05 00:00:00' else {TS} '9999-12-31 00:00:00' end effective_to
from {fx_clients_all} where k % 14 <> 0
union all
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, 'new ' || phone,
       case when k % 8 = 5 then 1 else 0 end, case when k % 4 = 1 then {TS} '2024-01-18 00:00:00' else {TS} '2024-01-20 00:00:00' end, {TS} '9999-12-31 00:00:00'
from {fx_clients_all} where k % 14 <> 0 and (k % 4 = 1 or k % 9 = 2)""",
    "fx_blacklist_src": """
select create_dt entry_dt, passport_num from {fx_clients_all} where k % 11 = 0""",
    "fx_blacklist_hist": """
select create_dt entry_dt, passport_num from {fx_clients_all} where k % 22 = 0""",
    # Three days of sources: entities vanish on day 2 and come back on day 3, attributes move, day 3 stages some keys twice.
    "d1_clients_src": """select * from {fx_clients_src}""",
    "d2_clients_src": """
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to,
       case when k % 11 = 3 then 'second ' || phone else phone end phone, create_dt,
       case when k % 11 = 3 then {TS} '2024-01-15 12:00:00' else update_dt end update_dt
from {fx_clients_all} where k % 29 <> 0 and k % 31 <> 5""",
    "d3_clients_src": """
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to,
       case when k % 11 = 3 then 'second ' || phone else phone end phone, create_dt,
       case when k % 31 = 5 then {TS} '2024-01-25 10:00:00' when k % 11 = 3 then {TS} '2024-01-15 12:00:00' else update_dt end update_dt
from {fx_clients_all} where k % 29 <> 0
union all
select client_id, last_name, first_name, patronymic, date_of_birth, passport_num, {TS} '2024-01-22 00:00:00', 'third ' || phone, create_dt, {TS} '2024-01-26 00:00:00'
from {fx_clients_all} where k % 29 <> 0 and k % 10 = 7""",
    "d1_accounts_src": """select * from {fx_accounts_src}""",
    "d2_accounts_src": """select * from {fx_accounts_src} where client not like '%17'""",
    "d3_accounts_src": """
select account, valid_to, client, create_dt, case when client like '%17' then {TS} '2024-01-27 00:00:00' else update_dt end update_dt
from {fx_accounts_src}""",
    "d1_cards_src": """select * from {fx_cards_src} where card_num not like '%9'""",
    "d2_cards_src": """select * from {fx_cards_src}""",
    "d3_cards_src": """
select card_num, case when card_num like '%8' then 'A1' else account end account, create_dt,
       case when card_num like '%8' then {TS} '2024-01-28 00:00:00' else update_dt end update_dt
from {fx_cards_src}""",
    "d1_terminals_src": """select * from {fx_terminals_src}""",
    "d2_terminals_src": """
select terminal_id, terminal_type, case when terminal_id like '%4' then 'MOVED' else terminal_city end terminal_city, terminal_address
from {fx_terminals_src} where terminal_id not like '%3'""",
    "d3_terminals_src": """select * from {fx_terminals_src}""",
    "d1_blacklist_src": """select entry_dt, passport_num from {fx_blacklist_src} where passport_num like '%1'""",
    "d2_blacklist_src": """select entry_dt, passport_num from {fx_blacklist_src} where passport_num like '%1' or passport_num like '%2'""",
    "d3_blacklist_src": """select entry_dt, passport_num from {fx_blacklist_src}""",
    "d1_transactions": """select * from {fx_transactions} where trans_date < {TS} '2024-01-11 00:00:00'""",
    "d2_transactions": """
select * from {fx_transactions} where trans_date >= {TS} '2024-01-11 00:00:00' and trans_date < {TS} '2024-01-21 00:00:00'""",
    "d3_transactions": """select * from {fx_transactions} where trans_date >= {TS} '2024-01-21 00:00:00'""",
    # The watermark table of the warehouse: one control row (db, table, time), nine days after the first event.
    "fx_meta": """
select 'wh' table_db, 'transactions' table_name, cast(cast(min(ts) as date) + interval 9 day as {TS}) last_update_dt from {events}""",
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return [r for r in _REF.findall(VIEWS[name]) if r != "TS"]


def _closure(names) -> list[str]:
    """Fixture views needed by ``names`` in dependency order."""
    out: list[str] = []

    def visit(n):
        if n in VIEWS and n not in out:
            for d in deps(n):
                visit(d)
            out.append(n)
    for n in names:
        visit(n)
    return out


def duck_body(name: str) -> str:
    return _REF.sub(lambda m: "timestamp" if m.group(1) == "TS" else m.group(1), VIEWS[name])


def with_fixtures(sql: str, names=None) -> str:
    """Prefix ``sql`` (DuckDB dialect) with CTEs for every fixture it names."""
    if names is None:
        names = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    need = _closure(names)
    if not need:
        return sql
    ctes = ",\n".join(f"{n} as ({duck_body(n)}\n)" for n in need)
    body = sql.strip()
    if body[:4].lower() == "with":
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name not in VIEWS:
            return self.table(name)
        text = VIEWS[name].replace("{TS}", "timestamp_ntz")
        frames = {d: self[d] for d in deps(name)}
        df = self.spark.sql(text, **frames)
        self._cache[name] = df
        return df
