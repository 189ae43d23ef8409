"""Table schemas and sentinel dates.

Dates of the warehouse carry a time of day and no zone, so every date
column is ``TimestampNTZType``. Flags are stored as integers; fixed-width
card/account numbers are stored as trimmed strings.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open end of a version and the "beginning of time".
HIGH_DATE = _dt.datetime(9999, 12, 31)
LOW_DATE = _dt.datetime(1900, 1, 1)

S = T.StringType()
TS = T.TimestampNTZType()
I = T.IntegerType()
AMT = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCD_TAIL = (("deleted_flg", I), ("effective_from", TS), ("effective_to", TS))

CLIENT_ATTRS = ("last_name", "first_name", "patronymic", "date_of_birth",
                "passport_num", "passport_valid_to", "phone")
ACCOUNT_ATTRS = ("valid_to", "client")
CARD_ATTRS = ("account_num",)
TERMINAL_ATTRS = ("terminal_type", "terminal_city", "terminal_address")

HIST_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", TS), ("passport_num", S), ("passport_valid_to", TS),
    ("phone", S), *SCD_TAIL)
HIST_ACCOUNTS = _struct(("account_num", S), ("valid_to", TS), ("client", S), *SCD_TAIL)
HIST_CARDS = _struct(("card_num", S), ("account_num", S), *SCD_TAIL)
HIST_TERMINALS = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
    ("terminal_address", S), *SCD_TAIL)

FACT_BLACKLIST = _struct(("entry_dt", TS), ("passport_num", S))
FACT_TRANSACTIONS = _struct(
    ("trans_id", S), ("trans_date", TS), ("amt", AMT), ("card_num", S),
    ("oper_type", S), ("oper_result", S), ("terminal", S))

STG_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", TS), ("passport_num", S), ("passport_valid_to", TS),
    ("phone", S), ("create_dt", TS), ("update_dt", TS))
STG_ACCOUNTS = _struct(("account_num", S), ("valid_to", TS), ("client", S),
                       ("create_dt", TS), ("update_dt", TS))
STG_CARDS = _struct(("card_num", S), ("account_num", S), ("create_dt", TS), ("update_dt", TS))
STG_TERMINALS = _struct(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                        ("terminal_address", S))
STG_BLACKLIST = FACT_BLACKLIST
STG_TRANSACTIONS = FACT_TRANSACTIONS

META = _struct(("table_db", S), ("table_name", S), ("last_update_dt", TS))
REP_FRAUD = _struct(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
                    ("event_type", I), ("report_dt", TS))

# What a day's report needs of the days before: the last operation of each card, the last time of each passport.
CARRY_CARDS = _struct(("card_num", S), ("trans_id", S), ("trans_date", TS), ("terminal_city", S), ("tm_effective_from", TS),
                      ("c_effective_from", TS), ("passport_num", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                      ("phone", S), ("passport_valid_to", TS), ("deleted_flg", I), ("event_type", I))
CARRY_PASSPORTS = _struct(("passport_num", S), ("event_dt", TS))

# Ledger of the files whose rows are in the facts: one row a file, written in the run that loads it.
LOADED_FILES = _struct(("file_name", S), ("file_size", T.LongType()), ("day", S), ("run_id", S))

# Source tables as the operational system exposes them (column names as read).
SRC_CLIENTS = STG_CLIENTS
SRC_ACCOUNTS = _struct(("account", S), ("valid_to", TS), ("client", S),
                       ("create_dt", TS), ("update_dt", TS))
SRC_CARDS = _struct(("card_num", S), ("account", S), ("create_dt", TS), ("update_dt", TS))


# Per-dimension description used by the SCD operators.
class Dim:
    def __init__(self, name: str, key: str, attrs: tuple[str, ...], schema: T.StructType):
        self.name, self.key, self.attrs, self.schema = name, key, attrs, schema

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attrs]


CLIENTS = Dim("clients", "client_id", CLIENT_ATTRS, HIST_CLIENTS)
ACCOUNTS = Dim("accounts", "account_num", ACCOUNT_ATTRS, HIST_ACCOUNTS)
CARDS = Dim("cards", "card_num", CARD_ATTRS, HIST_CARDS)
TERMINALS = Dim("terminals", "terminal_id", TERMINAL_ATTRS, HIST_TERMINALS)
DIMS = {d.name: d for d in (CLIENTS, ACCOUNTS, CARDS, TERMINALS)}

WAREHOUSE_TABLES = {
    "hist_clients": HIST_CLIENTS, "hist_accounts": HIST_ACCOUNTS,
    "hist_cards": HIST_CARDS, "hist_terminals": HIST_TERMINALS,
    "fact_blacklist": FACT_BLACKLIST, "fact_transactions": FACT_TRANSACTIONS,
    "rep_fraud": REP_FRAUD, "meta": META,
    "carry_cards": CARRY_CARDS, "carry_passports": CARRY_PASSPORTS, "loaded_files": LOADED_FILES,
}


def ts_lit(value: _dt.datetime | str) -> Column:
    """A zone-free timestamp literal, independent of the session's timestampType."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    # Cast from text: no session time zone is involved on the way.
    return F.lit(value).cast(TS)


def high() -> Column:
    return ts_lit(HIGH_DATE)


def low() -> Column:
    return ts_lit(LOW_DATE)


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns by name and cast to its types.

    One ``selectExpr`` call (text parsed in the JVM) instead of a Column
    object per field: the same plan with far fewer driver round trips.
    """
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])


def empty(spark, schema: T.StructType):
    return spark.createDataFrame([], schema)
