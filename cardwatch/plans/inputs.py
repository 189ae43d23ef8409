"""The day's inputs for each dimension, built from the fixture views.

Bank dimensions are captured from their source with the watermark of
``fx_meta``; terminals come from the day's file, whose latest operation
time (``fx_transactions``) is their clock.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.fixtures import META_DB, META_TABLE, RUN_TS
from cardwatch.operators import cdc
from cardwatch.plans.state import materializer

# Staging column <- source column, per bank dimension.
CAPTURE = {
    "clients": ("fx_clients_src", "fx_clients_hist", "client_id", "client_id",
                {c: c for c in S.STG_CLIENTS.fieldNames()}),
    "accounts": ("fx_accounts_src", "fx_accounts_hist", "account_num", "account",
                 {"account_num": "account", "valid_to": "valid_to", "client": "client",
                  "create_dt": "create_dt", "update_dt": "update_dt"}),
    "cards": ("fx_cards_src", "fx_cards_hist", "card_num", "card_num",
              {"card_num": "card_num", "account_num": "account", "create_dt": "create_dt",
               "update_dt": "update_dt"}),
}


def run_ts():
    return S.ts_lit(RUN_TS)


def stored_history(fx, name: str):
    """The history as the warehouse holds it: a stored table, not a view.

    A run reads its history from storage; the fixture view is written out
    once (checkpoint) so the plan starts from a stored relation as well.
    (It also sidesteps a Spark 4.1 optimizer failure when a union's first
    child is an aliasing projection of a view.)
    """
    key = f"_stored_{name}"
    if key not in fx._cache:
        fx._cache[key] = materializer(fx.spark)(fx[name])
    return fx._cache[key]


def staged(fx, dim_name: str):
    """(history before the run, staged rows, key snapshot, day scalars) of a dimension."""
    if dim_name == "terminals":
        stg = fx["fx_terminals_src"]
        return (stored_history(fx, "fx_terminals_hist"), stg, stg.select("terminal_id"),
                cdc.day_max(fx["fx_transactions"]))
    src_name, hist_name, key, src_key, columns = CAPTURE[dim_name]
    src, hist = fx[src_name], stored_history(fx, hist_name)
    wm = cdc.watermark(fx["fx_meta"], META_DB, META_TABLE)
    stg = cdc.capture_incremental(src, wm, hist, key, columns, run_ts(), src_key=src_key)
    # the staging table (SNK-1): written once, read by every step of the day
    return hist, materializer(fx.spark)(stg), cdc.key_snapshot(src, src_key, key), None

