"""The daily run (E1 bank dimensions, E2 daily files, E3 report + watermark).

``run_day`` reads the published state, applies every step of the day
as DataFrame transformations, writes each changed table once (facts and
report as appended parts) and switches the state pointer last: a failed
run publishes nothing, and the day's files may be archived only after
``commit`` returns.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardwatch import schemas as S
from cardwatch.operators import cdc, facts, fraud, scd2
from cardwatch.plans.state import Run, materializer
from cardwatch.sources.files import conform_bank

# Staging column <- source column of the bank tables.
BANK_CAPTURE = {
    "clients": ("client_id", "client_id", {c: c for c in S.STG_CLIENTS.fieldNames()}),
    "accounts": ("account_num", "account",
                 {"account_num": "account", "valid_to": "valid_to", "client": "client",
                  "create_dt": "create_dt", "update_dt": "update_dt"}),
    "cards": ("card_num", "card_num",
              {"card_num": "card_num", "account_num": "account", "create_dt": "create_dt",
               "update_dt": "update_dt"}),
}


@dataclass
class DayInputs:
    clients: DataFrame        # source tables as read (SRC-1 shape)
    accounts: DataFrame
    cards: DataFrame
    terminals: DataFrame      # the day's files in staging shape (SRC-2..4)
    blacklist: DataFrame
    transactions: DataFrame


def run_day(spark: SparkSession, root: str, run_id: str, inputs: DayInputs, run_ts: str,
            profile: str = "reference", max_gap: str = "60 days", meta_db: str = "wh",
            meta_table: str = "transactions", work_dir: str | None = None,
            parallel: int | None = None, report_scope: str = "all",
            files: list[tuple[str, int, str]] = (), capture: str = "watermark", overlap: str = "1 hour") -> dict:
    """One business day over the published state.

    ``report_scope``: "all" reports all history again (as the reference does);
    "day" (keyed profile) reports the day's operations and what they decide about
    earlier ones, from carried state (:func:`fraud.day_report`). ``files``:
    (name, size, day) of the files that the inputs come from, for the ledger.
    ``capture``: "watermark" compares the bank tables with the last operation's time
    (as the reference does); "cursor" (keyed profile) keeps a cursor of its own for
    each, with ``overlap`` for late commits (:func:`cdc.capture_since`).
    """
    if capture not in ("watermark", "cursor") or (capture == "cursor" and profile != "keyed"):
        raise ValueError("capture is watermark, or cursor with profile='keyed'")
    if report_scope not in ("all", "day"):
        raise ValueError(f"unknown report scope {report_scope!r}")
    if report_scope == "day" and profile != "keyed":
        raise ValueError("a day's report needs versions valid at the operation: profile='keyed'")
    run = Run(spark, root, run_id, profile)
    mat = materializer(spark, work_dir)
    now = S.ts_lit(run_ts)
    out: dict[str, DataFrame] = {}
    cursors: dict[tuple[str, str], DataFrame] = {}

    earlier = run.table("fact_transactions")
    meta = run.table("meta")
    wm = cdc.watermark(meta, meta_db, meta_table)      # 1 row, cheap to recompute
    stg_tx = mat(S.conform(inputs.transactions, S.STG_TRANSACTIONS))

    # E1: capture and version a bank dimension
    def bank(name):
        key, src_key, columns = BANK_CAPTURE[name]
        # read the source once: capture, key snapshot and history see the same rows
        src = mat(conform_bank(getattr(inputs, name), name))
        hist = run.table(f"hist_{name}")
        if capture == "cursor":
            stg, at = cdc.capture_since(src, cdc.cursor(meta, "bank", name), overlap, hist, key, S.DIMS[name].attrs, columns, now, src_key=src_key)
            stg, cursors["bank", name] = mat(stg), at
        else:
            stg = mat(cdc.capture_incremental(src, wm, hist, key, columns, now, src_key=src_key))
        keys = cdc.key_snapshot(src, src_key, key)
        new = scd2.apply_day(hist, stg, keys, S.DIMS[name], now, None, profile, materialize=mat)
        return f"hist_{name}", run.replace(f"hist_{name}", new)

    # E2: the day's files
    def terminals():
        stg_tm = mat(S.conform(inputs.terminals, S.STG_TERMINALS))
        new_tm = scd2.apply_day(run.table("hist_terminals"), stg_tm, stg_tm.select("terminal_id"),
                                S.TERMINALS, now, cdc.day_max(stg_tx), profile, materialize=mat)
        return "hist_terminals", run.replace("hist_terminals", new_tm)

    def blacklist():
        stg_bl = mat(S.conform(inputs.blacklist, S.STG_BLACKLIST))
        new = facts.new_facts(run.table("fact_blacklist"), stg_bl, "passport_num")
        return "fact_blacklist", run.append("fact_blacklist", new)

    def transactions():
        new = facts.new_facts(run.table("fact_transactions"), stg_tx, "trans_id")
        return "fact_transactions", run.append("fact_transactions", new)

    # The tables are independent until the report: their jobs run concurrently
    # (one driver thread each; Spark schedules the jobs side by side), which
    # keeps executors busy through the many small delta-sized steps.
    steps = [lambda n=n: bank(n) for n in BANK_CAPTURE] + [terminals, blacklist, transactions]
    with ThreadPoolExecutor(max_workers=parallel or len(steps)) as pool:
        for name, df in pool.map(lambda f: f(), steps):
            out[name] = df

    # E3: the report over the new state, then the watermark
    dims = [out["hist_cards"], out["hist_accounts"], out["hist_clients"], out["fact_blacklist"]]
    if report_scope == "day":
        if run.holds("carry_cards"):
            carry = run.table("carry_cards"), run.table("carry_passports")
        else:       # the first report of this kind: earlier operations are read once
            carry = fraud.carry_from_history(out["hist_terminals"], earlier, *dims, mat)
        report, cards, passports = fraud.day_report(
            out["hist_terminals"], run.appended("fact_transactions"), *dims, stg_tx, *carry, max_gap=max_gap, materialize=mat)
        out["carry_cards"] = run.replace("carry_cards", cards)
        out["carry_passports"] = run.replace("carry_passports", passports)
    else:
        report = fraud.fraud_report(out["hist_terminals"], out["fact_transactions"], *dims,
                                    stg_tx, max_gap=max_gap, as_of=(profile == "keyed"), materialize=mat)
        run.forget("carry_cards", "carry_passports")    # they would miss this run's operations
    out["rep_fraud"] = run.append("rep_fraud", report)
    if files:
        run.record_files(list(files))
    out["meta"] = run.replace("meta", cdc.advance_cursors(cdc.advance_watermark(meta, stg_tx, meta_db, meta_table), cursors))
    state = run.commit()
    return {"state": state, "tables": out}
