"""Source queries: fixture rows written in the daily file formats and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardwatch.catalog import register
from cardwatch.plans.job import load_transaction_days
from cardwatch.plans.state import publish, read_table
from cardwatch.session import checkpoint_dir
from cardwatch.sources import files, xlsx
from cardwatch.streaming.daily_files import load_transactions_stream


TX_SECONDS = ("select trans_id, date_trunc('second', trans_date) trans_date, amt, card_num, "
              "oper_type, oper_result, terminal from {src}")


def scratch(spark, what: str) -> str:
    """A fresh folder name below the session's checkpoint folder, on whatever storage that is."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cardwatch-{what}-{uuid.uuid4().hex[:12]}"


def _tx_text(df, bad=None):
    """Transactions as the daily file's text columns (optionally a broken date)."""
    date = F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss")
    if bad is not None:
        date = F.when(bad, F.lit("31.02.2024 25:61")).otherwise(date)
    return df.select("trans_id", date.alias("transaction_date"),
                     F.regexp_replace(F.col("amt").cast("string"), r"\.", ",").alias("amount"),
                     "card_num", "oper_type", "oper_result", "terminal")


# The file carries times to the second (as the warehouse DATE type does).
@register("src_transactions_csv", TX_SECONDS.format(src="fx_transactions"))
def src_transactions_csv(fx):
    """SRC-4: ';'-separated text with decimal comma, read back to the staging schema."""
    path = scratch(fx.spark, "tx") + "/transactions_31012024.txt"
    _tx_text(fx["fx_transactions"]).write.option("sep", ";").option("header", True).csv(path)
    return files.read_transactions(fx.spark, path)


@register("src_bad_rows", TX_SECONDS.format(src="fx_transactions") + " where cast(trans_id as bigint) % 50 <> 0")
def src_bad_rows(fx):
    """SRC-7: rows with an unreadable time go to quarantine; the rest load."""
    tx = fx["fx_transactions"]
    path = scratch(fx.spark, "badtx") + "/transactions_31012024.txt"
    (_tx_text(tx, F.col("trans_id").cast("bigint") % 50 == 0)
     .write.option("sep", ";").option("header", True).csv(path))
    good, _bad = files.read_transactions(fx.spark, path, bad_rows="quarantine")
    return good


@register("src_bad_rows_quarantined", "select trans_id, 'transaction_date' reason from fx_transactions where cast(trans_id as bigint) % 50 = 0")
def src_bad_rows_quarantined(fx):
    """SRC-7, the other side: the raw lines of the rows that do not load."""
    path = scratch(fx.spark, "badtx") + "/transactions_31012024.txt"
    (_tx_text(fx["fx_transactions"], F.col("trans_id").cast("bigint") % 50 == 0)
     .write.option("sep", ";").option("header", True).csv(path))
    _good, bad = files.read_transactions(fx.spark, path, bad_rows="quarantine")
    return bad.select(F.split("raw_line", ";")[0].alias("trans_id"), "reason")


@register("src_terminals_xlsx", "select * from fx_terminals_src")
def src_terminals_xlsx(fx):
    """SRC-2: terminals written as workbooks (sheet 'terminals'), read back by position."""
    folder = scratch(fx.spark, "xlsx-terminals")
    xlsx.write_sheets(fx["fx_terminals_src"], folder, "terminals", rows_per_book=200)
    return xlsx.read_terminals(fx.spark, folder)


@register("src_blacklist_xlsx", "select entry_dt, passport_num from fx_blacklist_src")
def src_blacklist_xlsx(fx):
    """SRC-3: blacklist workbooks with the date as an Excel serial number in one
    file set and as text in the other; both read back to timestamps."""
    bl = fx["fx_blacklist_src"]
    serial = (F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1899-12-30 00:00:00', entry_dt)")
              / F.lit(86400000000.0))
    even = F.substring("passport_num", 3, 20).cast("bigint") % 2 == 0
    as_number = bl.where(even).select(serial.alias("date"), "passport_num")
    as_text = bl.where(~even).select(F.date_format("entry_dt", "yyyy-MM-dd HH:mm:ss").alias("date"),
                                     "passport_num")
    folder = scratch(fx.spark, "xlsx-blacklist")
    xlsx.write_sheets(as_number, folder, "blacklist")
    xlsx.write_sheets(as_text, folder, "blacklist")
    return xlsx.read_blacklist(fx.spark, folder)


@register("src_stream_daily_files", "select * from fx_transactions_hist union all " + TX_SECONDS.format(
    src="fx_transactions s where not exists "
        "(select 1 from fx_transactions_hist t where t.trans_id = s.trans_id)"))
def src_stream_daily_files(fx):
    """SRC-5/6 + FCT-1: day files arriving in an inbox, landed by the stream, loaded in one run."""
    spark = fx.spark
    root = scratch(spark, "stream")
    inbox = f"{root}/inbox"
    publish(spark, f"{root}/wh", "0", append={"fact_transactions": fx["fx_transactions_hist"]})
    # the day's operations arrive as several files
    _tx_text(fx["fx_transactions"]).repartition(4).write.option("sep", ";").option("header", True).csv(inbox)
    load_transactions_stream(spark, f"{root}/wh", inbox, f"{root}/work", f"{root}/archive", max_files_per_batch=2)
    return read_table(spark, f"{root}/wh", "fact_transactions")


# Delivery dates of the three files: operations up to the 10th, up to the 20th, the rest.
_DELIVERIES = (("10012024", "trans_date < timestamp_ntz'2024-01-11'"),
               ("20012024", "trans_date >= timestamp_ntz'2024-01-11' and trans_date < timestamp_ntz'2024-01-21'"),
               ("31012024", "trans_date >= timestamp_ntz'2024-01-21'"))


@register("src_days_by_date", "select * from fx_transactions_hist union all " + TX_SECONDS.format(
    src="fx_transactions s where not exists "
        "(select 1 from fx_transactions_hist t where t.trans_id = s.trans_id)"))
def src_days_by_date(fx):
    """SRC-5 + FCT-1: every unpublished day of a folder, found by the dates in the file names, the
    earliest first. Each file repeats the operations of the file before with other amounts: the first day's rows stay."""
    spark = fx.spark
    root = scratch(spark, "days")
    publish(spark, f"{root}/wh", "0", append={"fact_transactions": fx["fx_transactions_hist"]})
    tx = fx["fx_transactions"]
    for i, (date, when) in reversed(list(enumerate(_DELIVERIES))):      # the last day arrives first
        rows = tx.where(when)
        if i:
            rows = rows.unionByName(tx.where(_DELIVERIES[i - 1][1]).withColumn("amt", (F.col("amt") + 1).cast("decimal(10,2)")))
        _tx_text(rows).write.option("sep", ";").option("header", True).csv(f"{root}/inbox/transactions_{date}.txt")
    load_transaction_days(spark, f"{root}/wh", f"{root}/inbox", f"{root}/archive")
    return read_table(spark, f"{root}/wh", "fact_transactions")
