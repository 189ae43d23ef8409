"""One business day end to end: find the day's files, load, publish, archive.

The daily files are located by date in their names (SRC-5), read by the
Spark readers, the run is published (``run_day``), and only after the
commit are the files moved to the archive folder with a ``.backup``
suffix (SRC-6). A failed run therefore leaves its files in the inbox to
be retried, and the published state unchanged. Running a date again
replaces it; a file that an earlier attempt has archived is read there.
Which files are loaded is in the published ledger (``loaded_files``), so
:func:`run_pending_days` takes every day of an inbox that is not, in order of its date.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from cardwatch.operators.facts import new_facts
from cardwatch.plans.daily import DayInputs, run_day
from cardwatch.plans.state import Run, materializer, read_table, write_parquet
from cardwatch.sources import files, xlsx


def archive_files(spark: SparkSession, paths: list[str], archive_dir: str) -> list[str]:
    """Move each file to ``archive_dir/<name>.backup`` (Hadoop FS rename: any shared store).

    A file that was delivered again goes beside the first one, as ``<name>.backup-2`` and so on.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    moved = []
    for p in paths:
        src = jvm.org.apache.hadoop.fs.Path(p)
        fs = src.getFileSystem(conf)
        dst_dir = jvm.org.apache.hadoop.fs.Path(archive_dir)
        fs.mkdirs(dst_dir)
        dst, n = jvm.org.apache.hadoop.fs.Path(dst_dir, src.getName() + ".backup"), 1
        while fs.exists(dst):
            n += 1
            dst = jvm.org.apache.hadoop.fs.Path(dst_dir, f"{src.getName()}.backup-{n}")
        if not fs.rename(src, dst):
            raise OSError(f"could not archive {p} to {dst.toString()}")
        moved.append(dst.toString())
    return moved


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def file_size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder that stands for one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def logical_name(path: str) -> str:
    """The name a file was delivered under, wherever it lies now."""
    return path.rstrip("/").rsplit("/", 1)[1].removesuffix(".backup")


def days_in(spark: SparkSession, inbox: str, kinds=tuple(files.FILE_PATTERNS)) -> dict[dt.date, dict[str, str]]:
    """Business dates with a file of each of ``kinds`` in the inbox, by the dates in their names, in order."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(inbox)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[dt.date, dict[str, str]] = {}
    for status in fs.listStatus(p) if fs.exists(p) else []:
        name = status.getPath().getName()
        for kind in kinds:
            day = files.date_of(kind, name)
            if day is not None:
                found.setdefault(day, {})[kind] = f"{inbox.rstrip('/')}/{name}"
    return {d: f for d, f in sorted(found.items()) if len(f) == len(kinds)}


def pending_days(spark: SparkSession, root: str, inbox: str, kinds=tuple(files.FILE_PATTERNS)) -> list[dt.date]:
    """Dates in the inbox with a file (by name and size) that the published ledger does not have."""
    ledger = {(r["file_name"], r["file_size"]) for r in read_table(spark, root, "loaded_files").select("file_name", "file_size").collect()}
    return [d for d, f in days_in(spark, inbox, kinds).items()
            if any((logical_name(p), file_size(spark, p)) not in ledger for p in f.values())]


def run_pending_days(spark: SparkSession, root: str, inbox: str, archive_dir: str, bank, run_ts=None, **options) -> list[dict]:
    """Every unpublished day of the inbox, one published run each, the earliest first.

    ``bank``: the source tables, or a function of the date; ``run_ts``: None or a function of the date. Files that are
    in the ledger but still in the inbox (a run that stopped before its archive step) are archived.
    """
    results = []
    for day in pending_days(spark, root, inbox):
        results.append(run_business_day(spark, root, inbox, archive_dir, day, bank(day) if callable(bank) else bank,
                                        run_ts=run_ts(day) if run_ts else None, **options))
    archive_files(spark, [p for f in days_in(spark, inbox).values() for p in f.values()], archive_dir)
    return results


def load_transaction_days(spark: SparkSession, root: str, inbox: str, archive_dir: str | None = None, bad_rows: str = "fail") -> list[str]:
    """Only the operations of every unpublished day (FCT-1), one published run a day, the earliest first. Returns the run ids."""
    runs = []
    for day in pending_days(spark, root, inbox, ("transactions",)):
        path, run_id = files.daily_path(inbox, "transactions", day), day.strftime("%Y%m%d")
        run = Run(spark, root, run_id)
        tx = files.read_transactions(spark, path, bad_rows=bad_rows)
        tx = materializer(spark)(tx[0] if bad_rows == "quarantine" else tx)     # the file is parsed once
        run.append("fact_transactions", new_facts(run.table("fact_transactions"), tx, "trans_id"))
        run.forget("carry_cards", "carry_passports")    # no report has seen these operations
        run.record_files([(logical_name(path), file_size(spark, path), run_id)])
        run.commit()
        runs.append(run_id)
    if archive_dir:
        archive_files(spark, [f["transactions"] for f in days_in(spark, inbox, ("transactions",)).values()], archive_dir)
    return runs


def locate(spark: SparkSession, inbox: str, archive_dir: str, kind: str, business_date) -> str:
    """The day's file in the inbox, or in the archive if an earlier attempt moved it."""
    path = files.daily_path(inbox, kind, business_date)
    moved = f"{archive_dir.rstrip('/')}/{path.rsplit('/', 1)[1]}.backup"
    return moved if not _exists(spark, path) and _exists(spark, moved) else path


def run_business_day(spark: SparkSession, root: str, inbox: str, archive_dir: str,
                     business_date: dt.date | str, bank: dict[str, DataFrame],
                     run_ts: str | None = None, profile: str = "reference",
                     max_gap: str = "60 days", bad_rows: str = "fail", report_scope: str = "all") -> dict:
    """Load one business day from ``inbox``; ``bank`` holds the source tables
    ``clients``, ``accounts``, ``cards`` (e.g. from :func:`files.read_bank`)."""
    if isinstance(business_date, str):
        business_date = dt.date.fromisoformat(business_date)
    paths = {k: locate(spark, inbox, archive_dir, k, business_date) for k in files.FILE_PATTERNS}
    tx = files.read_transactions(spark, paths["transactions"], bad_rows=bad_rows)
    quarantined = None
    if bad_rows == "quarantine":
        tx, quarantined = tx
    inputs = DayInputs(clients=bank["clients"], accounts=bank["accounts"], cards=bank["cards"],
                       terminals=xlsx.read_terminals(spark, paths["terminals"]),
                       blacklist=xlsx.read_blacklist(spark, paths["blacklist"]),
                       transactions=tx)
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0).isoformat(sep=" ")
    run_id = business_date.strftime("%Y%m%d")
    names = [(logical_name(p), file_size(spark, p), run_id) for p in paths.values()]
    result = run_day(spark, root, run_id, inputs, run_ts, profile=profile, max_gap=max_gap,
                     work_dir=f"{root.rstrip('/')}/_work", report_scope=report_scope, files=names)
    if quarantined is not None:     # kept next to the warehouse: the inbox file is about to move
        qpath = f"{root.rstrip('/')}/_quarantine/run={run_id}/attempt={uuid.uuid4().hex}"
        write_parquet(quarantined, qpath)
        quarantined = spark.read.parquet(qpath)
    result["archived"] = archive_files(
        spark, [p for p in paths.values() if not p.endswith(".backup")], archive_dir)
    result["quarantined"] = quarantined
    return result
