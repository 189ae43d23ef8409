"""Daily files as a stream (SRC-5, SRC-6 with FCT-1).

New transaction files in an inbox folder are picked up by a Structured
Streaming file source and only *landed*: each micro-batch is written to a
folder of its own, and a replayed batch overwrites its folder. When the
stream has caught up, the landed files that the published ledger
(``loaded_files``, by name and size) does not have go into the
facts in one published run (:class:`cardwatch.plans.state.Run`), by the
insert-only rule applied day by day: a key counts as known if the facts or
an earlier day's file have it, and rows of one day are all kept. So the
rows depend on the files alone, not on how they were split into batches;
a failure at any point, a lost checkpoint included, loads nothing twice and leaves nothing out. Files are archived last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators.facts import new_facts
from cardwatch.plans.job import _exists, archive_files, logical_name
from cardwatch.plans.state import Run, _delete, _read_text, _write_text
from cardwatch.sources.files import TX_FILE_SCHEMA, staging_columns

RUN_PREFIX = "stream-"


def transaction_stream(spark: SparkSession, inbox: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Staging columns plus the source file, its size and the day in its name (yyyyMMdd; empty if it has none)."""
    reader = (spark.readStream.schema(TX_FILE_SCHEMA)
              .option("sep", ";").option("header", True).option("enforceSchema", True)
              .option("locale", "de-DE").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
              .option("mode", "FAILFAST"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    raw = reader.csv(inbox).withColumns({"source_file": F.col("_metadata.file_path"), "source_size": F.col("_metadata.file_size")})
    name = F.element_at(F.split("source_file", "/"), -1)
    day = F.regexp_replace(F.regexp_extract(name, r"_(\d{8})\.", 1), r"^(\d\d)(\d\d)(\d{4})$", "$3$2$1")
    return raw.select(*staging_columns(), day.alias("day"), "source_file", "source_size")


def land_transactions(spark: SparkSession, inbox: str, landing: str, checkpoint: str,
                      max_files_per_batch: int | None = None) -> None:
    """Read all new files of the inbox into ``landing/batch=<id>/``; returns when caught up."""
    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{landing}/batch={batch_id:012d}")

    (transaction_stream(spark, inbox, max_files_per_batch).writeStream.foreachBatch(land)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def _landing(spark: SparkSession, work: str) -> str:
    """The landing zone that belongs to the stream's checkpoint: a new checkpoint lands anew, beside what an old one left."""
    marker = f"{work}/checkpoint/cardwatch-landing"
    name = _read_text(spark, marker)
    if name is None:
        name = uuid.uuid4().hex
        _write_text(spark, marker, name)
    return f"{work}/landing/{name}"


def load_transactions_stream(spark: SparkSession, root: str, inbox: str, work: str,
                             archive_dir: str | None = None, max_files_per_batch: int | None = None) -> dict | None:
    """Land the inbox, load the landed files that the ledger does not have into ``fact_transactions``, archive the files.

    ``work``: folder of the stream's checkpoint and landing zone. Returns the
    published state, or None if there was nothing new.
    """
    landing = _landing(spark, work)
    land_transactions(spark, inbox, landing, f"{work}/checkpoint", max_files_per_batch)
    if not _exists(spark, landing):
        return None
    landed = spark.read.parquet(landing)
    run = Run(spark, root, f"{RUN_PREFIX}{uuid.uuid4().hex}")
    known = run.loaded_files()
    found = [(r["source_file"], r["source_size"], r["day"]) for r in landed.select("source_file", "source_size", "day").distinct().collect()]     # one row a file
    fresh = [f for f in found if (logical_name(f[0]), f[1]) not in known]
    state = None
    if fresh:
        rows = landed.join(spark.createDataFrame([(f[0],) for f in fresh], "source_file string"), "source_file", "left_semi")
        rows = new_facts(run.table("fact_transactions"), rows.select(*S.STG_TRANSACTIONS.fieldNames(), "day"), "trans_id", keep=["day"])
        # of a key in the files of several days the first day's rows; a NULL key is always new
        first = rows.filter("trans_id is not null").groupBy("trans_id").agg(F.min("day").alias("first_day"))
        rows = rows.join(first, "trans_id", "left").filter("first_day is null or day = first_day").drop("day", "first_day")
        run.append("fact_transactions", rows)
        run.forget("carry_cards", "carry_passports")    # no report has seen these operations
        run.record_files([(logical_name(f), size, day) for f, size, day in fresh])
        state = run.commit()
    if archive_dir:
        archive_files(spark, [f[0] for f in found if _exists(spark, f[0])], archive_dir)
    _delete(spark, landing)    # all of it is in the facts; the checkpoint keeps the files from landing again
    return state
