"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, licenses, linededup, lm, mixing, neardup, pii, quality, runs, search, toxicity, warc
from ._shared import new_path, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_pages(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"), unit="sentence", run_words=linededup.RUN_WORDS)
    return out.withColumn("kept", linededup.spans(F.col("kept")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.clean(table(spark, sf_dir, "documents"))
    return out.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted_periods(table(spark, sf_dir, "documents")))
    return found.select(*runs.digests(found))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_pii, op2_decontaminate, op3_neardup, op4_toxicity, op5_fingerprints, op6_warc, op7_lm, op8_linededup, op9_licenses, op10_mixing, op11_search, op12_quality, op13_runs, pipeline)}

ORACLE = {
    "op2_decontaminate": decontaminate.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op8_linededup": linededup.ORACLE_SQL,
    "op9_licenses": licenses.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL.format(docs="documents"),
    "op11_search": search.ORACLE_SQL,
    "op12_quality": quality.ORACLE_SQL,
}
