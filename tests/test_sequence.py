"""Skew-safe lead equals the plain window lead, with and without hot keys."""

import pytest
from pyspark.sql import functions as F

from cardwatch.operators.sequence import bucket_sizes, lead_columns


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("hot_rows", [3, 50, 10_000])
def test_lead_matches_window(spark, hot_rows):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    # user 0..14; make user 3 hot and add NULL keys and NULL times
    df = ev.select(
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(
            F.when(F.col("event_id") % 2 == 0, F.lit(3)).otherwise(F.col("user_id"))).alias("k"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("ts")).alias("ts"),
        F.col("event_id").alias("id"), "event_type")
    order = ["ts", "id"]
    fast = lead_columns(df, ["k"], order, ["event_type", "ts"], hot_rows=hot_rows)
    slow = lead_columns(df, ["k"], order, ["event_type", "ts"], skew_safe=False)
    cols = ["id", "next_event_type", "next_ts"]
    assert _rows(fast, cols) == _rows(slow, cols)
    assert fast.count() == df.count()


def test_an_outlier_does_not_put_a_hot_key_into_one_bucket(spark):
    """Bursts and one early date: no (key, bucket) has more than twice the bound."""
    df = spark.range(10_001).select(F.lit("k").alias("k"), F.when(F.col("id") == 0, F.lit("1900-01-01").cast("timestamp_ntz"))
                                    .otherwise(F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz")).alias("ts"), "id")
    fast = lead_columns(df, ["k"], ["ts", "id"], ["id"], hot_rows=1000)
    assert _rows(fast, ["id", "next_id"]) == _rows(lead_columns(df, ["k"], ["ts", "id"], ["id"], skew_safe=False), ["id", "next_id"])
    sizes = bucket_sizes(df, ["k"], ["ts", "id"], hot_rows=1000)
    assert max(sizes) <= 2000 and sum(sizes) == 10_001


def test_rows_without_a_time_do_not_stay_together(spark):
    """90 percent of a hot key's rows have no time, others share one: the later order columns split them."""
    df = spark.range(10_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 10 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
                                    (F.col("id") * 7919 % 10_000).cast("string").alias("name"), "id")
    order = ["ts", "name", "id"]
    sizes = bucket_sizes(df, ["k"], order, hot_rows=1000)
    assert max(sizes) <= 2000 and sum(sizes) == 10_000
    fast = lead_columns(df, ["k"], order, ["id", "ts"], hot_rows=1000)
    assert _rows(fast, ["id", "next_id"]) == _rows(lead_columns(df, ["k"], order, ["id", "ts"], skew_safe=False), ["id", "next_id"])


def test_buckets_by_text_and_of_equal_rows(spark):
    """Any orderable first column; rows that are equal throughout stay in one bucket."""
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.concat(F.lit("n"), F.col("id") % 700).alias("name"), F.lit(1).alias("v"))
    fast = lead_columns(df, ["k"], ["name", "v"], ["name"], hot_rows=200)
    assert _rows(fast, ["k", "name", "next_name"]) == _rows(lead_columns(df, ["k"], ["name", "v"], ["name"], skew_safe=False), ["k", "name", "next_name"])
    same = spark.range(900).select(F.lit(1).alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"))
    assert _rows(lead_columns(same, ["k"], ["ts"], ["k"], hot_rows=100), ["next_k"]).count((1,)) == 899
