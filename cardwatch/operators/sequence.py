"""Next-row lookup (``lead``) that survives a hot partition key.

``lead(x) over (partition by k order by o)`` needs every row of ``k`` in
one task; when a single key holds a large share of all rows (an unknown
card, a test terminal) that task holds that share. Here a key with more
than ``hot_rows`` rows is split into buckets with about equally many rows
each, along the whole order: bounds are quantiles of the complete sort tuple, so
bursts, outliers and any number of rows with the same or no first value
do not matter. The bounds come from the rows whose tuple's hash falls into a
fixed share (about ``SAMPLES`` a bucket) and are saved once, so any recomputation after
a lost executor gives the same buckets. The lead is taken per (key,
bucket); the last row of each bucket then takes the first row of the next
non-empty bucket of the same key. Keys below the threshold keep one
bucket and never reach the fix-up. Only rows equal in every order column stay together.

The ordering must be total on the columns that matter (add tie-breakers):
rows that tie on ``order_by`` may come out in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_KEY, _BUCKET, _TAIL = "_seq_key", "_seq_bucket", "_seq_tail"
_HEAD, _NEXT_HEAD, _POS = "_seq_head", "_seq_next_head", "_seq_pos"
DEFAULT_HOT_ROWS = 2_000_000
BROADCAST_HOT_KEYS = 100_000
SAMPLES = 64        # rows whose tuples place a bound, per bucket


def sort_struct(order_by, values=()):
    """Struct that sorts like ``order_by ASC NULLS LAST`` and carries ``values``."""
    fields = []
    for i, c in enumerate(order_by):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
    fields += [F.col(v).alias(f"v{j}") for j, v in enumerate(values)]
    return F.struct(*fields)


def key_stats(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows per key: a partial aggregate (map-side combined)."""
    return df.select(F.struct(*partition_by).alias(_KEY)).groupBy(_KEY).agg(F.count(F.lit(1)).alias("_n"))


def _chunks(df: DataFrame, partition_by: list[str], order_by: list[str], hot_rows: int | None,
            stats: DataFrame | None) -> DataFrame | None:
    """``df`` with its key, bucket and whether the key is hot; None if no key is hot."""
    hot_rows = int(hot_rows or df.sparkSession.conf.get("cardwatch.lead.hotRows",
                                                        str(DEFAULT_HOT_ROWS)))
    stats = stats if stats is not None else key_stats(df, partition_by)
    # Hot keys: at most total_rows / hot_rows of them.
    hot = stats.where(F.col("_n") > hot_rows).select(_KEY, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_b"))
    n_hot = hot.count()
    if n_hot == 0:
        return None
    # A struct is never NULL and compares NULL fields as equal, so one plain
    # equi-key serves the window, the bucket table and the fix-up join; the
    # join then reuses the window's hash partitioning for the big side.
    keyed = df.select("*", F.struct(*partition_by).alias(_KEY))
    # Quantiles of the hot keys alone, saved: every later use sees the same bounds.
    from cardwatch.plans.state import materializer
    share = max(1, hot_rows // SAMPLES)
    sampled = keyed.where(F.pmod(F.xxhash64(*order_by), F.lit(share)) == 0).select(_KEY, sort_struct(order_by).alias(_POS))
    bounds = (sampled.join(hot, _KEY, "inner").groupBy(_KEY)
              .agg(F.sort_array(F.collect_list(_POS)).alias("_s"), F.max("_b").alias("_b"))
              # ascending, at 1/b, 2/b, ... of the sample
              .select(_KEY, F.transform(F.sequence(F.lit(1), F.greatest(F.col("_b") - 1, F.lit(1))),
                                        lambda i: F.get("_s", F.floor(i * F.size("_s") / F.greatest("_b", F.lit(2))).cast("int"))).alias("_bounds")))
    bounds = materializer(df.sparkSession)(bounds)
    if n_hot <= BROADCAST_HOT_KEYS:      # checked size: broadcast; else a shuffle join
        bounds = F.broadcast(bounds)
    placed = keyed.join(bounds.withColumn("_hot", F.lit(True)), _KEY, "left")
    placed = placed.withColumn(_POS, F.when(F.col("_hot"), sort_struct(order_by)))
    bucket = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.size(F.filter("_bounds", lambda x: x < F.col(_POS)))).cast("long")
    return placed.select(*df.columns, _KEY, bucket.alias(_BUCKET), F.col("_hot").isNotNull().alias("_hot"))


def bucket_sizes(df: DataFrame, partition_by: list[str], order_by: list[str], hot_rows: int) -> list[int]:
    """Rows of each bucket of the hot keys, as :func:`lead_columns` would make them (for tests and tuning)."""
    chunked = _chunks(df, partition_by, order_by, hot_rows, None)
    return [r[0] for r in chunked.where("_hot").groupBy(_KEY, _BUCKET).agg(F.count(F.lit(1)).alias("n")).select("n").collect()] if chunked else []


def lead_columns(df: DataFrame, partition_by: list[str], order_by: list[str],
                 values: list[str], prefix: str = "next_", hot_rows: int | None = None,
                 skew_safe: bool = True, stats: DataFrame | None = None) -> DataFrame:
    """Add ``prefix + v`` = ``lead(v)`` over (partition_by, order_by ASC NULLS LAST).

    ``stats`` (from :func:`key_stats`, possibly over a cheaper input with the
    same keys, e.g. the facts before a fan-out join, times that fan-out)
    tells which keys are hot. Their number is checked on the driver (one
    count): with no hot key the plain window is used, which keeps an
    existing partitioning on the key and adds no stage; otherwise hot keys
    are split into buckets as described above.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]

    def plain():
        w = Window.partitionBy(*partition_by).orderBy(*order)
        return df.select("*", *[F.lead(v).over(w).alias(prefix + v) for v in values])

    chunked = _chunks(df, partition_by, order_by, hot_rows, stats) if skew_safe else None
    if chunked is None:
        return plain()
    w = Window.partitionBy(_KEY, _BUCKET).orderBy(*order)
    local = chunked.select(
        "*", *[F.lead(v).over(w).alias(prefix + v) for v in values],
        F.lead(F.lit(1)).over(w).isNull().alias(_TAIL))

    # First row of every bucket of a hot key, then the first row of the next bucket.
    heads = (chunked.where("_hot").groupBy(_KEY, _BUCKET)
             .agg(F.min(sort_struct(order_by, values)).alias(_HEAD)))
    nxt = (heads.select(_KEY, _BUCKET, F.lead(_HEAD).over(
        Window.partitionBy(_KEY).orderBy(_BUCKET)).alias(_NEXT_HEAD))
        .where(F.col(_NEXT_HEAD).isNotNull()))

    l, r = local.alias("_l"), nxt.alias("_r")
    cond = ((F.col(f"_l.{_KEY}") == F.col(f"_r.{_KEY}"))
            & (F.col(f"_l.{_BUCKET}") == F.col(f"_r.{_BUCKET}"))
            & F.col(f"_l.{_TAIL}") & F.col("_l._hot"))
    joined = l.join(r, cond, "left")
    out_cols = [F.col(f"_l.{c}") for c in df.columns]
    for j, v in enumerate(values):
        out_cols.append(F.when(F.col(f"_l.{_TAIL}") & F.col("_l._hot"), F.col(f"_r.{_NEXT_HEAD}.v{j}"))
                        .otherwise(F.col(f"_l.{prefix + v}")).alias(prefix + v))
    return joined.select(*out_cols)
