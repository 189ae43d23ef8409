"""Type-2 history maintenance (SCD-1..8), one implementation, two profiles.

``profile="reference"`` reproduces the daily job as written: changed
entities are matched, closed and flagged by an *attribute value* (last
name, client, account, address) rather than by the entity key, the
close test is not null-safe and guards only one arm, and deleted
entities are restored from their previous version. ``profile="keyed"``
is the evident intent: versions are matched, closed and tombstoned by
key (see :func:`spec_for`).

Every step is a ``DataFrame -> DataFrame`` function. Steps that only add
rows return just the new rows ("deltas"); UPDATE-like steps are split
into a *targets* step (a small distinct set of match values) and an
*apply* step (a left join of the history with that set plus ``when``),
so a caller can materialize the small pieces and rewrite the large
history once per run (:func:`apply_statements`). :func:`apply_day` gives the same
rows for the reference profile with the merges, and the two updates, taken together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.columns import changed, minus_days
from cardwatch.operators.sides import sized
from cardwatch.schemas import Dim, TS, conform, high, low


@dataclass(frozen=True)
class Spec:
    """How one dimension is versioned under one profile."""
    new_from: str                    # "create_dt" | "low"
    new_to: str                      # "high" | "lead"
    change_match: tuple[str, ...]    # SCD-4: one merge per column, in order
    close_on: str                    # SCD-5 match column
    close_guarded: tuple[str, ...]   # arms of the SCD-5 finder guarded by "open"
    flag_on: str                     # SCD-6 match column
    clock: str                       # "run" (run time) | "day" (day's latest operation)
    keyed: bool = False


# What each statement of the daily job matches on.
REFERENCE = {
    "clients": Spec("create_dt", "high", ("last_name", "passport_num", "passport_valid_to", "phone"),
                    "last_name", ("last_name",), "last_name", "run"),
    "accounts": Spec("create_dt", "lead", ("valid_to", "client"), "client", ("valid_to",),
                     "client", "run"),
    "cards": Spec("create_dt", "lead", ("card_num",), "account_num", ("account_num",),
                  "account_num", "run"),
    "terminals": Spec("low", "high", ("terminal_type", "terminal_city", "terminal_address"),
                      "terminal_address", ("terminal_address",), "terminal_address", "day"),
}


def _keyed(spec: Spec, key: str, attrs) -> Spec:
    return Spec(spec.new_from, "high", (key,), key, tuple(attrs), key, spec.clock,
                keyed=True)


def spec_for(dim: Dim, profile: str = "reference") -> Spec:
    base = REFERENCE[dim.name]
    if profile == "reference":
        return base
    if profile == "keyed":
        return _keyed(base, dim.key, dim.attrs)
    raise ValueError(f"unknown profile {profile!r}")


def version_rows(df: DataFrame, dim: Dim, flag, eff_from: Column, eff_to: Column) -> DataFrame:
    """Project staged/history rows to the history schema of ``dim``."""
    out = df.select(dim.key, *dim.attrs, F.lit(flag).cast("int").alias("deleted_flg"),
                    eff_from.cast(TS).alias("effective_from"), eff_to.cast(TS).alias("effective_to"))
    return conform(out, dim.schema)


def restrict(big: DataFrame, small: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``big`` whose ``cols`` occur in ``small`` (semi join; NULLs never match).

    The day's delta is the build side, so when AQE measures it as small the
    history is streamed past a broadcast instead of being shuffled; when it
    is not small, a shuffle join is used. Joining against the restricted
    history gives the same result as against all of it, since rows of
    other keys can never match.
    """
    # (a semi join ignores duplicates on its build side: no distinct needed)
    probe = small.select(*cols).where(" and ".join(f"`{c}` is not null" for c in cols))
    return big.join(probe, cols, "left_semi")


def is_open(prefix: str = "") -> Column:
    return F.col(f"{prefix}effective_to") == high()


# ---- SCD-3 ----------------------------------------------------------------

def version_end(df: DataFrame, key: str, start: str, tie_breakers=(), out: str = "version_end",
                skew_safe: bool = True) -> DataFrame:
    """SCD-3: next version's start of the same key minus one day, else 9999-12-31."""
    from cardwatch.operators.sequence import lead_columns
    nxt = f"_next_{start}"
    seq = lead_columns(df, [key], [start, *tie_breakers], [start], prefix="_next_",
                       skew_safe=skew_safe)
    return seq.withColumn(out, F.coalesce(minus_days(F.col(nxt)), high())).drop(nxt)


# ---- SCD-1 ----------------------------------------------------------------

def insert_new(hist: DataFrame, stg: DataFrame, dim: Dim, spec: Spec) -> DataFrame:
    """SCD-1: staged rows whose key has no history row at all (NULL keys included)."""
    known = restrict(hist.select(dim.key), stg, [dim.key])
    return first_versions(stg.join(known, dim.key, "left_anti"), dim, spec)


def first_versions(new: DataFrame, dim: Dim, spec: Spec) -> DataFrame:
    """Staged rows without a history as the first versions of their keys."""
    eff_from = F.col("create_dt") if spec.new_from == "create_dt" else low()
    if spec.new_to == "lead":
        new = version_end(new, dim.key, "create_dt", (*dim.attrs, "update_dt"), out="_to")
        eff_to = F.col("_to")
    else:
        eff_to = high()
    return version_rows(new, dim, 0, eff_from, eff_to)


# ---- SCD-4 ----------------------------------------------------------------

def insert_changed(hist: DataFrame, stg: DataFrame, dim: Dim, match_on: str,
                   eff_from: Column) -> DataFrame:
    """SCD-4 (reference): a staged row that has no history row, or differs
    (null-safe, any attribute) from an open one, becomes a new version,
    once per such history row, unless some history row has the same
    ``match_on`` value (a NULL value never matches).
    """
    rel = restrict(hist.select(dim.key, *dim.attrs, "effective_to"), stg, [dim.key])
    t = rel.select(F.col(dim.key).alias("_tk"), *[F.col(a).alias(f"_t_{a}") for a in dim.attrs],
                   F.col("effective_to").alias("_t_to"))
    s_cols = [F.col(c) for c in stg.columns]
    j = stg.join(t, F.col(dim.key) == F.col("_tk"), "left")
    diff = reduce(or_, [~F.col(a).eqNullSafe(F.col(f"_t_{a}")) for a in dim.attrs], F.lit(False))
    using = j.where(F.col("_tk").isNull() | ((F.col("_t_to") == high()) & diff)).select(*s_cols)
    # candidates are staged rows, so the staged values bound the lookup
    # (distinct: many history rows may share one value, and an anti join's right side is not split)
    taken = restrict(hist.select(match_on), stg, [match_on]).distinct().select(F.col(match_on).alias("_m"))
    new = using.join(taken, F.col(match_on) == F.col("_m"), "left_anti")
    return version_rows(new, dim, 0, eff_from, high())


def dedupe_by_key(stg: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One staged row per key (the greatest by ``order``), deterministic."""
    others = [c for c in stg.columns if c != key]
    pick = F.max_by(F.struct(*others), F.struct(*order, *others))
    return stg.groupBy(key).agg(pick.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def mark_staged_keyed(hist: DataFrame, stg: DataFrame, dim: Dim) -> DataFrame:
    """``stg`` (one row per key, :func:`dedupe_by_key`) with ``_known``: the key has a history row;
    and ``_held``: an open, unflagged one has exactly the staged attributes. One pass over the history."""
    rel = restrict(hist, stg, [dim.key])
    rel = rel.select(F.col(dim.key).alias("_tk"), *[F.col(a).alias(f"_t_{a}") for a in dim.attrs],
                     (is_open() & (F.col("deleted_flg") == 0)).alias("_t_current"))
    same = reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(f"_t_{a}")) for a in dim.attrs], F.coalesce("_t_current", F.lit(False)))
    return (stg.join(rel, F.col(dim.key) == F.col("_tk"), "left").groupBy(*stg.columns)
            .agg((F.count("_tk") > 0).alias("_known"), F.max(same).alias("_held")))


def insert_changed_keyed(marked: DataFrame, dim: Dim, eff_from: Column) -> DataFrame:
    """SCD-4 (keyed): a staged row of a known key with no open, unflagged
    version holding exactly its attributes becomes the new open version.
    ``marked``: from :func:`mark_staged_keyed`; what SCD-1 inserts holds the staged attributes."""
    return version_rows(marked.where(F.col("_known") & ~F.col("_held")), dim, 0, eff_from, high())


# ---- SCD-5 ----------------------------------------------------------------

def close_targets(hist: DataFrame, stg: DataFrame, dim: Dim, spec: Spec) -> DataFrame:
    """SCD-5 finder: distinct ``close_on`` values of history rows whose key is
    staged with different attributes: plain ``<>`` (NULL never differs), and
    only the arms in ``close_guarded`` require an open row (keyed: :func:`close_keyed`).
    """
    t = hist.alias("t")
    s = stg.select(dim.key, *dim.attrs).alias("s")
    arms = []
    for a in dim.attrs:
        arm = F.col(f"t.{a}") != F.col(f"s.{a}")
        if a in spec.close_guarded:
            arm = is_open("t.") & arm
        arms.append(arm)
    hit = reduce(or_, arms, F.lit(False))
    j = t.join(s, F.col(f"t.{dim.key}") == F.col(f"s.{dim.key}"), "inner")
    return j.where(hit).select(F.col(f"t.{spec.close_on}").alias(spec.close_on)).distinct()


def apply_close(hist: DataFrame, targets: DataFrame, spec: Spec, end: Column) -> DataFrame:
    """SCD-5 update: ``effective_to = end`` for every row whose ``close_on`` value is a target."""
    m = spec.close_on
    tg = targets.where(F.col(m).isNotNull()).select(F.col(m).alias("_c"), F.lit(True).alias("_close"))
    h = hist.join(tg, F.col(m) == F.col("_c"), "left")
    hit = F.coalesce(F.col("_close"), F.lit(False))
    cols = [F.when(hit, end).otherwise(F.col("effective_to")).cast(TS).alias(c) if c == "effective_to"
            else F.col(c) for c in hist.columns]
    return h.select(*cols)


def close_keyed(hist: DataFrame, stg: DataFrame, dim: Dim, end: Column) -> DataFrame:
    """SCD-5 (keyed): end every open row of a staged key that differs (null-safe)
    from the staged row or is a tombstone; an open row equal to it stays open.
    ``stg`` must hold one row per key."""
    s = stg.where(F.col(dim.key).isNotNull()).select(
        F.col(dim.key).alias("_k"), *[F.col(a).alias(f"_s_{a}") for a in dim.attrs])
    diff = reduce(or_, [~F.col(a).eqNullSafe(F.col(f"_s_{a}")) for a in dim.attrs], F.col("deleted_flg") == 1)
    hit = F.col("_k").isNotNull() & is_open() & diff
    h = hist.join(s, F.col(dim.key) == F.col("_k"), "left")
    return h.select(*[F.when(hit, end).otherwise(F.col(c)).cast(TS).alias(c) if c == "effective_to"
                      else F.col(c) for c in hist.columns])


# ---- SCD-6 ----------------------------------------------------------------

def flag_targets(hist: DataFrame, keys: DataFrame, dim: Dim, spec: Spec) -> DataFrame:
    """SCD-6 finder: distinct ``flag_on`` values of open, unflagged rows whose
    key is missing from the key snapshot (a NULL key is always missing)."""
    present = keys.select(dim.key).where(F.col(dim.key).isNotNull()).distinct()
    gone = (hist.where((F.col("deleted_flg") == 0) & is_open())
            .join(present, dim.key, "left_anti"))
    return gone.select(spec.flag_on).distinct()


def apply_flag(hist: DataFrame, targets: DataFrame, spec: Spec, set_from: Column | None,
               set_to: Column) -> DataFrame:
    """SCD-6 update (reference): every row sharing a target value gets
    ``deleted_flg = 1``, ``effective_to = set_to`` and, when given,
    ``effective_from = set_from``."""
    m = spec.flag_on
    tg = targets.where(F.col(m).isNotNull()).select(F.col(m).alias("_f"), F.lit(True).alias("_flag"))
    h = hist.join(tg, F.col(m) == F.col("_f"), "left")
    hit = F.coalesce(F.col("_flag"), F.lit(False))
    new = {"deleted_flg": F.lit(1), "effective_to": set_to}
    if set_from is not None:
        new["effective_from"] = set_from
    cols = [F.when(hit, new[c]).otherwise(F.col(c)).cast(hist.schema[c].dataType).alias(c)
            if c in new else F.col(c) for c in hist.columns]
    return h.select(*cols)


def flag_deleted_keyed(hist: DataFrame, keys: DataFrame, dim: Dim, at: Column,
                       end: Column, materialize) -> tuple[DataFrame, DataFrame]:
    """SCD-6 (keyed): close the open unflagged row of every key missing from
    the snapshot and add a tombstone (flag 1) from ``at`` to 9999-12-31.
    Returns (updated history, tombstones); the rows that go are found once (``materialize``)."""
    present = keys.select(dim.key).where(F.col(dim.key).isNotNull()).distinct()
    gone_keys = (hist.where((F.col("deleted_flg") == 0) & is_open())
                 .join(present, dim.key, "left_anti")
                 .where(F.col(dim.key).isNotNull()))
    gone_keys = sized(materialize(gone_keys))
    tomb = version_rows(gone_keys, dim, 1, at, high())
    g = gone_keys.select(dim.key).distinct().withColumn("_gone", F.lit(True))
    h = hist.join(g, dim.key, "left")
    hit = F.coalesce(F.col("_gone"), F.lit(False)) & is_open() & (F.col("deleted_flg") == 0)
    cols = [F.when(hit, end).otherwise(F.col(c)).cast(TS).alias(c) if c == "effective_to"
            else F.col(c) for c in hist.columns]
    return h.select(*cols), tomb


# ---- SCD-7 / SCD-8 --------------------------------------------------------

def first_unique_version_keys(hist: DataFrame, key: str) -> DataFrame:
    """SCD-7: keys whose earliest ``effective_from`` (NULLS LAST) is held by
    exactly one row, i.e. a running ``count(key)`` over (key order by
    effective_from, peers included) is below 2 on some row.

    Two partial aggregates instead of a window: a hot key is combined
    map-side instead of landing whole in one task.
    """
    per_start = (hist.where(F.col(key).isNotNull())
                 .groupBy(key, "effective_from").agg(F.count(F.lit(1)).alias("_c")))
    first = per_start.groupBy(key).agg(
        F.min(F.struct(F.col("effective_from").isNull().alias("n"),
                       F.col("effective_from").alias("f"), F.col("_c").alias("c"))).alias("_first"))
    return first.where(F.col("_first.c") < 2).select(key)


def restore_previous(hist: DataFrame, dim: Dim, eff_from: Column | None, eff_to: Column) -> DataFrame:
    """SCD-8: distinct unflagged copies of the flagged rows of keys that pass
    SCD-7; ``effective_from`` kept unless given, ``effective_to`` = ``eff_to``."""
    return restore_flagged(hist, hist.where(F.col("deleted_flg") == 1), dim, eff_from, eff_to)


def restore_flagged(hist: DataFrame, flagged: DataFrame, dim: Dim, eff_from: Column | None, eff_to: Column) -> DataFrame:
    """:func:`restore_previous` where the flagged rows of ``hist`` are at hand."""
    # SCD-7 is per key: only keys with a flagged row need their versions counted
    keys = first_unique_version_keys(restrict(hist, flagged, [dim.key]), dim.key)
    rows = flagged.join(keys, dim.key, "left_semi")
    frm = F.col("effective_from") if eff_from is None else eff_from
    return version_rows(rows, dim, 0, frm, eff_to).distinct()


# ---- one dimension, one day -------------------------------------------------

STEPS = ("insert_new", "insert_changed", "close", "flag_deleted", "restore")


def clocks(spec: Spec, run_ts: Column, day_scalars: DataFrame | None):
    """(start of a new version, end of a closed one).

    Terminals run on the day's latest operation time: a 1-row aggregate
    used as a scalar subquery, evaluated once per query. Keyed versions are
    half-open: one ends where the next one starts, so every moment after the
    first start belongs to exactly one version. The reference ends a day before.
    """
    start = run_ts if spec.clock == "run" else day_scalars.scalar()
    return start, (start if spec.keyed else minus_days(start))


def apply_statements(hist: DataFrame, stg: DataFrame, keys: DataFrame, dim: Dim, run_ts: Column,
                     day_scalars: DataFrame | None = None, profile: str = "reference",
                     stop_after: str = "restore", materialize=None) -> DataFrame:
    """The daily steps of one dimension as a plain chain of the statements above, each over the
    result of those before. :func:`apply_day` returns the same rows with fewer passes over the history.
    """
    if materialize is None:
        from cardwatch.plans.state import materializer
        materialize = materializer(hist.sparkSession)
    spec = spec_for(dim, profile)
    start, end = clocks(spec, run_ts, day_scalars)
    if spec.keyed:      # one row per key from the first step on; rows without a key are no entity
        order = ["update_dt", "create_dt"] if "update_dt" in stg.columns else []
        stg = sized(materialize(dedupe_by_key(stg.where(F.col(dim.key).isNotNull()), dim.key, order)))
        keys = sized(keys)
        marked = materialize(mark_staged_keyed(hist, stg, dim))
        h = hist.unionByName(first_versions(marked.where(~F.col("_known")), dim, spec))
    else:
        h = hist.unionByName(materialize(insert_new(hist, stg, dim, spec)))
    if stop_after == "insert_new":
        return h
    if spec.keyed:
        new = insert_changed_keyed(marked, dim, start)
        if stop_after == "insert_changed":
            return h.unionByName(new)
        h = close_keyed(h, stg, dim, end).unionByName(new)
        if stop_after == "close":
            return h
        h, tomb = flag_deleted_keyed(h, keys, dim, start, end, materialize)
        return h.unionByName(tomb)
    for m in spec.change_match:
        h = h.unionByName(materialize(insert_changed(h, stg, dim, m, start)))
    if stop_after == "insert_changed":
        return h
    h = apply_close(h, materialize(close_targets(h, stg, dim, spec)), spec, end)
    if stop_after == "close":
        return h
    set_from = run_ts if spec.clock == "run" else None
    h = apply_flag(h, materialize(flag_targets(h, keys, dim, spec)), spec, set_from,
                   high() if spec.clock == "run" else end)
    if stop_after == "flag_deleted":
        return h
    if spec.clock == "run":
        restored = restore_previous(h, dim, None, end)
    else:
        restored = restore_previous(h, dim, start, high())
    return h.unionByName(materialize(restored))


#: Staged rows up to which the merges of SCD-4 run in one partition (counted first): no exchange at all.
SMALL_DELTA = 100_000


def _texts(match: tuple[str, ...]) -> Column:
    """One (number, value as text) row per match column that has a value."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(m).cast("string").alias("v")) for i, m in enumerate(match)])
    return F.inline(F.filter(pairs, lambda p: p["v"].isNotNull()))


def merged_versions(hist: DataFrame, rel: DataFrame, new: DataFrame, stg: DataFrame, dim: Dim, spec: Spec,
                    eff_from: Column, materialize) -> DataFrame:
    """SCD-4, all merges of the day in one pass over the staged rows: the versions they insert, in total.

    ``rel``: the history rows of staged keys; ``new``: what SCD-1 inserts. The history
    itself is read once, for the match values that it holds already. A merge sees what those
    before it inserted, which are staged rows too: whether one has the value is a maximum
    over the staged rows of that value, how many differ from a row is a sum over those of its key.
    """
    cols = [dim.key, *dim.attrs]
    base = rel.select(*cols, "effective_to").unionByName(new.select(*cols, "effective_to"))
    rows = stg.groupBy(*cols).agg(F.count(F.lit(1)).alias("_dup"))
    taken = (hist.select(_texts(spec.change_match))
             .join(stg.select(_texts(spec.change_match)), ["i", "v"], "left_semi").distinct())
    taken = sized(materialize(taken))
    t = base.select(F.col(dim.key).alias("_tk"), *[F.col(a).alias(f"_t_{a}") for a in dim.attrs], F.col("effective_to").alias("_t_to"))
    same_key = F.col(dim.key) == F.col("_tk")
    differs = reduce(or_, [~F.col(a).eqNullSafe(F.col(f"_t_{a}")) for a in dim.attrs], F.lit(False))
    counted = (rows.join(t, same_key, "left").groupBy(*cols, "_dup")
               .agg(F.count("_tk").alias("_n"), F.count_if((F.col("_t_to") == high()) & differs).alias("_open")))
    # no version at all (a NULL key): once; else once per open version that differs
    counted = counted.withColumn("_open", F.when(F.col("_n") == 0, 1).otherwise(F.col("_open")))
    fresh = sized(new).select(dim.key).where(F.col(dim.key).isNotNull()).distinct().withColumn("_fresh", F.lit(True))
    df = counted.join(fresh, dim.key, "left")
    df = df.withColumn("_in", F.coalesce("_fresh", F.lit(False)) | F.col(dim.key).isNull())     # in the history since SCD-1
    # one column a merge: the staged rows whose value the history has
    pairs = taken.groupBy("v").agg(F.collect_set("i").alias("_is"))
    for i, m in enumerate(spec.change_match):
        df = df.join(pairs.select(F.col("v").alias(f"_v{i}"), F.array_contains("_is", i).alias(f"_taken{i}")), F.col(m).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    df = materialize(df)
    n_rows, n_keyed, n_keys = df.agg(F.count(F.lit(1)), F.count(dim.key), F.count_distinct(dim.key)).first()
    if n_rows <= SMALL_DELTA:
        df = df.coalesce(1)
    df = df.withColumn("_ins", F.lit(0).cast("long"))
    by_key, by_row = Window.partitionBy(dim.key), Window.partitionBy(*cols)
    for i, m in enumerate(spec.change_match):
        held = (F.max(F.col("_in") | (F.col("_ins") > 0)).over(Window.partitionBy(m)) | F.coalesce(f"_taken{i}", F.lit(False))) & F.col(m).isNotNull()
        others = F.lit(0)       # what earlier merges inserted for other rows of the key: nothing if no key is staged twice
        if n_keyed > n_keys:
            others = F.when(F.col(dim.key).isNotNull(), F.sum("_ins").over(by_key) - F.sum("_ins").over(by_row)).otherwise(others)
        df = df.withColumn("_add", F.when(held, F.lit(0)).otherwise(F.col("_dup") * (F.col("_open") + others)))
        df = df.withColumn("_ins", F.col("_ins") + F.col("_add")).drop("_add")
    df = df.where(F.col("_ins") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_ins"))))
    return version_rows(df, dim, 0, eff_from, high())


def value_hits(hist: DataFrame, rel: DataFrame, inserted: DataFrame, stg: DataFrame, keys: DataFrame, dim: Dim, spec: Spec) -> DataFrame:
    """SCD-5 and SCD-6 finders together: one row per match value that is closed or flagged, (value, close, flag).

    Both statements reach rows by the same column, so a value that is closed has no open row left to flag.
    """
    c = spec.close_on
    closed = close_targets(rel.unionByName(inserted), stg, dim, spec).select(F.col(c).alias("_c"), F.lit(True).alias("close"), F.lit(False).alias("gone"))
    gone = flag_targets(hist.unionByName(inserted), keys, dim, spec).select(F.col(spec.flag_on).alias("_c"), F.lit(False).alias("close"), F.lit(True).alias("gone"))
    both = closed.unionByName(gone).where(F.col("_c").isNotNull()).groupBy("_c").agg(F.max("close").alias("close"), F.max("gone").alias("gone"))
    return both.select("_c", "close", (F.col("gone") & ~F.col("close")).alias("flag"))


def apply_hits(hist: DataFrame, hits: DataFrame, spec: Spec, end: Column, set_from: Column | None, set_to: Column,
               flag: bool = True) -> DataFrame:
    """SCD-5 and, with ``flag``, SCD-6 updates in one join: see :func:`apply_close` and :func:`apply_flag`."""
    h = hist.join(hits, F.col(spec.close_on) == F.col("_c"), "left")
    flagged = F.coalesce(F.col("flag"), F.lit(False)) if flag else F.lit(False)
    new = {"effective_to": F.when(F.coalesce(F.col("close"), F.lit(False)), end).when(flagged, set_to).otherwise(F.col("effective_to")),
           "deleted_flg": F.when(flagged, 1).otherwise(F.col("deleted_flg"))}
    if set_from is not None:
        new["effective_from"] = F.when(flagged, set_from).otherwise(F.col("effective_from"))
    return h.select(*[new[c].cast(hist.schema[c].dataType).alias(c) if c in new else F.col(c) for c in hist.columns])


def apply_day(hist: DataFrame, stg: DataFrame, keys: DataFrame, dim: Dim, run_ts: Column,
              day_scalars: DataFrame | None = None, profile: str = "reference",
              stop_after: str = "restore", materialize=None) -> DataFrame:
    """Run the daily steps for one dimension and return its new history.

    The day's statements work on what the day can affect: the staged rows, the history
    rows of their keys (one semi join), and the match values they close or flag; the large history is only streamed past
    these, and rewritten once by the caller's publish. ``materialize`` cuts
    lineage of the small tables (default: Parquet tables in the checkpoint
    folder, see :func:`cardwatch.plans.state.materializer`). The rows are those of :func:`apply_statements`.
    """
    if materialize is None:
        from cardwatch.plans.state import materializer
        materialize = materializer(hist.sparkSession)
    spec = spec_for(dim, profile)
    if spec.keyed or spec.close_on != spec.flag_on:
        return apply_statements(hist, stg, keys, dim, run_ts, day_scalars, profile, stop_after, materialize)
    start, end = clocks(spec, run_ts, day_scalars)
    stg, keys = sized(stg), sized(keys)
    rel = materialize(restrict(hist, stg, [dim.key]).select(*hist.columns))
    new = materialize(insert_new(rel, stg, dim, spec))
    if stop_after == "insert_new":
        return hist.unionByName(new)
    inserted = new.unionByName(materialize(merged_versions(hist, rel, new, stg, dim, spec, start, materialize)))
    h = hist.unionByName(inserted)
    if stop_after == "insert_changed":
        return h
    hits = sized(materialize(value_hits(hist, rel, inserted, stg, keys, dim, spec)))
    run_clock = spec.clock == "run"
    update = dict(spec=spec, end=end, set_from=run_ts if run_clock else None, set_to=high() if run_clock else end)
    h = apply_hits(h, hits, flag=stop_after != "close", **update)
    if stop_after in ("close", "flag_deleted"):
        return h
    flagged = sized(materialize(h.where(F.col("deleted_flg") == 1)))
    restored = restore_flagged(h, flagged, dim, None if run_clock else start, end if run_clock else high())
    return h.unionByName(materialize(restored))
