"""Benchmark decontamination by winnowing (operator 2).

Of every window of ``SPAN - K + 1`` consecutive K-word hashes the smallest is kept (the
last, if several are); so any SPAN words that a document and an item share keep at least one
fingerprint in common, at the same place of both. Fingerprints of documents and
items are joined, and every hit is extended to both sides as far as the words agree;
a run of SPAN words or more is contamination.

What is broadcast is a bit table of the items' fingerprints, 2 MB whatever
their number. It only spares the shuffle fingerprints that no item has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import packed, saved, ship
from ._words import LETTERS_DIGITS, binary_column, bytes_of, grams, slices, tokens

ship(__name__)

SPAN = 13       # words of a window
K = 7           # words of a hash; windows of SPAN - K + 1 hashes
SHARE = 20      # contaminated: hit words are at least one in so many
TABLE_BITS = 24


def winnowed(h: np.ndarray, first: np.ndarray, span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Places (token numbers) and hashes of the kept k-grams of all texts."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    g = grams(h, k)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    best, at = g[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, span - k + 1):
        here = g[j:j + n]
        less = here <= best
        best[less] = here[less]
        at[less] = j
    chosen = np.zeros(len(g), dtype=bool)
    chosen[(np.arange(n) + at)[doc[:n] == doc[span - 1:]]] = True
    p = np.flatnonzero(chosen)
    return p, g[p]


def _whole(h, first, m: int):
    """Places and hashes of all m-grams within texts."""
    g = grams(h, m)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    p = np.flatnonzero(doc[:len(g)] == doc[m - 1:m - 1 + len(g)]) if len(g) else np.empty(0, np.int64)
    return p, g[p]


def _numbers(start: int, n: int) -> pa.Array:
    task = TaskContext.get()
    return pa.array((np.int64(task.partitionId() if task else 0) << 36) + np.arange(start, start + n), pa.int64())


def _lists(values: pa.Array, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)


def _item_rows(span: int, k: int):
    def run(batches):
        seen = 0
        for b in slices(batches):
            h, _, first = tokens(*bytes_of(b.column(1)), LETTERS_DIGITS)
            n = np.diff(first)
            p, fp = winnowed(h, first, span, k)
            for m in np.unique(n[(n > 0) & (n < span)]):  # an item of fewer words is one window
                short = np.flatnonzero(n == m)
                wp, wg = _whole(h, first, int(m))
                own = np.isin(wp, first[short])
                p, fp = np.concatenate([p, wp[own]]), np.concatenate([fp, wg[own]])
            order = np.argsort(p, kind="stable")
            p, fp = p[order], fp[order]
            at = np.searchsorted(p, first)
            of = np.repeat(first[:-1], np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [_numbers(seen, b.num_rows), b.column(0), pa.array(n, pa.int32()), binary_column(h, first),
                 _lists(pa.array(fp.view(np.int64)), at), _lists(pa.array((p - of).astype(np.int32)), at)],
                ["iid", "item_id", "i_words", "i_hashes", "fps", "qs"])
            seen += b.num_rows
    return run


def _doc_rows(bits, short: list[int], span: int, k: int):
    def run(batches):
        table, seen = bits.value, 0
        for b in slices(batches):
            h, _, first = tokens(*bytes_of(b.column(1)), LETTERS_DIGITS)
            places, hashes = [], []
            for p, fp in [winnowed(h, first, span, k), *(_whole(h, first, m) for m in short)]:
                bit = (fp >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
                known = (table[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
                places.append(p[known])
                hashes.append(fp[known])
            p, fp = np.concatenate(places), np.concatenate(hashes)
            order = np.argsort(p, kind="stable")
            p, fp = p[order], fp[order]
            at = np.searchsorted(p, first)
            of = np.repeat(first[:-1], np.diff(at))
            # words go along only where there is something to extend
            hit = np.diff(at) > 0
            carried = np.repeat(hit, np.diff(first))
            words = binary_column(h[carried], np.concatenate([[0], np.cumsum(np.where(hit, np.diff(first), 0))]))
            yield pa.RecordBatch.from_arrays(
                [_numbers(seen, b.num_rows), b.column(0), b.column(2), pa.array(np.diff(first), pa.int64()), words,
                 _lists(pa.array(fp.view(np.int64)), at), _lists(pa.array((p - of).astype(np.int32)), at)],
                ["rid", "doc_id", "t_hash", "n_words", "d_hashes", "fps", "ps"])
            seen += b.num_rows
    return run


def _extend(span: int):
    """Runs of equal words on one diagonal of a document and an item."""
    def run(batches):
        for b in batches:
            rid, iid, begin, starts, ends = [], [], [], [], []
            for r, i, s, dw, iw, n in zip(*(b.column(j).to_pylist() for j in range(6))):
                same = np.frombuffer(dw, np.uint64) == np.frombuffer(iw, np.uint64)
                edge = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
                up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                for x, y in zip(up, down):
                    if y - x >= min(span, n):
                        rid.append(r), iid.append(i), starts.append(s + int(x)), ends.append(s + int(y))
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(iid, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                                             ["rid", "iid", "start", "end"])
    return run


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", span: int = SPAN, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): one row per document (rid, doc_id, t_hash, n_words), and maximal runs (rid, item_id, start, end) in words.

    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. An item of
    fewer than ``span`` words is a single window. Null and empty texts have no words and match
    nothing; repeated rows are separate documents; null item ids appear as 'null'. ``rid`` is a row number of ours: documents of one id
    are not mixed up. Only the named columns are read.
    """
    spark = docs.sparkSession
    source = items.select(F.col(f"`{item_col}`").cast("string").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    found = saved(source.mapInArrow(_item_rows(span, k), "iid long, item_id string, i_words int, i_hashes binary, fps array<long>, qs array<int>"), "bench-items")
    prints = found.select("iid", F.explode(F.arrays_zip("fps", "qs")).alias("z")).select("iid", F.col("z.fps").alias("fp"), F.col("z.qs").alias("q"))
    short = [r[0] for r in found.filter((F.col("i_words") > 0) & (F.col("i_words") < span)).select("i_words").distinct().collect()]  # span - 1 rows at most
    word = F.shiftrightunsigned("fp", 64 - TABLE_BITS + 6)
    bit = F.shiftrightunsigned("fp", 64 - TABLE_BITS).bitwiseAND(F.lit(63))
    cells = prints.select(word.alias("w"), bit.cast("int").alias("b")).groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("bits"))
    table = np.zeros(2 ** (TABLE_BITS - 6), dtype=np.uint64)
    for r in cells.collect():  # as many rows as the table has words, at most
        table[r["w"]] = np.uint64(r["bits"] & (2 ** 64 - 1))
    bits = spark.sparkContext.broadcast(table)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("t_hash"))
    read = saved(rows.mapInArrow(_doc_rows(bits, sorted(short), span, k),
                                 "rid long, doc_id long, t_hash long, n_words long, d_hashes binary, fps array<long>, ps array<int>"), "bench-docs")
    seen = (read.filter(F.size("fps") > 0).select("rid", F.explode(F.arrays_zip("fps", "ps")).alias("z"))
            .select("rid", F.col("z.fps").alias("fp"), F.col("z.ps").alias("p")))
    # One row for each diagonal: many hits of one run are one extension.
    lines = seen.join(prints, "fp").select("rid", "iid", (F.col("p") - F.col("q")).alias("shift")).distinct()
    met = (lines.join(found.select("iid", "item_id", "i_words", "i_hashes"), "iid")
           .join(read.filter(F.size("fps") > 0).select("rid", "n_words", "d_hashes"), "rid"))
    start = F.greatest(F.col("shift"), F.lit(0))
    stop = F.least(F.col("n_words").cast("int"), F.col("shift") + F.col("i_words"))
    cut = lambda c, a, b: F.substring(c, a * 8 + 1, (b - a) * 8)  # noqa: E731  words a .. b-1 of packed hashes
    pairs = met.select("rid", "iid", start.alias("start"), cut(F.col("d_hashes"), start, stop).alias("dw"),
                       cut(F.col("i_hashes"), start - F.col("shift"), stop - F.col("shift")).alias("iw"), "i_words")
    runs = pairs.mapInArrow(_extend(span), "rid long, iid long, start int, end int")
    hits = runs.join(found.select("iid", F.coalesce("item_id", F.lit("null")).alias("item_id")), "iid")
    return read.select("rid", "doc_id", "t_hash", "n_words"), hits.select("rid", "item_id", "start", "end")


def covered(spans: Column) -> Column:
    """How many places a set of [start, end) spans covers."""
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
                       lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
                                               F.greatest(acc["upto"], s["end"]).alias("upto")),
                       lambda acc: acc["n"])


def _judged(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    read, hits = contamination(docs, items, **options)
    found = hits.groupBy("rid").agg(covered(F.collect_set(F.struct("start", "end"))).alias("n_hit"),
                                    F.array_sort(F.collect_set("item_id")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return read.join(found, "rid", "left").select(
        "doc_id", "t_hash", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (ids as sorted strings), contaminated.

    Options and special cases as in :func:`contamination`; empty tables give no rows or no hits.
    """
    return _judged(docs, items, **options).drop("t_hash")


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = _judged(docs, items, id_col=id_col, text_col=text_col, **options).filter("contaminated")
    bad = saved(bad.select(F.col("doc_id").alias("of"), F.col("t_hash").alias("of_hash")).distinct(), "bench-contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("t_hash") == F.col("of_hash"))
    return packed(docs, id_col, text_col).join(bad, same, "left_anti").select("row.*")


ORACLE_SQL = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), {SPAN}) AS m, unnest(list_transform(range(1, len(w) - least(len(w), {SPAN}) + 2), lambda i: array_to_string(w[i:i + least(len(w), {SPAN}) - 1], ' '))) AS g
        FROM items WHERE len(w) > 0),
lens AS (SELECT DISTINCT m FROM win),
dg AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM words, lens WHERE len(w) >= m),
hit AS (SELECT DISTINCT dg.doc_id, dg.i, dg.m, win.item_id FROM dg JOIN win ON dg.g = win.g AND dg.m = win.m),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN cover USING (doc_id) LEFT JOIN who USING (doc_id)
"""
