"""Threshold-scaled document fingerprints (operator 5).

A fingerprint keeps every distinct five-word shingle hash below a fixed fraction of
the hash space. Two fingerprints of one fraction merge by union, and compare by
intersection: Jaccard likeness, or the containment of the smaller in the larger,
however unequal the documents are. A text none of whose hashes is below the
threshold keeps its smallest one, so only texts without words have an empty
fingerprint.

The query also needs each document's successor in descending id order. Documents
are dealt once, to ranges of ids, and each range is read in order with one document
held; the first document of a range goes to the range before it too. Ids alone
decide the ranges, in two small jobs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ship
from ._words import NOT_SPACE, bytes_of, distinct_by_text, shingles, slices, tokens

ship(__name__)

WORDS = 5
FRACTION = 1 / 4
SLICE = 1_000_000  # bytes of text at a time


def sketches(texts: pa.Array, words: int = WORDS, fraction: float = FRACTION) -> tuple[np.ndarray, np.ndarray]:
    """Sorted kept hashes of each text, one after the other, and their n + 1 places."""
    h, _, first = tokens(*bytes_of(texts), NOT_SPACE)
    s, of = shingles(h, first, words)
    n = len(first) - 1
    low = s < np.uint64(int(fraction * 2 ** 64))
    kept, kept_of = s[low], of[low]
    bare = np.ones(n, dtype=bool)
    bare[kept_of] = False
    rest = bare[of]
    if rest.any():  # texts without a hash below the threshold: their smallest
        o = np.lexsort((s[rest], of[rest]))
        d, v = of[rest][o], s[rest][o]
        lead = np.ones(len(d), dtype=bool)
        lead[1:] = d[1:] != d[:-1]
        kept, kept_of = np.concatenate([kept, v[lead]]), np.concatenate([kept_of, d[lead]])
    return distinct_by_text(kept, kept_of, n)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 for one."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both documents together (of texts with hashes below the threshold)."""
    return np.union1d(a, b)


def as_text(sketch: np.ndarray) -> str:
    """16 hex digits a hash, in ascending order."""
    return sketch.astype(">u8").tobytes().hex()


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                fraction: float = FRACTION) -> DataFrame:
    """One row per document: doc_id and its fingerprint as 16 hex digits a hash; null text as empty.

    Narrow: no shuffle. Repeated rows each give a row; other columns are not read.
    """
    def run(batches):
        for b in slices(batches, "text", SLICE):
            v, at = sketches(b.column(1), words, fraction)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([as_text(v[i:j]) for i, j in zip(at[:-1], at[1:])], pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _compared(words: int, fraction: float):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "in_edited"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]

    def results(ids, texts, nexts):
        """nexts: the successor of each text, by place in ``texts`` (one more than there are ids, or None)."""
        edited = []
        for i, t in enumerate(texts[:len(ids)]):
            half = len(t) // 2
            edited.append(t[:len(t) - half] + nexts[i][:half])
        v, at = sketches(pa.array(texts, pa.large_string()), words, fraction)
        e, e_at = sketches(pa.array(edited, pa.large_string()), words, fraction)
        rows = []
        for i, t in enumerate(texts[:len(ids)]):
            a, b, c = v[at[i]:at[i + 1]], e[e_at[i]:e_at[i + 1]], v[at[i + 1]:at[i + 2]]
            rows.append((ids[i], len(t), hashlib.sha256(edited[i].encode()).hexdigest(), as_text(a), as_text(b),
                         likeness(a, b), likeness(a, c), containment(a, b)))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        ids, texts, part, size = [], [], None, 0  # documents in order; the last one waits for its successor
        for b in batches:
            for doc_id, text, at, guest in zip(*(b.column(i).to_pylist() for i in range(4))):
                if at != part:  # a new range; the one before ended with a guest
                    if len(texts) > 1:
                        yield results(ids, texts, texts[1:])
                    ids, texts, part, size = [], [], at, 0
                texts.append(text)
                size += len(text)
                if not guest:
                    ids.append(doc_id)
                if size > SLICE and len(texts) > 1:
                    n = len(texts) - 1
                    yield results(ids[:n], texts, texts[1:])
                    ids, texts, size = ids[n:], texts[n:], len(texts[-1])
        if len(texts) > 1:
            yield results(ids, texts, texts[1:])

    return run


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    fraction: float = FRACTION, ranges: int | None = None) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The edited text: the last half of the code points, rounded down, replaced by as
    many of the successor's (or all of it). The successor: the next smaller doc_id, for the
    last document the first. Null ids come last. Repeated ids are in order of their
    text's hash; repeated rows follow one another. Null text: empty; an
    empty text edits to itself. near_*: Jaccard likeness of the fingerprints (two
    empty: 1, one: 0); in_edited: the share of the document's shingles found in the edited one.
    An empty table gives no rows; a single document succeeds itself.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("t_hash", F.xxhash64("text"))
    # Range bounds by id, as many as a shuffle has partitions; equal ids fall into one range.
    n = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("b")).first()["b"] or []
    cuts = np.array(sorted(set(bounds)), dtype=np.int64)

    @F.arrow_udf("int")
    def range_of(a: pa.Array) -> pa.Array:
        # descending ids: range 0 has the largest, null ids come after the smallest
        at = len(cuts) - np.searchsorted(cuts, a.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        at[a.is_null().to_numpy(zero_copy_only=False)] = len(cuts) + 1
        return pa.array(at, pa.int32())

    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "t_hash")
    heads = (rows.select(range_of("doc_id").alias("part"), place.alias("place")).groupBy("part")
             .agg(F.max("place").alias("place")).orderBy("part").collect())  # one row a range
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, in_edited double")
    if not heads:
        return spark.createDataFrame([], schema)
    # The first of a range is also the guest at the end of the range before (of the last, for range 0).
    guests = spark.createDataFrame([(heads[i - 1]["part"], h["place"]["known"], h["place"]["doc_id"], h["place"]["t_hash"]) for i, h in enumerate(heads)],
                                   "host int, known boolean, g_id long, g_hash long")
    dealt = rows.withColumn("part", range_of("doc_id"))
    marked = (dealt.join(F.broadcast(guests), dealt["doc_id"].eqNullSafe(F.col("g_id")) & (dealt["t_hash"] == F.col("g_hash")), "left")
              .withColumn("host", F.when(F.col("known").isNotNull(), F.col("host"))))
    stay = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("part"), F.lit(True).alias("guest"))
    both = marked.select("doc_id", "text", "t_hash", F.explode(F.when(F.col("host").isNull(), F.array(stay)).otherwise(F.array(stay, visit))).alias("w"))
    both = both.select("doc_id", "text", "w.part", "w.guest", "t_hash")
    ordered = both.repartitionById(len(cuts) + 2, F.col("part")).sortWithinPartitions(
        F.col("part"), F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("t_hash").desc())
    return ordered.select("doc_id", "text", "part", "guest").mapInArrow(_compared(words, fraction), schema)

