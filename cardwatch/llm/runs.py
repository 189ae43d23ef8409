"""Periodic runs of words within documents (operator 13).

A run is a maximal stretch of consecutive words with a smallest period q (words q apart
are the same) and at least ``max(least, 2 * q)`` words. Words are read from left to
right; each earlier occurrence of a word is a diagonal of a lag, and the diagonals that
are alive, with the place where each began, are all that is carried. A diagonal that the next word does not
continue ends, and if it is long enough its run is emitted there and then.

What keeps the table of diagonals sparse:

* a run of lag q matches itself on max(q, least - q) words or more, so an occurrence counts
  from the point where the words before it match as well: six for lags below twelve, and g
  words for lags from g to 2 * g - 1 (g = 12, 24, 48, ...);
* inside a run of period q that is long enough already, the occurrences k * q words back can only
  repeat that run, so they are passed over in one step. A text of one
  word has one diagonal, not a square of them.

Documents are independent: no shuffle, a slice of texts in memory at a time.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ship
from ._words import AS_IS, NOT_SPACE, bytes_of, grams, mix64, slices, tokens

ship(__name__)

LEAST = 12  # words of a run
RUN = "array<struct<start: long, length: long, period: long>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _repeated(values: np.ndarray, places: np.ndarray):
    """Values that occur twice or more: (places sorted by value, then place; number of the first entry of each entry's group)."""
    order = np.lexsort((places, values))
    v, p = values[order], places[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = v[1:] != v[:-1]
    single = new.copy()
    single[:-1] &= new[1:]
    v, p, new = v[~single], p[~single], new[~single]
    starts = np.flatnonzero(new)
    return v, p, np.repeat(starts, np.diff(np.append(starts, len(v))))


def _occurrences(words: np.ndarray, seed: int):
    """Per class of lags: (g, places of repeated g-grams by value, group starts, entries with an earlier place in reach)."""
    g, v, at = seed, grams(words, seed), None
    at = np.arange(len(v))
    while len(v):
        v, at, group = _repeated(v, at)
        if not len(v):
            return
        near = np.zeros(len(at), dtype=bool)
        near[1:] = (group[1:] == group[:-1]) & (at[1:] - at[:-1] < 2 * g)
        yield g, at, group, np.flatnonzero(near)
        # a gram of twice the length: two repeated ones, end to end
        by_place = np.argsort(at)
        at, v = at[by_place], v[by_place]
        second = np.searchsorted(at, at + g)
        second[second == len(at)] = 0
        both = at[second] == at + g
        v, at = mix64(v[both] * np.uint64(0xD6E8FEB86659FD93) + v[second[both]]), at[both]
        g *= 2


def runs_of(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of an array of word numbers or hashes, by start, then period."""
    seed = (least + 1) // 2
    classes, ends, kinds, entries = [], [], [], []
    for k, (g, at, group, near) in enumerate(_occurrences(words, seed)):
        classes.append((g, at.tolist(), group.tolist()))
        ends.append(at[near] + g - 1)
        kinds.append(np.full(len(near), k))
        entries.append(near)
    if not classes:
        return []
    ends, kinds, entries = np.concatenate(ends), np.concatenate(kinds), np.concatenate(entries)
    order = np.lexsort((kinds, ends))
    found: list[tuple[int, int, int]] = []
    alive: dict[int, int] = {}  # lag -> first word of its stretch
    here: dict[int, int] = {}
    last, covered, covered_soon = -2, None, None

    def step(stop: int) -> None:
        """Diagonals that did not reach ``stop`` have ended before it."""
        for lag, start in alive.items():
            if lag not in here and stop - start >= max(least, 2 * lag):
                found.append((start, stop - start, lag))

    for j, k, e in zip(ends[order].tolist(), kinds[order].tolist(), entries[order].tolist()):
        if j != last:
            step(last)
            alive, here = here, {}
            if j != last + 1:
                step(last + 1)
                alive = {}
            last, covered, covered_soon = j, None, None
        g, at, group = classes[k]
        place, low, t = at[e], group[e], e - 1
        # covered: first word of a run that holds j, of a period of at most g
        if k and covered_soon is not None:
            covered = covered_soon
        if covered is not None:
            if covered <= place - 2 * g + 1:
                continue
            t = bisect_left(at, covered, low, e) - 1
        while t >= low:
            lag = place - at[t]
            if lag >= 2 * g:
                break
            if lag >= g or not k:
                start = here[lag] = alive.get(lag, at[t])
                if j + 1 - start >= max(least, 2 * lag):
                    if covered_soon is None or start < covered_soon:
                        covered_soon = start
                    if lag <= g and (covered is None or start < covered):
                        covered = start
                        t = bisect_left(at, start, low, t)
            t -= 1
    step(last)
    alive, here = here, {}
    step(last + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _run(least: int):
    seed = (least + 1) // 2

    def run(batches):
        for b in slices(batches):
            data, at = bytes_of(b.column(1))
            h, doc, first = tokens(data, at, NOT_SPACE, AS_IS)
            # documents in which some gram of the least length comes twice; the others hold no run
            g = grams(h, seed)
            inside = doc[:len(g)] == doc[seed - 1:seed - 1 + len(g)]
            owner = doc[:len(g)][inside]
            v = np.sort(mix64(g[inside] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            twice = v[1:][v[1:] == v[:-1]]
            tagged = mix64(g[inside] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            suspects = set(owner[np.isin(tagged, twice)].tolist()) if len(twice) else set()
            runs, texts = [], []
            for i in range(b.num_rows):
                found = runs_of(h[first[i]:first[i + 1]], least) if i in suspects else []
                words = data[at[i]:at[i + 1]].tobytes().split()  # the same white space as NOT_SPACE
                texts.append(b" ".join(collapsed(words, found)))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(first), pa.int64()), pa.array(runs, RUN_TYPE), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, runs array<struct<start, length, period>>, collapsed.

    Words are runs of characters outside ASCII white space, compared as they are written. ``runs``
    are in order of start, then period, counted in words from 0. ``collapsed``: the words
    that stay when each run keeps its first period, joined by one blank. Null and
    empty texts: no words, no runs, ''. Repeated rows and ids each give a row; null ids
    stay null; only the named columns are read; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_run(least), f"doc_id long, n_words long, runs {RUN}, collapsed string")


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): with h = crc32(doc_id as text) and g = h div 10, where h mod 10 is 0 the words from a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8).

    Null ids and texts without words stay as they are.
    """
    text = F.col(f"`{text_col}`")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                       F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    times = (F.lit(3) + F.col("g") % 8).cast("int")
    period = (F.lit(1) + F.floor((n - a) / times)).cast("int")
    periodic = F.concat(F.slice("words", F.lit(1), a), F.flatten(F.array_repeat(F.slice("words", a + 1, period), times)))
    return rows.select("doc_id", F.when(n > 0, F.array_join(F.slice(periodic, F.lit(1), n), " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> list[Column]:
    """The longest run and the digests, from what ``find_runs`` returns."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    length, period = best["length"], -best["period"]
    return [F.col("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"), length.alias("length"), period.alias("period"),
            F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
