r"""Repeated lines, sentences or paragraphs across documents (operator 8).

Every unit of a text is normalised and hashed; equal digests meet globally, pre-aggregated to the
smallest rank (document id, then place in the document); every other occurrence
is a repeat. Repeats that follow one another make a run, and runs of ``run_words`` words or
more are cut out of their text; what is kept carries its original offsets.

Units: lines; paragraphs between blank lines; or, finer, the sentences of every line, so that a passage
that begins or ends inside a line is found too. A sentence ends with a word that ends
in ``.!?…`` or the like; one of fewer than SENTENCE_WORDS words belongs to the
next of its line, so where a unit begins and ends follows from the words around that place alone.

Every unit with ``min_words`` words is grouped, however short. Texts are read twice and never shuffled
by digest: only (digest, rank) rows are. A unit that a third of all documents
share is joined by broadcast (at most 511 digests can be that frequent), not gathered in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import join_hot, saved, ship
from ._words import slices

ship(__name__)

MIN_WORDS = 1        # every unit that is not blank
RUN_WORDS = 20       # words of a run of repeated units that is cut, in the registered query
SENTENCE_WORDS = 5

SPACE = r"[\x20\x09-\x0D]"
_CLOSING = r"['\")\]}»”’]"
_STOP = r"[.!?…。！？]"
_word = re.compile(r"[^\x20\x09-\x0D]+")
_stop = re.compile(rf"{_STOP}{_CLOSING}*(?:{SPACE}+|\Z)")
_blank_line = re.compile(r"\n[ \t\r]*\n")
_spaces = re.compile(r"[\x20\x09-\x0D\xA0　]+")


def normalised(unit: str) -> str:
    """Lower case, runs of white space as one blank, no white space at the ends."""
    return _spaces.sub(" ", unit.lower()).strip(" ")


def _sentences(line: str, least: int) -> list[str]:
    out, begin, last = [], 0, 0
    for m in _stop.finditer(line):
        if len(_word.findall(line, last, m.end())) >= least:
            out.append(line[begin:m.end()])
            begin = m.end()
        last = m.end()
    if begin < len(line) or not out:
        out.append(line[begin:])
    return out


def units_of(text: str, unit: str) -> list[tuple[str, int]]:
    """(unit without, length with the separator after it); the lengths add up to the text's."""
    out = []
    if unit == "paragraph":
        at = 0
        for m in _blank_line.finditer(text):
            out.append((text[at:m.start()], m.end() - at))
            at = m.end()
        return out + [(text[at:], len(text) - at)]
    lines = text.split("\n")
    for i, line in enumerate(lines):
        end = 1 if i < len(lines) - 1 else 0
        pieces = [line] if unit == "line" else _sentences(line, SENTENCE_WORDS)
        out += [(p, len(p)) for p in pieces[:-1]] + [(pieces[-1], len(pieces[-1]) + end)]
    return out


def _digests(unit: str, min_words: int):
    def run(batches):
        for b in slices(batches):
            places, digests = [], []
            for text in b.column(1).to_pylist():
                at, found = [], []
                for i, (body, _) in enumerate(units_of(text, unit) if text is not None else []):
                    if len(_word.findall(body)) >= min_words:
                        at.append(i)
                        found.append(hashlib.blake2b(normalised(body).encode(), digest_size=16).digest())
                places.append(at)
                digests.append(found)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(places, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.binary()))],
                                             ["doc_id", "t_hash", "places", "digests"])
    return run


KEPT = "array<struct<start: long, end: long, at: long>>"
_KEPT_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("at", pa.int64())]))


def cut(text: str, unit: str, gone: set[int], run_words: int) -> tuple[str, int, int, list[dict]]:
    """(what is left, units, units removed, kept spans) of a text whose units at the places ``gone`` are repeats."""
    units = units_of(text, unit)
    removed, run, size = set(), [], 0
    for i, (body, _) in enumerate([*units, ("end", 0)]):
        n = len(_word.findall(body)) if gone else 0
        if i in gone:
            run.append(i)
            size += n
        elif n:  # blank units neither belong to a run nor end it
            if size >= run_words:
                removed.update(run)
            run, size = [], 0
    kept, left, at, out = [], [], 0, 0
    for i, (_, length) in enumerate(units):
        if i not in removed and length:
            if kept and kept[-1]["end"] == at:
                kept[-1]["end"] = at + length
            else:
                kept.append({"start": at, "end": at + length, "at": out})
            left.append(text[at:at + length])
            out += length
        at += length
    return "".join(left), len(units), len(removed), kept


def _cut(unit: str, run_words: int):
    def run(batches):
        for b in slices(batches):
            rows = [(None, 0, 0, 0, []) if text is None else (lambda c: (c[0], c[1], len(gone or []), c[2], c[3]))(cut(text, unit, set(gone or []), run_words))
                    for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:4]],
                                              pa.array(columns[4], _KEPT_TYPE)], ["doc_id", "text", "n_units", "n_repeated", "n_removed", "kept"])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                min_words: int = MIN_WORDS, run_words: int = 1) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_units, n_repeated, n_removed, kept array<struct<start, end, at>>.

    ``unit``: line, sentence (of a line) or paragraph. ``kept``: the runs of the original text that stay, as
    code point offsets [start, end) there and their place ``at`` in the new text. The earliest occurrence
    is that in the smallest doc_id (null last), then, for repeated ids, in the text of the
    smallest hash, then the first in the text; repeated rows are one document, so
    all of them keep or lose the same units. ``n_repeated``: units that have an earlier occurrence; ``n_removed``: those in runs of ``run_words`` words or more, which
    are cut (1: all of them). Blank units between repeats do not end a run. Null text: null, no units. Units of
    fewer than ``min_words`` words, blank ones included, always stay. A removed
    unit goes with the separator after it. A text all of whose units go is ''.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t_hash"))
    found = saved(rows.mapInArrow(_digests(unit, min_words), "doc_id long, t_hash long, places array<int>, digests array<binary>"), "line-digests")
    found = found.select("doc_id", "t_hash", F.explode(F.arrays_zip("places", "digests")).alias("z")).select(
        "doc_id", "t_hash", F.col("z.places").alias("place"), F.col("z.digests").alias("digest"))
    # null ids come last: their flag sorts after
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_hash", "place")
    first = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first"))
    first = saved(first.filter("n > 1"), "line-first")
    again = join_hot(found, first, "digest", "n")
    again = again.filter(~F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_hash", "place").eqNullSafe(F.col("first")))
    # repeated rows give each place twice: a set
    gone = again.groupBy("doc_id", "t_hash").agg(F.collect_set("place").alias("gone"))
    gone = saved(gone.withColumnRenamed("doc_id", "of").withColumnRenamed("t_hash", "of_hash"), "line-gone")
    # a shuffle join whatever the size: the plan is the same for a small and a large corpus
    joined = rows.join(gone.hint("merge"), rows["doc_id"].eqNullSafe(F.col("of")) & (rows["t_hash"] == F.col("of_hash")), "left")
    return joined.select("doc_id", "text", "gone").mapInArrow(_cut(unit, run_words), f"doc_id long, text string, n_units long, n_repeated long, n_removed long, kept {KEPT}")


def spans(kept: Column) -> Column:
    """``kept`` as text: start-end@at, comma-joined."""
    return F.array_join(F.transform(kept, lambda k: F.format_string("%d-%d@%d", k["start"], k["end"], k["at"])), ",")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# A word that ends a sentence, and one that does not; then whole units of a line.
_T = rf"[^\x20\x09-\x0D]*{_STOP}{_CLOSING}*"
_N = rf"(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?…。！？'\")\]}}»”’]{_CLOSING}*|{_CLOSING}+)"
_UNIT = rf"{SPACE}*(?:(?:{_N}{SPACE}+){{0,{SENTENCE_WORDS - 2}}}{_T}{SPACE}+)*(?:{_N}{SPACE}+){{{SENTENCE_WORDS - 1},}}{_T}(?:{SPACE}+|\z)|(?s:.+)"
ORACLE_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS row, length(string_split(text, chr(10))) AS n_rows FROM documents),
s AS (SELECT doc_id, row, n_rows, CASE WHEN line = '' THEN [''] ELSE regexp_extract_all(line, {_sql(_UNIT)}) END AS units FROM l),
v AS (SELECT doc_id, row, n_rows, length(units) AS n_units, unnest(units) AS body, generate_subscripts(units, 1) AS i FROM s),
u AS (SELECT doc_id, body, row_number() OVER (PARTITION BY doc_id ORDER BY row, i) - 1 AS place,
             length(body) + CASE WHEN i = n_units AND row < n_rows THEN 1 ELSE 0 END AS n,
             length(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS k,
             md5(trim(regexp_replace(lower(body), '[\x20\x09-\x0D\x{{00A0}}\x{{3000}}]+', ' ', 'g'), ' ')) AS digest FROM v),
w AS (SELECT *, k >= {MIN_WORDS} AND row_number() OVER (PARTITION BY k >= {MIN_WORDS}, digest ORDER BY doc_id, place) > 1 AS again FROM u),
x AS (SELECT *, sum(CASE WHEN k > 0 AND NOT again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place) AS part FROM w),
m AS (SELECT *, again AND sum(CASE WHEN again THEN k ELSE 0 END) OVER (PARTITION BY doc_id, part) >= {RUN_WORDS} AS gone,
             sum(n) OVER (PARTITION BY doc_id ORDER BY place) AS stop FROM x),
r AS (SELECT *, sum(gone::INT) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM m),
k AS (SELECT doc_id, run, sum(n) AS n, max(stop) AS stop,
             string_agg(body || CASE WHEN n > length(body) THEN chr(10) ELSE '' END, '' ORDER BY place) AS piece
      FROM r WHERE NOT gone GROUP BY doc_id, run HAVING sum(n) > 0),
o AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY run) - n AS spot FROM k),
t AS (SELECT doc_id, string_agg(piece, '' ORDER BY run) AS text,
             string_agg((stop - n)::BIGINT || '-' || stop::BIGINT || '@' || spot::BIGINT, ',' ORDER BY run) AS kept FROM o GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_units, count(*) FILTER (again) AS n_repeated, count(*) FILTER (gone) AS n_removed FROM r GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text, coalesce(c.n_units, 0)::BIGINT AS n_units,
       coalesce(c.n_repeated, 0)::BIGINT AS n_repeated, coalesce(c.n_removed, 0)::BIGINT AS n_removed, coalesce(t.kept, '') AS kept
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)
"""
