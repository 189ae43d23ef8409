r"""Line-first cleaning (operator 12).

Every line with a word is held against the rules of ``LINE_RULES``; the lines that break
one are removed, and a document that loses more than ``LOSS_PERCENT`` of its word
characters, or has fewer than ``LEAST_WORDS`` words left, is rejected. Blank lines stay.
Documents are independent: no shuffle, a slice of texts in memory at a time. The rules
are expressions that Python and RE2 read alike, so ``ORACLE_SQL`` holds the same text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ship
from ._words import AS_IS, NOT_SPACE, bytes_of, grams, mix64, slices, tokens

ship(__name__)

WORD = r"[^\x20\x09-\x0D]+"
#: punctuation: a line of prose ends a sentence, quotes and brackets aside, at its own end or before a further word
ENDS = r"[.!?…。！？][\"')\]}»”’]*([\x20\x09-\x0D]|\z)"
#: navigation: separators between the entries of a menu or table, one for every MARK_SHARE words or more
SEPARATOR = r"[|»›•·]"
#: marks: words with a heap of marks, one of every MARK_SHARE words or more
MARKED = r"[^\x20\x09-\x0D]*[!?#*$%&<>=~_]{2,}[^\x20\x09-\x0D]*"
#: boilerplate: phrases of page furniture, in lines of up to BOILER_WORDS words
BOILER = (r"(?i)(javascript (is|must|required)|enable (javascript|cookies)|(uses?|accept|all) cookies|cookie (policy|settings|consent)|privacy policy|"
          r"terms (of|and) (use|service|conditions)|lorem ipsum|(sign|log) ?(in|up) (to|now|here)|subscribe (to|now)|click here|(read|load|show) more\b|"
          r"share (this|on)|back to top|skip to (main )?content|add to (cart|basket)|page \d+ of \d+)")
#: stutter: words equal to the word before, STUTTER_WORDS and one of every STUTTER_SHARE words or more
STUTTER_SHARE = 3
STUTTER_WORDS = 3
MARK_SHARE = 5
BOILER_WORDS = 25
LOSS_PERCENT = 30
LEAST_WORDS = 20
WINDOW = 8             # words of a window that may repeat
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
RULES = ("punctuation", "navigation", "marks", "stutter", "boilerplate")

_word, _marked, _separator, _boiler = (re.compile(p) for p in (WORD, MARKED, SEPARATOR, BOILER))
_heap = re.compile(r"[!?#*$%&<>=~_]{2,}")
_ends = re.compile(ENDS.replace(r"\z", r"\Z"))
_is_symbol = np.zeros(256, dtype=bool)
_is_symbol[[ord(c) for c in SYMBOLS]] = True


def broken_rule(line: str, words: list[str]) -> int | None:
    """Number in RULES of the first rule that a line breaks, given its words."""
    n_words = len(words)
    if not _ends.search(line):
        return 0
    if MARK_SHARE * len(_separator.findall(line)) >= n_words:
        return 1
    if _heap.search(line) and MARK_SHARE * len(_marked.findall(line)) >= n_words:
        return 2
    stutter = sum(map(str.__eq__, words, words[1:]))
    if stutter >= STUTTER_WORDS and STUTTER_SHARE * stutter >= n_words:
        return 3
    if n_words <= BOILER_WORDS and _boiler.search(line):
        return 4
    return None


def _lines(text: str):
    """(text of the lines that stay, lines with a word, lines removed by rule, word characters and words lost, repeated lines)."""
    kept, seen, by_rule, n_lines, lost, lost_words, repeated = [], set(), [0] * len(RULES), 0, 0, 0, 0
    for line in text.split("\n"):
        words = _word.findall(line)
        if words:
            n_lines += 1
            repeated += line in seen
            seen.add(line)
            rule = broken_rule(line, words)
            if rule is not None:
                by_rule[rule] += 1
                lost_words += len(words)
                lost += sum(map(len, words))
                continue
        kept.append(line)
    return "\n".join(kept), n_lines, by_rule, lost, lost_words, repeated


def _repeat_words(h: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Per text, words in windows of WINDOW words that its words hold twice or more."""
    g = grams(h, WINDOW)
    inside = np.flatnonzero(doc[:len(g)] == doc[WINDOW - 1:WINDOW - 1 + len(g)])
    keys = mix64(g[inside] + doc[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys) + 1, dtype=bool)
    twice[1:-1] = same
    twice[:-1] |= np.append(same, False)[:len(keys)] if len(keys) else False
    at = inside[order[twice[:-1]]]
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge)[:-1] > 0], minlength=texts).astype(np.int64)


FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("n_lines", pa.int64()), ("lost_words", pa.int64()), ("lost_chars", pa.int64()),
          *[(f"n_{r}", pa.int64()) for r in RULES], ("text", pa.string())]
_SQL_TYPES = {pa.int64(): "long", pa.string(): "string"}


def _measure(batches):
    for b in slices(batches):
        data, at = bytes_of(b.column(1))
        h, doc, first = tokens(data, at, NOT_SPACE, AS_IS)
        n = b.num_rows
        # code points in words: bytes that are neither white space nor continue a character
        points = np.concatenate([[0], np.cumsum(NOT_SPACE[data] & ((data & 0xC0) != 0x80))])
        symbols = np.concatenate([[0], np.cumsum(_is_symbol[data])])
        lines = [_lines(t or "") for t in b.column(1).to_pylist()]
        columns = [np.diff(first), points[at[1:]] - points[at[:-1]], symbols[at[1:]] - symbols[at[:-1]], [x[5] for x in lines],
                   _repeat_words(h, doc, n), [x[1] for x in lines], [x[4] for x in lines], [x[3] for x in lines],
                   *[[x[2][r] for x in lines] for r in range(len(RULES))]]
        text = pa.array([x[0] if ok else None for ok, x in zip(b.column(1).is_valid().to_pylist(), lines)], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(np.asarray(c, dtype=np.int64), pa.int64()) for c in columns], text], [f for f, _ in FIELDS])


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loss_percent: int = LOSS_PERCENT) -> DataFrame:
    """One row per document: its measures, the cleaned ``text``, ``base_failed`` and ``kept``.

    n_words, word_chars, n_symbols, n_dup_lines (lines with a word equal to an earlier one), n_repeat_words: of the
    whole text. n_lines: lines with a word; n_punctuation, n_navigation, n_marks, n_stutter, n_boilerplate: lines removed, by the
    first rule broken; lost_words, lost_chars: what went with them. ``base_failed``: fewer than 20 words, or more
    than 30 percent of them in repeated windows of 8. ``kept``: not base_failed, no more than
    ``loss_percent`` of the word characters lost, 20 words left. Null texts: no words, text
    null; empty ones ''. Repeated rows and ids each give a row, null ids too; only the named columns are read; an
    empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = rows.mapInArrow(_measure, ", ".join(f"{f} {_SQL_TYPES[t]}" for f, t in FIELDS))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(REPEAT_PERCENT) * F.col("n_words"))
    left = F.col("n_words") - F.col("lost_words") >= LEAST_WORDS
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & left & (F.lit(100) * F.col("lost_chars") <= F.lit(loss_percent) * F.col("word_chars")))


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, {_sql_text(WORD)}) AS ws FROM d),
p AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, CASE WHEN count(*) OVER v = {WINDOW} THEN string_agg(x, ' ') OVER v END AS win FROM p
      WINDOW v AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) > 1 AS twice FROM g WHERE win IS NOT NULL),
q AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM (SELECT r, i, unnest(range({WINDOW})) AS o FROM c WHERE twice) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
m AS (SELECT *, length(list_filter(list_zip(ws[1:length(ws) - 1], ws[2:]), lambda z: z[1] = z[2])) AS again_words
      FROM (SELECT *, regexp_extract_all(line, {_sql_text(WORD)}) AS ws FROM l)),
n AS (SELECT r, line, i, length(ws) AS k, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS ch,
             row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
             CASE WHEN length(ws) = 0 THEN NULL
                  WHEN NOT regexp_matches(line, {_sql_text(ENDS)}) THEN 0
                  WHEN {MARK_SHARE} * length(regexp_extract_all(line, {_sql_text(SEPARATOR)})) >= length(ws) THEN 1
                  WHEN {MARK_SHARE} * length(regexp_extract_all(line, {_sql_text(MARKED)})) >= length(ws) THEN 2
                  WHEN again_words >= {STUTTER_WORDS} AND {STUTTER_SHARE} * again_words >= length(ws) THEN 3
                  WHEN length(ws) <= {BOILER_WORDS} AND regexp_matches(line, {_sql_text(BOILER)}) THEN 4 END AS rule FROM m),
s AS (SELECT r, count(*) FILTER (k > 0) AS n_lines, count(*) FILTER (k > 0 AND again) AS n_dup_lines, sum(k) AS n_words, sum(ch) AS word_chars,
             coalesce(sum(k) FILTER (rule IS NOT NULL), 0) AS lost_words, coalesce(sum(ch) FILTER (rule IS NOT NULL), 0) AS lost_chars,
             {", ".join(f"count(*) FILTER (rule = {i}) AS n_{r}" for i, r in enumerate(RULES))},
             string_agg(line, chr(10) ORDER BY i) FILTER (rule IS NULL) AS stays FROM n GROUP BY r),
b AS (SELECT s.*, coalesce(q.n_repeat_words, 0) AS n_repeat_words,
             s.n_words < {LEAST_WORDS} OR 100 * coalesce(q.n_repeat_words, 0) > {REPEAT_PERCENT} * s.n_words AS base_failed
      FROM s LEFT JOIN q ON q.r = s.r)
SELECT d.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       length(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_lines::BIGINT AS n_lines, lost_words::BIGINT AS lost_words, lost_chars::BIGINT AS lost_chars,
       {", ".join(f"n_{r}::BIGINT AS n_{r}" for r in RULES)}, sha256(coalesce(stays, '')) AS text_sha256, base_failed,
       NOT base_failed AND n_words - lost_words >= {LEAST_WORDS} AND 100 * lost_chars <= {LOSS_PERCENT} * word_chars AS kept
FROM d JOIN b ON b.r = d.r
"""
