"""Operators 11 to 13: brute force, hand-made cases, odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from test_cases import LONG, ODD, empty, prose, rows_of

from cardwatch.llm import quality, queries, runs, search
from cardwatch.llm._words import AS_IS, LETTERS_DIGITS, NOT_SPACE, mix64, tokens, bytes_of

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# 11: ranked lexical search

def ranked(docs, items, k=10):
    """All pairs, plainly: [(item_id, rank, doc_id, score)]."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(t))
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_all = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        wanted, found = set(terms(text)), []
        for (d, bag), n in zip(bags, sizes):
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * (10 + 90 * n * n_docs // n_all)))
                        for t in wanted if t in bag)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


ITEMS = [(1, "one two"), (2, prose(40, 2)), (3, None), (4, ""), (5, "É ñ 中文字"), (5, "a WARC b"), (None, "tail other"), (6, "nowhere-to-be-found"), (7, LONG)]
ITEM = "item_id long, text string"


def test_search_cases(spark):
    got = search.search(brute.frame(spark, ODD, extra="terms"), brute.frame(spark, ITEMS, ITEM, extra="iid"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got, *got.columns) == ranked(ODD, ITEMS)
    assert rows_of(search.search(brute.frame(spark, ODD), brute.frame(spark, ITEMS, ITEM), k=2), *got.columns) == ranked(ODD, ITEMS, 2)
    for docs, items in ((empty(spark), brute.frame(spark, ITEMS, ITEM)), (brute.frame(spark, ODD), empty(spark, ITEM)), (brute.frame(spark, [(1, None), (2, "")]), brute.frame(spark, ITEMS, ITEM))):
        none = search.search(docs, items)
        assert none.count() == 0 and none.columns == got.columns


def test_search_with_ties_small_trees_blocks_and_first_scores(spark, monkeypatch):
    """Many equal scores across trees, several blocks of items, first scores from a part of the documents."""
    docs = [(i, prose(3 + i % 4, i % 11)) for i in range(400)] + [(i, prose(60, i)) for i in range(400, 500)]
    items = [(f"q{i}", prose(6 + i, i % 11)) for i in range(30)]
    want = ranked(docs, items)
    assert len({(r[0], r[3]) for r in want}) < len(want)  # ties there are
    for name, value in (("TREE_DOCS", 37), ("BLOCK_TERMS", 200), ("FIRST_DOCS", 60)):
        monkeypatch.setattr(search, name, value)
    got = search.search(brute.frame(spark, docs), brute.frame(spark, items, "item_id string, text string"))
    assert rows_of(got, *got.columns) == want


def test_bounds_exclude_most_pairs_and_no_answer():
    """The trees alone, against all products: equal results, far fewer pairs."""
    r = np.random.Generator(np.random.PCG64(5))
    n_terms, n = 500, 3000
    lengths = r.integers(0, 60, n)
    terms = np.concatenate([np.sort(r.choice(n_terms, x, replace=False)) for x in lengths]).astype(np.int64)
    values = r.integers(1, 1000, len(terms)) * (1 + terms % 7 * 50)
    at = np.concatenate([[0], np.cumsum(lengths)])
    wanted = [np.sort(r.choice(n_terms, x, replace=False)) for x in r.integers(1, 12, 70)]
    tree = search.ItemTree(list(range(70)), wanted, np.bincount(terms, minlength=n_terms))
    best = search.Best(70, 10, np.zeros(70, np.int64))
    scored = search.DocTree(np.arange(n), np.zeros(n, bool), at, terms, values, n_terms).search(tree, best)
    assert scored < 0.4 * 70 * n
    dense = np.zeros((n, n_terms), np.int64)
    dense[np.repeat(np.arange(n), lengths), terms] = values
    for i, iid in enumerate(tree.iids):
        scores = dense[:, wanted[iid]].sum(axis=1)
        top = np.lexsort((np.arange(n), -scores))[:10]
        assert best.ids[i].tolist() == top.tolist() and best.scores[i].tolist() == scores[top].tolist()


def test_maxima_of_groups():
    one = search.Maxima(np.array([0, 2, 2, 4, 5]), np.array([1, 4, 1, 3, 0]), np.array([5, 2, 7, 1, 9]))
    two = one.above(3, 6)
    assert (two.at.tolist(), two.terms.tolist(), two.values.tolist()) == ([0, 3, 4], [1, 3, 4, 0], [7, 1, 2, 9])
    marked = np.isin(np.arange(6), [0, 1])
    assert two.dot(np.array([1, 0]), marked).tolist() == [9, 7] and one.dot(np.array([1]), marked).tolist() == [0]


# 12: quality rules

def test_lines_are_judged_first(spark):
    good = "\n".join(f"{prose(12, 40 + i)}." for i in range(8))
    docs = {
        1: good, 2: good + "\nHome | About | Contact | Login.", 3: good + "\nPlease accept all cookies to go on.", 4: good + "\nbuy$$$ now### or!! never&&& come.",
        5: good + "\nvery very very very good.", 6: good + "\nno sentence here", 7: good + "\nHe said \"stop.\" Then more followed", 8: "Home | About | Us.\n" * 12 + good,
        9: "\n" + good + "\n\n \n", 10: prose(19, 1) + ".", 11: "\n".join([f"{prose(10, 3)}."] * 4), 12: "Our privacy policy: " + prose(30, 7) + "."}
    got = {r.doc_id: r for r in quality.clean(brute.frame(spark, list(docs.items()), extra="n_words")).collect()}
    assert {d: r.kept for d, r in got.items()} == {d: d not in (8, 10, 11) for d in docs}
    assert {d: [got[d][f"n_{r}"] for r in quality.RULES] for d in docs} == {d: [0] * 5 for d in docs} | {
        2: [0, 1, 0, 0, 0], 3: [0, 0, 0, 0, 1], 4: [0, 0, 1, 0, 0], 5: [0, 0, 0, 1, 0], 6: [1, 0, 0, 0, 0], 8: [0, 12, 0, 0, 0]}
    assert all(got[d].text == good for d in range(2, 7)) and got[8].text == good and got[9].text == docs[9] and got[7].text == docs[7]
    assert (got[10].base_failed, got[11].base_failed, got[8].base_failed) == (True, True, True) and (got[11].n_dup_lines, got[11].n_repeat_words) == (3, 40)
    assert got[2].lost_words == 7 and got[2].lost_chars == sum(map(len, "Home | About | Contact | Login.".split()))


def test_quality_cases(spark):
    odd = ODD + [(20, "\x85 \x1c a\xa0b c #*$%&|<>"), (21, "x\n" * 3000), (None, prose(40, 5) + ".")]
    got = quality.clean(brute.frame(spark, odd, extra="base_failed"))

    def plain(d, t):
        w = WORD.findall(t or "")
        windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        return d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)

    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted((plain(*r) for r in odd), key=repr)
    texts = collections.defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append(r.text)
        assert not (r.kept and r.base_failed) and r.lost_chars <= r.word_chars
    assert texts[1] == [None] and texts[2] == [""] and texts[3] == [" \n\t "] and texts[21] == [""]
    none = quality.clean(empty(spark))
    assert none.count() == 0 and none.columns == got.columns
    strict = quality.clean(brute.frame(spark, [(1, "\n".join([prose(30, 1) + "."] + ["no end"]))]), loss_percent=0).first()
    assert not strict.kept and strict.lost_words == 2


def test_labelled_junk_goes_and_good_texts_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = quality.clean(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    n = {(r.quality, r.kept, r.base_failed): r["count"] for r in got.groupBy("quality", "kept", "base_failed").count().collect()}
    assert (0, True, False) not in n and (1, False, False) not in n and n[0, False, False] > 10


# 13: periodic runs

def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                found.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def numbered(w):
    return mix64(np.array(w, dtype=np.uint64) + np.uint64(1)) if len(w) else np.empty(0, np.uint64)


blocks = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(blocks, st.sampled_from([4, 7, 12]))
def test_runs_of_repeated_blocks(parts, least):
    w = [x for block, times in parts for x in block * times]
    assert runs.runs_of(numbered(w), least) == plain_runs(w, least)


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_runs_of_random_words(letters):
    r = random.Random(letters)
    for i in range(60):
        w = [r.randrange(letters) for _ in range(r.randrange(200))]
        p = r.randrange(1, 60)
        w = w[:40] + [w[40 + k % p] if 40 + k % p < len(w) else 9 for k in range(r.randrange(200))] + w[60:]
        assert runs.runs_of(numbered(w)) == plain_runs(w)


def test_nested_and_overlapping_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:  # the Fibonacci word: as many runs as words can hold
        a, b = b, b + a
    assert runs.runs_of(numbered(b)) == plain_runs(b) and len(plain_runs(b)) > 40
    w = ([0] * 14 + [1]) * 3 + [2, 3] * 20
    assert runs.runs_of(numbered(w)) == plain_runs(w)


def test_one_word_texts_take_no_square_of_steps():
    assert runs.runs_of(numbered([5] * 100_000)) == [(0, 100_000, 1)]
    assert runs.runs_of(numbered(([5] * 49 + [6]) * 2000))[0] == (0, 49, 1)
    assert (0, 100_000, 50) in runs.runs_of(numbered(([5] * 49 + [6]) * 2000))


def test_run_cases(spark):
    docs = ODD + [(30, "a b c " * 4 + "d"), (31, "a B a b " * 6), (32, "x\n" * 12 + "y " * 30), (33, "é\xa0é " * 12), (34, LONG + " go" * 5000)]
    got = {(r.doc_id, r.n_words): r for r in runs.find_runs(brute.frame(spark, docs, extra="runs")).collect()}
    for d, t in docs:
        w = WORD.findall(t or "")
        found = plain_runs(w) if len(w) < 2000 else [(len(w) - 5000, 5000, 1)] if d == 34 else []
        r = got[d, len(w)]
        assert [tuple(x) for x in r.runs] == found
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if i not in dropped)
    assert got[30, 13].collapsed == "a b c d" and got[32, 42].collapsed == "x y" and got[31, 24].collapsed == "a B a b"
    assert runs.find_runs(empty(spark)).count() == 0
    assert runs.find_runs(brute.frame(spark, docs)).count() == len(docs)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def run_row(doc_id, text):
    w = planted(doc_id, text)
    found = plain_runs(w)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_run_query_against_brute_force(spark):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    docs = [(d, x) for d, x in zip(t["doc_id"], t["text"])]
    got = {r.doc_id: tuple(r) for r in queries.op13_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    some = [(d, x) for d, x in docs if len(WORD.findall(x or "")) < 3000]  # brute force takes the square of the words
    assert len(some) > 0.95 * len(docs) and any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in some)
    for d, x in some:
        assert got[d] == run_row(d, x)


def test_planted_periods_of_odd_rows(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = list(zip(ids, [None, "", "  ", "one", "one two", "a b c", *[prose(n, n) for n in range(4, 60)]]))
    docs += [(None, prose(30, 1)), (ids[-1], "x y z"), (ids[-1], "x y z")]
    found = runs.find_runs(runs.with_planted_periods(brute.frame(spark, docs, extra="words")))
    got = found.select(*runs.digests(found))
    assert rows_of(got, *got.columns) == sorted((run_row(d, x) for d, x in docs), key=repr)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
                                "runs_sha256": "string", "collapsed_sha256": "string"}


def test_words_keep_their_case_where_asked():
    data = bytes_of(pa.array(["Ab ab", "ab"]))
    folded, kept = tokens(*data, NOT_SPACE)[0], tokens(*data, NOT_SPACE, AS_IS)[0]
    assert folded[0] == folded[1] == folded[2] and kept[0] != kept[1] == kept[2]
    assert len(tokens(*bytes_of(pa.array(["a@b-c"])), LETTERS_DIGITS)[0]) == 3
