r"""Ranked lexical search by dual trees (operator 11).

A document's value at a term is w * f(tf, length), an item's is 0 or 1; the score is their
inner product. Both sides are put into trees whose nodes hold the maximum at every
term, so the product of two nodes bounds every pair below them. A pair of nodes whose
bound is under the weakest k-th score of the node's items is dropped whole; ties are kept, so the
ranking is exact.

Items are a query set of bounded blocks (``BLOCK_TERMS`` terms, whatever the number of items);
for each block the documents are read once and leave, beside their length, only the counts
of terms that some item has. Document frequencies come from those rows; a bounded part
of the documents gives each item a first k-th score, which every task starts from. Each
task puts its documents into trees of ``TREE_DOCS`` and keeps the k best of each item, and the best of all
tasks meet by item, cut to k before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import saved, ship
from ._words import LETTERS_DIGITS, binary_column, bytes_of, distinct_by_text, slices, tokens
from .decontaminate import _numbers

ship(__name__)

BEST = 10
TREE_DOCS = 4096        # documents of a tree
TREE_ENTRIES = 1_000_000  # or entries, whichever comes first
LEAF_DOCS = 4
FAN = 8
BLOCK_TERMS = 500_000   # item terms of a block
FIRST_DOCS = 16_384     # documents that give the first k-th scores, about
LEAVES_AT_ONCE = 64     # leaves scored between two looks at the k-th score


def _places(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1, one range after the other."""
    at = _places(lengths)
    return np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])


class Maxima:
    """Sparse vectors, one after the other; ``above`` gives the vectors of groups of FAN: their maximum at every term."""

    def __init__(self, at: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.at, self.terms, self.values = at, terms, values

    def __len__(self) -> int:
        return len(self.at) - 1

    def above(self, group: int, n_terms: int) -> Maxima:
        owner = np.repeat(np.arange(len(self)) // group, np.diff(self.at))
        keys = owner * np.int64(n_terms) + self.terms
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        values = np.maximum.reduceat(self.values[order], starts) if len(starts) else self.values[:0]
        keys = keys[starts]
        groups = -(-len(self) // group)
        return Maxima(np.searchsorted(keys, np.arange(groups + 1) * np.int64(n_terms)), (keys % n_terms).astype(np.int64), values)

    def dot(self, rows: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """Sum of the values at marked terms, of each of ``rows``."""
        lengths = self.at[rows + 1] - self.at[rows]
        entries = _spread(self.at[rows], lengths)
        sums = np.concatenate([[0], np.cumsum(np.where(marked[self.terms[entries]], self.values[entries], 0))])
        at = _places(lengths)
        return sums[at[1:]] - sums[at[:-1]]


class ItemTree:
    """Items in an order that puts like ones together, and levels of unions of their terms (0: the items)."""

    def __init__(self, iids: list[int], terms: list[np.ndarray], df: np.ndarray):
        # the commonest terms of an item, as a rule those of its language, then the rarest
        def key(i):
            by = terms[i][np.argsort(df[terms[i]], kind="stable")]
            return [*by[-1:-4:-1].tolist(), *by[:1].tolist()]
        order = sorted(range(len(iids)), key=key)
        self.iids = np.array([iids[i] for i in order], dtype=np.int64)
        level = Maxima(_places(np.array([len(terms[i]) for i in order])), np.concatenate([terms[i] for i in order]).astype(np.int64),
                       np.ones(sum(map(len, terms)), dtype=np.int8))
        self.levels = [level]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].above(FAN, len(df)))


class Best:
    """The k best documents of each item: score downwards, then doc_id upwards, null ids last."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, np.maximum(floor, 1)  # scores of 0 do not count
        self.scores = [np.empty(0, np.int64)] * n_items
        self.ids = [np.empty(0, np.int64)] * n_items
        self.nulls = [np.empty(0, bool)] * n_items

    def add(self, item: int, scores, ids, nulls) -> None:
        good = scores >= self.floor[item]
        if not good.any():
            return
        s, d, z = (np.concatenate([old[item], new[good]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        top = np.lexsort((d, z, -s))[:self.k]
        self.scores[item], self.ids[item], self.nulls[item] = s[top], d[top], z[top]
        if len(top) == self.k:
            self.floor[item] = max(self.floor[item], s[top[-1]])


class DocTree:
    """Documents as vectors of w * f, in order of their number of terms; levels of maxima over LEAF_DOCS, then FAN."""

    def __init__(self, ids, nulls, at, terms, values, n_terms: int):
        # documents with as many terms have maxima that say most about each of them; those without terms have no score
        order = np.argsort(np.diff(at), kind="stable")[np.count_nonzero(np.diff(at) == 0):]
        lengths = np.diff(at)[order]
        entries = _spread(at[:-1][order], lengths)
        self.ids, self.nulls = ids[order], nulls[order]
        self.docs = Maxima(_places(lengths), terms[entries], values[entries])
        self.levels = [self.docs.above(LEAF_DOCS, n_terms)]
        while len(self.levels[-1]) > FAN:
            self.levels.append(self.levels[-1].above(FAN, n_terms))
        self.n_terms = n_terms

    def search(self, items: ItemTree, best: Best) -> int:
        """Offer ``best`` every pair that no bound excludes; how many pairs were scored."""
        scored, marked = 0, np.zeros(self.n_terms, dtype=bool)

        def visit(q_level: int, q: int, d_level: int, nodes: np.ndarray) -> None:
            nonlocal scored
            level = items.levels[q_level]
            mine = level.terms[level.at[q]:level.at[q + 1]]
            width = FAN ** q_level
            floors = best.floor[q * width:(q + 1) * width]
            marked[mine] = True
            bounds = self.levels[d_level].dot(nodes, marked)
            alive = bounds >= floors.min()
            nodes, bounds = nodes[alive], bounds[alive]
            if not q_level and not d_level:
                order = np.argsort(-bounds, kind="stable")
                nodes, bounds = nodes[order], bounds[order]
                while len(nodes):
                    now, nodes, bounds = nodes[:LEAVES_AT_ONCE], nodes[LEAVES_AT_ONCE:], bounds[LEAVES_AT_ONCE:]
                    starts = now * LEAF_DOCS
                    rows = _spread(starts, np.minimum(starts + LEAF_DOCS, len(self.docs)) - starts)
                    scored += len(rows)
                    best.add(q, self.docs.dot(rows, marked), self.ids[rows], self.nulls[rows])
                    going = bounds >= best.floor[q]
                    nodes, bounds = nodes[going], bounds[going]
                marked[mine] = False
                return
            marked[mine] = False
            if not len(nodes):
                return
            if d_level:
                starts = nodes * FAN
                nodes = _spread(starts, np.minimum(starts + FAN, len(self.levels[d_level - 1])) - starts)
                d_level -= 1
            if q_level:
                for child in range(q * FAN, min((q + 1) * FAN, len(items.levels[q_level - 1]))):
                    visit(q_level - 1, child, d_level, nodes)
            else:
                visit(0, q, d_level, nodes)

        if len(self.docs):
            visit(len(items.levels) - 1, 0, len(self.levels) - 1, np.arange(len(self.levels[-1])))
        return scored


def _item_rows(batches):
    seen = 0
    for b in slices(batches):
        h, doc, first = tokens(*bytes_of(b.column(1)), LETTERS_DIGITS)
        v, at = distinct_by_text(h, doc, b.num_rows)
        yield pa.RecordBatch.from_arrays([_numbers(seen, b.num_rows), b.column(0), pa.array(np.diff(at), pa.int64()), binary_column(v, at)],
                                         ["iid", "item_id", "n_terms", "terms"])
        seen += b.num_rows


def _doc_rows(vocabulary):
    """(doc_id, n, terms, tfs): length in terms, numbers of the known terms in ascending order and their counts."""
    def run(batches):
        known = vocabulary.value
        for b in slices(batches):
            h, doc, first = tokens(*bytes_of(b.column(1)), LETTERS_DIGITS)
            place = np.searchsorted(known, h)
            place[place == len(known)] = 0
            hit = known[place] == h if len(known) else np.zeros(len(h), bool)
            keys, tf = np.unique(doc[hit] * np.int64(max(1, len(known))) + place[hit], return_counts=True)
            at = np.searchsorted(keys, np.arange(b.num_rows + 1) * np.int64(max(1, len(known))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(first), pa.int64()), binary_column((keys % max(1, len(known))).astype(np.int32), at),
                 binary_column(tf.astype(np.int32), at)], ["doc_id", "n", "terms", "tfs"])
    return run


def _numbers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """int32 values of a binary column, one after the other, and their places."""
    data, at = bytes_of(column)
    return np.frombuffer(np.ascontiguousarray(data), np.int32).astype(np.int64), at // 4


def _frequencies(n_terms: int):
    def run(batches):
        df = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            df += np.bincount(_numbers_of(b.column(0))[0], minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], ["term", "df"])
    return run


def _ranked(tree, weights, n_docs: int, n_all: int, k: int, floor):
    def run(batches):
        items, w = tree.value, weights.value
        best = Best(len(items.iids), k, floor.value.copy())
        held, entries = [], 0

        def search() -> None:
            ids = pa.concat_arrays([b.column(0) for b in held])
            n = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
            terms, at = _numbers_of(pa.concat_arrays([b.column(2) for b in held]))
            tf, _ = _numbers_of(pa.concat_arrays([b.column(3) for b in held]))
            m = 10 + (90 * n * n_docs) // n_all
            values = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(at))))
            DocTree(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), at, terms, values, len(w)).search(items, best)

        for whole in batches:
            for start in range(0, whole.num_rows, TREE_DOCS):
                b = whole.slice(start, TREE_DOCS)
                held.append(b)
                entries += int(_numbers_of(b.column(2))[1][-1])
                if sum(x.num_rows for x in held) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    search()
                    held, entries = [], 0
        if held:
            search()
        of = np.repeat(items.iids, [len(s) for s in best.scores])
        if len(of):
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.concatenate(best.ids), mask=np.concatenate(best.nulls)), pa.array(np.concatenate(best.scores))],
                                             ["iid", "doc_id", "score"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("iid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = BEST) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. N, L and document frequencies are
    those of all rows of ``docs`` (repeated rows and ids are documents of their own). Scores of 0 are
    left out. Equal scores rank by ascending doc_id, null ids last. Every row of ``items`` is an item, repeated and
    null ids too; one without terms, null or empty, has no rows, and so has every item where there are no documents. Only the named columns are read.
    """
    spark = docs.sparkSession
    source = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    kind = source.schema["item_id"].dataType.simpleString()
    wanted = saved(source.mapInArrow(_item_rows, f"iid long, item_id {kind}, n_terms long, terms binary"), "search-items")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    blocks = -(-(wanted.agg(F.sum("n_terms")).first()[0] or 0) // BLOCK_TERMS)
    out = None
    for block in range(blocks):
        part = wanted.filter((F.col("n_terms") > 0) & (F.pmod(F.xxhash64("iid"), F.lit(blocks)) == block))
        found = _search_block(spark, rows, part.select("iid", "terms"), k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "iid long, doc_id long, score long, rank int")
    # item ids alone: at most k rows an item meet one row an item
    return out.join(wanted.select("iid", "item_id"), "iid").select("item_id", "rank", "doc_id", "score")


def _search_block(spark, rows: DataFrame, part: DataFrame, k: int) -> DataFrame | None:
    """(iid, doc_id, score, rank) of a block of items: about BLOCK_TERMS terms, which the driver and every task can hold."""
    block = part.collect()
    if not block:
        return None
    hashes = [np.frombuffer(r["terms"], np.uint64) for r in block]
    vocabulary = np.unique(np.concatenate(hashes))
    sc = spark.sparkContext
    counted = saved(rows.mapInArrow(_doc_rows(sc.broadcast(vocabulary)), "doc_id long, n long, terms binary, tfs binary"), "search-terms")
    n_docs, n_all = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), dtype=np.int64)
    per_task = counted.select("terms").mapInArrow(_frequencies(len(df)), "term long, df long")
    for r in per_task.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row a term of the block
        df[r["term"]] = r["df"]
    weights = sc.broadcast(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64))
    tree = sc.broadcast(ItemTree([r["iid"] for r in block], [np.searchsorted(vocabulary, h) for h in hashes], df))

    def ranked(of: DataFrame, floor: np.ndarray) -> DataFrame:
        some = of.filter(F.octet_length("terms") > 0)
        return some.mapInArrow(_ranked(tree, weights, n_docs, n_all, k, sc.broadcast(floor)), "iid long, doc_id long, score long")

    none = np.zeros(len(tree.value.iids), dtype=np.int64)
    shares = -(-n_docs // FIRST_DOCS)
    floor = none
    if shares > 1:  # the k-th best of some documents is at most the k-th best of all: a bound, never an answer
        first = _top(ranked(counted.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(shares)) == 0), none), k)
        at = {iid: i for i, iid in enumerate(tree.value.iids.tolist())}
        floor = none.copy()
        for r in first.filter(F.col("rank") == k).collect():  # one row an item of the block
            floor[at[r["iid"]]] = r["score"]
    return saved(_top(ranked(counted, floor), k), "search-best")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH i AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
a AS (SELECT count(*) AS total, sum(n)::BIGINT AS l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * any_value(a.total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term),
s AS (SELECT i.item_id, p.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * d.n * a.total) // a.l))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term) JOIN d ON d.doc_id = p.doc_id, a GROUP BY i.item_id, p.doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= {BEST}
"""
