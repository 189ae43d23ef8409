"""Language-model scores by a weighted backoff automaton (operator 7).

The model: n-grams with Dirichlet smoothing, in backoff form. A state is a context
(the last words that the model has seen together); a seen n-gram is an arc with weight
``log10((c(h w) + MU * P(w | shorter h)) / (c(h) + MU))``; any other word takes the failure arc
``log10(MU / (c(h) + MU))`` to the state of the shorter context, in the end to the root, whose
arcs are the base distribution. A text is traversed once from left to right, carrying its state
and summing weights.

No model is ever in one place. Documents are worked on in blocks of about ``BLOCK`` tokens:

1. each block numbers its words (saved: token numbers and word hashes);
2. it asks for the counts of its distinct n-grams, and contributes those of its
   training documents, as sorted hashes cut into ranges;
3. requests are merged level by level: a node of level l takes, of a group of fan**l blocks, one
   of fan**l ranges, adds up equal n-grams, and sends what it has on in ``fan`` finer ranges,
   until one group holds all blocks; answers go back the same way, in the order asked;
4. a block's answers are the part of the automaton that its texts can reach, and it traverses
   them all at once.

So a frequent n-gram is one entry a block, then one a node; every node holds about as much as one
block, and each level has blocks x fan rows, so that the exchange grows with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import saved, ship
from ._words import NOT_SPACE, bytes_of, mix64, slices, tokens

ship(__name__)

ORDER = 2
MU = 20.0
FOLDS, HELD_OUT = 5, 1
BLOCK = 2_000_000          # tokens
SHARD = 2_000_000          # n-grams of all blocks in a range of the last level, about
FAN = 256                  # ranges, and members of a group, of a level at most (some 8,000 n-grams a row)
END = np.uint64(0xE7D0000000000001)      # the token after the last word
START = np.uint64(0x57A0000000000003)    # context of the first token; no token itself


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers: how many bytes the largest needs, then the bytes of equal weight together."""
    a = np.ascontiguousarray(a.astype(np.uint64, copy=False))
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([width]) + np.ascontiguousarray(a.view(np.uint8).reshape(len(a), 8)[:, :width].T).tobytes()


def unpack(b: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :b[0]] = planes.T
    return out.view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """The first value, then the gaps."""
    return a[:1].astype(np.uint64).tobytes() + pack(a[1:] - a[:-1])


def unpack_sorted(b: bytes) -> np.ndarray:
    if len(b) < 8:
        return np.empty(0, np.uint64)
    return np.cumsum(np.append(np.frombuffer(b, np.uint64, 1), unpack(b[8:], np.uint64)), dtype=np.uint64)


def _blocks(block: int):
    """Documents to blocks: word hashes, sorted; token numbers in them (each text ends with END)."""
    def emit(number, ids, held, sizes, parts):
        h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        words, at = np.unique(h, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             pa.array([sizes], pa.list_(pa.int32())), pa.array([pack_sorted(words)], pa.large_binary()).cast(pa.binary()),
             pa.array([pack(at.astype(np.uint32))], pa.binary()), pa.array([len(h)], pa.int64())],
            ["block", "ids", "held", "sizes", "words", "tokens", "n"])

    def run(batches):
        task = TaskContext.get()
        number = np.int64(task.partitionId() if task else 0) << 32
        ids, held, sizes, parts, n = [], [], [], [], 0
        for b in slices(batches):
            h, _, first = tokens(*bytes_of(b.column(2)), NOT_SPACE)
            ids += b.column(0).to_pylist()
            held += b.column(1).to_pylist()
            sizes += (np.diff(first) + 1).tolist()
            parts.append(np.insert(h, first[1:], END))
            n += len(parts[-1])
            if n >= block:
                yield emit(int(number), ids, held, sizes, parts)
                number, ids, held, sizes, parts, n = number + 1, [], [], [], [], 0
        if ids:
            yield emit(int(number), ids, held, sizes, parts)

    return run


def _ngrams(words: np.ndarray, token: np.ndarray, sizes: np.ndarray, order: int):
    """For each order: sorted hashes of the block's distinct n-grams, and the place of each token's n-gram among them.

    An n-gram that would begin before START does not exist: place -1.
    """
    begin = np.zeros(len(token), dtype=bool)
    begin[np.cumsum(sizes) - sizes] = True
    out = [(words, token.astype(np.int64))]
    # states of order n - 1 after the token before: START has a number of its own
    state, hashes = np.empty(len(token), np.int64), np.append(words, START)
    state[1:] = token[:-1]
    state[begin] = len(words)
    for n in range(2, order + 1):
        exists = state >= 0
        code = state[exists] * (len(words) + 1) + token[exists]
        code, at = np.unique(code, return_inverse=True)
        h = mix64(hashes[code // (len(words) + 1)] * np.uint64(0xD6E8FEB86659FD93) + words[code % (len(words) + 1)] + np.uint64(n))
        rank = np.argsort(h)
        place = np.empty(len(h), np.int64)
        place[rank] = np.arange(len(h))
        here = np.full(len(token), -1, np.int64)
        here[exists] = place[at]
        out.append((h[rank], here))
        hashes = h[rank]
        state = np.full(len(token), -1, np.int64)
        state[1:] = here[:-1]
        state[begin] = -1
    return out


def _of_block(words, token, sizes, held):
    words, token, sizes = unpack_sorted(words), unpack(token, np.uint32), np.array(sizes, np.int64)
    return words, token, sizes, np.repeat(np.array(held, bool), sizes)


def _levels(parts: int, fan: int) -> tuple[int, int]:
    """Number of levels, and the fan-out that gives ``parts`` ranges or more in the last."""
    levels = 1
    while fan ** levels < parts:
        levels += 1
    out = max(2, int(parts ** (1 / levels)))
    while out ** levels < parts:
        out += 1
    return levels, out


def _cut(h: np.ndarray, parts: int):
    """(range, slice) for the ranges of sorted hashes that are not empty; those of parts * k lie within those of parts."""
    at = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    lead = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
    for a, b in zip(lead, np.append(lead[1:], len(at))):
        yield int(at[a]), slice(int(a), int(b))


#: kind: "up" (a request to node (n, grp, rng) of the next level), "map" (of node (n, grp, rng): places of a child's
#: n-grams in the node's list) or "answer" (counts for a child's range).
NODE = "kind string, n int, grp long, rng long, child long, hashes binary, counts binary, sum_c long, kinds long"
NODE_SCHEMA = pa.schema([("kind", pa.string()), ("n", pa.int32()), ("grp", pa.int64()), ("rng", pa.int64()), ("child", pa.int64()),
                         ("hashes", pa.binary()), ("counts", pa.binary()), ("sum_c", pa.int64()), ("kinds", pa.int64())])


def _rows(rows: list) -> pa.Table:
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(NODE_SCHEMA)}, NODE_SCHEMA)


def _requests(order: int, levels: int, fan: int):
    groups = fan ** (levels - 1)

    def run(batches):
        for b in batches:
            for block, words, token, sizes, held in zip(*(b.column(i).to_pylist() for i in range(5))):
                words, token, sizes, out_of = _of_block(words, token, sizes, held)
                group = int(mix64(np.array([block], np.uint64))[0] % np.uint64(groups))
                for n, (h, at) in enumerate(_ngrams(words, token, sizes, order), 1):
                    counted = np.bincount(at[(at >= 0) & ~out_of], minlength=len(h)).astype(np.uint64)
                    for r, x in _cut(h, fan):
                        yield _rows([("up", n, group, r, block, pack_sorted(h[x]), pack(counted[x]), 0, 0)]).to_batches()[0]
    return run


def _node(level: int, levels: int, fan: int):
    """One node: requests of its children merged; sent on with the children's places, at the last level answered."""
    def run(t: pa.Table) -> pa.Table:
        asked = [unpack_sorted(x) for x in t.column("hashes").to_pylist()]
        given = [unpack(x, np.uint64) for x in t.column("counts").to_pylist()]
        children = t.column("child").to_pylist()
        n, group, rng = (t.column(c)[0].as_py() for c in ("n", "grp", "rng"))
        h, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(h), np.uint64)
        np.add.at(total, at, np.concatenate(given))
        cut = np.concatenate([[0], np.cumsum([len(a) for a in asked])])
        places = [at[a:b] for a, b in zip(cut[:-1], cut[1:])]
        if level == levels:
            rows = [("answer", n, 0, rng, c, None, pack(total[p]), 0, 0) for c, p in zip(children, places)]
            rows[0] = rows[0][:7] + (int(total.sum()), int((total > 0).sum()))
            return _rows(rows)
        rows = [("map", n, group, rng, c, pack_sorted(p.astype(np.uint64)), None, 0, 0) for c, p in zip(children, places)]
        above = group % fan ** (levels - level - 1)
        rows += [("up", n, above, r, group, pack_sorted(h[x]), pack(total[x]), 0, 0) for r, x in _cut(h, fan ** (level + 1))]
        return _rows(rows)

    return run


def _hand_back(maps: pa.Table, answers: pa.Table) -> pa.Table:
    """Counts of a node's list, from its ranges in order, to each child in the order it asked."""
    got = sorted(zip(answers.column("part").to_pylist(), answers.column("counts").to_pylist()))
    total = np.concatenate([unpack(c, np.uint64) for _, c in got])
    return _rows([("answer", n, 0, rng, child, None, pack(total[unpack_sorted(places).astype(np.int64)]), 0, 0)
                  for n, rng, child, places in zip(*(maps.column(c).to_pylist() for c in ("n", "rng", "child", "hashes")))])


def _counts(blocks: DataFrame, order: int, levels: int, fan: int) -> tuple[DataFrame, int, int]:
    """(block, n, rng, counts) for every block; all training tokens; distinct ones."""
    up = blocks.select("block", "words", "tokens", "sizes", "held").mapInArrow(_requests(order, levels, fan), NODE)
    maps = []
    for level in range(1, levels + 1):
        nodes = saved(up.groupBy("n", "grp", "rng").applyInArrow(_node(level, levels, fan), NODE), "lm-nodes")
        up = nodes.filter("kind = 'up'")
        maps.append(nodes.filter("kind = 'map'").select("n", "grp", "rng", "child", "hashes"))
    total, kinds = nodes.filter("n = 1").agg(F.sum("sum_c"), F.sum("kinds")).first()
    answers = nodes.filter("kind = 'answer'")
    for level in range(levels - 1, 0, -1):
        part = answers.select("n", F.col("child").alias("grp"), F.expr(f"rng div {fan}").alias("rng"), F.col("rng").alias("part"), "counts")
        keys = ("n", "grp", "rng")
        answers = maps[level - 1].groupBy(*keys).cogroup(part.groupBy(*keys)).applyInArrow(_hand_back, NODE)
    return answers.select(F.col("child").alias("block"), "n", "rng", "counts"), total or 0, kinds or 0


def _traverse(order: int, mu: float, total: int, kinds: int, train_docs: int):
    """Scores of a block's documents: its texts and the arcs that they can take."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        got = sorted(zip(answers.column("n").to_pylist(), answers.column("rng").to_pylist(), answers.column("counts").to_pylist()))
        count = {n: np.concatenate([unpack(c, np.uint64) for k, _, c in got if k == n] or [np.empty(0, np.uint64)]).astype(float) for n in range(1, order + 1)}
        for ids, held, sizes, words, token in zip(*(blocks.column(c).to_pylist() for c in ("ids", "held", "sizes", "words", "tokens"))):
            words, token, sizes, _ = _of_block(words, token, sizes, held)
            grams = _ngrams(words, token, sizes, order)
            own = count[1][grams[0][1]]
            p = (own + 0.5) / (total + 0.5 * (kinds + 1))  # at the root
            base = np.log10(p)
            begin = np.cumsum(sizes) - sizes
            seen = np.empty(len(token))  # how often the state of the next shorter context was entered
            seen[1:] = own[:-1]
            seen[begin] = train_docs
            for n in range(2, order + 1):
                at = grams[n - 1][1]
                arc = np.where(at >= 0, count[n][at], 0.0) if len(count[n]) else np.zeros(len(token))
                # an unseen state or n-gram: only the failure arc's share of the shorter state is left
                p = np.where(at >= 0, (arc + mu * p) / (seen + mu), p)
                seen = np.zeros(len(token))
                seen[1:] = arc[:-1]
                seen[begin] = 0
            add = lambda x: np.add.reduceat(x, begin) if len(begin) else np.empty(0)
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(sizes, pa.int64()),
                 pa.array(add((own > 0).astype(np.int64)), pa.int64()), pa.array(np.full(len(sizes), total), pa.int64()),
                 pa.array(add(base), pa.float64()), pa.array(add(np.log10(p)), pa.float64())], names))
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_batches(out, schema)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mu: float = MU,
          block: int = BLOCK, shard: int = SHARD, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trained on the documents whose crc32(doc_id as text) mod 5 is not 1 (a null id trains).
    Null and empty texts are the end token alone. Repeated rows count as often as they
    appear. Without training documents every word is unknown, and the scores are the base's. Only the two named columns are read.
    """
    doc_id = F.col(f"`{id_col}`").cast("long")
    held = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), held.alias("held"), F.col(f"`{text_col}`").alias("text"))
    blocks = saved(rows.mapInArrow(_blocks(block), "block long, ids array<long>, held array<boolean>, sizes array<int>, words binary, tokens binary, n long"), "lm-blocks")
    n, train_docs = blocks.agg(F.sum("n"), F.sum(F.size(F.filter("held", lambda x: ~x)))).first()
    levels, fan = _levels(max(8, -(-(n or 0) // shard)), fan)
    answers, total, kinds = _counts(blocks, order, levels, fan)
    return (blocks.drop("n").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_traverse(order, mu, total, kinds, train_docs or 0),
                          "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
