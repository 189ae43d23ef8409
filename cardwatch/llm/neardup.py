"""Near-duplicate documents by SetSketch registers (operator 3).

A document's set is its distinct five-word shingles. Documents of equal sets are one
class from the start; everything below works on classes.

* Sketch: 64 registers; register i is the smallest of n exponential draws, truncated to a power of
  the base (``K = floor(1 - log_b(min))``), so sketches merge by maximum and equal
  registers are as likely as the sets are similar.
* Bands of registers are the buckets, as wide as the similarity allows: of four for 0.85 (two
  such sets miss all 16 bands with probability 8e-6), of three for 0.80 (21 bands, 3e-7).
* Candidates within a bucket: all pairs of a small one; in a larger one every member meets
  a few hubs (the member that shares the most bands with others, and random ones), so their number is
  linear. Links are joined into components, and larger buckets that still hold
  several components are gone through exactly, in tiles of about 512 x 512 sets: a tile
  looks at its pairs across components and returns only links that join some, so
  no rows are made for pairs.
* A candidate whose registers make the similarity implausible (likelihood ratio, jointly over
  larger, smaller and equal registers with the known set sizes) is dropped; every
  other is verified on the full sets.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._shared import SPACE_WORD, join_hot, packed, saved, ship
from ._words import NOT_SPACE, binary_column, bytes_of, distinct_by_text, mix64, shingles, slices, tokens

ship(__name__)

WORDS = 5
PERCENT = 85          # linked: 100 * intersection >= PERCENT * union
REGISTERS = 64
MISSED = 1e-5         # probability at most that a link of just the similarity asked for shares no band
BASE, RATE, TOP = 1.001, 20.0, 65534  # b, a and q of the sketch: 16-bit registers
SMALL = 16            # buckets up to this size: all pairs
TILE, TILE_SHINGLES = 512, 200_000  # sets, and shingles in them, on one side of a tile, about
TOO_FEW = 5e-8        # probability at most that the sketches of a link have too few equal registers
DOUBT = 16.0          # log likelihood ratio beyond which PERCENT is given up

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(0, 2 ** 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(percent: int) -> int:
    """Registers of a band: as many as miss no more than MISSED of the links of that similarity."""
    fit = [r for r in range(1, REGISTERS + 1) if (1 - (percent / 100) ** r) ** (REGISTERS // r) <= MISSED]
    return max(fit, default=1)


def fewest_equal(percent: int) -> int:
    """Equal registers that a link has: fewer come with probability TOO_FEW at most."""
    j, below, k = percent / 100, 0.0, 0
    while k < REGISTERS and (below := below + comb(REGISTERS, k) * j ** k * (1 - j) ** (REGISTERS - k)) <= TOO_FEW:
        k += 1
    return k


def registers(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Registers (texts x REGISTERS, uint16) of the sets v[at[i]:at[i+1]]; empty sets give zeros."""
    out = np.zeros((len(at) - 1, REGISTERS), dtype=np.uint16)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some) == 0:
        return out
    for i in range(REGISTERS):
        least = np.minimum.reduceat((v * _FACTORS[i]) >> np.uint64(32), at[some])
        draw = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
        out[some, i] = np.clip(np.floor(1.0 - np.log(draw) / np.log(BASE)), 0, TOP + 1)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _log_likelihoods(more, less, na, nb, j):
    """Log likelihood of similarity j, given how many registers of a are larger and smaller than b's."""
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: -np.log(1.0 - np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    equal = np.clip(1.0 - up - down, 1e-12, 1.0)
    return more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(equal)


def plausible(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """May pairs of sketches (rows of ka, kb) of sets of na and nb elements be linked?"""
    na, nb = na.astype(float), nb.astype(float)
    more, less = (ka > kb).sum(1), (ka < kb).sum(1)
    top = np.minimum(na, nb) / np.maximum(na, nb)
    at = percent / 100
    here = _log_likelihoods(more, less, na, nb, np.minimum(at, top))
    best = np.full(len(na), -np.inf)
    for j in np.linspace(0.0, at, 35):
        best = np.maximum(best, _log_likelihoods(more, less, na, nb, np.minimum(j, top)))
    return (top >= at) & (best - here <= DOUBT)


def _sketch_rows(words: int):
    def run(batches):
        for b in slices(batches):
            h, _, first = tokens(*bytes_of(b.column(2)), NOT_SPACE)
            v, at = distinct_by_text(*shingles(h, first, words), b.num_rows)
            k, n = registers(v, at), np.diff(at)
            # order-free 128-bit digest of a set
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(v ^ np.uint64(s)), dtype=np.uint64)]) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            digest = np.stack([s[at[1:]] - s[at[:-1]] for s in sums], 1) if len(v) else np.zeros((b.num_rows, 2), np.uint64)
            none = n == 0
            pack = lambda m: pa.array([None if e else m[i].tobytes() for i, e in enumerate(none)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pack(digest), pack(k)],
                                             ["doc_id", "t_hash", "n_shingles", "digest", "sketch"])
    return run


def _plausible_rows(percent: int):
    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            sketch = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, REGISTERS)
            ok = plausible(sketch(b.column(4)), sketch(b.column(5)), b.column(2).to_numpy(), b.column(3).to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], ["a", "b"])
    return run


def _set_rows(words: int):
    def run(batches):
        for b in slices(batches, "text"):
            h, _, first = tokens(*bytes_of(b.column(1)), NOT_SPACE)
            v, at = distinct_by_text(*shingles(h, first, words), b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), binary_column(v, at)], ["digest", "shingles"])
    return run


class _Chunk:
    """One side of a tile: ids, component numbers, sizes, sketches and sets of its classes."""

    def __init__(self, rows: list, roots: dict):
        self.ids = [r["digest"] for r in rows]
        self.root = np.array([roots.setdefault(r["root"], len(roots)) for r in rows])
        self.size = np.array([r["size"] for r in rows])
        self.sketch = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint16).reshape(-1, REGISTERS)
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.all = np.concatenate(self.sets)


def _common(own: np.ndarray, side: _Chunk, which: np.ndarray) -> np.ndarray:
    """How many elements of ``own`` (sorted) each of the sets ``which`` has."""
    if len(which) * 4 > len(side.ids):
        place = np.minimum(np.searchsorted(own, side.all), len(own) - 1)
        return np.add.reduceat((own[place] == side.all).astype(np.int64), side.at[:-1])[which]
    return np.array([len(np.intersect1d(own, side.sets[i], assume_unique=True)) for i in which])


def tile_links(left: list, right: list, same: bool, percent: int) -> list[tuple]:
    """Links across components between two chunks (or within one), each of which joined two components of the tile."""
    roots: dict = {}
    x, y = _Chunk(left, roots), _Chunk(right, roots)
    group = np.arange(len(roots))  # component numbers as the tile joins them
    found, fewest = [], fewest_equal(percent)
    for i in range(len(x.ids)):
        ok = (group[y.root] != group[x.root[i]]) & (np.minimum(y.size, x.size[i]) * 100 >= np.maximum(y.size, x.size[i]) * percent)
        if same:
            ok[:i + 1] = False
        which = np.flatnonzero(ok)
        which = which[(y.sketch[which] == x.sketch[i]).sum(1) >= fewest]
        if len(which) == 0:
            continue
        both = _common(x.sets[i], y, which)
        linked = which[100 * both >= percent * (x.size[i] + y.size[which] - both)]
        for j in linked:
            a, b = group[x.root[i]], group[y.root[j]]
            if a != b:
                group[group == b] = a
                found.append((x.ids[i], y.ids[j]))
    return found


def _tile_rows(percent: int):
    def run(batches):
        for b in batches:
            links = []
            for i in range(b.num_rows):
                links += tile_links(b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py(), percent)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in links], pa.binary()), pa.array([p[1] for p in links], pa.binary())], ["a", "b"])
    return run


def _verified(words: int, percent: int):
    """Rows in order of group; in a group first the hub (member null), then its members."""
    def run(batches):
        hub, hub_set = None, None
        for b in slices(batches, "text"):
            h, _, first = tokens(*bytes_of(b.column(2)), NOT_SPACE)
            v, at = distinct_by_text(*shingles(h, first, words), b.num_rows)
            found = []
            for i, (a, m) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                own = v[at[i]:at[i + 1]]
                if m is None:
                    hub, hub_set = a, own
                elif a == hub:
                    both = len(np.intersect1d(hub_set, own, assume_unique=True))
                    if 100 * both >= percent * (len(hub_set) + len(own) - both):
                        found.append((a, m))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], ["a", "b"])
    return run


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among candidate ``pairs`` (a, b), on full sets. ``texts``: (digest, text)."""
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    # a hub of very many members is verified in several groups
    few = 64
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / few)).cast("int")
    pairs = saved(join_hot(pairs, saved(degree, "dup-degrees"), "a", "n").select("a", "b", chunk.alias("chunk")), "dup-groups")
    members = pairs.join(texts, pairs["b"] == texts["digest"]).select("a", F.col("b").alias("member"), "text", "chunk")
    hubs = pairs.select("a", "chunk").distinct()
    hubs = hubs.join(texts, hubs["a"] == texts["digest"]).select("a", F.lit(None).cast("binary").alias("member"), "text", "chunk")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = hubs.unionByName(members).repartition(n, "a", "chunk").sortWithinPartitions("a", "chunk", F.col("member").asc_nulls_first())
    return rows.select("a", "member", "text").mapInArrow(_verified(words, percent), "a binary, b binary")


def _all_pairs(members: DataFrame) -> DataFrame:
    """All pairs of the members of small buckets, with sizes and sketches."""
    one = F.struct("digest", "size", "sketch")
    lists = members.groupBy("bucket").agg(F.array_sort(F.collect_list(one)).alias("m"))  # SMALL at most
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, F.size("m")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    return _pair_rows(lists.select(F.explode(pairs).alias("p")).select("p.x", "p.y"))


def _pair_rows(df: DataFrame) -> DataFrame:
    """(x, y) structs as candidate rows, the smaller digest second."""
    keep = F.col("x.digest") > F.col("y.digest")
    one = lambda f: F.when(keep, F.col(f"x.{f}")).otherwise(F.col(f"y.{f}"))
    two = lambda f: F.when(keep, F.col(f"y.{f}")).otherwise(F.col(f"x.{f}"))
    return df.filter("x.digest <> y.digest").select(one("digest").alias("a"), two("digest").alias("b"), one("size").alias("na"), two("size").alias("nb"),
                                                    one("sketch").alias("ka"), two("sketch").alias("kb"))


def _hub_pairs(members: DataFrame, hubs: list) -> DataFrame:
    """Every member of a bucket with each hub of the bucket; ``hubs``: orders whose largest is a hub."""
    one = ["digest", "size", "sketch"]
    agg = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.max(F.struct(order.alias("rank"), *one)).alias(f"h{i}") for i, order in enumerate(hubs)])
    agg = saved(agg.select("bucket", "n", F.array(*[F.struct(*[F.col(f"h{i}.{c}") for c in one]) for i in range(len(hubs))]).alias("hubs")), "dup-hubs")
    met = join_hot(members, agg, "bucket", "n").select(F.struct(*one).alias("y"), F.explode(F.array_distinct("hubs")).alias("x"))
    # the hub goes first, whatever the order of digests: its set is read once for many members
    return (met.filter("x.digest <> y.digest").select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b"), F.col("x.size").alias("na"), F.col("y.size").alias("nb"),
                                                      F.col("x.sketch").alias("ka"), F.col("y.sketch").alias("kb")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    component_id: the smallest doc_id reachable over links, its own included (null
    ids count for nothing, unless there is no other). kept: doc_id = component_id,
    also if both are null. Null, empty and blank texts have no shingles and are
    linked with nothing. Repeated rows are documents of one id: all have the same component. Only the two
    named columns are read.
    """
    out = _grouped(docs, id_col, text_col, words, percent)
    return (out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("low.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, of which no near-duplicate has a smaller id; of repeated rows one.

    Of several texts with the component's smallest id, that of the smallest hash stays. Texts without words all stay.
    """
    groups = saved(_grouped(docs, id_col, text_col, words, percent), "dup-groups")
    lead = groups.filter((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("t_hash") == F.col("low.t_hash")))
    keys = saved(lead.groupBy(F.col("doc_id").alias("of"), F.col("t_hash").alias("of_hash")).agg(F.count(F.lit(1)).alias("n_rows")), "dup-keys")
    met = packed(docs, id_col, text_col).join(keys, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("t_hash") == F.col("of_hash")))
    out = met.filter("n_rows = 1").select("row.*")
    if keys.filter("n_rows > 1").limit(1).count():
        out = out.unionByName(met.filter("n_rows > 1").groupBy("doc_id", "t_hash").agg(F.first("row").alias("row")).select("row.*"))
    bare = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(SPACE_WORD)
    return out.unionByName(docs.filter(~bare))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(doc_id, t_hash, n_shingles, low) of every row; low: the smallest (no_id, doc_id, t_hash) of its component."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("t_hash"), text.alias("text"))
    read = saved(rows.mapInArrow(_sketch_rows(words), "doc_id long, t_hash long, n_shingles long, digest binary, sketch binary"), "dup-sketches")
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_hash")
    classes = saved(read.filter("n_shingles > 0").groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(rep).alias("rep"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")), "dup-classes")
    found = saved(_links(classes, rows, words, percent), "dup-components")
    low = found.join(classes.select(F.col("digest").alias("node"), "rep"), "node")
    low = saved(low.groupBy("root").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("n")), "dup-roots")
    named = saved(join_hot(found, low, "root", "n").select(F.col("node").alias("digest"), F.col("rep").alias("low")), "dup-named")
    classes = saved(classes.join(named, "digest", "left").select("digest", "n", F.coalesce("low", "rep").alias("low")), "dup-named-classes")
    out = join_hot(read.filter("n_shingles > 0").select("doc_id", "t_hash", "n_shingles", "digest"), classes, "digest", "n")
    alone = read.filter("n_shingles = 0").select("doc_id", "t_hash", "n_shingles", F.lit(None).cast(classes.schema["low"].dataType).alias("low"))
    return out.select("doc_id", "t_hash", "n_shingles", "low").unionByName(alone)


def _links(classes: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of all classes that are linked with another."""
    width = band_rows(percent)
    step = 2 * width
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * step + 1, step)) for i in range(REGISTERS // width)])
    listed = classes.select("digest", F.explode(bands).alias("bucket"))
    buckets = saved(listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "dup-buckets")
    shared = saved(join_hot(saved(listed, "dup-bands"), buckets, "bucket", "n"), "dup-shared")
    # centrality: with how many others a class shares bands
    central = shared.groupBy("digest").agg(F.sum("n").alias("central"))
    members = saved(shared.join(central, "digest").join(classes.select("digest", "size", "sketch"), "digest"), "dup-members")
    small, large = members.filter(F.col("n") <= SMALL), members.filter(F.col("n") > SMALL).drop("n")
    first = _hub_pairs(large, [F.col("central"), F.xxhash64("digest", F.lit(1)), F.xxhash64("digest", F.lit(2))])
    pairs = saved(_plausible(_all_pairs(small).unionByName(first), percent), "dup-pairs")
    # texts of the classes that have candidates or are in larger buckets: read once, by id
    wanted = members.select("digest").distinct().join(classes.select("digest", "rep"), "digest")
    wanted = wanted.select("digest", F.col("rep.doc_id").alias("w_id"), F.col("rep.t_hash").alias("w_hash"))
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(F.col("w_id")) & (rows["t_hash"] == F.col("w_hash"))).select("digest", "text")
    texts = saved(texts.dropDuplicates(["digest"]), "dup-texts")
    links = saved(_verify(pairs, texts, words, percent), "dup-links")
    found = saved(components(links), "dup-found")
    open_ = _open(large, found)
    if open_.limit(1).count():
        more = saved(_tiles(open_, texts, words, percent), "dup-more-links")
        if more.limit(1).count():
            found = components(links.unionByName(more))
    return found


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(_plausible_rows(percent), "a binary, b binary").distinct()


def _open(large: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their component, of larger buckets that hold several components."""
    rooted = saved(large.join(found.withColumnRenamed("node", "digest"), "digest", "left")
                   .withColumn("root", F.coalesce("root", "digest")), "dup-rooted")
    several = (rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"),
                                            F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("who"))
               .filter("lo <> hi").dropDuplicates(["n", "who"]))  # several bands give the same members
    return saved(join_hot(rooted, saved(several.select("bucket", "n"), "dup-several"), "bucket", "n").select(*rooted.columns), "dup-open")


def _tiles(open_: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links across components within buckets, by chunks of sets that meet two by two.

    The members of a bucket's largest component are chunks of their own: they need
    not meet one another. A bucket of m members of which k are in other components makes
    about (k / TILE) * (m / TILE) tiles, of one row each.
    """
    sets = saved(texts.join(open_.select("digest").distinct(), "digest", "left_semi").mapInArrow(_set_rows(words), "digest binary, shingles binary"), "dup-sets")
    by_root = open_.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    stats = by_root.groupBy("bucket").agg(F.max(F.struct("n", "root", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    chunks = lambda n, s: F.ceil(F.greatest(n / TILE, s / TILE_SHINGLES)).cast("int")
    stats = stats.select("bucket", "n", F.col("top.root").alias("main"), chunks(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("others"),
                         chunks(F.col("top.n"), F.col("top.s")).alias("mains"))
    met = join_hot(open_, saved(stats, "dup-tile-stats"), "bucket", "n")
    place = F.xxhash64("digest")
    met = met.withColumn("chunk", F.when(F.col("root") == F.col("main"), F.col("others") + F.pmod(place, F.col("mains"))).otherwise(F.pmod(place, F.col("others"))).cast("int"))
    met = met.select("bucket", "chunk", "others", "mains", "digest", "root", "size", "sketch").join(sets, "digest")
    packed_ = saved(met.groupBy("bucket", "others", "mains", "chunk").agg(F.collect_list(F.struct("digest", "root", "size", "sketch", "shingles")).alias("c")), "dup-chunks")
    # tile (i, j), i <= j, i not of the largest component
    left = packed_.filter("chunk < others").select("bucket", F.col("chunk").alias("i"), F.col("c").alias("c1"), F.explode(F.sequence(F.col("chunk"), F.col("others") + F.col("mains") - 1)).alias("j"))
    right = packed_.select("bucket", F.col("chunk").alias("j"), F.col("c").alias("c2"), F.explode(F.sequence(F.lit(0), F.least(F.col("chunk"), F.col("others") - 1))).alias("i"))
    tiles = left.join(right, ["bucket", "i", "j"]).select("c1", "c2", (F.col("i") == F.col("j")).alias("same"))
    return tiles.mapInArrow(_tile_rows(percent), "a binary, b binary").distinct()
