"""Slow, plain versions of the operators, in Python, for small tables."""

import collections
import hashlib
import math
import re
import zlib

def frame(spark, rows, schema="doc_id long, text string", extra="hash"):
    """Rows as a table in three partitions, with one more column, of a name that operators use inside."""
    df = spark.createDataFrame([tuple(r) + ("x",) for r in rows], f"{schema}, `{extra}` string")
    return df.repartition(3)


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(t):
    return (t or "").translate(LOW)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def letters(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def shingle_set(t, k=5):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(docs):
    """[(doc_id, text)] -> {(doc_id, text): (n_shingles, component)}; all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        low[find(i)].append(d)
    pick = {r: min((d for d in ds if d is not None), default=None) for r, ds in low.items()}
    return [(d, len(sets[i]), pick[find(i)], d == pick[find(i)]) for i, (d, _) in enumerate(docs)]


def decontaminate(docs, items):
    windows = collections.defaultdict(set)
    for item, t in items:
        w = letters(t)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i:i + m])].add("null" if item is None else str(item))
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, who = letters(t), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit.update(range(i, i + m))
                    who |= windows[tuple(w[i:i + m])]
        out.append((d, len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def edited(docs):
    """Texts in descending id order, nulls last -> (id, n_chars, sha256 of the edited text)."""
    docs = [(d, t or "") for d, t in docs]
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        half = len(t) // 2
        e = t[:len(t) - half] + order[(i + 1) % len(order)][1][:half]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return out


def language_model(docs, mu):
    text = [words(t) + ["</s>"] for _, t in docs]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    c, pairs, starts = collections.Counter(), collections.Counter(), 0
    for w, h in zip(text, held):
        if not h:
            c.update(w)
            pairs.update(zip(["<s>"] + w, w))
            starts += 1
    n, kinds = sum(c.values()), len(c)
    out = []
    for (d, _), w, h in zip(docs, text, held):
        base = score = 0.0
        for u, x in zip(["<s>"] + w, w):
            p = (c[x] + 0.5) / (n + 0.5 * (kinds + 1))
            base += math.log10(p)
            score += math.log10((pairs[u, x] + mu * p) / ((starts if u == "<s>" else c[u]) + mu))
        out.append((d, h, len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out


def line_dedup(docs, min_words=1):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        if t is None:
            out.append((d, None, 0, 0))
            continue
        kept, gone, lines = [], 0, t.split("\n")
        for i, line in enumerate(lines):
            key = re.sub(r"[\s 　]+", " ", line.lower()).strip(" ")
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= min_words:
                if key in seen:
                    gone += 1
                    continue
                seen.add(key)
            kept.append(line + ("\n" if i < len(lines) - 1 else ""))
        out.append((d, "".join(kept), len(lines), gone))
    return out


def sentence_dedup(docs, run_words):
    """[(doc_id, text)] with distinct ids -> [(doc_id, text left, units, repeated, removed)]; units are the sentences of lines."""
    stop = re.compile(r"""[.!?…。！？]['")\]}»”’]*$""")
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        if t is None:
            out.append((d, None, 0, 0, 0))
            continue
        units = []  # (unit with what follows it, words)
        for line in re.findall(r"[^\n]*\n|[^\n]+$|$", t)[:t.count("\n") + 1]:
            pieces, now, since = [], "", 0
            for m in re.finditer(r"[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*", line):
                now += m[0]
                since += 1
                if stop.search(m[1]):
                    if since >= 5:
                        pieces.append(now)
                        now = ""
                    since = 0
            if now:
                pieces.append(now)
            units += pieces or [line]
        keys = [re.sub(r"[\x20\x09-\x0D\xa0\u3000]+", " ", u.lower()).strip(" ") for u in units]
        sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", u)) for u in units]
        again = []
        for k, n in zip(keys, sizes):
            again.append(n > 0 and k in seen)
            if n:
                seen.add(k)
        gone, run = set(), []
        for i in [*range(len(units)), None]:
            if i is not None and (again[i] or not sizes[i]):
                run += [i] if again[i] else []
                continue
            if sum(sizes[j] for j in run) >= run_words:
                gone.update(run)
            run = []
        out.append((d, "".join(u for i, u in enumerate(units) if i not in gone), len(units), sum(again), len(gone)))
    return out
