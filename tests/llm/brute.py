"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def secrets(text):
    text = text or ""
    found = []
    for rank, (kind, pattern, group, least, flags) in enumerate(
        [
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.I | re.A),
            ("access", r"AKIA[A-Z0-9]+", 0, 18, 0),
            ("hex", r"[0-9a-f]+", 0, 16, 0),
        ]
    ):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    spans = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    n = Counter(k for *_, k in found)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(spans.encode()).hexdigest(), spans


def substring(docs, size=13):
    """docs: (doc_id, text). Rows (doc_id, n_words, n_removed, sha) in order of input."""
    least = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            if i is not None:
                least[g] = min(least.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            if g in least and (i is None or least[g] < i):
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, size=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def classes(docs, threshold=0.8):
    """Rows (doc_id, class_id, n_links) in order of input."""
    sets = [shingles(t) for _, t in docs]
    up, links = list(range(len(docs))), Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)].append(d)
    return [(d, min(least[root(i)], default=None), links[i]) for i, (d, _) in enumerate(docs)]


def edits(a, b):
    """Edit distance; a column of the table is held as two numbers of len(a) bits (steps up and steps down)."""
    if not a or not b:
        return len(a) + len(b)
    at, full, top = {}, (1 << len(a)) - 1, 1 << len(a) - 1
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    up, down, n = full, 0, len(a)
    for y in b:
        m = at.get(y, 0)
        same = ((m & up) + up ^ up) | m | down
        plus, minus = (down | ~(same | up)) & full, same & up & full
        n += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(same | plus)) & full, plus & same & full
    return n


def norm(line):
    return re.sub(r"[^\w]+|_+", " ", line.lower()).strip(" ")


def simhash(words, half=0, bits=56):
    """Bits that more than half of the words' hashes have."""
    import xxhash

    seed = xxhash.xxh64(half.to_bytes(4, "little"), seed=42).intdigest()
    hs = [xxhash.xxh64(w.encode(), seed=seed).intdigest() for w in words]
    return sum(1 << b for b in range(bits) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def similar_lines(lines, least=0.8):
    """All pairs of lines with few enough edits; nothing but the edits is asked."""
    for i, x in enumerate(lines):
        for y in lines[:i]:
            most = int((1 - least) * max(len(x), len(y)) + 1e-9)
            if abs(len(x) - len(y)) <= most and edits(x, y) <= most:
                yield x, y


def line_dedup(docs, least=0.8, chars=20):
    """docs: (doc_id, text), ids and texts not null. {doc_id: kept text}."""
    occ = [(d, n, norm(raw)) for d, t in docs for n, raw in enumerate(t.split("\n")) if len(norm(raw)) >= chars]
    distinct = sorted({x for *_, x in occ})
    up = {x: x for x in distinct}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in similar_lines(distinct, least):
        up[root(x)] = root(y)
    gone, seen = defaultdict(set), set()
    for d, n, x in sorted(occ):
        if root(x) in seen:
            gone[d].add(n)
        seen.add(root(x))
    return {d: "\n".join(raw for n, raw in enumerate(t.split("\n")) if n not in gone[d]) for d, t in docs}


def leaks(docs, items, stretch=20, share=0.8, short=8):
    """Pairs (doc_id, item_id) with an aligned stretch of enough equal words."""
    fold = lambda t: re.sub(r"[\x00-/:-@\[-`{-\x7f]+", " ", "".join(c.lower() if c.isascii() else c for c in t or "")).split(" ")
    words = lambda t: [w for w in fold(t) if w]
    out = set()
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            size = min(stretch, len(v))
            if size < short:
                continue
            for shift in range(-len(v), len(w)):
                equal = [0 <= shift + k < len(w) and w[shift + k] == v[k] for k in range(len(v))]
                inside = [0 <= shift + k < len(w) for k in range(len(v))]
                if any(all(inside[a : a + size]) and sum(equal[a : a + size]) >= share * size for a in range(len(v) - size + 1)):
                    out.add((d, i))
                    break
    return out
