"""Plain single-process versions of the operators, for small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def WORDS(n, seed):  # noqa: N802
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def components(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingle_set(text, size=5):
    w = SPACED.findall((text or "").translate(_LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def near_duplicates(rows):
    """rows (doc_id, text) -> (doc_id, n_shingles, component_id, kept)"""
    sets = [(d, shingle_set(t)) for d, t in rows]
    known = [(d, s) for d, s in sets if d is not None and s]
    links = [(a, b) for i, (a, s) in enumerate(known) for b, t in known[:i] if 100 * len(s & t) >= 75 * len(s | t)]
    found = components({d for d, _ in sets if d is not None}, links)
    return [(d, len(s), found.get(d), d is None or found[d] == d) for d, s in sets]


def substrings(rows, size=20):
    """rows (doc_id, text) -> (doc_id, n_words, n_removed, sha256)"""
    rank = lambda d: (1 << 63) if d is None else d
    docs = [(rank(d), SPACED.findall(t or "")) for d, t in rows]
    least = {}
    for d, w in docs:
        for i in range(len(w) - size + 1):
            least[tuple(w[i : i + size])] = min(d, least.get(tuple(w[i : i + size]), d))
    out = []
    for (doc, _), (d, w) in zip(rows, docs):
        gone, seen = set(), set()
        for i in range(len(w) - size + 1):
            g = tuple(w[i : i + size])
            if least[g] < d or g in seen:
                gone.update(range(i, i + size))
            seen.add(g)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_strings(rows, size=400):
    """rows (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, sha256)"""
    docs = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + size] for _, b in docs for i in range(len(b) - size + 1))
    out = []
    for d, b in docs:
        gone = bytearray(len(b))
        upto = 0
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                for k in range(max(i, upto), i + size):
                    gone[k] = 1
                upto = i + size
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(rows, items, n=10):
    """rows (doc_id, text), items (item_id, text) -> (doc_id, n_words, n_hit, n_items, sha256, contaminated)"""
    known = defaultdict(set)
    for item, text in items:
        w = BENCH.findall((text or "").translate(_LOWER))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            known[tuple(w[i : i + size])].add(str(item))
    sizes = {len(k) for k in known}
    out = []
    for d, text in rows:
        w = BENCH.findall((text or "").translate(_LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in known:
                    hit.update(range(i, i + size))
                    found |= known[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out
