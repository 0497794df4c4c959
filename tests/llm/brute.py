"""Plain Python versions of the operators."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def jaccard(rows, n=4, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent, degree = list(range(len(rows))), collections.Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                degree[i] += 1
                degree[j] += 1
                parent[root(i)] = root(j)
    big = 2**63 - 1
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), big), big if d is None else d)
    shown = lambda x: None if x == big else x
    return collections.Counter((d, len(sets[i]), shown(least[root(i)]) if sets[i] else d, degree[i]) for i, (d, _) in enumerate(rows))


def substring(rows, window=50):
    big = 2**63 - 1
    words = [(big if d is None else d, d, [w.encode() for w in WORD.findall(t or "")]) for d, t in rows]
    least = {}
    for i, _, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, big), i)
    out = collections.Counter()
    for i, d, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))] += 1
    return out


def lines(rows, least_chars=20, least_docs=3):
    big = 2**63 - 1
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(LOWER)
    holders = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least_chars:
                holders[key(x)].add(big if d is None else d)
    out = collections.Counter()
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(holders[key(x)]) >= least_docs and max(holders[key(x)]) != (big if d is None else d))]
        out[d, len(every), len(every) - len(kept), sha("\n".join(kept).encode())] += 1
    return out


def suffixes(rows, length=200):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = collections.Counter()
    for d, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))] += 1
    return out
