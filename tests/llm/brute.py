"""Plain versions of what the operators compute, row by row."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def rows(*texts):
    return [(i, t) for i, t in enumerate(texts)]


def simhash(t, n=3):
    w = NONSPACE.findall(lower(t))
    s = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(keys, linked):
    up = list(range(len(keys)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(keys))]


def repeats(docs, window=35):
    """doc_id, n_words, n_removed, sha256 of what is left."""
    words = [(i, NONSPACE.findall(t or "")) for i, t in docs]
    seen = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def shingles(t, n=5):
    w = NONSPACE.findall(lower(t))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def places_by_first_word(seqs):
    index = defaultdict(list)
    for k, s in enumerate(seqs):
        if s:
            index[s[0]].append(k)
    return index
