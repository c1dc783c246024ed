"""Brute-force versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, n=5):
    w = SPACE.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(docs, num=75, den=100):
    """``[(id, n, component)]`` of ``[(id, text)]`` in order."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            if a is None or docs[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (a, _) in enumerate(docs):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    return [(a, len(sets[i]), None if a is None else least[root(i)]) for i, (a, _) in enumerate(docs)]


def without_repeats(docs, window):
    """``[(id, n_words, n_removed, kept)]`` in order."""
    words = [SPACE.findall(t or "") for _, t in docs]
    first = {}
    for (a, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1) if a is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(a, first.get(key, a))
    out = []
    for (a, _), w in zip(docs, words, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1) if a is not None else ():
            if first[tuple(w[i : i + window])] < a:
                keep[i : i + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((a, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def leaks(docs, items, n=10):
    """``[(id, n_words, n_hit, items)]`` in order."""
    windows = defaultdict(set)
    for name, t in items:
        w = ALNUM.findall(lower(t))
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows[tuple(w[i : i + k])].add(None if name is None else str(name))
    out = []
    for a, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                names = windows.get(tuple(w[i : i + k]))
                if names:
                    hit |= set(range(i, i + k))
                    found |= names - {None}
        out.append((a, len(w), len(hit), sorted(found)))
    return out
