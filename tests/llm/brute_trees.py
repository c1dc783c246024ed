"""Brute-force Merkle manifest, all levels in memory."""

import zlib
from collections import defaultdict
from hashlib import sha256


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout=16):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def path(levels, i, fanout=16):
    """Left and right siblings, level by level."""
    out = []
    for nodes in levels[:-1]:
        start = i // fanout * fanout
        run = nodes[start : start + fanout]
        out.append(("".join(run[: i - start]), "".join(run[i - start + 1 :])))
        i //= fanout
    return out


def manifest(rows, fanout=16):
    """Of rows ``doc_id, source, lang, n_chars, text``."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]], fanout)
    top = tree([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            siblings = path(trees[s], i, fanout) + path(top, k, fanout)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            v = leaf((*r[:4], text))
            for a, b in siblings:
                v = h(a + v + b)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, h("".join(a + b for a, b in siblings)), v, v == root))
    return out
