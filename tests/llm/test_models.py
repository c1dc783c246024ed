"""Language ID and quality against dense versions written out with sets, dicts and numpy."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldload.llm import langid, quality, text
from fieldload.llm.queries import op5_quality_bayes, op8_language_id

SF = "/root/testdata/sf0.001"


def grams(value: str) -> set:
    """Folded bytes, and hashed runs of 2 to 4 of them."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in value.encode())
    out = set(raw)
    for j, n in enumerate((2, 3, 4)):
        for i in range(len(raw) - n + 1):
            cell = int.from_bytes(raw[i : i + n], "big") * 0x9E3779B1 % 2**32 >> 20
            out.add(256 + j * 4096 + cell)
    return out


def test_language_equals_dense_kernels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), langid.held_out().alias("out")).collect()
    has_letter = lambda t: any(c.isalpha() for c in t or "")
    known = sorted((r["lang"], r["h"], r["doc_id"], r["text"]) for r in rows if not r["out"] and r["lang"] is not None and r["text"] is not None)
    langs = sorted({k[0] for k in known})
    known = [k for k in known if has_letter(k[3])]
    sets = [grams(k[3]) for k in known]
    marks = [i for lang in langs for i in [j for j, k in enumerate(known) if k[0] == lang][: 96 // len(langs)]]

    def kernel(a, b):
        return np.array([[len(x & y) / math.sqrt(len(x) * len(y)) for y in b] for x in a])

    held = [sets[i] for i in marks]
    k_nm, k_mm = kernel(sets, held), kernel(held, held)
    y = np.array([[k[0] == lang for lang in langs] for k in known], float)
    w = np.linalg.lstsq(k_nm.T @ k_nm + 0.5 * k_mm, k_nm.T @ y, rcond=1e-7)[0]
    asked = [r for r in rows if has_letter(r["text"])]
    value = kernel([grams(r["text"]) for r in asked], held) @ w
    want = {r["doc_id"]: (langs[v.argmax()], min(1.0, max(0.0, v.max()))) for r, v in zip(asked, value, strict=True)}
    got = op8_language_id(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want.get(r["doc_id"], ("und", 0.0))
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=2e-3)


def cells_of(value: str | None) -> list:
    """Distinct cells of the words, then the six shape cells."""
    raw = (value or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return []
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    hashes = {w: int(text.hash_words(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), 1)[0]) >> 48 for w in set(low)}
    seq = [hashes[w] for w in low]
    n, size = len(seq), len(raw)
    odd = sum(33 <= b < 127 and not chr(b).isalnum() for b in raw)
    caps = sum(65 <= b < 91 for b in raw)
    shape = (odd / size * 20, caps / size * 7.9, len(set(seq)) / n * 7.9, math.log2(n + 1) / 2, sum(map(len, low)) / n / 2,
             sum(a == b for a, b in zip(seq, seq[1:])) / n * 7.9)
    return sorted(set(seq)) + [65536 + i * 8 + min(7, int(x)) for i, x in enumerate(shape)]


def strength(groups: list) -> float:
    """``(good, n, mean)`` of each group."""
    m = sum(g[2] for g in groups) / len(groups)
    v = sum((g[0] / g[1] - g[2]) ** 2 for g in groups) / len(groups)
    between = v - m * (1 - m) * sum(1 / g[1] for g in groups) / len(groups)
    return 10_000.0 if between <= 0 else min(10_000.0, max(1.0, m * (1 - m) / between - 1))


def test_quality_equals_dense_posteriors(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)).alias("half")
    labels = {r["doc_id"]: (r["quality"], r["half"]) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", half).collect()}
    cells = {r["doc_id"]: cells_of(r["text"]) for r in docs}
    first = [(labels[i][0], c) for i, c in cells.items() if labels.get(i, (None, 1))[1] == 0]
    total = [sum(y == v for y, _ in first) for v in (0, 1)]
    count = np.ones((2, quality.WIDTH))
    for y, c in first:
        count[y, c] += 1
    odds = np.log(count[1] / (total[1] + 2)) - np.log(count[0] / (total[0] + 2))
    prior = (total[1] + 1) / (sum(total) + 4)
    parts = {i: (odds[c[:-6]].mean(), odds[c[-6:]].sum()) if c else (0.0, 0.0) for i, c in cells.items()}
    rest = [i for i in cells if labels.get(i, (None, 0))[1] == 1]
    x, y = np.array([(*parts[i], 1.0) for i in rest]), np.array([labels[i][0] for i in rest], float)
    w = np.zeros(3)
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * len(x) * np.eye(3), x.T @ (y - p) - 1e-3 * len(x) * w)
    base = math.log(prior / (1 - prior))
    evidence = {i: float(np.dot(w, (*parts[i], 1.0)) - base) if c else 0.0 for i, c in cells.items()}
    by_path, by_host = {}, {}
    for r in docs:
        p = 1 / (1 + math.exp(-evidence[r["doc_id"]] - base))
        for held, key in ((by_path, (r["source"], r["lang"])), (by_host, r["source"])):
            good, n = held.get(key, (0.0, 0))
            held[key] = (good + p, n + 1)
    overall = sum(g for g, _ in by_host.values()) / len(docs)
    s = strength([(g, n, overall) for g, n in by_host.values()])
    host = {h: (g + s * overall) / (n + s) for h, (g, n) in by_host.items()}
    s = strength([(g, n, host[h]) for (h, _), (g, n) in by_path.items()])
    path = {k: (g + s * host[k[0]]) / (n + s) for k, (g, n) in by_path.items()}
    at = {r["doc_id"]: (r["source"], r["lang"]) for r in docs}
    got = op5_quality_bayes(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        k = at[r["doc_id"]]
        odds_of = evidence[r["doc_id"]] + math.log(path[k] / (1 - path[k]))
        want = (evidence[r["doc_id"]], host[k[0]], path[k], 1 / (1 + math.exp(-odds_of)))
        assert (r["evidence"], r["host_rate"], r["path_rate"], r["probability"]) == pytest.approx(want, abs=2e-3, rel=2e-3)
