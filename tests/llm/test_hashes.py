"""Texts that collide under any polynomial modulo 2**64, and workers without the package."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
from fieldload.llm import decontaminate, ngram_join, substrings, text

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") & 1] for i in range(n)]


ONE, TWO = "".join(thue_morse(2048, "a", "b")), "".join(thue_morse(2048, "b", "a"))


def hashes(column, k=1, lower=False):
    tok = text.Tokenizer(text.space_words(), lower)
    out = []
    for words in tok.chunks(pa.array(column)):
        at = words.starts_of(k)
        out += list(zip(tok.runs(words, at, at + k).tolist(), tok.runs(tok.second(words), at, at + k).tolist(), strict=True))
    return out


def test_words_and_runs_have_hashes_of_their_own():
    r = np.random.default_rng(1)
    words = {"".join(r.choice(list("abé"), size)) for size in range(1, 140) for _ in range(6)} | {ONE, TWO, ONE[:512], TWO[:512]}
    found = hashes(sorted(words))
    assert len({a for a, _ in found}) == len({b for _, b in found}) == len(words) and all(a != b for a, b in found)
    # A word's hash does not depend on its place, the chunk or the case.
    assert [h for h in hashes(["x " + " ".join(sorted(words))])[1:]] == found
    assert hashes(["AbC é"], lower=True) == hashes(["abc é"])


def test_runs_of_every_length():
    words = [f"w{i % 7}" for i in range(100)]
    for k in (1, 2, 3, 5, 8, 50, 64, 99):
        want = {}
        for i, h in enumerate(hashes([" ".join(words)], k)):
            assert want.setdefault(tuple(words[i : i + k]), h) == h
        assert len(set(want.values())) == len(want)
    a, b = (" ".join(thue_morse(2048, x, y)) for x, y in (("u", "v"), ("v", "u")))
    for k in (512, 2048):
        assert not set(hashes([a[: 2 * k - 1]], k)) & set(hashes([b[: 2 * k - 1]], k))


def test_operators_keep_colliding_texts_apart(spark):
    rows = [(1, ONE), (2, TWO), (3, " ".join([ONE[:512]] * 50)), (4, " ".join([TWO[:512]] * 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert links == {1: 1, 2: 2, 3: 3, 4: 4}
    assert all(r.n_removed == 0 for r in substrings.remove_repeats(docs).collect())
    items = spark.createDataFrame([("i", ONE)], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.find_leaks(docs, items).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_workers_need_no_copy_of_the_package(tmp_path):
    names = ["op3_ngram_jaccard", "op5_quality_bayes", "op7_substring_dedup", "op8_language_id", "op11_source_divergence", "op13_merkle_manifest"]
    script = f"""
import sys
sys.path.append({ROOT!r})
from fieldload.session import build_session
spark = build_session("local[4]", 4)
from fieldload.llm.queries import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""
    (tmp_path / "elsewhere.py").write_text(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "elsewhere.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names, done.stderr[-2000:]
