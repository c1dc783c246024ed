"""The pipeline: planted cases, stage columns, and every query against its SQL."""

import os
import random
import sys

import pytest
from llm import brute

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tests"))

import corpus_pipeline  # noqa: E402
import oracle_compare  # noqa: E402
from fieldload.llm import langid, oracle  # noqa: E402
from fieldload.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_compare.duck(SF)


@pytest.mark.parametrize("name", list(oracle.STATEMENTS))
def test_query_equals_sql(spark, con, name):
    _, problems = oracle_compare.compare(spark, con, name, QUERIES[name], oracle.STATEMENTS[name], SF)
    assert not problems


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in oracle.STATEMENTS])
def test_other_queries_give_a_row_for_each_row(spark, name):
    source = "pages" if name.startswith("op6") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_planted_cases(spark):
    """Each stage takes out what it should and leaves clean documents as they are."""
    rng = random.Random(4)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = [(i, words(rng, 120), "en", f"s{i % 3}") for i in range(40)]
    copy = clean[5][1].split()
    near = " ".join([*copy[:60], "changed", *copy[61:]])
    passage = words(rng, 55)
    planted = [(100, clean[5][1]), (101, near), (102, words(rng, 80) + " " + passage + " " + words(rng, 80)),
               (103, words(rng, 90) + " " + passage), (104, words(rng, 50) + " " + bench + " " + words(rng, 50)), (105, None), (106, "12 34"),
               (0, clean[0][1]), (None, words(rng, 70))]
    rows = clean + [(a, t, "en", "s1") for a, t in planted]
    docs = spark.createDataFrame([(a, t, lang, s, len(t or ""), 1) for a, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(
            stage(spark, docs, SF).collect(), "doc_id long, text string, lang string, source string, n_chars long"
        )
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    left = {(r["doc_id"], r["text"]): r["n_chars"] for r in docs.collect()}
    for a, t, _, _ in clean:
        assert left[a, t] == len(t)
    ids = sorted((k[0] for k in left), key=str)
    assert ids == sorted([*range(40), 102, 103, None], key=str)
    by = {k[0]: k[1] for k in left}
    assert passage in by[102] and len(by[103].split()) == 90
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(mix) == len(left) and all(r["taken"] <= 3 * r["size"] for r in mix)


def test_rows_of_one_id_with_unlike_texts_stay(spark):
    """Only rows that equal or link with a kept row go, whatever the row order."""
    rng = random.Random(9)
    a, b, c, d = (words(rng, 80) for _ in range(4))
    near = " ".join([*a.split()[:40], "changed", *a.split()[41:]])
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "de", "s", 1), (2, b, "en", "s", 1), (3, near, "en", "s", 1), (3, c, "en", "s", 1),
            (4, d, "en", "t", 1), (4, d.upper(), "en", "t", 1), (5, "", "en", "s", 0), (5, "", "en", "s", 0), (5, " ", "en", "s", 1), (None, a, "en", "s", 1)]
    found = []
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
        found.append(sorted((tuple(r) for r in dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, SF).collect()), key=str))
    assert found[0] == found[1]
    kept = [r[:3] for r in found[0]]
    want = [(1, a, "en"), (1, b, "de"), (3, c, "en"), (5, "", "en"), (5, " ", "en"), (None, a, "en")]
    assert sorted((r for r in kept if r[0] != 4), key=str) == sorted(want, key=str)
    assert [r[1].lower() for r in kept if r[0] == 4] == [d]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stage = dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"] for r in stage["ngram_jaccard"](spark, docs, SF).collect()}
    assert kept == {a for a, _, c in brute.components(rows) if a == c}
    cleaned = {r["doc_id"]: r["text"] for r in stage["substring_dedup"](spark, docs, SF).collect()}
    assert cleaned == {a: (k if n else dict(rows)[a]) for a, _, n, k in brute.without_repeats(rows, 50)}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in stage["decontamination"](spark, docs, SF).collect()}
    assert clean == {a for a, _, n, _ in brute.leaks(rows, items) if not n}


def test_run_chains_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns)
    rows = got.collect()
    total = sum(r["size"] for r in rows)
    assert rows and abs(sum(r["taken"] for r in rows) - total) < 0.05 * total


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
    assert langid.UNKNOWN == "und"
