"""N-gram Jaccard join, substring dedup, decontamination and top-k search against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import brute

from fieldload.llm import components, decontaminate, ngram_join, sketch, substrings, text, topk
from fieldload.llm.queries import table
from fieldload.operators.stage import cut

DOCS = "doc_id long, text string"


def prose(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=3):
    """Exact and near copies, chains, shared passages, short, odd and null rows."""
    rng = random.Random(seed)
    rows, passage, i = [], prose(rng, 60), 0
    for _ in range(12):
        base = prose(rng, rng.choice([3, 5, 20, 80, 300]))
        family = base
        for _ in range(rng.randrange(1, 9)):
            rows.append((i, " ".join(family)))
            i += 1
            family = list(family)
            for _ in range(rng.randrange(0, 3)):
                family[rng.randrange(len(family))] = f"x{rng.randrange(9999)}"
    for _ in range(15):
        own = prose(rng, 150)
        rows.append((i, " ".join(own[:70] + passage + own[70:]).upper() if i % 2 else "\t".join(own[:70] + passage + own[70:])))
        i += 1
    for t in (None, "", " \n ", "one", "one", "Two words", "two words", "é é é é é é é", "a a a a a a a a a a"):
        rows.append((i, t))
        i += 1
    rows += [(None, rows[0][1]), (None, None), rows[1], (rows[2][0], "another text under one id"), (i, " ".join(prose(rng, 30_000)))]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus()
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.components(rows), key=str)


def test_components_with_every_ngram_frequent(spark, monkeypatch):
    """The route of frequent n-grams alone gives the same links."""
    monkeypatch.setattr(ngram_join, "frequency_classes", lambda counts: (counts > 1).astype(np.uint8))
    rows = corpus(5)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.components(rows), key=str)


def test_major_component_does_not_depend_on_row_order(spark):
    """Both sides of the join of split groups must exclude the same component, whichever order ties arrive in."""
    rows = [(g, c) for g in range(40) for c in (g, g + 1, g + 2)] + [(99, 5), (99, 5), (99, 7), (98, 1), (98, 1)]
    want = {g: g + 2 for g in range(40)} | {99: 5}
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for some in (rows, rows[::-1]):
            got = ngram_join.majors(spark.createDataFrame(some, "gram long, comp long").coalesce(1)).collect()
            assert {r["gram"]: r["major"] for r in got} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_major_component_is_chosen_once(spark, monkeypatch):
    """The choice is written before the two sides of the join read it."""
    written = []
    monkeypatch.setattr(ngram_join, "cut", lambda df, name: written.append(name) or cut(df, name))
    ngram_join.jaccard_components(spark.createDataFrame(corpus(), DOCS))
    assert written.count("majors") == 1


def test_components_of_a_hot_group(spark):
    """A third of all rows are near copies of one text, many of them linked only through others."""
    rng = random.Random(1)
    base = prose(rng, 120)
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(i % 7):
            words[rng.randrange(120)] = f"z{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(prose(rng, 60) + base[:10])) for i in range(240)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), min_size=1), min_size=2, max_size=12))
def test_trie_overlaps(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = ngram_join.overlaps(arrays[0], arrays[1:], 75, 100)
    assert got == [100 * len(sets[0] & s) >= 75 * len(sets[0] | s) for s in sets[1:]]


@pytest.mark.parametrize("bits", [26, 4])
def test_repeats_equal_brute_force(spark, bits):
    """A saturated sketch (4 bits) prunes nothing and loses nothing."""
    rows = corpus(7)
    got = substrings.remove_repeats(spark.createDataFrame(rows, DOCS), window=20, gram=4, sketch_bits=bits)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()]
    assert sorted(got, key=str) == sorted(brute.without_repeats(rows, 20), key=str)


def test_repeats_of_rows_with_clashing_columns(spark):
    rows = [(i, " ".join(map(str, range(60))), -1, -2, "old", "kept") for i in range(3)]
    df = spark.createDataFrame(rows, DOCS + ", n_words int, n_removed int, kept_text string, lang string")
    got = sorted(map(tuple, substrings.remove_repeats(df).collect()))
    assert [r[:2] + r[2:5] for r in got] == [
        (0, rows[0][1], "kept", 60, 0), (1, rows[0][1], "kept", 60, 60), (2, rows[0][1], "kept", 60, 60)
    ]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\né0-,", max_size=60)), max_size=12), st.booleans())
def test_tokenizer(texts, alnum):
    import pyarrow as pa

    tok = text.Tokenizer(text.alnum_words() if alnum else text.space_words(), lower=alnum)
    pattern = brute.ALNUM if alnum else brute.SPACE
    got = []
    for words in tok.chunks(pa.array(texts, pa.string())):
        for r in range(words.hi - words.lo):
            w = [words.word(i) for i in range(words.woff[r], words.woff[r + 1])]
            got.append([(x.lower() if alnum else x).decode() for x in w])
    assert got == [pattern.findall(brute.lower(t) if alnum else t or "") for t in texts]


def test_sketch_never_undercounts(spark):
    rng = random.Random(2)
    keys = [rng.getrandbits(62) for _ in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:100]], "key long")
    maps = sketch.members(df, bits=12)
    assert sketch.passes(maps, np.array(keys, np.int64).view(np.uint64), 12).all()

    def read(batches):
        for b in batches:
            yield b["key"].to_numpy().view(np.uint64)

    twice = sketch.merged(sketch.fill(df, read, 22, 2), 22, 2, sketch.repeated, 1)
    flags = sketch.passes(twice, np.array(keys, np.int64).view(np.uint64), 22)
    assert flags[:100].all() and flags[100:].mean() < 0.05


def test_membership_is_added_up_in_one_shuffle(spark, monkeypatch):
    """Tasks on the way to a bitmap, all of which the driver keeps track of."""
    calls, added = [], sketch._added
    monkeypatch.setattr(sketch, "_added", lambda *a: calls.append(a) or added(*a))
    keys = np.random.default_rng(4).integers(-(2**62), 2**62, 2000)
    maps = sketch.members(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(7))
    assert len(calls) == 1 and sketch.passes(maps, keys.view(np.uint64), 24).all()


def test_stripping_runs_one_python_step_after_another_shuffle(spark):
    """Steps stacked without a shuffle between them hold a Python worker each, for every running task."""
    out = substrings.remove_repeats(spark.createDataFrame(corpus(), DOCS))
    plan = out._jdf.queryExecution().optimizedPlan()
    stacked, todo = 0, [plan]
    while todo:
        p = todo.pop()
        below = [p.children().apply(i) for i in range(p.children().size())]
        while below and below[0].nodeName() in ("Project", "Filter") and p.nodeName() == "MapInArrow":
            below = [below[0].children().apply(i) for i in range(below[0].children().size())]
        stacked += p.nodeName() == "MapInArrow" and any(b.nodeName() == "MapInArrow" for b in below)
        todo += below
    assert stacked == 0


def test_gram_counts_reach_the_driver_in_two_bytes(spark, monkeypatch):
    seen, classes = [], ngram_join.frequency_classes
    monkeypatch.setattr(ngram_join, "frequency_classes", lambda counts: seen.append(counts.copy()) or classes(counts))
    rows = [(i, "a common text of words and " + "more " * (i % 3)) for i in range(70_000)]
    ngram_join.JaccardJoin(spark.createDataFrame(rows, DOCS), "doc_id", "text", 5, 75, 100)
    assert seen[0].itemsize == 2 and seen[0].max() == sketch.CELL_MAX
    high = seen[0] > 1000
    assert (classes(seen[0]) == classes(seen[0].astype(np.uint32))).all() and (classes(seen[0])[high] > 0).all()


def smallest(edges):
    """The smallest node of every node's component."""
    of = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in of:
        for a, b in edges:
            if a != b:
                of[a] = of[b] = min(of[a], of[b])
    return of


@pytest.mark.parametrize("edges, rounds", [
    ([], 0),
    ([(3, 3)], 0),
    ([(i, 1) for i in range(2, 40)] + [(i, 50) for i in range(51, 60)], 0),
    ([(7, 2), (2, 7), (9, 2), (2, -5)], 1),
    ([(i, i + 1) for i in range(4)], None),
    ([(i, i + 1) for i in range(0, 60, 2)] + [(i, i + 17) for i in range(40)], None),
])
def test_components_take_no_round_that_changes_nothing(spark, monkeypatch, edges, rounds):
    cuts, write = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df, name: cuts.append(write(df, name)) or cuts[-1])
    got = {r["node"]: r["comp"] for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == smallest(edges)
    if rounds is not None:
        assert len(cuts) == 1 + rounds
    assert len({frozenset(map(tuple, c.collect())) for c in cuts}) == len(cuts)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then sleeps"), (2, "Tiny item!"), (3, "Tiny item!"), (4, None),
         (5, "--"), (None, "nameless item here"), (12, "the quick brown fox jumps over the lazy dog and")]
LEAKS = [(1, "so THE quick, brown fox jumps over the lazy dog and then sleeps; yes. tiny-item tiny  item"), (2, None), (3, ""),
         (4, "the quick brown fox jumps over the lazy dog"), (5, "a nameless item here"), (5, "a nameless item here"), (None, "tiny item"),
         (6, "the quick brown fox jumps over the lazy dog and cat " * 400)]


@pytest.mark.parametrize("bound", [32 << 20, 2000])
def test_leaks_equal_brute_force(spark, bound):
    """With a small bound the item windows are scanned in blocks."""
    docs = spark.createDataFrame([(a, t, 0, "x") for a, t in LEAKS], DOCS + ", n_hit int, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_leaks(docs, items, broadcast_bytes=bound).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got]
    assert sorted(got, key=str) == sorted(brute.leaks(LEAKS, ITEMS), key=str)


@pytest.mark.parametrize("bound", [32 << 20, 2000])
def test_helper_names_may_clash(spark, bound):
    """Columns named like helpers, and like one-letter joins, come through."""
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, words, "r", "k", i, i, i) for i in range(3)], "doc_id long, text string, __row string, __key string, __0 int, s int, i int")
    found = substrings.remove_repeats(docs)
    assert found.columns[:7] == docs.columns
    assert sorted((r["doc_id"], r["n_removed"], r["__row"], r["__key"], r["__0"], r["s"], r["i"]) for r in found.collect()) == [
        (i, 0 if i == 0 else 60, "r", "k", i, i, i) for i in range(3)
    ]
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame([*ITEMS, (7, words)], "item_id long, text string"), broadcast_bytes=bound)
    assert leaks.columns[:7] == docs.columns
    assert sorted((r["doc_id"], r["n_hit"], r["__row"], r["s"], r["i"]) for r in leaks.collect()) == [(i, 60, "r", i, i) for i in range(3)]


def test_leak_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "é keep Tiny, item! rest tiny item"), (2, "clean")], DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.without_spans(decontaminate.find_leaks(docs, items)).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["é keep  ! rest  ", "clean"]
    assert [tuple(s) for s in got[0]["spans"]] == [(2, 4, 8, 18), (5, 7, 25, 34)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], DOCS)
    assert ngram_join.jaccard_components(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(some, items).select("n_words", "n_hit").collect() == [(3, 0)]
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors, vectors).count() == 0


VECTORS = [(i, [((i * 7 + j * 3) % 11 - 5) / 8.0 for j in range(6)]) for i in range(40)]
ODD = [(100, None), (101, [1.0, None]), (102, [float("nan")]), (103, [float("inf")]), (None, [1.0] * 6), (104, []), (105, [0.5, 0.25]),
       (106, [1e30] * 6), (3, VECTORS[3][1])]


def test_topk_equals_brute_force(spark):
    df = spark.createDataFrame([(a, v, "x", 1) for a, v in VECTORS + ODD], "vec_id long, embedding array<double>, score string, rank int")
    got = topk.top_k(df.where("vec_id % 5 = 0"), df, k=7, query_block=4, candidate_block=9).collect()
    held = {a: [int(np.floor(256 * x)) for x in v] for a, v in VECTORS + ODD if a is not None and a not in (100, 101, 102, 103)}
    want = []
    for q in held:
        if q % 5 == 0:
            scores = []
            for c, v in held.items():
                s = sum(x * y for x, y in zip(held[q], v, strict=False))
                scores.append((-max(-topk.LONG_MAX, min(topk.LONG_MAX, s)), c))
            scores = sorted(s for s in scores if s[1] != q)[:7]
            want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_ties_and_few_candidates(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in (9, 3, 7, 1)], "vec_id long, embedding array<float>")
    got = topk.top_k(df.where("vec_id = 7"), df, k=5).orderBy("rank").collect()
    assert [r["id"] for r in got] == [1, 3, 9]


def test_topk_sends_no_side_through_the_driver(spark):
    """The planner guesses the size of packed blocks; by its guess the copies of a side were broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    kept = {key: spark.conf.get(key, None) for key in keys}
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    try:
        for key in keys:
            spark.conf.set(key, "100m")
        found = topk.top_k(df.where("vec_id % 5 = 0"), df, k=3)
        assert len(found.collect()) == 24
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("queries", [3, 1000])
def test_topk_over_many_groups_tiles_and_sets_of_queries(spark, monkeypatch, queries):
    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "GROUPS", 5)
    monkeypatch.setattr(topk, "TILE", (2, 3))
    r = random.Random(5)
    # Many equal scores, lengths that differ, and weights of two, four and eight bytes.
    rows = [(i, [r.randrange(-2, 3) * 0.5 * 10.0 ** r.choice([0, 0, 3, 8]) for _ in range(r.randrange(5))]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df.where("vec_id % 4 = 0"), df, k=4, query_block=3, candidate_block=7)
    held = {a: [int(np.floor(256 * x)) for x in v] for a, v in rows}
    want = []
    for q in range(0, 120, 4):
        scores = [(sum(x * y for x, y in zip(held[q], v, strict=False)), c) for c, v in held.items() if c != q]
        scores = [(-max(-topk.LONG_MAX, min(topk.LONG_MAX, s)), c) for s, c in scores]
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scores)[:4])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_queries_read_whole_tables(spark):
    assert table(spark, "/root/testdata/sf0.001", "documents").count() == 200


@pytest.mark.parametrize("family, whole", [(2, 4096), (4, 4096), (4, 3)])
def test_nodes_near_families_lose_no_link(spark, monkeypatch, family, whole):
    """Families of near copies, texts that nearly link with them, and texts that link two of them."""
    monkeypatch.setattr(ngram_join, "FAMILY", family)
    monkeypatch.setattr(ngram_join, "WHOLE", whole)
    r = random.Random(family)
    docs = []
    for base in range(5):
        words = [f"b{base}w{i}" for i in range(60)]
        for copy in range(8):
            w = list(words)
            for _ in range(copy % 4):
                w[r.randrange(60)] = f"x{r.randrange(9)}"
            docs.append(w)
        for cut_at in range(30, 60, 4):
            docs.append(words[:cut_at] + [f"y{r.randrange(50)}" for _ in range(60 - cut_at)])
        docs.append(words[:55] + [f"b{(base + 1) % 5}w{i}" for i in range(5, 12)])
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(x) for x in got) == sorted(brute.components(rows))


def middling(base=0, copies=60):
    """Texts that hold most of one text each, too little to link with it or, but for some, with each other."""
    r = random.Random(base)
    words = [f"b{base}w{i}" for i in range(150)]
    rows = [" ".join(words)]
    for i in range(copies):
        w = list(words)
        for at in r.sample(range(0, 150, 5), 9 if i % 3 else 2):
            w[at] = f"y{base}-{i if i % 7 else 0}-{at}"
        rows.append(" ".join(w))
    return rows


@pytest.mark.parametrize("shared", [1, 3, 8])
def test_middling_copies_lose_no_link(spark, monkeypatch, shared):
    """Places bound what meets, whatever number of shared n-grams is asked for."""
    monkeypatch.setattr(ngram_join, "SHARED", shared)
    rows = list(enumerate([*middling(0), *middling(1, 20), *[" ".join(t.split()[:k]) for t in middling(2, 6) for k in (150, 130, 114, 100)]]))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))


def test_unlinked_copies_meet_in_few_rows(spark, monkeypatch):
    """Of n texts that share much with one text and link with none, far less than n * n / 2 rows meet."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(words)
        for at in r.sample(range(0, 150, 5), 10):
            w[at] = f"y{i}-{at}"
        rows.append((i, " ".join(w)))
    met = []
    meeting = ngram_join.JaccardJoin.meeting

    def counted(self, minor, others):
        rows = met_rows(self, minor, others)
        met.append(rows.count())
        return meeting(self, minor, others)

    met_rows = ngram_join.JaccardJoin.met
    monkeypatch.setattr(ngram_join.JaccardJoin, "meeting", counted)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))
    assert met[0] < 120 * 119 / 2


def test_sizes_and_places_beyond_two_bytes():
    for x in ([], [0, 65535], [0, 65536]):
        a = np.array(x, np.int64)
        data = ngram_join._narrow(a).tobytes()
        assert ngram_join._wide(data, len(a)).tolist() == x
