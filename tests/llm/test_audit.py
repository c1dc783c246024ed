"""Source divergence, sharding and the Merkle manifest on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

from llm import brute_trees as bt
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldload.llm import divergence, merkle, shards

DOCS = "doc_id long, text string, lang string, source string, n_chars long, at string, value int, n string"


def docs(spark, rows):
    """Rows ``doc_id, text, lang, source, n_chars`` beside columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS)


# ------------------------------------------------------------ source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, top=200, scale=10**9):
    words = [(r[2] or "", r[3] or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, w in words:
        groups[lang].add(source)
        df[lang].update(set(w))
        count[lang, source].update(w)
    out = []

    def ranked(lang, source, part, found):
        found.sort(key=lambda x: (-x[0], x[1].encode()))
        out.extend((lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found))

    for lang, names in groups.items():
        kept = [t for t, n in df[lang].items() if n >= 3]
        total = Counter()
        for s in names:
            total.update({t: count[lang, s][t] for t in kept})

        def share(c):
            n = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + scale * (c[t] + 1) // n for t in kept}

        p, q = {s: share(count[lang, s]) for s in names}, share(total)
        for s in names:
            ranked(lang, s, "pair", [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s])
            found = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            ranked(lang, s, "term", found[:top])
    return sorted(out)


def audited(spark, rows, **options):
    df = divergence.audit(docs(spark, rows), **options)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def texts(seed, n, long=0):
    r = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(70)] + ["É", "日本", "Straße"]
    rows = []
    for i in range(n):
        words = [vocabulary[min(int(r.expovariate(0.1)), len(vocabulary) - 1)] for _ in range(r.randrange(60))]
        rows.append((i, " ".join(w.upper() if r.random() < 0.2 else w for w in words), f"l{i % 2}", f"s{r.randrange(5)}", 1))
    return rows + [(n, "wa wb " * long, "l0", "s1", 1)]


def test_audit_equals_brute_force(spark):
    rows = texts(3, 80, 3000) + [
        (None, None, None, None, None), (1, "", "l0", "only", 0), (1, "12 _ -", "l1", None, 0), (2, "wa", None, "s0", 2), (2, "wa", None, "s0", 2), (2, "wa wa", None, "s0", 2),
    ]
    got = audited(spark, rows)
    assert got == brute_audit(rows)
    assert ("", "", "pair", "s0") in {r[:4] for r in got}


def test_audit_ranks_are_cut_and_ties_ordered(spark):
    rows = [(i, "é gamma beta alpha", "l", "a", 1) for i in range(3)] + [(i, "zeta zeta", "l", "b", 1) for i in range(3, 6)]
    got = audited(spark, rows, top_terms=2)
    assert got == brute_audit(rows, top=2)
    assert [r[3] for r in got if r[2] == "term" and r[1] == "a"] == ["alpha", "beta"]


def test_audit_without_kept_terms(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(1, "a b", "l", "s", 1), (2, "a", "l", "t", 1)]) == [("l", "s", "pair", "t", 0, 1), ("l", "t", "pair", "s", 0, 1)]


def test_products_tile_by_tile(monkeypatch):
    r = np.random.default_rng(1)
    counts = np.where(r.random((300, 7)) < 0.6, 0, r.integers(0, 40, (300, 7)))
    sizes = counts.sum(0) + 300
    whole = divergence.priced(counts, counts.sum(1), sizes, 10**9)
    want = [[sum((divergence.shares(counts[:, g], sizes[g], 10**9) - (q := divergence.shares(counts[:, h], sizes[h], 10**9))) ** 2 // q) for h in range(7)] for g in range(7)]
    assert (whole == np.array(want) * (1 - np.eye(7, dtype=int))).all()
    monkeypatch.setattr(divergence, "TILE", 30)
    monkeypatch.setattr(divergence, "COMMON_TERMS", 5)
    assert (divergence.priced(counts, counts.sum(1), sizes, 10**9) == whole).all()


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 1 << 61), st.integers(1, 1 << 61))
def test_shares_stay_exact_beyond_64_bits(spark, count, more):
    total = count + more
    want = 1 + 10**9 * (count + 1) // total
    assert divergence.shares(np.array([count]), np.array([total]), 10**9)[0] == want
    row = spark.range(1).select(divergence.share(F.lit(count).cast("long"), F.lit(total).cast("long")).alias("p")).first()
    assert row["p"] == want


# ------------------------------------------------------------ sharding


def sharded(spark, rows, n=5, base=None, slots=64):
    return shards.shard(docs(spark, rows), n, base, slots).collect()


def test_shards_hold_near_equal_bytes(spark, tmp_path):
    r = random.Random(1)
    rows = [(i, "é" * r.randrange(200), "l", "hot" if i % 3 else "s", 1) for i in range(2000)]
    rows += [(7, "same", "l", "hot", 1)] * 1000 + [(None, None, None, None, None), (None, "", "l", "s", 1), (5000, "x" * 20000, "l", "s", 1)]
    got = sharded(spark, rows, 4, slots=1024)
    assert len(got) == len(rows)
    load, places = Counter(), defaultdict(list)
    for x in got:
        load[x["shard"]] += x["size"]
        places[x["shard"]].append(x["slot"])
    assert sorted(load) == [0, 1, 2, 3] and max(load.values()) - min(load.values()) < 500
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # Copies of one record are spread.
    assert max(Counter(x["shard"] for x in got if x["doc_id"] == 7).values()) < 400
    nulls = [x for x in got if x["doc_id"] is None]
    assert [(x["size"], x["text_crc32"]) for x in nulls] == [(8, 0)] * 2
    again = sharded(spark, rows, 4, slots=1024)
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_places_do_not_depend_on_ranges(spark):
    rows = [(i, "t" * (i % 50), "l", "s", 1) for i in range(500)]
    found = shards.records(docs(spark, rows), 8)
    slot_map = shards.first_map(spark, 3, 8)
    want = sorted(map(str, shards.place(found, slot_map).collect()))
    assert sorted(map(str, shards.place(found, slot_map, range_rows=7).collect())) == want


def test_map_versions_move_few_slots(spark, tmp_path):
    base = f"file://{tmp_path}/maps"
    rows = [(i, "t" * (i % 97), "l", "s", 1) for i in range(3000)]
    sharded(spark, rows, 4, base, 256)
    assert shards.versions(spark, base) == [1, 2]
    first, second = ({x["home"]: x["shard"] for x in shards.read_map(spark, base, v).collect()} for v in (1, 2))
    assert first == {i: i % 4 for i in range(256)} and set(second) == set(first)
    moved = sum(first[h] != second[h] for h in first)
    assert 0 < moved < 64
    # The next rows edit the stored map.
    sharded(spark, rows + [(i, "more", "l", "s", 1) for i in range(3000, 3100)], 4, base, 256)
    third = {x["home"]: x["shard"] for x in shards.read_map(spark, base).collect()}
    assert shards.versions(spark, base) == [1, 2, 3] and sum(third[h] != second[h] for h in second) < moved
    with pytest.raises(Exception, match="exist"):
        shards.write_map(shards.first_map(spark, 4, 256), base, 2)
    load = shards.slot_bytes(shards.records(docs(spark, rows), 256))
    grown = {x["home"]: x["shard"] for x in shards.grow(shards.read_map(spark, base, 2), load, 4).collect()}
    changed = {h for h in second if grown[h] != second[h]}
    assert changed and all(grown[h] == 4 for h in changed)
    by_shard = Counter()
    for x in load.collect():
        by_shard[grown[x["home"]]] += x["bytes"]
    assert max(by_shard.values()) - min(by_shard.values()) < 0.2 * max(by_shard.values())


def test_shards_of_nothing(spark):
    assert sharded(spark, []) == []
    assert [tuple(x)[1:3] for x in sharded(spark, [(1, "é", "l", "s", 1)])] == [(10, zlib.crc32("é".encode()))]


# ------------------------------------------------------------ Merkle manifest


def proved(spark, rows, **options):
    df = merkle.manifest(docs(spark, rows), **options)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def expected(rows, fanout=16):
    return sorted(bt.manifest([(r[0], r[3], r[2], r[4], r[1]) for r in rows], fanout), key=str)


def test_manifest_equals_brute_force(spark):
    rows = [(i, f"Text {i} É" * (i % 4), "EN", f"s{min(i % 7, 2)}", i) for i in range(700)]
    rows += [(5, None, None, None, None), (None, "Null id", "l", "s1", 3), (5, "A", "l", "s1", 3), (5, "A", "l", "s1", 3), (10**12, "B" * 300_000, "l", "big", 3)]
    assert proved(spark, rows) == expected(rows)
    verified = Counter(r[-1] for r in proved(spark, rows))
    assert verified[True] and verified[False]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 27, 28, 82])
def test_manifest_of_every_shape(spark, n):
    rows = [(i, f"T{i}", "l", "a" if i % 5 else "b", i) for i in range(n)]
    assert proved(spark, rows, fanout=3, levels=1) == expected(rows, 3)


def test_manifest_of_many_sources(spark):
    rows = [(i, f"T{i}", "l", f"s{i}", i) for i in range(40)]
    assert proved(spark, rows, fanout=3, levels=2) == expected(rows, 3)


def test_manifest_of_nothing(spark):
    assert proved(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(2, 5))
def test_witnesses_of_an_append_only_tree(n, fanout):
    values = [merkle.digest(str(i)) for i in range(n)]
    tree = merkle.Appender(fanout)
    for i, v in enumerate(values):
        tree.append(v)
        # Open runs only: full ones are a node of the level above.
        assert all(len(run) < fanout for run in tree.runs) and i < n
    root = tree.close()
    levels = bt.tree(values, fanout)
    assert root == levels[-1][0]
    for i, v in enumerate(values):
        assert tree.witness(i) == bt.path(levels, i, fanout)
        assert merkle.fold(v, tree.witness(i)) == root
        assert n == 1 or merkle.fold(merkle.digest("x"), tree.witness(i)) != root
