"""Exact Jaccard self-join of n-gram sets through prefix trees.

All sets are kept in one global order of n-grams: rare before frequent (by a
count sketch over all documents), then by hash.  Two sets with Jaccard
similarity of at least ``t`` share one of their first ``n - ceil(t n) + 1``
n-grams, so only documents that share such a prefix n-gram are compared:

1. Documents with one set are one node (its 64-bit set hash).
2. Prefix n-grams meet in buckets.  An n-gram whose sketch count is low has a
   bounded group; groups of the others are kept as rows and aggregated.
3. Two prefixes hold all common n-grams up to the end of the one that ends
   first, so the number of prefix n-grams a pair shares bounds its overlap.
   Pairs of a group's hub and members that pass the bound by the groups of
   that hub alone are compared first; what links joins into components.  Then
   pairs in different components meet at n-grams that stand early in both sets,
   and those with enough of them are compared.  Pairs inside a component need no
   check, and a component of many members is first met as a whole: the prefix
   n-grams that a node shares with any of them bound those with each.
4. Comparing: the sets to be held against one probe stand in a trie (sorted
   by the global order; a set shares the path it has in common with its
   predecessor).  Overlap counted on a shared path is reused, and a branch is
   left as soon as its overlap plus the shorter remainder cannot reach the
   needed overlap.

Links are exact up to 58-bit n-gram hashes; equal 64-bit set hashes are taken
as equal sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import collect, cut, remove
from . import sketch, text
from .components import connected

ORDER_BITS = 58
# Cells of the count sketch: about one for every 32 n-grams, at most 2**24 (16
# MB of classes on every executor).  Past that, more n-grams count as frequent.
SKETCH_BITS = (16, 24)
GRAMS_A_CELL = 32
NODE_BITS = 24
PROBES = 256
# Members of a group that a window ranks in one task.
WHOLE = 4096


def needed(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of sets of ``a`` and ``b`` n-grams at ``den * inter >= num * union``."""
    return -(-num * (a + b) // (num + den))


def overlaps(probe: np.ndarray, members: list[np.ndarray], num: int, den: int) -> list[bool]:
    """Which ``members`` link with ``probe``; all are ascending n-gram arrays.

    The members form a trie by their common starts; ``seen[d]`` is the overlap
    of the current path's first ``d`` n-grams with the probe.
    """
    size = len(probe)
    linked = [False] * len(members)
    order = sorted(range(len(members)), key=lambda i: members[i].byteswap().tobytes())
    path, seen = np.zeros(0, np.uint64), np.zeros(1, np.int64)
    for i in order:
        m, n = members[i], len(members[i])
        if not n or not size or not den * min(n, size) >= num * max(n, size):
            continue
        need = needed(n, size, num, den)
        k = min(len(path), n)
        differ = np.flatnonzero(path[:k] != m[:k])
        depth = int(differ[0]) if len(differ) else k
        path, seen = m[:depth], seen[: depth + 1]
        while True:
            past = int(np.searchsorted(probe, m[depth - 1], "right")) if depth else 0
            bound = seen[-1] + min(n - depth, size - past)
            if bound < need or depth == n:
                linked[i] = bool(bound >= need)
                break
            step = m[depth : depth + max(32, depth)]
            at = np.searchsorted(probe, step)
            hit = (at < size) & (probe[np.minimum(at, size - 1)] == step)
            seen = np.concatenate([seen, seen[-1] + np.cumsum(hit)])
            depth += len(step)
            path = m[:depth]
    return linked


def _sets(tok: text.Tokenizer, words: text.Words, n_words: int, classes: np.ndarray):
    """Distinct ordered n-grams of a chunk's rows: values and offsets."""
    y = _ordered(_grams(tok, words, n_words), classes)
    size = np.where(words.counts >= n_words, words.counts - n_words + 1, np.minimum(words.counts, 1))
    off = np.concatenate([[0], np.cumsum(size)])
    for a, b in zip(off[:-1], off[1:], strict=True):
        if b - a > 1:
            y[a:b].sort()
    new = np.ones(len(y), dtype=bool)
    new[1:] = y[1:] != y[:-1]
    new[off[:-1][size > 0]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return y[new], upto[off]


def _grams(tok, words, n_words):
    full = words.starts_of(n_words)
    short = words.woff[:-1][(words.counts > 0) & (words.counts < n_words)]
    start = np.concatenate([full, short])
    end = np.concatenate([full + n_words, words.woff[1:][(words.counts > 0) & (words.counts < n_words)]])
    order = np.argsort(start, kind="stable") if len(short) else slice(None)
    return tok.runs(words, start[order], end[order])


def _ordered(x: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The n-gram's place in the global order: frequency class, then hash."""
    cell = sketch.cells(x, 0, int(len(classes)).bit_length() - 1)
    return (classes[cell].astype(np.uint64) << np.uint64(ORDER_BITS)) | (x >> np.uint64(64 - ORDER_BITS))


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """0 for n-grams at the sketch's usual count, else 1 and more by powers of two."""
    mean = counts.mean()
    usual = max(32.0, mean + 6 * math.sqrt(mean))
    c = np.zeros(len(counts), np.uint8)
    high = counts > usual
    c[high] = np.minimum(1 + np.log2(counts[high] / usual), 60).astype(np.uint8)
    return c


def _signature(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(text.mix(values), dtype=np.uint64)]).astype(np.uint64)
    return text.mix(upto[off[1:]] - upto[off[:-1]] + np.diff(off).astype(np.uint64))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _narrow(x: np.ndarray) -> np.ndarray:
    """In two bytes each where all fit, else in four."""
    return x.astype(np.uint16 if x.max(initial=0) < 1 << 16 else np.int32)


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * count else np.int32).astype(np.int32)


def majors(members: DataFrame) -> DataFrame:
    """``gram, major``: the component most members (``gram, comp``) are in, of equals the largest, where there are several."""
    kinds = members.groupBy("gram", "comp").agg(F.count("*").alias("k"))
    major = F.max(F.struct("k", "comp")).getField("comp").alias("major")
    return kinds.groupBy("gram").agg(major, F.count("*").alias("comps")).where("comps > 1").select("gram", "major")


def hubbed(members: DataFrame) -> DataFrame:
    """``node, n, hub, hub_n`` of the members (``gram, node, n, size``) of every group but its hub.

    A group's hub is the member whose n-grams most others hold: the text that
    near copies were made from.  Groups of at most ``WHOLE`` rows are ranked
    whole in a window, larger ones by an aggregate and a join.
    """
    # A window on ``node`` holds the n-grams of one text.
    mass = F.sum("size").over(Window.partitionBy("node")) / F.max("n").over(Window.partitionBy("node"))
    ranked = members.withColumn("mass", mass)
    best = F.max(F.struct("mass", "node", "n"))
    small = ranked.where(F.col("size") <= WHOLE).withColumn("h", best.over(Window.partitionBy("gram")))
    large = ranked.where(F.col("size") > WHOLE)
    tops = large.groupBy("gram").agg(best.alias("h"))
    large = members.where(F.col("size") > WHOLE).join(tops, "gram")
    columns = ["node", "n", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n")]
    return small.select(*columns).unionByName(large.select(*columns)).where("hub <> node")


class JaccardJoin:
    """One run of the join over ``docs``; see :func:`jaccard_components`."""

    def __init__(self, docs, id_col, text_col, n_words, num, den, with_keys=False):
        self.spark = docs.sparkSession
        self.n_words, self.num, self.den = n_words, num, den
        key = [F.xxhash64(text_col).alias("text_key")] if with_keys else []
        self.keys = ["text_key"] if with_keys else []
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *key)
        self.id_type = self.docs.schema["id"].dataType.simpleString()
        size = self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 1
        bits = min(max(round(math.log2(size / 6 / GRAMS_A_CELL + 1)), SKETCH_BITS[0]), SKETCH_BITS[1])
        grams = sketch.fill(self.docs.where("id is not null").select("text"), self._keys(), bits, 1)
        counts = sketch.merged(grams, bits, 1, lambda a: a.astype(np.uint16).tobytes(), 16)
        self.seen: list = []
        self.classes = self.spark.sparkContext.broadcast(frequency_classes(counts.reshape(-1).view(np.uint16)))

    def _keys(self):
        n_words = self.n_words

        def keys(batches):
            tok = text.Tokenizer(text.space_words(), lower=True)
            for batch in batches:
                for words in tok.chunks(batch["text"]):
                    yield _grams(tok, words, n_words)

        return keys

    def _each(self, df, emit, schema):
        """Runs ``emit(batch, words, values, offsets, signatures)`` on all chunks."""
        n_words, classes = self.n_words, self.classes

        def run(batches):
            tok = text.Tokenizer(text.space_words(), lower=True)
            for batch in batches:
                for words in tok.chunks(batch["text"]):
                    values, off = _sets(tok, words, n_words, classes.value)
                    yield from emit(batch, words, values, off, _signature(values, off))

        return df.mapInArrow(run, schema)

    def nodes(self) -> DataFrame:
        """``id, n, node`` of every row, and its ``text_key`` if asked for."""
        keys = self.keys

        def emit(batch, words, values, off, node):
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch["id"].slice(words.lo, words.hi - words.lo),
                    "n": pa.array(np.diff(off)),
                    "node": pa.array(node.view(np.int64)),
                }
                | {c: batch[c].slice(words.lo, words.hi - words.lo) for c in keys}
            )

        schema = ", ".join([f"id {self.id_type}, n long, node long", *(f"{c} long" for c in keys)])
        return cut(self._each(self.docs, emit, schema), "sets")

    def groups(self, buckets: int) -> DataFrame:
        """``gram, node, n, at, size``: members of prefix n-grams, ``at`` the n-gram's place in the node's order; the group's ``size`` is null for frequent ones."""
        num, den = self.num, self.den

        def emit(batch, words, values, off, node):
            valid = batch["id"].slice(words.lo, words.hi - words.lo).is_valid().to_numpy(zero_copy_only=False)
            n = np.where(valid, np.diff(off), 0)
            first = np.where(n > 0, n - -(-num * n // den) + 1, 0)
            at = _ranges(off[:-1], first)
            row = np.repeat(np.arange(len(n)), first)
            gram = values[at]
            rare = gram >> np.uint64(ORDER_BITS) == 0
            place = text.mix(np.where(rare, gram, node[row])) % np.uint64(buckets)
            bucket = place.astype(np.int64) + np.where(rare, 0, buckets)
            order = np.lexsort((row, bucket))
            bucket, row, gram, at = bucket[order], row[order], gram[order], at[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            columns = {"grams": gram, "nodes": node[row], "sizes": _narrow(n[row]), "places": _narrow(at - off[row])}
            spans = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int32())}
                | {c: pa.array([v[a:b].tobytes() for a, b in spans], pa.binary()) for c, v in columns.items()}
            )

        packed = self._each(
            self.docs, emit, "bucket int, grams binary, nodes binary, sizes binary, places binary"
        ).repartition(F.col("bucket"))

        def meet(batches):
            held: dict[int, list] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    held.setdefault(r["bucket"], []).append(r)
            for bucket, rows in held.items():
                gram = np.concatenate([np.frombuffer(r["grams"], np.uint64) for r in rows])
                node = np.concatenate([np.frombuffer(r["nodes"], np.int64) for r in rows])
                n, at = (np.concatenate([_wide(r[c], len(r["grams"]) // 8) for r in rows]) for c in ("sizes", "places"))
                rows.clear()
                order = np.lexsort((node, gram))
                gram, node, n, at = gram[order], node[order], n[order], at[order]
                new = np.ones(len(gram), dtype=bool)
                new[1:] = (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
                gram, node, n, at = gram[new], node[new], n[new], at[new]
                k = None
                if bucket < buckets:
                    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
                    size = np.diff(np.append(first, len(gram)))
                    many = np.repeat(size > 1, size)
                    gram, node, n, at, k = gram[many], node[many], n[many], at[many], np.repeat(size, size)[many]
                for a in range(0, len(gram), 200_000):
                    s = slice(a, a + 200_000)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "gram": pa.array(gram[s].view(np.int64)),
                            "node": pa.array(node[s]),
                            "n": pa.array(n[s]),
                            "at": pa.array(at[s]),
                            "size": pa.array(k[s]) if k is not None else pa.nulls(len(gram[s]), pa.int64()),
                        }
                    )

        return cut(packed.mapInArrow(meet, "gram long, node long, n int, at int, size long"), "gram-groups")

    def sets(self, requests: DataFrame) -> DataFrame:
        """``requests`` (``node, id``: a row of the node, and more columns) with the node's ``grams``."""
        seen = self.spark.sparkContext.broadcast(sketch.members(requests.select("node"), NODE_BITS))
        self.seen.append(seen)

        def emit(batch, words, values, off, node):
            ok = np.flatnonzero(sketch.passes(seen.value, node, NODE_BITS))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch["id"].take(pa.array(ok + words.lo)),
                    "node": pa.array(node[ok].view(np.int64)),
                    "grams": pa.array([values[off[i] : off[i + 1]].tobytes() for i in ok], pa.binary()),
                }
            )

        all_sets = self._each(self.docs, emit, f"id {self.id_type}, node long, grams binary")
        return all_sets.join(requests.hint("shuffle_hash"), ["node", "id"])

    def possible(self, shared: DataFrame) -> DataFrame:
        """Distinct pairs ``a, b`` of rows ``a, an, b, bn`` (one for each shared prefix n-gram) that may link."""
        num, den = self.num, self.den
        rest = F.greatest(*[F.ceil(F.col(n) * num / den) for n in ("an", "bn")]) - 1
        need = F.ceil((F.col("an") + F.col("bn")) * num / (num + den))
        fits = F.least("an", "bn") * den >= F.greatest("an", "bn") * num
        counted = shared.where(fits).groupBy("a", "an", "b", "bn").agg(F.count("*").alias("k"))
        return counted.where(F.col("k") + rest >= need).select("a", "b")

    def need(self, a: str, b: str):
        """:func:`needed` of two columns."""
        return F.ceil((F.col(a) + F.col(b)) * self.num / (self.num + self.den))

    def early(self):
        """Whether a member (``n, at``) stands early enough to meet sets as large as its own or larger."""
        return F.col("at") <= F.col("n") - self.need("n", "n") + SHARED - 1

    def met(self, minor: DataFrame, others: DataFrame) -> DataFrame:
        """Rows ``a, b, e`` of the pairs of ``minor`` (``gram, side, x, nx, ax, cx``) and ``others`` (``gram, side, node, n, at, comp``) at n-grams that stand early in both.

        The first ``e`` n-grams that a linking pair has in common stand, in
        either set of ``n``, before place ``n - needed + e``: at least
        ``needed - e`` common ones follow.  So only rows with both places there
        are met, and a pair needs ``e`` of them.  ``e`` is ``SHARED``, or as
        many as the prefix of the larger set holds.  Of sides 0 and 1 ``x`` is
        the smaller set, of side 2 ``node`` (of equal sizes, by node); its
        member must be ``early``.
        """
        x_first = (F.col("nx") < F.col("n")) | ((F.col("nx") == F.col("n")) & (F.col("x") < F.col("node")))
        fits = F.least("nx", "n") * self.den >= F.greatest("nx", "n") * self.num
        need = self.need("nx", "n")
        e = F.least(F.lit(SHARED), need - F.ceil(F.greatest("nx", "n") * self.num / self.den) + 1)
        placed = (F.col("ax") <= F.col("nx") - need + e - 1) & (F.col("at") <= F.col("n") - need + e - 1)
        met = minor.join(others, ["gram", "side"]).where((F.col("comp") != F.col("cx")) & (x_first == (F.col("side") < 2)) & fits & placed)
        return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"), e.alias("e"))

    def meeting(self, minor: DataFrame, others: DataFrame) -> DataFrame:
        """Distinct pairs ``a, b`` that :meth:`met` gives often enough to link."""
        return self.met(minor, others).groupBy("a", "b").agg(F.count("*").alias("k"), F.min("e").alias("e")).where("k >= e").select("a", "b")

    def links(self, pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """Edges ``u, v``: the ``pairs`` (``a``, ``b``) whose sets link."""
        num, den = self.num, self.den
        count = pairs.groupBy("a").agg(F.count("*").alias("k"))
        dealt = pairs.join(count, "a").select(
            "a", "b", F.expr(f"cast(pmod(xxhash64(b), ceil(k / {PROBES})) as int)").alias("salt")
        )
        probes = dealt.select("a", "salt").distinct()
        own = F.lit(None).cast("long").alias("b")
        asked = dealt.select(F.col("b").alias("node"), "a", "salt", "b").unionByName(
            probes.select(F.col("a").alias("node"), "a", "salt", own)
        )
        # Each set goes from its document straight to the probes that ask for it.
        work = self.sets(cut(asked.join(rows, "node"), "requests")).select("a", "salt", "b", "grams")

        def run(batches):
            at, probe, ids, members = None, None, [], []

            def close():
                if probe is None or not members:
                    return
                ok = [b for b, yes in zip(ids, overlaps(probe, members, num, den), strict=True) if yes]
                yield pa.RecordBatch.from_pydict({"u": pa.array([at[0]] * len(ok), pa.int64()), "v": pa.array(ok, pa.int64())})

            for batch in batches:
                columns = (batch[c].to_pylist() for c in ("a", "salt", "b"))
                for a, salt, b, grams in zip(*columns, batch["grams"], strict=True):
                    if (a, salt) != at:
                        yield from close()
                        at, probe, ids, members = (a, salt), None, [], []
                    grams = np.frombuffer(grams.as_buffer(), np.uint64)
                    if b is None:
                        probe = grams
                    else:
                        ids.append(b)
                        members.append(grams)
            yield from close()

        sorted_work = work.repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
        found = cut(sorted_work.mapInArrow(run, "u long, v long"), "links")
        self.seen.pop().destroy()
        return found

    def reachable(self, m: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Families, and the ``node, family`` that may link, of members ``gram, node, n, comp``.

        A node shares with a member at most the prefix n-grams that it has in
        common with any member of the family, so one row for each node, n-gram
        and family bounds the overlap with all its members.
        """
        num, den = self.num, self.den
        families = cut(comp.groupBy("comp").agg(F.count("*").alias("k")).where(F.col("k") >= FAMILY).select(F.col("comp").alias("family")), "families")
        mine = m.join(families, m["comp"] == families["family"])
        sizes = mine.groupBy("family").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        grams = cut(mine.select("gram", "family").distinct(), "family-grams")
        met = m.join(grams, "gram").where("comp <> family").groupBy("node", "n", "family").agg(F.count("*").alias("k"))
        # Of the sizes that can link, the shortest and the longest need the fewest shared n-grams.
        n = F.col("n")
        lo = F.greatest("lo", F.ceil(n * num / den))
        hi = F.least("hi", F.floor(n * den / num))

        def fewest(size):
            rest = F.greatest(F.ceil(n * num / den), F.ceil(size * num / den)) - 1
            return F.ceil((n + size) * num / (num + den)) - rest

        may = (lo <= hi) & (F.col("k") >= F.least(fewest(lo), fewest(hi)))
        return families, cut(met.join(sizes, "family").where(may).select("node", "family"), "reachable")


# Prefix n-grams that a pair of sets of like size must share before it is compared.
SHARED = 3
# Nodes of a component that other nodes are first held against as a whole.
FAMILY = 16


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, num: int = 75, den: int = 100,
    with_keys: bool = False,
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; a set
    holds the distinct runs of ``n_words`` words (fewer words: the whole
    sequence).  Rows link when ``den * intersection >= num * union``, exactly;
    ``component_id`` is the smallest id reachable by links.  Null or wordless
    text is an empty set, linked with nothing.  A row with a null id keeps its
    size, links with nothing and has a null component.  Rows that repeat an id
    are documents of their own with one name.  Other columns are ignored.
    ``with_keys`` adds ``text_key``, the xxhash64 of the row's text, and
    ``group_key``, which rows have in common exactly when links join them.
    """
    join = JaccardJoin(docs, id_col, text_col, n_words, num, den, with_keys)
    buckets = int(join.spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = join.nodes()
    named = nodes.where("id is not null and n > 0")
    with collect() as used:
        groups = join.groups(buckets)
    frequent = groups.where("size is null").drop("size")
    sizes = frequent.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1")
    with collect() as used_members:
        members = cut(groups.where("size is not null").unionByName(frequent.join(sizes, "gram")), "gram-members")
    remove(join.spark, used)
    spokes = hubbed(members)
    star = cut(
        join.possible(spokes.select(F.col("hub").alias("a"), F.col("hub_n").alias("an"), F.col("node").alias("b"), F.col("n").alias("bn"))),
        "star-pairs",
    )
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    one_row = named.groupBy("node").agg(F.min("id").alias("id"))
    near = join.links(star, one_row)
    comp = cut(connected(near), "components")

    # Written once; members whose node is in no component need no join.
    with collect() as used_up:
        single, linked = sketch.by_membership(members.drop("size"), F.col("node"), comp.select("node"))
        linked = linked.join(comp, "node", "left").select(*single.columns, F.coalesce("comp", "node").alias("comp"))
        m = cut(single.withColumn("comp", F.col("node")).unionByName(linked), "component-members")
    remove(join.spark, used_members)
    # Both sides of the join below need one choice of the major component: ties have an order, and it is made once.
    major = cut(majors(m), "majors")
    split = sketch.by_membership(m, F.col("gram"), major.select("gram"))[1].join(major, "gram")
    with collect() as used_split:
        split = cut(split, "split-members")
    families, reach = join.reachable(m, comp)
    remove(join.spark, used_up)
    minor = split.where("comp <> major").select(
        "gram", "major", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ax"), F.col("comp").alias("cx"), join.early().alias("early")
    )
    # A major component that is a family is met only by the nodes that may link with it.
    family = families.select(F.col("family").alias("major"), F.lit(True).alias("is_family"))
    may = reach.select(F.col("node").alias("x"), F.col("family").alias("major"), F.lit(True).alias("may"))
    minor = minor.join(family, "major", "left").join(may, ["x", "major"], "left")
    # Nodes of minor components meet each other (side 0) and those of the major one, as the smaller (1) and the larger set (2).
    with_major = "if(is_family is null or may is not null, if(early, array(1, 2), array(2)), array())"
    side = F.expr(f"explode(concat(if(early, array(0), array()), {with_major}))").alias("side")
    minor = minor.select("gram", "x", "nx", "ax", "cx", side)
    sides = F.when(F.col("comp") != F.col("major"), F.expr("array(0)")).when(join.early(), F.expr("array(1, 2)")).otherwise(F.expr("array(1)"))
    others = split.select("gram", "node", "n", "at", "comp", F.explode(sides).alias("side"))
    cross = join.meeting(minor, others).join(tried, ["a", "b"], "left_anti")
    cross = cut(cross, "cross-pairs")
    remove(join.spark, used_split)
    more = join.links(cross, one_row)
    # The later links join components, so only distinct pairs of those are contracted.
    lifted = more
    for end in ("u", "v"):
        at = comp.select(F.col("node").alias(end), F.col("comp").alias("c"))
        lifted = lifted.join(at, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    upper = cut(connected(lifted.distinct()), "components")
    known = comp.unionByName(upper.join(comp, "node", "left_anti"))
    upper = upper.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    comp = known.join(upper, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))

    rows = nodes.join(comp, "node", "left").select("id", "n", F.coalesce("comp", "node").alias("comp"), *join.keys)
    least = rows.where("id is not null and n > 0").groupBy("comp").agg(F.min("id").alias("component_id"))
    join.classes.destroy()
    return rows.join(least, "comp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))).alias("component_id"),
        *(["text_key", F.col("comp").alias("group_key")] if with_keys else []),
    )
