"""Divergence of a language's sources from each other and from the language.

Every (language, source) group and every language gives each kept term an
integer share ``p = 1 + floor(scale * (count + 1) / (N + V))``; a share ``p``
diverges from a share ``q`` by ``floor((p - q)^2 / q)``.

1. *Counts*: a task turns texts into Arrow arrays of words, encodes them by
   dictionary and counts by row and by group, so a word is compared as a word
   and no hash stands for it.  Spark sums by (language, source, term), then
   makes one row for each kept term with its groups' counts.
2. *Joint tables*: a bounded block of terms is a 0/1 matrix with one indicator
   column for each (group, count level), level 0 included.  Its product with its
   own transpose holds, for any two groups, how many terms have level ``a`` in
   one and ``b`` in the other: all joint tables at once.  Products are exact (a
   cell counts at most the block's terms) and go tile by tile.
3. *Pricing*: a cell adds its count times the divergence of its two levels.  A
   task adds up its blocks; what is shuffled is one number a pair and task.

Terms are dealt into blocks by a hash, in number by the entries of the
language, so a language with a third of all rows is many blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..operators.stage import cut
from . import text

SCALE = 1_000_000_000
MIN_DOCS = 3
# Entries (term, group) of one block, about; columns of one tile; terms of one product.
BLOCK_ENTRIES = 1 << 15
TILE = 2048
RARE_TERMS, COMMON_TERMS, COMMON = 2048, 64, 16
# Sums (pair of groups) that a task holds before it hands them on.
HELD = 1 << 21


def letters() -> np.ndarray:
    """Byte table of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``."""
    t = np.zeros(256, dtype=bool)
    t[0x41:0x5B] = t[0x61:0x7B] = t[0x80:] = True
    return t


def words_of(column: pa.Array, is_word: np.ndarray, lower: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column in order, and the row of each."""
    off, data = text.strings(column)
    off, data = off - off[0], data[off[0] : off[-1]]
    inside = is_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends_at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_at[1:])
    body = pa.py_buffer(np.ascontiguousarray(lower[data[inside]]))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends_at), body])
    return words, np.searchsorted(off, starts, "right") - 1


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` from ``lang, source, text``: occurrences and rows with the term."""

    def run(batches):
        is_word, lower = letters(), text.lower_table()
        for batch in batches:
            words, row = words_of(batch.column("text"), is_word, lower)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            terms, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            by_row, n = np.unique(row * len(terms) + code, return_counts=True)
            key, at = np.unique(group[by_row // len(terms)] * len(terms) + by_row % len(terms), return_inverse=True)
            g = key // len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(g // len(source.dictionary))),
                    source.dictionary.take(pa.array(g % len(source.dictionary))),
                    terms.take(pa.array(key % len(terms))).cast(pa.string()),
                    pa.array(np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)),
                    pa.array(np.bincount(at, minlength=len(key)).astype(np.int64)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    found = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, scale: int = SCALE) -> Column:
    """``1 + floor(scale * (count + 1) / total)``, exact for any long count."""
    wide = F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)"), total.cast("decimal(20,0)"))
    fits = count < (1 << 62) // scale
    return F.lit(1).cast("long") + F.when(fits, F.call_function("div", (count + 1) * F.lit(scale).cast("long"), total)).otherwise(wide)


# ------------------------------------------------------------ joint tables


def joint_tables(counts: np.ndarray):
    """Joint tables of all pairs of columns of ``counts`` (terms x groups): ``g, a, h, b, terms`` arrays, ``g < h``, tile by tile."""
    n, groups = counts.shape
    levels, code = np.unique(counts, return_inverse=True)
    key, column = np.unique(code.reshape(n, groups) + np.arange(groups) * len(levels), return_inverse=True)
    column = column.reshape(n, groups)
    of, level = key // len(levels), levels[key % len(levels)]
    edges = [0]
    ends = np.searchsorted(of, np.arange(groups), "right")
    for g in range(1, groups):  # tiles of whole groups
        if ends[g] - (ends[edges[-1] - 1] if edges[-1] else 0) > TILE:
            edges.append(g)
    edges.append(groups)
    tiles = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        first = ends[lo - 1] if lo else 0
        hot = np.zeros((n, ends[hi - 1] - first), np.float32)
        hot[np.arange(n)[:, None], column[:, lo:hi] - first] = 1
        tiles.append((first, hot))
    for i, (at_i, hot_i) in enumerate(tiles):
        for at_j, hot_j in tiles[i:]:
            joint = hot_i.T @ hot_j
            x, y = np.nonzero(joint)
            once = of[x + at_i] < of[y + at_j]  # a tile with itself has both orders
            x, y = x[once], y[once]
            terms = joint[x, y].astype(np.int64)
            x, y = x + at_i, y + at_j
            yield of[x], level[x], of[y], level[y], terms


def chunks(totals: np.ndarray, groups: int):
    """Positions of the terms of one product: terms of like frequency have few levels."""
    order = np.argsort(totals, kind="stable")
    rare = int(np.searchsorted(totals[order], COMMON))
    for part, size in ((order[:rare], RARE_TERMS), (order[rare:], COMMON_TERMS)):
        size = max(1, min(size, (1 << 20) // groups))
        for i in range(0, len(part), size):
            yield part[i : i + size]


def shares(counts: np.ndarray, totals: np.ndarray, scale: int) -> np.ndarray:
    if len(counts) and counts.max() >= (1 << 62) // scale:
        return np.array([1 + scale * (int(c) + 1) // int(t) for c, t in zip(counts, totals, strict=True)], np.int64)
    return 1 + scale * (counts + 1) // totals


def priced(counts: np.ndarray, totals: np.ndarray, sizes: np.ndarray, scale: int) -> np.ndarray:
    """Divergences summed over the terms: cell ``[g, h]`` is group ``g``'s from ``h``; ``sizes`` are the groups' ``N + V``."""
    groups = len(sizes)
    out = np.zeros(groups * groups, np.int64)
    for part in chunks(totals, groups):
        for g, a, h, b, terms in joint_tables(counts[part]):
            p, q = shares(a, sizes[g], scale), shares(b, sizes[h], scale)
            square = (p - q) ** 2
            np.add.at(out, g * groups + h, terms * (square // q))
            np.add.at(out, h * groups + g, terms * (square // p))
    return out.reshape(groups, groups)


def pair_sums(terms: DataFrame, langs: DataFrame, scale: int) -> DataFrame:
    """``lang, g, h, value`` summed over all kept terms.

    ``terms``: ``lang, term, total, counts`` (array of ``no, n``); ``langs``:
    ``lang, sizes`` (``N + V`` by group number), ``entries``.
    """
    buckets = F.ceil(F.col("entries") / BLOCK_ENTRIES)
    dealt = terms.join(bounded_broadcast(langs.select("lang", buckets.alias("buckets"))), "lang")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("term"), F.greatest("buckets", F.lit(1))))
    # About BLOCK_ENTRIES entries each.
    blocks = dealt.groupBy("lang", "bucket").agg(F.collect_list("total").alias("totals"), F.collect_list("counts").alias("counts"))
    blocks = blocks.join(langs.select("lang", "sizes"), "lang").select("lang", "sizes", "totals", "counts")

    def handed(sums):
        for lang, out in sums.items():
            g, h = np.nonzero(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int32)), pa.array(h.astype(np.int32)), pa.array(out[g, h])], ["lang", "g", "h", "value"]
            )

    def run(batches):
        sums, held = {}, 0
        for batch in batches:
            for i in range(batch.num_rows):
                lang = batch.column("lang")[i].as_py()
                sizes = batch.column("sizes")[i].values.to_numpy()
                totals = batch.column("totals")[i].values.to_numpy()
                lists = batch.column("counts")[i].values
                entries = lists.flatten()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                counts = np.zeros((len(totals), len(sizes)), np.int64)
                counts[row, entries.field("no").to_numpy()] = entries.field("n").to_numpy()
                if lang not in sums:
                    sums[lang] = np.zeros((len(sizes), len(sizes)), np.int64)
                    held += len(sizes) ** 2
                sums[lang] += priced(counts, totals, sizes, scale)
                if held > HELD:
                    yield from handed(sums)
                    sums, held = {}, 0
        yield from handed(sums)

    found = blocks.mapInArrow(run, "lang string, g int, h int, value long")
    return found.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


# ------------------------------------------------------------ the audit


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    scale: int = SCALE,
    top_terms: int = 200,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: every group against the others, and its terms against the language.

    Part ``pair`` has one row for each other source of the language, part
    ``term`` the ``top_terms`` terms with the greatest divergence among those the
    group uses more than the language.  Ranks count from 1 by value descending,
    then item.  A term is kept in languages where ``min_docs`` rows have it.
    Nulls read as empty; rows are documents, repeated ones too; a group without
    terms has counts of 0; a language without kept terms has pair values of 0 and
    no term rows; an empty table gives none.  Other columns are not read.
    """
    named = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = cut(named.select("lang", "source").distinct().withColumn("no", F.row_number().over(in_lang) - 1), "divergence-groups")
    counts = term_counts(named).join(bounded_broadcast(groups), ["lang", "source"])
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("no", "n")).alias("counts")
    )
    terms = cut(terms.where(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")

    entries = terms.select("lang", "term", "total", F.inline("counts"))
    used = entries.groupBy("lang", "no").agg(F.sum("n").alias("used"), F.count("*").alias("k"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_used"))
    sized = groups.join(used, ["lang", "no"], "left").join(kept, "lang", "left").select(
        "lang", "source", "no", F.coalesce("k", F.lit(0)).alias("k"),
        (F.coalesce("used", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("size"),
        (F.coalesce("lang_used", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("lang_size"),
    )
    sized = cut(sized, "divergence-sizes")
    langs = sized.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "size"))), lambda x: x["size"]).alias("sizes"), F.sum("k").alias("entries")
    )
    sums = pair_sums(terms, cut(langs, "divergence-languages"), scale)
    one = sized.select("lang", "source", F.col("no").alias("g"))
    two = sized.select("lang", F.col("source").alias("item"), F.col("no").alias("h"))
    pairs = one.join(two, "lang").where("g <> h").join(sums, ["lang", "g", "h"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    about = bounded_broadcast(sized.select("lang", "no", "source", "size", "lang_size"))
    p, q = share(F.col("n"), F.col("size"), scale), share(F.col("total"), F.col("lang_size"), scale)
    shared = entries.join(about, ["lang", "no"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    found = shared.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(ranked)
