"""Benchmark decontamination with a broadcast hash set of test n-grams.

Items become word windows; their set is measured before it is broadcast.  A
set beyond the bound is dealt into hash blocks, each within it, and the
documents are scanned once for each block.  A scan hashes every window of
every text, looks it up, and holds a hit against the item's words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stage import cut
from . import text
from .names import free_names

FILTER_BITS = 20
RESULTS = {"n_words": "long", "n_hit": "long", "spans": "array<struct<start:int,end:int,from:int,to:int>>", "items": "array<string>"}


def item_windows(items: DataFrame, n_words: int, id_col: str, text_col: str) -> DataFrame:
    """``hash, k, words, item``: the distinct windows of every item."""

    def run(batches):
        tok = text.Tokenizer(text.alnum_words(), lower=True)
        for batch in batches:
            ids = batch["item"].to_pylist()
            for words in tok.chunks(batch["text"]):
                out = set()
                for r in range(words.hi - words.lo):
                    a, b = int(words.woff[r]), int(words.woff[r + 1])
                    k = min(n_words, b - a)
                    for i in range(a, b - k + 1) if k else ():
                        out.add((i, k, ids[words.lo + r]))
                out = sorted(out, key=lambda x: x[:2])
                at = np.array([x[0] for x in out], np.int64)
                k = np.array([x[1] for x in out], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "hash": pa.array(tok.runs(words, at, at + k).view(np.int64)),
                        "k": pa.array(k.astype(np.int32)),
                        "words": pa.array([_phrase(words, i, n) for i, n, _ in out], pa.binary()),
                        "item": pa.array([x[2] for x in out], pa.string()),
                    }
                )

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "hash long, k int, words binary, item string").distinct()


def _phrase(words: text.Words, i: int, k: int) -> bytes:
    return b" ".join(words.word(j) for j in range(i, i + k)).lower()


def _lookup(rows) -> dict:
    """``k -> (filter, sorted hashes, [(words, items), ...] of each hash)``."""
    by: dict[int, dict[int, dict[bytes, set]]] = {}
    for r in rows:
        held = by.setdefault(r["k"], {}).setdefault(r["hash"] % (1 << 64), {})
        held.setdefault(bytes(r["words"]), set()).update([] if r["item"] is None else [r["item"]])
    out = {}
    for k, held in by.items():
        hashes = np.array(sorted(held), np.uint64)
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        out[k] = (seen, hashes, [held[int(h)] for h in hashes])
    return out


def _hits(tok: text.Tokenizer, words: text.Words, lookup: dict):
    """Hit words of a chunk, and the items found in each row."""
    edge = np.zeros(len(words) + 1, np.int64)
    found: dict[int, set] = {}
    for k, (seen, hashes, held) in lookup.items():
        at = words.starts_of(k)
        h = tok.runs(words, at, at + k)
        maybe = seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        at, h = at[maybe], h[maybe]
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        same = hashes[place] == h
        at, place = at[same], place[same]
        for i, p, row in zip(at.tolist(), place.tolist(), words.rows_of(at).tolist(), strict=True):
            items = held[p].get(_phrase(words, i, k))
            if items is not None:
                edge[i] += 1
                edge[i + k] -= 1
                found.setdefault(row, set()).update(items)
    return np.cumsum(edge[:-1]) > 0, found


def _scan(rows: DataFrame, lookup, text_col: str) -> DataFrame:
    """``rows`` with ``n_words, spans, items`` of one broadcast block."""
    carried = [c for c in rows.columns if c not in RESULTS]

    def run(batches):
        tok = text.Tokenizer(text.alnum_words(), lower=True)
        kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "end", "from", "to")]))
        for batch in batches:
            counts, hits, spans, items = [], [], [], []
            for words in tok.chunks(batch[text_col]):
                hit, found = _hits(tok, words, lookup.value)
                upto = np.concatenate([[0], np.cumsum(hit)])
                counts.append(words.counts)
                hits.append(upto[words.woff[1:]] - upto[words.woff[:-1]])
                for r in range(words.hi - words.lo):
                    a, b = words.woff[r], words.woff[r + 1]
                    items.append(sorted(found.get(r, ())))
                    if upto[a] == upto[b]:
                        spans.append([])
                        continue
                    step = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
                    lo, hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                    begin, end = words.starts[a + lo] - words.boff[r], words.ends[a + hi - 1] - words.boff[r]
                    spans.append(
                        [dict(zip(("start", "end", "from", "to"), x, strict=True))
                         for x in zip(lo.tolist(), hi.tolist(), begin.tolist(), end.tolist(), strict=True)]
                    )
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in carried]
                + [pa.array(np.concatenate(counts or empty)), pa.array(np.concatenate(hits or empty)),
                   pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                names=[*carried, *RESULTS],
            )

    schema = T.StructType([rows.schema[c] for c in carried])
    for name, kind in RESULTS.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    return rows.mapInArrow(run, schema)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    n_words: int = 10,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Input rows with ``n_words``, ``n_hit``, ``spans`` and ``items``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.  A
    window is ``n_words`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  ``spans`` lists maximal stretches of hit
    words (word positions ``start``/``end``, byte positions ``from``/``to``, ends
    exclusive); ``items`` the ids, as strings, of items with a window in the
    row.  Null text has no words; a null item id hits words but names nothing;
    an empty table on either side gives no hits.  Input columns named like a
    result give way to it.  Repeated rows are judged alike.
    """
    spark = docs.sparkSession
    windows = cut(item_windows(items, n_words, item_id, item_text), "item-windows")
    # Python objects of a window: words, item names, hash and containers.
    size = windows.agg(F.sum(F.length("words") + F.coalesce(F.length("item"), F.lit(0)) + 400)).first()[0] or 0
    blocks = max(1, math.ceil(size / broadcast_bytes))
    text_at, key_at, of_at, spans_at, items_at = free_names([*docs.columns, *RESULTS], 5)
    rows = docs.withColumn(text_at, F.col(text_col)) if text_col in RESULTS else docs
    reads = text_at if text_col in RESULTS else text_col

    def block(i: int):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == i)
        return spark.sparkContext.broadcast(_lookup(part.collect()))

    if blocks == 1:
        return _scan(rows, block(0), reads).drop(text_at)
    # Hits depend on the text alone, so those of all blocks are merged by its digest.  Blocks are broadcast in turn:
    # the hits of one are written before the next is made.
    keyed = rows.withColumn(key_at, F.sha2(F.col(reads), 256))
    more = None
    for i in range(blocks):
        held = block(i)
        hits = _scan(keyed.select(key_at, F.col(reads).alias(reads)), held, reads).where("n_hit > 0")
        hits = cut(hits.groupBy(F.col(key_at).alias(of_at)).agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "block-hits")
        held.destroy()
        more = hits if more is None else more.unionByName(hits)
    merged = more.groupBy(of_at).agg(
        F.flatten(F.collect_list("spans")).alias(spans_at),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(items_at),
    )
    merged = cut(merged, "merged-hits")
    counted = _scan(keyed, spark.sparkContext.broadcast({}), reads).drop("n_hit", "spans", "items")
    joined = counted.join(merged, F.col(key_at) == F.col(of_at), "left")
    fused = F.aggregate(
        F.array_sort(spans_at),
        F.expr("cast(array() as array<struct<start:int,end:int,from:int,to:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(
                    F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                    F.element_at(acc, -1)["from"].alias("from"), F.greatest(F.element_at(acc, -1)["to"], x["to"]).alias("to"),
                )),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int,from:int,to:int>>)")
    out = joined.withColumn("spans", F.when(F.col(spans_at).isNotNull(), fused).otherwise(none))
    out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]))
    out = out.withColumn("items", F.coalesce(items_at, F.expr("cast(array() as array<string>)")))
    keep = [c for c in docs.columns if c not in RESULTS]
    return out.select(*keep, *RESULTS)


def without_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of :func:`find_leaks` with the hit stretches cut from the text."""
    b = F.encode(F.col(text_col), "utf-8")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.decode(
            F.substring(
                b,
                F.when(i == 0, 1).otherwise(F.get(F.col("spans"), i - 1)["to"] + 1),
                F.coalesce(F.get(F.col("spans"), i)["from"], F.octet_length(F.col(text_col)))
                - F.when(i == 0, 0).otherwise(F.get(F.col("spans"), i - 1)["to"]),
            ),
            "utf-8",
        ),
    )
    return found.withColumn(text_col, F.when(F.size("spans") > 0, F.array_join(pieces, " ")).otherwise(F.col(text_col)))
