"""Removal of repeated word windows behind a count-min prefilter.

A window is ``window`` consecutive words of one document.  Its key is the
smallest hash of the ``gram``-word runs inside it; equal windows have equal
keys, and neighbouring windows mostly share one, so a document falls into
*segments* (stretches of windows with one key), about one per ``window / 2``
words.

1. Tasks count segment keys in count-min sketches, merged by block.  The
   count of a key is never below the number of documents with any of its
   windows; only segments whose key may repeat go on.  The merged sketch is
   ``2 * 2**sketch_bits`` bits whatever the corpus; a corpus too large for it
   loses pruning, never windows.
2. Whole segments with equal words (128-bit hash) are grouped: all windows of
   a segment that also stands in a smaller document are repeated.
3. The windows of the other segments with a repeated key are grouped one by
   one.  The first holder of every window is always among them.

Grouping is partial aggregation and a join that adaptive execution can split,
so a passage that a third of all documents share is not gathered in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stage import cut
from . import sketch, text
from .names import free_names

ROW = "__row"


def _segments(tok: text.Tokenizer, words: text.Words, window: int, gram: int):
    """First window, number of windows, row and key of each segment of a chunk."""
    at = words.starts_of(window)
    if not len(at):
        return at, at, at, at.astype(np.uint64)
    i = np.arange(len(words) - gram + 1)
    key = text.sliding_min(tok.runs(words, i, i + gram), window - gram + 1)[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), words.rows_of(at[first]), key[first]


def _per_row(keep: np.ndarray, woff: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(keep)])
    return upto[woff[1:]] - upto[woff[:-1]]


def _joined(words: text.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    k = np.flatnonzero(keep)
    lo, hi, row = words.starts[k], words.ends[k], words.rows_of(k)
    more = np.append(row[1:] == row[:-1], False) if len(k) else np.zeros(0, bool)
    data = words.data.copy()
    data[hi[more]] = 0x20
    span = hi + more
    edge = np.bincount(lo, minlength=len(data) + 2) - np.bincount(span, minlength=len(data) + 2)
    size = np.bincount(row, weights=span - lo, minlength=words.hi - words.lo)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    chosen = data[np.cumsum(edge[: len(data)]) > 0]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(chosen.tobytes()))


def remove_repeats(
    docs: DataFrame,
    window: int = 50,
    gram: int = 8,
    sketch_bits: int = 26,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Input rows with ``n_words``, ``n_removed`` and ``kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes when a window covering it
    also starts in a row with a smaller id; windows are judged on the input.
    ``kept_text`` is the remaining words joined by one space.  Null text reads
    as no words; rows with a null id neither lose words nor count as holders;
    rows of one id never repeat each other.  Input columns named like the
    three results give way to them.  Empty input gives an empty result.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = docs.sparkSession
    row_key = F.xxhash64(text_col)
    some = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), row_key.alias(ROW), F.col(text_col).alias("text"))

    def keys(batches):
        tok = text.Tokenizer(text.space_words(), lower=False)
        for batch in batches:
            for words in tok.chunks(batch["text"]):
                yield _segments(tok, words, window, gram)[3]

    bitmaps = sketch.merged(sketch.fill(some.select("text"), keys, sketch_bits, 2), sketch_bits, 2, sketch.repeated, 1)
    shared = spark.sparkContext.broadcast(bitmaps)

    def segments(batches):
        tok = text.Tokenizer(text.space_words(), lower=False)
        for batch in batches:
            for words in tok.chunks(batch["text"]):
                at, n, row, key = _segments(tok, words, window, gram)
                ok = sketch.passes(shared.value, key, sketch_bits)
                at, n, row, key = at[ok], n[ok], row[ok], key[ok]
                end = at + n + window - 1
                which = pa.array(row + words.lo)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["id"].take(which),
                        ROW: batch[ROW].take(which),
                        "start": pa.array((at - words.woff[row]).astype(np.int32)),
                        "n": pa.array(n.astype(np.int32)),
                        "key": pa.array(key.view(np.int64)),
                        "s1": pa.array(tok.runs(words, at, end).view(np.int64)),
                        "s2": pa.array(tok.runs(tok.second(words), at, end).view(np.int64)),
                    }
                )

    id_type = some.schema["id"].dataType.simpleString()
    row_schema = f"id {id_type}, {ROW} long"
    segs = cut(
        some.mapInArrow(segments, f"{row_schema}, start int, n int, key long, s1 long, s2 long"), "segments"
    )
    first = segs.groupBy("s1", "s2", "n").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Written, as holders are below: a common segment is split.
    first = cut(first.where("first < last").drop("last"), "segment-holders")
    open_keys = segs.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    judged = cut(
        segs.join(first, ["s1", "s2", "n"], "left")
        .join(open_keys, "key")
        .select("id", ROW, "start", "n", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("known")),
        "judged-segments",
    )
    ask = judged.where(~F.col("known")).groupBy("id", ROW).agg(F.collect_list(F.struct("start", "n")).alias("ask"))

    def windows(batches):
        tok = text.Tokenizer(text.space_words(), lower=False)
        for batch in batches:
            asked = batch["ask"]
            flat, off = asked.flatten(), asked.offsets.to_numpy() - asked.offsets[0].as_py()
            start, n = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
            for words in tok.chunks(batch["text"]):
                s = slice(off[words.lo], off[words.hi])
                row = np.repeat(np.arange(words.lo, words.hi), np.diff(off[words.lo : words.hi + 1]))
                k = n[s]
                # every asked start, then its n - 1 followers
                step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                row = np.repeat(row, k)
                pos = np.repeat(start[s], k) + step
                at = pos + words.woff[row - words.lo]
                which = pa.array(row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["id"].take(which),
                        ROW: batch[ROW].take(which),
                        "start": pa.array(pos.astype(np.int32)),
                        "w1": pa.array(tok.runs(words, at, at + window).view(np.int64)),
                        "w2": pa.array(tok.runs(tok.second(words), at, at + window).view(np.int64)),
                    }
                )

    asked_rows = sketch.by_membership(some, F.xxhash64("id", ROW), ask.select(F.xxhash64("id", ROW).alias("key")))[1]
    wins = asked_rows.join(ask.hint("shuffle_hash"), ["id", ROW]).select("id", ROW, "text", "ask").mapInArrow(
        windows, f"{row_schema}, start int, w1 long, w2 long"
    )
    # Written, so that the join below has plain exchanges on both sides and a common window can be split.
    holder = wins.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    holder = cut(holder.where("first < last").drop("last"), "window-holders")
    late = wins.join(holder, ["w1", "w2"]).where("id > first")
    gone = (
        judged.where("known").select("id", ROW, "start", "n")
        .unionByName(late.select("id", ROW, "start", F.lit(1).alias("n")))
        .groupBy("id", ROW)
        .agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    )
    results = {"n_words": "long", "n_removed": "long", "kept_text": "string"}
    id_at, row_at, text_at, of_at, key_at, gone_at = free_names([*docs.columns, *results], 6)
    gone = cut(
        gone.select(F.col("id").alias(of_at), F.col(ROW).alias(key_at), F.col("gone").alias(gone_at)), "repeated-windows"
    )
    kept_cols = [c for c in docs.columns if c not in results]
    reads_text = text_col if text_col in kept_cols else text_at
    wide = docs.select(
        *kept_cols, *([F.col(text_col).alias(text_at)] if reads_text == text_at else []),
        F.col(id_col).alias(id_at), row_key.alias(row_at),
    )

    def stripped(tok, batch, start, n, off):
        total, removed, parts = [], [], []
        for words in tok.chunks(batch[reads_text]):
            s = slice(off[words.lo], off[words.hi])
            first = start[s] + np.repeat(words.woff[:-1], np.diff(off[words.lo : words.hi + 1]))
            edge = np.bincount(first, minlength=len(words) + 1)
            edge -= np.bincount(first + n[s] + window - 1, minlength=len(words) + 1)
            keep = np.cumsum(edge[: len(words)]) == 0
            total.append(words.counts)
            removed.append(words.counts - _per_row(keep, words.woff))
            parts.append(_joined(words, keep))
        empty = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [batch[c] for c in kept_cols]
            + [pa.array(np.concatenate(total or empty)), pa.array(np.concatenate(removed or empty)),
               pa.concat_arrays(parts or [pa.array([], pa.string())])],
            names=[*kept_cols, *results],
        )

    def strip(batches):
        tok = text.Tokenizer(text.space_words(), lower=False)
        for batch in batches:
            gone = batch[gone_at].fill_null([])
            flat, off = gone.flatten(), gone.offsets.to_numpy() - gone.offsets[0].as_py()
            start, n = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
            yield stripped(tok, batch, start, n, off)

    def whole(batches):
        tok = text.Tokenizer(text.space_words(), lower=False)
        for batch in batches:
            none = np.zeros(0, np.int64)
            yield stripped(tok, batch, none, none, np.zeros(batch.num_rows + 1, np.int64))

    schema = T.StructType([docs.schema[c] for c in kept_cols])
    for name, kind in results.items():
        schema = schema.add(name, kind)
    # Most rows lose nothing; only those that may are joined with their losses.
    clear, maybe = sketch.by_membership(wide, F.xxhash64(id_at, row_at), gone.select(F.xxhash64(of_at, key_at).alias("key")), whole, schema)
    some = maybe.join(gone.hint("shuffle_hash"), (F.col(id_at) == F.col(of_at)) & (F.col(row_at) == F.col(key_at)), "left")
    return some.mapInArrow(strip, schema).unionByName(clear)
