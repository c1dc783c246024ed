"""Language ID by string-kernel classification.

The kernel of two texts is the cosine of their *presence* vectors: which
blended-spectrum n-grams (1 to 4 bytes of case-folded text, other ASCII
characters read as a space) occur, hashed into a fixed number of cells.  The
Nyström method maps a text to its kernel values with a few landmark texts,
and one-versus-rest kernel ridge regression is solved in that space.  Scoring
is a matrix product for each batch of texts.

The model is fitted on a bounded sample: the ``per_lang`` labelled documents
of each language with the smallest id hash, of which ``landmarks`` in total
are landmarks.  Scoring reads every text whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text

CELL_BITS = 12
GRAMS = (2, 3, 4)
WIDTH = 256 + len(GRAMS) * (1 << CELL_BITS)
UNKNOWN = "und"
RESULTS = {"lang_pred": "string", "score": "double"}


def _fold() -> np.ndarray:
    t = text.lower_table()
    other = np.ones(256, dtype=bool)
    other[0x41:0x5B] = other[0x61:0x7B] = other[0x80:] = False
    t[other] = 0x20
    return t


def presence(column: pa.Array, rows: int = 256):
    """Yields ``(lo, matrix, has_letter)``: n-gram presence of rows ``lo`` on."""
    off, data = text.strings(column)
    fold = _fold()
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + text.CHUNK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        raw = data[off[lo] : off[hi]]
        b = fold[raw]
        size = np.diff(off[lo : hi + 1])
        row = np.repeat(np.arange(hi - lo, dtype=np.int64) * WIDTH, size)
        left = np.repeat(off[lo + 1 : hi + 1] - off[lo], size) - np.arange(len(b))
        m = np.zeros((hi - lo) * WIDTH, np.float32)
        m[row + b] = 1
        key = b.astype(np.uint32)
        for j, g in enumerate(range(2, max(GRAMS) + 1)):
            key = (key[:-1] << np.uint32(8)) | b[g - 1 :]
            ok = left[: len(key)] >= g
            cell = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)).astype(np.int64)
            m[(row[: len(key)] + (256 + (j << CELL_BITS)) + cell)[ok]] = 1
        m = m.reshape(hi - lo, WIDTH)
        letter = m[:, 0x61:0x7B].any(axis=1)
        for r in np.flatnonzero(~letter & (size > 0)):
            letter[r] = any(c.isalpha() for c in column[lo + int(r)].as_py())
        yield lo, m, letter
        lo = hi


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt(np.maximum(m.sum(axis=1, keepdims=True), 1))


class Model:
    """Landmark vectors and the coefficients of every language."""

    def __init__(self, langs, landmarks, weights):
        self.langs, self.landmarks, self.weights = langs, landmarks, weights

    def score(self, m: np.ndarray) -> np.ndarray:
        return (_unit(m) @ self.landmarks) @ self.weights


def fit(x: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> Model:
    """Nyström features of the sample, then one ridge solution per language."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros((WIDTH, 0), np.float32), np.zeros((0, 0), np.float32))
    y = np.array(labels)
    share = max(1, landmarks // len(langs))
    chosen = np.concatenate([np.flatnonzero(y == lang)[:share] for lang in langs])
    x = _unit(x)
    marks = x[chosen]
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    phi = (x @ marks.T).astype(np.float64) @ root
    target = (y[:, None] == np.array(langs)).astype(np.float64)
    w = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ target)
    return Model(langs, np.ascontiguousarray(marks.T), (root @ w).astype(np.float32))


def train(docs, id_col, text_col, lang_col, per_lang=400, landmarks=96, ridge=0.5) -> Model:
    """Model of the labelled rows of ``docs``; rows with a null id, language or text are passed over."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "id is not null and lang is not null and text is not null"
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    ids = known.select("id", "lang").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_lang)

    def vectors(batches):
        for batch in batches:
            for lo, m, letter in presence(batch["text"]):
                ok = np.flatnonzero(letter)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["id"].take(pa.array(ok + lo)).cast(pa.string()),
                        "lang": batch["lang"].take(pa.array(ok + lo)),
                        "place": batch["place"].take(pa.array(ok + lo)),
                        "cells": pa.array([np.packbits(m[r] > 0).tobytes() for r in ok], pa.binary()),
                    }
                )

    # At most per_lang ids of each language are broadcast.
    sample = known.join(F.broadcast(ids), ["id", "lang"]).select("id", "lang", "place", "text")
    rows = sample.mapInArrow(vectors, "id string, lang string, place int, cells binary").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["place"], bytes(r["cells"])))
    x = np.array([np.unpackbits(np.frombuffer(bytes(r["cells"]), np.uint8))[:WIDTH] for r in rows], np.float32)
    return fit(x.reshape(len(rows), WIDTH), [r["lang"] for r in rows], landmarks, ridge)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Input rows with ``lang_pred`` and ``score`` (0 to 1).

    ``lang_pred`` is the language with the highest ridge output (the first by
    name among equals), ``und`` with score 0 where the text is null or has no
    letter, or the model knows no language.  Input columns named like a
    result give way to it.
    """
    # Plain arrays: a broadcast pickles classes by reference, and workers have no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.landmarks, model.weights))
    kept = [c for c in docs.columns if c not in RESULTS]
    rows = docs.withColumn("__text", F.col(text_col)) if text_col in RESULTS else docs
    reads = "__text" if text_col in RESULTS else text_col

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            lang, score = [], []
            for _, m, letter in presence(batch[reads]):
                if not model.langs:
                    letter = np.zeros(len(m), dtype=bool)
                    best = np.zeros(len(m), np.int64)
                    top = np.zeros(len(m))
                else:
                    f = model.score(m)
                    best = f.argmax(axis=1)
                    top = np.clip(f[np.arange(len(m)), best], 0, 1)
                lang += [model.langs[i] if ok else UNKNOWN for i, ok in zip(best, letter, strict=True)]
                score += np.where(letter, top, 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in kept] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*kept, *RESULTS]
            )

    schema = T.StructType([docs.schema[c] for c in kept])
    for name, kind in RESULTS.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """True for the third of the ids that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", **options) -> DataFrame:
    """:func:`predict` with a model trained on the rows that are not held out."""
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col, **options)
    return predict(docs, model, text_col)
