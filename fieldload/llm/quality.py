"""Quality classifier by hierarchical empirical Bayes.

Document evidence is a calibrated naive Bayes log-odds over hashed words and a
few shape features, fitted on a bounded labelled sample.  Sites are a
hierarchy (host, then path): each level's rate of good documents is a beta
posterior whose prior is the level above, with a strength estimated from the
spread of the rates (method of moments), so sparse sites shrink towards their
host and hosts towards the global rate.  The rates come from grouped sums over
all documents; a document's probability joins its own evidence with the
posterior of its path.
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

CELL_BITS = 16
SHAPES = 6
WIDTH = (1 << CELL_BITS) + SHAPES * 8
# Bounds of a strength: a level never counts for less or more documents.
STRENGTH = (1.0, 10_000.0)
HOST = "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
DIRECTORY = "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*/|/)"


def _features(words: text.Words, odd: np.ndarray, caps: np.ndarray):
    """Yields the distinct feature cells of each row of a chunk."""
    cell = (words.hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    width = words.ends - words.starts
    odd_upto, caps_upto = (np.concatenate([[0], np.cumsum(t[words.data])]) for t in (odd, caps))
    for r in range(words.hi - words.lo):
        a, b = words.woff[r], words.woff[r + 1]
        n = b - a
        if not n:
            yield np.zeros(0, np.int64)
            continue
        distinct = np.unique(cell[a:b])
        size = max(1, int(words.boff[r + 1] - words.boff[r]))
        shape = (
            (odd_upto[words.boff[r + 1]] - odd_upto[words.boff[r]]) / size * 20,
            (caps_upto[words.boff[r + 1]] - caps_upto[words.boff[r]]) / size * 7.9,
            len(distinct) / n * 7.9,
            math.log2(n + 1) / 2,
            width[a:b].mean() / 2,
            (cell[a + 1 : b] == cell[a : b - 1]).sum() / n * 7.9,
        )
        levels = [(1 << CELL_BITS) + i * 8 + min(7, int(x)) for i, x in enumerate(shape)]
        yield np.concatenate([distinct, levels])


def _reader():
    odd, caps = np.zeros(256, np.int64), np.zeros(256, np.int64)
    odd[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 1
    caps[0x41:0x5B] = 1
    tok = text.Tokenizer(text.space_words(), lower=True)

    def rows(column):
        for words in tok.chunks(column):
            yield from _features(words, odd, caps)

    return rows


def _parts(odds: np.ndarray, cells: np.ndarray) -> tuple[float, float]:
    """Mean log-odds of a document's words, and the sum of its shapes' log-odds."""
    n = len(cells) - SHAPES
    return (float(odds[cells[:n]].mean()), float(odds[cells[n:]].sum())) if n > 0 else (0.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and intercept of a logistic regression (Newton's method)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge * len(x) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Evidence:
    """Log-odds of feature cells and the weights that turn a document's into its evidence."""

    def __init__(self, odds, weights, prior):
        self.odds, self.weights, self.prior = odds, weights, prior

    def of(self, cells: np.ndarray) -> float:
        if len(cells) <= SHAPES:
            return 0.0
        words, shapes = _parts(self.odds, cells)
        a, b, c = self.weights
        return float(a * words + b * shapes + c - math.log(self.prior / (1 - self.prior)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, smooth: float = 1.0) -> Evidence:
    """Evidence model of at most ``sample`` labelled documents, those with the smallest id hash.

    Half of them count words and shapes; the other half weighs the two against
    each other, so that evidence is calibrated and not the sum of thousands of
    dependent words.
    """
    order = F.xxhash64(F.col("id").cast("string"))
    picked = labels.where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y")).orderBy(order, "id").limit(sample)
    picked = picked.withColumn("half", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(2)).cast("int"))
    # At most ``sample`` rows are broadcast.
    known = docs.select("id", "text").join(F.broadcast(picked), "id")

    def count(batches):
        rows = _reader()
        n = np.zeros((2, WIDTH + 1), np.int64)
        for batch in batches:
            for y, cells in zip(batch["y"].to_pylist(), rows(batch["text"]), strict=True):
                n[y, cells] += 1
                n[y, WIDTH] += 1
        for y in range(2):
            at = np.flatnonzero(n[y])
            yield pa.RecordBatch.from_pydict(
                {"y": pa.array(np.full(len(at), y, np.int32)), "cell": pa.array(at), "k": pa.array(n[y, at])}
            )

    n = np.zeros((2, WIDTH + 1))
    counted = known.where("half = 0").select("y", "text").mapInArrow(count, "y int, cell long, k long")
    for r in counted.groupBy("y", "cell").agg(F.sum("k").alias("k")).collect():
        n[r["y"], r["cell"]] = r["k"]
    total = n[:, WIDTH] + 2 * smooth
    rate = (n[:, :WIDTH] + smooth) / total[:, None]
    odds = np.log(rate[1] / rate[0]).astype(np.float32)
    prior = float((n[1, WIDTH] + smooth) / total.sum())

    def weigh(batches):
        rows = _reader()
        for batch in batches:
            parts = [_parts(odds, cells) for cells in rows(batch["text"])]
            yield pa.RecordBatch.from_pydict(
                {"y": batch["y"], "words": pa.array([p[0] for p in parts], pa.float64()), "shapes": pa.array([p[1] for p in parts], pa.float64())}
            )

    seen = known.where("half = 1").select("y", "text").mapInArrow(weigh, "y int, words double, shapes double").collect()
    if not seen:
        return Evidence(odds * 0, (0.0, 0.0, math.log(prior / (1 - prior))), prior)
    x = np.array([[r["words"], r["shapes"]] for r in seen])
    return Evidence(odds, tuple(_logistic(x, np.array([r["y"] for r in seen], float))), prior)


def _strength(groups: DataFrame, mean: str) -> float:
    """Documents a prior counts for: binomial noise against the spread of rates, over all groups."""
    r = groups.where("n > 0").agg(
        F.count("*").alias("g"), F.avg(mean).alias("m"), F.avg(F.pow(F.col("good") / F.col("n") - F.col(mean), 2)).alias("v"),
        F.avg(1 / F.col("n")).alias("i"),
    ).first()
    if not r["g"] or r["m"] is None:
        return STRENGTH[0]
    noise = r["m"] * (1 - r["m"])
    between = r["v"] - noise * r["i"]
    if between <= 0:
        return STRENGTH[1]
    return min(STRENGTH[1], max(STRENGTH[0], noise / between - 1))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    label_col: str = "quality",
    sample: int = 20_000,
    url_col: str = "url",
) -> DataFrame:
    """``id, evidence, host_rate, path_rate, probability, good`` of every row.

    ``labels`` has the id and a 0/1 label.  ``evidence`` is the document's own
    log-odds, ``host_rate`` and ``path_rate`` the shrunk posteriors of its
    host and path.  Null text reads as empty (evidence 0); null hosts and
    paths are a host and a path like others; rows repeat as they come.  With
    no labels every evidence is 0 and every rate one half.

    Where ``docs`` has a ``url_col``, the host is the URL's and the path its
    directory (up to the last slash, without query).  Otherwise ``host_col``
    and ``path_col`` stand for them.
    """
    if url_col in docs.columns:
        host = F.lower(F.regexp_extract(url_col, HOST, 1))
        path = F.regexp_extract(url_col, DIRECTORY, 1)
    else:
        host, path = F.col(host_col).cast("string"), F.col(path_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), host.alias("host"), path.alias("path"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    model = fit(rows, known, sample)
    # Plain arrays: a broadcast pickles classes by reference, and workers have no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.odds, model.weights, model.prior))
    keep = ["id", "host", "path"]

    def score(batches):
        rows = _reader()
        model = Evidence(*shared.value)
        for batch in batches:
            e = [model.of(cells) for cells in rows(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + [pa.array(e, pa.float64())], names=[*keep, "evidence"])

    schema = T.StructType([rows.schema[c] for c in keep]).add("evidence", "double")
    base = math.log(model.prior / (1 - model.prior))
    scored = cut(rows.mapInArrow(score, schema), "evidence")
    p = 1 / (1 + F.exp(-(F.col("evidence") + base)))
    by_path = cut(scored.groupBy("host", "path").agg(F.sum(p).alias("good"), F.count("*").alias("n")), "path-rates")
    by_host = by_path.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = by_host.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = (total["good"] or 0.0) / total["n"] if total["n"] else 0.5
    strong = _strength(by_host.withColumn("mean", F.lit(overall)), "mean")
    hosts = by_host.select("host", ((F.col("good") + strong * overall) / (F.col("n") + strong)).alias("host_rate"))
    named = by_path.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host"))).drop("h")
    strong = _strength(named, "host_rate")
    rates = named.select(
        F.col("host").alias("h"), F.col("path").alias("p"), "host_rate",
        ((F.col("good") + strong * F.col("host_rate")) / (F.col("n") + strong)).alias("path_rate"),
    )
    # A host's rows may be a third of all; the rates are one row a path and small, so rows stay where they are or are split.
    joined = scored.join(rates, scored["host"].eqNullSafe(rates["h"]) & scored["path"].eqNullSafe(rates["p"]))
    site = F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    probability = 1 / (1 + F.exp(-(F.col("evidence") + site)))
    return joined.select(
        F.col("id").alias(id_col), "evidence", "host_rate", "path_rate", probability.alias("probability"),
        (probability >= 0.5).alias("good"),
    )
