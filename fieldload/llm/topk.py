"""Exact top-k search by term-at-a-time accumulation.

Queries and candidates are packed into blocks, each candidate once; the
queries, the smaller side, are copied to a number of groups that the candidate
blocks are dealt to, and every pair of blocks that meets there is one row of
work.  In a task, each term's posting list (the block's candidates with a
weight at that term) is multiplied by the query weights at the term and
scattered into dense score arrays; a query's ``k`` best are kept from block to
block and merged over all groups.  Blocks are read whole and scores are
integers, so the result is exact.  The work is the stated query set against
all rows; no side is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Queries and candidates scored at once inside a task.
TILE = (32, 4096)
# Groups of candidate blocks, at least: each gets a copy of the queries.
GROUPS = 64
# Queries that a task holds with their best, about; for each so many the candidates are copied once more.
QUERIES = 200_000
LONG_MAX = (1 << 63) - 1
# Score of a place that no candidate has taken yet.
FREE = -LONG_MAX - 1


def _clean(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    # Floats stay floats, which order and compare as doubles do, in half the bytes.
    v = F.col(vec_col) if df.select(vec_col).dtypes[0][1] == "array<float>" else F.col(vec_col).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & ~odd)
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v).alias("v"))


def _narrow(weights: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them: 2 or 4 bytes, or doubles."""
    top = np.abs(weights).max(initial=0)
    return weights.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.float64)


def _packed(df: DataFrame, rows: int, scale: float, prefix: str = "") -> DataFrame:
    """Blocks of at most ``rows`` rows of a partition, ``part`` and ``no``: ids ascending, vector lengths, integer weights."""

    def block(held, part, no) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        v = table["v"].combine_chunks()
        weights = _narrow(np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)))
        sizes = np.diff(v.offsets.to_numpy()).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([no], pa.int32()),
                pa.array([table["id"].to_numpy().tobytes()], pa.binary()),
                pa.array([sizes.tobytes()], pa.binary()),
                pa.array([weights.dtype.char]),
                pa.array([weights.tobytes()], pa.binary()),
            ],
            [prefix + c for c in ("part", "no", "ids", "sizes", "kind", "weights")],
        )

    def pack(batches):
        part, no, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, rows - count))
                batch, count = batch.slice(held[-1].num_rows), count + held[-1].num_rows
                if count == rows:
                    yield block(held, part, no)
                    no, held, count = no + 1, [], 0
        if held:
            yield block(held, part, no)

    kinds = ("part int", "no int", "ids binary", "sizes binary", "kind string", "weights binary")
    return df.select("id", "v").sortWithinPartitions("id").mapInArrow(pack, ", ".join(prefix + x for x in kinds))


def _dense(sizes: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray:
    """Vectors as rows, a term's weights side by side; small whole numbers with the 4 bytes of their products."""
    kind = np.float64 if weights.dtype == np.float64 else np.int32
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = weights
    return np.asfortranarray(out)


def accumulate(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dense scores of query rows against candidate rows, one term at a time; whole numbers of 4 or 8 bytes.

    Fastest on arrays that hold a term's weights side by side (``order="F"``).
    """
    high = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if high == 0:
        return np.zeros((len(q), len(c)), np.int32)
    if not high < 2.0**62:
        exact = [[int(x) for x in row] for row in c]
        full = [[sum(int(a) * b for a, b in zip(row, other, strict=True)) for other in exact] for row in q]
        return np.array([[max(-LONG_MAX, min(LONG_MAX, x)) for x in row] for row in full], np.int64)
    kind = np.int32 if high < 2.0**30 else np.int64
    q, c = q.astype(kind, copy=False), c.astype(kind, copy=False)
    scores = np.zeros((len(q), len(c)), kind)
    step = np.empty_like(scores)
    for t in range(q.shape[1]):
        rows, posting = np.flatnonzero(q[:, t]), np.flatnonzero(c[:, t])
        if len(rows) * 2 > len(q) and len(posting) * 2 > len(c):
            np.multiply(q[:, t, None], c[None, :, t], out=step)
            scores += step
        elif len(rows) and len(posting):
            scores[np.ix_(rows, posting)] += np.outer(q[rows, t], c[posting, t])
    return scores


class Best:
    """The ``k`` highest scores of each query of a block so far, highest first; of equals the smaller ids."""

    def __init__(self, own: np.ndarray, k: int):
        self.own = own
        self.ids, self.scores = np.full((len(own), k), LONG_MAX), np.full((len(own), k), FREE)

    def add(self, start: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries from ``start`` on against candidates ``ids``, which ascend."""
        k, held = self.ids.shape[1], np.iinfo(scores.dtype)
        if k == 0:
            return
        # No candidate below a query's last place can enter; most queries have none that can.
        edge = np.clip(self.scores[start : start + len(scores), -1], held.min, held.max).astype(scores.dtype)
        for j in np.flatnonzero(scores.max(axis=1) >= edge):
            i = start + j
            at = np.flatnonzero(scores[j] >= edge[j])
            at = at[ids[at] != self.own[i]]
            s = scores[j, at]
            if len(s) > k:
                last = np.partition(s, len(s) - k)[len(s) - k]
                above = np.flatnonzero(s > last)
                pick = np.concatenate([above, np.flatnonzero(s == last)[: k - len(above)]])
                at, s = at[pick], s[pick]
            s, x = np.concatenate([self.scores[i], s.astype(np.int64)]), np.concatenate([self.ids[i], ids[at]])
            first = np.lexsort((x, ~s))[:k]
            self.scores[i], self.ids[i] = s[first], x[first]

    def rows(self) -> pa.RecordBatch:
        query, _ = taken = np.nonzero(self.scores != FREE)
        columns = [self.own[query], self.ids[taken], self.scores[taken]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "id", "score"])


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 256.0,
    query_block: int = 2048,
    candidate_block: int = 4096,
) -> DataFrame:
    """``query_id, rank, id, score``: each query's ``k`` highest integer inner products.

    Weights are ``floor(scale * x)``.  A candidate with the query's id is the
    query's own and left out; ties go to the smaller id; fewer than ``k``
    candidates give fewer rows.  Vectors that are null or hold a null or
    non-finite component, and rows with a null id, take no part; rows that
    repeat an id count once (their smallest vector).  Positions beyond the end
    of a shorter vector weigh 0; scores outside the long range are held at its
    end.  Empty tables give an empty result.  Other columns are ignored.
    """
    q, c = _clean(queries, id_col, vec_col), _clean(candidates, id_col, vec_col)
    # Only a row count and no row reaches the driver.
    sets = max(1, math.ceil(q.count() / QUERIES))
    groups = max(GROUPS, 2 * queries.sparkSession.sparkContext.defaultParallelism)
    # Candidates are shuffled once for each set of queries, queries once for each group: both in proportion to the rows.
    left = _packed(c, candidate_block, scale).withColumn("grp", F.expr(f"cast(pmod(xxhash64(part, no), {groups}) as int)"))
    left = left.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    right = _packed(q, query_block, scale, "q_").withColumn("set", F.expr(f"cast(pmod(xxhash64(q_part, q_no), {sets}) as int)"))
    right = right.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # The work is in pairs, not in bytes: by bytes all of it would be dealt to a few tasks.
    dealt = groups * sets
    work = left.repartition(dealt, "grp", "set").hint("merge").join(right.repartition(dealt, "grp", "set").hint("merge"), ["grp", "set"])

    def matrix(row, prefix):
        ids, sizes = (np.frombuffer(row[prefix + name].as_buffer(), kind) for name, kind in (("ids", np.int64), ("sizes", np.int32)))
        return ids, sizes, np.frombuffer(row[prefix + "weights"].as_buffer(), np.dtype(row[prefix + "kind"].as_py()))

    def score(batches):
        best, last = {}, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i] for name in batch.schema.names}
                place = (row["part"].as_py(), row["no"].as_py())
                if place != last:
                    last, (c_ids, c_sizes, c_weights) = place, matrix(row, "")
                    c_ids, cv = c_ids.copy(), _dense(c_sizes, c_weights, int(c_sizes.max(initial=0)))
                q_ids, q_sizes, q_weights = matrix(row, "q_")
                # Terms that only one side has add nothing.
                width = min(int(q_sizes.max(initial=0)), cv.shape[1])
                qv = _dense(q_sizes, q_weights, int(q_sizes.max(initial=0)))[:, :width]
                found = best.setdefault((row["q_part"].as_py(), row["q_no"].as_py()), Best(q_ids.copy(), k))
                for a in range(0, len(q_ids), TILE[0]):
                    for b in range(0, len(c_ids), TILE[1]):
                        found.add(a, accumulate(qv[a : a + TILE[0]], cv[b : b + TILE[1], :width]), c_ids[b : b + TILE[1]])
        for found in best.values():
            yield found.rows()

    found = work.drop("grp", "set").mapInArrow(score, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
