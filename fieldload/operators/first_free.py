"""The first timeseries of every dataset that no earlier one has loaded (W2, C-4, C17).

One after another by numeric id, a dataset takes its first timeseries that no
smaller one has taken; a failing one stops it too and stays free.  Set-based:

1. *Sure stops*: a row that fails, or that no smaller dataset lists, stops its
   dataset for certain, so later rows go.  Datasets whose first row is sure are
   decided, and what they take is gone for the others.
2. *Components*: datasets that are still open depend on each other only through
   timeseries they share.  Labels are contracted to the least of their
   neighbours; they are hashes, so rounds grow with the logarithm of the
   datasets.
3. A component of a bounded number of rows is walked as the rules say, many of
   them in one step.  Only larger ones go through rounds over all their
   datasets.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import cut

# Rows of a component that one task walks (it holds the taken ids only).
WALK_ROWS = 1 << 20

DATASET = ("ds_id", "ds_key")
PICK = "ds_id string, ds_key long, ts_id string, error boolean"


def first_free(fresh: DataFrame, walk_rows: int = WALK_ROWS) -> DataFrame:
    """``ds_id, ds_key, ts_id`` that each dataset creates or fails at, of rows ``ds_id, ds_key, ts_id, error``.

    Datasets of which others have taken every row are left out.
    """
    rows = cut(fresh.select(*DATASET, "ts_id", "error"), "fresh")
    who = F.struct("ds_key", "ds_id")
    # Cut for plain exchanges: a timeseries that many datasets list can be split.
    least = cut(rows.where(~F.col("error")).groupBy("ts_id").agg(F.min(who).alias("least")), "least-datasets")
    judged = rows.join(least, "ts_id", "left").withColumn("sure", F.col("error") | who.eqNullSafe(F.col("least"))).drop("least")
    stops = judged.where("sure").groupBy(*DATASET).agg(F.min("ts_id").alias("stop"))
    near = cut(judged.join(stops, [*DATASET], "left").where("stop IS NULL OR ts_id <= stop").drop("stop"), "near")
    first = near.groupBy(*DATASET).agg(F.min(F.struct("ts_id", "error", "sure")).alias("p")).select(*DATASET, "p.*")
    decided = cut(first.where("sure").drop("sure"), "decided")
    taken = decided.where("NOT error").select("ts_id")
    left = near.join(decided.select(*DATASET), [*DATASET], "left_anti").join(taken, "ts_id", "left_anti")
    left = cut(left.select(*DATASET, "ts_id", "error"), "open")
    if left.isEmpty():
        return decided.select(*DATASET, "ts_id")
    labelled = components(left)
    sizes = cut(labelled.groupBy("label").agg(F.count("*").alias("n")), "component-sizes")
    large = sizes.where(F.col("n") > walk_rows).select("label")
    found = decided.unionByName(cut(walk(labelled.join(large, "label", "left_anti")), "walked"))
    if not large.isEmpty():
        found = found.unionByName(rounds(labelled.join(large, "label", "left_semi")))
    return found.select(*DATASET, "ts_id")


def components(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label``, one for each connected component of datasets and timeseries."""
    labelled = cut(rows.withColumn("label", F.xxhash64(*DATASET)), "labelled")
    while True:
        by_ts = cut(labelled.groupBy("ts_id").agg(F.min("label").alias("low"), F.max("label").alias("high")), "label-ranges")
        if by_ts.where("low <> high").isEmpty():
            return labelled
        to = labelled.join(by_ts, "ts_id").groupBy("label").agg(F.min("low").alias("to"))
        labelled = cut(labelled.join(cut(to, "label-moves"), "label").drop("label").withColumnRenamed("to", "label"), "labelled")


def walk(labelled: DataFrame) -> DataFrame:
    """Picks of whole components, each walked by one task in dataset order."""

    def run(batches):
        label, dataset, taken, stopped = None, None, set(), False
        for batch in batches:
            picks = []
            for a, ds_id, ds_key, ts_id, error in zip(*(batch.column(c).to_pylist() for c in ("label", "ds_id", "ds_key", "ts_id", "error")), strict=True):
                if a != label:
                    label, taken = a, set()
                if (a, ds_id, ds_key) != dataset:
                    dataset, stopped = (a, ds_id, ds_key), False
                if stopped or ts_id in taken:
                    continue
                stopped = True
                if not error:
                    taken.add(ts_id)
                picks.append((ds_id, ds_key, ts_id, error))
            columns = zip(*picks, strict=True) if picks else [[]] * 4
            types = (pa.string(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["ds_id", "ds_key", "ts_id", "error"])

    n = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = labelled.repartition(n, "label").sortWithinPartitions("label", "ds_key", "ds_id", "ts_id")
    return ordered.select("label", *DATASET, "ts_id", "error").mapInArrow(run, PICK)


def rounds(rows: DataFrame) -> DataFrame:
    """Picks by rounds over all datasets, for components too large for one task.

    Each picks its first row left, a timeseries keeps the smallest dataset that
    picked it, and the others lose that row.  The rounds end when no pick is
    lost; the result is that of the walk, because all timeseries prefer
    datasets in the same order.
    """
    left = rows.select(*DATASET, "ts_id", "error")
    while True:
        pick = left.groupBy(*DATASET).agg(F.min(F.struct("ts_id", "error")).alias("_p"))
        pick = cut(pick.select(*DATASET, "_p.*"), "picks")
        good = pick.where(~F.col("error"))
        keeps = good.groupBy("ts_id").agg(F.min(F.struct("ds_key", F.col("ds_id").alias("_keeper"))).alias("_k"))
        lost = cut(
            good.join(keeps.select("ts_id", "_k._keeper"), "ts_id").where("ds_id <> _keeper").select("ds_id", "ts_id"), "lost"
        )
        if lost.isEmpty():
            return pick
        left = cut(left.join(lost, ["ds_id", "ts_id"], "left_anti"), "fresh")
