"""Purge of datasets with their children (C-5, K9, J10, C15).

The reference deletes, in one transaction: boxes of the dataset's images,
its images (by ``image.dataset_id``), revisions of its timeseries, its
timeseries, the dataset.  Sites, labels and files stay.  Here the doomed
keys are built by joins and every table keeps its survivors (anti joins);
the caller publishes them as a new version.  Unknown ids purge nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import to_int_key
from ..operators.joins import narrowed
from ..sources.tables import State


def doomed_datasets(state: State, ids: DataFrame) -> DataFrame:
    """Surrogate ids of the datasets named by ``ids`` (first column, ext id text).

    Compared on the integer form on both sides (C11), or as text where an id
    is no integer.
    """
    def keyed(text):
        number = to_int_key(text)
        return F.when(number.isNotNull(), F.concat(F.lit("#"), number.cast("string"))).otherwise(F.concat(F.lit("="), text))

    keys = ids.select(keyed(F.col(ids.columns[0]).cast("string")).alias("ds_key")).where("ds_key is not null").distinct()
    rows = state.dataset.select(F.col("id").alias("dataset_id"), keyed(F.col("ext_id")).alias("ds_key"))
    return narrowed(rows, keys, "ds_key").join(keys, "ds_key", "left_semi").select("dataset_id").distinct()


def purge(state: State, ids: DataFrame) -> State:
    ds = doomed_datasets(state, ids)
    doomed_images = state.image.join(ds, "dataset_id", "left_semi").select(F.col("id").alias("image_id"))
    doomed_ts = state.timeseries.join(ds, "dataset_id", "left_semi").select(F.col("id").alias("timeseries_id"))
    return state.with_tables(
        bbox=state.bbox.join(doomed_images, "image_id", "left_anti"),
        image=state.image.join(ds, "dataset_id", "left_anti"),
        revision=state.revision.join(doomed_ts, "timeseries_id", "left_anti"),
        timeseries=state.timeseries.join(ds, "dataset_id", "left_anti"),
        dataset=state.dataset.join(ds.withColumnRenamed("dataset_id", "id"), "id", "left_anti"),
    )
