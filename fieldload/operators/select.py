"""Dataset and timeseries selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_ts, to_int_key
from .expand import dedupe_by_id


def by_id(projects: DataFrame, key: str) -> DataFrame:
    """Rows of one project id (F1).  Equality on the raw id text, pushed to the scan."""
    return projects.where(F.col("id") == F.lit(str(key)))


def by_id_range(projects: DataFrame, lo: int, hi: int) -> DataFrame:
    """Distinct ids whose 32-bit integer value lies in ``[lo, hi]``.

    ANSI cast: one id that is not an integer fails the scan, as a range run
    of the reference does.
    """
    return (
        projects.select("id")
        .where(F.col("id").cast("int").between(int(lo), int(hi)))
        .distinct()
    )


def project_rows(projects: DataFrame) -> DataFrame:
    """One row per project id (S1, O2, C3): the row with the greatest
    ``updated_at``, then a deterministic hash tie-break.  The list of
    timeseries is *not* taken from this row: see ``listed``.
    """
    scalar = [c for c in projects.columns if c != "timeseries"]
    rows = projects.select(*scalar, parse_ts("updated_at").alias("_upd"))
    return dedupe_by_id(rows, "id", prefer="_upd").drop("_upd")


def point_lookup(projects: DataFrame, key: str) -> DataFrame:
    """The project row for one id, list = union over all rows with that id."""
    rows = by_id(projects, key)
    lists = (
        rows.select("id", F.explode("timeseries").alias("t"))
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("t")).alias("timeseries"))
    )
    return project_rows(rows).join(lists, "id", "left")


def listed(projects: DataFrame) -> DataFrame:
    """Distinct ``(ds_id, ts_id)`` pairs listed by the projects (J1 probe side).

    The union over all rows with one id (C3); NULL ids are no members.
    """
    return (
        projects.select(F.col("id").alias("ds_id"), F.explode("timeseries").alias("ts_id"))
        .where(F.col("ds_id").isNotNull() & F.col("ts_id").isNotNull())
        .distinct()
    )


def prior_pairs(state_timeseries: DataFrame, state_dataset: DataFrame) -> DataFrame:
    """Already loaded ``(ds_key, ts_id)`` pairs (S8, F5): the J2 build side."""
    ds = state_dataset.select(F.col("id").alias("_dsid"), to_int_key("ext_id").alias("ds_key"))
    return (
        state_timeseries.where(F.col("ext_id").isNotNull())
        .select(F.col("dataset_id").alias("_dsid"), F.col("ext_id").alias("ts_id"))
        .join(ds, "_dsid")
        .where(F.col("ds_key").isNotNull())
        .select("ds_key", "ts_id")
        .distinct()
    )


def not_loaded(pairs: DataFrame, loaded: DataFrame) -> DataFrame:
    """Pairs whose ``(ds_key, ts_id)`` is not loaded yet.

    An anti join is list-membership semantics: an empty or NULL-holding build
    side removes nothing extra.  NULL probe keys are dropped first.
    """
    return pairs.where(F.col("ts_id").isNotNull()).join(loaded, ["ds_key", "ts_id"], "left_anti")


def owner(pairs: DataFrame) -> DataFrame:
    """For each timeseries the dataset with the smallest numeric id, then id text."""
    return pairs.groupBy("ts_id").agg(F.min_by("ds_id", F.struct("ds_key", "ds_id")).alias("ds_id"))
