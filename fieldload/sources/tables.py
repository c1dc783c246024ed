"""Table loaders (S1-S9 scans) and the two input bundles of an import."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def table_path(template: str, name: str) -> str:
    """Path of one export table: ``TABLE`` in the template is the table name."""
    return template.replace("TABLE", name)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A driver table ``<base>/<name>.parquet`` (pruned and pushed down by Catalyst)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Sources:
    """The three export tables plus the label dictionary source."""

    projects: DataFrame
    timeseries: DataFrame
    images_metadata: DataFrame
    labels: DataFrame


@dataclass(frozen=True)
class State:
    """Target tables as they are before a run (natural keys plus surrogate ids)."""

    site: DataFrame
    dataset: DataFrame
    timeseries: DataFrame
    image: DataFrame
    bbox: DataFrame
    revision: DataFrame
    # The published version these tables were read from; 0 before the first.
    version: int = 0

    def with_tables(self, **tables: DataFrame) -> "State":
        return replace(self, **tables)


def read_sources(spark: SparkSession, template: str, labels_path: str) -> Sources:
    """Read the exports from a path template with declared schemas."""
    return Sources(
        projects=spark.read.schema(schemas.PROJECTS).parquet(table_path(template, "projects")),
        timeseries=spark.read.schema(schemas.TIMESERIES).parquet(table_path(template, "timeseries")),
        images_metadata=spark.read.schema(schemas.IMAGES_METADATA)
        .parquet(table_path(template, "images_metadata"))
        .drop(*schemas.IMAGE_COLUMNS_DROPPED),
        labels=spark.read.schema(schemas.LABELS).parquet(labels_path),
    )


def read_state(spark: SparkSession, base: str) -> State:
    """Read the current version of the published target tables (``plans.publish``)."""
    from ..plans.publish import latest_version, parts_of

    version = latest_version(spark, base)
    parts = parts_of(spark, base, version)

    def load(name: str) -> DataFrame:
        if not parts[name]:
            return spark.createDataFrame([], schemas.TARGETS[name])
        return spark.read.schema(schemas.TARGETS[name]).parquet(*parts[name])

    return State(**{name: load(name) for name in schemas.TARGETS}, version=version)
