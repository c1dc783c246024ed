"""Import projects as their export files land.

A file stream over the projects folder yields the new project rows of each
micro-batch; ``foreachBatch`` runs the batch import for exactly those ids
against the latest published state and publishes a new version.  A replayed
batch (after a failure) adds nothing twice: loaded timeseries, datasets and
sites are skipped by the same rules that make a second run idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans import import_plan as ip
from ..plans.publish import StaleVersion, compact, run_import
from ..session import configure
from ..sources.tables import read_sources, read_state, table_path

COMPACT_EVERY = 100


def import_batch(
    spark: SparkSession, batch: DataFrame, template: str, labels_path: str, warehouse: str, run_ts: str
) -> int | None:
    """Import the project ids of one micro-batch; returns the current version.

    Every ``COMPACT_EVERY`` versions the accumulated parts are rewritten.
    """
    ids = batch.select("id").where("id IS NOT NULL").distinct()
    if ids.isEmpty():
        return None
    src = read_sources(spark, template, labels_path)
    while True:
        state = read_state(spark, warehouse)
        try:
            version = run_import(ip.plan_import(src, state, ids, run_ts), warehouse)
        except StaleVersion:
            continue  # another run published meanwhile: plan on its state
        break
    if version % COMPACT_EVERY == 0 and version > state.version:
        version = compact(spark, warehouse)
    return version


def start(
    spark: SparkSession,
    template: str,
    labels_path: str,
    warehouse: str,
    checkpoint: str,
    run_ts: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream over ``template``'s projects folder; one import per micro-batch."""
    configure(spark)
    stream = spark.readStream.schema(schemas.PROJECTS).parquet(table_path(template, "projects"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        import_batch(batch.sparkSession, batch, template, labels_path, warehouse, run_ts)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
