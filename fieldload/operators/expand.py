"""List expansion and the image join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast
from .stage import cut

# Columns of images_metadata the import reads (P1: everything but the
# ground-truth pair, which Catalyst then prunes from the scan).
METADATA_COLUMNS = ("id", "exif", "taken_at", "predicted_at", "predicted_label", "predicted_boxes")


def explode_refs(timeseries: DataFrame) -> DataFrame:
    """One row per element of ``images``: ``ts_id, image_index, image_id, selected_image``.

    Positions are 1-based and count every element, also the ones that will
    find no metadata; NULL or empty lists give no rows.
    """
    return timeseries.select(
        F.col("id").alias("ts_id"),
        F.col("selected_image"),
        F.posexplode("images").alias("_pos", "image_id"),
    ).select(
        "ts_id",
        (F.col("_pos") + 1).cast("int").alias("image_index"),
        "image_id",
        "selected_image",
    )


def dedupe_by_id(df: DataFrame, key: str = "id", prefer: str | None = None) -> DataFrame:
    """One row per ``key`` (A3).  The kept row has the greatest ``prefer``
    value, then the greatest hash of the row: arbitrary but deterministic.

    Done with ``max_by`` so the work is a partial aggregation: a hot key is
    combined map-side and never gathered into one task as rows.
    """
    others = [c for c in df.columns if c != key]
    order = [F.col(prefer)] if prefer else []
    order.append(F.xxhash64(*[F.col(c) for c in others]))
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


def image_metadata(images_metadata: DataFrame) -> DataFrame:
    """The metadata columns the import uses, one row per image id.

    Ids are counted first, without the wide columns; only rows of ids that
    repeat go through the dedupe.  The others stay rows of the scan, so the
    image join shuffles them once, and its exchange can be split at a hot id.
    """
    cols = [c for c in METADATA_COLUMNS if c in images_metadata.columns]
    rows = images_metadata.select(*cols)
    repeated = cut(rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"), "repeated-images")
    repeated = bounded_broadcast(repeated)
    once = rows.join(repeated, "id", "left_anti").select(*cols)
    many = dedupe_by_id(rows.join(repeated, "id", "left_semi"), "id", prefer="predicted_at")
    return once.unionByName(many)


def attach_metadata(refs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Inner join of image refs with their metadata on the image id.

    A ref without metadata is dropped; a repeated ref keeps each position.
    The ref side's ``image_index`` and ``selected_image`` win (P6).
    """
    meta = metadata.withColumnRenamed("id", "image_id")
    return refs.join(meta, "image_id", "inner")


def explode_boxes(images: DataFrame, keep: list[str]) -> DataFrame:
    """One row per predicted box (X12, P5): ``keep`` columns plus box fields.

    ``box_index`` is 1-based; a NULL list gives no rows here (it is an error
    flagged at image level); a NULL element keeps a row with NULL fields.
    """
    return images.select(
        *keep, F.posexplode("predicted_boxes").alias("_bpos", "_b")
    ).select(
        *keep,
        (F.col("_bpos") + 1).cast("int").alias("box_index"),
        F.col("_b").isNull().alias("box_missing"),
        F.col("_b.label").alias("box_label"),
        F.col("_b.score").alias("score"),
        F.col("_b.box.xmin").alias("x_min"),
        F.col("_b.box.ymin").alias("y_min"),
        F.col("_b.box.xmax").alias("x_max"),
        F.col("_b.box.ymax").alias("y_max"),
    )


def timeseries_image_summary(images: DataFrame) -> DataFrame:
    """Per timeseries, its images in position order, summarised.

    The ordered group is never materialised as a list: ``min_by``/``max_by``
    over the position are partial aggregates, so even a timeseries holding a
    third of all images is combined map-side.
    """
    return images.groupBy("ts_id").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.min("image_index").alias("first_index"),
        F.max("image_index").alias("last_index"),
        F.min_by("image_id", "image_index").alias("first_image"),
        F.max_by("image_id", "image_index").alias("last_image"),
    )


def ordered_images(images: DataFrame, partitions: int | None = None) -> DataFrame:
    """Images globally ordered by (timeseries, position).

    Range partitioning on both columns lets one large timeseries span many
    partitions; each partition is sorted locally.
    """
    n = partitions or int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return images.repartitionByRange(n, "ts_id", "image_index").sortWithinPartitions(
        "ts_id", "image_index"
    )
