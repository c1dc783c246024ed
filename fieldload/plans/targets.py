"""Target rows (K1-K7, P2-P7) and the row-level error flags.

Rows carry natural keys (``ds_id`` = project id text, ``ts_id`` = timeseries
ext id, ``(ts_id, image_index, image_id)`` for images, plus ``box_index``
for boxes).  Surrogate ids are attached on publish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    blank_to_null,
    extra_json,
    hidden,
    json_valid,
    optional_ts,
    parse_ts,
)
from ..operators.expand import attach_metadata, explode_boxes
from ..operators.labels import lookup

# Fixed values.
FILE_PREFIX = "processed/tsimages/imported/"
NO_USER = -1
SITE_SRID = 4326
EXTRA_FIELDS = ("distance", "num_animals", "should_export_images", "camera_inactive", "taken_offset")


def _null(type_name: str):
    return F.lit(None).cast(type_name)


def timeseries_attrs(ts_rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per source timeseries row: target values and dataset-abort flags.

    ``label_error``: a non-blank predicted or ground-truth label that is not
    in the dictionary.  ``date_error``: created/updated text unreadable.
    ``verified_blank``: verified with a blank or NULL ground truth (fails
    only when the row would be created).
    """
    df = ts_rows.select(
        F.col("id").alias("ts_id"),
        "predicted_label",
        "ground_truth_label",
        "status",
        "selected_image",
        parse_ts("created_at").alias("created_ts"),
        parse_ts("updated_at").alias("updated_ts"),
        extra_json(*EXTRA_FIELDS).alias("extra"),
    )
    df = lookup(df, "predicted_label", dictionary, "predicted_species_id", "_pe")
    df = lookup(df, "ground_truth_label", dictionary, "validated_species_id", "_ge")
    verified = F.col("status").eqNullSafe(F.lit("verified"))
    return df.select(
        "ts_id",
        "selected_image",
        "created_ts",
        "updated_ts",
        "extra",
        hidden("predicted_label").alias("hidden"),
        "predicted_species_id",
        "validated_species_id",
        verified.alias("verified"),
        (F.col("_pe") | F.col("_ge")).alias("label_error"),
        (F.col("created_ts").isNull() | F.col("updated_ts").isNull()).alias("date_error"),
        (verified & blank_to_null("ground_truth_label").isNull()).alias("verified_blank"),
    )


def image_rows(refs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Joined image rows with target values and isolated-error flags.

    ``image_error``: exif not JSON, unreadable non-blank ``predicted_at``,
    or NULL box list.
    """
    joined = attach_metadata(refs, metadata)
    classified, classified_bad = optional_ts("predicted_at")
    return joined.select(
        "ts_id",
        "image_index",
        "image_id",
        "selected_image",
        "predicted_boxes",
        F.col("exif").alias("metadata"),
        F.col("taken_at").cast("timestamp_ntz").alias("captured_at"),
        classified.alias("classified_at"),
        hidden("predicted_label").alias("hidden"),
        F.concat(F.lit(FILE_PREFIX), F.col("image_id")).alias("file"),
        (
            ~json_valid("exif") | classified_bad | F.col("predicted_boxes").isNull()
        ).alias("image_error"),
    )


def box_rows(images: DataFrame, dictionary: DataFrame, keep: list[str]) -> DataFrame:
    """Box rows with label id, blur flag and the isolated-error flag.

    ``box_error``: NULL box, unknown or NULL label, or a NULL coordinate on a
    box that is to be blurred (``blur_applies`` tells whether the image is
    redacted in this run; a missing column means it is).
    """
    boxes = explode_boxes(images, keep)
    boxes = lookup(
        boxes, "box_label", dictionary, "label_id", "_unknown", blur_col="blur", blank_is_missing=False
    )
    any_null = (
        F.col("x_min").isNull() | F.col("y_min").isNull() | F.col("x_max").isNull() | F.col("y_max").isNull()
    )
    applies = F.col("blur_applies") if "blur_applies" in boxes.columns else F.lit(True)
    blur = F.coalesce(F.col("blur"), F.lit(False))
    return boxes.withColumn(
        "box_error",
        F.col("box_missing") | F.col("label_id").isNull() | (blur & applies & any_null),
    ).withColumn("blur", blur).drop("_unknown")


def site_rows(site_ids: DataFrame, run_ts: str) -> DataFrame:
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return site_ids.select(
        F.col("site_id").cast("bigint").alias("id"),
        ts.alias("created_at"),
        ts.alias("last_modified_at"),
        F.lit("").alias("comment"),
        F.lit(SITE_SRID).cast("int").alias("original_sr"),
    )


def dataset_rows(ds: DataFrame) -> DataFrame:
    """Dataset rows keyed by ``ext_id`` (raw project id text, C11)."""
    return ds.select(
        F.col("created_ts").alias("created_at"),
        F.col("updated_ts").alias("last_modified_at"),
        F.col("deleted"),
        F.col("site_id").alias("location_id"),
        F.lit(True).alias("locked"),
        F.lit("").alias("comment"),
        _null("bigint").alias("registration_id"),
        _null("interval day to second").alias("delta"),
        F.col("ds_id").alias("ext_id"),
    )


def timeseries_target(attrs: DataFrame) -> DataFrame:
    return attrs.select(
        F.col("created_ts").alias("created_at"),
        F.col("updated_ts").alias("last_modified_at"),
        "extra",
        "hidden",
        F.lit("").alias("comment"),
        "predicted_species_id",
        "validated_species_id",
        F.col("ts_id").alias("ext_id"),
    )


def revision_target(attrs: DataFrame) -> DataFrame:
    """Revision of a verified timeseries (K4): label = ground truth, user -1."""
    return attrs.where(F.col("verified")).select(
        F.col("ts_id"),
        F.col("updated_ts").alias("created_at"),
        F.col("updated_ts").alias("last_modified_at"),
        F.lit(NO_USER).cast("bigint").alias("user_id"),
        F.lit("").alias("comment"),
        F.col("validated_species_id").alias("label_id"),
    )


def selected_images(images: DataFrame) -> DataFrame:
    """Per timeseries the selected image row (K7, F12, J11): the image whose
    id equals the timeseries' selected id, the last position winning."""
    return (
        images.where(F.col("image_id") == F.col("selected_image"))
        .groupBy("ts_id")
        .agg(F.max("image_index").alias("selected_index"))
    )
