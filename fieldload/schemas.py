"""Source and target schemas.

Source tables are exports; their schemas are known only from use, so readers
apply these explicitly instead of inferring them.
"""

from __future__ import annotations

from pyspark.sql import types as T

BOX = T.StructType(
    [
        T.StructField("xmin", T.DoubleType()),
        T.StructField("ymin", T.DoubleType()),
        T.StructField("xmax", T.DoubleType()),
        T.StructField("ymax", T.DoubleType()),
    ]
)

PREDICTED_BOX = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("box", BOX),
    ]
)

BOXES = T.ArrayType(PREDICTED_BOX)

PROJECTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("camera_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("timeseries", T.ArrayType(T.StringType())),
    ]
)

TIMESERIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("selected_image", T.StringType()),
        T.StructField("predicted_label", T.StringType()),
        T.StructField("ground_truth_label", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("num_animals", T.IntegerType()),
        T.StructField("should_export_images", T.BooleanType()),
        T.StructField("camera_inactive", T.BooleanType()),
        T.StructField("taken_offset", T.StringType()),
    ]
)

IMAGES_METADATA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("exif", T.StringType()),
        T.StructField("taken_at", T.TimestampNTZType()),
        T.StructField("predicted_at", T.StringType()),
        T.StructField("predicted_label", T.StringType()),
        T.StructField("predicted_boxes", BOXES),
        T.StructField("ground_truth_label", T.StringType()),
        T.StructField("ground_truth_boxes", BOXES),
    ]
)

# Columns of images_metadata the engine never reads.
IMAGE_COLUMNS_DROPPED = ("ground_truth_label", "ground_truth_boxes")

LABELS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("blur", T.BooleanType()),
    ]
)

# Target tables.  Surrogate ids are given on publish; inside the engine rows
# are identified by their natural keys (ext ids, positions).
SITE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_modified_at", T.TimestampNTZType()),
        T.StructField("comment", T.StringType()),
        T.StructField("original_sr", T.IntegerType()),
    ]
)

DATASET = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_modified_at", T.TimestampNTZType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("locked", T.BooleanType()),
        T.StructField("comment", T.StringType()),
        T.StructField("registration_id", T.LongType()),
        T.StructField("delta", T.DayTimeIntervalType()),
        T.StructField("ext_id", T.StringType()),
    ]
)

TIMESERIES_TARGET = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_modified_at", T.TimestampNTZType()),
        T.StructField("extra", T.StringType()),
        T.StructField("dataset_id", T.LongType()),
        T.StructField("hidden", T.BooleanType()),
        T.StructField("comment", T.StringType()),
        T.StructField("predicted_species_id", T.LongType()),
        T.StructField("selected_image_id", T.LongType()),
        T.StructField("validated_species_id", T.LongType()),
        T.StructField("ext_id", T.StringType()),
    ]
)

IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("uuid", T.StringType()),
        T.StructField("dataset_id", T.LongType()),
        T.StructField("hidden", T.BooleanType()),
        T.StructField("sequence_index", T.IntegerType()),
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("timeseries_id", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("classified_at", T.TimestampNTZType()),
        T.StructField("ext_id", T.StringType()),
    ]
)

BBOX = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("image_id", T.LongType()),
        T.StructField("label_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("x_min", T.DoubleType()),
        T.StructField("x_max", T.DoubleType()),
        T.StructField("y_min", T.DoubleType()),
        T.StructField("y_max", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ext_id", T.StringType()),
    ]
)

REVISION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_modified_at", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("comment", T.StringType()),
        T.StructField("label_id", T.LongType()),
        T.StructField("timeseries_id", T.LongType()),
    ]
)

TARGETS = {
    "site": SITE,
    "dataset": DATASET,
    "timeseries": TIMESERIES_TARGET,
    "image": IMAGE,
    "bbox": BBOX,
    "revision": REVISION,
}
