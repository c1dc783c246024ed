"""Image output (U2, X9, X15, F11, J12, S10, S11, K8, C-1, C-2, C14).

An import with ``ImageFiles`` stores the images of its timeseries: landed files
are listed without their content, joined to the images the run needs, and each
is opened, decoded, blurred and encoded in the one task that writes it.  What
cannot be stored fails its timeseries, as unreadable sources fail it before.

Rectangles are columns computed by built-ins; only the pixel work runs in
Python, as Arrow batches with numpy.  Decoded rows use the layout of Spark's
``image`` source, which reads formats other than PNG (``read_landed``).
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pixels import blur_region, decode, encode_png, pixel_rects
from ..functions.scalars import pixel_bound
from ..operators.joins import is_small
from ..operators.stage import cut
from ..sources.files import file_system, list_files, present, read_bytes, read_member, unpacked, write_files
from .targets import FILE_PREFIX

# The Python steps below run on executors; pickle this module's functions by
# value so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes and number of source files for one task, and bytes of encoded images for one Arrow batch, about.
TASK_BYTES = 64 << 20
TASK_FILES = 20_000
BATCH_BYTES = 16 << 20


def read_landed(spark, path: str) -> DataFrame:
    """Landed JPEG/PNG files through Spark's image source, keyed by file name."""
    img = spark.read.format("image").option("dropInvalid", "true").load(path)
    return img.select(
        F.element_at(F.split("image.origin", "/"), -1).alias("image_id"),
        F.col("image.origin").alias("origin"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("nChannels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
    )


def blur_regions(blur_boxes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pixel rectangles of blurred boxes, one per (image, box position).

    Round half to even of (x_min w, y_min h, x_max w, y_max h).  One image
    can sit in several timeseries; its file is redacted once, so rectangles
    are distinct per image id.
    """
    boxes = blur_boxes.select("image_id", "box_index", "x_min", "y_min", "x_max", "y_max").distinct()
    return boxes.join(sizes, "image_id").select(
        "image_id",
        "box_index",
        pixel_bound("x_min", "width").alias("x0"),
        pixel_bound("y_min", "height").alias("y0"),
        pixel_bound("x_max", "width").alias("x1"),
        pixel_bound("y_max", "height").alias("y1"),
    )


def file_state(images: DataFrame, listing: DataFrame) -> DataFrame:
    """Whether each image row's target file exists already."""
    return images.join(
        listing.select(F.col("path").alias("file"), F.lit(True).alias("_hit")).distinct(), "file", "left"
    ).select(
        "ext_id",
        "timeseries_ext_id",
        "sequence_index",
        "file",
        F.coalesce("_hit", F.lit(False)).alias("target_exists"),
    )


def apply_regions(px: np.ndarray, rects) -> np.ndarray:
    """Blur each rectangle in turn (list order)."""
    for rect in rects:
        blur_region(px, rect)
    return px


def rects_per_image(regions: DataFrame) -> DataFrame:
    """Rectangles of each image in box order (bounded by one metadata row's boxes)."""
    return regions.groupBy("image_id").agg(
        F.array_sort(F.collect_list(F.struct("box_index", "x0", "y0", "x1", "y1"))).alias("rects")
    )


def redact(landed: DataFrame, regions: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Pixel rows to store (K8): of ``images`` (their ``image_id``), or of the images with a region."""
    return redact_rects(landed, rects_per_image(regions), images)


def redact_rects(landed: DataFrame, rects: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Landed images with ``rects`` (from ``rects_per_image``) blurred.

    Rectangles travel to the task that reads and decodes the file: with few
    of them they are broadcast and no pixel is shuffled.  Images without a
    rectangle come out as they are.  Out-of-range rectangles are clamped to
    the image and empty ones do nothing.
    """
    ids = rects.select("image_id") if images is None else images.select("image_id").distinct()
    wanted = ids.join(rects, "image_id", "left")
    # Decoded images are large; Arrow batches into the Python step are cut by
    # ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default), so a
    # batch holds a few large images or many small ones.
    flat = wanted.select("image_id", F.to_json("rects").alias("_size"))
    rows = landed.join(F.broadcast(wanted) if is_small(flat) else wanted, "image_id")

    def run(batches):
        for pdf in batches:
            out = []
            for rec in pdf.itertuples(index=False):
                h, w, c = int(rec.height), int(rec.width), int(rec.nChannels)
                px = np.frombuffer(rec.data, dtype=np.uint8).reshape(h, w, c).copy()
                before = px.copy()
                boxes = [(r["x0"], r["y0"], r["x1"], r["y1"]) for r in (() if rec.rects is None else rec.rects)]
                px = apply_regions(px, boxes)
                moved = np.any(px != before, axis=2)
                changed = int(np.count_nonzero(moved))
                for x0, y0, x1, y1 in boxes:
                    moved[max(int(y0), 0) : max(int(y1), 0), max(int(x0), 0) : max(int(x1), 0)] = False
                out.append((rec.image_id, h, w, c, px.tobytes(), len(boxes), changed, not moved.any()))
            yield pd.DataFrame(
                out,
                columns=["image_id", "height", "width", "nChannels", "data", "n_regions", "changed_pixels", "outside_same"],
            )

    schema = (
        "image_id string, height int, width int, nChannels int, data binary, n_regions int, changed_pixels int, "
        "outside_same boolean"
    )
    return rows.select("image_id", "height", "width", "nChannels", "data", "rects").mapInPandas(run, schema)


@dataclass
class ImageFiles:
    """Image output of an import: ``landed`` from ``list_landed``, targets below ``root``."""

    landed: DataFrame
    root: str


def list_landed(spark: SparkSession, root: str) -> DataFrame:
    """Landed files by image id (their name): ``image_id, source, start, length``; no image is opened.

    Those in packages are ranges of their package, from ``start`` on.
    """
    files = unpacked(list_files(spark, root), root)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("image_id"), F.concat(F.lit(root.rstrip("/") + "/"), F.col("file")).alias("source"), "start", "length"
    )


def _landed_bytes(source: str, start: int | None) -> bytes:
    return read_bytes(source) if start is None else read_member(source, start)


def image_jobs(images: DataFrame, boxes: DataFrame, files: ImageFiles) -> DataFrame:
    """One row for each image to store: ``image_id, file, source, start, length, boxes``.

    ``images``: rows without a target file; ``boxes``: their box rows, of which
    the blurred ones are kept in box order (bounded by one metadata row).  An
    image in several timeseries is one job; of several landed files the least.
    """
    wanted = images.where(~F.col("target_exists")).select("image_id", "file").distinct()
    corners = boxes.where("blur and blur_applies").select("image_id", "box_index", "x_min", "y_min", "x_max", "y_max").distinct()
    lists = corners.groupBy("image_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("box_index", "x_min", "y_min", "x_max", "y_max"))),
            lambda b: F.array(b["x_min"], b["y_min"], b["x_max"], b["y_max"]),
        ).alias("boxes")
    )
    start = "start" if "start" in files.landed.columns else F.lit(None).cast("long").alias("start")
    landed = files.landed.join(wanted.select("image_id"), "image_id", "left_semi").select("image_id", F.struct("source", start, "length").alias("_f"))
    rows = wanted.join(landed.groupBy("image_id").agg(F.min("_f").alias("_f")), "image_id", "left").join(lists, "image_id", "left")
    return rows.select("image_id", "file", "_f.source", "_f.start", "_f.length", "boxes")


def _spread(jobs: DataFrame) -> DataFrame:
    """Jobs dealt by the bytes and number of their files, on all cores at least (a small shuffle would be coalesced into few tasks)."""
    files, total = jobs.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    least = jobs.sparkSession.sparkContext.defaultParallelism
    return jobs.repartition(max(least, math.ceil(total / TASK_BYTES), math.ceil(files / TASK_FILES)), "image_id")


def encoded(jobs: DataFrame) -> DataFrame:
    """``path, content`` of every job: the landed image, regions blurred, as PNG; null where it cannot be read."""

    def store(source, start, boxes):
        if source is None:
            return None
        try:
            px = decode(_landed_bytes(source, start))
        except (OSError, ValueError):
            return None
        px = px.copy()
        for rect in pixel_rects(boxes or [], px.shape[1], px.shape[0]):
            blur_region(px, rect)
        return encode_png(px)

    def batch(paths, contents):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    def run(batches):
        paths, contents, size = [], [], 0
        for rows in batches:
            for path, *image in zip(*(rows.column(c).to_pylist() for c in ("file", "source", "start", "boxes")), strict=True):
                paths.append(path)
                contents.append(store(*image))
                size += len(contents[-1] or b"")
                if size > BATCH_BYTES:
                    yield batch(paths, contents)
                    paths, contents, size = [], [], 0
        yield batch(paths, contents)

    return _spread(jobs.select("image_id", "file", "source", "start", "length", "boxes")).mapInArrow(run, "path string, content binary")


def absent(jobs: DataFrame, root: str) -> DataFrame:
    """``image_id`` of the jobs whose target is not below ``root``; each task looks for its own files."""

    def run(batches):
        system, base = file_system(root)
        for rows in batches:
            found = system.get_file_info([f"{base}/{f}" for f in rows.column("file").to_pylist()])
            lost = [i for i, x in zip(rows.column("image_id").to_pylist(), found, strict=True) if x.type != pafs.FileType.File]
            yield pa.RecordBatch.from_arrays([pa.array(lost, pa.string())], ["image_id"])

    root = root.rstrip("/")
    return jobs.select("image_id", "file").mapInArrow(run, "image_id string")


def store_images(jobs: DataFrame, root: str) -> DataFrame:
    """K8: write the image of every job below ``root``; ``image_id`` of those that could not be stored.

    Files are whole or absent (``write_files``).  A retry writes the same files again.
    """
    write_files(encoded(jobs), root)
    return cut(absent(jobs, root), "images-not-stored")


def stored_check(jobs: DataFrame, root: str) -> DataFrame:
    """Stored images against their sources: ``image_id, height, width, n_regions, changed_pixels, outside_same``."""

    def run(batches):
        for rows in batches:
            out = []
            for row in rows.select(["image_id", "file", "source", "start", "boxes"]).to_pylist():
                before, after = decode(_landed_bytes(row["source"], row["start"])), decode(read_bytes(f"{root}/{row['file']}"))
                h, w = after.shape[:2]
                moved = np.any(before != after, axis=2)
                changed, boxes = int(moved.sum()), row["boxes"] or []
                for x0, y0, x1, y1 in pixel_rects(boxes, w, h):
                    moved[max(y0, 0) : max(y1, 0), max(x0, 0) : max(x1, 0)] = False
                out.append((row["image_id"], h, w, len(boxes), changed, not moved.any()))
            yield pd.DataFrame(out, columns=names)

    def arrow(batches):
        for frame in run(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=kinds, preserve_index=False)

    names = ["image_id", "height", "width", "n_regions", "changed_pixels", "outside_same"]
    kinds = pa.schema(list(zip(names, [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()], strict=True)))
    root = root.rstrip("/")
    schema = "image_id string, height int, width int, n_regions int, changed_pixels int, outside_same boolean"
    return _spread(jobs.select("image_id", "file", "source", "start", "length", "boxes")).mapInArrow(arrow, schema)


def targets(images: DataFrame, root: str) -> DataFrame:
    """``path`` (relative to ``root``) of the target files that the images (``image_id``) have already."""
    return present(images.select(F.concat(F.lit(FILE_PREFIX), F.col("image_id")).alias("path")), root)


def file_inputs(images: DataFrame, listing: DataFrame, landed: DataFrame) -> DataFrame:
    """``(image_id, target_exists, source_readable)`` for ``plan_import``:
    target file already written (``listing`` of the target root or ``targets``,
    relative paths) and source image landed and decodable (``landed``)."""
    ids = images.select("image_id").distinct()
    target = listing.select(
        F.regexp_replace("path", "^" + FILE_PREFIX, "").alias("image_id"), F.lit(True).alias("target_exists")
    ).distinct()
    source = landed.select("image_id", F.lit(True).alias("source_readable")).distinct()
    return ids.join(target, "image_id", "left").join(source, "image_id", "left").fillna(
        False, ["target_exists", "source_readable"]
    )
