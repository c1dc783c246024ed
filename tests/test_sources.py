"""Production readers: Spark's image source, binaryFile listing, ordering."""

import os
import struct
import tempfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from fieldload.operators import expand
from fieldload.plans import redact as rd
from fieldload.session import checkpoint_dir
from fieldload.sources import fixtures as fx
from fieldload.sources.files import list_files


def write_png(path, px):
    """Minimal 8-bit RGB PNG writer (no imaging library here)."""
    h, w, _ = px.shape
    raw = b"".join(b"\x00" + px[y].tobytes() for y in range(h))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n")
        f.write(chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)))
        f.write(chunk(b"IDAT", zlib.compress(raw)))
        f.write(chunk(b"IEND", b""))


def test_landed_png_is_read_and_redacted(spark):
    root = tempfile.mkdtemp(prefix="landed-", dir=checkpoint_dir(spark).replace("file:", ""))
    px = (np.arange(20 * 30 * 3) % 251).astype(np.uint8).reshape(20, 30, 3)
    write_png(os.path.join(root, "img7"), px)
    landed = rd.read_landed(spark, root)
    row = landed.first()
    assert (row.image_id, row.height, row.width, row.nChannels) == ("img7", 20, 30, 3)
    regions = spark.createDataFrame([("img7", 1, 5, 5, 15, 15)], "image_id string, box_index int, x0 int, y0 int, x1 int, y1 int")
    out = rd.redact(landed, regions).first()
    assert out.n_regions == 1 and 0 < out.changed_pixels <= 100
    data = np.frombuffer(out.data, np.uint8).reshape(20, 30, 3)
    original = np.frombuffer(row.data, np.uint8).reshape(20, 30, 3)
    mask = np.zeros((20, 30), bool)
    mask[5:15, 5:15] = True
    assert (data[~mask] == original[~mask]).all()


def test_binary_file_listing_feeds_file_state(spark):
    root = tempfile.mkdtemp(prefix="targets-", dir=checkpoint_dir(spark).replace("file:", ""))
    os.makedirs(os.path.join(root, "processed", "tsimages", "imported"))
    with open(os.path.join(root, "processed", "tsimages", "imported", "i1"), "wb") as f:
        f.write(b"x" * 10)
    listing = list_files(spark, root)
    assert list_files(spark, root + "/none").collect() == []
    assert [(r.path, r.length) for r in listing.collect()] == [("processed/tsimages/imported/i1", 10)]
    imgs = spark.createDataFrame(
        [("i1", "t", 1, "processed/tsimages/imported/i1"), ("i2", "t", 2, "processed/tsimages/imported/i2")],
        "ext_id string, timeseries_ext_id string, sequence_index int, file string",
    )
    got = {r.ext_id: r.target_exists for r in rd.file_state(imgs, listing).collect()}
    assert got == {"i1": True, "i2": False}


def test_ordered_images_global_order_spans_partitions(spark):
    rows = [("big", i, f"x{i}") for i in range(1, 401)] + [("a", 1, "y"), ("c", 2, "z")]
    imgs = spark.createDataFrame(rows, "ts_id string, image_index int, image_id string")
    ordered = expand.ordered_images(imgs, partitions=4)
    parts = ordered.withColumn("p", F.spark_partition_id()).collect()
    keys = [(r.ts_id, r.image_index) for r in parts]
    assert keys == sorted(keys)
    assert len({r.p for r in parts if r.ts_id == "big"}) > 1


def test_prior_state_is_made_from_the_written_exports(spark, monkeypatch):
    """Events are read and grouped once, not again for every table of prior state."""
    base = tempfile.mkdtemp(prefix="events-", dir=checkpoint_dir(spark).replace("file:", ""))
    rows = spark.range(60).selectExpr(
        "id AS event_id", "timestamp '2024-03-01 08:00:00' + make_interval(0, 0, 0, cast(id % 7 AS int)) AS ts", "1 + id % 5 AS user_id",
        "'click' AS event_type", "cast(id AS double) AS value", "'{}' AS props",
    )
    rows.coalesce(1).write.parquet(f"{base}/events.parquet")
    read = []
    made = fx.prior_rows

    def prior_rows(src, ds, keys, run_ts):
        state = made(src, ds, keys, run_ts)
        read.extend(f for name in ("timeseries", "image", "bbox", "revision") for f in getattr(state, name).inputFiles())
        read.extend(f for t in (src.projects, src.timeseries, src.images_metadata, src.labels, ds, keys) for f in t.inputFiles())
        return state

    monkeypatch.setattr(fx, "prior_rows", prior_rows)
    prior = fx.load(spark, base).prior
    assert read and not [f for f in read if "events.parquet" in f]
    assert {r.ext_id for r in prior.dataset.collect()} == {"2", "4"}
    assert prior.timeseries.count() == 10 and prior.image.count() == prior.image.select("id").distinct().count() > 0
