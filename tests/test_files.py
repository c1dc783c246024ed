"""Whole files written by tasks, and the images of an import."""

import io
import os
import tempfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldload.functions.pixels import decode, encode_png
from fieldload.plans import import_plan as ip
from fieldload.plans import redact as rd
from fieldload.session import checkpoint_dir
from fieldload.sources import files as sf
from fieldload.sources import fixtures as fx
from fieldload.sources.files import STAGING, list_files, write_files
from test_import_rules import RUN, box, committed, image, make, outcomes, project, series

IMAGES = "processed/tsimages/imported"


def folder(spark, name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir=checkpoint_dir(spark).replace("file:", ""))


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.startswith(".")}


def test_files_are_written_replaced_and_listed(spark):
    root = folder(spark, "files")
    rows = spark.range(300).select(
        F.concat(F.lit("a/b "), (F.col("id") % 3).cast("string"), F.lit("/é"), F.col("id").cast("string")).alias("path"),
        F.concat(F.lit("x"), F.col("id").cast("string")).cast("binary").alias("content"),
    )
    write_files(rows.repartition(4), "file:" + root)
    write_files(rows.where("id < 3").withColumn("content", F.lit(b"new")), root)
    write_files(spark.createDataFrame([("gone", None), (None, b"x")], "path string, content binary"), root)
    found = {r.path: r.length for r in list_files(spark, root).collect()}
    assert len(found) == 300 and found["a/b 0/é0"] == 3 and found["a/b 0/é99"] == 3 and "gone" not in found
    with open(f"{root}/a/b 2/é299", "rb") as f:
        assert f.read() == b"x299"
    assert not os.listdir(f"{root}/{STAGING}")


def test_failed_task_leaves_no_half_file(spark):
    root = folder(spark, "failed")

    def stop(batches):
        for batch in batches:
            yield batch.slice(0, 5)
            raise RuntimeError("task lost")

    rows = spark.range(0, 40, 1, 2).select(F.col("id").cast("string").alias("path"), F.lit(b"abc").alias("content"))
    with pytest.raises(Exception, match="task lost"):
        write_files(rows.mapInArrow(stop, "path string, content binary"), root)
    assert tree(root) == set() and list_files(spark, root).collect() == []
    write_files(rows, root)
    assert len(tree(root)) == 40 and all(r.length == 3 for r in list_files(spark, root).collect())


PIXELS = (np.arange(20 * 30 * 3) % 251).astype(np.uint8).reshape(20, 30, 3)


def land(root, names, bad=()):
    for n in names:
        with open(f"{root}/{n}", "wb") as f:
            f.write(b"no image" if n in bad else encode_png(PIXELS))


def stored(root):
    out = {}
    for name in sorted(tree(root)):
        with open(f"{root}/{name}", "rb") as f:
            out[name.removeprefix(IMAGES + "/")] = decode(f.read())
    return out


def imported(spark, src, st, landed, target, **options):
    return ip.plan_import(src, st, src.projects.select("id"), RUN, files=rd.ImageFiles(rd.list_landed(spark, landed), target), **options)


def test_images_of_an_import_are_stored_once(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b", "c", "d", "e"])],
        [series("a", ["i1", "i2", "i1"]), series("b", ["i3"]), series("c", ["i4", "i5"]), series("d", ["i6"]), series("e", ["i7"])],
        [image("i1", boxes=[box(), box(label="elk")]), image("i2", boxes=[]), image("i3"), image("i4", boxes=[]), image("i5"), image("i6", boxes=[box(xmin=None)]), image("i7")],
    )
    landed, target = folder(spark, "landed"), folder(spark, "targets")
    # i3 is missing, i5 unreadable, i6 stored before (and so not blurred); i9 and i8 are nobody's.
    land(landed, ["i1", "i2", "i4", "i5", "i7", "i8", "i9"], bad={"i5", "i8"})
    os.makedirs(f"{target}/{IMAGES}")
    with open(f"{target}/{IMAGES}/i6", "wb") as f:
        f.write(b"kept as it is")
    plan = imported(spark, src, st, landed, target)
    assert committed(plan) == {"a": "1", "d": "1", "e": "1"}
    assert outcomes(plan)["1"] == ("imported", 5, 5, 2)
    assert tree(target) == {f"{IMAGES}/{n}" for n in ("i1", "i2", "i4", "i6", "i7")}
    os.rename(f"{target}/{IMAGES}/i6", f"{landed}/i6")
    got = stored(target)
    assert (got["i2"] == PIXELS).all() and (got["i1"] != PIXELS).any()
    checked = {r.image_id: r for r in rd.stored_check(plan.jobs.where("image_id <> 'i5'"), target).collect()}
    assert all(r.outside_same and (r.changed_pixels > 0) == (r.n_regions > 0) for r in checked.values())
    # Again: nothing is opened a second time, so the files may be gone.
    for n in ("i1", "i2", "i4"):
        os.truncate(f"{landed}/{n}", 0)
    again = imported(spark, src, st, landed, target)
    assert committed(again) == {"a": "1", "e": "1"} and again.jobs.where("source is not null").count() <= 2


def test_single_goes_on_when_an_image_cannot_be_stored(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b"]), project("2", ["a", "c"])],
        [series("a", ["i1"]), series("b", ["i2"]), series("c", ["i3"])],
        [image("i1"), image("i2"), image("i3")],
    )
    landed, target = folder(spark, "landed"), folder(spark, "targets")
    land(landed, ["i1", "i2", "i3"], bad={"i1"})
    plan = imported(spark, src, st, landed, target, single=True)
    # Both stop at a, which fails and stays free; c was picked, and its image stored, while a was thought taken.
    assert committed(plan) == {} and outcomes(plan)["1"][3] == 1 and outcomes(plan)["2"][3] == 1
    assert tree(target) == {f"{IMAGES}/i3"}


def test_folders_are_listed_by_tasks_and_hold_landed_files_at_any_depth(spark):
    root = folder(spark, "deep")
    for d in ("", "/1F", "/1F/a%20b c", "/.staging", "/_tmp"):
        os.makedirs(root + d, exist_ok=True)
        for n, content in (("i" + str(len(d)), b"abc"), (".x", b"abc"), ("_y", b"abc"), ("empty", b"")):
            with open(f"{root}{d}/{n}", "wb") as f:
                f.write(content)
    listing = list_files(spark, "file:" + root + "/")
    assert {(r.path, r.length) for r in listing.collect()} == {("i0", 3), ("1F/i3", 3), ("1F/a%20b c/i11", 3)}
    # Spark's file index would hold every file of the folders in the driver.
    plan = listing._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" not in plan and root not in {f.replace("file:", "") for f in listing.inputFiles()}
    assert all("listing-" in f for f in listing.inputFiles())
    landed = {r.image_id: r.source for r in rd.list_landed(spark, root).collect()}
    assert landed == {"i0": f"{root}/i0", "i3": f"{root}/1F/i3", "i11": f"{root}/1F/a%20b c/i11"}


def test_target_files_are_looked_up_not_listed(spark, monkeypatch):
    target = folder(spark, "lookup")
    os.makedirs(f"{target}/{IMAGES}")
    for n, content in (("i1", b"x"), ("i2", b""), ("other", b"x")):
        with open(f"{target}/{IMAGES}/{n}", "wb") as f:
            f.write(content)
    ids = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "image_id string")
    found = rd.targets(ids, target)
    assert [r.path for r in found.collect()] == [f"{IMAGES}/i1"]
    src, st = make(spark, [project("1", ["a"])], [series("a", ["i1"])], [image("i1", boxes=[])])
    listed = []
    monkeypatch.setattr(rd, "list_files", lambda spark, root: listed.append(root))
    plan = ip.plan_import(src, st, src.projects.select("id"), RUN, files=rd.ImageFiles(spark.createDataFrame([], "image_id string, source string, length long"), target))
    assert committed(plan) == {"a": "1"} and not listed


def test_many_small_files_are_dealt_over_many_tasks(spark, monkeypatch):
    jobs = spark.range(50).select(F.col("id").cast("string").alias("image_id"), F.lit(1).cast("long").alias("length"))
    monkeypatch.setattr(rd, "TASK_FILES", 2)
    assert rd._spread(jobs).rdd.getNumPartitions() == 25


class Pipe(io.RawIOBase):
    """Cannot seek: ZIP then puts sizes behind the content."""

    def __init__(self, file):
        self.file = file

    def writable(self):
        return True

    def write(self, data):
        return self.file.write(data)


def test_images_are_read_from_packages(spark):
    """Stored, compressed and streamed members, beside plain files; damaged ones fail their timeseries only."""
    names = ["i1", "i2", "i3", "i4", "i5", "i6"]
    src, st = make(spark, [project("1", list("abcdef"))], [series(t, [i]) for t, i in zip("abcdef", names, strict=True)], [image(i, boxes=[]) for i in names])
    landed, target, png = folder(spark, "landed"), folder(spark, "targets"), encode_png(PIXELS)
    os.makedirs(f"{landed}/1F")
    with zipfile.ZipFile(f"{landed}/1F/a.zip", "w") as z:
        for name, content in (("x/i1", png), ("x/", b""), (".hidden", png), ("_x/i9", png), ("empty", b""), ("i5", png)):
            z.writestr(name, content)
    with zipfile.ZipFile(f"{landed}/b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("i2", png)
    with open(f"{landed}/c.zip", "wb") as f, zipfile.ZipFile(Pipe(f), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("i3", png)
    land(landed, ["i4", "not.zip"], bad={"not.zip"})
    with open(f"{landed}/1F/a.zip", "rb+") as f:
        data = f.read()
        f.seek(data.rindex(png) + 60)
        f.write(b"\0\0\0\0\0\0")
    found = {r.image_id: (r.source.removeprefix(landed), r.start is not None, r.length) for r in rd.list_landed(spark, landed).collect()}
    size = len(png)
    assert found == {
        "i1": ("/1F/a.zip", True, size), "i5": ("/1F/a.zip", True, size), "i2": ("/b.zip", True, size), "i3": ("/c.zip", True, size),
        "i4": ("/i4", False, size), "not.zip": ("/not.zip", False, 8),
    }
    plan = imported(spark, src, st, landed, target)
    assert committed(plan) == {t: "1" for t in "abcd"}
    got = stored(target)
    assert sorted(got) == ["i1", "i2", "i3", "i4"] and all((px == PIXELS).all() for px in got.values())
    checked = rd.stored_check(plan.jobs.where("image_id < 'i5'"), target).collect()
    assert len(checked) == 4 and all(r.outside_same and r.changed_pixels == 0 for r in checked)


def test_packages_hold_every_row_and_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sf, "PACKAGE_BYTES", 1000)
    monkeypatch.setattr(sf, "PACKAGE_FILES", 7)
    root = folder(spark, "packages")
    rows = spark.range(100).select(F.concat(F.lit("é/"), F.col("id").cast("string")).alias("path"), F.repeat(F.lit("x"), F.col("id").cast("int")).cast("binary").alias("content"))
    gone = spark.createDataFrame([("gone", None), (None, b"x")], "path string, content binary")
    write_files(sf.packages(rows.repartition(3).unionByName(gone)), root)
    held = []
    for name in tree(root):
        with zipfile.ZipFile(f"{root}/{name}") as z:
            held.append({n: len(z.read(n)) for n in z.namelist()})
            assert len(held[-1]) <= 7 and sum(held[-1].values()) < 1000 + 100
    assert {k: v for x in held for k, v in x.items()} == {f"é/{i}": i for i in range(100)} and sum(map(len, held)) == 100
    # The empty one is left out, as an empty file is.
    listed = sf.unpacked(list_files(spark, root), root).collect()
    assert {r.path.split("/")[-1]: r.length for r in listed} == {str(i): i for i in range(1, 100)}
    assert all(sf.read_member(f"{root}/{r.file}", r.start) == b"x" * r.length for r in listed)


def test_landed_fixture_takes_no_file_for_each_image(spark):
    sf_dir = "/root/testdata/sf0.001"
    files = fx.image_files(spark, sf_dir)
    made = {r.path: r.n for r in fx.landed_images(fx.events(spark, sf_dir)).select("path", F.length("content").alias("n")).collect()}
    assert {r.image_id: r.length for r in files.landed.collect()} == made
    assert len(tree(f"{fx.load(spark, sf_dir).root}/landed".replace("file:", ""))) < len(made) / 20
