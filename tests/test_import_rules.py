"""Rules of the import contract on tiny hand-built exports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldload import schemas
from fieldload.plans import import_plan as ip
from fieldload.plans import purge as pg
from fieldload.sources.tables import Sources, State

RUN = "2025-01-01 00:00:00"
LABELS = [(1, "nothing", False), (2, "fox", True), (3, "elk", False)]


def box(label="fox", xmin=0.1, ymin=0.1, xmax=0.5, ymax=0.5):
    return (0.9, label, (xmin, ymin, xmax, ymax))


def project(pid, ts, status="done", camera="7"):
    return (pid, status, camera, "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z", False, ts)


def series(tid, images, label="fox", gt=None, status="pending", selected=None):
    return (tid, images, selected, label, gt, status, "2024-01-01T00:00:00Z", "2024-01-01T12:00:00Z", 1.0, 1, True, False, None)


def image(iid, exif="{}", predicted_at="2024-01-01T00:00:00", label="fox", boxes=None):
    return (iid, exif, dt.datetime(2024, 1, 1), predicted_at, label, [box()] if boxes is None else boxes, None, None)


def make(spark, projects, timeseries, images, prior_ts=(), prior_ds=()):
    src = Sources(
        projects=spark.createDataFrame(projects, schemas.PROJECTS),
        timeseries=spark.createDataFrame(timeseries, schemas.TIMESERIES),
        images_metadata=spark.createDataFrame(images, schemas.IMAGES_METADATA),
        labels=spark.createDataFrame(LABELS, schemas.LABELS),
    )
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.TARGETS.items()}
    ds_rows = [(1000 + i, None, None, False, 7, True, "", None, None, ext) for i, ext in enumerate(prior_ds)]
    ts_rows = [(i + 1, None, None, None, ds, False, "", None, None, None, ext) for i, (ext, ds) in enumerate(prior_ts)]
    empty["dataset"] = spark.createDataFrame(ds_rows, schemas.DATASET)
    empty["timeseries"] = spark.createDataFrame(ts_rows, schemas.TIMESERIES_TARGET)
    return src, State(**empty)


def run(src, state, single=False, ids=None):
    ids = ids if ids is not None else src.projects.select("id")
    return ip.plan_import(src, state, ids, RUN, single=single)


def outcomes(plan):
    return {r.ds_id: (r.outcome, r.timeseries, r.images, r.errors) for r in plan.outcome.collect()}


def committed(plan):
    return {r.ts_id: r.ds_id for r in plan.committed.collect()}


def test_gates_and_no_new(spark):
    src, st = make(
        spark,
        [project("1", ["a"], status="failed"), project("2", ["a"], camera="x_2"), project("3", ["zz"]), project("4", None)],
        [series("a", ["i1"])],
        [image("i1")],
    )
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("99",)], "id string")
    out = outcomes(run(src, st, ids=ids))
    assert {k: v[0] for k, v in out.items()} == {
        "1": "failed_status", "2": "bad_site", "3": "no_new_timeseries", "4": "no_new_timeseries", "99": "not_found"
    }
    plan = run(src, st, ids=ids)
    assert ip.new_datasets(plan).count() == 0 and ip.new_sites(plan).count() == 0  # C1
    assert ip.range_summary(plan).first().asDict() == {"total": 5, "failed": 1}


def test_isolated_error_rolls_back_one_timeseries(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b", "c"])],
        [series("a", ["i1"]), series("b", ["i2", "i3"]), series("c", ["i4", "gone"])],
        [image("i1"), image("i2"), image("i3", exif="{bad"), image("i4", boxes=[box(label="ghost")])],
    )
    plan = run(src, st)
    assert committed(plan) == {"a": "1"}
    assert outcomes(plan)["1"] == ("imported", 3, 1, 2)


def test_unknown_label_aborts_at_cutoff(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b", "c"])],
        [series("a", ["i1"]), series("b", ["i2"], label="ghost"), series("c", ["i3"])],
        [image("i1"), image("i2"), image("i3")],
    )
    plan = run(src, st)
    assert committed(plan) == {"a": "1"}
    assert outcomes(plan)["1"][0] == "aborted"
    assert ip.new_datasets(plan).count() == 1  # committed before the loop


def test_verified_blank_aborts_only_when_new(spark):
    rows = [series("a", ["i1"]), series("b", ["i2"], status="verified", gt=""), series("c", ["i3"])]
    imgs = [image("i1"), image("i2"), image("i3")]
    src, st = make(spark, [project("1", ["a", "b", "c"])], rows, imgs)
    assert outcomes(run(src, st))["1"][0] == "aborted"
    src, st = make(spark, [project("1", ["a", "b", "c"])], rows, imgs, prior_ts=[("b", 5000)])
    plan = run(src, st)
    assert outcomes(plan)["1"][0] == "imported"
    assert committed(plan) == {"a": "1", "c": "1"}


def test_first_dataset_owns_shared_timeseries(spark):
    src, st = make(
        spark,
        [project("10", ["a", "b"]), project("9", ["a"])],
        [series("a", ["i1"]), series("b", ["i2"])],
        [image("i1"), image("i2")],
    )
    plan = run(src, st)
    assert committed(plan) == {"a": "9", "b": "10"}
    out = outcomes(plan)
    assert out["9"] == ("imported", 1, 1, 0) and out["10"] == ("imported", 2, 1, 0)


def test_single_stops_after_first_created(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b", "c"])],
        [series("a", ["i1"]), series("b", ["i2"]), series("c", ["i3"], label="ghost")],
        [image("i1"), image("i2"), image("i3")],
        prior_ts=[("a", 1000)],
        prior_ds=["1"],
    )
    plan = run(src, st, single=True)
    assert committed(plan) == {"b": "1"}
    assert outcomes(plan)["1"][0] == "imported"


def test_selected_image_last_position_wins(spark):
    src, st = make(
        spark,
        [project("1", ["a"])],
        [series("a", ["i1", "i2", "i1"], selected="i1")],
        [image("i1"), image("i2")],
    )
    rows = ip.new_timeseries_rows(run(src, st)).collect()
    assert rows[0].selected_index == 3


def test_blur_null_coordinate_is_isolated_error(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b"])],
        [series("a", ["i1"]), series("b", ["i2"])],
        [image("i1", boxes=[box(xmin=None)]), image("i2", boxes=[box(label="elk", xmin=None)])],
    )
    assert committed(run(src, st)) == {"b": "1"}  # elk is not blurred


def test_purge_removes_children_only(spark):
    st = State(
        site=spark.createDataFrame([(7, None, None, "", 4326)], schemas.SITE),
        dataset=spark.createDataFrame(
            [(1, None, None, False, 7, True, "", None, None, "5"), (2, None, None, False, 7, True, "", None, None, "6")],
            schemas.DATASET,
        ),
        timeseries=spark.createDataFrame(
            [(10, None, None, None, 1, False, "", None, None, None, "a"), (11, None, None, None, 2, False, "", None, None, None, "b")],
            schemas.TIMESERIES_TARGET,
        ),
        image=spark.createDataFrame(
            [(100, "i", 1, False, 1, None, None, 10, None, None, "i"), (101, "j", 2, False, 1, None, None, 11, None, None, "j")],
            schemas.IMAGE,
        ),
        bbox=spark.createDataFrame(
            [(1000, None, 100, 2, -1, 0.1, 0.2, 0.1, 0.2, 0.5, None), (1001, None, 101, 2, -1, 0.1, 0.2, 0.1, 0.2, 0.5, None)],
            schemas.BBOX,
        ),
        revision=spark.createDataFrame([(5, None, None, -1, "", 2, 10)], schemas.REVISION),
    )
    out = pg.purge(st, spark.createDataFrame([("005",), ("77",)], "id string"))
    assert [r.id for r in out.dataset.collect()] == [2]
    assert [r.id for r in out.timeseries.collect()] == [11]
    assert [r.id for r in out.image.collect()] == [101]
    assert [r.id for r in out.bbox.collect()] == [1001]
    assert out.revision.count() == 0 and out.site.count() == 1
    same = pg.purge(st, spark.createDataFrame([("404",)], "id string"))
    assert same.dataset.count() == 2 and same.bbox.count() == 2


@pytest.mark.parametrize("single", [False, True])
def test_second_run_adds_nothing(spark, single):
    from fieldload.plans import publish as pb

    src, st = make(
        spark,
        [project("1", ["a", "b"]), project("2", ["b", "c"])],
        [series("a", ["i1"]), series("b", ["i2"]), series("c", ["i3", "i1"], selected="i1")],
        [image("i1"), image("i2"), image("i3")],
    )
    first = pb.new_state(run(src, st, single=single))
    again = run(src, first, single=single)
    loaded = {r.ext_id for r in first.timeseries.collect()}
    more = committed(again)
    if single:
        # One new timeseries per dataset and run: the next run goes on.
        assert more and not (set(more) & loaded) and len(more) <= 2
    else:
        assert more == {}
    ts = first.timeseries
    dangling = first.image.join(ts.select(F.col("id").alias("timeseries_id")), "timeseries_id", "left_anti")
    assert dangling.count() == 0


def test_file_state_controls_blur_and_source_errors(spark):
    src, st = make(
        spark,
        [project("1", ["a", "b", "c"])],
        [series("a", ["i1"]), series("b", ["i2"]), series("c", ["i3"])],
        [image("i1", boxes=[box(xmin=None)]), image("i2", boxes=[box(xmin=None)]), image("i3")],
    )
    files = spark.createDataFrame(
        [("i1", True, False), ("i2", False, True), ("i3", False, False)],
        "image_id string, target_exists boolean, source_readable boolean",
    )
    plan = ip.plan_import(src, st, src.projects.select("id"), RUN, file_state=files)
    # i1: target exists, so no blur and no NULL-coordinate error; i2: blurred
    # with a NULL coordinate; i3: neither target nor readable source.
    assert committed(plan) == {"a": "1"}
    assert outcomes(plan)["1"] == ("imported", 3, 1, 2)


def test_file_inputs_from_listing(spark):
    from fieldload.plans import redact as rd

    imgs = spark.createDataFrame([("i1",), ("i2",)], "image_id string")
    listing = spark.createDataFrame([("processed/tsimages/imported/i1", 10)], "path string, length long")
    landed = spark.createDataFrame([("i2",)], "image_id string")
    got = {r.image_id: (r.target_exists, r.source_readable) for r in rd.file_inputs(imgs, listing, landed).collect()}
    assert got == {"i1": (True, False), "i2": (False, True)}


def test_purge_of_import_restores_state_except_sites(spark):
    import tempfile

    from fieldload.plans import publish as pb
    from fieldload.session import checkpoint_dir
    from fieldload.sources.tables import read_state

    src, st = make(
        spark,
        [project("1", ["a", "b"]), project("2", ["c"])],
        [series("a", ["i1"], status="verified", gt="fox"), series("b", ["i2"]), series("c", ["i3", "i1"])],
        [image("i1"), image("i2"), image("i3")],
    )
    base = tempfile.mkdtemp(prefix="purge-", dir=checkpoint_dir(spark).replace("file:", ""))
    pb.run_import(run(src, st), base)
    loaded = read_state(spark, base)
    assert loaded.timeseries.count() == 3 and loaded.revision.count() == 1 and loaded.bbox.count() == 4
    pb.run_purge(loaded, spark.createDataFrame([("1",), ("2",)], "id string"), base)
    pb.compact(spark, base)
    after = read_state(spark, base)
    for name in ("dataset", "timeseries", "image", "bbox", "revision"):
        assert getattr(after, name).count() == 0, name
    assert after.site.count() == 1  # both projects share camera 7; sites stay
