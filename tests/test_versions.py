"""Identity of keys, safe commits, image output and plans of small runs."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldload import schemas
from fieldload.operators import joins
from fieldload.plans import import_plan as ip
from fieldload.plans import publish as pb
from fieldload.plans import purge as pg
from fieldload.plans import redact as rd
from fieldload.session import checkpoint_dir
from fieldload.sources.tables import read_state
from test_import_rules import box, image, make, project, run, series
from test_sources import write_png


def folder(spark, name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir=checkpoint_dir(spark).replace("file:", ""))


def three(spark, *projects):
    rows = [series(t, [f"i{t}"]) for t in "abc"]
    return make(spark, list(projects), rows, [image(f"i{t}") for t in "abc"])


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_ids_with_one_integer_key_share_a_dataset(spark):
    src, st = three(spark, project("5", ["a"]), project("005", ["b"]))
    base = folder(spark, "keys")
    pb.run_import(run(src, st), base)
    got = read_state(spark, base)
    assert [r.ext_id for r in got.dataset.collect()] == ["005"]
    for table, n in ((got.timeseries, 2), (got.image, 2), (got.bbox, 2)):
        assert table.count() == n == table.select("id").distinct().count()
    assert got.timeseries.select("dataset_id").distinct().count() == 1


def test_repeated_prior_key_aborts_its_datasets(spark):
    src, st = make(spark, [project("5", ["a"]), project("6", ["a"])], [series("a", ["i"])], [image("i")], prior_ds=["5", "05"])
    plan = run(src, st)
    assert {r.ds_id: r.outcome for r in plan.outcome.collect()} == {"5": "aborted", "6": "imported"}


def test_long_and_textual_ids(spark):
    big = "3000000000"
    src, st = three(spark, project(big, ["a"]), project("x9", ["b"]))
    base = folder(spark, "long")
    plan = run(src, st)
    assert {r.ds_id: r.outcome for r in plan.outcome.collect()} == {big: "imported", "x9": "aborted"}
    pb.run_import(plan, base)
    state = read_state(spark, base)
    odd = state.dataset.unionByName(state.dataset.withColumn("id", F.lit(77).cast("long")).withColumn("ext_id", F.lit("x9")))
    odd = state.with_tables(dataset=odd)
    assert pg.purge(odd, ids(spark, "x9")).dataset.count() == 1
    assert pg.purge(odd, ids(spark, "0" + big, "y")).dataset.collect()[0].ext_id == "x9"
    pb.run_purge(state, ids(spark, big), base)
    assert read_state(spark, base).image.count() == 0


def test_second_plan_of_one_state_is_stale(spark):
    src, st = three(spark, project("1", ["a"]), project("2", ["b"]))
    base = folder(spark, "stale")
    one, two = run(src, st, ids=ids(spark, "1")), run(src, st, ids=ids(spark, "2"))
    assert pb.run_import(one, base) == 1
    assert [r.outcome for r in one.outcome.collect()] == ["imported"]
    with pytest.raises(pb.StaleVersion):
        pb.run_import(two, base)
    state = read_state(spark, base)
    assert pb.run_import(run(src, state, ids=ids(spark, "2")), base) == 2
    with pytest.raises(pb.StaleVersion):
        pb.run_purge(state, ids(spark, "1"), base)
    with pytest.raises(pb.StaleVersion):
        pb.publish_replace(state, base, ["image"])
    assert sorted(r.ext_id for r in read_state(spark, base).timeseries.collect()) == ["a", "b"]


def test_commit_of_a_taken_version_fails(spark):
    base = folder(spark, "taken")
    assert pb._commit(spark, base, 0, pb.ADDS, [("site", "x")]) == 1
    with pytest.raises(pb.StaleVersion):
        pb._commit(spark, base, 0, pb.ADDS, [("site", "y")])
    assert pb.parts_of(spark, base, 1)["site"] == ["x"] and len(os.listdir(f"{base}/_versions")) <= 2


def test_versions_hold_only_what_they_add(spark):
    src, st = three(spark, project("1", ["a"]), project("2", ["b"]))
    base = folder(spark, "delta")
    pb.run_import(run(src, st, ids=ids(spark, "1")), base)
    pb.run_import(run(src, read_state(spark, base), ids=ids(spark, "2")), base)
    kind, lines = pb._read_version(spark, base, 2)
    assert kind == pb.ADDS and len({t for t, _ in lines}) == len(lines) and "revision" not in dict(lines)
    assert len(pb.parts_of(spark, base, 2)["timeseries"]) == 2
    assert pb.run_import(run(src, read_state(spark, base)), base) == 2  # nothing new, no version
    assert pb.run_purge(read_state(spark, base), ids(spark, "404"), base) == 2
    assert pb.compact(spark, base) == 3 and len(pb.parts_of(spark, base, 3)["timeseries"]) == 1


def test_key_violations_keep_parts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", None)], "x string, y string")
    assert [(r.key, r.n) for r in joins.key_violations(df, ["x", "y"], "t").collect()] == [('["a",null]', 2)]


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_run_does_not_shuffle_the_metadata(spark):
    """Few needed ids are broadcast to the scan, so the metadata table is filtered before any exchange."""
    meta = spark.range(50_000).select(F.col("id").cast("string").alias("id"), F.lit("{}").alias("exif"))
    needed = spark.createDataFrame([(str(i),) for i in range(20)], "id string")
    text = final_plan(joins.narrowed(meta, needed, "id"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_hot_image_is_split(spark):
    """The image join has plain exchanges on both sides, so adaptive execution splits a hot id."""
    from fieldload.operators import expand

    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
        refs = spark.range(60_000).repartition(16).select(
            F.lit("t").alias("ts_id"), F.col("id").cast("int").alias("image_index"),
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).cast("string").alias("image_id"), F.lit(None).cast("string").alias("selected_image"))
        meta = spark.range(60_000).select(
            F.col("id").cast("string").alias("id"), F.uuid().alias("exif"), F.lit("2021").alias("predicted_at"))
        joined = expand.attach_metadata(refs, expand.image_metadata(meta))
        assert joined.count() == 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_schemas_of_stored_state(spark):
    base = folder(spark, "empty")
    state = read_state(spark, base)
    assert state.version == 0
    assert all(getattr(state, n).schema == s for n, s in schemas.TARGETS.items())
