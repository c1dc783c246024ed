from pyspark.sql import functions as F

from fieldload.operators import expand, joins, labels, select
from fieldload.operators.numbering import dense_ids


def test_explode_refs_positions(spark):
    ts = spark.createDataFrame(
        [("t1", ["a", "b", "a", None], "a"), ("t2", [], None), ("t3", None, None)],
        "id string, images array<string>, selected_image string",
    )
    rows = expand.explode_refs(ts).orderBy("image_index").collect()
    assert [(r.ts_id, r.image_index, r.image_id) for r in rows] == [
        ("t1", 1, "a"), ("t1", 2, "b"), ("t1", 3, "a"), ("t1", 4, None)
    ]


def test_attach_metadata_drops_missing_keeps_repeats(spark):
    refs = spark.createDataFrame(
        [("t", 1, "a", None), ("t", 2, "x", None), ("t", 3, "a", None)],
        "ts_id string, image_index int, image_id string, selected_image string",
    )
    meta = spark.createDataFrame([("a", "{}")], "id string, exif string")
    got = sorted(r.image_index for r in expand.attach_metadata(refs, meta).collect())
    assert got == [1, 3]  # gap kept where the ref vanished


def test_dedupe_by_id_is_deterministic(spark):
    df = spark.createDataFrame([("a", "2021", "x"), ("a", "2022", "y"), ("b", None, "z")], "id string, p string, v string")
    got = {r.id: r.v for r in expand.dedupe_by_id(df, "id", prefer="p").collect()}
    assert got == {"a": "y", "b": "z"}


def test_not_loaded_null_and_empty_semantics(spark):
    probe = spark.createDataFrame([(1, "1"), (1, "2"), (1, None)], "ds_key int, ts_id string")
    none = spark.createDataFrame([], "ds_key int, ts_id string")
    one = spark.createDataFrame([(1, "1")], "ds_key int, ts_id string")
    with_null = spark.createDataFrame([(1, "1"), (1, None)], "ds_key int, ts_id string")
    keys = lambda df: sorted(r.ts_id for r in df.collect())
    assert keys(select.not_loaded(probe, none)) == ["1", "2"]
    assert keys(select.not_loaded(probe, one)) == ["2"]
    assert keys(select.not_loaded(probe, with_null)) == ["2"]


def test_listed_is_union_over_duplicate_ids(spark):
    p = spark.createDataFrame([("5", ["a", "b"]), ("5", ["b", "c"]), ("6", None)], "id string, timeseries array<string>")
    got = sorted((r.ds_id, r.ts_id) for r in select.listed(p).collect())
    assert got == [("5", "a"), ("5", "b"), ("5", "c")]


def test_by_id_range_inclusive(spark):
    p = spark.createDataFrame([("1",), ("5",), ("10",), ("11",)], "id string")
    assert sorted(r.id for r in select.by_id_range(p, 5, 10).collect()) == ["10", "5"]


def test_owner_is_smallest_numeric_dataset(spark):
    pairs = spark.createDataFrame([("10", 10, "t"), ("9", 9, "t")], "ds_id string, ds_key int, ts_id string")
    assert select.owner(pairs).first().ds_id == "9"


def test_label_dictionary_last_id_and_any_blur(spark):
    lab = spark.createDataFrame([(1, "fox", False), (7, "fox", True), (2, "elk", None)], "id bigint, text string, blur boolean")
    got = {r.text: (r.id, r.blur) for r in labels.label_dictionary(lab).collect()}
    assert got == {"fox": (7, True), "elk": (2, False)}


def test_strict_lookup_flags_unknown_only(spark):
    lab = labels.prepared(spark.createDataFrame([(1, "fox", False)], "id bigint, text string, blur boolean"))
    df = spark.createDataFrame([("fox",), ("",), (None,), ("ghost",)], "t string")
    rows = labels.lookup(df, "t", lab, "tid", "err").collect()
    got = {r.t: (r.tid, r.err) for r in rows}
    assert got == {"fox": (1, False), "": (None, False), None: (None, False), "ghost": (None, True)}


def test_insert_absent_and_key_violations(spark):
    cand = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    existing = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in joins.insert_absent(cand, existing, ["k"]).collect()] == [2]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    v = joins.key_violations(dup, ["k"], "t").collect()
    assert [(r.key, r.n) for r in v] == [("1", 2)]


def test_dense_ids_follow_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).cast("string").alias("k"))
    start = spark.createDataFrame([(41,)], "s long")
    rows = dense_ids(df, ["k"], start=start, partitions=5).collect()
    ordered = sorted(rows, key=lambda r: r.k)
    assert [r.id for r in ordered] == list(range(41, 1041))


def test_summary_without_collecting_groups(spark):
    imgs = spark.createDataFrame(
        [("t", 3, "c"), ("t", 1, "a"), ("t", 2, "b")], "ts_id string, image_index int, image_id string"
    )
    r = expand.timeseries_image_summary(imgs).first()
    assert (r.n_images, r.first_image, r.last_image) == (3, "a", "c")
