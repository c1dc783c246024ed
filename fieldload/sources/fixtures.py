"""Export tables and prior state reshaped from the driver's ``events`` table.

The driver's data has no camera exports, so ``FIXTURES.md`` defines them from
``events`` (event = image, (user, day) = timeseries, user = project).  All of
it is Spark work over the whole ``events`` table.  The ``images`` and
``timeseries`` lists are built with ``collect_list`` because lists *are* the
source format; the engine itself never gathers a group.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.pixels import encode_png
from ..functions.scalars import parse_ts, resolve_site
from ..operators.expand import explode_refs, image_metadata
from ..operators.labels import prepared
from ..operators.numbering import dense_ids
from ..operators.stage import collect, cut, remove
from ..plans import targets as tg
from ..plans.redact import ImageFiles, list_landed
from .files import FILE_SCHEMA, packages, write_files
from .tables import Sources, State, read_sources, table

# Tasks pickle this module's pixel maker by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The labels of the fixtures (id, text, blur).
LABEL_ROWS = (
    (1, "nothing", False),
    (2, "click", False),
    (3, "error", True),
    (4, "purchase", False),
    (5, "signup", True),
    (6, "view", False),
)

# Ids of prior images and boxes (FIXTURES.md).
PRIOR_IMAGE_STRIDE = 10_000
PRIOR_BOX_STRIDE = 100

# Folders of landed packages.
LANDED_FOLDERS = 1024

# Fixed value: run timestamp used by registered queries (no wall clock).
RUN_TS = "2025-01-01 00:00:00"


def _null(type_name: str):
    return F.lit(None).cast(type_name)


def events(spark: SparkSession, base: str) -> DataFrame:
    """``events`` with the per-event predicted label of the fixture rules."""
    ev = table(spark, base, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    e = F.col("event_id")
    plab = (
        F.when(e % 13 == 0, _null("string"))
        .when(F.col("event_type") == "view", F.lit("nothing"))
        .otherwise(F.col("event_type"))
    )
    return ev.withColumn("plab", plab)


def image_table(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    box = F.struct(
        F.lit(0.1).alias("xmin"),
        F.lit(0.2).alias("ymin"),
        (F.lit(0.1) + (e % 5).cast("double") * F.lit(0.125)).alias("xmax"),
        F.lit(0.75).alias("ymax"),
    )
    one = F.struct(
        (F.col("value") / F.lit(500)).alias("score"),
        F.when(e % 997 == 0, F.lit("ghost")).otherwise(F.col("event_type")).alias("label"),
        box.alias("box"),
    )
    boxes = (
        F.when(e % 503 == 0, _null(schemas.BOXES.simpleString()))
        .when(e % 7 == 0, F.array().cast(schemas.BOXES))
        .otherwise(F.array(one).cast(schemas.BOXES))
    )
    return ev.where(e % 101 != 0).select(
        e.cast("string").alias("id"),
        F.when(e % 401 == 0, F.lit("{bad")).otherwise(F.col("props")).alias("exif"),
        F.col("ts").cast("timestamp_ntz").alias("taken_at"),
        F.when(e % 11 == 0, _null("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("predicted_at"),
        F.col("plab").alias("predicted_label"),
        boxes.alias("predicted_boxes"),
        F.col("plab").alias("ground_truth_label"),
        boxes.alias("ground_truth_boxes"),
    )


def groups(ev: DataFrame) -> DataFrame:
    """One row per (user, day) with the fields the timeseries rules need."""
    d = F.to_date("ts")
    g = ev.withColumn("d", d).groupBy("user_id", "d").agg(
        F.array_sort(
            F.collect_list(F.struct("ts", "event_id", F.col("event_id").cast("string").alias("id")))
        ).alias("_sorted"),
        F.max(F.col("event_id").cast("string")).alias("max_id"),
        F.min("plab").alias("lab"),
        F.count(F.lit(1)).alias("n"),
    )
    return g.select(
        "user_id",
        "d",
        F.dayofmonth("d").alias("dy"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("d", "yyyyMMdd")).alias("id"),
        F.transform("_sorted", lambda x: x["id"]).alias("refs"),
        "max_id",
        "lab",
        "n",
    )


def timeseries(g: DataFrame) -> DataFrame:
    u, dy = F.col("user_id"), F.col("dy")
    refs = F.col("refs")
    return g.select(
        "id",
        F.when(dy == 10, F.array_append(refs, refs[0])).otherwise(refs).alias("images"),
        F.when(u % 7 == 0, _null("string")).otherwise(F.col("max_id")).alias("selected_image"),
        F.when((u % 31 == 0) & (dy == 20), F.lit("ghost"))
        .when(dy == 15, F.lit(""))
        .otherwise(F.col("lab"))
        .alias("predicted_label"),
        F.when(dy % 3 == 1, _null("string"))
        .when(dy % 3 == 2, F.lit(""))
        .when((u % 29 == 0) & (dy == 9), _null("string"))
        .otherwise(F.coalesce(F.col("lab"), F.lit("click")))
        .alias("ground_truth_label"),
        F.when(dy % 3 == 0, F.lit("verified")).otherwise(F.lit("pending")).alias("status"),
        F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("created_at"),
        F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T12:00:00Z")).alias("updated_at"),
        F.col("n").cast("double").alias("distance"),
        F.col("n").cast("int").alias("num_animals"),
        (dy % 2 == 0).alias("should_export_images"),
        F.lit(False).alias("camera_inactive"),
        _null("string").alias("taken_offset"),
    )


def own_lists(g: DataFrame) -> DataFrame:
    return g.groupBy("user_id").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def projects(g: DataFrame) -> DataFrame:
    own = own_lists(g)
    nxt = own.select((F.col("user_id") - 1).alias("user_id"), F.col("ids")[0].alias("next_first"))
    p = own.join(nxt, "user_id", "left")
    u = F.col("user_id")
    us = u.cast("string")
    camera = (
        F.when(u % 5 == 0, us)
        .when(u % 5 == 1, F.concat(us, F.lit("_old")))
        .when(u % 5 == 2, F.concat(F.lit(" "), us, F.lit(" ")))
        .when(u % 5 == 3, F.concat(F.lit("x_"), us))
        .otherwise(F.concat(us, F.lit("_")))
    )
    lists = (
        F.when(u % 23 == 0, _null("array<string>"))
        .when(u % 19 == 0, F.array().cast("array<string>"))
        .when(u % 4 == 0, F.array_append("ids", F.concat(F.lit("missing-"), us)))
        .when((u % 10 == 1) & F.col("next_first").isNotNull(), F.array_append("ids", F.col("next_first")))
        .otherwise(F.col("ids"))
    )
    return p.select(
        us.alias("id"),
        F.when(u % 17 == 0, F.lit("failed")).otherwise(F.lit("done")).alias("status"),
        camera.alias("camera_id"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.lit("2024-02-01T00:00:00Z").alias("updated_at"),
        (u % 10 == 9).alias("deleted"),
        lists.alias("timeseries"),
    )


def labels_dim(ev: DataFrame) -> DataFrame:
    """Label source rows derived from ``events``: one per (event type, user
    parity) plus ``nothing`` per parity, ids and blur from the fixed table,
    blur set on parity-0 rows only.  Texts repeat, so the dictionary step
    (greatest id, blur if any row) has work to do."""
    spark = ev.sparkSession
    parity = (F.col("user_id") % 2).alias("parity")
    texts = ev.select(F.col("event_type").alias("text"), parity).unionByName(
        ev.select(F.lit("nothing").alias("text"), parity)
    ).distinct()
    # A literal six-row table: a proven size bound for the broadcast.
    fixed = spark.createDataFrame(list(LABEL_ROWS), "id bigint, text string, blur boolean")
    rows = texts.join(F.broadcast(fixed), "text")
    return rows.select("id", "text", (F.col("blur") & (F.col("parity") == 0)).alias("blur"))


@dataclass(frozen=True)
class Fixture:
    """Export tables and prior state, written once as Parquet and read back.

    Reading them from files makes every registered query start from Parquet
    scans (pushdown, pruning) as it would on real exports.
    """

    sources: Sources
    prior: State
    root: str

    @property
    def spark(self) -> SparkSession:
        return self.sources.projects.sparkSession


_CACHE: dict[tuple, Fixture] = {}
_TABLES = ("projects", "timeseries", "images_metadata", "labels")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _signature(spark: SparkSession, base: str) -> str:
    fs, p = _fs(spark, f"{base.rstrip('/')}/events.parquet")
    st = fs.getFileStatus(p)
    raw = f"{base}|{st.getLen()}|{st.getModificationTime()}|v3"
    return hashlib.sha1(raw.encode()).hexdigest()[:16]


def load(spark: SparkSession, base: str) -> Fixture:
    """The fixture for ``base``, built on first use (per checkpoint dir)."""
    key = (spark.sparkContext.applicationId, id(spark), base)
    if key not in _CACHE:
        _CACHE[key] = _materialize(spark, base)
    return _CACHE[key]


def _materialize(spark: SparkSession, base: str) -> Fixture:
    from ..session import checkpoint_dir

    root = f"{checkpoint_dir(spark).rstrip('/')}/fieldload-fixtures/{_signature(spark, base)}"
    fs, done = _fs(spark, f"{root}/_DONE")
    if not fs.exists(done):
        with collect() as used:
            lazy = _lazy(spark, base)
            for name in _TABLES:
                getattr(lazy.sources, name).write.mode("overwrite").parquet(f"{root}/{name}")
            # Prior state is made from the written exports, not from events again.
            lazy = replace(lazy, sources=read_sources(spark, f"{root}/TABLE", f"{root}/labels"))
            prior = _prior_lazy(lazy)
            for name in schemas.TARGETS:
                getattr(prior, name).write.mode("overwrite").parquet(f"{root}/prior_{name}")
        remove(spark, used)
        fs.create(done, True).close()
    src = read_sources(spark, f"{root}/TABLE", f"{root}/labels")
    prior = State(
        **{
            name: spark.read.schema(schema).parquet(f"{root}/prior_{name}")
            for name, schema in schemas.TARGETS.items()
        }
    )
    return Fixture(sources=src, prior=prior, root=root)


@dataclass(frozen=True)
class _Lazy:
    sources: Sources
    groups: DataFrame
    prior_users: DataFrame


def _lazy(spark: SparkSession, base: str) -> _Lazy:
    ev = events(spark, base)
    # Read by projects, timeseries and the keys of prior state: written once.
    g = cut(groups(ev), "groups")
    src = Sources(
        projects=projects(g),
        timeseries=timeseries(g),
        images_metadata=image_table(ev),
        labels=labels_dim(ev),
    )
    u = F.col("user_id")
    prior_users = (
        g.select("user_id").distinct().where((u % 2 == 0) & (u % 5 != 3) & (u % 17 != 0))
    )
    return _Lazy(sources=src, groups=g, prior_users=prior_users)


def prior_dataset(fx: _Lazy) -> DataFrame:
    """Prior datasets: id 1000 + user, ext_id = user, other columns by the import rules."""
    proj = fx.sources.projects.join(
        fx.prior_users.select(F.col("user_id").cast("string").alias("id")), "id", "left_semi"
    )
    return proj.select(
        (F.col("id").cast("bigint") + 1000).alias("id"),
        parse_ts("created_at").alias("created_at"),
        parse_ts("updated_at").alias("last_modified_at"),
        F.col("deleted"),
        resolve_site("camera_id").alias("location_id"),
        F.lit(True).alias("locked"),
        F.lit("").alias("comment"),
        _null("bigint").alias("registration_id"),
        _null("interval day to second").alias("delta"),
        F.col("id").alias("ext_id"),
    )


def prior_timeseries_keys(fx: _Lazy) -> DataFrame:
    """``(ext_id, dataset_id)`` of prior timeseries: days 1..5 of prior users."""
    return fx.groups.where(F.col("dy") <= 5).join(fx.prior_users, "user_id", "left_semi").select(
        F.col("id").alias("ext_id"), (F.col("user_id") + 1000).alias("dataset_id")
    )


def _prior_lazy(fx: _Lazy) -> State:
    """Prior target tables: the import rules applied to every prior timeseries."""
    ds = prior_dataset(fx)
    keys = dense_ids(prior_timeseries_keys(fx), ["ext_id"])
    return prior_rows(fx.sources, ds, keys, RUN_TS)


def prior_state(fx: Fixture) -> State:
    return fx.prior


def prior_rows(src, ds: DataFrame, ts_keys: DataFrame, run_ts: str):
    """Prior state for the fixtures: import rules on every prior timeseries.

    Ids follow FIXTURES.md: timeseries ids are given (rank by ext id); an
    image id is ``timeseries id * 10000 + position``, a box id ``image id *
    100 + box position``, a revision id the timeseries id.
    """
    dictionary = prepared(src.labels)
    site = tg.site_rows(ds.select(F.col("location_id").alias("site_id")).distinct(), run_ts)
    attrs = tg.timeseries_attrs(src.timeseries, dictionary).join(
        ts_keys.select(F.col("ext_id").alias("ts_id"), F.col("id").alias("ts_pk"), "dataset_id"), "ts_id"
    )
    # Attributes and images are read by several tables: written once.
    attrs = cut(attrs, "prior-attributes")
    refs = explode_refs(src.timeseries.join(ts_keys.select(F.col("ext_id").alias("id")), "id", "left_semi"))
    imgs = tg.image_rows(refs, image_metadata(src.images_metadata))
    imgs = imgs.join(attrs.select("ts_id", "ts_pk", "dataset_id"), "ts_id").withColumn(
        "image_pk", F.col("ts_pk") * PRIOR_IMAGE_STRIDE + F.col("image_index")
    )
    imgs = cut(imgs, "prior-images")
    image = imgs.select(
        F.col("image_pk").alias("id"),
        F.col("image_id").alias("uuid"),
        "dataset_id",
        "hidden",
        F.col("image_index").alias("sequence_index"),
        "captured_at",
        "metadata",
        F.col("ts_pk").alias("timeseries_id"),
        "file",
        "classified_at",
        F.col("image_id").alias("ext_id"),
    )
    boxes = tg.box_rows(imgs, dictionary, ["image_pk", "classified_at"])
    boxes = boxes.withColumn("box_pk", F.col("image_pk") * PRIOR_BOX_STRIDE + F.col("box_index"))
    bbox = boxes.select(
        F.col("box_pk").alias("id"),
        F.col("classified_at").alias("created_at"),
        F.col("image_pk").alias("image_id"),
        "label_id",
        F.lit(tg.NO_USER).cast("bigint").alias("user_id"),
        "x_min",
        "x_max",
        "y_min",
        "y_max",
        "score",
        _null("string").alias("ext_id"),
    )
    sel = tg.selected_images(imgs).join(
        imgs.select("ts_id", F.col("image_index").alias("selected_index"), F.col("image_pk")),
        ["ts_id", "selected_index"],
    ).groupBy("ts_id").agg(F.max("image_pk").alias("selected_image_id"))
    ts = attrs.join(sel, "ts_id", "left").select(
        F.col("ts_pk").alias("id"),
        F.col("created_ts").alias("created_at"),
        F.col("updated_ts").alias("last_modified_at"),
        "extra",
        "dataset_id",
        "hidden",
        F.lit("").alias("comment"),
        "predicted_species_id",
        "selected_image_id",
        "validated_species_id",
        F.col("ts_id").alias("ext_id"),
    )
    rev = tg.revision_target(attrs).join(attrs.select("ts_id", "ts_pk"), "ts_id")
    revision = rev.select(
        F.col("ts_pk").alias("id"),
        "created_at",
        "last_modified_at",
        "user_id",
        "comment",
        "label_id",
        F.col("ts_pk").alias("timeseries_id"),
    )
    return State(site=site, dataset=ds, timeseries=ts, image=image, bbox=bbox, revision=revision)


def repeated_timeseries(prior: State) -> State:
    """Prior state that holds the timeseries of a month's first day twice."""
    again = prior.timeseries.where(F.col("ext_id").endswith("01")).withColumn("id", F.col("id") + F.lit(10**9).cast("long"))
    return prior.with_tables(timeseries=prior.timeseries.unionByName(again))


def landed_sizes(events: DataFrame) -> DataFrame:
    """Sizes of the fixture's source images (FIXTURES.md), as built-in columns:
    width 32 + 8 (e mod 4), height 24 + 8 (e mod 3)."""
    e = F.col("event_id")
    return events.select(
        e.cast("string").alias("image_id"),
        (F.lit(32) + F.lit(8) * (e % 4)).cast("int").alias("width"),
        (F.lit(24) + F.lit(8) * (e % 3)).cast("int").alias("height"),
    )


def landed_images(events: DataFrame) -> DataFrame:
    """Source image files of the fixtures, made on the executors: ``path, content``.

    PNG with three channels, value (3x + 5y + 11c + e) mod 256 (blue, green,
    red).  Events with ``e % 89 = 0`` have no file, those with ``e % 97 = 0`` one
    that is no image.
    """
    base = {}

    def make(batches):
        for batch in batches:
            paths, contents = [], []
            for e, w, h in zip(*(batch.column(c).to_pylist() for c in ("event_id", "width", "height")), strict=True):
                if (h, w) not in base:
                    y, x, c = np.ogrid[0:h, 0:w, 0:3]
                    base[h, w] = ((3 * x + 5 * y + 11 * c) % 256).astype(np.uint8)
                px = base[h, w] + np.uint8(e % 256)
                paths.append(str(e))
                contents.append(b"no image" if e % 97 == 0 else encode_png(px))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])

    sized = landed_sizes(events.where("event_id % 89 <> 0")).select(F.col("image_id").cast("long").alias("event_id"), "width", "height")
    sized = sized.repartition(_cpu_partitions(events), "event_id")
    return sized.mapInArrow(make, FILE_SCHEMA)


def image_files(spark: SparkSession, base: str) -> ImageFiles:
    """Landed files, written once, and a new target root that holds those with ``e % 83 = 0`` already.

    Landed files come in packages, which lie in folders by the hash of their name; tasks list both.
    """
    root = load(spark, base).root
    fs, done = _fs(spark, f"{root}/landed_DONE")
    ev = events(spark, base)
    if not fs.exists(done):
        folder = F.hex(F.crc32("path") % LANDED_FOLDERS)
        write_files(packages(landed_images(ev)).select(F.concat(folder, F.lit("/"), F.col("path")).alias("path"), "content"), f"{root}/landed")
        fs.create(done, True).close()
    targets = f"{root}/targets-{uuid.uuid4().hex}"
    earlier = landed_images(ev.where("event_id % 83 = 0"))
    write_files(earlier.select(F.concat(F.lit(tg.FILE_PREFIX), F.col("path")).alias("path"), "content"), targets)
    return ImageFiles(list_landed(spark, f"{root}/landed"), targets)


def _cpu_partitions(df: DataFrame) -> int:
    """Partitions for a CPU-bound Python step: by cores, not by bytes (AQE
    would coalesce a small shuffle into one or two tasks)."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


# How ``timestamp_texts`` writes an event's time, by form.
TIME_FORMS = (
    "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy/MM/dd", "M/d/yyyy", "dd/MM/yyyy", "MM/dd/yyyy HH:mm", "MMMM d, yyyy", "d MMM yyyy",
    "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyyMMdd'T'HHmmss'Z'", "yyyyMMddHHmmss", "yyyy-MM-dd h:mm a", "HH:mm", "'junk'", "''", None,
    "yyyyMMdd",
)


def timestamp_texts(ev: DataFrame) -> DataFrame:
    form = F.col("event_id") % len(TIME_FORMS)
    text = F.lit(None).cast("string")
    for i, pattern in enumerate(TIME_FORMS):
        if pattern is not None:
            written = F.date_format("ts", pattern) if "y" in pattern or "H" in pattern else F.lit(pattern.strip("'"))
            text = F.when(form == i, written).otherwise(text)
    return ev.select("event_id", form.alias("form"), text.alias("text"))


def json_texts(ev: DataFrame) -> DataFrame:
    e = F.col("event_id").cast("string")
    put = lambda before, after: F.concat(F.lit(before), e, F.lit(after))
    texts = (
        F.col("props"), put('{"a":', ',"a":2}'), put('{"a": NaN, "b":', "}"), F.lit("NaN"), put("[", ",-Infinity]"), put('{"a":', ""),
        put("{'a':", "}"), put("[", ",]"),
    )
    form = F.col("event_id") % len(texts)
    text = texts[0]
    for i, t in enumerate(texts):
        text = F.when(form == i, t).otherwise(text)
    return ev.select("event_id", form.alias("form"), text.alias("text"))


def key_texts(ev: DataFrame) -> DataFrame:
    """Dataset ids as text: plain for all users, with leading zeros or spaces for some."""
    u = F.col("user_id").cast("string")
    text = F.when(F.col("user_id") % 3 == 0, F.array(u, F.concat(F.lit("00"), u))).when(
        F.col("user_id") % 3 == 1, F.array(u, F.concat(F.lit(" "), u), F.concat(u, F.lit("x")))
    ).otherwise(F.array(u))
    return ev.select("user_id").distinct().select(F.explode(text).alias("ext_id"))


def overlapping(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    gap = lambda n: F.when(e % n == 0, _null("double")).otherwise(F.lit(0.25))
    label = F.when(e % 10 == 0, F.lit("ghost")).when(e % 21 == 0, _null("string")).otherwise(F.col("event_type"))
    one = F.struct(
        F.lit(0.5).alias("score"), label.alias("label"),
        F.struct(gap(6).alias("xmin"), F.lit(0.25).alias("ymin"), F.lit(0.75).alias("xmax"), F.lit(0.75).alias("ymax")).alias("box"),
    )
    two = F.struct(
        F.lit(0.25).alias("score"), F.lit("error").alias("label"),
        F.struct(F.lit(0.5).alias("xmin"), F.lit(0.5).alias("ymin"), gap(4).alias("xmax"), F.lit(1.0).alias("ymax")).alias("box"),
    )
    boxes = F.when(e % 15 == 0, F.array(one, F.lit(None))).otherwise(F.array(one, two))
    return ev.select(e.cast("string").alias("image_id"), boxes.cast(schemas.BOXES).alias("predicted_boxes"))


def repeated_images(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return ev.select(
        F.floor(e / 3).cast("string").alias("id"),
        F.col("props").alias("exif"),
        F.col("ts").cast("timestamp_ntz").alias("taken_at"),
        F.lpad((e * 7919 % 1000003).cast("string"), 12, "0").alias("predicted_at"),
        F.col("plab").alias("predicted_label"),
        F.array().cast(schemas.BOXES).alias("predicted_boxes"),
    )
