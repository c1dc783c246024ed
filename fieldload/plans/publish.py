"""Publish an import: append the run's new rows as new parts.

There is no table format with MERGE on the classpath.  Each table is a set
of Parquet parts.  Version ``n`` is one small file ``_versions/v-n`` that
says what it adds to version ``n - 1`` (an import), or lists all parts anew
(a purge, a compaction).  An import writes only its *new* rows, so the cost of
a run grows with what it adds, and a failed run leaves the previous version
current.

A plan knows the version its state was read from and commits the next one.
Version files are put in place by a rename that fails where the name is
taken: of two plans made from one state the second raises ``StaleVersion``
and must be planned anew.  (The rename is atomic on HDFS; on a store whose
rename is not, commits need a lock.)

Surrogate ids of new rows follow the largest existing id
(``operators.numbering.dense_ids``: no single-partition window).  Datasets
and timeseries are numbered in natural-key order; images and boxes in
partition order (dense, no global sort of the largest tables).  The
image <-> timeseries cycle is closed by numbering both first and joining on
natural keys.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import to_int_key
from ..operators.numbering import dense_ids
from ..sources.tables import State
from . import import_plan as ip

VERSIONS = "_versions"
ADDS, LISTS = "adds", "lists"


class StaleVersion(RuntimeError):
    """Another run published after the state of this one was read."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{VERSIONS}/v-{version:010d}"


def latest_version(spark: SparkSession, base: str) -> int:
    """Number of the current version, 0 before the first."""
    fs, root = _fs(spark, f"{base.rstrip('/')}/{VERSIONS}")
    if not fs.exists(root):
        return 0
    found = (re.fullmatch(r"v-(\d{10})", st.getPath().getName()) for st in fs.listStatus(root))
    return max((int(m[1]) for m in found if m), default=0)


def _read_version(spark: SparkSession, base: str, version: int) -> tuple[str, list[tuple[str, str]]]:
    fs, path = _fs(spark, _version_path(base, version))
    stream = fs.open(path)
    try:
        kind, *lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()
    return kind, [tuple(x.split("\t", 1)) for x in lines]


def parts_of(spark: SparkSession, base: str, version: int) -> dict[str, list[str]]:
    """Parts of each table at ``version``: back to the last full listing.

    At most six lines for each run since that listing (see ``compact``).
    """
    added: list[tuple[str, str]] = []
    for v in range(version, 0, -1):
        kind, lines = _read_version(spark, base, v)
        added = lines + added
        if kind == LISTS:
            break
    parts: dict[str, list[str]] = {name: [] for name in schemas.TARGETS}
    for table, path in added:
        parts[table].append(path)
    return parts


def _commit(spark: SparkSession, base: str, after: int, kind: str, lines: list[tuple[str, str]]) -> int:
    """Make version ``after + 1``; ``StaleVersion`` if it exists."""
    jvm = spark._jvm
    fs, written = _fs(spark, f"{base.rstrip('/')}/{VERSIONS}/.new-{uuid.uuid4().hex}")
    out = fs.create(written, False)
    try:
        out.write(bytearray("".join(x + "\n" for x in (kind, *("\t".join(p) for p in lines))).encode()))
    finally:
        out.close()
    _, final = _fs(spark, _version_path(base, after + 1))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(written), fs.makeQualified(final), options)
    except Py4JJavaError as e:
        fs.delete(written, False)
        if "FileAlreadyExists" in str(e.java_exception.getClass()) or fs.exists(final):
            raise StaleVersion(f"version {after + 1} of {base} exists; read the state and plan again") from None
        raise
    return after + 1


def _start(df: DataFrame) -> DataFrame:
    return df.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("start"))


def new_rows(plan: ip.Plan) -> State:
    """Only the run's new rows, with surrogate ids and resolved foreign keys."""
    st = plan.state
    site = ip.new_sites(plan)

    dataset = dense_ids(ip.new_datasets(plan), ["ext_id"], start=_start(st.dataset)).select(
        *schemas.DATASET.fieldNames()
    )
    # One row for each key a new timeseries can have: the gate aborts keys that
    # prior state repeats, and a run makes one dataset for a key.
    ds_keys = (
        st.dataset.select("id", "ext_id")
        .unionByName(dataset.select("id", "ext_id"))
        .groupBy(to_int_key("ext_id").alias("_k"))
        .agg(F.min("id").alias("dataset_id"))
    )

    ts_rows = ip.new_timeseries_rows(plan).withColumn("_k", to_int_key("dataset_ext_id"))
    ts_rows = dense_ids(ts_rows, ["ext_id"], start=_start(st.timeseries)).join(ds_keys, "_k")
    ts_ids = ts_rows.select(F.col("ext_id").alias("timeseries_ext_id"), F.col("id").alias("timeseries_id"), "dataset_id")

    img = dense_ids(ip.committed_images(plan), None, start=_start(st.image)).join(ts_ids, "timeseries_ext_id")
    image = img.select(*schemas.IMAGE.fieldNames())

    sel = img.where("is_selected").select(
        F.col("timeseries_ext_id").alias("ext_id"),
        F.col("sequence_index").alias("selected_index"),
        F.col("id").alias("selected_image_id"),
    )
    timeseries = ts_rows.join(sel, ["ext_id", "selected_index"], "left").select(
        *schemas.TIMESERIES_TARGET.fieldNames()
    )

    img_keys = img.select(
        "timeseries_ext_id",
        "sequence_index",
        F.col("ext_id").alias("image_ext_id"),
        F.col("id").alias("image_id"),
    )
    box = ip.new_boxes(plan).join(img_keys, ["timeseries_ext_id", "sequence_index", "image_ext_id"])
    box = dense_ids(box, None, start=_start(st.bbox)).withColumn("ext_id", F.lit(None).cast("string"))
    bbox = box.select(*schemas.BBOX.fieldNames())

    rev = ip.new_revisions(plan).join(
        ts_ids.select(F.col("timeseries_ext_id").alias("ts_id"), "timeseries_id"), "ts_id"
    )
    revision = dense_ids(rev, ["timeseries_id"], start=_start(st.revision)).select(
        *schemas.REVISION.fieldNames()
    )
    return State(site=site, dataset=dataset, timeseries=timeseries, image=image, bbox=bbox, revision=revision)


def new_state(plan: ip.Plan) -> State:
    """Prior tables plus the run's new rows (in-memory view of the next version)."""
    new = new_rows(plan)
    st = plan.state
    return State(**{n: getattr(st, n).unionByName(getattr(new, n)) for n in schemas.TARGETS})


def _write_parts(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write each table's part; tables without rows give none."""
    run = uuid.uuid4().hex
    out = {}
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}/part-{run}"
        df.select(*schemas.TARGETS[name].fieldNames()).write.mode("errorifexists").parquet(path)
        if not df.sparkSession.read.schema(schemas.TARGETS[name]).parquet(path).isEmpty():
            out[name] = path
    return out


def publish_new(new: State, base: str, after: int) -> int:
    """Append the new rows of every table as the version after ``after``; without any, ``after`` stays current."""
    spark = new.site.sparkSession
    if latest_version(spark, base) != after:
        raise StaleVersion(f"{base} is past version {after}; read the state and plan again")
    written = _write_parts({name: getattr(new, name) for name in schemas.TARGETS}, base)
    return _commit(spark, base, after, ADDS, sorted(written.items())) if written else after


def publish_replace(state: State, base: str, tables: list[str]) -> int:
    """Rewrite ``tables`` from ``state`` (e.g. after a purge); others keep their parts."""
    spark = state.site.sparkSession
    if latest_version(spark, base) != state.version:
        raise StaleVersion(f"{base} is past version {state.version}; read the state again")
    parts = parts_of(spark, base, state.version)
    written = _write_parts({name: getattr(state, name) for name in tables}, base)
    for name in tables:
        parts[name] = [written[name]] if name in written else []
    return _commit(spark, base, state.version, LISTS, [(t, p) for t, ps in parts.items() for p in ps])


def publish(state: State, base: str) -> int:
    """Write every table of ``state`` as the whole next version."""
    return publish_replace(state, base, list(schemas.TARGETS))


def run_import(plan: ip.Plan, base: str, cleanup: bool = True) -> int:
    """Publish the run's new rows and its outcome, then remove the run's stage tables.

    The outcome goes to ``<base>/_outcomes`` and ``plan.outcome`` reads it
    from there.  Stage tables of a run that fails are removed as well.
    """
    from ..operators import stage

    spark = plan.datasets.sparkSession
    created: list[str] = []
    try:
        with stage.collect() as created:
            version = publish_new(new_rows(plan), base, plan.state.version)
            path = f"{base.rstrip('/')}/_outcomes/run-{uuid.uuid4().hex}"
            schema = plan.outcome.schema
            plan.outcome.write.mode("errorifexists").parquet(path)
            plan.outcome = spark.read.schema(schema).parquet(path)
    finally:
        if cleanup:
            stage.remove(spark, list(plan.stages) + created)
    return version


def run_purge(state: State, ids: DataFrame, base: str) -> int:
    """Purge datasets with their children and publish the survivors; unknown ids change nothing."""
    from .purge import doomed_datasets, purge

    if doomed_datasets(state, ids).isEmpty():
        return state.version
    return publish_replace(purge(state, ids), base, ["bbox", "image", "revision", "timeseries", "dataset"])


def compact(spark: SparkSession, base: str, tables: list[str] | None = None) -> int:
    """Rewrite tables whose parts accumulated over many runs into one part each."""
    from ..sources.tables import read_state

    return publish_replace(read_state(spark, base), base, tables or list(schemas.TARGETS))
