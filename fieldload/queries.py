"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables (reshaped by ``sources.fixtures``).  Column names equal
those of the matching SQL in ``fieldload.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalars import hidden, json_valid, parse_ts, resolve_site, to_int_key
from .operators import expand, joins, labels, select
from .operators.numbering import dense_ids
from .operators.stage import cut
from .plans import import_plan as ip
from .plans import purge as pg
from .plans import redact as rd
from .plans import targets as tg
from .session import configure
from .sources import fixtures as fx
from .sources.files import list_files

# Fixed parameters of the registered queries.
LOOKUP_ID = "42"
RANGE = (25, 124)

_PLANS: dict[tuple, ip.Plan] = {}
_TARGETS: dict[tuple, str | None] = {}


def _fixture(spark: SparkSession, sf_dir: str) -> fx.Fixture:
    configure(spark)
    return fx.load(spark, sf_dir)


def _plan(spark: SparkSession, sf_dir: str, kind: str = "all", single: bool = False) -> ip.Plan:
    f = _fixture(spark, sf_dir)
    key = (f.root, spark.sparkContext.applicationId, id(spark), kind, single)
    if key not in _PLANS:
        src = f.sources
        ids = select.by_id_range(src.projects, *RANGE) if kind == "range" else src.projects.select("id")
        files = fx.image_files(spark, sf_dir) if kind == "files" else None
        prior = fx.repeated_timeseries(f.prior) if kind == "repeats" else f.prior
        _PLANS[key] = ip.plan_import(src, prior, ids, fx.RUN_TS, single=single, files=files)
        _TARGETS[key] = files.root if files else None
    return _PLANS[key]


# ------------------------------------------------------------ scans / selection


def point_lookup(spark, sf_dir):
    src = _fixture(spark, sf_dir).sources
    row = select.point_lookup(src.projects, LOOKUP_ID)
    return row.select(
        "id", "status", "camera_id", "created_at", "updated_at", "deleted",
        F.array_join("timeseries", ",").alias("timeseries_list"),
    )


def range_select(spark, sf_dir):
    return select.by_id_range(_fixture(spark, sf_dir).sources.projects, *RANGE)


def resolve_site_q(spark, sf_dir):
    p = _fixture(spark, sf_dir).sources.projects
    return p.select("id", "camera_id", resolve_site("camera_id").alias("site_id"))


def parse_timestamps(spark, sf_dir):
    t = _fixture(spark, sf_dir).sources.timeseries
    return t.select(
        "id", parse_ts("created_at").alias("created_ts"), parse_ts("updated_at").alias("updated_ts")
    )


def exif_valid(spark, sf_dir):
    m = _fixture(spark, sf_dir).sources.images_metadata
    return m.select("id", json_valid("exif").alias("exif_ok"))


def hidden_flag(spark, sf_dir):
    m = _fixture(spark, sf_dir).sources.images_metadata
    return m.select("id", "predicted_label", hidden("predicted_label").alias("hidden"))


def extra_json(spark, sf_dir):
    t = _fixture(spark, sf_dir).sources.timeseries
    return t.select("id", tg.extra_json(*tg.EXTRA_FIELDS).alias("extra"))


def label_dictionary(spark, sf_dir):
    return labels.label_dictionary(_fixture(spark, sf_dir).sources.labels)


def label_lookup(spark, sf_dir):
    src = _fixture(spark, sf_dir).sources
    a = tg.timeseries_attrs(src.timeseries, labels.prepared(src.labels))
    return a.select(
        F.col("ts_id").alias("id"), "predicted_species_id", "validated_species_id", "label_error", "hidden"
    )


# ------------------------------------------------------------ lists and the image join


def expand_images(spark, sf_dir):
    t = _fixture(spark, sf_dir).sources.timeseries
    return expand.explode_refs(t).select("ts_id", "image_index", "image_id")


def image_metadata(spark, sf_dir):
    m = _fixture(spark, sf_dir).sources.images_metadata
    return m.drop("ground_truth_label", "ground_truth_boxes").select(
        "id", "exif", "taken_at", "predicted_at", "predicted_label",
        F.array_size("predicted_boxes").alias("n_boxes"),
    )


def _all_images(spark, sf_dir) -> DataFrame:
    src = _fixture(spark, sf_dir).sources
    return expand.attach_metadata(expand.explode_refs(src.timeseries), expand.image_metadata(src.images_metadata))


def image_join(spark, sf_dir):
    return _all_images(spark, sf_dir).select(
        "ts_id", "image_index", "image_id", "selected_image", "exif", "taken_at", "predicted_at", "predicted_label"
    )


def distinct_images(spark, sf_dir):
    t = _fixture(spark, sf_dir).sources.timeseries
    return expand.explode_refs(t).where(F.col("image_id").isNotNull()).select("image_id").distinct()


def images_by_timeseries(spark, sf_dir):
    return expand.timeseries_image_summary(_all_images(spark, sf_dir))


def image_dedupe(spark, sf_dir):
    m = _fixture(spark, sf_dir).sources.images_metadata
    return expand.image_metadata(m).select("id", "exif", "predicted_at", "predicted_label")


# ------------------------------------------------------------ import plan


def new_timeseries(spark, sf_dir):
    return _plan(spark, sf_dir).candidates.select("ds_id", "ts_id", "in_prior", "bad")


def abort_cutoff(spark, sf_dir):
    return _plan(spark, sf_dir).cutoff


def single_timeseries(spark, sf_dir):
    return _plan(spark, sf_dir, single=True).attempted.select("ds_id", "ts_id")


def timeseries_owner(spark, sf_dir):
    return _plan(spark, sf_dir).committed


def timeseries_outcome(spark, sf_dir):
    p = _plan(spark, sf_dir)
    judged = p.attempted.join(p.ts_errors, "ts_id", "left").join(
        p.committed.withColumnRenamed("ds_id", "owner"), "ts_id", "left"
    )
    status = (
        F.when(F.coalesce("error", F.lit(False)), F.lit("error"))
        .when(F.col("owner") == F.col("ds_id"), F.lit("committed"))
        .otherwise(F.lit("present"))
    )
    return judged.select("ds_id", "ts_id", status.alias("status"))


def dataset_outcome(spark, sf_dir):
    return _plan(spark, sf_dir).outcome.select("ds_id", "outcome")


def import_summary(spark, sf_dir):
    return _plan(spark, sf_dir).outcome.where(F.col("timeseries") > 0).where(
        F.col("outcome").isin(ip.IMPORTED, ip.ABORTED)
    )


def range_summary(spark, sf_dir):
    return ip.range_summary(_plan(spark, sf_dir, kind="range"))


def site_insert(spark, sf_dir):
    return ip.new_sites(_plan(spark, sf_dir))


def dataset_insert(spark, sf_dir):
    return ip.new_datasets(_plan(spark, sf_dir)).drop("delta")


def timeseries_insert(spark, sf_dir):
    return ip.new_timeseries_rows(_plan(spark, sf_dir)).drop("selected_index")


def revision_insert(spark, sf_dir):
    return ip.new_revisions(_plan(spark, sf_dir))


def image_insert(spark, sf_dir):
    return ip.new_images(_plan(spark, sf_dir))


def bbox_insert(spark, sf_dir):
    return ip.new_boxes(_plan(spark, sf_dir))


def selected_image(spark, sf_dir):
    return ip.new_timeseries_rows(_plan(spark, sf_dir)).select(F.col("ext_id").alias("ts_id"), "selected_index")


def key_violations(spark, sf_dir):
    p = _plan(spark, sf_dir)
    st = p.state
    ts = st.timeseries.select("ext_id").unionByName(ip.new_timeseries_rows(p).select("ext_id"))
    ds = st.dataset.select("ext_id").unionByName(ip.new_datasets(p).select("ext_id"))
    site = st.site.select("id").unionByName(ip.new_sites(p).select("id"))
    return (
        joins.key_violations(ts, ["ext_id"], "timeseries")
        .unionByName(joins.key_violations(ds.select(to_int_key("ext_id").alias("k")), ["k"], "dataset"))
        .unionByName(joins.key_violations(site, ["id"], "site"))
    )


def surrogate_ids(spark, sf_dir):
    """Publish numbering of new timeseries: after the largest prior id, by ext id."""
    p = _plan(spark, sf_dir)
    start = p.state.timeseries.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("start"))
    rows = ip.new_timeseries_rows(p).select("ext_id")
    return dense_ids(rows, ["ext_id"], start=start)


# ------------------------------------------------------------ purge


def _purged(spark, sf_dir):
    f = _fixture(spark, sf_dir)
    ids = select.by_id_range(f.sources.projects, *RANGE)
    return pg.purge(fx.prior_state(f), ids)


def purge_dataset(spark, sf_dir):
    return _purged(spark, sf_dir).dataset.select("id", "ext_id")


def purge_timeseries(spark, sf_dir):
    return _purged(spark, sf_dir).timeseries.select("id", "ext_id", "dataset_id")


def purge_revision(spark, sf_dir):
    return _purged(spark, sf_dir).revision.select("id", "timeseries_id", "label_id")


def purge_image(spark, sf_dir):
    return _purged(spark, sf_dir).image.select("id", "ext_id", "dataset_id", "timeseries_id", "sequence_index")


def purge_bbox(spark, sf_dir):
    return _purged(spark, sf_dir).bbox.select("id", "image_id", "label_id")


# ------------------------------------------------------------ redaction


def _regions(spark, sf_dir):
    p = _plan(spark, sf_dir)
    blur = p.boxes.join(p.committed.select("ts_id"), "ts_id", "left_semi").where("blur")
    return rd.blur_regions(blur, fx.landed_sizes(fx.events(spark, sf_dir)))


def blur_regions(spark, sf_dir):
    return _regions(spark, sf_dir)


def repeated_prior(spark, sf_dir):
    """Outcome of an import over prior state that holds some timeseries keys twice."""
    return _plan(spark, sf_dir, kind="repeats").outcome


def _files_plan(spark, sf_dir) -> tuple[ip.Plan, str]:
    """The import of every project with its image files, and the root it stored them below."""
    plan = _plan(spark, sf_dir, kind="files")
    return plan, next(_TARGETS[k] for k, p in _PLANS.items() if p is plan)


def file_state(spark, sf_dir):
    """Committed images and whether their target file existed before the run."""
    images = ip.committed_images(_files_plan(spark, sf_dir)[0])
    return images.select("ext_id", "timeseries_ext_id", "sequence_index", "file", "target_exists")


def import_files(spark, sf_dir):
    """Outcome of an import whose images are partly missing, unreadable or stored already."""
    return _files_plan(spark, sf_dir)[0].outcome


def stored_files(spark, sf_dir):
    """Target files after the run."""
    return list_files(spark, _files_plan(spark, sf_dir)[1]).select("path")


def redact_images(spark, sf_dir):
    """Every stored image of a committed timeseries against its source: blurred inside its regions only."""
    plan, root = _files_plan(spark, sf_dir)
    committed = ip.committed_images(plan).select(F.col("ext_id").alias("image_id"))
    out = rd.stored_check(cut(plan.jobs.join(committed, "image_id", "left_semi"), "stored-jobs"), root)
    return out.select("image_id", "height", "width", "n_regions", "outside_same")


# ------------------------------------------------------------ rules on odd values


def ordered_images(spark, sf_dir):
    return expand.ordered_images(_all_images(spark, sf_dir)).select("ts_id", "image_index", "image_id")


def timestamp_forms(spark, sf_dir):
    """Timestamps written in many forms, by event."""
    t = fx.timestamp_texts(fx.events(spark, sf_dir))
    return t.select("event_id", "form", parse_ts("text").alias("parsed"))


def json_forms(spark, sf_dir):
    """JSON texts valid and not, by event."""
    t = fx.json_texts(fx.events(spark, sf_dir))
    return t.select("event_id", "form", json_valid("text").alias("valid"))


def key_repeats(spark, sf_dir):
    """Keys that occur more than once: dataset ids written in several ways, and pairs."""
    ev = fx.events(spark, sf_dir)
    texts = fx.key_texts(ev).select(to_int_key("ext_id").alias("k"))
    return joins.key_violations(texts, ["k"], "dataset").unionByName(
        joins.key_violations(ev, ["user_id", "event_type"], "pair")
    )


def overlap_boxes(spark, sf_dir):
    """Two overlapping boxes an image, some without coordinates, label or value."""
    src = _fixture(spark, sf_dir).sources
    rows = tg.box_rows(fx.overlapping(fx.events(spark, sf_dir)), labels.prepared(src.labels), ["image_id"])
    return rows.select("image_id", "box_index", "label_id", "blur", "box_error", "x_min", "x_max")


def image_repeats(spark, sf_dir):
    """Image ids that occur several times (A3)."""
    rows = expand.image_metadata(fx.repeated_images(fx.events(spark, sf_dir)))
    return rows.select("id", "exif", "predicted_at", "predicted_label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "point_lookup": point_lookup,
    "range_select": range_select,
    "resolve_site": resolve_site_q,
    "parse_timestamps": parse_timestamps,
    "exif_valid": exif_valid,
    "hidden_flag": hidden_flag,
    "extra_json": extra_json,
    "label_dictionary": label_dictionary,
    "label_lookup": label_lookup,
    "expand_images": expand_images,
    "image_metadata": image_metadata,
    "image_join": image_join,
    "distinct_images": distinct_images,
    "images_by_timeseries": images_by_timeseries,
    "image_dedupe": image_dedupe,
    "new_timeseries": new_timeseries,
    "abort_cutoff": abort_cutoff,
    "single_timeseries": single_timeseries,
    "timeseries_owner": timeseries_owner,
    "timeseries_outcome": timeseries_outcome,
    "dataset_outcome": dataset_outcome,
    "import_summary": import_summary,
    "range_summary": range_summary,
    "site_insert": site_insert,
    "dataset_insert": dataset_insert,
    "timeseries_insert": timeseries_insert,
    "revision_insert": revision_insert,
    "image_insert": image_insert,
    "bbox_insert": bbox_insert,
    "selected_image": selected_image,
    "key_violations": key_violations,
    "surrogate_ids": surrogate_ids,
    "purge_dataset": purge_dataset,
    "purge_timeseries": purge_timeseries,
    "purge_revision": purge_revision,
    "purge_image": purge_image,
    "purge_bbox": purge_bbox,
    "blur_regions": blur_regions,
    "file_state": file_state,
    "redact_images": redact_images,
    "import_files": import_files,
    "stored_files": stored_files,
    "repeated_prior": repeated_prior,
    "ordered_images": ordered_images,
    "timestamp_forms": timestamp_forms,
    "json_forms": json_forms,
    "key_repeats": key_repeats,
    "overlap_boxes": overlap_boxes,
    "image_repeats": image_repeats,
}
