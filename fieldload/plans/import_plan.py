"""The import of many projects as one set-based plan (C-1 .. C-4, C-7).

The reference walks datasets one after another, timeseries one after
another, committing as it goes.  The same outcome is a handful of joins and
partial aggregates (see the README for the rules):

1. gate each requested project (not found, failed, unusable site, bad dates
   or non-integer id);
2. ``cand``: listed timeseries that exist, minus pairs already loaded for the
   dataset;
3. ``cutoff``: the first bad timeseries (unknown label, bad date, verified
   without ground truth when new, more than one prior row) per dataset; rows
   before it are reached;
4. rows reached and new anywhere are attempted; their images and boxes give
   the isolated-error flag;
5. the smallest numeric dataset id attempting an error-free timeseries owns
   it; the rest count as present.

Nothing is collected; every step is a join or an aggregate by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_ts, resolve_site, to_int_key
from ..operators.expand import explode_refs, image_metadata
from ..operators.first_free import first_free
from ..operators.joins import IdSet, id_set, insert_absent, is_small, narrowed
from ..operators.labels import prepared
from ..operators.stage import collect as stage_tables
from ..operators.stage import cut, remove
from ..operators.select import listed, not_loaded, owner, prior_pairs, project_rows
from ..sources.tables import Sources, State
from . import redact as rd
from . import targets as tg

# Dataset outcomes; the last two count as failed in a range run.
IMPORTED = "imported"
FAILED_STATUS = "failed_status"
BAD_SITE = "bad_site"
NO_NEW = "no_new_timeseries"
NOT_FOUND = "not_found"
ABORTED = "aborted"
FAILED_OUTCOMES = (NOT_FOUND, ABORTED)


def _cut(df: DataFrame, name: str) -> DataFrame:
    """Materialise a frame read by several later steps (a table in the shared
    checkpoint folder: survives executor loss and keeps later plans small)."""
    return cut(df, name)


@dataclass
class Plan:
    """Frames of one import run, over the stage tables that building it wrote."""

    datasets: DataFrame  # one row per requested id: gate, keys, site, dates
    candidates: DataFrame  # (ds_id, ds_key, ts_id) dataset-new rows + flags
    cutoff: DataFrame  # (ds_id, cutoff)
    attempted: DataFrame  # (ds_id, ds_key, ts_id) rows that create or fail
    images: DataFrame  # joined image rows of attempted timeseries
    boxes: DataFrame  # box rows of those images
    ts_errors: DataFrame  # (ts_id, error, n_images)
    committed: DataFrame  # (ts_id, ds_id) owner of each loaded timeseries
    outcome: DataFrame  # (ds_id, outcome, timeseries, images, errors)
    ts_attrs: DataFrame  # target values per timeseries row
    run_ts: str
    state: State
    stages: tuple[str, ...] = ()  # stage tables this plan reads
    jobs: DataFrame | None = None  # images this run stored or tried to (with files)


def gate_datasets(src: Sources, state: State, ids: DataFrame) -> DataFrame:
    """One row per requested id with its first failing gate, if any.

    A key that prior state holds more than once cannot be looked up: its
    datasets are aborted.
    """
    req_ids = id_set(ids.select(F.col(ids.columns[0]).cast("string").alias("ds_id")), "requested")
    req = req_ids.ids
    wanted = narrowed(src.projects, req_ids, "id")
    rows = project_rows(wanted.join(req.select(F.col("ds_id").alias("id")), "id", "left_semi"))
    prior = state.dataset.select(to_int_key("ext_id").alias("ds_key")).where("ds_key is not null")
    keys = IdSet(req.select(to_int_key("ds_id").alias("ds_key")).where("ds_key is not null").distinct(), req_ids.small)
    prior = narrowed(prior, keys, "ds_key")
    repeated = prior.groupBy("ds_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("ds_key", F.lit(True).alias("_many"))
    ds = req.join(rows.withColumnRenamed("id", "ds_id").withColumn("_found", F.lit(True)), "ds_id", "left")
    ds = ds.select(
        "ds_id",
        to_int_key("ds_id").alias("ds_key"),
        F.coalesce("_found", F.lit(False)).alias("found"),
        "status",
        "deleted",
        resolve_site("camera_id").alias("site_id"),
        parse_ts("created_at").alias("created_ts"),
        parse_ts("updated_at").alias("updated_ts"),
    ).join(repeated, "ds_key", "left")
    ds = ds.select("ds_id", *[c for c in ds.columns if c not in ("ds_id", "_many")], F.coalesce("_many", F.lit(False)).alias("_many"))
    gate = (
        F.when(~F.col("found"), F.lit(NOT_FOUND))
        .when(F.col("status").eqNullSafe(F.lit("failed")), F.lit(FAILED_STATUS))
        .when(F.col("site_id").isNull(), F.lit(BAD_SITE))
        .when(
            F.col("ds_key").isNull() | F.col("created_ts").isNull() | F.col("updated_ts").isNull() | F.col("_many"),
            F.lit(ABORTED),
        )
    )
    return ds.withColumn("gate", gate).drop("_many")


def plan_import(
    src: Sources,
    state: State,
    ids: DataFrame,
    run_ts: str,
    single: bool = False,
    file_state: DataFrame | None = None,
    files: rd.ImageFiles | None = None,
) -> Plan:
    """Plan the import of every project id in ``ids`` (first column).

    ``file_state``: optional ``(image_id, target_exists, source_readable)``;
    without it no target file exists yet and every source is readable.

    ``files``: store the images of the timeseries that would load, those with a
    target file excepted.  Target files are then looked up by the tasks, landed
    ones are those of the listing, and an image that is not landed or cannot be stored fails its timeseries.
    Stored images stay, also those of a timeseries that fails.
    """
    with stage_tables() as created:
        try:
            return _plan_import(src, state, ids, run_ts, single, file_state, files, created)
        except Exception:
            remove(src.projects.sparkSession, created)
            raise


def _plan_import(src, state, ids, run_ts, single, file_state, files, created) -> Plan:
    dictionary = prepared(src.labels)
    # Per requested project: read by the candidate set, outcomes and new rows.
    datasets = _cut(gate_datasets(src, state, ids), "datasets")
    open_ds = datasets.where(F.col("gate").isNull()).select("ds_id", "ds_key")

    # 2. dataset-new set: listed ∩ existing rows, minus loaded pairs.
    # The gate has one row for each requested id, so it is as small as those.
    open_ids = IdSet(open_ds.select(F.col("ds_id").alias("id")), is_small(open_ds.select("ds_id")))
    pairs = listed(narrowed(src.projects, open_ids, "id").join(open_ids.ids, "id", "left_semi"))
    pairs = _cut(pairs.withColumn("ds_key", to_int_key("ds_id")), "listed")
    # Prior keys and timeseries are narrowed to the listed ids where these are
    # few, so that a small run broadcasts them and shuffles no whole table.
    listed_ids = id_set(pairs.select("ts_id"), "listed-ids")
    prior_ts = narrowed(state.timeseries, listed_ids, "ext_id")
    pairs = not_loaded(pairs, prior_pairs(prior_ts, state.dataset))
    series = narrowed(src.timeseries, listed_ids, "id")
    attrs = tg.timeseries_attrs(series, dictionary)
    # A key that prior state holds more than once cannot be looked up: it is bad.
    known = prior_ts.groupBy(F.col("ext_id").alias("ts_id")).agg((F.count(F.lit(1)) > 1).alias("many"))
    flags = attrs.select(
        "ts_id",
        "label_error",
        "date_error",
        "verified_blank",
    ).join(known.withColumn("in_prior", F.lit(True)), "ts_id", "left")
    flags = flags.select(
        "ts_id",
        F.coalesce("in_prior", F.lit(False)).alias("in_prior"),
        (
            F.col("label_error")
            | F.col("date_error")
            | (F.col("verified_blank") & F.col("in_prior").isNull())
            | F.coalesce("many", F.lit(False))
        ).alias("bad"),
    )
    # One row per source timeseries row (duplicated ids count twice, C16).
    # Cut here: cutoff, reach, counters and the attempted set all read it.
    candidates = _cut(pairs.join(flags, "ts_id"), "candidates")

    # 3. first bad row per dataset; rows before it are reached.
    # Cut: joins with it then have plain exchanges, which can be split.
    cutoff = _cut(candidates.where("bad").groupBy("ds_id").agg(F.min("ts_id").alias("cutoff")), "cutoff")
    reach = candidates.join(cutoff, "ds_id", "left").where(
        F.col("cutoff").isNull() | (F.col("ts_id") < F.col("cutoff"))
    )
    fresh = reach.where(~F.col("in_prior")).select("ds_id", "ds_key", "ts_id")

    # 4. images and boxes of the timeseries; isolated errors.
    att_ids = fresh.select(F.col("ts_id").alias("id")).distinct()
    # Read twice below (needed ids, image join): materialised once.
    refs = _cut(explode_refs(series.join(att_ids, "id", "left_semi")), "refs")
    # Few needed ids are broadcast to the metadata scan; many are left to the
    # image join itself, the metadata being shuffled once for it.
    needed = id_set(refs.select(F.col("image_id").alias("id")), "needed-images")
    meta = image_metadata(narrowed(src.images_metadata, needed, "id"))
    images = tg.image_rows(refs, meta)
    if files is not None:
        wanted = needed.ids.select(F.col("id").alias("image_id"))
        file_state = rd.file_inputs(wanted, rd.targets(wanted, files.root), files.landed)
    if file_state is not None:
        fs = file_state.select("image_id", "target_exists", "source_readable")
        images = images.join(fs, "image_id", "left").select(
            *[c for c in images.columns if c != "image_error"],
            F.coalesce("target_exists", F.lit(False)).alias("target_exists"),
            (
                F.col("image_error")
                | (~F.coalesce("target_exists", F.lit(False)) & ~F.coalesce("source_readable", F.lit(False)))
            ).alias("image_error"),
        )
    else:
        images = images.withColumn("target_exists", F.lit(False))
    # The image join (J4) is the one big shuffle; errors, image rows, boxes
    # and selected images all read its output, so it is materialised once.
    images = _cut(images, "images")
    boxes = tg.box_rows(
        images.withColumn("blur_applies", ~F.col("target_exists")),
        dictionary,
        ["ts_id", "image_index", "image_id", "classified_at", "blur_applies"],
    )
    flag_rows = images.select("ts_id", F.col("image_error").alias("err"), F.lit(1).alias("img")).unionByName(
        boxes.select("ts_id", F.col("box_error").alias("err"), F.lit(0).alias("img"))
    )
    ts_errors = flag_rows.groupBy("ts_id").agg(
        F.bool_or("err").alias("error"), F.sum("img").cast("bigint").alias("n_images")
    )
    # Cut for plain exchanges in its joins.
    ts_errors = _cut(ts_errors, "timeseries-errors")
    jobs = None
    attempted = _attempted(fresh, ts_errors, single)
    if files is not None:
        jobs, ts_errors = _store(fresh, attempted, images, boxes, ts_errors, single, files)
        attempted = _attempted(fresh, ts_errors, single)

    # 5. owners of error-free attempted timeseries.
    judged = attempted.join(ts_errors, "ts_id", "left").select(
        "ds_id",
        "ds_key",
        "ts_id",
        F.coalesce("error", F.lit(False)).alias("error"),
        F.coalesce("n_images", F.lit(0)).cast("bigint").alias("n_images"),
    )
    judged = _cut(judged, "judged")
    committed = _cut(owner(judged.where(~F.col("error")).select("ds_id", "ds_key", "ts_id")), "committed")

    # Counters and outcome per dataset.
    n_cand = candidates.groupBy("ds_id").agg(F.count(F.lit(1)).alias("timeseries"))
    n_err = judged.where("error").groupBy("ds_id").agg(F.count(F.lit(1)).alias("errors"))
    n_img = (
        committed.join(judged.select("ds_id", "ts_id", "n_images").dropDuplicates(["ds_id", "ts_id"]), ["ds_id", "ts_id"])
        .groupBy("ds_id")
        .agg(F.sum("n_images").cast("bigint").alias("images"))
    )
    out = (
        datasets.select("ds_id", "ds_key", "gate")
        .join(n_cand, "ds_id", "left")
        .join(cutoff, "ds_id", "left")
        .join(n_err, "ds_id", "left")
        .join(n_img, "ds_id", "left")
    )
    if single:
        # A dataset that took one did not go on to its bad timeseries.
        took = attempted.select("ds_id", F.lit(True).alias("_took")).distinct()
        out = out.join(took, "ds_id", "left")
        aborted = F.col("cutoff").isNotNull() & F.col("_took").isNull()
    else:
        aborted = F.col("cutoff").isNotNull()
    n_ts = F.coalesce("timeseries", F.lit(0)).cast("bigint")
    outcome = out.select(
        "ds_id",
        F.coalesce(
            F.col("gate"),
            F.when(n_ts == 0, F.lit(NO_NEW)).when(aborted, F.lit(ABORTED)).otherwise(F.lit(IMPORTED)),
        ).alias("outcome"),
        n_ts.alias("timeseries"),
        F.coalesce("images", F.lit(0)).cast("bigint").alias("images"),
        F.coalesce("errors", F.lit(0)).cast("bigint").alias("errors"),
    )
    return Plan(
        datasets=datasets,
        candidates=candidates,
        cutoff=cutoff,
        attempted=attempted,
        images=images,
        boxes=boxes,
        ts_errors=ts_errors,
        committed=committed,
        outcome=outcome,
        ts_attrs=attrs,
        run_ts=run_ts,
        state=state,
        stages=tuple(created),
        jobs=jobs,
    )


def _attempted(fresh: DataFrame, ts_errors: DataFrame, single: bool) -> DataFrame:
    """Rows that create or fail: all of ``fresh``, or the first that each dataset would create (C4, C17)."""
    if not single:
        return fresh
    return first_free(fresh.join(ts_errors, "ts_id", "left").withColumn("error", F.coalesce("error", F.lit(False))))


def _store(fresh, attempted, images, boxes, ts_errors, single, files) -> tuple[DataFrame, DataFrame]:
    """Store the images of attempted timeseries; the jobs, and ``ts_errors`` with the timeseries that failed by it.

    With ``single`` a failure can make other picks, whose images are stored in
    the next round.
    """
    jobs = None
    while True:
        loads = attempted.select("ts_id").distinct().join(ts_errors.where("error").select("ts_id"), "ts_id", "left_anti")
        mine = images.join(loads, "ts_id", "left_semi")
        more = rd.image_jobs(mine, boxes.join(loads, "ts_id", "left_semi"), files)
        more = _cut(more if jobs is None else more.join(jobs.select("image_id"), "image_id", "left_anti"), "image-jobs")
        jobs = more if jobs is None else jobs.unionByName(more)
        failed = rd.store_images(more, files.root)
        if failed.isEmpty():
            return jobs, ts_errors
        late = images.join(failed, "image_id", "left_semi").select("ts_id", F.lit(True).alias("late")).distinct()
        ts_errors = ts_errors.join(late, "ts_id", "left").select("ts_id", (F.col("error") | F.col("late").isNotNull()).alias("error"), "n_images")
        ts_errors = _cut(ts_errors, "timeseries-errors")
        if not single:
            return jobs, ts_errors
        attempted = _attempted(fresh, ts_errors, single)


def range_summary(plan: Plan) -> DataFrame:
    """Totals of a range run (A6): datasets tried and datasets failed."""
    return plan.outcome.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("outcome").isin(*FAILED_OUTCOMES)).alias("failed"),
    )


# ---------------------------------------------------------------- new rows


def persisted_datasets(plan: Plan) -> DataFrame:
    """Datasets whose site/dataset step committed (C1): open and with new rows."""
    has_cand = plan.candidates.select("ds_id").distinct()
    return plan.datasets.where(F.col("gate").isNull()).join(has_cand, "ds_id", "left_semi")


def new_sites(plan: Plan) -> DataFrame:
    ids = persisted_datasets(plan).select("site_id").distinct()
    fresh = insert_absent(ids, plan.state.site.select(F.col("id").alias("site_id")), ["site_id"])
    return tg.site_rows(fresh, plan.run_ts)


def new_datasets(plan: Plan) -> DataFrame:
    """One row for each new integer key: of ids with one key, the smallest text."""
    existing = plan.state.dataset.select(to_int_key("ext_id").alias("ds_key"))
    rows = persisted_datasets(plan)
    first = rows.groupBy("ds_key").agg(F.min("ds_id").alias("ds_id"))
    fresh = insert_absent(rows.join(first, ["ds_key", "ds_id"], "left_semi"), existing, ["ds_key"])
    return tg.dataset_rows(fresh)


def committed_attrs(plan: Plan) -> DataFrame:
    """Target values of committed timeseries, one source row per id."""
    from ..operators.expand import dedupe_by_id

    rows = dedupe_by_id(plan.ts_attrs.join(plan.committed.select("ts_id"), "ts_id", "left_semi"), "ts_id", "updated_ts")
    return rows.join(plan.committed, "ts_id")


def new_timeseries_rows(plan: Plan) -> DataFrame:
    attrs = committed_attrs(plan)
    sel = tg.selected_images(plan.images.join(plan.committed.select("ts_id"), "ts_id", "left_semi"))
    return (
        tg.timeseries_target(attrs)
        .join(attrs.select(F.col("ts_id").alias("ext_id"), F.col("ds_id").alias("dataset_ext_id")), "ext_id")
        .join(sel.withColumnRenamed("ts_id", "ext_id"), "ext_id", "left")
    )


def new_revisions(plan: Plan) -> DataFrame:
    return tg.revision_target(committed_attrs(plan))


IMAGE_COLUMNS = (
    "uuid", "ext_id", "dataset_ext_id", "timeseries_ext_id", "sequence_index", "hidden", "captured_at", "metadata", "file",
    "classified_at",
)


def new_images(plan: Plan) -> DataFrame:
    return committed_images(plan).select(*IMAGE_COLUMNS)


def committed_images(plan: Plan) -> DataFrame:
    """``new_images`` with ``is_selected``: the image's id is the selected one of its timeseries."""
    imgs = plan.images.join(plan.committed, "ts_id")
    return imgs.select(
        F.coalesce(F.col("image_id") == F.col("selected_image"), F.lit(False)).alias("is_selected"),
        "target_exists",
        F.col("image_id").alias("uuid"),
        F.col("image_id").alias("ext_id"),
        F.col("ds_id").alias("dataset_ext_id"),
        F.col("ts_id").alias("timeseries_ext_id"),
        F.col("image_index").alias("sequence_index"),
        "hidden",
        "captured_at",
        "metadata",
        "file",
        "classified_at",
    )


def new_boxes(plan: Plan) -> DataFrame:
    boxes = plan.boxes.join(plan.committed.select("ts_id"), "ts_id", "left_semi")
    return boxes.select(
        F.col("ts_id").alias("timeseries_ext_id"),
        F.col("image_id").alias("image_ext_id"),
        F.col("image_index").alias("sequence_index"),
        "box_index",
        F.col("classified_at").alias("created_at"),
        "label_id",
        F.lit(tg.NO_USER).cast("bigint").alias("user_id"),
        "x_min",
        "x_max",
        "y_min",
        "y_max",
        "score",
    )
