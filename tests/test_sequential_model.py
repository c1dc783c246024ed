"""The set-based plan against a sequential model on seeded random exports."""

import random

import pytest

from fieldload.plans import import_plan as ip
from sequential_model import simulate
from test_import_rules import LABELS, box, image, make, project, series

LABEL_BLUR = {text: blur for _, text, blur in LABELS}


def random_case(seed):
    rnd = random.Random(seed)
    ts_ids = [f"t{i:02d}" for i in range(16)]
    img_ids = [f"i{i:02d}" for i in range(24)]
    images, model_images = [], {}
    for iid in img_ids[:-3]:  # last three refs have no metadata
        exif = "{bad" if rnd.random() < 0.06 else "{}"
        if rnd.random() < 0.05:
            boxes, mboxes = None, None
        else:
            label = rnd.choice(["fox", "elk", "nothing", "fox", "ghost"] if rnd.random() < 0.1 else ["fox", "elk"])
            xmin = None if rnd.random() < 0.08 else 0.1
            boxes, mboxes = [box(label=label, xmin=xmin)], [(label, (xmin, 0.1, 0.5, 0.5))]
        images.append(image(iid, exif=exif, boxes=boxes))
        model_images[iid] = {"exif": exif, "boxes": mboxes}
    timeseries, model_ts = [], []
    for tid in ts_ids:
        refs = rnd.sample(img_ids, rnd.randint(0, 3))
        r = rnd.random()
        label = "ghost" if r < 0.06 else ("" if r < 0.2 else rnd.choice(["fox", "elk", "nothing"]))
        status = "verified" if rnd.random() < 0.4 else "pending"
        gt = rnd.choice(["fox", "", None, "elk"]) if status == "verified" else rnd.choice([None, "fox"])
        timeseries.append(series(tid, refs, label=label, gt=gt, status=status))
        model_ts.append(
            {"id": tid, "images": refs, "predicted_label": label, "ground_truth_label": gt,
             "status": status, "bad_date": False}
        )
    projects, model_p = [], []
    for pid in range(1, 9):
        lst = rnd.sample(ts_ids + ["dangling"], rnd.randint(0, 6))
        status = "failed" if rnd.random() < 0.1 else "done"
        camera = "x_1" if rnd.random() < 0.1 else f"{pid}_cam"
        projects.append(project(str(pid), lst, status=status, camera=camera))
        model_p.append({"id": str(pid), "status": status, "camera_id": camera, "timeseries": lst})
    prior_ds = [str(p) for p in range(1, 9) if rnd.random() < 0.3]
    prior_ts = [(t, 1000 + prior_ds.index(ds)) for t in ts_ids if prior_ds and rnd.random() < 0.2
                for ds in [rnd.choice(prior_ds)]]
    model_prior_ts = {t: int(prior_ds[ds_id - 1000]) for t, ds_id in prior_ts}
    return (projects, timeseries, images, prior_ts, prior_ds), (model_p, model_ts, model_images, model_prior_ts, {int(d) for d in prior_ds})


@pytest.mark.parametrize("seed,single", [(1, False), (2, False), (3, False), (4, True), (5, False), (6, False), (7, True), (8, True), (9, True)])
def test_plan_equals_sequential_model(spark, seed, single):
    (projects, timeseries, images, prior_ts, prior_ds), model = random_case(seed)
    src, st = make(spark, projects, timeseries, images, prior_ts=prior_ts, prior_ds=prior_ds)
    ids = [str(p) for p in range(1, 10)]
    plan = ip.plan_import(src, st, spark.createDataFrame([(i,) for i in ids], "id string"), "2025-01-01 00:00:00", single=single)
    got_out = {r.ds_id: (r.outcome, r.timeseries, r.images, r.errors) for r in plan.outcome.collect()}
    got_own = {r.ts_id: r.ds_id for r in plan.committed.collect()}
    m_p, m_ts, m_img, m_prior, m_ds = model
    want_out, want_own = simulate(m_p, m_ts, m_img, LABEL_BLUR, m_prior, m_ds, ids, single=single)
    assert got_own == want_own
    assert got_out == want_out


@pytest.mark.parametrize("seed", [2, 3, 9])
def test_prior_keys_held_twice_abort_their_datasets(spark, seed):
    (projects, timeseries, images, prior_ts, prior_ds), (m_p, m_ts, m_img, m_prior, m_ds) = random_case(seed)
    twice = prior_ts[::2]
    src, st = make(spark, projects, timeseries, images, prior_ts=prior_ts + twice, prior_ds=prior_ds)
    ids = [str(p) for p in range(1, 10)]
    plan = ip.plan_import(src, st, spark.createDataFrame([(i,) for i in ids], "id string"), "2025-01-01 00:00:00")
    got = {r.ds_id: (r.outcome, r.timeseries, r.images, r.errors) for r in plan.outcome.collect()}
    want, owners = simulate(m_p, m_ts, m_img, LABEL_BLUR, m_prior, m_ds, ids, repeated={t for t, _ in twice})
    assert got == want and {r.ts_id: r.ds_id for r in plan.committed.collect()} == owners


def test_single_is_exact_for_one_dataset(spark):
    (projects, timeseries, images, prior_ts, prior_ds), model = random_case(7)
    src, st = make(spark, projects, timeseries, images, prior_ts=prior_ts, prior_ds=prior_ds)
    m_p, m_ts, m_img, m_prior, m_ds = model
    plan = ip.plan_import(src, st, spark.createDataFrame([("5",)], "id string"), "2025-01-01 00:00:00", single=True)
    got = {r.ds_id: (r.outcome, r.timeseries, r.images, r.errors) for r in plan.outcome.collect()}
    want, _ = simulate(m_p, m_ts, m_img, LABEL_BLUR, m_prior, m_ds, ["5"], single=True)
    assert got == want
