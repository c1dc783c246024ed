"""Hot keys: one project, one image and one timeseries each hold a large
share of the rows.  Results must stay whole and the plans must not gather a
group into one list."""

from fieldload.plans import import_plan as ip
from fieldload.queries import QUERIES

from test_import_rules import image, make, project, series

N = 600


def test_hot_project_image_and_timeseries(spark):
    big = [f"hot{i}" for i in range(N)]
    ts = [series(f"t{i:04d}", ["shared", f"own{i}"]) for i in range(N)]
    ts.append(series("zbig", big + ["shared"], selected="shared"))
    imgs = [image("shared")] + [image(f"own{i}") for i in range(N)] + [image(h) for h in big]
    projects = [project("1", [f"t{i:04d}" for i in range(N)] + ["zbig"]), project("2", ["t0000", "zbig"])]
    src, st = make(spark, projects, ts, imgs)
    plan = ip.plan_import(src, st, src.projects.select("id"), "2025-01-01 00:00:00")
    out = {r.ds_id: (r.outcome, r.timeseries, r.images, r.errors) for r in plan.outcome.collect()}
    assert out["1"] == ("imported", N + 1, 2 * N + N + 1, 0)
    assert out["2"] == ("imported", 2, 0, 0)
    assert plan.committed.count() == N + 1
    assert ip.new_images(plan).count() == 3 * N + 1
    sel = {r.ext_id: r.selected_index for r in ip.new_timeseries_rows(plan).collect()}
    assert sel["zbig"] == N + 1


def test_import_plans_do_not_collect_groups(spark):
    sf = "/root/testdata/sf0.001"
    # point_lookup returns one project row with its list; redaction groups
    # the boxes of one image; neither gathers a group that grows with data.
    allowed = {"point_lookup", "redact_images"}
    for name, q in QUERIES.items():
        if name in allowed:
            continue
        text = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in text and "collect_set" not in text, name
