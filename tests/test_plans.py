"""Physical plan checks: pushdown, pruning, no cartesian joins."""

import pytest

from fieldload import queries as Q

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan_text(Q.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_point_lookup_pushes_filter(spark):
    text = plan_text(Q.QUERIES["point_lookup"](spark, SF))
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,42)]" in text


def test_star_exclusion_prunes_scan(spark):
    text = plan_text(Q.QUERIES["image_metadata"](spark, SF))
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    assert "ground_truth" not in scan


def test_import_scans_prune_ground_truth(spark):
    from fieldload.plans import targets as tg
    from fieldload.operators import expand

    f = Q._fixture(spark, SF)
    refs = expand.explode_refs(f.sources.timeseries)
    text = plan_text(tg.image_rows(refs, expand.image_metadata(f.sources.images_metadata)))
    assert "ground_truth" not in text


def test_import_stages_have_no_single_partition_exchange(spark, monkeypatch):
    from fieldload.operators import stage
    from fieldload.plans import import_plan as ip
    from fieldload.sources import fixtures as fx

    f = Q._fixture(spark, SF)
    plans = {}
    orig = stage.cut

    def capture(df, name="stage"):
        plans[name] = plan_text(df)
        return orig(df, name)

    monkeypatch.setattr(ip, "cut", capture)
    ip.plan_import(f.sources, f.prior, f.sources.projects.select("id"), fx.RUN_TS)
    assert {"datasets", "candidates", "refs", "images", "judged"} <= set(plans)
    for name, text in plans.items():
        assert "SinglePartition" not in text, name
        assert "Window" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
