"""First free timeseries of many datasets against the walk written out."""

import random

import pytest

from fieldload.operators import first_free as ff
from fieldload.operators import stage

ROWS = "ds_id string, ds_key long, ts_id string, error boolean"


def walked(rows):
    taken, out = set(), set()
    for key, ds in sorted({(k, d) for d, k, _, _ in rows}):
        for ts, error in sorted({(t, e) for d, _, t, e in rows if d == ds}):
            if ts in taken:
                continue
            out.add((ds, key, ts))
            if not error:
                taken.add(ts)
            break
    return out


def found(spark, rows, **options):
    return {tuple(r) for r in ff.first_free(spark.createDataFrame(rows, ROWS), **options).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_walk(spark, seed):
    r = random.Random(seed)
    bad = {f"t{i:03d}" for i in range(60) if r.random() < 0.1}
    rows = []
    for d in r.sample(range(1, 400), 60):
        for t in {f"t{r.randrange(60):03d}" for _ in range(r.randrange(1, 7))}:
            rows.append((str(d), d, t, t in bad))
    rows += rows[:3]  # repeated source rows
    want = walked(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, walk_rows=4) == want  # large components by rounds


def test_chain_and_nothing(spark):
    # Everyone's first row is the second row of the one before.
    rows = [(str(d), d, f"t{d + k:03d}", False) for d in range(1, 60) for k in (-1, 0)] + [("0", 0, "t000", False)]
    assert found(spark, rows) == walked(rows)
    assert found(spark, []) == set()


@pytest.mark.parametrize("seed,n", [(0, 12), (0, 48)])
def test_tables_written_do_not_grow_with_datasets(spark, seed, n):
    rows = [(str(d), d, f"t{t:03d}", False) for d in range(n) for t in range(n + 3)]
    with stage.collect() as written:
        assert found(spark, rows) == walked(rows) == {(str(d), d, f"t{d:03d}") for d in range(n)}
    assert len(written) <= 12
