"""Property tests of scalar rules against plain-Python statements of them."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldload.functions import scalars as S

ASCII_WS = " \t\n\r\f\v"


def site_rule(raw):
    if raw is None:
        return None
    s = raw.strip(ASCII_WS)
    if s and all(c in "0123456789" for c in s):
        v = int(s)
    else:
        base = s.split("_")[0]
        if not base or not all(c in "0123456789" for c in base):
            return None
        v = int(base)
    return v if v < 2**63 else None


texts = st.text(alphabet=st.sampled_from(list("0123456789_ x-.\t\nab")), max_size=12)


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_resolve_site_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(S.resolve_site("v")).collect()]
    assert got == [site_rule(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=30))
def test_pixel_bound_is_round_half_even(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(S.pixel_bound("v", F.lit(1))).collect()]
    assert got == [round(v) for v in values]  # Python's round is half-to-even
