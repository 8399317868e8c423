"""Randomised checks against plain-Python versions of the original semantics."""

from __future__ import annotations

import json
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeflux.functions.text import OS_FALLBACK, OS_NAMES, os_family
from lakeflux.operators.avro import json_field_types
from lakeflux.operators.profile import column_profile

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def classify_os(text: str) -> str:
    """The original loop: every name is tested, the last hit wins."""
    result = ""
    for name in OS_NAMES:
        if name in text.lower():
            result = name
    return result or OS_FALLBACK


@SETTINGS
@given(
    st.lists(
        st.lists(st.sampled_from(list("abcdwinosAIW ") + ["android", "iPhone", "Ubuntu", "windows", "MACINTOSH"]), max_size=8).map(
            "".join
        ),
        min_size=1,
        max_size=30,
    )
)
def test_os_family_matches_loop(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "ua string")
    got = [r.o for r in df.select(os_family("ua").alias("o")).collect()]
    assert got == [classify_os(t) for t in texts]


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-5, 5)),
            st.one_of(st.none(), st.just(float("nan")), st.floats(-3, 3, allow_nan=False, allow_infinity=False)),
            st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
            st.one_of(st.none(), st.sampled_from(["x", "y"])),
        ),
        max_size=40,
    )
)
def test_profile_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "i long, f double, s string, b string")
    got = {r.feature: r for r in column_profile(df).collect()}
    pdf = pd.DataFrame(rows, columns=["i", "f", "s", "b"], dtype=object)
    for name, text in (("i", False), ("f", False), ("s", True), ("b", True)):
        col = pd.to_numeric(pdf[name]) if not text else pdf[name]
        r = got[name]
        n = len(pdf)
        want_null = round(col.isnull().sum() / n, 4) if n else None
        assert r.null_share == want_null
        assert r.n_unique == col.nunique()
        assert r.is_categorical == (1 if text else 0)
        assert r.is_binary == (1 if text and col.nunique() == 2 else 0)
        if not text:
            mn, mx = col.min(), col.max()
            assert (r.min_value is None and (mn is None or math.isnan(mn))) or r.min_value == mn
            assert (r.max_value is None and (mx is None or math.isnan(mx))) or r.max_value == mx


def avro_class(value) -> str:
    """Per value, as the original helper: null, boolean, integer, float, text,
    other; integers beyond 32 bits are long here."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "int" if -(2**31) <= value < 2**31 else ("long" if -(2**63) <= value < 2**63 else "double")
    if isinstance(value, float):
        return "double"
    return "string"


def merge(classes: set[str]) -> str:
    classes = classes - {"null"}
    if not classes:
        return "string"
    if len(classes) == 1:
        return next(iter(classes))
    if classes <= {"int", "long"}:
        return "long"
    if classes <= {"int", "long", "double"}:
        return "double"
    return "string"


json_values = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(2**40), 2**40),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
    st.text(alphabet="abc12 ", max_size=4),
    st.lists(st.integers(0, 3), max_size=2),
    st.dictionaries(st.sampled_from(["u", "v"]), st.integers(0, 3), max_size=2),
)


@SETTINGS
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), json_values, min_size=1, max_size=4), min_size=1, max_size=12))
def test_json_field_types_match_python(spark, records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "p string")
    got = {r.field: (json.loads(r.avro_type)[1], r.n_values, r.n_null) for r in json_field_types(df, "p").collect()}
    want = {}
    for key in {k for r in records for k in r}:
        vals = [r[key] for r in records if key in r]
        classes = {avro_class(v) for v in vals}
        want[key] = (merge(classes), sum(v is not None for v in vals), sum(v is None for v in vals))
    assert got == want
