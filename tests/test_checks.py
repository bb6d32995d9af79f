import math

import pytest

from sluice.operators import checks as C


def test_shares(spark):
    plans = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 1.5), ("d", -0.1), ("e", None), ("f", math.nan)], "plan string, share double")
    found = {r["subject"]: (r["passed"], r["reason"]) for r in C.share_checks(plans, "plan", "share").collect()}
    assert found["a"] == found["b"] == (True, None)
    assert found["c"] == (False, "share must lie in [0.0, 1.0], got 1.5")
    assert not any(found[p][0] for p in "cdef") and found["e"][1].endswith("null") and found["f"][1].endswith("NaN")


def test_rows(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "source string")
    counts = spark.createDataFrame([("a", 3), ("b", 0), ("other", 1)], "source string, samples long")
    found = sorted(tuple(r) for r in C.row_checks(expected, counts, "source").collect())
    assert found == [("rows", "a", True, None), ("rows", "b", False, "no rows collected"), ("rows", "c", False, "no rows collected")]


def test_failures_are_raised(spark):
    plans = spark.createDataFrame([("a", 0.5), ("b", 2.0)], "plan string, share double")
    found = C.share_checks(plans, "plan", "share")
    C.raise_failures(found.where("passed"))
    with pytest.raises(ValueError, match="b: share must lie"):
        C.raise_failures(found)
