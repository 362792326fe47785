"""Property tests: the distributed exact quantile and the histogram agree
with NumPy on arbitrary small inputs (ties, negatives, constants, nulls)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cabmetrics.operators.profile import equal_width_histogram
from cabmetrics.operators.quantiles import exact_quantiles

values = st.lists(
    st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
    min_size=1,
    max_size=60,
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(vals=values, p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]))
def test_exact_quantile_property(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [p], limit=1, accuracy=10)["x"][0]
    present = [v for v in vals if v is not None]
    if not present:
        assert got is None
    else:
        assert got == pytest.approx(float(np.percentile(present, p * 100)), rel=1e-9, abs=1e-9)


@SETTINGS
@given(vals=values, bins=st.integers(1, 7))
def test_histogram_property(spark, vals, bins):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = equal_width_histogram(df, "x", bins, digits=None).orderBy("bin").collect()
    present = [v for v in vals if v is not None]
    if not present:
        assert rows == []
        return
    want, _ = np.histogram(present, bins=bins)
    assert sum(r.n for r in rows) == len(present)
    assert [r.n for r in rows] == want.tolist()
