import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from gridpulse.operators import quantiles
from gridpulse.operators.quantiles import exact_quantiles

P = [0.0, 0.05, 0.5, 0.95, 1.0]


def _check(spark, values, ps=P):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, {"x": ps})
    present = [v for v in values if v is not None and v == v]
    for p in ps:
        want = None if not present else float(np.quantile(np.array(present), p))
        if want is None:
            assert got["x", p] is None
        else:
            assert got["x", p] == pytest.approx(want, rel=1e-12, abs=1e-300)


def test_mixed_signs_ties_nulls_and_nan(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1e6, 1e6) for _ in range(500)] + [0.0] * 300 + [7.25] * 400
    values += [None] * 50 + [float("nan")] * 20 + [-0.0, 1e-300, -1e300, 1e300]
    rng.shuffle(values)
    _check(spark, values)


@pytest.mark.parametrize("values", [[], [None], [3.5], [2.0, 2.0], [1.0, 2.0], [0.0, -0.0, 0.0]])
def test_small_inputs(spark, values):
    _check(spark, values)


def test_narrow_brackets_split_until_values_are_few(spark, monkeypatch):
    """All values within one coarse bucket, and a tiny limit for counting values."""
    monkeypatch.setattr(quantiles, "VALUE_ROWS", 5)
    monkeypatch.setattr(quantiles, "LINEAR_SPLITS", 16)
    rng = random.Random(2)
    _check(spark, [100.0 + rng.random() * 0.01 for _ in range(3000)], [0.05, 0.5, 0.95])


def test_two_metrics_at_once(spark):
    rng = random.Random(4)
    rows = [(rng.expovariate(1.0), float(rng.randrange(10))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = exact_quantiles(df, {"a": [0.95, 0.05], "b": [0.95]})
    a, b = np.array(rows).T
    assert got["a", 0.95] == pytest.approx(np.quantile(a, 0.95), rel=1e-12)
    assert got["a", 0.05] == pytest.approx(np.quantile(a, 0.05), rel=1e-12)
    assert got["b", 0.95] == pytest.approx(np.quantile(b, 0.95), rel=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e12, max_value=1e12),
                min_size=1, max_size=60))
def test_any_values(spark, values):
    _check(spark, values, [0.05, 0.5])
