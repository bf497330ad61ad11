from datetime import datetime, timedelta

import numpy as np

from gridpulse.operators import alerts
from gridpulse.schemas import ALERT_COLUMNS

T0 = datetime(2013, 11, 1)
HOURLY = "timestamp timestamp_ntz, grid_id long, total_activity double, internet_activity double"


def series(spark, values):
    """cell -> list of (hour, total, internet)"""
    return spark.createDataFrame(
        [(T0 + timedelta(hours=h), c, t, i) for c, s in values.items() for h, t, i in s], HOURLY)


VALUES = {
    1: [(0, 10.0, 1.0), (1, 20.0, 1.0), (2, 41.0, 9.0), (5, 82.5, 1.0)],   # hour 5: previous row is hour 2
    2: [(0, 0.0, 0.0), (1, 0.5, 0.5), (2, 1.0, 1.0)],                      # previous 0 fires, 2x exactly does not
    3: [(0, 100.0, 50.0)],
}


def test_rules_against_brute_force(spark):
    df = series(spark, VALUES)
    limits = alerts.thresholds(df)
    totals = [t for s in VALUES.values() for _, t, _ in s]
    nets = [i for s in VALUES.values() for _, _, i in s]
    assert limits.high_activity == np.quantile(totals, 0.95)
    assert limits.high_internet == np.quantile(nets, 0.95)
    assert limits.low_activity == np.quantile(totals, 0.05)

    want = []
    for cell, rows in VALUES.items():
        previous = None
        for h, t, i in rows:
            if t > limits.high_activity:
                want.append((1, cell, h, "HIGH_ACTIVITY", t, limits.high_activity))
            if i > limits.high_internet:
                want.append((2, cell, h, "HIGH_INTERNET", i, limits.high_internet))
            if previous is not None and t > 2 * previous:
                want.append((3, cell, h, "SUDDEN_SPIKE", t, 2 * previous))
            if t < limits.low_activity:
                want.append((4, cell, h, "LOW_ACTIVITY", t, limits.low_activity))
            previous = t
    want = [(n, c, T0 + timedelta(hours=h), k, v, x) for n, (_, c, h, k, v, x) in enumerate(sorted(want), 1)]
    out = alerts.alert_table(df, limits)
    assert out.columns == ALERT_COLUMNS
    got = out.collect()
    assert sorted((r.alert_id, r.grid_id, r.timestamp, r.alert_type, r.value, r.threshold) for r in got) == want
    assert [(r.timestamp, r.grid_id, r.alert_type) for r in got] == sorted(
        (r.timestamp, r.grid_id, r.alert_type) for r in got)
    again = alerts.alert_table(df, limits, renumber=True).collect()
    assert [r.alert_id for r in again] == list(range(1, len(want) + 1))


def test_nothing_fires_keeps_the_schema(spark):
    df = series(spark, {1: [(0, 5.0, 1.0)]})
    out = alerts.alert_table(df, alerts.thresholds(df))
    assert out.count() == 0 and out.columns == ALERT_COLUMNS
    empty = df.limit(0)
    assert alerts.alert_table(empty, alerts.thresholds(empty)).count() == 0
