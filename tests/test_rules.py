from pyspark.sql import functions as F

from stridewise.functions import rules


def _mask(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_distance_limits(make_runs, config):
    df = make_runs(distance_km=[config.distance_min - 0.01, config.distance_min, 10.0, config.distance_max,
                                config.distance_max + 0.01, None, -1.0])
    assert _mask(df, rules.valid_distance(config)) == [False, True, True, True, False, False, False]


def test_duration_limits(make_runs, config):
    df = make_runs(duration_sec=[59.0, 60.0, 3600.0, 18000.0, 18001.0, None])
    assert _mask(df, rules.valid_duration(config)) == [False, True, True, True, False, False]


def test_pace_limits(make_runs, config):
    # 10 km: 2.29 / 2.30 / 10.50 / 10.51 min per km; 20 km in 45 min is too fast
    df = make_runs(distance_km=[10.0, 10.0, 10.0, 10.0, 20.0],
                   duration_sec=[2.29 * 600, 2.30 * 600, 10.50 * 600, 10.51 * 600, 45 * 60.0])
    assert _mask(df, rules.valid_pace(config)) == [False, True, True, False, False]


def test_pace_zero_distance_is_invalid(make_runs, config):
    assert _mask(make_runs(distance_km=[0.0]), rules.valid_pace(config)) == [False]


def test_heart_rate_limits(make_runs, config):
    df = make_runs(avg_heart_rate=[79.0, 80.0, 150.0, 210.0, 211.0, None])
    assert _mask(df, rules.valid_heart_rate(config)) == [False, True, True, True, False, False]


def test_hr_consistency_masks(make_runs, config):
    # max - avg: +20, 0, -3 (tolerated), -4 (conflict), one side null
    df = make_runs(avg_heart_rate=[150.0, 150.0, 150.0, 150.0, None],
                   max_heart_rate=[170.0, 150.0, 147.0, 146.0, 140.0])
    m = rules.hr_consistency(config)
    rows = df.select(m.inverted.alias("i"), m.tolerance.alias("t"), m.conflict.alias("c")).collect()
    assert [(r.i, r.t, r.c) for r in rows] == [
        (False, False, False), (False, False, False), (True, True, False), (True, False, True), (False, False, False)]


def test_masks_never_null(make_runs, config):
    df = make_runs(distance_km=[None], duration_sec=[None], avg_heart_rate=[None])
    row = df.select(rules.valid_distance(config), rules.valid_pace(config), rules.valid_heart_rate(config)).first()
    assert list(row) == [False, False, False]


def test_all_present(make_runs):
    df = make_runs(distance_km=[1.0, None, 1.0], duration_sec=[1.0, 1.0, None])
    assert _mask(df, rules.all_present(["distance_km", "duration_sec"])) == [True, False, False]
    assert df.where(~rules.all_present(["distance_km"])).count() == 1
    assert df.where(F.lit(True)).count() == 3


def test_unit_heuristics_scope(make_runs):
    from datetime import datetime

    from stridewise.operators.typing import scale_if_max_above, scale_if_median_within
    early, late = datetime(2025, 8, 22), datetime(2025, 9, 19)
    df = make_runs(distance_km=[5000.0, 10000.0, 5.0, 10.0], export_date=[early, early, late, late],
                   duration_sec=[30.0, 40.0, 1800.0, 2400.0])
    # whole frame (the reference's behaviour): one export in metres turns every distance
    whole = sorted(r.distance_km for r in scale_if_max_above(df, "distance_km", 200, 1000.0).collect())
    assert whole == [0.005, 0.01, 5.0, 10.0]
    # per export: only the export in metres is converted
    per = sorted(r.distance_km for r in scale_if_max_above(df, "distance_km", 200, 1000.0, scope="export_date").collect())
    assert per == [5.0, 5.0, 10.0, 10.0]
    mins = sorted(r.duration_sec for r in scale_if_median_within(df, "duration_sec", 10, 200, 60.0, scope="export_date").collect())
    assert mins == [1800.0, 1800.0, 2400.0, 2400.0]
