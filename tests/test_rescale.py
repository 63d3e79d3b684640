"""Rescaling and moving averages against numpy and pandas."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from stridewise.operators.moving import moving_average
from stridewise.operators.rescale import min_max, power_transform, standardise, yeo_johnson_exponents


def likelihood(x, e):
    up = np.log1p(np.maximum(x, 0)) if abs(e) < 1e-12 else (np.power(np.maximum(x, 0) + 1, e) - 1) / e
    down = -np.log1p(np.maximum(-x, 0)) if abs(e - 2) < 1e-12 else -(np.power(np.maximum(-x, 0) + 1, 2 - e) - 1) / (2 - e)
    y = np.where(x >= 0, up, down)
    return -0.5 * len(x) * np.log(y.var()) + (e - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_scores_per_group_and_edge_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), ("b", 5.0), (None, 2.0), (None, 4.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["x"]): (r["x_std"], r["x_01"]) for r in min_max(standardise(df, ["x"], ["g"]), ["x"], ["g"]).collect()}
    assert got == {("a", 1.0): (-1.0, 0.0), ("a", 3.0): (1.0, 1.0), ("a", None): (None, None), ("b", 5.0): (0.0, 0.0),
                   (None, 2.0): (-1.0, 0.0), (None, 4.0): (1.0, 1.0), ("c", None): (None, None)}
    whole = [r["x_std"] for r in standardise(df, ["x"]).orderBy("x").collect() if r["x_std"] is not None]
    x = np.sort([v for _, v in rows if v is not None])
    assert np.allclose(whole, (x - x.mean()) / x.std())
    assert standardise(df.limit(0), ["x"]).count() == 0


@pytest.mark.parametrize("make", [lambda r: r.lognormal(1, 0.6, 800), lambda r: r.normal(0, 3, 800), lambda r: -r.gamma(2, 2, 800), lambda r: r.random(800) ** 0.3])
def test_exponent_is_the_most_likely(spark, make):
    x = make(np.random.default_rng(1))
    e = yeo_johnson_exponents(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double"), ["x"])["x"]
    grid = np.linspace(-5, 5, 20001)
    best = grid[np.argmax([likelihood(x, g) for g in grid])]
    assert abs(e - best) < 0.004


def test_columns_share_scans_and_constants_stay(spark):
    df = spark.createDataFrame([(float(i), 3.0, None) for i in range(50)], "a double, b double, c double")
    found = yeo_johnson_exponents(df, ["a", "b", "c"])
    assert found["b"] == found["c"] == 1.0 and 0 < found["a"] < 1.5
    out = power_transform(df, ["a", "b", "c"], found).first()
    assert (out["a_yj"], out["b_yj"], out["c_yj"]) == (0.0, 3.0, None)


@pytest.mark.parametrize("days", [1, 7, 30])
def test_moving_average_equals_pandas(spark, days):
    rng = np.random.default_rng(days)
    start = datetime(1969, 11, 1)
    rows = [(["x", "y"][int(rng.integers(2))], start + timedelta(hours=int(rng.integers(0, 24 * 200, 1)[0]) // 6 * 6), float(rng.normal())) for _ in range(400)]
    rows += [("x", None, 1.0), ("x", start + timedelta(days=3), None), (None, start, 2.0)]
    got = {(r["g"], r["t"]): (r["moving_average"], r["rows_in_span"]) for r in
           moving_average(spark.createDataFrame(rows, "g string, t timestamp_ntz, v double"), "v", "t", ["g"], days).collect()}
    frame = pd.DataFrame([r for r in rows if r[1] is not None], columns=["g", "t", "v"])
    assert len(got) == len(frame.drop_duplicates(["g", "t"]))
    for (g, t), (mean, n) in got.items():
        own = frame[(frame.g.isna() if g is None else frame.g == g) & (frame.t <= t) & (frame.t > t - timedelta(days=days))].v.dropna()
        assert n == len(own) and (mean is None if not n else abs(mean - own.mean()) < 1e-9)
