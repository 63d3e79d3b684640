import numpy as np
import pandas as pd
import pytest

from stridewise.operators.quantiles import exact_median, exact_percentiles

PROBS = [0, 0.25, 0.5, 0.75, 1]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({
        # one hot group with most rows, a null group, small groups
        "g": rng.choice(["hot", "a", "b", None], n, p=[0.7, 0.1, 0.1, 0.1]),
        "v": np.where(rng.random(n) < 0.05, np.nan, rng.integers(0, 40, n) + rng.choice([0, 0.25, 0.5], n)),
    })
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("method", ["hist", "rank"])
def test_equal_to_pandas(sample, method):
    pdf, df = sample
    got = exact_percentiles(df, ["g"], "v", PROBS, method=method).toPandas()
    assert len(got) == 4
    for _, row in got.iterrows():
        sub = pdf[pdf.g.isna()] if row.g is None else pdf[pdf.g == row.g]
        x = sub.v.dropna()
        assert np.allclose(x.quantile(PROBS).values, row.q, rtol=0, atol=1e-12)
        assert row.n == len(x) and row.n_distinct == x.nunique()


def test_auto_picks_rank_above_bound(sample):
    pdf, df = sample
    got = exact_percentiles(df, ["g"], "v", [0.5], method="auto", max_distinct=5).toPandas()
    hot = got[got.g == "hot"].iloc[0]
    assert hot.q[0] == pdf[pdf.g == "hot"].v.median()


def test_median_helper(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 4.0), ("x", 7.0), ("y", None)], "g string, v double")
    rows = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    assert rows == {"x": 3.0}


@pytest.mark.parametrize("options", [{"method": "hist"}, {"method": "rank"}, {"max_distinct": 1}])
def test_without_keys_the_frame_is_one_group(sample, options):
    pdf, df = sample
    (row,) = exact_percentiles(df, [], "v", PROBS, **options).collect()
    x = pdf.v.dropna()
    assert np.allclose(x.quantile(PROBS).values, row.q, rtol=0, atol=1e-12) and (row.n, row.n_distinct) == (len(x), x.nunique())


@pytest.mark.parametrize("options", [{}, {"max_distinct": 1}])
def test_median_levels_down_to_the_whole_frame(sample, options):
    from stridewise.operators.impute import median_levels

    pdf, df = sample
    rows = {(r.gid, r.g): r.median for r in median_levels(df, "v", [["g"], []], **options).collect()}
    assert rows[1, None] == pdf.v.median() and rows[0, "hot"] == pdf[pdf.g == "hot"].v.median()
    assert len(rows) == 5
