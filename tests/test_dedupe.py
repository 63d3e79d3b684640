from datetime import datetime

from stridewise.operators.dedupe import keep_first


def test_keeps_earliest_export_and_counts(make_runs):
    df = make_runs(calories=[400.0, 999.0, 400.0],
                   export_date=[datetime(2025, 9, 19), datetime(2025, 8, 22), datetime(2025, 8, 22)],
                   distance_km=[5.0, 5.0, 6.0])
    out = keep_first(df, ["source", "date", "distance_km", "duration_sec"], ["export_date"]).orderBy("distance_km").collect()
    assert [(r.distance_km, r.calories, r.n_copies) for r in out] == [(5.0, 999.0, 2), (6.0, 400.0, 1)]


def test_null_keys_are_equal(make_runs):
    df = make_runs(distance_km=[None, None, 5.0])
    out = keep_first(df, ["source", "date", "distance_km", "duration_sec"])
    assert out.count() == 2


def test_columns_and_order_preserved(make_runs):
    df = make_runs(n=3)
    out = keep_first(df, ["source", "date"], count_col=None)
    assert out.columns == df.columns and out.count() == 1


def test_hot_key(spark):
    # one key holds most rows: the single-row min_by buffer keeps memory flat
    df = spark.range(20000).selectExpr("IF(id % 3 = 0, id, 0) AS k", "id AS v")
    out = keep_first(df, ["k"], ["v"], count_col="n")
    assert out.count() == 1 + 20000 // 3 - 0
    hot = out.where("k = 0").first()
    assert hot.v == 0 and hot.n == 20000 - 20000 // 3 - 1 + 1


def test_frames_difference(make_runs):
    from stridewise.operators.combine import frames_difference
    a = make_runs(distance_km=[1.0, 2.0, 2.0])
    b = make_runs(distance_km=[2.0, 3.0])
    row = frames_difference(a, b).first()
    assert (row.missing, row.extra) == (2, 1)
    assert tuple(frames_difference(a, a).first()) == (0, 0)
