import numpy as np
import pytest

from stridewise.llm.rpforest import component_labels, further_levels, near_vectors


def brute(rows, cosine=0.95):
    n = len(rows)
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.asarray(v, dtype=float) if ok else None
        if ok:
            x = x / np.abs(x).max()
            x = x / np.sqrt((x * x).sum())
        unit.append(x if ok else None)
    link = np.eye(n, dtype=bool)
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]):
                link[i, j] = link[j, i] = unit[i] @ unit[j] >= cosine
    label = component_labels(link)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        name = min(ids) if ids else None
        out.append((rows[i][0], int(link[i].sum()) - 1, name, rows[i][0] == name))
    return sorted(out, key=str)


def check(spark, rows, kind="float", **options):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = sorted((tuple(r) for r in near_vectors(table, **options).collect()), key=str)
    assert got == brute(rows)
    return got


def clusters(seed, groups=12, each=12, dim=16, noise=0.05):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(each):
            v = (centre + noise * np.sqrt(dim) * rng.standard_normal(dim) * rng.random()).astype(np.float32)
            out.append((len(out), [float(x) for x in v]))
    return out


def test_recall_on_a_larger_table(spark):
    rows = clusters(5, groups=60, each=40, dim=64, noise=0.03)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = np.asarray([v for _, v in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = dict(zip([i for i, _ in rows], (x @ x.T >= 0.95).sum(axis=1) - 1, strict=True))
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(table).collect()}
    assert all(got[i] <= n for i, n in links.items())
    assert sum(got.values()) >= 0.9 * sum(links.values()) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_brute_force(spark, seed):
    check(spark, clusters(seed))


def test_large_leaves_are_split_again_and_groups_meet_in_blocks(spark):
    check(spark, clusters(3, groups=4, each=90, noise=0.03), most_in_leaf=40)


def test_edge_cases(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
        (8, [float("inf"), 1.0]), (9, [None, 1.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e30, 1e28]),
        (13, [-0.0, 5.0]),
    ]
    got = check(spark, rows)
    assert (4, 0, 4, True) in got
    check(spark, [(1, [1e-200, 0.0]), (2, [1e300, 0.0])], "double")
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, kept boolean, cls long")
    assert near_vectors(empty).count() == 0


def hot_group(n, pairs, typical=0.88, dim=64, seed=11):
    """``n`` vectors of one dense group, and ``pairs`` more at cosine 0.952 to the first of them that chain with nothing else."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(dim))
    x = unit(centre + np.sqrt(1 / typical - 1) * unit(rng.standard_normal((n, dim))))
    alike = 1 - (1 - 0.952) / (1 - typical)
    own = x[:pairs] - np.sqrt(typical) * centre
    mates = np.sqrt(typical) * centre + alike * own + np.sqrt((1 - alike**2) * (1 - typical)) * unit(rng.standard_normal((pairs, dim)))
    side = mates - (mates * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    return np.concatenate([x, 0.952 * x[:pairs] + np.sqrt(1 - 0.952**2) * unit(side)])


def test_pairs_in_a_hot_group_are_found_with_few_trees(spark):
    x = hot_group(6000, 300)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component_id"] for r in near_vectors(table, trees=4).collect()}
    assert sum(got[i] == got[6000 + i] for i in range(300)) >= 0.97 * 300


def test_levels_follow_the_size():
    assert [further_levels(m, 1500) for m in (1501, 2400, 3000, 10**7)] == [1, 1, 2, 4]


def test_sql_twin_on_chains_copies_and_unusable_vectors(spark):
    import duckdb
    import pyarrow as pa

    from stridewise.llm.rpforest import ORACLE

    rng = np.random.default_rng(11)
    base = rng.normal(size=(40, 16))
    near = [base[i % 40] + rng.normal(scale=0.08, size=16) * (1 + i % 3) for i in range(160)]
    vectors = [v.tolist() for v in (*base, *near, *base[:5])] + [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [1.0, 2.0]]
    rows = [(1000 - i, v) for i, v in enumerate(vectors)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))}))
    want = sorted(con.execute(ORACLE).fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want and max(w[1] for w in want) > 1
