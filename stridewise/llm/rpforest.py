"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Every tree splits by random directions at the median; vectors close to a
split go to both sides. Vectors are compared within leaves, in double
precision; links join components. Leaves that are still too large are split
again with directions fitted to a sample of their own, and what cannot be split
is compared block by block. Pairs planted at the threshold go down the trees
along with the vectors; forests are added until so many of them have met as the
recall asks for, however deep the trees are. Link counts are then taken within
components.

Equal vectors are one class throughout, so their number costs nothing.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop_stage, stage

COSINE = 0.95
#: Trees of a forest, and the share of planted pairs that must meet in some forest, in each quarter of them by density.
TREES = 12
RECALL = 0.99
#: Planted pairs at most, and the share of the sample they are made from; vectors expected to have this many links need none.
PROBES = 1_000
PROBE_SHARE = 0.05
CHAINED = 50
LEAF = 250
MOST_IN_LEAF = 1500
SPILL = 0.08

#: Bounds of the samples that trees are fitted on: vectors a forest, and vectors a leaf that is split again.
SAMPLE = 20_000
LEAF_SAMPLE = 2_000
LEVELS_PER_ROUND = 4
MOST_ROUNDS = 8
#: Rows of a block where a group meets itself in pairs of blocks: a leaf's, and the least and most of a component's (an eighth of it between).
BLOCK = 1_000
LEAST_BLOCK, MOST_BLOCK = 128, 2_000


def unit_rows(vectors) -> np.ndarray:
    x = np.asarray(list(vectors), dtype=np.float64)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_tree(x: np.ndarray, levels: int, rng: np.random.Generator, spill: float = SPILL, least: int = 32) -> dict:
    """Random directions with the quantiles around the median between which vectors go to both sides; child -1 is a leaf."""
    dirs, low, high, kids = [], [], [], []

    def grow(rows: np.ndarray, level: int) -> int:
        if level == 0 or len(rows) < 2 * least:
            return -1
        d = rng.standard_normal(x.shape[1])
        d /= np.sqrt(d @ d)
        p = x[rows] @ d
        lo, hi = np.quantile(p, [0.5 - spill / 2, 0.5 + spill / 2])
        if ((p >= lo) & (p <= hi)).mean() > 0.5:
            return -1
        me = len(dirs)
        dirs.append(d)
        low.append(lo)
        high.append(hi)
        kids.append([-1, -1])
        kids[me] = [grow(rows[p <= hi], level - 1), grow(rows[p >= lo], level - 1)]
        return me

    grow(np.arange(len(x)), levels)
    return {"dirs": np.asarray(dirs), "low": np.asarray(low), "high": np.asarray(high), "kids": kids}


def descend(x: np.ndarray, tree: dict) -> list[tuple[int, np.ndarray]]:
    """``(leaf, rows)`` of all leaves that get rows; a leaf is named by its path of sides after a leading 1."""
    if not len(tree["dirs"]):
        return [(1, np.arange(len(x)))]
    out, todo = [], [(0, 1, np.arange(len(x)))]
    while todo:
        node, path, rows = todo.pop()
        if node < 0:
            if len(rows):
                out.append((path, rows))
            continue
        p = x[rows] @ tree["dirs"][node]
        left, right = tree["kids"][node]
        todo.append((left, 2 * path, rows[p <= tree["high"][node]]))
        todo.append((right, 2 * path + 1, rows[p >= tree["low"][node]]))
    return out


def component_labels(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable, for a symmetric boolean matrix with a true diagonal."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def usable(vector: str):
    """True for vectors with finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda e: e != 0), F.lit(False))


def forest_sample(classes: DataFrame, seed: int) -> tuple[dict[int, np.ndarray], int]:
    """Unit vectors by length, of ``SAMPLE`` classes at most, and the number of classes."""
    sample = classes.orderBy(F.xxhash64("cls", F.lit(seed))).limit(SAMPLE).select("dim", "v").collect()
    dims = sorted({r["dim"] for r in sample})
    return {dim: unit_rows(r["v"] for r in sample if r["dim"] == dim) for dim in dims}, classes.count()


def first_levels(n: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))


def planted_pairs(x: np.ndarray, levels: int, weight: float, cosine: float, rng: np.random.Generator) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """``(spread, u, v)``: vectors of ``x``, each with one made up at ``cosine`` that spreads about the local centre as its neighbours do.

    Where neighbours are so dense that a vector has ``CHAINED`` links anyway, links chain and no pair is made.
    ``weight`` is the number of vectors that one of ``x`` stands for.
    """
    out, dim = [], x.shape[1]
    if dim < 2 or len(x) < 2 or not 0 < cosine < 1:
        return out
    wanted = set(rng.permutation(len(x))[: min(PROBES, math.ceil(PROBE_SHARE * len(x)))].tolist())
    for _, rows in descend(x, fit_tree(x, levels, rng)):
        centre = x[rows].mean(axis=0)
        for i in wanted.intersection(rows.tolist()):
            wanted.discard(i)
            u, own = x[i], x[i] - centre
            spread = float(own @ own)
            alike = 1 - (1 - cosine) / spread if spread > 0 else 0.0
            if alike <= 0 or weight * len(rows) * math.erfc(alike * math.sqrt(dim / 2)) / 2 >= CHAINED:
                continue
            other = x[rng.choice(rows)] - centre
            other = other - (other @ own) / spread * own
            size = np.sqrt(other @ other)
            if size < 1e-9:
                other = rng.standard_normal(dim)
                other = other - (other @ own) / spread * own
                size = np.sqrt(other @ other)
            v = centre + alike * own + np.sqrt(max(0.0, 1 - alike * alike) * spread) * other / size
            side = v - (v @ u) * u
            size = np.sqrt(side @ side)
            if size > 1e-9:
                out.append((spread, u, cosine * u + np.sqrt(1 - cosine * cosine) * side / size))
    return out


def first_leaves(classes: DataFrame, planted: DataFrame | None, sample: dict[int, np.ndarray], n: int, trees: int, seed: int, first: int) -> DataFrame:
    """``(tree, node, cls, dim, v)`` after the descent through the trees ``first`` and on, fitted on the sample."""
    spark = classes.sparkSession
    numbers = range(first, first + trees)
    forests = {dim: [fit_tree(x, first_levels(n), np.random.default_rng([seed, dim, t])) for t in numbers] for dim, x in sample.items()}
    shared = spark.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = unit_rows(part.column(2).to_pylist())
                # vectors of a length that the sample lacks stay together in one node of each tree, to be split later
                for t, tree in zip(numbers, shared.value.get(int(dim), [{"dirs": ()}] * len(numbers)), strict=True):
                    for leaf, rows in descend(x, tree):
                        got = part.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), t, dtype=np.int32)), pa.array(np.full(len(rows), leaf * 100_003 + int(dim), dtype=np.int64)), *got.columns],
                            names=["tree", "node", "cls", "dim", "v"],
                        )

    kind = classes.schema["v"].dataType.simpleString()
    rows = classes.select("cls", "dim", "v")
    if planted is not None:
        rows = rows.unionByName(planted.select("cls", "dim", "v"))
    return rows.mapInArrow(run, f"tree int, node long, cls long, dim int, v {kind}")


def further_levels(size: int, most: int) -> int:
    """Levels after which a node of ``size`` vectors has leaves of less than ``most``, as each level loses pairs."""
    return min(LEVELS_PER_ROUND, max(1, math.ceil(math.log(size / (0.9 * most)) / -math.log(0.5 + SPILL / 2))))


def split_again(rows: DataFrame, large: DataFrame, kind: str, round_no: int, most: int) -> DataFrame:
    """The rows of ``large`` nodes, sent down a further tree fitted to a sample of each node."""
    over = rows.join(large, ["tree", "node"])
    chosen = over.where(F.pmod(F.xxhash64("cls", F.lit(round_no)), F.greatest(F.lit(1), F.floor(F.col("m") / LEAF_SAMPLE))) == 0)

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([round_no, key[0], key[1] & 0x7FFFFFFF])
        tree = fit_tree(unit_rows(part["v"]), further_levels(int(part["m"].iloc[0]), most), rng)
        return pd.DataFrame({"tree": [key[0]], "node": [key[1]], "model": [pickle.dumps(tree)]})

    models = stage(chosen.groupBy("tree", "node").applyInPandas(fit, "tree int, node long, model binary"), "models")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (_, node), part in frame.groupby(["tree", "node"], sort=False):
                tree = pickle.loads(part["model"].iloc[0])
                part = part.drop(columns="model").reset_index(drop=True)
                for leaf, at in descend(unit_rows(part["v"]), tree):
                    got = part.iloc[at].copy()
                    got["node"] = np.int64((int(node) * 1_000_003 + leaf * 7919 + 13) % (1 << 62))
                    yield got

    return over.drop("m").join(models, ["tree", "node"]).mapInPandas(run, f"tree int, node long, cls long, dim int, v {kind}")


def leaves(rows: DataFrame, kind: str, most: int = MOST_IN_LEAF) -> tuple[DataFrame, list[DataFrame]]:
    """The rows after :func:`first_leaves` with large nodes split again, and the written tables they are read from."""
    rows = stage(rows, "leaves")
    written = [rows]
    done: DataFrame | None = None
    before = None
    for r in range(MOST_ROUNDS):
        sizes = rows.groupBy("tree", "node").agg(F.count("*").alias("m"))
        large = stage(sizes.where(f"m > {most}"), "large")
        written.append(large)
        total = large.agg(F.sum("m")).first()[0]
        if not total or (before is not None and total > 0.9 * before):
            break
        before = total
        kept = rows.join(large.select("tree", "node"), ["tree", "node"], "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = stage(split_again(rows, large, kind, r, most), "leaves")
        written.append(rows)
    return rows if done is None else done.unionByName(rows), written


def forest_links(classes: DataFrame, cosine: float, trees: int, seed: int, most: int, recall: float) -> DataFrame:
    """Edges ``(a, b)`` of as many forests of ``trees`` trees as it takes for ``recall`` of the planted pairs to meet."""
    spark = classes.sparkSession
    kind = classes.schema["v"].dataType.simpleString()
    sample, n = forest_sample(classes, seed)
    sampled = sum(len(x) for x in sample.values())
    rng = np.random.default_rng([seed, 1])
    pairs = [(dim, *pair) for dim, x in sample.items() for pair in planted_pairs(x, first_levels(n), n / sampled, cosine, rng)]
    planted, marks = None, None
    if pairs:
        names = rng.integers(-(1 << 63), 1 << 63, size=(len(pairs), 2)).tolist()
        made = [(int(names[i][k]), dim, both[k].tolist(), i) for i, (dim, _, *both) in enumerate(pairs) for k in (0, 1)]
        planted = spark.createDataFrame(made, "cls long, dim int, v array<double>, pair int").withColumn("v", F.col("v").cast(kind))
        planted = stage(planted, "planted")
        marks = F.broadcast(planted.select("cls", "pair"))
    quarters = [set(q.tolist()) for q in np.array_split(np.argsort([p[1] for p in pairs], kind="stable"), 4)] if pairs else []
    edges: DataFrame | None = None
    found, met, first = [], set(), 0
    while True:
        rows, written = leaves(first_leaves(classes, planted, sample, n, trees, seed, first), kind, most)
        if marks is not None:
            both = rows.join(marks, "cls").groupBy("tree", "node", "pair").agg(F.countDistinct("cls").alias("k")).where("k = 2")
            met |= {r["pair"] for r in both.select("pair").distinct().collect()}
            rows = rows.join(marks.select("cls"), "cls", "left_anti")
        found.append(stage(leaf_links(rows, cosine), "links"))
        drop_stage(*written)
        first += trees
        edges = found[-1] if edges is None else edges.unionByName(found[-1])
        if all(len(q & met) >= recall * len(q) for q in quarters):
            break
    if len(found) > 1:
        edges = stage(edges.distinct(), "links")
        drop_stage(*found)
    return edges


def in_blocks(rows: DataFrame, keys: list[str], block) -> DataFrame:
    """Rows with ``p, q`` and ``side``: a group with more than ``block`` rows meets itself as pairs of bounded blocks."""
    sizes = stage(rows.groupBy(*keys).agg(F.count("*").alias("_m")), "sizes")
    parts = F.ceil(F.col("_m") / block).cast("int")  # block: a number, or a column over _m
    dealt = (
        rows.join(sizes, keys).withColumn("_n", parts)
        .withColumn("side", F.when(F.col("_n") > 1, F.pmod(F.xxhash64("cls"), F.col("_n")).cast("int")).otherwise(0))
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    )
    return dealt.withColumn("p", F.least("side", "_o")).withColumn("q", F.greatest("side", "_o")).drop("_m", "_n", "_o")


def leaf_links(rows: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that join what is linked within leaves: at most one a row, not all pairs."""

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("cls").sort_values("cls")
        x, names = unit_rows(part["v"]), part["cls"].to_numpy()
        label = component_labels((x @ x.T >= cosine) | np.eye(len(x), dtype=bool))
        at = np.flatnonzero(label != np.arange(len(x)))
        return pd.DataFrame({"a": names[label[at]], "b": names[at]})

    blocks = in_blocks(rows, ["tree", "node", "dim"], block)
    return blocks.groupBy("tree", "node", "dim", "p", "q").applyInPandas(compare, "a long, b long").distinct()


def link_counts(rows: DataFrame, cosine: float) -> DataFrame:
    """``(cls, others)``: over the rows ``(component, cls, dim, mult, v)``, how many vectors of other classes each links with."""

    def count(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        p, q = key[2], key[3]
        one, two = part[part["side"] == p], part[part["side"] == q]
        x, y = unit_rows(one["v"]), unit_rows(two["v"])
        if not len(x) or not len(y):
            return pd.DataFrame({"cls": [], "others": []}, dtype="int64")
        hit = x @ y.T >= cosine
        if p == q:
            np.fill_diagonal(hit, False)
            return pd.DataFrame({"cls": one["cls"], "others": hit @ two["mult"].to_numpy()})
        return pd.DataFrame({
            "cls": np.concatenate([one["cls"], two["cls"]]),
            "others": np.concatenate([hit @ two["mult"].to_numpy(), hit.T @ one["mult"].to_numpy()]),
        })

    block = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.col("_m") / 8)))
    blocks = in_blocks(rows, ["component", "dim"], block)
    parts = blocks.groupBy("component", "dim", "p", "q").applyInPandas(count, "cls long, others long")
    return parts.groupBy("cls").agg(F.sum("others").alias("others"))


def near_vectors(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, trees: int = TREES, seed: int = 7,
    most_in_leaf: int = MOST_IN_LEAF, recall: float = RECALL,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors link at a cosine of ``cosine`` or more; only vectors of one
    length are compared. Null, zero, empty or non-finite vectors and those with null components
    link with nothing. Repeated rows count as vectors of their own. Rows
    without an id link like others but never name a component. Forests of
    ``trees`` trees are added until ``recall`` (below 1) of planted pairs have met.
    """
    table = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    valid = table.where(usable("v"))
    classes = stage(
        valid.groupBy("v").agg(F.count("*").alias("mult"), F.min("vec_id").alias("least"))
        .withColumn("cls", F.xxhash64("v")).withColumn("dim", F.size("v")),
        "vectors",
    )
    edges = forest_links(classes, cosine, trees, seed, most_in_leaf, recall)
    label = connected_components(edges).select(F.col("node").alias("cls"), "component")
    grouped = stage(classes.join(label, "cls"), "grouped")
    others = link_counts(grouped, cosine)
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = (
        grouped.select("cls", "component").join(stage(least, "least"), "component").join(stage(others, "others"), "cls")
        .select("cls", "component_id", "others")
    )
    info = stage(
        classes.select("cls", "mult", "least").join(stage(of_class, "of-class"), "cls", "left")
        .select("cls", (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")),
        "answers",
    )
    drop_stage(edges, grouped)
    keyed = table.select("vec_id", F.when(usable("v"), F.xxhash64("v")).alias("cls"))
    return keyed.join(info, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def rpforest_query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: DuckDB SQL of :func:`rpforest_query`: all pairs compared, links followed to the least vec_id.
ORACLE = f"""
WITH RECURSIVE given AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), vectors AS MATERIALIZED (
  SELECT vec_id, v FROM given
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE CASE WHEN len(x.v) = len(y.v) THEN list_cosine_similarity(x.v, y.v) >= {COSINE} END
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT g.vec_id, coalesce(c.n, 0) AS n_links, least(g.vec_id, coalesce(l.b, g.vec_id)) AS component_id,
  g.vec_id <= coalesce(l.b, g.vec_id) AS kept
FROM given g LEFT JOIN counts c ON c.a = g.vec_id LEFT JOIN least l ON l.a = g.vec_id
"""
