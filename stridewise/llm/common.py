"""Helpers shared by the operators: written intermediate tables, hot-key joins, connected components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_root

#: The white space that parts words (space, tab to carriage return), for Java expressions and for trimming.
WHITE_CLASS = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\f\r"

#: Settings while a table is written: shuffle files go when the write is done, and Python tasks get small batches of long texts.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Session settings (``__`` stands for a dot) that hold inside the block only."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (scheme kept)."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    The lineage is cut, a lost executor costs a re-read only, and the shuffle
    files behind the write are removed as soon as it is done.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with session_conf(spark, **_WRITING):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_stage(*frames: DataFrame) -> None:
    """Remove the folders of frames made by :func:`stage` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "staged_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            hadoop = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Python tasks get long texts a few megabytes at a time from now on (for results that are not written here)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def trim_memory() -> None:
    """Give memory that a Python worker has freed back to the system, as the worker lives on idle."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def worker_object(name: str, make):
    """An object kept by a Python worker process between its tasks, so that a cache need not be filled anew."""
    import sys
    import types

    kept = sys.modules.setdefault("_stridewise_worker", types.ModuleType("_stridewise_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def word_array(text: Column) -> Column:
    """Words of a text (maximal runs without ASCII white space) as an array; null and blank texts give an empty one."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WHITE_CLASS, -1))


def computed_once(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the columns ``names`` behind a wall for the optimizer.

    A filter on a column built up over several projections would have the
    whole expression copied into it, each level over. The place in the array, always
    0, but not for the optimizer, keeps filters above the projection that holds the columns.
    """
    others = [c for c in df.columns if c not in names]
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1)).cast("int")
    packed = df.select(*[F.col(f"`{c}`") for c in others], F.get(F.array(F.struct(*names)), place).alias("_once"))
    return packed.select(*[F.col(f"`{c}`") for c in others], *[F.col(f"_once.{n}").alias(n) for n in names])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge list; ``component`` is the smallest node reachable.

    Hook to the smallest neighbouring label, then jump: each round takes, per
    node, the least label among its own and its neighbours', then replaces
    the label by the label of that label. Minima are combined before the
    shuffle and every round is a written table, so neither a hub nor a lost
    executor hurts. Stops when no label changes; raises if ``max_rounds``
    do not suffice (the rounds grow with the logarithm of the diameter).
    """
    both = (
        edges.select(F.col(a).alias("s"), F.col(b).alias("t"))
        .unionByName(edges.select(F.col(b).alias("s"), F.col(a).alias("t")))
        .where("s is not null and t is not null")
        .distinct()
    )
    both = stage(both, "edges")
    label = stage(both.groupBy(F.col("s").alias("node")).agg(F.least(F.col("node"), F.min("t")).alias("l")), "labels")
    for _ in range(max_rounds):
        # the least label that a node sees on itself or on a neighbour, offered to itself and to its present label
        seen = (
            both.join(label.select(F.col("node").alias("t"), "l"), "t").select(F.col("s").alias("node"), "l")
            .unionByName(label)
            .groupBy("node").agg(F.min("l").alias("m"))
        )
        offers = stage(seen, "offers")
        pairs = label.join(offers, "node")
        hooked = (
            pairs.select("node", "m").unionByName(pairs.select(F.col("l").alias("node"), "m"))
            .groupBy("node").agg(F.min("m").alias("m"))
        )
        hooked = stage(hooked, "hooked")
        jumped = hooked.join(hooked.select(F.col("node").alias("m"), F.col("m").alias("mm")), "m", "left").select(
            "node", F.least("m", F.coalesce("mm", "m")).alias("l")
        )
        new = stage(jumped, "labels")
        changed = new.join(label.withColumnRenamed("l", "old"), "node").where("l <> old").limit(1).count()
        drop_stage(offers, hooked, label)
        label = new
        if not changed:
            drop_stage(both)
            return label.select("node", F.col("l").alias("component")).transform(_keep_path(label))
    raise RuntimeError("connected components did not settle")


def _keep_path(source: DataFrame):
    def mark(df: DataFrame) -> DataFrame:
        df.staged_path = source.staged_path
        return df

    return mark


def running_before(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, per ``keys`` in ``order`` (for pre-aggregated tables)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
