"""Sharding by Karmarkar-Karp differencing: near equal bytes for groups of equal texts that stay together.

Groups are dealt to blocks; each block is differenced in one bounded task and
leaves one partial partition (its k sums). Blocks are then differenced in
the same way, a fan-in at a time, until one partial partition is left.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_stage, running_before, stage

#: Fixed value: shards asked for.
SHARDS = 8

GROUPS_PER_BLOCK = 20_000
BLOCKS_PER_MERGE = 2_000
ROWS_PER_SLOT_BUCKET = 10_000


def difference(partials: list[list[int]], k: int) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions of ``k`` sums each into one.

    The two with the largest spread are merged, the one's largest sum with the
    other's smallest and so on, until one is left. Returns where each
    part of each input ended (``places[i][j]``) and the final sums.
    """
    heap = []
    for i, sums in enumerate(partials):
        slots = sorted(((s, (i, j)) for j, s in enumerate(sums)), key=lambda x: -x[0])
        heap.append((slots[-1][0] - slots[0][0], i, [(s, [at] if s else []) for s, at in slots]))
    heapq.heapify(heap)
    made = len(partials)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        merged = [(a + b, _joined(x, y)) for (a, x), (b, y) in zip(one, reversed(two), strict=True)]
        merged.sort(key=lambda slot: -slot[0])
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], made, merged))
        made += 1
    places = [[0] * k for _ in partials]
    for slot, (_, parts) in enumerate(heap[0][2]):
        for i, j in parts:
            places[i][j] = slot
    return places, [s for s, _ in heap[0][2]]


def _joined(x: list, y: list) -> list:
    """The shorter list goes into the longer."""
    if len(x) < len(y):
        x, y = y, x
    x.extend(y)
    return x


def group_shards(groups: DataFrame, k: int = SHARDS, groups_per_block: int = GROUPS_PER_BLOCK, blocks_per_merge: int = BLOCKS_PER_MERGE) -> DataFrame:
    """``(group, shard)`` for a table ``(group string, size long)`` with one row a group."""
    blocks = max(1, -(-groups.count() // groups_per_block))

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "group"], ascending=[False, True], kind="stable")
        places, sums = difference([[s] + [0] * (k - 1) for s in rows["size"].tolist()], k)
        part = np.asarray([p[0] for p in places], dtype=np.int32)
        return pd.DataFrame({"group": rows["group"], "node": rows["node"], "part": part, "part_sum": np.asarray(sums, dtype=np.int64)[part]})

    placed = stage(
        groups.withColumn("node", F.pmod(F.xxhash64("group"), F.lit(blocks))).groupBy("node")
        .applyInPandas(first, "group string, node long, part int, part_sum long"),
        "shard-groups",
    )
    # one row a part of a block; parts without a group are missing and count as 0
    nodes = stage(placed.groupBy("node", "part").agg(F.max("part_sum").alias("sum")), "shard-nodes")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        keys = sorted(rows["node"].unique())
        at = {n: i for i, n in enumerate(keys)}
        partials = [[0] * k for _ in keys]
        for n, p, s in zip(rows["node"], rows["part"], rows["sum"], strict=True):
            partials[at[n]][p] = int(s)
        places, sums = difference(partials, k)
        out = [(n, p, int(n // blocks_per_merge), places[i][p], sums[places[i][p]]) for n, i in at.items() for p in range(k)]
        return pd.DataFrame(out, columns=["node", "part", "up_node", "up_part", "up_sum"])

    while blocks > 1:
        step = stage(
            nodes.withColumn("_up", F.floor(F.col("node") / blocks_per_merge)).groupBy("_up")
            .applyInPandas(merge, "node long, part int, up_node long, up_part int, up_sum long"),
            "shard-merge",
        )
        placed = placed.join(step.select("node", "part", "up_node", "up_part"), ["node", "part"]).select(
            "group", F.col("up_node").alias("node"), F.col("up_part").alias("part")
        )
        nodes = step.select(F.col("up_node").alias("node"), F.col("up_part").alias("part"), F.col("up_sum").alias("sum")).distinct()
        blocks = -(-blocks // blocks_per_merge)
    return placed.select("group", F.col("part").alias("shard"))


def shard_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document.

    Size is the UTF-8 bytes of the text plus 1 (null: 1, treated as an
    empty text); equal texts go to one shard; ``slot`` counts a shard's rows
    from 0 without gaps, repeated rows included. A null ``doc_id`` is a value
    like any other; an empty table gives an empty table.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    thin = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.sha2(body, 256).alias("group"),
        ).withColumn("_bucket_hash", F.xxhash64("doc_id", "group", F.monotonically_increasing_id())),
        "shard-docs",
    )
    groups = stage(thin.groupBy("group").agg(F.sum("size").alias("size")), "shard-sizes")
    if not groups.take(1):
        return thin.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    shard_of = stage(group_shards(groups, k), "shard-map")
    buckets = max(16, -(-thin.count() // ROWS_PER_SLOT_BUCKET))
    placed = stage(
        thin.join(shard_of, "group").withColumn("bucket", F.pmod("_bucket_hash", F.lit(buckets)))
        .select("doc_id", "size", "text_crc32", "shard", "bucket", "_bucket_hash"),
        "shard-placed",
    )
    drop_stage(groups)
    counts = running_before(placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")), ["shard"], ["bucket"], "n", "before")
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "_bucket_hash")
    starts = stage(counts.select("shard", "bucket", "before"), "shard-starts")
    return (
        placed.withColumn("_n", F.row_number().over(inside)).join(starts, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("_n") - 1).alias("slot"))
    )


def sharding_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
