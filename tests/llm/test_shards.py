import zlib

import pytest

from stridewise.llm.shards import difference, group_shards, shard_documents


def check(docs, spread):
    rows = shard_documents(docs).collect()
    assert len(rows) == docs.count()
    sums, slots, home = [0] * 8, {}, {}
    texts = sorted((r["text"] or "").encode() for r in docs.collect())
    assert sorted(zlib.crc32(t) for t in texts) == sorted(r["text_crc32"] for r in rows)
    assert sorted(len(t) + 1 for t in texts) == sorted(r["size"] for r in rows)
    for r in rows:
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert home.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert max(sums) - min(sums) <= spread
    return sums


def test_bytes_are_near_equal(documents):
    largest = max(len(r["text"].encode()) for r in documents.collect())
    check(documents, largest / 4)


def test_edge_cases(edge_documents, no_documents):
    check(edge_documents, 10**9)
    assert shard_documents(no_documents).collect() == []


def test_difference_beats_greedy_on_a_known_case():
    places, sums = difference([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]], 2)
    assert sorted(sums) == [14, 16]  # Karmarkar and Karp's own example
    for i, value in enumerate([8, 7, 6, 5, 4]):
        assert places[i][0] in (0, 1) and value
    assert sums == [sum(v for v, p in zip([8, 7, 6, 5, 4], places, strict=True) if p[0] == s) for s in (0, 1)]


@pytest.mark.parametrize("per_block,per_merge", [(50, 100), (20, 3)])
def test_blocks_and_merges_place_each_group_once(spark, per_block, per_merge):
    groups = spark.range(400).selectExpr("cast(id as string) as `group`", "1 + (id * id) % 997 as size")
    rows = group_shards(groups, 8, per_block, per_merge).join(groups, "group").groupBy("shard").sum("size").collect()
    total = groups.groupBy().sum("size").first()[0]
    assert sum(r[1] for r in rows) == total and group_shards(groups, 8, per_block, per_merge).count() == 400
    if per_merge == 100:
        assert max(r[1] for r in rows) - min(r[1] for r in rows) <= 0.01 * total
