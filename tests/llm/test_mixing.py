import re

import pytest

from stridewise.llm.mixing import mix_sources, mixed_documents


def targets(sizes):
    """Share by weight, stop at three times the size, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {s: share.get(s, 3.0 * sizes[s]) for s in order}
        stopped.update(over)


def check(docs):
    rows = mix_sources(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["size"] == n and 0 <= r["taken"] <= 3 * n and r["taken"] == r["copies"] * n
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), n)
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * largest[s]
    return rows, sizes, taken, want, largest


def test_targets_and_taken(documents):
    rows, sizes, taken, want, largest = check(documents)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 * largest[s] + 1


def test_small_sources_stop_at_three_epochs(spark):
    docs = [(i, "w " * 10, "a") for i in range(3)] + [(10 + i, "v " * 10, "b") for i in range(200)]
    rows, *_ = check(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    assert {r["taken"] for r in rows if r["source"] == "a"} == {30}


def test_edge_cases(edge_documents, no_documents):
    check(edge_documents)
    assert mix_sources(no_documents).count() == 0
    nothing = edge_documents.where("text is null")
    assert [r["taken"] for r in mix_sources(nothing).collect()] == [0, 0]


def test_reruns_agree_whatever_the_partitions(documents):
    one = mix_sources(documents).select("doc_id", "taken").collect()
    two = mix_sources(documents.repartition(7)).select("doc_id", "taken").collect()
    assert sorted(one) == sorted(two)


def test_mixed_documents_repeats_rows(edge_documents):
    taken = {r["doc_id"]: 0 for r in edge_documents.collect()}
    for r in mix_sources(edge_documents).collect():
        taken[r["doc_id"]] += r["copies"]
    mixed = mixed_documents(edge_documents)
    assert mixed.columns == edge_documents.columns
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}


def test_better_documents_come_first(spark):
    varied = [(i, " ".join(f"x{i}y{j}" for j in range(50)), "a") for i in range(300)]
    dull = [(1000 + i, "same " * 50, "a") for i in range(300)]
    filler = [(5000 + i, " ".join(f"f{j}" for j in range(50)), s) for i in range(100) for s in ("b", "c")]
    docs = spark.createDataFrame(varied + dull + filler, "doc_id long, text string, source string")
    rows = [r for r in mix_sources(docs).collect() if r["source"] == "a"]
    base = min(r["copies"] for r in rows)
    extra = [r["doc_id"] < 1000 for r in rows if r["copies"] > base]
    assert sum(extra) >= 290 and len(extra) - sum(extra) <= 210
