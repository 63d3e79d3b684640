import random
import re

import numpy as np
import pytest

from stridewise.llm import jaccard
from stridewise.llm.jaccard import jaccard_components, one_per_group, signatures
from stridewise.llm.shingles import WordHashes, least_difference, parity, shingle_set


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    """n_shingles and component of each row index; a component's name is its smallest id."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[root(i)] = min(names.get(root(i), d), d)
    return sorted(((d, len(s), names.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def check(docs, k=4, percent=85):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, k=k, percent=percent).collect()), key=str)
    assert got == brute(rows, k, percent)


def near_copies(n, seed, edits=1, words=60):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        out.append((seed * 1000 + i, " ".join(own)))
    return out


def test_equals_brute_force(documents):
    check(documents)


def test_edge_cases(edge_documents, no_documents):
    check(edge_documents)
    assert jaccard_components(no_documents).count() == 0


def test_groups_at_the_threshold(spark):
    docs = near_copies(60, 1, 3) + near_copies(40, 2, 2, 30) + [(9000 + i, " ".join(f"q{j}" for j in range(i, i + 12))) for i in range(30)]
    check(spark.createDataFrame(docs, "doc_id long, text string"))
    check(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80)


@pytest.mark.parametrize("part_level", [0, 8])
def test_many_classes_under_one_signature_meet_in_blocks(spark, monkeypatch, part_level):
    monkeypatch.setattr(jaccard, "MOST_PAIRED", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "PART_LEVEL", part_level)
    docs = near_copies(80, 3, 3) + near_copies(30, 4, 4, 40)
    check(spark.createDataFrame(docs, "doc_id long, text string"))


@pytest.mark.parametrize("seed", range(6))
def test_linked_sets_share_a_signature(seed):
    """Whatever the frequency classes are: rare only, frequent only, mixed, and sets that run out of tokens."""
    rng = np.random.default_rng(seed)
    levels = rng.choice(np.asarray([0, 1, 3], dtype=np.uint8), 1 << 10, p=[(1, 0, 0), (0, 1, 0), (0.1, 0.6, 0.3), (0.5, 0.4, 0.1), (0.05, 0.9, 0.05), (0.02, 0, 0.98)][seed])
    for _ in range(400):
        n = int(rng.integers(1, 120))
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = int(rng.integers(0, max(1, n // 10) + 1))
        a, b = np.unique(base[cut // 2 :]), np.unique(np.concatenate([base[: n - (cut - cut // 2)], rng.integers(0, 1 << 63, int(rng.integers(0, 3)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) and len(b) and 100 * both >= 85 * (len(a) + len(b) - both) and (len(a) != len(b) or both != len(a)):
            assert len(np.intersect1d(signatures(a, levels, 85), signatures(b, levels, 85))), (n, cut)


def test_parts_of_frequent_signatures():
    rng = np.random.default_rng(3)
    sigs = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    heat = np.repeat(np.asarray([0, jaccard.PART_LEVEL, jaccard.PART_LEVEL + 1, jaccard.PART_LEVEL + 4], dtype=np.uint8), 10)
    dealt = np.stack([jaccard.parts_of(sigs, heat, int(cls)) for cls in rng.integers(-(1 << 63), 1 << 63, 2000)])
    assert not dealt[:, :20].any() and set(np.unique(dealt[:, 20:30])) == {1, 2}
    for column in dealt[:, 30:].T:  # about the same number of classes in each of the parts
        assert set(np.unique(column)) == set(range(1, 17)) and np.bincount(column)[1:].max() < 250


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 63, int(rng.integers(0, 300)), dtype=np.uint64)]))
        if len(b):
            assert least_difference(parity(a), parity(b)) <= len(np.setxor1d(a, b))


def test_shingle_sets():
    h = WordHashes()
    assert len(shingle_set("a b c d e", 4, h)) == 2 and len(shingle_set("A b", 4, h)) == 1 and len(shingle_set(" \n", 4, h)) == 0
    assert (shingle_set("A B c D", 4, h) == shingle_set("a\tb c\nd", 4, h)).all()
    assert set(shingle_set("a b c", 4, h)) != set(shingle_set("b c", 4, h))


def test_one_per_group(spark, documents, edge_documents):
    kept = one_per_group(documents)
    assert kept.columns == documents.columns
    least = {r["component_id"] for r in jaccard_components(documents, k=5, percent=80).collect()}
    assert {r["doc_id"] for r in kept.collect()} == least
    edge = sorted((r["doc_id"] for r in one_per_group(edge_documents).collect()), key=str)
    assert edge == sorted([1, 2, 3, 4, 7, 8, 9, None, None], key=str)
    again = spark.createDataFrame([(1, "p q r s t u"), (1, "p q r s t u"), (2, "other words are here now")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in one_per_group(again).collect()) == [1, 2]


def test_copies_in_other_tasks_are_read_once(spark):
    """Copies of all texts, dealt to other tasks, change neither the frequencies nor what is indexed."""

    def figures(copies):
        rows = [(i + 10_000 * c, t) for c in range(copies) for i, t in near_copies(40, 5, 3)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(copies, "doc_id")
        docs = docs.withColumn("text_hash", jaccard._text_hash("text")).withColumn("row", jaccard._row_hash("doc_id", "text_hash"))
        firsts = jaccard.first_rows(docs.select("doc_id", "text_hash"))
        levels = jaccard.frequency_levels(jaccard.profile(docs, 4, firsts).cache())
        posted = jaccard.index(docs, spark.sparkContext.broadcast(levels), 4, 85, firsts)
        return int(levels.astype(int).sum()), sorted(map(tuple, posted.distinct().collect())), posted.count()

    once, many = figures(1), figures(8)
    assert once[:2] == many[:2] and many[2] <= 1.1 * once[2]


def test_one_per_group_looks_up_what_both_bitmaps_mark(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_BITS", 9)  # so dense that most rows are marked by both
    rows = [(i + 1000 * c, t) for c in range(6) for i, t in near_copies(30, 6, 1)] + [(i, f"{i} a text of its own") for i in range(300)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    least = {r["component_id"] for r in jaccard_components(docs, k=5, percent=80).collect()}
    assert sorted(r["doc_id"] for r in one_per_group(docs).collect()) == sorted(least)
