import re
from collections import Counter

import numpy as np
import pytest

from stridewise.llm import phrases
from stridewise.llm.phrases import mine_phrases, ngram_groups


def brute(rows, least, top, covered=100):
    out = []
    per_lang = {}
    for lang, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts = per_lang.setdefault(lang or "und", Counter())
            for n in range(1, 6):
                counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, f in per_lang.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: c for p, c in f.items() if 2 <= len(p) <= 5 and c >= least}
        inside = {}
        for p, c in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside.get(p[i : i + m], 0), c)
        found = []
        for p, a in cands.items():
            if 100 * inside.get(p, -1) >= covered * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def mined(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "text", "1 as n", "2 as rank", "text as phrase", "0L as f")
    return sorted(tuple(r) for r in mine_phrases(docs, **options).collect())


def random_rows(seed, docs=150, words=14):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "a\x01", "A", "new york"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!"]
    out = []
    for _ in range(docs):
        picked = rng.choice(vocabulary, size=rng.integers(0, 60), p=weights / weights.sum())
        out.append((rng.choice(["en", "de", None]), "".join(w + rng.choice(marks) for w in picked)))
    return out


@pytest.mark.parametrize("seed, covered", [(1, 100), (2, 100), (3, 60)])
def test_equals_brute_force(spark, seed, covered):
    rows = [(None if lang is None else str(lang), text) for lang, text in random_rows(seed)]
    rows += [("en", "same passage over and over again here") for _ in range(30)] + [("fr", None), ("fr", ""), ("fr", " \t.,"), (None, "x")]
    want = brute(rows, least=12, top=40, covered=covered)
    assert len(want) > 40
    assert mined(spark, rows, least=12, top=40, covered_percent=covered) == want


def test_small_batches_slices_and_a_crowded_bitmap(spark, monkeypatch):
    rows = [(None if lang is None else str(lang), text) for lang, text in random_rows(4)]
    monkeypatch.setattr(phrases, "HELD_BYTES", 300)
    monkeypatch.setattr(phrases, "SLICE", 16)
    monkeypatch.setattr(phrases, "GIVEN_ROWS", 7)
    # every bit set: all n-grams are counted, none is wrong
    monkeypatch.setattr(phrases, "hash_bitmap", lambda hashes, column: np.full(1 << 10, 255, dtype=np.uint8))
    assert mined(spark, rows, least=12, top=40) == brute(rows, least=12, top=40)


def test_products_beyond_64_bits(spark):
    f = 4_000_000_000
    counts = spark.createDataFrame([("en", ["a"], "a", f), ("en", ["b"], "b", f + 1), ("en", ["a", "b"], "a b", f - 1)], "lang string, words array<string>, phrase string, f long")
    cuts = phrases.cut_counts(counts).selectExpr("a", "l", "r").collect()
    assert [tuple(r) for r in cuts] == [(f - 1, f, f + 1)]
    n = 10**15
    got = spark.sql(f"select cast(cast(1000 as decimal(38,0)) * cast({f - 1}L as decimal(38,0)) * cast({n}L as decimal(38,0)) "
                    f"div (cast({f}L as decimal(38,0)) * cast({f + 1}L as decimal(38,0))) as long) as s").first()["s"]
    assert got == 1000 * (f - 1) * n // (f * (f + 1))


def test_equal_hashes_of_different_ngrams():
    ids = np.array([1, 2, 3, 1, 2, 4])
    first, counts = ngram_groups(ids, np.array([0, 1, 3, 4]), 2, np.zeros(4, dtype=np.uint64))
    assert sorted(zip([tuple(ids[[0, 1, 3, 4][i] + np.arange(2)]) for i in first], counts.tolist())) == [((1, 2), 2), ((2, 3), 1), ((2, 4), 1)]


def test_empty_and_edge_tables(spark, edge_documents, no_documents):
    assert mine_phrases(no_documents).count() == 0
    rows = [(r["lang"], r["text"]) for r in edge_documents.collect()]
    assert sorted(tuple(r) for r in mine_phrases(edge_documents, least=2).collect()) == brute(rows, 2, 2000)
