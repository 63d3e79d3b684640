import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stridewise.llm import katz
from stridewise.llm.katz import Discounts, katz_scores


def brute(rows):
    """Scores of each row, and the model's conditional mass after every context, which must be one."""
    tokens = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for seq, h in zip(tokens, held, strict=True):
        if not h:
            for a, b in zip([b" ", *seq], seq, strict=False):
                uni[b] += 1
                bi[a, b] += 1
                ctx[a] += 1
    n, v = sum(uni.values()), len(uni)
    low = lambda c: [sum(x == r for x in c.values()) for r in range(1, 7)]
    d1, d2 = Discounts.of(low(uni)).factor, Discounts.of(low(bi)).factor
    share = lambda c, d: c * (d[c - 1] if c <= 5 else 1.0)
    left = sum(c - share(c, d1) for c in uni.values())
    whole, unknown = (n, left / n) if left > 1e-9 else (n + 1, 1 / (n + 1))
    word = lambda w: share(uni[w], d1) / whole if uni[w] else unknown
    after, weight, den = defaultdict(list), {}, {}
    for (a, b), c in bi.items():
        after[a].append((b, c))
    mass = []
    for a, seen in after.items():
        spare = sum(c - share(c, d2) for _, c in seen)
        den[a] = ctx[a] + (spare <= 1e-9)
        weight[a] = (spare if spare > 1e-9 else 1.0) / den[a] / (1 - sum(word(b) for b, _ in seen))
        mass.append(sum(share(c, d2) for _, c in seen) / den[a] + weight[a] * (1 - sum(word(b) for b, _ in seen)))
    out = []
    for seq, h in zip(tokens, held, strict=True):
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in seq)
        score = 0.0
        for a, b in zip([b" ", *seq], seq, strict=False):
            if bi.get((a, b)):
                score += math.log10(share(bi[a, b], d2) / den[a])
            else:
                score += (math.log10(weight[a]) if a in weight else 0.0) + math.log10(word(b))
        out.append((h, len(seq), sum(uni[w] > 0 for w in seq), n, base, score))
    return out, mass


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, mass = brute(rows)
    assert mass == pytest.approx([1.0] * len(mass))
    got = katz_scores(docs).collect()
    key = lambda r: (str(r[0]), *r[1:])
    got = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got], key=key)
    want = sorted([(d, *w) for (d, _), w in zip(rows, want, strict=True)], key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for i in (5, 6):
        assert [g[i] for g in got] == pytest.approx([w[i] for w in want], rel=1e-9, abs=1e-9)
    return got


def test_equals_brute_force(documents):
    got = check(documents)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)  # better than the base on held-out texts


def test_many_blocks_and_hot_words(documents, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(katz, "TOKENS_PER_BUCKET", 3_000)
    check(documents)


def test_edge_cases(edge_documents, no_documents):
    check(edge_documents)
    assert katz_scores(no_documents).count() == 0
    assert len(check(edge_documents.where("text is null"))) == 2


def test_arrays_round_trip():
    for kind in ("u8", "i8", "i4", "f8", "?"):
        for values in (np.asarray([], dtype=kind), np.asarray([1, 0, 7, 7, 250], dtype=kind)):
            assert (katz.unsqueeze(katz.squeeze(values), kind) == values).all()
    rising = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (katz.unsqueeze(katz.squeeze(rising, rising=True), "u8", rising=True) == rising).all()


def test_discounts_fall_back_to_none():
    assert Discounts.of([5, 0, 1, 1, 1, 1]).factor == (1.0,) * 5
    assert all(0 < d <= 1 for d in Discounts.of([1000, 400, 210, 130, 90, 60]).factor)
