import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stridewise.llm import pieces
from stridewise.llm.pieces import PieceEncoder, decode_pieces, default_model, encode_pieces, merge


@pytest.fixture(scope="module")
def coder():
    return PieceEncoder(default_model())


def same(coder, text):
    assert coder.encode(text) == coder.library.encode(text), repr(text)


MIXED = [" ", "▁", "a", "e", "t", "the", "é", "\n", "\t", "\x00", "1", "　", "\U0001f600", "中", "-", "=", "aaaa", "  ", "<s>", "<0x0A>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(MIXED), max_size=40).map("".join) | st.text(max_size=60))
def test_equals_the_library(coder, text):
    same(coder, text)
    assert coder.decode(coder.encode(text)) == coder.library.decode(coder.library.encode(text))


def test_runs_and_joined_pieces(coder):
    for c in " =-*a/_.\n":
        for n in (1, 2, 3, 15, 16, 17, 33, 64, 65, 200):
            same(coder, c * n)
            same(coder, c * n + "the")
    rng, all_pieces = random.Random(5), list(coder.ids)
    for _ in range(3000):
        same(coder, "".join(rng.choices(all_pieces, k=rng.randint(1, 6))).replace("▁", " "))


def test_a_word_longer_than_many_windows(coder, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 64)
    rng = random.Random(6)
    same(coder, "".join(rng.choices("abcdeinrst", k=5000)))


def test_positions_fail_and_are_taken_back(coder):
    """Where the longest match is wrong the encoder has to go back; the definition agrees."""
    word = next(w for w in ("▁" + a + b for a in coder.ids for b in ("ing", "ed", "er")) if len(w) < 12 and "▁" not in w[1:]
                and merge(w, coder.score)[0] != max((w[:i] for i in range(1, len(w) + 1) if w[:i] in coder.ids), key=len))
    assert coder.encode_cut(word) == [coder.ids[p] for p in merge(word, coder.score)]


def test_table(spark, edge_documents, no_documents, coder):
    table = edge_documents.withColumnRenamed("kept", "piece_ids")
    rows = encode_pieces(table, decoded="back").collect()
    assert len(rows) == table.count()
    for r in rows:
        want = coder.library.encode(r["text"] or "")
        assert list(r["piece_ids"]) == want and r["back"] == coder.library.decode(want)
    assert encode_pieces(no_documents).count() == 0
    coded = encode_pieces(edge_documents).drop("text")
    assert sorted(str(r["text"]) for r in decode_pieces(coded).collect()) == sorted(str(r["back"]) for r in rows)


def test_query(spark, coder):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in pieces.pieces_query(spark, sf).collect())
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = coder.library.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(coder.library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
