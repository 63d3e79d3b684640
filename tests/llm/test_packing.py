import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stridewise.llm.packing import WINDOW, best_fit_decreasing, pack_documents, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def check(docs, tokenizer, most_padding=1.3):
    rows = pack_documents(docs).collect()
    ids = {}
    for r in docs.select("doc_id", "text").collect():
        ids.setdefault(r["doc_id"], []).append([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for key, texts in ids.items():
        want = []
        for t in texts:
            for at in range(0, len(t), WINDOW):
                part = np.asarray(t[at : at + WINDOW], dtype="<u4").tobytes()
                want.append((at, len(part) // 4, zlib.crc32(part), len(t)))
        assert sorted(pieces[key]) == sorted(want), key
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= WINDOW
    assert len(rows) == sum(map(len, pieces.values()))
    tokens = sum(len(t) for x in ids.values() for t in x)
    assert len(windows) <= max(1, most_padding * tokens / WINDOW + 1)


def test_documents(documents, tokenizer):
    check(documents, tokenizer)


def test_edge_cases(edge_documents, no_documents, tokenizer):
    check(edge_documents, tokenizer)
    assert pack_documents(no_documents).count() == 0


def test_odd_texts_tokenize_like_the_whole(spark, tokenizer):
    texts = [
        "a<|endoftext|> b", "it's x\x1cy ́z", "ΑΣ ΣΑΣ Σ", "\n\n  a\tb\r\nc é", "x" * 5000 + " 'S 'T don'T", "A.. b., C. d,. İ. İx",
        "<|endoftext|>. a|b|", "ǅ ª áb, é. 한글. ①. x². ½ ẞ", "the&&& of%%% !! ?!.", " a b　c", "re're 've.", "né né", "ﬁn ﬀ",
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer)


def test_best_fit_takes_the_tightest_window():
    rnd = random.Random(3)
    for _ in range(200):
        lengths = sorted((rnd.randint(1, 16) for _ in range(rnd.randint(1, 40))), reverse=True)
        numbers, offsets = best_fit_decreasing(lengths, 16)
        free = []
        for length, number, offset in zip(lengths, numbers, offsets, strict=True):
            fits = [f for f in free if f >= length]
            if fits:
                assert free[number] == min(fits)
            else:
                assert number == len(free)
                free.append(16)
            assert offset == 16 - free[number]
            free[number] -= length
