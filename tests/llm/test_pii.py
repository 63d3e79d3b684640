import random
import re
from hashlib import sha256

import pytest

from stridewise.llm import pii


def plain(text):
    """The stated patterns word for word."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.fixture(scope="module")
def field():
    return pii.train()


def test_patterns_equal_the_stated_ones():
    rnd = random.Random(5)
    parts = ["a", "@", ".", "1", "2", "55", "-", "+", " ", "_", "x.c", "4111111111111111", "é", "255", "0256", "(", ")", "%", "\U0001f600"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "a@" * 100_000):
        pii.base_spans(text)


def test_documents(documents, field):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in pii.personal_data(documents, field=field).collect():
        text = texts[r["doc_id"]]
        base = plain(text)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        assert r["base_sha256"] == sha256(pii.span_text(base).encode()).hexdigest()
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        assert {pii.span_text([s]) for s in base} <= set(r["spans"].split(",")) | {""}
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))
        if not re.search("[0-9@]", text):
            assert r["spans"] == ""


def test_the_field_adds_what_the_patterns_miss(field):
    found = lambda t: pii.find_spans([t], field)[1][0]
    text = "call +1 (212) 555-9999 4524132264652876 and"
    assert plain(text) == [] and [(k, text[a:b]) for k, a, b in found(text)] == [("card", "4524132264652876"), ("phone", "+1 (212) 555-9999")]
    assert [k for k, _, _ in found("mail bob@host now, or (415) 555-1234.")] == ["email", "phone"]
    for clean in ("in 2004 there were 1234567 rows", "version 2.0, released 12.03.2021", "100 200 300 400 500", "CC BY-NC 4.0.", "password=7602ad27cf5550de1c"):
        assert found(clean) == [], clean


def test_held_out_rows_of_the_labelled_table():
    right = total = 0
    for fold in range(5):
        model = pii.train([r for i, r in enumerate(pii.LABELLED) if i % 5 != fold])
        runs = pii.labelled_runs([r for i, r in enumerate(pii.LABELLED) if i % 5 == fold])
        for labels, (_, want) in zip(pii.viterbi(model, [f for f, _ in runs]), runs, strict=True):
            right += sum(a == b for a, b in zip(labels, want, strict=True))
            total += len(want)
    assert right / total > 0.7


def test_viterbi_equals_trying_every_sequence(field):
    import itertools

    import numpy as np

    runs = [f for f, _ in pii.labelled_runs(pii.LABELLED) if len(f) <= 3]
    for got, run in zip(pii.viterbi(field, runs), runs, strict=True):
        e = field.scores(run)
        score = lambda y, e=e: field.start[y[0]] + e[0, y[0]] + sum(field.trans[a, b] + e[t, b] for t, (a, b) in enumerate(itertools.pairwise(y), 1))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(run)), key=score)
        assert np.isclose(score(best), score(got))


def test_edge_cases_and_redaction(edge_documents, no_documents, field):
    rows = pii.personal_data(edge_documents, field=field).collect()
    assert len(rows) == 11 and all(r["spans"] == "" for r in rows if r["doc_id"] in (2, 3, 4, None))
    assert pii.personal_data(no_documents, field=field).count() == 0
    out = pii.redact_documents(edge_documents, field=field)
    assert out.schema == edge_documents.schema
    texts = {r["doc_id"]: r for r in out.collect()}
    given = next(r["text"] for r in edge_documents.collect() if r["doc_id"] == 7)
    assert texts[7]["text"] == given.replace("x@y.org", "[EMAIL]").replace("+1 (212) 555-0148", "[PHONE]") and texts[7]["n_chars"] == len(texts[7]["text"])
    assert texts[2]["text"] is None and texts[1]["text"] == "a b c d e f g"
    assert pii.redact("abcdef", [("ip", 1, 3), ("card", 2, 4)]) == "a[IP]ef"
