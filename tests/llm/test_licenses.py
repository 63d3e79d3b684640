import random
import re

import pytest

from stridewise.llm.licenses import BASE_PHRASES, LEAST_MATCH, TEMPLATES, license_scan, license_words, plain_scan, word_statistics

COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def check(docs):
    idf = word_statistics(docs.select(license_words("text").alias("_w")), "_w")
    rows = license_scan(docs).select("text", *COLUMNS).collect()
    for r in rows:
        assert tuple(r)[1:] == plain_scan(r["text"], idf), (r["text"] or "")[:80]
    return {r["text"]: r for r in rows}, len(rows)


def test_equals_plain_python(documents):
    assert check(documents)[1] == documents.count()


def test_edge_cases(edge_documents, no_documents):
    rows, n = check(edge_documents)
    assert n == 11 and license_scan(no_documents).count() == 0
    assert rows[None]["labels"] == "" and rows[None]["score"] == 0.0 and rows[None]["first_word"] is None


@pytest.mark.parametrize("t", range(len(TEMPLATES)))
def test_each_template_is_found(spark, documents, t):
    if t % 4:  # a quarter of them through Spark, all of them in plain Python
        idf = {w: 1.0 for x in TEMPLATES for w in x.text.split()}
        assert TEMPLATES[t].label in plain_scan("word " + TEMPLATES[t].text.upper() + ". word", idf)[5].split(",")
        return
    noise = documents.select("text").limit(30)
    hit = spark.createDataFrame([("Eins zwei. " + TEMPLATES[t].text.title() + "!\nmore",), (TEMPLATES[t].text.replace(" ", " zz "),)], "text string")
    rows, _ = check(noise.union(hit))
    assert TEMPLATES[t].label in rows["Eins zwei. " + TEMPLATES[t].text.title() + "!\nmore"]["labels"].split(",")
    assert rows[TEMPLATES[t].text.replace(" ", " zz ")]["labels"] == ""


def test_base_places(spark):
    rows, _ = check(spark.createDataFrame([("CC-BY, the MIT  License; mit license GNU general\npublic LICENSE ccby",)], "text string"))
    (r,) = rows.values()
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (4, 0, 7, "cc-by,gpl,mit")


def test_no_python_in_the_plan(documents):
    assert "Python" not in license_scan(documents)._jdf.queryExecution().executedPlan().toString()


def full_scan(text):
    """(labels, score) with every template compared at every word, without an index."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    spaced = f" {' '.join(words)} "
    labels, score = {label for phrase, label in BASE_PHRASES if f" {phrase} " in spaced}, 0.0
    for t in TEMPLATES:
        own = t.text.split()
        for o in range(-len(own) + 1, len(words)):
            share = sum(0 <= o + j < len(words) and words[o + j] == y for j, y in enumerate(own)) / len(own)
            span = f" {' '.join(words[max(o, 0) : max(o, 0) + len(own)])} "
            if share >= LEAST_MATCH and all(f" {p} " in span for p in t.phrases):
                labels.add(t.label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


def test_bundles_and_long_prose_lose_no_label(spark, documents):
    rng = random.Random(5)
    vocabulary = sorted({w for t in TEMPLATES for w in t.text.split()})
    notices = [t.text for t in TEMPLATES]
    texts = [" . ".join(notices)] + [f"{a} . {b}" for i, a in enumerate(notices) for b in notices[i + 1 :: 3]]
    for notice in notices:  # inside prose that uses many licence words, as it stands and with words replaced
        prose = " ".join(rng.choice(vocabulary) for _ in range(300))
        worn = " ".join("zz" if rng.random() < 0.12 else w for w in notice.split())
        texts.append(f"{prose} . {notice} . {prose} . {worn}")
    mit = notices[2].split()
    missing = set(sorted({*mit} - {"free", "of", "charge", "without", "restriction", "the", "software", "to"})[: len(mit) // 4])
    texts.append(" ".join("zz" if w in missing else w for w in mit))
    table = documents.select("text").limit(30).union(spark.createDataFrame([(x,) for x in texts], "text string"))
    rows, _ = check(table)
    for x in texts:
        assert (rows[x]["labels"], rows[x]["score"]) == full_scan(x), x[:80]
    assert len(rows[texts[0]]["labels"].split(",")) == 15
