import re

import pytest

from stridewise.llm.quality import EDGE_MARKS, STOP_WORDS, keep_good, quality_rules

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(re.sub('[A-Z]', lambda m: m[0].lower(), w.strip(EDGE_MARKS)) in STOP_WORDS for w in words), len(lines),
        len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def check(docs):
    rows = quality_rules(docs).select("text", *COLUMNS).collect()
    for r in rows:
        assert tuple(r)[1:] == measures(r["text"]), r["text"][:80]
    return len(rows)


def test_measures_equal_plain_python(documents):
    assert check(documents) == documents.count()


def test_edge_cases(edge_documents, no_documents):
    assert check(edge_documents) == 11
    out = quality_rules(edge_documents)
    assert {"doc_id", "lang", "source", "size"} <= set(out.columns)
    assert out.where("kept is null or base_failed is null").count() == 0
    assert quality_rules(no_documents).count() == 0


@pytest.mark.parametrize(
    "text",
    ["x y z " * 40, "(The) OF, And... «la» 'der' -por- the,of \"\"\"\"\"\"\"\"\"\"\"\"the\"\"\"\"\"\"\"\" \u0130n !!! it's", "a b c a b c", "p q p q p q p q", "l1 m\nl1 m\n l1 m\n\n\n", "a b c d a b c d e", "#*$ %&| <>", "\U0001f600 é é"],
)
def test_overlapping_repeats_and_lines(spark, text):
    check(spark.createDataFrame([(text,)], "text string"))


def test_labelled_good_documents_stay(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality_rules(docs).join(labels, "doc_id")
    good = judged.where("quality = 1 and not base_failed")
    assert good.where("not kept").count() <= 0.002 * good.count()
    bad = judged.where("quality = 0")
    assert bad.where("kept").count() <= 0.1 * bad.count()
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules(docs).where("kept").count()


def test_no_python_in_the_plan(documents):
    plan = quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


PROSE = " ".join(f"the{i} word{i} of{i}" for i in range(30))
CLEAN = " ".join(f"house{i} by the river{i} and hill{i}" for i in range(20))


@pytest.mark.parametrize(("text", "lang", "kept"), [
    (CLEAN, "en", True), (CLEAN.upper(), "en", True), (CLEAN.replace("the", "(The),"), "en", True),
    (PROSE, "en", False), (PROSE, "EN_us", False), (PROSE, " de-AT", False), (PROSE, None, False), (PROSE, "", False),
    (PROSE, "pl", True), (PROSE, "fi-FI", True), ("nur " * 200, "pl", False), ("", "pl", False), (None, "pl", False),
])
def test_stop_words_in_any_case_and_only_where_there_is_a_list(spark, text, lang, kept):
    docs = spark.createDataFrame([(1, text, lang)], "doc_id long, text string, lang string")
    assert quality_rules(docs).first()["kept"] is kept
    assert keep_good(docs).count() == int(kept)
    assert keep_good(docs).columns == docs.columns


def test_a_table_without_languages_is_judged_by_all_lists(spark):
    docs = spark.createDataFrame([(1, CLEAN), (2, PROSE)], "doc_id long, text string")
    assert [r["doc_id"] for r in keep_good(docs).collect()] == [1]
