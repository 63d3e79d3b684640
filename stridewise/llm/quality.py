"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, computed_once, word_array

#: The symbols counted as ``n_symbols``.
SYMBOL_CLASS = "[#*$%&|<>]"

#: Languages with a list of stop words, and frequent function words of theirs, in lower case.
STOP_LANGUAGES = ("en", "fr", "de", "es")
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with",
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "que", "pour",
    "der", "die", "und", "den", "das", "von", "zu", "mit", "ist",
    "el", "los", "y", "se", "por", "con", "para", "una",
)

#: Punctuation around a word that is no part of a stop word.
EDGE_MARKS = ".,;:!?\"'()[]{}<>«»„“”‚‘’¿¡…*_-–—/"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``least <= metric <= most``; an open side is None. ``metric`` is a SQL expression over the base columns.

    ``where`` names a boolean column: the rule holds for the other rows whatever their metric.
    """

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    where: str | None = None


#: The threshold table. Ratios have the words or the lines of the text as denominators.
DEFAULT_RULES = (
    Rule("words", "n_words", least=50),
    Rule("mean_word_length", "word_chars / n_words", least=2.0, most=20.0),
    Rule("symbols_per_word", "n_symbols / n_words", most=0.25),
    Rule("stop_words_per_word", "n_stop_words / n_words", least=0.005, where="has_stop_list"),
    Rule("duplicate_lines", "n_dup_lines / n_lines", most=0.5),
    Rule("repeated_words", "n_repeat_words / n_words", most=0.5),
    Rule("lines_per_word", "n_lines / n_words", most=0.5),
)


def compile_rules(rules: tuple[Rule, ...]) -> list[tuple[str, Column]]:
    """One boolean column a rule; a metric that is null (no words, no lines) fails its rule."""
    out = []
    for r in rules:
        metric = F.expr(_safe(r.metric))
        ok = F.lit(True)
        if r.least is not None:
            ok = ok & (metric >= F.lit(float(r.least)))
        if r.most is not None:
            ok = ok & (metric <= F.lit(float(r.most)))
        ok = F.coalesce(ok, F.lit(False))
        out.append((r.name, ok | F.coalesce(~F.col(r.where), F.lit(False)) if r.where else ok))
    return out


def _safe(metric: str) -> str:
    """``a / b`` as a division that gives null for b = 0."""
    top, slash, bottom = metric.partition(" / ")
    return f"try_divide(cast({top} as double), cast({bottom} as double))" if slash else f"cast({top} as double)"


def has_stop_list(docs: DataFrame, lang: str) -> Column:
    """False where a language is stated (``en``, ``en-US``, ``EN_us``) and has no list; true where it has one or none is stated."""
    if lang not in docs.columns:
        return F.lit(True)
    main = F.lower(F.regexp_extract(F.col(f"`{lang}`").cast("string"), r"^\s*([A-Za-z]*)", 1))
    return F.coalesce(main.isin("", *STOP_LANGUAGES), F.lit(True))


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_stop_words, n_lines, n_dup_lines, n_repeat_words (long).

    Null texts count as empty. n_stop_words counts words in any case (A-Z) and with punctuation around them. n_repeat_words marks the words of every
    three-word window that stands twice or more in the text; windows are
    compared by a 64-bit hash inside one text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("_w", word_array(F.col(text)))
        .withColumn("_l", F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(body, F.lit(SYMBOL_CLASS)).cast("long"))
        .withColumn("n_stop_words", F.size(F.filter("_w", _is_stop_word)).cast("long"))
        .withColumn("n_lines", F.size("_l").cast("long"))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
        .withColumn("_h", F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2))))
        .withColumn("_h", F.when(F.size("_h") > 3, F.slice(F.col("_h"), F.lit(1), F.size("_h") - 2)))
        .withColumn(
            "_s",
            F.when(
                F.size(F.array_distinct("_h")) < F.size("_h"),
                F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
            ),
        )
        .withColumn("n_repeat_words", F.coalesce(_covered("_s"), F.lit(0)).cast("long"))
        .drop("_w", "_l", "_h", "_s")
    )


def _is_stop_word(word: Column) -> Column:
    """Whether a word, trimmed of punctuation and lower-cased, is in the list."""
    return ascii_lower(F.btrim(word, F.lit(EDGE_MARKS))).isin(*STOP_WORDS)


def _covered(sorted_windows: str) -> Column:
    """Words under windows whose hash stands next to an equal one in the sorted array."""
    twice = F.filter(
        sorted_windows,
        lambda x, i: (x["h"] == F.get(sorted_windows, i - 1)["h"]) | (x["h"] == F.get(sorted_windows, i + 1)["h"]),
    )
    at = F.sort_array(F.transform(twice, lambda x: x["p"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        at,
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = DEFAULT_RULES, lang: str = "lang") -> DataFrame:
    """Measures, ``has_stop_list``, ``base_failed``, one ``ok_<rule>`` flag a rule and ``kept`` for each document.

    The rule on stop words judges only documents whose language has a list, and those that state none (null, empty or no column ``lang``).

    Input columns stay; own names that clash are replaced. Null and empty
    texts have all measures 0 and fail; an empty table gives an empty table;
    repeated rows are judged alike. All work is one projection over the scan:
    no shuffle, no user function.
    """
    measured = text_measures(docs, text).withColumns({
        "has_stop_list": has_stop_list(docs, lang),
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })
    flags = compile_rules(rules)
    verdict = ~F.col("base_failed")
    for name, ok in flags:
        verdict = verdict & F.col(f"ok_{name}")
    judged = measured.withColumns({f"ok_{name}": ok for name, ok in flags}).withColumn("kept", verdict)
    return computed_once(judged, [*MEASURES, "has_stop_list", "base_failed", *[f"ok_{name}" for name, _ in flags], "kept"])


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = DEFAULT_RULES, lang: str = "lang") -> DataFrame:
    """The documents that pass, with the columns of ``docs``.

    Whatever their names, columns of ``docs`` stay as they are. Null and empty texts go; repeated rows stay or go together.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    stated = [F.col(f"`{lang}`").alias("_lang")] if lang in docs.columns else []
    judged = quality_rules(docs.select(row.alias("_row"), F.col(text).alias("_text"), *stated), "_text", rules, "_lang")
    return judged.where("kept").select("_row.*")


QUERY_COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
)


def quality_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return quality_rules(docs).select(*QUERY_COLUMNS)


_MARKS = EDGE_MARKS.replace("'", "''")
_LANGUAGES = ", ".join(f"'{x}'" for x in STOP_LANGUAGES)
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

ORACLE = rf"""
with t as (select doc_id, coalesce(text, '') as body,
                  coalesce(lower(regexp_extract(lang, '^\s*([A-Za-z]*)', 1)) in ('', {_LANGUAGES}), true) as has_stop_list,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
           from documents),
b as (select doc_id, w, has_stop_list, cast(len(w) as bigint) as n_words,
             cast(length(list_aggregate(list_concat(w, ['']), 'string_agg', '')) as bigint) as word_chars,
             cast(len(regexp_extract_all(body, '{SYMBOL_CLASS}')) as bigint) as n_symbols,
             cast(len(list_filter(w, lambda x: translate(trim(x, '{_MARKS}'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') in ({_STOPS}))) as bigint) as n_stop_words,
             cast(len(l) as bigint) as n_lines,
             cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines
      from t),
g as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
      from (select doc_id, w, unnest(range(1, n_words - 1)) as i from b)),
r as (select doc_id, i from g qualify count(*) over (partition by doc_id, a, b, c) > 1),
n as (select doc_id, count(distinct p) as n_repeat_words
      from (select doc_id, unnest([i, i + 1, i + 2]) as p from r) group by doc_id),
m as (select b.*, coalesce(n.n_repeat_words, 0) as n_repeat_words from b left join n using (doc_id)),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and word_chars >= 2.0 * n_words and word_chars <= 20.0 * n_words
       and n_symbols <= 0.25 * n_words and (n_stop_words >= 0.005 * n_words or not has_stop_list)
       and n_dup_lines <= 0.5 * n_lines and n_lines <= 0.5 * n_words as kept
from v
"""
