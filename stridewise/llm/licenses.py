"""Licence scans with a positional index of rare words.

Each template is indexed by its words that are rarest in the corpus, with
their positions. A document looks up every index word it holds, for the
templates whose mandatory phrases it holds; postings that agree on the relative
position give places, at which the template's words are compared one by one and
its mandatory phrases are checked. The index words are enough for every place
that matches. All of it is one projection over the scan, besides the word
statistics.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, computed_once

#: What parts words after lower-casing A-Z, and the base phrases with their labels.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


#: Customary licence notices, with phrases that must stand in the matched place.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("free of charge", "without restriction"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2", "except in compliance"),
    ),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template(
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("source and binary forms", "following conditions"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)

#: Words a template is indexed by at least, postings that must agree, share of words that must match.
INDEX_WORDS = 8
AGREEING = 2
LEAST_MATCH = 0.75


def license_words(text: str) -> Column:
    """Words of a text as an array; null and empty texts give an empty one."""
    parts = F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BREAKS, -1)
    return F.filter(parts, lambda x: x != "")


def word_statistics(worded: DataFrame, words: str, templates=TEMPLATES) -> dict[str, float]:
    """IDF over all documents of every word of the templates (a bounded list)."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    found = worded.select(F.explode(F.array_union(F.array(F.lit("")), F.array_intersect(words, _strings(vocabulary)))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}


def positional_index(idf: dict[str, float], templates=TEMPLATES, most: int = INDEX_WORDS) -> dict[str, list[tuple[int, int]]]:
    """Word -> (template, position) for each template's ``most`` rarest words.

    A long template gets more: as many as may be missing from a match, and ``AGREEING`` besides.
    """
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        words = template.text.split()
        missing = len(words) - math.ceil(LEAST_MATCH * len(words))
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[: max(most, missing + AGREEING)]
        for q, w in enumerate(words):
            if w in rare:
                index.setdefault(w, []).append((t, q))
    return index


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _phrase_starts(words: str, phrase: str) -> Column:
    parts = phrase.split()

    def here(x: Column, i: Column) -> Column:
        ok = x == parts[0]
        for j, p in enumerate(parts[1:], 1):
            ok = ok & (F.coalesce(F.get(words, i + j), F.lit("")) == p)
        return ok

    marked = F.transform(words, lambda x, i: F.when(here(x, i), i))
    return F.filter(marked, lambda i: i.isNotNull())


def license_scan(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``score`` is the largest share of a template's words that stand in place,
    over the templates found; 0 without one. Null and empty texts have no
    words, no labels and score 0; repeated rows are answered alike; own
    columns that clash are replaced; an empty table gives an empty table.
    """
    worded = docs.withColumn("_w", license_words(text))
    idf = word_statistics(worded.select("_w"), "_w", templates)
    index = positional_index(idf, templates)
    postings = F.create_map(*[
        x for w, places in index.items()
        for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(q).alias("q")) for t, q in places]))
    ])
    texts = F.array(*[_strings(t.text.split()) for t in templates])
    names = _strings([t.label for t in templates])
    phrases = F.array(*[_strings([f" {p} " for p in t.phrases]) for t in templates])

    cue = "|".join([p.split()[-1] for p, _ in BASE_PHRASES[:1]] + [BREAKS.join(p.split()) for p, _ in BASE_PHRASES if not p.endswith("license")])
    may_have = ascii_lower(F.coalesce(F.col(text), F.lit(""))).rlike(cue)
    out = worded.withColumn("n_words", F.size("_w").cast("long"))
    out = out.withColumn("_starts", F.when(may_have, F.array(*[_phrase_starts("_w", p) for p, _ in BASE_PHRASES])))
    out = (
        out.withColumn("_all", F.flatten("_starts"))
        .withColumn("n_base", F.coalesce(F.size("_all"), F.lit(0)).cast("long"))
        .withColumn("n_base", F.greatest(F.col("n_base"), F.lit(0)))
        .withColumn("first_word", F.array_min("_all").cast("long"))
        .withColumn("last_word", F.array_max("_all").cast("long"))
        .withColumn(
            "_base",
            F.coalesce(
                F.array_compact(F.array(*[F.when(F.size(F.get("_starts", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE_PHRASES)])),
                F.array().cast("array<string>"),
            ),
        )
    )
    # a place holds its template's phrases, so the text does: the other templates need no lookups
    joined = F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))
    out = out.withColumn("_text", joined).withColumn(
        "_can",
        F.array_compact(F.array(*[
            F.when(reduce(and_, [F.contains("_text", F.lit(f" {p} ")) for p in t.phrases], F.lit(True)), F.lit(i)) for i, t in enumerate(templates)
        ])),
    )
    at = F.filter(F.transform("_w", lambda x, i: F.when(x.isin(*index), F.struct(x.alias("x"), i.alias("i")))), lambda e: e.isNotNull())
    hits = F.flatten(
        F.transform(
            at,
            lambda e: F.transform(
                F.filter(F.element_at(postings, e["x"]), lambda p: F.array_contains("_can", p["t"])),
                lambda p: F.struct(p["t"].alias("t"), (e["i"] - p["q"]).alias("o")),
            ),
        )
    )
    out = out.withColumn("_hits", F.when(F.size("_can") > 0, F.sort_array(hits)))
    out = out.withColumn(
        "_places",
        F.filter("_hits", lambda x, i: (F.get("_hits", i + (AGREEING - 1)) == x) & ~F.get("_hits", i - 1).eqNullSafe(x)),
    )

    def judged(place: Column) -> Column:
        words = F.get(texts, place["t"])
        matched = F.size(F.filter(F.transform(words, lambda y, j: F.get("_w", place["o"] + j).eqNullSafe(y)), lambda ok: ok))
        span = F.concat(F.lit(" "), F.array_join(F.slice(F.col("_w"), F.greatest(place["o"], F.lit(0)) + 1, F.size(words)), " "), F.lit(" "))
        found = F.forall(F.get(phrases, place["t"]), lambda p: F.contains(span, p))
        return F.struct(F.get(names, place["t"]).alias("label"), (matched / F.size(words)).alias("share"), found.alias("found"))

    out = out.withColumn("_judged", F.filter(F.transform("_places", judged), lambda x: x["found"] & (x["share"] >= LEAST_MATCH)))
    both = F.concat("_base", F.coalesce(F.transform("_judged", lambda x: x["label"]), F.array().cast("array<string>")))
    answered = (
        out.withColumn("base_labels", F.array_join(F.sort_array("_base"), ","))
        .withColumn("labels", F.array_join(F.sort_array(F.array_distinct(both)), ","))
        .withColumn("score", F.coalesce(F.array_max(F.transform("_judged", lambda x: x["share"])), F.lit(0.0)))
        .drop("_w", "_starts", "_all", "_base", "_text", "_can", "_hits", "_places", "_judged")
    )
    return computed_once(answered, ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def plain_scan(text: str | None, idf: dict[str, float], templates=TEMPLATES) -> tuple:
    """The same answer for one text in plain Python, for tests: (n_words, n_base, first, last, base_labels, labels, score)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    starts, base = [], set()
    for phrase, label in BASE_PHRASES:
        p = phrase.split()
        got = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += got
        if got:
            base.add(label)
    index = positional_index(idf, templates)
    labels, score = set(base), 0.0
    agree: dict[tuple[int, int], int] = {}
    for i, w in enumerate(words):
        for t, q in index.get(w, ()):
            agree[t, i - q] = agree.get((t, i - q), 0) + 1
    for (t, o), n in agree.items():
        own = templates[t].text.split()
        share = sum(0 <= o + j < len(words) and words[o + j] == y for j, y in enumerate(own)) / len(own)
        span = " " + " ".join(words[max(o, 0) : max(o, 0) + len(own)]) + " "
        if n >= AGREEING and share >= LEAST_MATCH and all(f" {p} " in span for p in templates[t].phrases):
            labels.add(templates[t].label)
            score = max(score, share)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def license_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _oracle() -> str:
    """DuckDB SQL of :func:`license_query`: every template word joined with every equal word, places by their difference, no index."""
    values = ", ".join(f"({t}, '{x.label}', {len(x.text.split())}, [{', '.join(repr(f' {p} ') for p in x.phrases)}])" for t, x in enumerate(TEMPLATES))
    words = ", ".join(f"({t}, {q}, '{w}')" for t, x in enumerate(TEMPLATES) for q, w in enumerate(x.text.split()))
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, w, p, '{label}' AS label FROM placed WHERE " + " AND ".join(f"w[p + {j + 1}] = '{x}'" for j, x in enumerate(phrase.split()))
        for phrase, label in BASE_PHRASES
    )
    return rf"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), placed AS (
  SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM worded
), based AS (
  {phrases}
), base AS (
  SELECT doc_id, count(*) AS n, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM based GROUP BY doc_id
), templates(t, label, size, phrases) AS (VALUES {values}
), template_words(t, q, x) AS (VALUES {words}
), places AS (
  SELECT doc_id, t, p - q AS o, count(*) AS n FROM (SELECT doc_id, p, w[p + 1] AS x FROM placed) JOIN template_words USING (x) GROUP BY ALL
), spans AS (
  SELECT doc_id, label, n / size AS share, phrases, ' ' || array_to_string(list_slice(w, greatest(o, 0) + 1, greatest(o, 0) + size), ' ') || ' ' AS span
  FROM places JOIN templates USING (t) JOIN worded USING (doc_id) WHERE n >= {LEAST_MATCH} * size
), found AS (
  SELECT doc_id, label, share FROM spans WHERE len(list_filter(phrases, lambda y: NOT contains(span, y))) = 0
), named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT doc_id, label, share FROM found UNION ALL SELECT doc_id, label, 0 FROM based) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(m.labels, '') AS labels, coalesce(m.score, 0)::DOUBLE AS score
FROM worded d LEFT JOIN base b USING (doc_id) LEFT JOIN named m USING (doc_id)
"""


ORACLE = _oracle()
