"""Phrases whose words stand together more often than chance, from sorted streams of n-gram counts.

Counting goes order by order: an n-gram is counted only where both its
(n-1)-grams reach the least count, as no phrase is more frequent than a part
of it. A pass counts the n-grams of its order by hash, which makes small rows, and
those of the order before by their words, where the hash was frequent; a bitmap of
these hashes (bounded, false positives only cost work) settles that where the texts are
read. Tasks count by word ids and Spark adds up, so every count used is exact.

The counts are then kept as two streams, one sorted by the first words of a
phrase (prefix order) and one by its last words (suffix order). Each way to cut a
phrase in two meets the count of its first part in the one and that of the rest in the other
by sort-merge joins, which walk two sorted streams in lockstep and build no hash table.
The same streams give each phrase its most frequent extensions by a word to
the right (prefix order) and to the left (suffix order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_stage, stage, trim_memory
from .jaccard import hash_bitmap, marked
from .shingles import mix64

#: What parts pieces of a text, and what parts words.
PIECE_ENDS, WORD_ENDS = ".,;:!?\n\x0b\x0c\r", " \t"

#: A byte that UTF-8 never holds: it stands for an end of a piece.
END = b"\xff"
_TABLE = bytes(0xFF if chr(b) in PIECE_ENDS else 0x20 if chr(b) in WORD_ENDS else b for b in range(256))

#: Bytes of text that a task counts at once, bytes of a text split at once, rows given back at once, parts of a language's ranking.
HELD_BYTES, SLICE, GIVEN_ROWS, PARTS = 9 << 20, 1 << 22, 50_000, 64


def plain_words(text: str) -> Iterator[bytes]:
    """The words of a text with a space behind each, an end of a piece as a word of its own; long texts in slices cut between words."""
    body = text.encode("utf-8").lower().translate(_TABLE)
    start = 0
    while start < len(body):
        stop = body.find(b" ", start + SLICE)
        stop = len(body) if stop < 0 else stop
        words = body[start:stop].replace(END, b" \xff ").split()
        if words:
            yield b" ".join(words) + b" "
        start = stop
    yield END + b" "


class Words:
    """Ids of all words of some texts, numbered by Arrow as they come; id 0 is the end of a piece."""

    def __init__(self, parts: list[bytes]) -> None:
        data = b"".join([END + b" ", *parts])
        ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 0x20) + 1
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), dtype=np.uint64, count=len(self.words))

    def phrase(self, row) -> str:
        return b"".join([self.words[i] for i in row])[:-1].decode("utf-8", "replace")


def ngram_groups(ids: np.ndarray, starts: np.ndarray, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, count)``: for each distinct n-gram at ``starts`` one place and the number of places.

    Sorted by hash; where n-grams of one hash differ in a word, all are sorted by their words.
    """
    def same(by: np.ndarray) -> np.ndarray:
        alike = np.ones(len(by) - 1, dtype=bool)
        for j in range(order):
            column = ids[starts[by] + j]
            alike &= column[1:] == column[:-1]
        return alike

    by = np.argsort(hashes, kind="stable")
    alike = same(by)
    if (alike != (hashes[by][1:] == hashes[by][:-1])).any():
        by = np.lexsort([ids[starts + j] for j in range(order)])
        alike = same(by)
    edges = np.flatnonzero(np.concatenate([[True], ~alike]))
    return by[edges], np.diff(np.concatenate([edges, [len(by)]]))


def _count_held(words: Words, lang: str, order: int, most: int, frequent) -> Iterator[pa.RecordBatch]:
    """The texts held of one language, in the pass of an order: see :func:`ngram_pass`."""
    ids, word_hashes = words.ids, words.hashes
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8")))
    with np.errstate(over="ignore"):
        if order <= 2:  # words by their ids, without a sort
            of_word = mix64(word_hashes + seed)
            counts = np.bincount(ids, minlength=len(word_hashes))
            counts[0] = 0
            present = np.flatnonzero(counts)
        if order == 1:
            yield _rows(lang, [None], np.zeros(1, dtype=np.int64), np.array([counts.sum()]))
            yield from _hash_rows(of_word[present], counts[present])
            return
        shorter = order - 1
        ends = np.concatenate([[0], np.cumsum(ids == 0)])
        if len(ids) < shorter:
            return
        hashes = word_hashes[ids]
        rolled = mix64(hashes + seed)
        for j in range(1, shorter):
            rolled = mix64(rolled[:-1] * np.uint64(3) + hashes[j:])
        ok = marked(frequent, rolled) & (ends[shorter:] == ends[:-shorter])
        if order == 2:
            often = present[marked(frequent, of_word[present])]
            yield from _phrase_rows(lang, words, [often], of_word[often], counts[often])
        else:
            starts = np.flatnonzero(ok)
            if len(starts):
                first, found = ngram_groups(ids, starts, shorter, rolled[starts])
                yield from _phrase_rows(lang, words, [ids[starts[first] + j] for j in range(shorter)], rolled[starts[first]], found)
        if order <= most:
            starts = np.flatnonzero(ok[:-1] & ok[1:] & (ends[order:] == ends[:-order])) if len(ids) >= order else np.empty(0, dtype=np.int64)
            if len(starts):
                yield from _hash_rows(*np.unique(mix64(rolled[starts] * np.uint64(3) + hashes[starts + shorter]), return_counts=True))


def _phrase_rows(lang: str, words: Words, columns: list[np.ndarray], hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts), GIVEN_ROWS):
        part = slice(at, at + GIVEN_ROWS)
        phrases = [words.phrase(row) for row in zip(*[c[part].tolist() for c in columns])]
        yield _rows(lang, phrases, hashes[part].view(np.int64), counts[part])


def _hash_rows(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts), GIVEN_ROWS):
        part = slice(at, at + GIVEN_ROWS)
        yield _rows(None, [None] * len(counts[part]), hashes[part].view(np.int64), counts[part])


def _rows(lang: str | None, phrases: list, hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())],
        names=["lang", "phrase", "hash", "f"],
    )


def ngram_pass(texts: DataFrame, order: int, most: int, least: int, frequent=None) -> DataFrame:
    """Counts ``(lang, phrase, hash, f)`` of one pass over ``texts (lang, text)``, those of ``least`` or more.

    Without language: counts of n-grams of this order (up to ``most``) by hash, whose both (n-1)-grams are in ``frequent``,
    the broadcast bitmap of the pass before. With language and phrase: exact counts of the (n-1)-grams in that bitmap. Equal hashes of
    different n-grams only let through phrases whose own count then decides. Order 1 also gives a row a language with
    neither phrase nor hash: the number of all its words, whatever it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def count() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                yield from _count_held(Words(parts), lang, order, most, None if frequent is None else frequent.value)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                parts = list(plain_words(text.as_py()))
                held.setdefault(lang.as_py(), []).extend(parts)
                size += sum(map(len, parts))
                if size >= HELD_BYTES:
                    yield from count()
                    held, size = {}, 0
        yield from count()
        held.clear()
        trim_memory()

    parts = texts.select("lang", "text").mapInArrow(run, "lang string, phrase string, hash long, f long")
    added = parts.groupBy("lang", "phrase", "hash").agg(F.sum("f").alias("f"))
    total = F.col("lang").isNotNull() & F.col("phrase").isNull()
    return added.where((total & (F.col("f") > 0)) | (F.col("f") >= least))


def frequent_phrases(texts: DataFrame, most_words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts ``(lang, words, phrase, f)`` of the phrases of 1 to ``most_words`` words found often enough, and ``(lang, n)``."""
    sc = texts.sparkSession.sparkContext
    passes, frequent = [], None
    for order in range(1, most_words + 2):
        passes.append(stage(ngram_pass(texts, order, most_words, least, frequent), f"ngrams-{order}"))
        if frequent is not None:
            frequent.destroy()
        if order <= most_words:
            frequent = sc.broadcast(hash_bitmap(passes[-1].where("lang is null"), "hash"))
    totals = passes[0].where("lang is not null").select("lang", F.col("f").alias("n"))
    counts = passes[1].where("phrase is not null")
    for more in passes[2:]:
        counts = counts.unionByName(more.where("phrase is not null"))
    return counts.select("lang", F.split("phrase", " ").alias("words"), "phrase", "f"), totals


def _joined(words) -> F.Column:
    return F.array_join(words, " ")


def cut_counts(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, k, l, r)`` for each way to cut each phrase of two words or more.

    Two merge joins: the cuts in the order of their first parts walk along the
    count stream in prefix order, then in the order of their rests along that in suffix order.
    """
    words = F.col("words")
    stream = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = (
        counts.where(F.size("words") >= 2)
        .select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", _joined(F.slice(words, F.lit(1), F.col("k"))).alias("head"),
                _joined(F.slice(words, F.col("k") + 1, F.size(words) - F.col("k"))).alias("rest"))
    )
    left = cuts.hint("merge").join(stream.withColumnsRenamed({"part": "head", "part_f": "l"}), ["lang", "head"]).drop("head")
    return left.hint("merge").join(stream.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"]).drop("rest")


def extension_counts(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, extended)``: the count of the most frequent extension of a phrase by one word, to either side.

    No longer extension is more frequent than the one-word extension inside it, so these decide for all.
    """
    words = F.col("words")
    longer = counts.where(F.size("words") >= 3)
    heads = longer.select("lang", _joined(F.slice(words, F.lit(1), F.size(words) - 1)).alias("phrase"), "f")
    tails = longer.select("lang", _joined(F.slice(words, F.lit(2), F.size(words) - 1)).alias("phrase"), "f")
    return heads.unionByName(tails).groupBy("lang", "phrase").agg(F.max("f").alias("extended"))


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 5, least: int = 100,
                 covered_percent: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are lower-cased (A-Z) runs without blanks inside pieces between
    ``. , ; : ! ?`` and line breaks. Candidates have 2 to ``most_words`` words and
    ``least`` occurrences or more; the score ``floor(1000 a n / (l r))`` is that of the
    lowest-scoring cut (ties: the fewest first words). A phrase goes if one extension holds
    ``covered_percent`` (100 at most) of its occurrences. Ranked by score, count and phrase (bytes).

    Null languages are ``und``; null, empty and blank texts hold no phrase, a
    document counts as often as it is repeated, ties are settled by the phrase, other
    columns are ignored, an empty table gives no row. Numbers are exact up to 38 digits.
    """
    if not 0 < covered_percent <= 100:
        raise ValueError("covered_percent must lie in 1 to 100")
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")).where("text is not null and text <> ''")
    counts, totals = frequent_phrases(texts, most_words, least)
    n = F.col("n")
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r", "n")}
    # the languages' totals are merged in as well, whatever their number; a language is dealt over several parts
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    dealt = totals.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    scored = cut_counts(counts).withColumn("part", part).hint("merge").join(dealt, ["lang", "part"]).select(
        "lang", "phrase", "a", "k", "l", "r", n, *[v.alias(f"_{c}") for c, v in exact.items()]
    ).withColumn("score", F.expr("cast(cast(1000 as decimal(38,0)) * _a * _n div (_l * _r) as long)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = (
        lowest.hint("merge").join(extension_counts(counts), ["lang", "phrase"], "left")
        .where(F.col("extended").isNull() | (F.lit(100) * F.col("extended") < F.lit(covered_percent) * F.col("a")))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    # a language is ranked in parts first, so that no task sorts all its phrases
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = (
        kept.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        .where(F.col("_place") <= top).drop("_part", "_place")
    )
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet")), "phrases")


ORACLE = r"""
with t as (
  select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents where text is not null),
p as (select lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) as piece from t),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from p),
g as (
  select lang, k as len, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i : i + k - 1], ' '))) as phrase
  from w, range(1, 6) as r(k) where len(words) >= k),
c as (select lang, len, phrase, count(*) as f from g group by all),
n as (select lang, cast(sum(f) as bigint) as n from c where len = 1 group by lang),
often as (select lang, len, phrase, f, string_split(phrase, ' ') as words from c where f >= 100),
cand as (select * from often where len >= 2),
cuts as (
  select lang, phrase, f as a, k, array_to_string(words[1 : k], ' ') as head, array_to_string(words[k + 1 : len], ' ') as rest
  from cand, range(1, 5) as r(k) where k < len),
scored as (
  select cuts.lang, cuts.phrase, a, k, x.f as l, y.f as r, n,
    cast((cast(1000 as hugeint) * a * n) // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts join often x on x.lang = cuts.lang and x.phrase = head join often y on y.lang = cuts.lang and y.phrase = rest
    join n on n.lang = cuts.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select distinct cand.lang, array_to_string(cand.words[i : i + m - 1], ' ') as phrase, cand.f
  from cand, range(2, 5) as a(m), range(1, 5) as b(i) where m < cand.len and i + m - 1 <= cand.len),
kept as (
  select * from lowest where not exists (
    select 1 from inside where inside.lang = lowest.lang and inside.phrase = lowest.phrase and 100 * inside.f >= 100 * lowest.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""
