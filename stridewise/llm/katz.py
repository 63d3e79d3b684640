"""Bigram language model with Katz backoff: Good-Turing discounts, exactly normalised backoff weights.

Texts are cut into blocks of about a million tokens; a block holds its distinct
words once. What travels is compressed arrays: each block sends its distinct words,
then its distinct bigrams, with counts to buckets; buckets add up, keep their part
of the count tables, and answer the blocks with what these asked for. A document is then
scored inside its block, token by token: a bigram that was seen takes its discounted share,
any other backs off to the word's own probability.

Bigrams are dealt by their first word, those of very frequent first words by both;
the few frequent first words have their sums added up over the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, session_conf, stage, trim_memory

#: Which documents are held out, and up to which count Good-Turing discounts.
FOLDS, HELD_FOLD = 7, 2
DISCOUNTED = 5

BLOCK_BYTES = 6 << 20
TOKENS_PER_BUCKET = 1_000_000
HOT_SHARE = 4

#: Stand for the start and the end of a text; no word holds white space.
START_WORD, END_WORD = b" ", b"\n"


def squeeze(values: np.ndarray, rising: bool = False) -> bytes:
    """Compressed bytes of an array, like bytes of the items together; ``rising`` stores differences instead."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(blob: bytes, kind: str, rising: bool = False) -> np.ndarray:
    item = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    values = np.ascontiguousarray(planes.reshape(item, -1).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=values.dtype) if rising else values


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def spread(x: np.ndarray) -> np.ndarray:
    """Scrambled non-negative 63-bit values of 64-bit ids."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) >> np.uint64(1)).astype(np.int64)


# ---------------------------------------------------------------- blocks


def text_blocks(docs: DataFrame) -> DataFrame:
    """``(doc_id, held, text)`` as block rows: documents, their token numbers, distinct word hashes and word codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = 0
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(size // BLOCK_BYTES)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    yield _block_row(batch.slice(a, b - a), (TaskContext.get().partitionId() << 32) + made)
                    made += 1
        trim_memory()

    return docs.mapInArrow(run, "block long, doc_ids array<long>, held array<boolean>, lengths binary, words binary, codes binary, tokens long")


def _block_row(part: pa.RecordBatch, block: int) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part.column(2), "").cast(pa.string())))
    flat, bounds = lists.flatten(), lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    counts = np.diff(before[bounds - bounds[0]])
    coded = flat.filter(pa.array(full)).dictionary_encode()
    spelled = [w.encode() for w in coded.dictionary.to_pylist()]
    hashes, rank = np.unique(np.asarray([word_hash(w) for w in (*spelled, START_WORD, END_WORD)], dtype=np.uint64), return_inverse=True)
    ends = np.cumsum(counts + 2)
    codes = np.empty(int(ends[-1]), dtype=np.int32)
    inner = np.ones(len(codes), dtype=bool)
    inner[ends - 1] = inner[ends - counts - 2] = False
    codes[ends - counts - 2], codes[ends - 1] = rank[-2], rank[-1]
    codes[inner] = rank[coded.indices.to_numpy(zero_copy_only=False)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
            pa.array([part.column(1).to_pylist()], pa.list_(pa.bool_())),
            pa.array([squeeze((counts + 2).astype(np.int32))], pa.binary()), pa.array([squeeze(hashes, rising=True)], pa.binary()),
            pa.array([squeeze(codes)], pa.binary()), pa.array([int(len(codes))], pa.int64()),
        ],
        names=["block", "doc_ids", "held", "lengths", "words", "codes", "tokens"],
    )


def _trained(lengths: np.ndarray, held) -> np.ndarray:
    """Per token of a block whether its document is in the training part."""
    return np.repeat(~np.asarray(held, dtype=bool), lengths)


# ---------------------------------------------------------------- words


def send_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Each block's distinct words with their training counts, dealt to buckets by ranges of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, codes = unsqueeze(row["words"], "u8", rising=True), unsqueeze(row["codes"], "i4")
                trained = _trained(unsqueeze(row["lengths"], "i4"), row["held"])
                counts = np.bincount(codes[trained], minlength=len(words)).astype(np.int32)
                cuts = np.searchsorted(words, [np.uint64(((1 << 64) * i) // buckets) for i in range(1, buckets)]).tolist() if buckets > 1 else []
                parts = [(i, a, b) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(words)], strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _, _ in parts], pa.int64()), pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([squeeze(words[a:b], rising=True) for _, a, b in parts], pa.binary()), pa.array([squeeze(counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    names=["bucket", "block", "words", "counts"],
                )

    return blocks.select("block", "held", "lengths", "words", "codes").mapInArrow(run, "bucket long, block long, words binary, counts binary")


def count_words(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's table of words with their counts (block null), and to each block the ids and counts of its words."""
    parts = [unsqueeze(w, "u8", rising=True) for w in rows["words"]]
    words, place = np.unique(np.concatenate(parts), return_inverse=True)
    sent = np.concatenate([unsqueeze(c, "i4") for c in rows["counts"]])
    total = np.bincount(place, weights=sent, minlength=len(words)).astype(np.int64)
    bucket, at = int(rows["bucket"].iloc[0]), 0
    marks = np.isin(words, np.asarray([word_hash(START_WORD)], dtype=np.uint64))
    real = total[~marks]
    out = [(bucket, None, squeeze(words, rising=True), squeeze(total), int(real.sum()), int((real > 0).sum()), _count_of_counts(real))]
    for block, own in zip(rows["block"], parts, strict=True):
        mine = place[at : at + len(own)]
        at += len(own)
        out.append((bucket, int(block), squeeze(mine.astype(np.int32), rising=True), squeeze(total[mine]), 0, 0, [0] * (DISCOUNTED + 1)))
    frame = pd.DataFrame(out, columns=["bucket", "block", "ids", "counts", "tokens", "kinds", "low"])
    frame["block"] = frame["block"].astype("Int64")
    return frame


WORD_SCHEMA = "bucket long, block long, ids binary, counts binary, tokens long, kinds long, low array<long>"


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.clip(counts, 0, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist()


@dataclass(frozen=True)
class Discounts:
    """Good-Turing factors for counts up to ``DISCOUNTED``; 1 above, and wherever the formula gives nothing usable."""

    factor: tuple[float, ...]

    @staticmethod
    def of(low: list[int]) -> Discounts:
        """From the numbers of items seen once, twice, ... ``DISCOUNTED`` + 1 times."""
        k = DISCOUNTED
        if len(low) <= k or min(low) <= 0:
            return Discounts((1.0,) * k)
        common = (k + 1) * low[k] / low[0]
        found = [((r + 1) * low[r] / (r * low[r - 1]) - common) / (1 - common) if common != 1 else 1.0 for r in range(1, k + 1)]
        return Discounts(tuple(d if 0 < d < 1 else 1.0 for d in found))

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        table = np.asarray([0.0, *self.factor, 1.0])
        return table[np.minimum(counts, len(table) - 1)] * counts


@dataclass(frozen=True)
class WordModel:
    """Probabilities of single words: discounted shares, and what is left for the one unknown word."""

    tokens: int
    kinds: int
    low: tuple[int, ...]
    discounts: Discounts

    @property
    def left(self) -> float:
        return sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.discounts.factor, self.low, strict=False), 1))

    @property
    def whole(self) -> float:
        """The denominator: one more than the tokens where no discount leaves anything."""
        return self.tokens + (0.0 if self.left > 0 else 1.0)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        unknown = (self.left if self.left > 0 else 1.0) / self.whole
        return np.where(counts > 0, self.discounts.shares(counts) / self.whole, unknown)

    def add_one_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.kinds + 1.0))


# ---------------------------------------------------------------- bigrams


@dataclass
class BlockPairs:
    """A block's tokens with global word ids and counts, and its distinct bigrams in the order in which they are sent."""

    codes: np.ndarray
    lengths: np.ndarray
    trained: np.ndarray
    ids: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(row: dict) -> BlockPairs:
        lengths = unsqueeze(row["lengths"], "i4")
        parts = sorted(row["answers"], key=lambda a: a["bucket"])
        ids = np.concatenate([unsqueeze(p["ids"], "i4", rising=True).astype(np.int64) + (p["bucket"] << 32) for p in parts])
        counts = np.concatenate([unsqueeze(p["counts"], "i8") for p in parts])
        return BlockPairs(unsqueeze(row["codes"], "i4"), lengths, _trained(lengths, row["held"]), ids, counts)

    def distinct(self, buckets: int, hot: int):
        """Distinct (first, second) code pairs sorted by bucket and first id; per token which of them ends there (-1 at starts)."""
        first, second = self.codes[:-1].astype(np.int64), self.codes[1:].astype(np.int64)
        starts = np.cumsum(self.lengths)[:-1]
        inner = np.ones(len(first), dtype=bool)
        inner[starts - 1] = False  # from an end to the next start
        size = len(self.ids)
        keys, place = np.unique((first * size + second)[inner], return_inverse=True)
        a, b = keys // size, keys % size
        bucket = spread(self.ids[a]) % buckets
        both = self.counts[a] > hot
        bucket[both] = spread(self.ids[a[both]] * 31 + self.ids[b[both]]) % buckets
        order = np.lexsort((self.ids[b], self.ids[a], bucket))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        ends = np.full(len(self.codes), -1, dtype=np.int64)
        ends[1:][inner] = rank[place]
        trained = np.bincount(rank[place], weights=self.trained[1:][inner], minlength=len(order)).astype(np.int32)
        return a[order], b[order], bucket[order], trained, ends


def _cuts(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """``(value, from, to)`` of the runs of a sorted array."""
    if not len(sorted_values):
        return []
    at = np.concatenate([[0], np.flatnonzero(np.diff(sorted_values)) + 1, [len(sorted_values)]])
    return [(int(sorted_values[a]), int(a), int(b)) for a, b in zip(at[:-1], at[1:], strict=True)]


def send_pairs(blocks: DataFrame, buckets: int, hot: int) -> DataFrame:
    """Each block's distinct bigrams with training counts; first words once a run, with the counts of both words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = BlockPairs.of(row)
                a, b, bucket, trained, _ = block.distinct(buckets, hot)
                rows = []
                for value, lo, hi in _cuts(bucket):
                    runs = _cuts(a[lo:hi])
                    heads = np.asarray([r[0] for r in runs])
                    rows.append((
                        value, row["block"], squeeze(block.ids[heads], rising=True), squeeze(block.counts[heads]),
                        squeeze(np.asarray([r[2] - r[1] for r in runs], dtype=np.int32)),
                        squeeze(block.ids[b[lo:hi]]), squeeze(block.counts[b[lo:hi]]), squeeze(trained[lo:hi]),
                    ))
                kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["bucket", "block", "heads", "head_counts", "runs", "seconds", "second_counts", "trained"],
                )

    return blocks.mapInArrow(
        run, "bucket long, block long, heads binary, head_counts binary, runs binary, seconds binary, second_counts binary, trained binary"
    )


PAIR_SCHEMA = (
    "bucket long, heads binary, head_counts binary, head_of binary, seconds binary, second_counts binary, counts binary, "
    "low array<long>, asked array<struct<block: long, pairs: binary, heads: binary>>"
)


def count_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's bigram table, and which of its rows each block asked for."""
    heads = [unsqueeze(x, "i8", rising=True) for x in rows["heads"]]
    runs = [unsqueeze(x, "i4") for x in rows["runs"]]
    firsts, first_at = np.unique(np.concatenate(heads), return_inverse=True)
    head_counts = np.zeros(len(firsts), dtype=np.int64)
    head_counts[first_at] = np.concatenate([unsqueeze(x, "i8") for x in rows["head_counts"]])
    head_of = np.repeat(first_at, np.concatenate(runs))
    seconds, second_at = np.unique(np.concatenate([unsqueeze(x, "i8") for x in rows["seconds"]]), return_inverse=True)
    second_counts = np.zeros(len(seconds), dtype=np.int64)
    second_counts[second_at] = np.concatenate([unsqueeze(x, "i8") for x in rows["second_counts"]])
    keys, place = np.unique(head_of * len(seconds) + second_at, return_inverse=True)
    sent = np.concatenate([unsqueeze(x, "i4") for x in rows["trained"]])
    total = np.bincount(place, weights=sent, minlength=len(keys)).astype(np.int64)
    asked, p, h = [], 0, 0
    for block, head, run in zip(rows["block"], heads, runs, strict=True):
        n = int(run.sum())
        asked.append({"block": int(block), "pairs": squeeze(place[p : p + n].astype(np.int32), rising=True), "heads": squeeze(first_at[h : h + len(head)].astype(np.int32), rising=True)})
        p, h = p + n, h + len(head)
    second = keys % len(seconds)
    return pd.DataFrame({
        "bucket": [int(rows["bucket"].iloc[0])], "heads": [squeeze(firsts, rising=True)], "head_counts": [squeeze(head_counts)],
        "head_of": [squeeze((keys // len(seconds)).astype(np.int32), rising=True)], "seconds": [squeeze(seconds[second])],
        "second_counts": [squeeze(second_counts[second])], "counts": [squeeze(total)], "low": [_count_of_counts(total)], "asked": [asked],
    })


def backoff(seen_left: np.ndarray, whole: np.ndarray, words_seen: np.ndarray) -> np.ndarray:
    """Backoff weights: the mass that discounts leave of a first word, over the mass of the words not seen after it."""
    left = np.where(seen_left > 0, seen_left / np.maximum(whole, 1.0), 1.0 / (whole + 1.0))
    return left / np.maximum(1.0 - words_seen, 1e-12)


def answer_pairs(table: DataFrame, words: WordModel, discounts: Discounts, hot: int) -> DataFrame:
    """To each block the counts of its bigrams and, per first word, its denominator's excess and backoff weight; sums of hot words apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                heads, whole = unsqueeze(row["heads"], "i8", rising=True), unsqueeze(row["head_counts"], "i8")
                head_of, counts = unsqueeze(row["head_of"], "i4", rising=True), unsqueeze(row["counts"], "i8")
                word = np.where(counts > 0, words.probability(unsqueeze(row["second_counts"], "i8")), 0.0)
                left = np.bincount(head_of, weights=counts - discounts.shares(counts), minlength=len(heads))
                seen = np.bincount(head_of, weights=word, minlength=len(heads))
                weight = backoff(left, whole, seen)
                out = []
                for ask in row["asked"]:
                    at = unsqueeze(ask["heads"], "i4", rising=True)
                    out.append((row["bucket"], ask["block"], squeeze(counts[unsqueeze(ask["pairs"], "i4", rising=True)]), squeeze(weight[at]), squeeze(left[at] > 0), None, None, None, None))
                for i in np.flatnonzero(whole > hot):
                    out.append((row["bucket"], None, None, None, None, int(heads[i]), int(whole[i]), float(left[i]), float(seen[i])))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["bucket", "block", "counts", "weights", "discounted", "head", "whole", "head_left", "head_seen"],
                )

    columns = table.select("bucket", "heads", "head_counts", "head_of", "second_counts", "counts", "asked")
    return columns.mapInArrow(
        run, "bucket long, block long, counts binary, weights binary, discounted binary, head long, whole long, head_left double, head_seen double"
    )


def score_blocks(blocks: DataFrame, words: WordModel, discounts: Discounts, buckets: int, hot: int, hot_words: dict[int, tuple[float, bool]]) -> DataFrame:
    """Scores of the documents of the blocks, which carry the answers to their words and bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = BlockPairs.of(row)
                a, b, bucket, _, ends = block.distinct(buckets, hot)
                seen, weight, discounted = (np.zeros(len(a), dtype=k) for k in (np.int64, np.float64, bool))
                answers = {x["bucket"]: x for x in row["pair_answers"]}
                for value, lo, hi in _cuts(bucket):
                    got = answers[value]
                    seen[lo:hi] = unsqueeze(got["counts"], "i8")
                    run_of = np.concatenate([[0], np.cumsum(np.diff(a[lo:hi]) != 0)])
                    weight[lo:hi] = unsqueeze(got["weights"], "f8")[run_of]
                    discounted[lo:hi] = unsqueeze(got["discounted"], "?")[run_of]
                for i in np.flatnonzero(block.counts[a] > hot):
                    weight[i], discounted[i] = hot_words[int(block.ids[a[i]])]
                whole = block.counts[a]
                word = np.log10(words.probability(block.counts))
                with np.errstate(divide="ignore"):
                    pair = np.log10(discounts.shares(seen) / np.maximum(whole + ~discounted, 1))
                    backed = np.where(whole > 0, np.log10(np.maximum(weight, 1e-300)), 0.0) + word[b]
                token = np.where(seen > 0, pair, backed)
                inside = ends >= 0  # every token but the starts
                scores = np.where(inside, token[np.maximum(ends, 0)], 0.0)
                base = np.where(inside, words.add_one_log(block.counts)[block.codes], 0.0)
                known = inside & (block.counts[block.codes] > 0)
                at = np.concatenate([[0], np.cumsum(block.lengths)[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array((block.lengths - 1).astype(np.int64)),
                        pa.array(np.add.reduceat(known.astype(np.int64), at)), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(scores, at)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return blocks.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def _answered(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Block rows with the array of the buckets' answers to them."""
    own = [c for c in answers.columns if c != "block"]
    grouped = answers.groupBy("block").agg(F.collect_list(F.struct(*own)).alias(name))
    return blocks.join(grouped, "block")


def katz_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", folds: int = FOLDS, held_fold: int = HELD_FOLD) -> DataFrame:
    """Per document held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Learned from the documents whose crc32 of the id modulo ``folds`` is not
    ``held_fold``; a null id counts as an empty string. A null or empty text
    is its end token alone. Repeated rows are learned and answered one by one.
    Without any training token every probability is that of the unknown word; an
    empty table gives an empty table. Other columns are not used.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == held_fold
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held"), F.col(text).cast("string").alias("text"))
    few = {"spark__sql__execution__arrow__maxRecordsPerBatch": "2", "spark__sql__parquet__columnarReaderBatchSize": "8"}
    blocks = stage(text_blocks(rows), "lm-blocks")
    size = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-size // TOKENS_PER_BUCKET))
    with session_conf(spark, **few):
        word_rows = stage(send_words(blocks, buckets).groupBy("bucket").applyInPandas(count_words, WORD_SCHEMA), "lm-words")
        totals = word_rows.where("block is null").agg(
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"),
            *[F.coalesce(F.sum(F.get("low", F.lit(i))), F.lit(0)).alias(f"n{i}") for i in range(DISCOUNTED + 1)],
        ).first()
        low = tuple(totals[f"n{i}"] for i in range(DISCOUNTED + 1))
        words = WordModel(totals["tokens"], totals["kinds"], low, Discounts.of(list(low)))
        hot = max(1, words.tokens // (HOT_SHARE * buckets))
        blocks2 = stage(
            _answered(blocks.drop("words", "tokens"), word_rows.where("block is not null").select("block", "bucket", "ids", "counts"), "answers"), "lm-blocks"
        )
        drop_stage(blocks, word_rows)
        table = stage(send_pairs(blocks2.select("block", "held", "lengths", "codes", "answers"), buckets, hot).groupBy("bucket").applyInPandas(count_pairs, PAIR_SCHEMA), "lm-pairs")
        pair_low = table.agg(*[F.coalesce(F.sum(F.get("low", F.lit(i))), F.lit(0)).alias(f"n{i}") for i in range(DISCOUNTED + 1)]).first()
        discounts = Discounts.of([pair_low[f"n{i}"] for i in range(DISCOUNTED + 1)])
        replies = stage(answer_pairs(table, words, discounts, hot), "lm-replies")
        drop_stage(table)
        # first words above the hot count: fewer than HOT_SHARE * buckets
        sums = replies.where("head is not null").groupBy("head").agg(F.max("whole").alias("whole"), F.sum("head_left").alias("l"), F.sum("head_seen").alias("s")).collect()
        hot_words = {r["head"]: (float(backoff(np.asarray(r["l"]), np.asarray(r["whole"]), np.asarray(r["s"]))), r["l"] > 0) for r in sums}
        joined = _answered(blocks2, replies.where("block is not null").select("block", "bucket", "counts", "weights", "discounted"), "pair_answers")
        scored = stage(score_blocks(joined, words, discounts, buckets, hot, hot_words), "lm-scores")
        drop_stage(blocks2, replies)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def katz_query(spark, sf_dir: str) -> DataFrame:
    return katz_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
