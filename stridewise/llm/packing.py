"""Packing token sequences: overlong documents are cut into full windows, the rest is packed best-fit decreasing.

Texts are tokenized once, in Arrow batches, into thin piece rows. Pieces are
dealt to blocks of a bounded number of rows by a hash, and each block is packed on its
own; the padding that blocks add is at most a few open windows each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, trim_memory, worker_object

#: Tokenizer file, id put after each document, window length.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
WINDOW = 4096

PIECES_PER_BLOCK = 20_000
CACHED_WORDS = 600_000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file as installed on the machine (driver or executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Marks that may end a word. The tokenizer parts a run of them from the letters before it.
TAIL_MARKS = ".,!?;:&*$#%|"

TEXT_BYTES_AT_ONCE = 6 << 20


class WordEncoder:
    """Ids of texts, one encoding a distinct word.

    The tokenizer drops white space and no token spans it, so the ids of a
    text are those of its words one after another. It lower-cases, and parts
    a run of letters from the marks behind it, so the forms of a word share
    one entry; entries are kept, up to ``cached_words``. Words of letters only
    are encoded together as one string, whose ids are parted at word ends.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.cached_words = cached_words
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts as one array, and where each text starts (with the end as last entry)."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        flat, starts = self._ids_of(words.dictionary)
        which = words.indices.to_numpy(zero_copy_only=False)
        counts = np.diff(starts)[which]
        ends = np.cumsum(counts)
        at = np.repeat(starts[which] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
        before = np.concatenate([[0], ends])
        bounds = lists.offsets.to_numpy()
        return flat[at], before[bounds - bounds[0]]

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after another, and where each starts."""
        marks = "[" + "".join("\\" + m for m in TAIL_MARKS) + "]*$"
        core = pc.utf8_rtrim(words, characters=TAIL_MARKS)
        plain = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring(core, "\u0130")))
        core = pc.if_else(plain, pc.ascii_lower(core), words)
        tail = pc.if_else(plain, pc.struct_field(pc.extract_regex(words, f"(?P<t>{marks})"), "t"), "")
        core, tail = core.to_pylist(), tail.to_pylist()
        wanted = {*core, *tail}
        missing = wanted.difference(self.known)
        if missing and len(self.known) > self.cached_words:
            self.known = {"": b""}
            missing = wanted.difference(self.known)
        letters = [w for w, ok in zip(core, plain.to_pylist(), strict=True) if ok and w in missing]
        self._learn(list(dict.fromkeys(letters)), list(missing.difference(letters)))
        known = self.known
        parts = [known[c] + known[t] if t else known[c] for c, t in zip(core, tail, strict=True)]
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))]) // 4
        return np.frombuffer(b"".join(parts), dtype="<u4"), starts

    def _learn(self, letters: list[str], others: list[str]) -> None:
        if letters:
            ids = np.asarray(self.tokenizer.encode(" ".join(letters), add_special_tokens=False).ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) == len(letters):
                raw = ids.tobytes()
                self.known.update(zip(letters, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
            else:
                others = letters + others
        for part, got in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.known[part] = np.asarray(got.ids, dtype="<u4").tobytes()


def text_slices(batch: pa.RecordBatch, column: int, text_bytes: int = TEXT_BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``text_bytes`` bytes of one text column, a row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    part = size // text_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def pieces(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, end_id: int = END_ID,
           cached_words: int = CACHED_WORDS, text_bytes: int = TEXT_BYTES_AT_ONCE) -> DataFrame:
    """One row a piece; every piece but the last of a document has ``window`` ids. A null text is empty: its end id only.

    A Python worker keeps the ids of up to ``cached_words`` words (and those of one batch) between its tasks, and encodes
    ``text_bytes`` of text at once: more of both is more memory, less encoding.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        file = path or tokenizer_path()
        encoder = worker_object(f"encoder {file} {cached_words}", lambda: WordEncoder(file, cached_words))
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, 1, text_bytes):
                rows = []
                ids, starts = encoder.encode(pc.fill_null(part.column(1), ""))
                for key, a, b in zip(part.column(0).to_pylist(), starts, starts[1:], strict=False):
                    own, total = ids[a:b].tobytes() + end, int(b - a) + 1
                    for at in range(0, total, window):
                        crc = zlib.crc32(own[4 * at : 4 * (at + window)])
                        rows.append((key, at, min(window, total - at), crc, total, zlib.crc32(b"%d" % at, crc)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"],
                )
        trim_memory()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, PIECE_SCHEMA)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree of counts over the capacities finds the tightest that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window_no: int) -> None:
        self.windows[capacity].append(window_no)
        self._add(capacity, 1)

    def tightest(self, length: int) -> int | None:
        """Capacity of the tightest open window with room for ``length``."""
        node = self.leaves + length
        count = self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves

    def pop(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece, ``lengths`` given longest first."""
    tree, made = OpenWindows(window), 0
    numbers, offsets = [], []
    for length in lengths:
        capacity = tree.tightest(length)
        if capacity is None:
            capacity, number, made = window, made, made + 1
        else:
            number = tree.pop(capacity)
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            tree.put(capacity - length, number)
    return numbers, offsets


def pack(cut_pieces: DataFrame, window: int = WINDOW, pieces_per_block: int = PIECES_PER_BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to piece rows.

    ``sequence_id`` is the block number times 2^32 plus the number within the
    block. Repeated rows are pieces of their own; an empty table packs to
    an empty table.
    """
    cut_pieces = stage(cut_pieces, "pieces")
    blocks = max(1, -(-cut_pieces.count() // pieces_per_block))

    def pack_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        numbers, offsets = best_fit_decreasing(rows["length"].tolist(), window)
        rows["sequence_id"] = rows["block"].to_numpy() * (1 << 32) + np.asarray(numbers, dtype=np.int64)
        rows["offset"] = np.asarray(offsets, dtype=np.int64)
        return rows.drop(columns=["block"])

    # a hash of id, place and content; copies and repeated ids are spread by the row's own number too
    block = F.pmod(F.xxhash64("doc_id", "start", "salt", F.monotonically_increasing_id()), F.lit(blocks))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return cut_pieces.withColumn("block", block).drop("salt").groupBy("block").applyInPandas(pack_block, out)


def pack_documents(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   cached_words: int = CACHED_WORDS, text_bytes: int = TEXT_BYTES_AT_ONCE) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences (see :func:`pieces`, :func:`pack`)."""
    return pack(pieces(docs, path, text, doc_id, window, cached_words=cached_words, text_bytes=text_bytes), window)


def packing_query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
