"""Encoding with a merge-type (BPE) SentencePiece model by backtracking, and decoding.

A merge-type encoding is the one sequence of pieces of which every two
neighbours are compatible: merging their joined text anew gives back the same
two pieces. So no merge queue over the whole text is needed. At each position
the encoder takes the longest piece that an Aho-Corasick automaton over the
vocabulary found there, then ever shorter ones, until it is compatible with the
piece before; where none is, the position is marked as failed in a bit field,
the last piece is taken back and shortened. Every position fails at most once.

Pieces with a space behind another character do not exist in such vocabularies
(it is checked), so texts are cut before each run of spaces, and around line
breaks where no piece holds one. A worker encodes each cut, mostly a word, once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import session_conf, worker_object

#: Fixed value: the character that stands for a space inside pieces.
SPACE = "▁"

#: Encoded cuts that a worker keeps in each of two generations, compatible pairs, and the longest cut that it keeps (characters).
KEEP_CUTS, KEEP_PAIRS, KEEP_LENGTH = 300_000, 1_000_000, 64

#: Positions whose matches are held at once while a long cut is encoded.
WINDOW = 1 << 14


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def merge(text: str, score: dict[str, float]) -> list[str]:
    """The defining procedure: join the neighbours whose joined piece scores highest, the leftmost first, until none is left."""
    parts = list(text)
    while len(parts) > 1:
        best, place = None, -1
        for i in range(len(parts) - 1):
            value = score.get(parts[i] + parts[i + 1])
            if value is not None and (best is None or value > best):
                best, place = value, i
        if best is None:
            break
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
    return parts


class PieceEncoder:
    """Encoder and decoder of one model file."""

    def __init__(self, model: str) -> None:
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib = self.library
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(lib.get_piece_size()):
            if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i) or lib.is_unused(i)):
                piece = lib.id_to_piece(i)
                self.score[piece], self.ids[piece] = lib.get_score(i), i
        if lib.is_unknown(self.byte_ids[0]) or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("not a merge-type model with byte fallback whose pieces hold spaces in front only")
        if lib.encode("a b  c") != self._library_form("a b  c"):
            raise ValueError("the model changes texts otherwise than by a space in front")
        # pieces that merging itself never yields can stand in no encoding
        self.automaton = ahocorasick.Automaton()
        self.longest = 1
        for piece, i in self.ids.items():
            if len(piece) == 1 or merge(piece, self.score) == [piece]:
                self.automaton.add_word(piece, (len(piece), i, piece))
                self.longest = max(self.longest, len(piece))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cuts: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}  # the generation before: what is met again moves back
        # line breaks and the like stand in no piece: texts are cut around them too
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        self.cutter = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|[{alone}]+" if alone else ""))

    def _library_form(self, text: str) -> list[int]:
        return [self.ids[p] for p in merge(SPACE + text.replace(" ", SPACE), self.score)]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the joined text of two pieces anew gives these two."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEEP_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = merge(left + right, self.score) == [left, right]
        return known

    def _found(self, text: str, starts: int) -> list[list[tuple]]:
        """For each of the first ``starts`` positions the pieces that start there, shortest first."""
        found: list[list[tuple]] = [[] for _ in range(starts)]
        for end, match in self.automaton.iter(text):
            start = end - match[0] + 1
            if start < starts:
                found[start].append(match)
        return found

    def encode_cut(self, text: str) -> list[int]:
        """Ids of a text without change of its characters (spaces already replaced)."""
        size = len(text)
        matches = self._found(text, size) if size <= WINDOW else _Windows(self, text)
        failed = bytearray(size // 8 + 1)
        taken: list[tuple[int, int, str]] = []  # id or -1 for a character without piece, place among the options, piece
        position, place = 0, None
        last = None  # the piece before the position, if one can merge with it
        while position < size:
            options = matches[position]
            if not options:  # a character without a piece: no merge reaches over it
                taken.append((-1, -1, text[position]))
                position += 1
                place = last = None
                continue
            if place is None:
                place = len(options) - 1
            while place >= 0:
                length, i, piece = options[place]
                end = position + length
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or self.compatible(last, piece)):
                    break
                place -= 1
            if place >= 0:
                taken.append((i, place, piece))
                position, place, last = end, None, piece
            else:
                if last is None:
                    raise RuntimeError("no encoding found")
                failed[position >> 3] |= 1 << (position & 7)
                _, place, piece = taken.pop()
                position -= len(piece)
                place -= 1  # below 0, where the piece taken back was the shortest: its position fails next
                last = taken[-1][2] if taken and taken[-1][0] >= 0 else None
        if all(i >= 0 for i, _, _ in taken):
            return [i for i, _, _ in taken]
        ids: list[int] = []
        for i, _, piece in taken:
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text as the library gives them, without begin and end."""
        if not text:
            return []
        ids: list[int] = []
        cuts, extend = self.cuts, ids.extend
        for cut in self.cutter.findall(SPACE + text.replace(" ", SPACE)):
            known = cuts.get(cut)
            if known is None:
                known = self.older.get(cut)
                if known is None:
                    known = self.encode_cut(cut)
                if len(cut) <= KEEP_LENGTH:
                    if len(cuts) >= KEEP_CUTS:
                        self.older, self.cuts = cuts, {}
                        cuts = self.cuts
                    cuts[cut] = known
            extend(known)
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


class _Windows:
    """Matches of a long text by position, found window by window; three windows are held."""

    def __init__(self, coder: PieceEncoder, text: str) -> None:
        self.coder, self.text, self.held = coder, text, {}

    def __getitem__(self, position: int) -> list[tuple]:
        w, place = divmod(position, WINDOW)
        found = self.held.get(w)
        if found is None:
            begin = w * WINDOW
            stop = min(begin + WINDOW, len(self.text))
            if len(self.held) >= 3:
                self.held.pop(next(iter(self.held)))
            found = self.held[w] = self.coder._found(self.text[begin : stop + self.coder.longest - 1], stop - begin)
        return found[place]


def encode_pieces(docs: DataFrame, text: str = "text", ids: str = "piece_ids", decoded: str | None = None, model: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text (``array<int>``) and, if named, the text decoded from them.

    Null and empty texts give an empty array and an empty text. All other
    columns pass through; a column that has one of the new names already is
    replaced. Rows are independent (ties and repeated rows stay), there is no
    shuffle, and a long text is encoded with matches of :data:`WINDOW` positions held at a time.
    """
    import pyarrow as pa

    model = model or default_model()
    new = [ids] + ([decoded] if decoded else [])
    kept = [c for c in docs.columns if c not in new]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_piece_text"))
    schema = T.StructType([
        *[docs.schema[c] for c in kept], T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
        *([T.StructField(decoded, T.StringType(), False)] if decoded else []),
    ])

    def encode(batches):
        coder = worker_object(f"pieces:{model}", lambda: PieceEncoder(model))
        for batch in batches:
            flat, ends, back = [], [0], []
            for t in batch.column("_piece_text"):
                found = coder.encode(t.as_py())
                flat.append(pa.array(found, pa.int32()))
                ends.append(ends[-1] + len(found))
                if decoded:
                    back.append(coder.decode(found))
            columns = [batch.column(c) for c in kept]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(flat) if flat else pa.array([], pa.int32())))
            if decoded:
                columns.append(pa.array(back, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=kept + new)

    return source.mapInArrow(encode, schema)


def decode_pieces(table: DataFrame, ids: str = "piece_ids", text: str = "text", model: str | None = None) -> DataFrame:
    """``table`` with the text that its ids stand for (null ids: empty text); a column of that name is replaced."""
    import pyarrow as pa

    model = model or default_model()
    kept = [c for c in table.columns if c != text]
    schema = T.StructType([*[table.schema[c] for c in kept], T.StructField(text, T.StringType(), False)])

    def decode(batches):
        coder = worker_object(f"pieces:{model}", lambda: PieceEncoder(model))
        for batch in batches:
            back = pa.array([coder.decode([i for i in x.as_py() or [] if i is not None]) for x in batch.column(ids)], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], back], names=[*kept, text])

    return table.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(decode, schema)


def pieces_query(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Contract of op12: number and digest of the ids of every text, and the digest of the text decoded from them."""
    from .common import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_pieces(docs, decoded="_decoded", model=model)
    out = coded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
    return stage(out, "pieces")
