"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field is trained on a small labelled table (``LABELLED``). A word without
a digit or an ``@`` can only be labelled outside, so a text falls apart, without
loss, into runs of the other words; these are decoded by Viterbi in numpy
batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: The kinds in order of output, and the patterns of the base spans (see :func:`base_spans`).
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A span in code points, end exclusive.
Span = tuple[str, int, int]

#: The training table: texts with ``[kind text]`` around personal data. Numbers, names and hosts are invented.
LABELLED = (
    "call me on [phone +1 (212) 555-0148] after nine",
    "tel [phone +1 (646) 555-0191]",
    "her number is [phone +1 (303) 555-0117] [card 4000123412341234] thanks",
    "reach us [phone +1 (415) 555-0133] [card 4556737586899855] or later",
    "paid with [card 4716108999716531] and left [phone +1 (720) 555-0102] as contact",
    "[phone +1 (907) 555-0165] [phone +1 (808) 555-0121] both work",
    "mobile [phone +49 170 5550123] office [phone +49 30 5550199]",
    "fax [phone +33 1 99 00 12 34] please",
    "appelez le [phone +33 6 39 98 12 34] demain",
    "ruf [phone 030 5550176] an",
    "phone [phone (212) 555-0144] or mail",
    "phone [phone 212-555-0156] today",
    "dial [phone 1-800-555-0199] now",
    "llame al [phone +34 600 555 012] hoy",
    "[phone +44 20 7946 0123] is the desk",
    "or [phone +1-202-555-0143] instead",
    "text [phone +12025550178] for help",
    "two lines [phone +1 (312) 555-0110] and [phone +1 (312) 555-0111]",
    "card [card 5105 1051 0510 5100] was charged",
    "visa [card 4012-8888-8888-1881] expired",
    "amex [card 3782 822463 10005] on file",
    "the card [card 371449635398431] was used",
    "number [card 6011000990139424] belongs to the shop",
    "carte [card 4970100000000154] refusée",
    "karte [card 5555555555554444] gesperrt",
    "tarjeta [card 4444333322221111] vencida",
    "[card 4929123456781234] [card 4539123456781234] are both listed",
    "charge [card 4485275742308327] then call [phone +1 (617) 555-0177]",
    "from [ip 192.0.2.14] and [ip 198.51.100.7]",
    "host [ip 203.0.113.99] answered",
    "ping [ip 10.0.0.12] failed",
    "server at [ip 2001:db8::8a2e:370:7334] is down",
    "address [ip 2001:db8:0:1::5] was seen",
    "[ip fe80::1ff:fe23:4567:890a] is local",
    "login from [ip 172.16.254.1] by [email jo.doe@mail.example.org]",
    "write to [email anna.m@example.net] soon",
    "mail [email kk.42@mail4.example.com] today",
    "contact [email root@localhost] please",
    "ask [email admin@intranet] about it",
    "[email müller@beispiel.example] antwortet",
    "escribe a [email info@correo.example.es] ya",
    "user [email x_y+tag@sub.example.co] replied [ip 198.51.100.23]",
    "[email a.b@mail1.example.com] [phone +1 (503) 555-0160] [card 4024007198964305] all leaked",
    "[ip 203.0.113.5] [card 4532015112830366] [phone +1 (213) 555-0127]",
    "in 1998 there were 12 of them",
    "chapter 3 verse 16 and page 214",
    "version 2.0 of the text and 4.0 later",
    "licensed under version 3 and 2.0",
    "it cost 1,250.00 or 19.99 each",
    "on 12.03.2021 at 14:30 we met",
    "from 2019-05-07 to 2020-11-30",
    "room 101 and 202 and 303",
    "the 2 of 3 and the 4th of 5th",
    "about 300000 people and 4500 cars",
    "a total of 1234567 rows in 12 files",
    "order 20210314 and ref 99812",
    "id 7602ad27cf5550de1c is a key",
    "password=f2f5acd241f026fd29 was shown",
    "token c1f6c02f845bf3028d99 expired",
    "ratio 3:2 and 10:1 at 16:9",
    "release 1.2.3 follows 1.2.2",
    "see 4.1.2 and 10.4.1 below",
    "score 21-15 and 7-5 in 2004",
    "isbn 978-3-16-148410-0 in stock",
    "between 100 and 200 or 1000 and 2000",
    "numbers 1 2 3 4 5 6 7 8 9 10 11 12",
    "values 17 23 42 99 108 256 1024 65536",
    "row 0.25 0.50 0.75 1.00 total 2.50",
    "a1 b2 c3 d4 and x9",
    "h2o and co2 and 3d",
    "50% of 80% is 40%",
    "5.5.5 and 1.1 are sections",
    "the year 2024 and the years 1990-1995",
    "@ home or @ work",
    "follow @someone and @other on the net",
    "100 200 300 400 500 600 700",
    "2001 2002 2003 2004 2005 2006",
    "12 34 56 78 90 12 34",
    "42. The next. 43. The last.",
    "zip 90210 or 10115 or 75001",
    "weights 12.5 kg and 130.25 kg",
    "lot 000123 of 000456",
    "code 8f14e45fceea167a5a36dedd4bea2543",
    "#1 and #22 and no. 333",
    "$5 and $1000 and 20€",
)

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FEATURE_BITS = 12
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"\[(email|ip|card|phone) ([^\]]+)\]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Fixed-pattern spans by kind, then start. A match that fails its check is dropped without another try."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------- features


def word_shape(word: str) -> str:
    """Digits to d, letters to a or A, runs of four or more shortened; marks stay."""
    kinds = "".join("d" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:64])
    return re.sub(r"(.)\1{3,}", lambda m: m[1] * 4, kinds)


def word_marks(word: str) -> tuple[str, ...]:
    """Shape, length classes and tell-tale marks of one word."""
    n = sum("0" <= c <= "9" for c in word)
    core = word.strip(".,;:!?\"'")
    out = ["s=" + word_shape(core), "n=%d" % (n if n < 5 else 6 if n < 7 else 8 if n < 9 else 11 if n < 12 else 12 if n < 13 else 19 if n < 20 else 99)]
    out += ["has" + c for c in "@+().:-/%=," if c in core]
    out += [f"dots={min(core.count('.'), 4)}", f"colons={min(core.count(':'), 3)}"]
    if core.isdigit():
        out.append("only")
    if any(c.isalpha() for c in core):
        out.append("letters")
    return tuple(out)


def _place(feature: str) -> int:
    import zlib

    return zlib.crc32(feature.encode()) & ((1 << FEATURE_BITS) - 1)


class Features(dict):
    """Hashed features by (word before, word, word after), '' at the ends; the latest are kept."""

    MOST = 50_000

    def __missing__(self, key: tuple[str, str, str]) -> tuple[int, ...]:
        if len(self) >= self.MOST:
            self.clear()
        value = self[key] = word_features(*key)
        return value


def word_features(before: str, word: str, after: str) -> tuple[int, ...]:
    """Hashed features of a word between its neighbours ('' at the ends)."""
    names = [*word_marks(word), "bias"]
    for tag, near in (("p:", before), ("f:", after)):
        names += [tag + m for m in (word_marks(near) if may_be_personal(near) else ("plain" if near else "none",))]
    cue = before.lower().strip(".,;:!?\"'")
    names.append("cue=" + (cue if cue in CUES else ""))
    return tuple(sorted({_place(f) for f in names}))


#: Words before personal data that serve as features.
CUES = frozenset("tel phone mobile call dial fax text card visa amex carte karte tarjeta ip host ping mail contact write room page chapter version year id order".split())


def may_be_personal(word: str) -> bool:
    return "@" in word or any("0" <= c <= "9" for c in word)


def runs_of(text: str, known: Features) -> list[tuple[list[tuple[int, int]], list[tuple[int, ...]]]]:
    """Maximal runs of words with a digit or ``@``: their places and their features. White space never joins texts' lines apart."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    special = [may_be_personal(text[a:b]) for a, b in words]
    out, i = [], 0
    while i < len(words):
        if not special[i]:
            i += 1
            continue
        j = i
        while j < len(words) and special[j]:
            j += 1
        get = lambda x: text[words[x][0] : words[x][1]] if 0 <= x < len(words) else ""
        out.append((words[i:j], [known[get(x - 1), get(x), get(x + 1)] for x in range(i, j)]))
        i = j
    return out


# ---------------------------------------------------------------- the field


class Field:
    """Weights of the chain: hashed emissions, transitions, start and end scores."""

    def __init__(self, emit: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.emit, self.trans, self.start = emit, trans, start

    def scores(self, features: list[tuple[int, ...]]) -> np.ndarray:
        return np.stack([self.emit[list(f)].sum(axis=0) for f in features])


def _allowed() -> np.ndarray:
    """0 where one label may follow another, else -inf: an inside label needs its kind before it."""
    ok = np.zeros((len(LABELS), len(LABELS)))
    for j, to in enumerate(LABELS):
        if to.startswith("I-"):
            for i, frm in enumerate(LABELS):
                if frm[2:] != to[2:]:
                    ok[i, j] = -np.inf
    return ok


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def labelled_runs(rows) -> list[tuple[list[tuple[int, ...]], list[int]]]:
    """Features and labels of the runs of marked-up texts."""
    out, known = [], Features()
    for row in rows:
        text, spans, at = "", [], 0
        for m in _MARKED.finditer(row):
            text += row[at : m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        text += row[at:]
        for places, features in runs_of(text, known):
            labels = []
            for a, b in places:
                hit = next((s for s in spans if s[1] < b and a < s[2]), None)
                labels.append(0 if hit is None else LABELS.index(("B-" if a <= hit[1] else "I-") + hit[0]))
            out.append((features, labels))
    return out


def train(rows=LABELLED, rounds: int = 80, rate: float = 0.3, l2: float = 0.01) -> Field:
    """Maximum likelihood with an L2 penalty by full-gradient steps with per-weight step sizes (forward-backward)."""
    data, k = labelled_runs(rows), len(LABELS)
    hard = _allowed()
    start_hard = np.asarray([-np.inf if label.startswith("I-") else 0.0 for label in LABELS])
    field = Field(np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k)), np.zeros(k))
    grown = [np.full(w.shape, 1e-8) for w in (field.emit, field.trans, field.start)]
    for _ in range(rounds):
        grads = [-l2 * field.emit, -l2 * field.trans, -l2 * field.start]
        for features, labels in data:
            e, n = field.scores(features), len(labels)
            trans, first = field.trans + hard, field.start + start_hard
            fwd, bwd = np.empty((n, k)), np.zeros((n, k))
            fwd[0] = first + e[0]
            for t in range(1, n):
                fwd[t] = _lse(fwd[t - 1][:, None] + trans, 0) + e[t]
            for t in range(n - 2, -1, -1):
                bwd[t] = _lse(trans + (e[t + 1] + bwd[t + 1])[None, :], 1)
            total = _lse(fwd[-1], 0)
            node = -np.exp(fwd + bwd - total)
            node[np.arange(n), labels] += 1
            for t, f in enumerate(features):
                grads[0][list(f)] += node[t]
            grads[2] += node[0]
            for t in range(1, n):
                grads[1] -= np.exp(fwd[t - 1][:, None] + trans + (e[t] + bwd[t])[None, :] - total)
                grads[1][labels[t - 1], labels[t]] += 1
        for w, g, s in zip((field.emit, field.trans, field.start), grads, grown, strict=True):
            s += g * g
            w += rate * g / np.sqrt(s)
    return Field(field.emit, field.trans + hard, field.start + start_hard)


def viterbi(field: Field, runs: list[list[tuple[int, ...]]], cells: int = 200_000) -> list[list[int]]:
    """Best label sequence of each run; runs of like length are decoded together."""
    out: list[list[int]] = [[] for _ in runs]
    order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(runs[order[end]]) <= cells:
            end += 1
        _decode(field, [runs[i] for i in order[at:end]], order[at:end], out)
        at = end
    return out


def _decode(field: Field, batch: list, names: list[int], out: list) -> None:
    lengths = np.asarray([len(r) for r in batch])
    longest, k = int(lengths.max()), len(LABELS)
    e = np.zeros((len(batch), longest, k))
    for i, r in enumerate(batch):
        e[i, : len(r)] = field.scores(r)
    best, back = field.start + e[:, 0], np.zeros((len(batch), longest, k), dtype=np.int8)
    for t in range(1, longest):
        step = best[:, :, None] + field.trans[None]
        frm = step.argmax(axis=1)
        new = np.take_along_axis(step, frm[:, None, :], axis=1)[:, 0] + e[:, t]
        live = (t < lengths)[:, None]
        back[:, t] = np.where(live, frm, np.arange(k))
        best = np.where(live, new, best)
    label = best.argmax(axis=1)
    path = np.empty((len(batch), longest), dtype=np.int64)
    for t in range(longest - 1, -1, -1):
        path[:, t] = label
        label = back[np.arange(len(batch)), t, label]
    for i, name in enumerate(names):
        out[name] = path[i, : lengths[i]].tolist()


def chain_spans(text: str, places: list[tuple[int, int]], labels: list[int]) -> list[Span]:
    """Spans of a labelled run, trimmed to the data itself and held to the plain limits of their kind."""
    out, i = [], 0
    while i < len(labels):
        name = LABELS[labels[i]]
        j = i + 1
        if name != "O":
            while j < len(labels) and LABELS[labels[j]] == "I-" + name[2:]:
                j += 1
            a, b = places[i][0], places[j - 1][1]
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if _plausible(name[2:], text[a:b]):
                out.append((name[2:], a, b))
        i = j
    return out


def _plausible(kind: str, value: str) -> bool:
    n = len(_digits(value))
    if kind == "email":
        return 0 < value.find("@") < len(value) - 1
    if kind == "ip":
        return value.count(".") == 3 or value.count(":") >= 2
    return 13 <= n <= 19 if kind == "card" else 7 <= n <= 15


def find_spans(texts: list[str], field: Field, known: Features | None = None) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans (base, and the field's that touch none of them) of each text."""
    known = Features() if known is None else known
    base = [base_spans(t) if t else [] for t in texts]
    runs = [(i, places, features) for i, t in enumerate(texts) if t for places, features in runs_of(t, known)]
    every = [list(b) for b in base]
    for (i, places, _), labels in zip(runs, viterbi(field, [r[2] for r in runs]), strict=True):
        for kind, a, b in chain_spans(texts[i], places, labels):
            if not any(s[1] < b and a < s[2] for s in base[i]):
                every[i].append((kind, a, b))
    return base, [sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) for spans in every]


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _suspects(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """Rows whose text holds a digit or ``@`` (no other can have a span), some megabytes of text at a time."""
    at = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False).to_numpy(zero_copy_only=False))
    rows, texts, held = [], [], 0
    for i in at.tolist():
        text = column[i].as_py()
        rows.append(i)
        texts.append(text)
        held += len(text)
        if held > 4_000_000:
            yield rows, texts
            rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", field: Field | None = None) -> DataFrame:
    """Per document: counts of the base spans, the SHA-256 of their list, and the list of all spans.

    Null and empty texts have no spans; repeated rows are answered one by
    one; an empty table gives an empty table; other columns are not used.
    """
    field = field or train()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        none, known = sha256(b"").hexdigest(), Features()
        for batch in batches:
            n = batch.num_rows
            counts = {k: np.zeros(n, dtype=np.int64) for k in KINDS}
            digests, spans = [none] * n, [""] * n
            for rows, texts in _suspects(batch.column(1)):
                for i, base, every in zip(rows, *find_spans(texts, field, known), strict=True):
                    for kind, _, _ in base:
                        counts[kind][i] += 1
                    digests[i] = sha256(span_text(base).encode()).hexdigest()
                    spans[i] = span_text(every)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[k]) for k in KINDS], pa.array(digests), pa.array(spans)],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def redact_documents(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; ``n_chars``, where there, follows the new text."""
    field = field or train()
    small_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for batch in batches:
            column = batch.column(place)
            new: dict[int, str] = {}
            for rows, texts in _suspects(column):
                for i, t, every in zip(rows, texts, find_spans(texts, field, known)[1], strict=True):
                    if every:
                        new[i] = redact(t, every)
            if new:
                mask = np.zeros(batch.num_rows, dtype=bool)
                mask[list(new)] = True
                column = pc.replace_with_mask(column, pa.array(mask), pa.array([new[i] for i in sorted(new)], column.type))
            yield pa.RecordBatch.from_arrays([column if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pii_query(spark, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
