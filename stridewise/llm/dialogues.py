"""Repair of conversation structure at least cost, by divide and conquer in linear space (Hirschberg).

A repaired conversation has the role initials ``(s?(ua)+)?``. An automaton of
four states reads them (0 nothing yet, 1 after s, 2 after u, 3 after a), so the
cost of repairing rows up to a place is a vector of four numbers. The
conversation is halved; the forward vector of the first half and the backward
vector of the second meet in the middle, a state is chosen in which their sum is least,
and both halves are solved alone. Of several least crossings the one with the
ASCII-least audit is chosen: a letter sequence fixes the path of states, so no two first
halves are prefixes of each other and their order, kept as four ranks beside the
costs, decides.

Conversations are laid out by ranges of ``(conversation, turn, role, text)``.
One that lies within a partition is solved where it is read. The others (those at
the edges of partitions, and any longer than :data:`MOST_HELD`) are cut into blocks
of turns; a block is summed up by its 4 x 4 costs and ranks, the same divide and
conquer over the blocks fixes the states at their borders, and then each block is
solved on its own. So no task holds a whole hot conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE_CLASS, stage

#: Rows and characters of one conversation held while it is read; a longer one is solved in blocks.
MOST_HELD, MOST_CHARS = 20_000, 1 << 25
#: Turns in a block: 2**BLOCK_BITS.
BLOCK_BITS = 14
#: Solved sequences of row codes that a worker keeps.
KEEP_SOLVED = 50_000

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

INITIALS = "suao"  # o: any other
OK, BLANK, DUPLICATE, CUT = range(4)
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: State after the user or assistant row that can follow in a state, and after one with a given initial.
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
#: Cost and audit of ending in a state.
_TAIL = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def row_code(role: str, fault: int) -> int:
    place = INITIALS.find(role[:1]) if role[:1] else 3
    return (place if 0 <= place < 3 else 3) * 4 + fault


def _row_steps(code: int) -> list[tuple[int, int, int, str]]:
    """``(from, to, cost, letters)`` of a row: inserts before it, then its own edit; the best way only for each from and to."""
    initial, fault = INITIALS[code // 4], code % 4
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, letters, cost = start, "", 0
        for _ in range(3):
            ways = [(state, DELETE, "D")]
            if fault in (OK, CUT):
                extra = TRUNCATED if fault == CUT else 0
                ways.append((_NEXT[state], REROLE + extra, "R"))
                if state in _KEPT[initial]:
                    ways.append((_KEPT[initial][state], extra, "K"))
            for end, more, letter in ways:
                way = (cost + more, letters + letter)
                best[start, end] = min(best.get((start, end), way), way)
            state, letters, cost = _NEXT[state], letters + "I", cost + INSERT
    return [(p, q, c, s) for (p, q), (c, s) in best.items()]


ROW_STEPS = [_row_steps(code) for code in range(16)]


def forward(items: list, lo: int, hi: int, start: int) -> tuple[dict[int, int], dict[int, int]]:
    """Least cost from ``start`` to each state behind ``items[lo:hi]``, and the rank of the ASCII-least audit among the states."""
    cost, rank = {start: 0}, {start: 0}
    for i in range(lo, hi):
        best: dict[int, tuple] = {}
        for p, q, c, key in items[i]:
            if p in cost:
                way = (cost[p] + c, rank[p], key)
                if q not in best or way < best[q]:
                    best[q] = way
        cost = {q: way[0] for q, way in best.items()}
        rank = {q: place for place, q in enumerate(sorted(best, key=lambda q: best[q][1:]))}
    return cost, rank


def backward(items: list, lo: int, hi: int, end: int) -> dict[int, int]:
    """Least cost from each state before ``items[lo:hi]`` to ``end``."""
    cost = {end: 0}
    for i in range(hi - 1, lo - 1, -1):
        best: dict[int, int] = {}
        for p, q, c, _ in items[i]:
            if q in cost and (p not in best or cost[q] + c < best[p]):
                best[p] = cost[q] + c
        cost = best
    return cost


def crossings(items: list, lo: int, hi: int, start: int, end: int) -> list[int]:
    """States between the items of the least path from ``start`` to ``end`` with the ASCII-least audit, ``end`` last."""
    if hi - lo == 1:
        return [end]
    mid = (lo + hi) // 2
    cost, rank = forward(items, lo, mid, start)
    rest = backward(items, mid, hi, end)
    state = min((q for q in cost if q in rest), key=lambda q: (cost[q] + rest[q], rank[q]))
    return crossings(items, lo, mid, start, state) + crossings(items, mid, hi, state, end)


def final_state(items: list) -> tuple[int, int]:
    """Last state and whole cost of the least audit of a conversation (of one row at least)."""
    cost, rank = forward(items, 0, len(items), 0)
    end = min(cost, key=lambda q: (cost[q] + _TAIL[q][0], rank[q]))
    return end, cost[end] + _TAIL[end][0]


def letters_between(codes: bytes, start: int, end: int) -> str:
    """The audit of rows given the states before and behind them."""
    steps = [ROW_STEPS[c] for c in codes]
    out, state = [], start
    for way, q in zip(steps, crossings(steps, 0, len(steps), start, end)):
        out.append(next(s for p, e, _, s in way if p == state and e == q))
        state = q
    return "".join(out)


def solve(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if not codes:
        return 0, ""
    end, cost = final_state([ROW_STEPS[c] for c in codes])
    return cost, letters_between(codes, 0, end) + _TAIL[end][1]


def edited(letters: str, state: int, rows: Iterator) -> Iterator[tuple]:
    """``(letter, role, row)`` of each row that the edits leave; ``role`` None: as it is, ``row`` None: inserted."""
    for letter in letters:
        if letter == "I":
            yield "I", ("assistant" if state == 2 else "user"), None
            state = _NEXT[state]
            continue
        row = next(rows)
        if letter == "R":
            yield "R", ("assistant" if state == 2 else "user"), row
            state = _NEXT[state]
        elif letter == "K":
            yield "K", None, row
            state = _KEPT[row[0][:1]][state]


def illegal_pairs(codes: bytes) -> int:
    initials = [INITIALS[c // 4] for c in codes]
    return sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))


@dataclass(frozen=True)
class Repair:
    audits: DataFrame  # conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256
    rows: DataFrame    # conversation, place (order of the rows within it), turn (null: inserted), role, text, edit


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         absent: str | None = None) -> Repair:
    """Faults, least edits and repaired rows of every conversation.

    The rows of a conversation stand in the order of their turns (nulls first), then role, then
    text; a null conversation is one of its own. Null roles and texts count as one space. The first
    fault of a row counts: blank (nothing but white space), duplicate (role and text stood earlier),
    truncated (the last character that is not white space is none of ``. ! ?``). Blank and duplicate rows are deleted (4);
    others are kept, get the role user or assistant (3) or are deleted (4); empty rows may be inserted (3); a truncated
    row that stays costs 3 more. Roles are known by their first character; an empty role is none of s, u, a.
    Rows with ``absent`` true only name their conversation, which has zeros and an empty audit
    if it has no others. Other columns are ignored, an empty table gives empty results.
    """
    spark = rows.sparkSession
    conv_type = rows.schema[conv].dataType
    body = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    trimmed = F.regexp_replace(body, WHITE_CLASS + r"\z", "")
    prepared = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        body.alias("text"), (F.coalesce(F.col(f"`{absent}`"), F.lit(False)) if absent else F.lit(False)).alias("absent"),
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    # the text's beginning splits very many rows of one turn as well
    laid = prepared.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
    record = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("conv", conv_type), T.StructField("pos", T.LongType()), T.StructField("sub", T.LongType()),
        T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("absent", T.BooleanType()), T.StructField("blank_row", T.BooleanType()), T.StructField("cut_row", T.BooleanType()),
        T.StructField("edit", T.StringType()), *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])
    read = stage(laid.mapInArrow(_reader(record), record), "dialogues")
    whole = read.where("kind = 'audit'").select("conv", *_COUNTS, "audit", "repaired_sha256")
    near = read.where("kind = 'row'").select("conv", "pos", "sub", "turn", "role", "text", "edit")
    raw = read.where("kind = 'raw'").select("conv", "pos", "turn", "role", "text", "absent", F.col("blank_row").alias("blank"), F.col("cut_row").alias("cut"))
    far_audits, far_rows = _in_blocks(raw)
    audits = whole.unionByName(far_audits).withColumnRenamed("conv", conv)
    out = near.unionByName(far_rows).select(F.col("conv").alias(conv), F.struct("pos", "sub").alias("place"), F.col("turn").alias("turn"),
                                            F.col("role").alias("role"), F.col("text").alias("text"), "edit")
    return Repair(audits, out)


def _reader(record: T.StructType):
    """Solves the conversations that lie wholly in a partition, and gives the rows of the others back with their places."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = record.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = to_arrow_schema(record)
        base = TaskContext.get().partitionId() << 40
        solved: dict[bytes, tuple[int, str]] = {}
        out: list[dict] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return batch

        def raw(conv, held: list) -> None:
            out.extend({"kind": "raw", "conv": conv, "pos": p, "turn": t, "role": r, "text": x, "absent": a, "blank_row": b, "cut_row": c}
                       for p, t, r, x, a, b, c in held)

        def done(conv, held: list) -> None:
            present = [h for h in held if not h[4]]
            seen, codes = set(), bytearray()
            for _, _, r, x, _, blank, cut in present:
                fault = BLANK if blank else DUPLICATE if (r, x) in seen else CUT if cut else OK
                seen.add((r, x))
                codes.append(row_code(r, fault))
            codes = bytes(codes)
            if codes not in solved:
                if len(solved) >= KEEP_SOLVED:
                    solved.clear()
                solved[codes] = solve(codes)
            cost, audit = solved[codes]
            digest = hashlib.sha256()
            for i, (letter, new_role, row) in enumerate(edited(audit, 0, ((h[2], h[3], h[1]) for h in present))):
                r, x, t = (new_role, "", None) if row is None else (new_role or row[0], row[1], row[2])
                digest.update(f"{chr(10) if i else ''}{r}:{x}".encode())
                out.append({"kind": "row", "conv": conv, "pos": present[0][0], "sub": i, "turn": t, "role": r, "text": x, "edit": letter})
            turns = {h[1] for h in present if h[1] is not None}
            faults = [c % 4 for c in codes]
            out.append({
                "kind": "audit", "conv": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
                "illegal": illegal_pairs(codes), "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest(),
            })

        current, held, chars, first, split, n = None, [], 0, True, False, 0
        for batch in batches:
            for values in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "absent", "blank", "cut")]):
                if n and values[0] != current:
                    # the first of a partition may have begun in the one before
                    (raw if first or split else done)(current, held)
                    held, chars, first, split = [], 0, False, False
                current = values[0]
                held.append((base + n, *values[1:]))
                chars += len(values[3])
                n += 1
                if len(held) >= MOST_HELD or chars >= MOST_CHARS:
                    raw(current, held)
                    held, chars, split = [], 0, True
                if len(out) >= 10_000 or split and out:
                    yield flush()
        raw(current, held)  # the last may go on in the next partition
        if out:
            yield flush()

    assert names[0] == "kind"
    return read


def _in_blocks(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired rows of conversations given as placed rows, solved in blocks of turns."""
    present = raw.where("not absent")
    conv_type = raw.schema["conv"].dataType
    key = F.struct(F.col("conv").alias("v"))  # a struct is never null, so that null conversations meet in joins
    # the first place of each role and text; hashed texts spread a hot conversation and are combined before the shuffle
    first = present.where("not blank").groupBy("conv", "role", F.md5(F.col("text").cast("binary"))).agg(F.min("pos").alias("pos"))
    marks = present.select("conv", "pos", "role", "blank", "cut").join(first.select("pos", F.lit(True).alias("new")), "pos", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(OK)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    coded = marks.select("conv", "pos", F.shiftright("pos", BLOCK_BITS).alias("block"), (place * 4 + fault).cast("int").alias("code"))

    blocks_type = T.StructType([
        T.StructField("conv", conv_type), T.StructField("run", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("steps", T.ArrayType(T.ArrayType(T.LongType()))), *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "head", "last")],
    ])
    blocks = stage(coded.groupBy("conv", "block").applyInArrow(_sum_up(blocks_type), blocks_type), "dialogue-blocks")
    border_type = "run long, start long, stop long, total long, tail string, illegal long"
    borders = blocks.drop("codes", "places").groupBy("conv").applyInArrow(_borders, border_type)
    joined = blocks.join(borders.withColumnRenamed("illegal", "between"), "run")
    piece_type = T.StructType([
        T.StructField("conv", conv_type), T.StructField("run", T.LongType()), T.StructField("piece", T.StringType()), T.StructField("tail", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("edits", T.ArrayType(T.StructType([
            T.StructField("pos", T.LongType()), T.StructField("sub", T.LongType()), T.StructField("edit", T.StringType()), T.StructField("role", T.StringType())]))),
    ])
    pieces = stage(joined.mapInArrow(_solve_blocks(piece_type), piece_type), "dialogue-pieces")

    found = pieces.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("run", "piece", "tail"))).alias("parts"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
    ).withColumn("audit", F.concat(F.array_join(F.transform("parts", lambda p: p["piece"]), ""), F.element_at("parts", -1)["tail"])).drop("parts")
    turns = raw.where("not absent").groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    # the text of the rows that stay; what is inserted has no row of its own
    edits = pieces.select("conv", F.inline("edits"))
    texts = present.select(F.col("pos").alias("_pos"), F.col("role").alias("_role"), "text", "turn")
    rows = edits.join(texts, (F.col("pos") == F.col("_pos")) & (F.col("edit") != "I"), "left").select(
        "conv", "pos", "sub", "turn", F.coalesce("role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")
    rows = stage(rows, "dialogue-rows")
    digests = rows.repartition("conv").sortWithinPartitions("conv", "pos", "sub").select("conv", "role", "text")
    digest_type = T.StructType([T.StructField("conv", conv_type), T.StructField("repaired_sha256", T.StringType())])
    digests = digests.mapInArrow(_digests(digest_type), digest_type)

    def by_key(df: DataFrame) -> DataFrame:
        return df.withColumn("key", key).drop("conv")

    everyone = raw.select("conv").distinct()
    audits = (
        everyone.withColumn("key", key).join(by_key(found), "key", "left").join(by_key(turns), "key", "left").join(by_key(digests), "key", "left")
        .select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
    )
    return audits, rows


def _sum_up(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        codes = bytes(table.column("code").to_pylist())
        places = table.column("pos").to_pylist()
        items = [ROW_STEPS[c] for c in codes]
        steps = []
        for start in range(4):
            cost, rank = forward(items, 0, len(items), start)
            steps += [[start, q, cost[q], rank[q]] for q in sorted(cost)]
        faults = [c % 4 for c in codes]
        row = {"conv": table.column("conv")[0].as_py(), "run": places[0], "codes": codes, "places": places, "steps": steps,
               "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
               "illegal": illegal_pairs(codes), "head": codes[0] // 4, "last": codes[-1] // 4}
        return pa.Table.from_pylist([row], schema=to_arrow_schema(schema))

    return run


def _borders(table: pa.Table) -> pa.Table:
    """States at the borders of the blocks of one conversation: the divide and conquer over blocks as items."""
    table = table.sort_by("run")
    items = [[tuple(s) for s in steps] for steps in table.column("steps").to_pylist()]
    end, total = final_state(items)
    states = [0, *crossings(items, 0, len(items), 0, end)]
    heads, lasts = table.column("head").to_pylist(), table.column("last").to_pylist()
    between = [0] + [int((INITIALS[a], INITIALS[b]) not in _LEGAL) for a, b in zip(lasts, heads[1:])]
    n = len(items)
    return pa.table({
        "run": table.column("run").cast(pa.int64()), "start": pa.array(states[:-1], pa.int64()), "stop": pa.array(states[1:], pa.int64()),
        "total": pa.array([total] + [0] * (n - 1), pa.int64()), "tail": pa.array([""] * (n - 1) + [_TAIL[end][1]], pa.string()),
        "illegal": pa.array(between, pa.int64()),
    })


def _solve_blocks(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                piece = letters_between(r["codes"], r["start"], r["stop"])
                rows = ((INITIALS[c // 4], p) for c, p in zip(r["codes"], r["places"]))
                edits, last = [], r["places"][0]
                # an inserted row stands before the next row of the block: its place is that of the row before, or of the block
                for sub, (letter, role, row) in enumerate(edited(piece + r["tail"], r["start"], rows), 1):
                    last = row[1] if row else last
                    edits.append({"pos": last, "sub": sub, "edit": letter, "role": role})
                out = {c: r[c] for c in ("conv", "run", "blank", "duplicate", "truncated", "tail")}
                out |= {"piece": piece, "illegal": r["illegal"] + r["between"], "cost": r["total"], "edits": edits}
                yield pa.RecordBatch.from_pylist([out], schema=arrow)

    return run


def _digests(schema: T.StructType):
    """SHA-256 of the rows of each conversation, which stand together; a row at a time, as the digest of a sequence has to be."""
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        stream = (v for batch in batches for v in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]))
        for conv, rows in groupby(stream, key=lambda v: v[0]):
            digest = hashlib.sha256()
            for i, (_, role, text) in enumerate(rows):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}], schema=arrow)

    return run


def damage(rows: DataFrame) -> DataFrame:
    """Conversations damaged by ``crc32(conv_id:turn) % 20``: 0 makes a row absent, 1 empties its text, 2 takes its ``. ! ?`` out, 3 repeats it, 4 makes it a user's."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("_kind")
    return rows.withColumn("_kind", F.crc32(name.cast("binary")) % 20).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("absent"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def dialogues_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op11: damage, then faults, least audit and digest of the repaired rows per conversation."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return stage(repair_conversations(damage(rows), absent="absent").audits, "dialogue-audits")


def _oracle() -> str:
    """DuckDB SQL of :func:`dialogues_query`: the same least audits by a reduction over the rows of each conversation.

    The reduction keeps one text a state, nine digits of cost and the audit, so that the least text is the least and ASCII-least audit.
    """

    def add(x: str, cost: int, letters: str) -> str:
        return f"(lpad(cast(cast(left({x}, 9) as integer) + {cost} as varchar), 9, '0') || substr({x}, 10) || '{letters}')"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def edit(state: str, more: str, letter: str) -> str:
        return f"case when x[2] in ('ok', 'cut') {more} then case when x[2] = 'cut' then {{}} else {{}} end end".format(
            add(state, (REROLE if letter == "R" else 0) + TRUNCATED, letter), add(state, REROLE if letter == "R" else 0, letter))

    with_inserts = [
        "a[1]", "a[2]",
        least("a[3]", add("a[1]", INSERT, "I"), add("a[2]", INSERT, "I"), add("a[4]", INSERT, "I")),
        least("a[4]", add("a[3]", INSERT, "I"), add("a[1]", 2 * INSERT, "II"), add("a[2]", 2 * INSERT, "II")),
    ]
    step = "[{}]".format(", ".join([
        add("b[1]", DELETE, "D"),
        least(add("b[2]", DELETE, "D"), edit("b[1]", "and x[1] = 's'", "K")),
        least(add("b[3]", DELETE, "D"), *[edit(f"b[{p}]", "", "R") for p in (1, 2, 4)], *[edit(f"b[{p}]", "and x[1] = 'u'", "K") for p in (1, 2, 4)]),
        least(add("b[4]", DELETE, "D"), edit("b[3]", "", "R"), edit("b[3]", "and x[1] = 'a'", "K")),
    ]))
    bound = f"list_transform([[{', '.join(with_inserts)}]], lambda b: {step})[1]"
    end = least("e[1]", add("e[2]", 2 * INSERT, "II"), add("e[3]", INSERT, "I"), "e[4]")
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with crc as (
  select list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) as t),
named as (
  select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
kinds as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as body,
    xor(list_reduce(list_transform(string_split(name, ''), lambda ch: cast(ord(ch) as bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as kind
  from named, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(body, '[.!?]', '', 'g') else body end as body,
    unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from kinds where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, body, copy) as i, rtrim(body, {white}) as trimmed from damaged),
faults as (
  select conv_id, i, turn, role, body, left(role, 1) as initial, case
    when trimmed = '' or trimmed is null then 'blank'
    when row_number() over (partition by conv_id, role, body order by i) > 1 then 'again'
    when right(trimmed, 1) not in ('.', '!', '?') then 'cut' else 'ok' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from placed),
ends as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'again') as duplicate, count(*) filter (fault = 'cut') as truncated,
    count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal,
    list_reduce(list([initial, fault] order by i), lambda a, x: {bound}, ['000000000', null, null, null]) as e
  from faults group by conv_id),
least_audit as (select * exclude (e), {end} as best from ends),
letters as (
  select conv_id, unnest(string_split(substr(best, 10), '')) as letter, generate_subscripts(string_split(substr(best, 10), ''), 1) as p
  from least_audit where length(best) > 9),
counted as (
  select *, count(*) filter (letter <> 'I') over w as i, count(*) filter (letter <> 'D') over w as j,
    count(*) filter (letter <> 'D') over (partition by conv_id) as m
  from letters window w as (partition by conv_id order by p)),
repaired as (
  select c.conv_id, j, case when letter = 'K' then f.role when (j + m) % 2 = 1 then 'user' else 'assistant' end
      || ':' || case when letter = 'I' then '' else f.body end as line
  from counted c left join faults f on f.conv_id is not distinct from c.conv_id and f.i = c.i and letter <> 'I' where letter <> 'D'),
digests as (select conv_id, sha256(string_agg(line, chr(10) order by j)) as digest from repaired group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(coalesce(left(best, 9), '0') as bigint) as cost, coalesce(substr(best, 10), '') as audit,
  coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
  left join least_audit l on l.conv_id is not distinct from c.conv_id left join digests d on d.conv_id is not distinct from c.conv_id
"""


ORACLE = _oracle()
