import hashlib
import random
import re
import zlib

import pytest

from stridewise.llm import dialogues
from stridewise.llm.dialogues import damage, repair_conversations, solve

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def least_audit(rows):
    """All states with their least (cost, audit), row by row; rows are (initial, fault)."""
    best = {0: (0, "")}
    for initial, fault in rows:
        new = {}
        for start, (cost, audit) in best.items():
            for inserts in range(4):
                state = start
                for _ in range(inserts):
                    state = NEXT[state]
                ways = [(state, 4, "D")]
                if fault in ("ok", "cut"):
                    extra = 3 * (fault == "cut")
                    ways.append((NEXT[state], 3 + extra, "R"))
                    if (initial, state) in KEPT:
                        ways.append((KEPT[initial, state], extra, "K"))
                for end, more, letter in ways:
                    way = (cost + 3 * inserts + more, audit + "I" * inserts + letter)
                    new[end] = min(new.get(end, way), way)
        best = new
    tails = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    return min((c + tails[s][0], a + tails[s][1]) for s, (c, a) in best.items())


def brute(rows):
    """Contract rows of conversations given as (conv, turn, role, text) after damage, and their names."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv and not r[4]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text, _ in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not last else "again" if (role, text) in seen else "cut" if last[-1] not in ".!?" else "ok")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit = least_audit([(r[2][:1], f) for r, f in zip(own, faults)])
        kept = len(audit.replace("D", ""))
        lines, i, j = [], 0, 0
        for letter in audit:
            row = None if letter == "I" else own[i]
            i += letter != "I"
            if letter != "D":
                j += 1
                role = row[2] if letter == "K" else "user" if (j + kept) % 2 else "assistant"
                lines.append(f"{role}:{row[3] if row else ''}")
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("again"), faults.count("cut"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=str)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text, kind == 0)] * (2 if kind == 3 else 1)
    return out


def random_rows(seed, convs=40, most=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "open end", " ", "", "tail. \n", " ", None, "a.b", "..."]
    out = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, most)):
            out.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts)))
    rng.shuffle(out)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_divide_and_conquer_equals_dynamic_programming():
    rng = random.Random(1)
    names = {dialogues.OK: "ok", dialogues.BLANK: "blank", dialogues.DUPLICATE: "again", dialogues.CUT: "cut"}
    for _ in range(3000):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 14)))
        assert solve(codes) == least_audit([("suao"[c // 4], names[c % 4]) for c in codes])


@pytest.mark.parametrize("seed, held, bits", [(1, 20_000, 14), (2, 3, 1), (3, 4, 0), (4, 2, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, held, bits):
    monkeypatch.setattr(dialogues, "MOST_HELD", held)
    monkeypatch.setattr(dialogues, "BLOCK_BITS", bits)
    rows = random_rows(seed)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cost", "'x' as audit", "2 as pos", "true as blank").repartition(5)
    got = repair_conversations(damage(table), absent="absent").audits
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(damaged(rows))


def test_one_hot_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(dialogues, "MOST_HELD", 50)
    monkeypatch.setattr(dialogues, "BLOCK_BITS", 4)
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["One.", "Two", f"Three {i}."])) for i in range(3000)] + random_rows(9, convs=6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repair = repair_conversations(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "c"), conv="c")
        got = sorted((tuple(r) for r in repair.audits.collect()), key=str)
        kept = repair.rows.orderBy("c", "place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plain = [(c, t, " " if r is None else r, " " if x is None else x, False) for c, t, r, x in rows]
    assert got == brute(plain)
    for conv, *_, digest in got:
        lines = [f"{r['role']}:{r['text']}" for r in kept if r["c"] == conv]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept if r["c"] == conv))


def test_empty_text_ids_and_all_dropped(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(none).audits.count() == 0 and repair_conversations(none).rows.count() == 0
    rows = [("x", 0, "user", "Hello.", True), ("y", 0, "user", "Hello.", False), (None, None, None, None, False)]
    got = repair_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, gone boolean"), absent="gone").audits
    empty = hashlib.sha256(b"").hexdigest()
    found = {r["conv_id"]: tuple(r)[1:] for r in got.collect()}
    assert found["x"] == (0, 0, 0, 0, 0, 0, "", empty)
    assert found["y"][4:7] == (0, 3, "KI") and found[None][1:7] == (1, 0, 0, 0, 4, "D")
