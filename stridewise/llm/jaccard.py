"""Similarity join on word shingles with token-combination prefixes.

Tokens (shingle hashes) are ordered by frequency class, then by hash. A set
of n tokens may miss at most ``e = n - ceil(t * n)`` of a partner's. Rare
tokens of its prefix are indexed one by one, frequent ones as pairs within
hash groups; a prefix is extended until its rare tokens plus, per group, all
frequent tokens but one exceed e, so that two linked sets share a
signature. Sets that run out of tokens before are indexed, among
themselves, by the single tokens of the plain prefix as well.

Frequencies come from a counting sketch of fixed width over the shingles of all
distinct texts (equal sets within a task once); they steer cost, never the result.
Equal texts are read for one of them only, and equal sets are one class throughout.
Candidates are verified on full sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.joins import lookup_join
from .common import connected_components, drop_stage, stage, trim_memory
from .shingles import WordHashes, least_difference, mix64, parity, set_key, shingle_set

SKETCH_BITS = 23
SKETCH_CHUNKS = 64
PAIR_GROUPS = 32

#: Signatures with more classes than this are compared in blocks instead of as rows of pairs.
MOST_PAIRED = 64
#: Classes in a block on average at most; they are dealt to blocks by hash.
BLOCK = 256
#: Signatures above this frequency level (some 2**level sets) are ordered in parts of about that many sets.
PART_LEVEL = 8

#: The largest bitmap of hashes that is broadcast: 2**MOST_BITS bits.
MOST_BITS = 27


PROFILE = ["text_hash", "n", "cls", "parity", "chunk", "counts"]


def _flush(sketch: np.ndarray, held: list[np.ndarray], mask: np.uint64) -> None:
    if held:
        cells, counts = np.unique(np.concatenate(held) & mask, return_counts=True)
        sketch[cells.astype(np.int64)] += counts.astype(np.int32)
        held.clear()


def _row_hash(doc_id, text_hash):
    return F.xxhash64(text_hash, doc_id)


def first_rows(rows: DataFrame):
    """A bitmap, broadcast, of the row hashes of one row of each group of equal texts in ``rows (doc_id, text_hash)``: the one with the smallest id.

    Where texts are read it picks these rows and a few others, so that copies are neither counted nor indexed again,
    however many there are and wherever they stand. Without it the frequencies of all shingles would grow with the copies.
    """
    firsts = stage(rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id")).select(_row_hash("doc_id", "text_hash").alias("row")), "firsts")
    return rows.sparkSession.sparkContext.broadcast(hash_bitmap(firsts, "row"))


def _first(batch: pa.RecordBatch, firsts) -> pa.RecordBatch:
    """The rows of a batch that the bitmap marks; their hashes are the first column."""
    return batch.filter(pa.array(marked(firsts.value, batch.column(0).to_numpy()), pa.bool_()))


def profile(docs: DataFrame, k: int, firsts) -> DataFrame:
    """One pass over ``(row, text_hash, text)``: a row a text, then the task's sketch in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        sketch, held, n_held = np.zeros(1 << SKETCH_BITS, dtype=np.int32), [], 0
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            batch = _first(batch, firsts)
            sizes, keys, odd = [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), k, hashes)
                key = set_key(s) if len(s) else None
                odd.append(parity(s) if len(s) else None)
                sizes.append(len(s))
                keys.append(key)
                if key is not None and key not in seen:
                    seen.add(key)
                    held.append(s)
                    n_held += len(s)
                    if n_held > 500_000:
                        _flush(sketch, held, mask)
                        n_held = 0
            none = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(odd, pa.binary()), none, pa.nulls(len(sizes), pa.binary())],
                names=PROFILE,
            )
        _flush(sketch, held, mask)
        rows = []
        for i, part in enumerate(np.split(sketch, SKETCH_CHUNKS)):
            cells = np.flatnonzero(part)
            if len(cells):
                rows.append((i, zlib.compress(np.concatenate([np.diff(cells, prepend=0), part[cells]]).astype("<u4").tobytes(), 1)))
        empty = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [empty, empty, empty, pa.nulls(len(rows), pa.binary()), pa.array([r[0] for r in rows], pa.int32()),
             pa.array([r[1] for r in rows], pa.binary())],
            names=PROFILE,
        )
        trim_memory()

    return docs.select("row", "text_hash", "text").mapInArrow(run, "text_hash long, n long, cls long, parity binary, chunk int, counts binary")


def frequency_levels(profiled: DataFrame) -> np.ndarray:
    """Per sketch cell 0 (rare) or a level that grows with the logarithm of its count: ``2**SKETCH_BITS`` bytes in all."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNKS, dtype=np.int64)
        for blob in rows["counts"]:
            steps, counts = np.frombuffer(zlib.decompress(blob), dtype="<u4").reshape(2, -1)
            total[np.cumsum(steps, dtype=np.int64)] += counts
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [zlib.compress(total.astype("<i8").tobytes(), 1)]})

    chunks = profiled.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary")
    width = (1 << SKETCH_BITS) // SKETCH_CHUNKS
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for row in chunks.collect():  # SKETCH_CHUNKS rows at most
        counts[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), dtype="<i8")
    mean = counts.mean()
    over = counts - (mean + 4 * np.sqrt(mean) + 4)
    return np.where(over > 0, 1 + np.log2(np.maximum(over, 1)).astype(np.uint8), 0).astype(np.uint8)


def signatures(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set (sorted distinct hashes) for a Jaccard threshold in per cent."""
    return levelled_signatures(tokens, levels, percent)[0]


def levelled_signatures(tokens: np.ndarray, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set and the frequency level of each: that of its token, of a pair the lower one."""
    n = len(tokens)
    need = n - -(-percent * n // 100) + 1
    level = levels[(tokens & np.uint64(len(levels) - 1)).astype(np.int64)]
    rare = tokens[level == 0]
    if len(rare) >= need:
        return mix64(rare[:need]), np.zeros(need, dtype=np.uint8)
    order = np.argsort(level, kind="stable")
    frequent, its_level = tokens[order][len(rare) :], level[order][len(rare) :]
    group = (mix64(frequent) % np.uint64(PAIR_GROUPS)).astype(np.int64)
    first = np.zeros(len(frequent), dtype=bool)
    first[np.unique(group, return_index=True)[1]] = True
    reached = len(rare) + np.cumsum(~first)
    enough = np.flatnonzero(reached >= need)
    complete = len(enough) > 0
    take = int(enough[0]) + 1 if complete else len(frequent)
    out, heat = [mix64(rare)], [np.zeros(len(rare), dtype=np.uint8)]
    for g in np.unique(group[:take]):
        at = np.flatnonzero(group[:take] == g)
        at = at[np.argsort(frequent[at])]
        if len(at) > 1:
            i, j = np.triu_indices(len(at), 1)
            with np.errstate(over="ignore"):
                out.append(mix64(mix64(frequent[at[i]] + np.uint64(2)) + frequent[at[j]]))
            heat.append(np.minimum(its_level[at[i]], its_level[at[j]]))
    if not complete:
        out.append(mix64(tokens[order][:need] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        heat.append(level[order][:need])
    return np.concatenate(out), np.concatenate(heat)


def parts_of(sigs: np.ndarray, heat: np.ndarray, cls: int) -> np.ndarray:
    """The part, from 1, of each signature above ``PART_LEVEL`` in which a class is ordered; 0 for the others.

    A class has one of two places, by a bit of the signature: chains in parts of
    the one kind are so joined by those in parts of the other.
    """
    out = np.zeros(len(sigs), dtype=np.int64)
    hot = np.flatnonzero(heat > PART_LEVEL)
    if len(hot):
        place = mix64(np.asarray([cls, ~cls], dtype=np.int64).view(np.uint64))[(sigs[hot] & np.uint64(1)).astype(np.int64)]
        width = np.uint64(1) << np.minimum(heat[hot] - PART_LEVEL, 30).astype(np.uint64)
        out[hot] = 1 + (place & (width - np.uint64(1))).astype(np.int64)
    return out


def index(docs: DataFrame, levels, k: int, percent: int, firsts) -> DataFrame:
    """``(sig, cls, n, part)`` of every set; equal texts once, equal sets within a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, table = WordHashes(), set(), levels.value
        for batch in batches:
            batch = _first(batch, firsts)
            sigs, keys, sizes, parts, held = [], [], [], [], 0
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k, hashes)
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                own, heat = levelled_signatures(s, table, percent)
                sigs.append(own)
                parts.append(parts_of(own, heat, key))
                keys.append(np.full(len(own), key, dtype=np.int64))
                sizes.append(np.full(len(own), len(s), dtype=np.int64))
                held += len(own)
                if held > 200_000:
                    yield _posting_batch(sigs, keys, sizes, parts)
                    sigs, keys, sizes, parts, held = [], [], [], [], 0
            if sigs:
                yield _posting_batch(sigs, keys, sizes, parts)
        trim_memory()

    return docs.select("row", "text").mapInArrow(run, "sig long, cls long, n long, part long")


def _posting_batch(sigs, keys, sizes, parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(sigs).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (keys, sizes, parts))],
        names=["sig", "cls", "n", "part"],
    )


def hash_bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of a power-of-two table set at the hashes; 16 bits a hash, between 2**20 and 2**``MOST_BITS`` in all."""
    n = hashes.count()
    bits = min(MOST_BITS, max(20, (16 * n).bit_length()))
    width = 1 << (bits - 6)

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros(width, dtype=bool)
        cells[rows["at"].to_numpy()] = True
        return pd.DataFrame({"part": rows["part"].iloc[:1], "cells": [np.packbits(cells, bitorder="little").tobytes()]})

    cell = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    placed = hashes.select(F.shiftright(cell, bits - 6).alias("part"), cell.bitwiseAND(F.lit(width - 1)).alias("at")).distinct()
    table = np.zeros((64, width // 8), dtype=np.uint8)
    for row in placed.groupBy("part").applyInPandas(mark, "part long, cells binary").collect():  # 64 rows, 2**MOST_BITS bits at most
        table[row["part"]] = np.frombuffer(row["cells"], dtype=np.uint8)
    return table.reshape(-1)


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the table; all that are, and a few others."""
    cell = hashes.astype(np.int64) & np.int64(8 * len(table) - 1)
    return (table[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def class_sets(docs: DataFrame, reps: DataFrame, k: int, firsts) -> DataFrame:
    """``(cls, tokens)`` of the classes in ``reps (cls, text_hash)``, from the texts with these hashes.

    A bitmap of the hashes picks the texts where they are read, so that texts are not shuffled; only sets are.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(hash_bitmap(reps, "text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, table = WordHashes(), set(), bitmap.value
        for batch in batches:
            batch = _first(batch, firsts)
            keys, sets = [], []
            for i in np.flatnonzero(marked(table, batch.column(1).to_numpy())).tolist():
                s = shingle_set(batch.column(2)[i].as_py(), k, hashes)
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(s.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], names=["cls", "tokens"]
            )
        trim_memory()

    found = docs.select("row", "text_hash", "text").mapInArrow(run, "cls long, tokens array<long>")
    return found.join(reps.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def not_too_different(pairs: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose parities allow the threshold: at similarity t two sets differ in (1-t)/(1+t) of their sizes at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                (100 + percent) * least_difference(x, y) <= (100 - percent) * (m + n)
                for x, y, m, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    one = parities.select(F.col("cls").alias("a"), F.col("parity").alias("x"), F.col("n").alias("m"))
    two = parities.select(F.col("cls").alias("b"), F.col("parity").alias("y"), F.col("n"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y", "m", "n").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""
    one = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(one, "a").join(two, "b")
        .withColumn("_i", shared)
        .where(100 * F.col("_i") >= percent * (F.size("ta") + F.size("tb") - F.col("_i")))
        .select("a", "b")
    )


def _near_in_size(small: str, large: str, percent: int):
    return 100 * F.col(small) >= percent * F.col(large)


def similar_classes(docs: DataFrame, profiled: DataFrame, levels, k: int, percent: int, firsts) -> DataFrame:
    """``(node, component)`` of the classes that are linked with another.

    First every class is tried against its neighbour, in order of size, under
    each signature: that joins groups of near copies by chains, without
    writing out their pairs. What is left are pairs under one signature whose
    classes still stand in different components; all of those are verified,
    in blocks where a signature has many classes. A signature of frequent
    tokens is ordered in parts, so that no task orders all of its classes;
    which classes meet in a part changes the chains, not the result.
    """
    order = Window.partitionBy("sig", "part").orderBy("n", "cls")
    whole = Window.partitionBy("sig", "part")
    posted = (
        index(docs, levels, k, percent, firsts)
        .withColumn("prev", F.lag("cls").over(order)).withColumn("prev_n", F.lag("n").over(order))
        .withColumn("lo", F.min("cls").over(whole)).withColumn("hi", F.max("cls").over(whole)).withColumn("m", F.count("*").over(whole))
        .where("(part > 0 or lo <> hi) and (prev is null or prev <> cls)")
    )
    shared = stage(posted.select("sig", "part", "cls", "n", "m", "prev", "prev_n"), "postings")
    chain = stage(
        shared.where("prev is not null").where(_near_in_size("prev_n", "n", percent))
        .select(F.least("cls", "prev").alias("a"), F.greatest("cls", "prev").alias("b")).distinct(),
        "chain",
    )
    members = profiled.where("cls is not null").select("cls", "text_hash", "n", "parity")

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()

    def sets_of(classes: DataFrame) -> DataFrame:
        chosen = members.join(stage(classes, "wanted"), "cls", "left_semi").groupBy("cls").agg(F.min("text_hash").alias("text_hash"))
        return stage(class_sets(docs, stage(chosen, "reps"), k, firsts), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        wanted = members.join(stage(both(pairs), "wanted"), "cls", "left_semi")
        parities = stage(wanted.groupBy("cls").agg(F.min("parity").alias("parity"), F.min("n").alias("n")), "parities")
        near = stage(not_too_different(pairs, parities, percent), "near")
        sets = sets_of(both(near))
        out = stage(verify(near, sets, percent), "links")
        drop_stage(sets, parities)
        return out

    edges = linked(chain)
    labels = connected_components(edges)
    # classes of the signatures ordered in parts, where they are more than a list may hold
    counted = shared.where("part > 0").groupBy("sig").agg(F.count("*").alias("in_parts")).where(f"in_parts > {MOST_PAIRED}")
    named = lookup_join(shared.select("sig", "part", "cls", "n", "m"), counted, ["sig"])
    named = named.withColumn("m", F.when(F.col("part") > 0, F.coalesce("in_parts", F.lit(1))).otherwise(F.col("m"))).join(
        labels.select(F.col("node").alias("cls"), F.col("component").alias("c")), "cls", "left"
    ).select("sig", "cls", "n", "m", F.coalesce("c", "cls").alias("c"))
    named = stage(named, "named")
    # at most MOST_PAIRED classes in a list
    lists = named.where(f"m <= {MOST_PAIRED}").groupBy("sig").agg(F.collect_list(F.struct("cls", "n", "c")).alias("l"))
    apart = lambda x, y: (x["cls"] < y["cls"]) & (x["c"] != y["c"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
    mates = F.transform("l", lambda x: F.transform(F.filter("l", lambda y: apart(x, y)), lambda y: F.struct(x["cls"].alias("a"), y["cls"].alias("b"))))
    rest = lists.where(F.size("l") > 1).select(F.explode(F.flatten(mates)).alias("p")).select("p.*").distinct().join(chain, ["a", "b"], "left_anti")
    rest = stage(rest, "rest")
    many = named.where(f"m > {MOST_PAIRED}").select("sig", "cls", "n", "c").distinct()
    open_sigs = many.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("sig")
    large = stage(many.join(open_sigs, "sig"), "open")
    drop_stage(named, shared)
    edges = edges.unionByName(linked(rest))
    if large.take(1):
        in_large = large.select("cls").distinct()
        edges = edges.unionByName(stage(block_links(large, sets_of(in_large), percent), "links"))
    return connected_components(edges)


def block_links(posted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components ``c`` that share one of the signatures of ``posted``.

    Classes stand in blocks of about ``BLOCK`` at most, those with a signature in common close together.
    Each pair of blocks that has a signature in common is one group; it
    compares in numpy and returns only links that join components.
    """
    first = posted.groupBy("cls").agg(F.min("sig").alias("lead"), F.max("c").alias("c"), F.sort_array(F.collect_set("sig")).alias("sigs"))
    first = stage(first, "leads")
    leads = first.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    dealt = F.pmod(F.xxhash64("cls"), F.coalesce("blocks", F.lit(1)))
    blocked = stage(lookup_join(first, leads, ["lead"]).withColumn("block", F.xxhash64("lead", dealt)).drop("lead", "blocks"), "blocks")
    by_sig = stage(blocked.select(F.explode("sigs").alias("sig"), "block").distinct(), "block-sigs")
    mates = (
        by_sig.select("sig", F.col("block").alias("p")).join(by_sig.select("sig", F.col("block").alias("q")), "sig")
        .where("p <= q").select("p", "q").distinct()
    )
    mates = stage(mates, "block-pairs")
    full = stage(blocked.join(sets, "cls"), "block-sets")
    sides = full.join(mates.select(F.col("p").alias("block"), "p", "q"), "block").unionByName(
        full.join(mates.where("p <> q").select(F.col("q").alias("block"), "p", "q"), "block")
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return links_of_blocks(rows, key[0], key[1], percent)

    return sides.groupBy("p", "q").applyInPandas(compare, "a long, b long")


def links_of_blocks(rows: pd.DataFrame, p: int, q: int, percent: int) -> pd.DataFrame:
    one = rows[rows["block"] == p].reset_index(drop=True)
    two = rows[rows["block"] == q].reset_index(drop=True)
    tokens = list(two["tokens"])
    sizes = np.asarray([len(t) for t in tokens], dtype=np.int64)
    names = np.unique(np.concatenate(list(rows["sigs"])))
    has = np.zeros((len(two), len(names)), dtype=bool)
    for i, own in enumerate(two["sigs"]):
        has[i, np.searchsorted(names, own)] = True
    label = {c: c for c in rows["c"]}

    def root(c: int) -> int:
        while label[c] != c:
            label[c] = c = label[label[c]]
        return c

    found, other = [], two["c"].tolist()
    for cls, c, own, mine in zip(one["cls"], one["c"], one["sigs"], one["tokens"], strict=True):
        n = len(mine)
        apart = np.asarray([root(o) for o in other]) != root(c)
        near = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)) & apart
        near &= has[:, np.searchsorted(names, own)].any(axis=1)
        at = np.flatnonzero(near)
        if not len(at):
            continue
        hit = np.isin(np.concatenate([tokens[i] for i in at]), mine)
        both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(sizes[at])[:-1]]), dtype=np.int64)
        for i in at[100 * both >= percent * (sizes[at] + n - both)]:
            if root(other[i]) != root(c):
                found.append((cls, int(two["cls"].iloc[i])))
                label[root(other[i])] = root(c)
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Documents link when the Jaccard similarity of their sets of distinct
    k-word shingles reaches ``percent`` per cent; ``component_id`` is the
    smallest doc_id reachable by links. Fewer than k words make one shingle;
    null, empty and blank texts have none and link with nothing, as a row
    without a partner (component_id = doc_id). Repeated rows are answered one
    by one; rows with a null doc_id link like others but never name a
    component (null if all its members are null). Other columns are not used.
    """
    return _components(docs, text, doc_id, k, percent).drop("text_hash")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _components(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    docs = docs.withColumn("row", _row_hash("doc_id", "text_hash"))
    ids = stage(docs.select("doc_id", "text_hash"), "ids")
    firsts = first_rows(ids)
    profiled = stage(profile(docs, k, firsts), "profile")
    levels = spark.sparkContext.broadcast(frequency_levels(profiled))
    texts = profiled.where("n is not null").groupBy("text_hash").agg(F.min("n").alias("n"), F.min("cls").alias("cls"))
    rows = stage(ids.join(texts, "text_hash").select("doc_id", "text_hash", "n", "cls"), "rows")
    linked = similar_classes(docs, profiled, levels, k, percent, firsts)
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = stage(
        classes.join(linked.select(F.col("node").alias("cls"), "component"), "cls", "left")
        .select("cls", "least", F.coalesce("component", "cls").alias("component")),
        "class-labels",
    )
    least = stage(named.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    of_class = stage(named.join(least, "component").select("cls", "component_id"), "class-components")
    return rows.join(of_class, "cls", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each group of linked documents: the one with the smallest id.

    Rows without a shingle stay, and so do rows without an id. Of repeated
    rows (same id and text) one stays.
    """
    answer = stage(_components(docs, text, doc_id, k, percent), "near-copies")
    leaves = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    gone = answer.where(leaves).select("doc_id", "text_hash").distinct()
    stays = answer.where(~leaves).select(_row_hash("doc_id", "text_hash").alias("row")).distinct()
    again = answer.where("doc_id = component_id").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")

    # two bitmaps settle most rows where they are read, kept or not, so that their texts are not shuffled; the few that both mark are looked up
    gone, again = stage(gone, "gone"), stage(again, "again")
    sc = docs.sparkSession.sparkContext
    out = sc.broadcast(hash_bitmap(stage(gone.unionByName(again).select(_row_hash("doc_id", "text_hash").alias("row")), "out"), "row"))
    kept = sc.broadcast(hash_bitmap(stage(stays, "stays"), "row"))

    @F.pandas_udf("int")
    def settled(hashes: pd.Series) -> pd.Series:
        """0: stays, 1: gone, 2: to be looked up."""
        hashes = hashes.to_numpy()
        return pd.Series(marked(out.value, hashes).astype(np.int32) * (1 + marked(kept.value, hashes)))

    rows = docs.withColumn("_hash", _text_hash(text)).withColumn("_settled", settled(_row_hash(F.col(doc_id).cast("long"), "_hash")))

    def listed(frame: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        return frame.join(ids.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")), (F.col(doc_id) == F.col("_id")) & (F.col("_hash") == F.col("_h")), how)

    looked_up = listed(rows.where("_settled = 2"), gone, "left_anti")
    found = rows.where("_settled = 0").unionByName(listed(looked_up, again, "left_anti"))
    found = found.unionByName(listed(looked_up, again, "left_semi").dropDuplicates([doc_id, "_hash"]))
    return found.select(*docs.columns)


def jaccard_query(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB SQL of :func:`jaccard_query`: shared shingles counted by pair, links followed to the least doc_id.
ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.i >= 85 * (m.n + n.n - p.i)
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""
