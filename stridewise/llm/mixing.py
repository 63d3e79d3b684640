"""Mixing sources to target weights by weighted random keys (Efraimidis-Spirakis) and prefix sums.

Whole epochs of a source come first; the rest of its target is filled by the
documents with the smallest keys. The keys are a hash of the document, so a
rerun or a recomputed task selects the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import running_before, stage, word_array

#: Weights of the sources in order, repeating, and the most epochs of a source.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3

ROWS_PER_BIN = 10_000
LEAST_BINS = 256


def with_keys(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: str = "mix", quality: Column | None = None
) -> DataFrame:
    """Adds ``_size`` (words), ``_key`` (exponential, rate = quality weight) and ``_x`` (the key mapped to [0, 1)).

    The quality weight of a document defaults to its share of distinct
    words, at least 0.05: repetitive texts come late in the order.
    """
    if quality is None:
        quality = F.greatest(F.lit(0.05), F.try_divide(F.size(F.array_distinct("_words")).cast("double"), F.col("_size").cast("double")))
    digest = F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))).cast("binary")
    )
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return (
        docs.withColumn("_words", word_array(F.col(text)))
        .withColumn("_size", F.size("_words").cast("long"))
        .withColumn("_quality", F.coalesce(quality, F.lit(0.05)))
        .withColumn("_key", -F.log(unit) / F.col("_quality"))
        .withColumn("_x", F.col("_key") / (F.col("_key") + 1))
        .drop("_words", "_quality")
    )


def source_targets(thin: DataFrame, source: str, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row a source: ``_source_size``, ``_target``.

    Sources in code point order, null last, take the weights in turn. A
    target stops at ``most_epochs`` times the source's size; what is over is
    shared among the others by weight until none is above (the level of the
    first source, by size over weight, that stays below its stop).
    """
    per = thin.groupBy(source).agg(F.sum("_size").alias("_source_size"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    by_room = Window.orderBy(F.col("_source_size") / F.col("_weight"), F.col(source).asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("_source_size").over(everything) - F.coalesce(F.sum(most_epochs * F.col("_source_size")).over(before), F.lit(0))
    ).cast("double") / F.sum("_weight").over(onward).cast("double")
    stop = (most_epochs * F.col("_source_size")).cast("double")
    ranked = per.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long"))
    levelled = ranked.withColumn("_level", level).withColumn("_stopped", F.col("_level") * F.col("_weight") > stop)
    common = F.min(F.when(~F.col("_stopped"), F.struct(F.col("_source_size") / F.col("_weight"), F.col("_level").alias("v")))).over(everything)["v"]
    return levelled.select(
        source, "_source_size", F.when(F.col("_stopped"), stop).otherwise(common * F.col("_weight")).alias("_target")
    )


def source_cuts(thin: DataFrame, source: str, targets: DataFrame) -> DataFrame:
    """Adds to ``targets`` the whole epochs and the bin and key where the fractional selection of a source ends.

    The keys are first summed in bins per source (combined before the
    shuffle); only the rows of the one bin in which a source's target ends
    are then put in order, so that no task sorts a whole source.
    """
    rows = thin.count()
    bins = LEAST_BINS
    while bins * ROWS_PER_BIN < rows:
        bins *= 2
    binned = thin.withColumn("_bin", F.floor(F.col("_x") * bins))
    per_bin = binned.groupBy(source, "_bin").agg(F.sum("_size").alias("_sum"))
    cuts = targets.withColumn(
        "_epochs", F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    ).withColumn("_rest", F.col("_target") - F.col("_epochs") * F.col("_source_size"))
    sums = running_before(per_bin, [source], ["_bin"], "_sum", "_before")
    end = (
        sums.alias("s").join(cuts.alias("c"), F.col(f"s.{source}").eqNullSafe(F.col(f"c.{source}")))
        .where("s._before <= c._rest and c._rest < s._before + s._sum")
        .select("c.*", F.col("s._bin").alias("_cut_bin"), "s._before")
    )
    end = stage(end, "mix-end")
    last = (
        binned.alias("d").join(end.alias("e"), F.col(f"d.{source}").eqNullSafe(F.col(f"e.{source}")) & (F.col("d._bin") == F.col("e._cut_bin")))
        .select(F.col(f"e.{source}").alias(source), "e._rest", "e._before", "d._size", "d._key")
    )
    w = Window.partitionBy(source).orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        last.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_size").over(w), F.lit(0)) + F.col("_size") / 2)
        .where("_at <= _rest").groupBy(source).agg(F.max("_key").alias("_cut_key"))
    )
    cuts = (
        cuts.alias("c").join(end.alias("e"), F.col(f"c.{source}").eqNullSafe(F.col(f"e.{source}")), "left")
        .join(chosen.alias("k"), F.col(f"c.{source}").eqNullSafe(F.col(f"k.{source}")), "left")
        .select("c.*", "e._cut_bin", "k._cut_key", F.lit(bins).alias("_bins"))
    )
    return stage(cuts, "mix-cuts")


def take(keyed: DataFrame, source: str, cuts: DataFrame) -> DataFrame:
    """``keyed`` plus size, source_size, target, copies (how often the mix takes the row) and taken (words)."""
    at = F.floor(F.col("d._x") * F.col("c._bins"))
    partial = (at < F.col("c._cut_bin")) | ((at == F.col("c._cut_bin")) & (F.col("d._key") <= F.col("c._cut_key")))
    own = [c for c in keyed.columns if c not in {"_size", "_key", "_x", "size", "source_size", "target", "copies", "taken"}]
    return (
        keyed.alias("d").join(cuts.alias("c"), F.col(f"d.{source}").eqNullSafe(F.col(f"c.{source}")))
        .select(
            *[F.col(f"d.`{c}`") for c in own],
            F.col("d._size").alias("size"),
            F.col("c._source_size").alias("source_size"),
            F.col("c._target").alias("target"),
            F.when(F.col("d._size") == 0, F.lit(0)).otherwise(
                F.col("c._epochs") + F.when(F.coalesce(partial, F.lit(False)), 1).otherwise(0)
            ).cast("long").alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """Every document with size, source_size, target, copies and taken.

    Null texts have size 0; a null source is a source of its own; documents
    without words are never taken; an empty table gives an empty table;
    repeated rows (same id and text) share one key and are taken or left
    together. Own columns that clash are replaced.
    """
    keyed = with_keys(docs, text, doc_id)
    if keep_text:
        thin = stage(keyed.select(source, "_size", "_key", "_x"), "mix-keys")
    else:
        keyed = stage(keyed.drop(text), "mix-keys")
        thin = keyed
    cuts = source_cuts(thin, source, stage(source_targets(thin, source), "mix-targets"))
    return take(keyed, source, cuts)


def mixed_documents(docs: DataFrame, **names: str) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with the columns of ``docs``."""
    mixed = mix_sources(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])), **names)
    return (
        mixed.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")
    )


def mixing_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
with t as (select doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                  (cast(('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 13)) as bigint)
                   + 0.5) / 4503599627370496.0 as u
           from documents),
d as (select doc_id, source, cast(len(w) as bigint) as size,
             -ln(cast(u as double)) / coalesce(greatest(0.05, len(list_distinct(w)) / nullif(cast(len(w) as double), 0)), 0.05) as k
      from t),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
r as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s),
l as (select *, cast(sum(source_size) over () - coalesce(sum(3 * source_size) over before, 0) as double)
                / cast(sum(weight) over onward as double) as level
      from r
      window before as (order by cast(source_size as double) / weight, source nulls last rows between unbounded preceding and 1 preceding),
             onward as (order by cast(source_size as double) / weight, source nulls last rows between current row and unbounded following)),
c as (select *, level * weight > 3 * source_size as stopped from l),
g as (select source, source_size,
             case when stopped then cast(3 * source_size as double)
                  else weight * (select arg_min(level, cast(source_size as double) / weight) from c where not stopped) end as target
      from c),
e as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from g),
o as (select d.doc_id, d.size, e.source_size, e.target, e.epochs,
             coalesce(sum(d.size) over (partition by d.source order by d.k rows between unbounded preceding and 1 preceding), 0)
             + d.size / 2.0 <= e.target - e.epochs * e.source_size as chosen
      from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target,
       cast(size * (epochs + case when chosen then 1 else 0 end) as bigint) as taken
from o
"""
