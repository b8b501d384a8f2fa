"""Mixing sources to target weights by weighted reservoir keys (Efraimidis and Spirakis).

DataFrame functions only. Every document gets the exponential key -ln(u) / weight, where u is
a uniform number hashed from the document and a seed; ascending keys are a weighted sample
without replacement of any prefix. A source takes whole epochs first; the rest of its budget
goes to documents in key order, by prefix sums of their sizes, and the document at the edge
gives only the words that still fit.

A source may hold most rows: prefix sums go by ranges of the key. Each source has about the
square root of its number of documents as ranges; range sums are prefix-summed per source, and
documents only inside their range.

Defined cases: a null text has size 0 and takes nothing; null is a source of its own, the last
one; a null, zero or negative quality weight counts as the smallest weight; repeated rows are
documents of their own (ties in the key are broken by doc_id and size, and rows that agree in
all of these are alike); an empty table gives no rows. ``mix`` keeps other columns, unless they
have the name of a result or one of the names in its list of own columns; ``apply_mix`` keeps
all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, set_aside, written

SMALLEST_WEIGHT = 1e-6


def word_count(text: Column) -> Column:
    """Number of words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) hashed from columns; equal on every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets of sources. ``sizes``: one row a source (source, source_size, n_docs).

    Sources in code-point order, null last, weigh ``weights``, repeating. They share ``share``
    times the total size by weight, none above ``most`` times its own size; the excess is
    reshared by weight. That is the level L at which sum(min(most * size, L * weight)) is the
    whole: sources are filled in ascending order of most * size / weight, and L follows from
    prefix sums. The windows here run over one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    listed = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighed = sizes.withColumn("_weight", listed).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(rest)
    leveled = weighed.withColumn("_level", level)
    unfilled = F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.col("_level"))
    # Filled sources come first, so the first level that its own source bears is the level.
    found = leveled.withColumn("_found", F.first(unfilled, ignorenulls=True).over(everything))
    target = F.when(F.col("_found").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_found") * F.col("_weight"))
    )
    return found.select("source", "source_size", "n_docs", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0,
        seed: int = 20, text: str = "text", quality: DataFrame | None = None) -> DataFrame:
    """What the mix takes of each document: the columns of ``docs`` but the text, with size,
    source_size, target (its source's), taken (words, repeats counted) and text_hash. ``quality``
    has positive weights (doc_id, weight), averaged per doc_id; documents without one weigh 1.
    The sized rows without texts are written once; texts are never shuffled."""
    own = {"size", "source_size", "target", "taken", "text_hash", "n_docs",
           "_key", "_range", "_range2", "_q", "_qid", "_source", "_mean", "_base", "_sum", "_in"}
    kept = [c for c in docs.columns if c not in own and c != text]
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], word_count(F.col(text)).alias("size"),
                        F.xxhash64(F.col(text)).alias("text_hash"))
    q = F.lit(1.0)
    if quality is not None:
        per_doc = quality.groupBy(F.col("doc_id").alias("_qid")).agg(F.avg(F.col("weight").cast("double")).alias("_q"))
        sized = sized.join(per_doc, F.col("doc_id") == F.col("_qid"), "left").drop("_qid")
        q = F.coalesce(F.col("_q"), F.lit(1.0))
        q = F.when(F.isnan(q) | (q < SMALLEST_WEIGHT), F.lit(SMALLEST_WEIGHT)).otherwise(q)
    key = -F.log(uniform(seed, F.col("doc_id"), F.col("text_hash"))) / q
    sized = written(sized.withColumn("_key", key).drop("_q"), "mix-sized")

    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"), F.avg("_key").alias("_mean")
    )
    means = sources.select(F.col("source").alias("_s2"), F.col("_mean"))
    targets = source_targets(sources.drop("_mean"), weights, share, most)
    targets = targets.join(means, F.col("source").eqNullSafe(F.col("_s2"))).drop("_s2")
    # A written table on either side, so that a hot source can be split in the join.
    targets = written(targets.withColumnRenamed("source", "_source"), "mix-targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    # Ranges of the key: 1 - exp(-key / mean) is about uniform and rises with the key.
    n = F.ceil(F.sqrt("n_docs"))
    place = F.when(F.col("_mean") > 0, F.lit(1.0) - F.exp(-F.col("_key") / F.col("_mean"))).otherwise(F.lit(0.0))
    ranged = joined.withColumn("_range", F.floor(place * n).cast("long")).drop("_mean", "n_docs")

    sums = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("source").alias("_source"), F.col("_range").alias("_range2"),
                        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        bases, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_range2"))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - epochs * F.col("source_size") - F.col("_base") - F.col("_in")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest))
    return placed.select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target",
                         taken.cast("long").alias("taken"), "text_hash")


def apply_mix(docs: DataFrame, mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mixed rows: each document as often as ``mixed`` takes it whole, and once more with the
    first words (joined by one blank) where it takes a part. The columns of ``docs``; n_chars
    follows a cut text. Rows that agree in doc_id and text share out their group's takes."""
    named, docs = docs.columns, set_aside(docs, ("doc_id", "n_chars", text))
    takes = (
        mixed.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .agg(F.sort_array(F.collect_list(F.struct("taken", "size")), asc=False).alias("__takes"))
    )
    number = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy(F.lit(1)))
    joined = docs.withColumn("__own", F.xxhash64(F.col(text))).join(
        takes, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))
    ).withColumn("__take", F.element_at("__takes", number))
    whole = F.when(F.col("__take.size") > 0, F.floor(F.col("__take.taken") / F.col("__take.size"))).otherwise(F.lit(0))
    part = F.col("__take.taken") - whole * F.col("__take.size")
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    rows = joined.withColumn("__words", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), 1, F.col("__words").cast("int")), " ")
    new = F.when(F.col("__words") > 0, cut).otherwise(F.col(text))
    out = rows.withColumn(text, new)
    if "n_chars" in docs.columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("__words") > 0, length).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns]).toDF(*named)
