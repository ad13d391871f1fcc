"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import narrow_side, staged

GAP = "\\x20\\x09-\\x0D"
SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none. Each word with the space behind it becomes one
    letter, so a text is counted without a list of its words."""
    words = F.regexp_replace(F.ltrim(text, F.lit(SPACES)), f"[^{GAP}]+[{GAP}]*", "w")
    return F.coalesce(F.length(words), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, target for one row (source, source_size) per source.

    Sources in code-point order (null last) take the weights in turn and share the total size.
    A target stops at `most` times its source's size; the excess goes to the others by weight
    until none is above its limit. That end point is one level for all sources that are not at their
    limit: the sources are walked in the order in which they reach it.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("place"))
    walked = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = walked.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sizes.withColumn("place", ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("full_at", F.col("limit").cast("double") / F.col("weight"))
        .withColumn("step", F.row_number().over(walked))
        .withColumn("left_size", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left_size").cast("double") / F.col("left_weight"))
    )
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("step"))).over(everything)
    rows = rows.withColumn("first", first)
    level = F.max(F.when(F.col("step") == F.col("first"), F.col("level"))).over(everything)
    capped = F.col("first").isNull() | (F.col("step") < F.col("first"))
    target = F.when(capped, F.col("limit").cast("double")).otherwise(
        F.least(F.col("level_at") * F.col("weight"), F.col("limit").cast("double"))
    )
    return rows.withColumn("level_at", level).select("source", "source_size", target.alias("target"))


def fraction(seed: int, doc_id: Column) -> Column:
    """A number in [0, 1) from 52 bits of a keyed hash of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: int = 11, size: Column | None = None
) -> DataFrame:
    """Every row of `docs` with a struct column `mix`: size, source_size, target, copies, taken.

    A source's rate is target / size. Each document is taken floor(rate) times, and once more if a
    number hashed from seed and doc_id is below the rest of the rate; a rerun takes the same. `size` is
    the words of `text` unless another column is given.

    * A null text has size 0. A source without words has target and rate 0.
    * Null sources are one source, the last. Rows of the same doc_id are decided alike.
    * A long text is counted whole; only its words' number of letters is held beside it.
    * An empty table gives no rows. A column named `mix` must not exist; others pass through.
    """
    if "mix" in {c.lower() for c in docs.columns}:
        raise ValueError("the documents have a column mix already")
    size = word_count(F.col("text")) if size is None else F.coalesce(size.cast("long"), F.lit(0).cast("long"))
    sizes = docs.select("source", size.alias("size"))
    sources = staged(
        source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most),
        "mix-sources",
    )
    share = sources.select(F.col("source").alias("__name"), F.struct("source_size", "target").alias("__share"))
    rate = F.when(F.col("__share.source_size") > 0, F.col("__share.target") / F.col("__share.source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = (whole + (fraction(seed, F.col("doc_id")) < rate - whole).cast("int")).cast("int")
    joined = docs.join(narrow_side(share), docs["source"].eqNullSafe(share["__name"]))
    mix = F.struct(
        size.alias("size"), F.col("__share.source_size").alias("source_size"),
        F.col("__share.target").alias("target"), copies.alias("copies"), (copies * size).alias("taken"),
    )
    return joined.withColumn("mix", mix).drop("__name", "__share")


def mix_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: int = 11) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of `docs`."""
    rows = mixed(docs, weights, most, seed)
    times = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies")))
    return rows.select(*[rows[c] for c in docs.columns], times.alias("__copy")).drop("__copy")
