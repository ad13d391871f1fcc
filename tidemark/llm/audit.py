"""How filters interact: what each removes in every order, counted from one pass over the bytes."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, staged
from tidemark.llm.spans import first_like, padded
from tidemark.llm.words import in_parts, pieces, text_bytes

# What the transducer tells bytes apart by. END isn't a byte of UTF-8: it is written behind each text.
PLAIN, GAP, CAPITAL, SYMBOL, TAIL, END = range(6)
END_BYTE = 0xFF
SYMBOLS = b"#$%&*|"
# Its two states are whether the byte before was of a word. What it says about a byte, as bits:
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_TAIL = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    table = np.full(256, PLAIN, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = GAP
    table[65:91] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = TAIL
    table[END_BYTE] = END
    return table


def _says() -> np.ndarray:
    """What is said in each state (rows) about each class (columns)."""
    table = np.zeros((2, 6), np.uint8)
    table[0, [PLAIN, CAPITAL, SYMBOL, TAIL]] |= BEGINS
    table[1, [GAP, END]] |= ENDS
    table[:, CAPITAL] |= IS_CAPITAL
    table[:, SYMBOL] |= IS_SYMBOL
    table[:, TAIL] |= IS_TAIL
    return table


CLASSES, SAYS = _classes(), _says()
IN_WORD = np.array([c not in (GAP, END) for c in range(6)], np.uint8)  # the state behind each class
COUNTS = ("words", "distinct_words", "capitals", "code_points", "symbols")


def transduce(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each text; text i is data[bounds[i] : bounds[i + 1]]."""
    sizes = np.diff(bounds)
    tape = np.full(len(data) + len(sizes), END_BYTE, np.uint8)
    tape[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
    ends = bounds[1:] + np.arange(len(sizes))  # of the end marks
    classes = CLASSES[tape]
    state = np.concatenate([[0], IN_WORD[classes[:-1]]])
    said = SAYS[state, classes]

    def per_text(bit: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(said & bit), ends), prepend=0)

    starts = np.flatnonzero(said & BEGINS)
    lengths = np.flatnonzero(said & ENDS) - starts
    owner = np.searchsorted(ends, starts)
    new = first_like(padded(tape), starts, lengths, owner) == np.arange(len(starts))
    return {
        "words": per_text(BEGINS),
        "distinct_words": np.bincount(owner[new], minlength=len(sizes)),
        "capitals": per_text(IS_CAPITAL),
        "code_points": sizes - per_text(IS_TAIL),
        "symbols": per_text(IS_SYMBOL),
    }


def text_counts(docs: DataFrame) -> DataFrame:
    """The columns of `docs` but `text`, and COUNTS of the text as longs.

    Words lie between ASCII white space and are told apart by all their bytes; capitals are A-Z, symbols
    `#$%&*|`. A null text is empty. A long text is worked on whole, in memory in proportion to it.
    A column named as one of COUNTS must not exist.
    """
    clash = {c.lower() for c in docs.columns} & set(COUNTS)
    if clash:
        raise ValueError(f"the documents have columns {sorted(clash)} already")
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            found = [transduce(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in pieces(bounds)]
            counts = [pa.array(np.concatenate([f[c] for f in found]).astype(np.int64)) for c in COUNTS] if found else []
            if counts:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + counts, names=[*kept, *COUNTS])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def text_failures() -> list[Column]:
    """The conditions of filters A to D over COUNTS: short, repetitive, shouting, symbols."""
    words, distinct, capitals, points, symbols = map(F.col, COUNTS)
    return [words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, symbols > 0]


def _bits(failures: list[Column]) -> Column:
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures)), F.lit(0))


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many rows of each part fail just the filters whose bits are set.

    Bits 0 to 3 are `text_failures`; bit 4 says that a row with a smaller doc_id has the same text.
    `good` and `toxic` count the rows that have a label row with quality 1, with toxic 1.

    * `part` is lang, null as the empty string. A null text is empty. Texts are equal by SHA-256.
    * A null doc_id is neither smaller nor larger than another and has no label. Rows that share a
      doc_id are not smaller than each other. Contradicting labels count if any of them says 1.
    * An empty table gives no rows. Other columns are not read.

    Copies are counted per text, part and label before any exchange by text, so that a text in a third of
    all rows leaves each task as a few rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), "text"
    )
    fails = _bits(text_failures()).alias("fails")
    yes = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).cast("int").alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(*yes).where("good + toxic > 0")
    keys = ["digest", "part", "fails", "good", "toxic"]
    with Scratch(docs.sparkSession) as scratch:
        read = scratch.staged(text_counts(rows).select("doc_id", "part", "digest", fails), "audit-rows")
        same = read.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
        known = same.where("doc_id is not null").join(said, "doc_id", "left").fillna(0, ["good", "toxic"])
        copies = known.groupBy(*keys).agg(
            F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first")
        )
        least = F.min("first").over(Window.partitionBy("digest"))
        spared = F.when(F.col("first") == least, F.col("n_first")).otherwise(0)
        split = F.explode(
            F.array(
                F.struct(F.col("fails").alias("mask"), F.col("spared").alias("n")),
                F.struct((F.col("fails") + 16).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
            )
        )
        cells = copies.withColumn("spared", spared).select("part", "good", "toxic", split.alias("cell"))
        unknown = read.where("doc_id is null").groupBy("part", F.col("fails").alias("mask")).agg(F.count("*").alias("n"))
        cells = cells.select("part", "cell.mask", "cell.n", "good", "toxic").unionByName(
            unknown.withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
        )
        counted = cells.groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
        )
        return staged(counted.where("n > 0"), "audit-masks")


def interactions(masks: DataFrame, filters: int = 5) -> DataFrame:
    """One row per part, order of the filters and step, from `failure_masks` (or rows like them).

    Filters are named A, B, C ... by their bits; an order is a string of the names, applied left to right.
    kept: rows left after the step; removed: here; redundant: fail this filter but went before;
    unique_fails: fail no other; good_lost, toxic_lost: labelled ones removed here; shapley: what the
    filter removes, summed over all orders. All are exact sums over at most 2^filters cells a part.

    A part is one row until its orders are written out, so nothing is gathered but its cells.
    """
    names = string.ascii_uppercase[:filters]
    orders = ",".join("".join(p) for p in permutations(names))
    order, step, mask = F.col("filter_order"), F.col("step"), F.col("c.mask")
    bit_of = {name: 1 << i for i, name in enumerate(names)}
    here = F.substring(order, step, F.lit(1))
    bit = sum((F.when(here == n, b).otherwise(0) for n, b in bit_of.items()), F.lit(0))
    seen = sum((F.when(F.instr(order, n) < step, b).otherwise(0) for n, b in bit_of.items()), F.lit(0))
    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = (
        cells.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(filters))))
        .withColumn("bit", bit)
        .withColumn("seen", seen)
    )

    def total(condition, value=lambda c: c["n"]) -> Column:
        one = lambda a, c: a + F.when(condition(c["mask"]), value(c)).otherwise(F.lit(0).cast("long"))
        return F.aggregate("cells", F.lit(0).cast("long"), one)

    bit, seen = F.col("bit"), F.col("seen")
    fails = lambda m: m.bitwiseAND(bit) != 0
    went = lambda m: m.bitwiseAND(seen) != 0
    goes = lambda m: fails(m) & ~went(m)
    orders_each = F.array(*[F.lit(math.factorial(filters) // (i + 1)) for i in range(filters)])
    share = lambda c: c["n"] * F.element_at(orders_each, F.bit_count(c["mask"]))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~went(m)).alias("kept"),
        total(goes).alias("removed"),
        total(lambda m: fails(m) & went(m)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(goes, lambda c: c["good"]).alias("good_lost"),
        total(goes, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`interactions` of the five filters over `docs` (doc_id, text, lang) and `labels` (doc_id, quality, toxic);
    `failure_masks` says what is done with nulls, repeated rows, long texts and empty tables."""
    return interactions(failure_masks(docs, labels))
