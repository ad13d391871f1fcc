"""Substring search over a column through postings of its trigrams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.guards import contains_ci
from tidemark.sources.partitions import PartitionedTable, Section

SIZE = 3
BUCKETS = 32
POSTINGS, COUNTS = "postings", "counts"
ROW = "row_hash"
RAREST = 4  # trigrams of a needle that are looked up


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text in lower case; none of a null or shorter one."""
    letters = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("(?s)."), F.lit(0))

    def runs(of: Column) -> Column:
        spots = F.when(F.size(of) >= SIZE, F.sequence(F.lit(0), F.size(of) - SIZE)).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: F.concat(*[F.get(of, i + k) for k in range(SIZE)]))

    # As an element of a list the letters are taken apart once, not for every run.
    return F.array_distinct(F.transform(F.array(letters), runs)[0])


def literals(needle: str) -> list[str]:
    """The parts of a needle between its wildcards `%` and `_`; after a backslash these stand for themselves."""
    parts, escaped = [""], False
    for letter in needle.lower():
        if escaped or letter not in "%_\\":
            parts[-1] += letter
        elif letter != "\\":
            parts.append("")
        escaped = letter == "\\" and not escaped
    return [p for p in parts if p]


def needed(needle: str) -> list[str]:
    """Trigrams that every match has; empty if the needle has no literal part of three letters."""
    return sorted({part[i : i + SIZE] for part in literals(needle) for i in range(len(part) - SIZE + 1)})


class TrigramIndex:
    """Postings (trigram, hash of the key) of a text column, in buckets by trigram, and how many rows have each.

    A needle is looked up by its rarest trigrams; rows that have all of them are candidates. They are
    checked against the text itself, so rows whose keys share a hash do no harm and the answer is that of a scan: `%` and `_` stay wildcards and case is
    folded. A needle without three letters in a row has no trigram and is searched for by a scan.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.StructType, column: str) -> None:
        """`key` has the columns that tell rows apart, `column` is the text that is searched."""
        self.spark, self.column, self.key = spark, column, key.fieldNames()
        gram, bucket = T.StructField("gram", T.StringType()), T.StructField("bucket", T.IntegerType())
        self.table = PartitionedTable(spark, path, {
            # A key may be long and a text has hundreds of trigrams; eight bytes say which row is meant.
            POSTINGS: Section(T.StructType([gram, T.StructField(ROW, T.LongType()), bucket]), "bucket", ("gram",)),
            COUNTS: Section(T.StructType([gram, T.StructField("rows", T.LongType()), bucket]), "bucket", ("gram",)),
        })

    def build(self, rows: DataFrame) -> None:
        """Index all rows anew; a row leaves its task once per distinct trigram, in the bucket of the trigram."""
        base = self.table.state()
        gram = F.explode(trigrams(F.col(self.column))).alias("gram")
        named = rows.select(F.xxhash64(*self.key).alias(ROW), gram)
        postings = self.table.write(POSTINGS, named.withColumn("bucket", _bucket(F.col("gram"))))
        written = self.table.open(POSTINGS, postings.folders)
        counts = self.table.write(COUNTS, written.groupBy("gram", "bucket").agg(F.count(F.lit(1)).alias("rows")))
        self.table.publish(base, {
            s: {**dict.fromkeys(base.of(s), ()), **load.folders} for s, load in ((POSTINGS, postings), (COUNTS, counts))
        })

    def _read(self, section: str, grams: Sequence[str]) -> DataFrame:
        """The rows of some trigrams, from their buckets alone."""
        named = self.spark.createDataFrame([(g,) for g in grams], "gram string")
        buckets = [r[0] for r in named.select(_bucket(F.col("gram"))).distinct().collect()]
        return self.table.read(section, buckets).where(F.col("gram").isin(list(grams)))

    def candidates(self, needle: str) -> DataFrame | None:
        """Hashes of the keys of rows that have the needle's rarest trigrams, from the postings alone; None if it
        has no trigram."""
        grams = needed(needle)
        if not grams:
            return None
        found = self._read(COUNTS, grams).orderBy("rows", "gram").collect()  # at most as many as the needle has
        if len(found) < len(grams):
            return self.table.open(POSTINGS, {}).select(ROW)  # one of them occurs nowhere
        rarest = [r["gram"] for r in found[:RAREST]]
        hits = self._read(POSTINGS, rarest).groupBy(ROW).agg(F.countDistinct("gram").alias("n"))
        return hits.where(F.col("n") == len(rarest)).select(ROW)

    def search(self, rows: DataFrame, needle: str) -> DataFrame:
        """The rows whose column contains the needle, exactly as `contains_ci` finds them in a scan."""
        matches = contains_ci(F.col(self.column), needle)
        found = self.candidates(needle)
        if found is None:
            return rows.where(matches)
        same = F.xxhash64(*[rows[c] for c in self.key]) == found[ROW]
        return rows.join(found, same, "left_semi").where(matches)


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")
