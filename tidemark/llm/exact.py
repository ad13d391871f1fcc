"""Exact duplicates by a 128-bit hash of the text, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_case, narrow_side, staged


def exact_duplicates(docs: DataFrame, keep: str = "smallest", fold: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Rows of equal text form a group; with `fold`, A-Z are lower-cased first. The row with the
    smallest (or largest) doc_id of a group stays and names it.

    * A null text is an empty one. Empty texts are equal to each other.
    * A null doc_id loses against any other; a group of null ids only has a null keep_id, and its
      rows stay.
    * Rows that repeat both id and text are the same document: all of them carry the same verdict.
    * An empty table gives no rows. Other columns are not read.

    Groups are never gathered: sizes, ids and the byte comparison are combined aggregates, so that
    a text repeated in a third of all rows leaves each task as one row.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    pick = F.min if keep == "smallest" else F.max
    text = fold_case(F.col("text")) if fold else F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("body")).withColumn("hash", F.unhex(F.md5("body")))

    keys = staged(texts.select("doc_id", "hash", F.sha2("body", 256).alias("text_sha256")), "exact-keys")
    groups = staged(
        keys.groupBy("hash").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "exact-groups",
    )

    # Only texts of repeated hashes are compared. min = max says that all bytes of a group agree.
    repeated = groups.where("group_size > 1").select("hash")
    copies = texts.join(narrow_side(repeated), "hash")
    collided = staged(
        copies.groupBy("hash")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .where("low <> high")
        .select("hash"),
        "exact-collisions",
    )

    def verdict(rows: DataFrame) -> DataFrame:
        return rows.select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        )

    if not collided.limit(1).count():
        return verdict(keys.join(groups, "hash"))
    # Different texts under one hash are told apart by the text itself.
    apart = copies.join(collided, "hash", "left_semi").withColumn("text_sha256", F.sha2("body", 256))
    subgroups = apart.groupBy("hash", "body").agg(
        pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    plain = keys.join(collided, "hash", "left_anti").join(groups, "hash")
    return verdict(plain).unionByName(verdict(apart.join(subgroups, ["hash", "body"])))


def without_exact_duplicates(docs: DataFrame, keep: str = "smallest", fold: bool = False) -> DataFrame:
    """The rows of `docs` that stay, once each; every column is passed through."""
    verdicts = exact_duplicates(docs, keep, fold)
    stay = verdicts.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    text = fold_case(F.col("text")) if fold else F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn("__own", F.sha2(text, 256))
    kept = marked.join(stay, marked["doc_id"].eqNullSafe(stay["__id"]) & (marked["__own"] == stay["__sha"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "__own"]).select(*[kept[c] for c in docs.columns])
