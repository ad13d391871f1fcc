"""Bronze: landed documents, one envelope of pages per source and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import iso_day
from tidemark.sources.documents import RANGE_BYTES, read_documents
from tidemark.sources.registry import DOCUMENT, get_source

# An envelope is one row and one file. Beyond this many pages a pull is split over several envelopes,
# which say what the numbers of their pages are, so that no task ever holds an unbounded pull.
PAGES_PER_ENVELOPE = 500


def envelopes(
    pages: DataFrame, per_envelope: int = PAGES_PER_ENVELOPE, page_count: int | None = None
) -> DataFrame:
    """Wrap rows of (source, logical_date, fetched_at, page_no, page) into envelopes.

    `page_no` counts within a pull: a source, day and fetch. `page_count` is that of the whole pull, in
    each of its envelopes; `page_numbers` has the numbers of the pages inside, and `extras` what the
    pages have as `extra`.

    Pages are only ever brought together with those of their envelope. The pages of a pull are counted
    apart, unless the caller knows their number because there is just one pull.
    """
    pull = ["source", "logical_date", "fetched_at"]
    part = F.floor(F.col("page_no") / per_envelope).alias("part")
    extra = [c for c in ("extra",) if c in pages.columns]
    # Not every page can be compared with another, so only the numbers are.
    numbered = F.array_sort(
        F.collect_list(F.struct("page_no", "page", *extra)),
        lambda a, b: F.signum(a["page_no"] - b["page_no"]).cast("int"),
    )
    parts = pages.groupBy(*pull, part).agg(numbered.alias("numbered"))
    if page_count is None:
        counts = pages.groupBy(*pull).agg(F.count(F.lit(1)).alias("__pages")).withColumnsRenamed({c: f"__{c}" for c in pull})
        same = [parts[c].eqNullSafe(counts[f"__{c}"]) for c in pull]
        parts, count = parts.join(counts, same), F.col("__pages")
    else:
        count = F.lit(page_count)
    return parts.select(
        *pull,
        count.cast("int").alias("page_count"),
        F.col("numbered.page").alias("pages"),
        F.transform("numbered.page_no", lambda n: n.cast("long")).alias("page_numbers"),
        *[F.col(f"numbered.{c}").alias("extras") for c in extra],
    )


def numbered_pages(documents: DataFrame) -> DataFrame:
    """One row per page: logical_date, fetched_at, page_no, page (and `document`, if known, and `extra`
    where the documents have extras).

    Pages are numbered as in their pull; documents that don't say count from zero.
    """
    others = [c for c in ("logical_date", "fetched_at", DOCUMENT) if c in documents.columns]
    place = F.posexplode("pages").alias("place", "page")
    asides = [c for c in ("page_numbers", "extras") if c in documents.columns]
    rows = documents.select(*others, *asides, place)
    own = F.col("place").cast("long")
    number = F.coalesce(F.get("page_numbers", F.col("place")), own) if "page_numbers" in asides else own
    extra = [F.get("extras", F.col("place")).alias("extra")] if "extras" in asides else []
    return rows.select(*others, number.alias("page_no"), "page", *extra)


def write_bronze(documents: DataFrame, path: str) -> None:
    """Land envelopes, each as a JSON document of its own; a rerun of a source and day replaces it."""
    day = F.substring("logical_date", 1, 10).alias("day")
    (
        documents.select("*", F.col("source").alias("feed"), day)
        .hint("rebalance", "feed", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .partitionBy("feed", "day")
        .json(path)
    )


def stamp(pages: DataFrame, source: str, logical_date: str) -> DataFrame:
    """Give the pages of one pull (page_no, page) their source, day and fetch instant (UTC)."""
    get_source(source)
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return pages.select(
        F.lit(source).alias("source"),
        F.lit(f"{logical_date[:10]}T00:00:00+00:00").alias("logical_date"),
        F.concat(now, F.lit("+00:00")).alias("fetched_at"),
        "page_no",
        "page",
        *[c for c in ("extra",) if c in pages.columns],
    )


def _with_day(documents: DataFrame) -> DataFrame:
    return documents.withColumn("logical_date", iso_day(F.col("logical_date")))


def read_bronze(
    spark: SparkSession, source: str, path: str | list[str], multi_line: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Read the documents of one source by path or glob; `logical_date` becomes a date.

    A file may hold a document over many lines or any number of documents one after another; large files
    are read in ranges by several tasks. Files of other sources are left out. If every document is known
    to stand on a line of its own, `multi_line=False` leaves the splitting to Spark's JSON reader.

    The schema is explicit: nothing is inferred. Unmodelled payload fields are not read, except the
    `extras` that documents of some feeds carry.
    """
    schema = get_source(source).landed_schema
    if multi_line:
        texts = read_documents(spark, path, source, range_bytes)
        # As rows of an array, a document is parsed once: filters on its fields stay behind the parsing.
        documents = texts.select(F.inline(F.array(F.from_json("document", schema))))
    else:
        documents = spark.read.schema(schema).json(path)
    return _with_day(documents.where(F.col("source") == source))


def read_landed(
    spark: SparkSession, source: str, path: str, day: str | None = None
) -> DataFrame:
    """Read what `write_bronze` landed; partition filters keep the scan to one source (and day)."""
    schema = get_source(source).landed_schema.add("feed", "string").add("day", "date")
    landed = spark.read.schema(schema).json(path).where(F.col("feed") == source)
    if day is not None:
        landed = landed.where(F.col("day") == F.lit(day).cast("date"))
    return _with_day(landed.drop("feed", "day"))


def completeness(documents: DataFrame, source: str, max_pages: int | None = None) -> DataFrame:
    """Per source, day and fetch: pages landed, pages expected, and whether the fetch is complete.

    Works across split envelopes. The expected number comes from the payload itself; `max_pages` is
    for pulls that were told to stop there.
    """
    spec = get_source(source)
    page: Column = F.explode("pages").alias("page")
    expected = spec.pages_expected.cast("long")
    if max_pages is not None:
        expected = F.least(expected, F.lit(max_pages).cast("long"))
    return (
        documents.select("source", "logical_date", "fetched_at", page)
        .groupBy("source", "logical_date", "fetched_at")
        .agg(F.count(F.lit(1)).alias("pages_landed"), expected.alias("pages_expected"))
        .withColumn("complete", F.col("pages_landed") >= F.col("pages_expected"))
    )
