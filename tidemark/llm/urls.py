"""URL filters: rules by host and path, and a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_case, staged

WORDS = 8  # words of 64 bits in a block; a key sets one bit in each
BITS_PER_KEY = 16
FILTER_BYTES = 64 << 20  # a larger filter is joined by block number instead of being broadcast


def url_host(url: Column) -> Column:
    return fold_case(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host in lower case and path, without scheme, query and fragment."""
    return F.concat(url_host(url), url_path(url))


def _bit(i: int) -> Column:
    """The bit that a key sets in word i of its block."""
    return F.expr(f"shiftleft(1L, cast(shiftright(spread, {6 * i}) & 63 as int))")


def _place(keys: DataFrame, blocks: int) -> DataFrame:
    """Block number and bit source of every key."""
    return keys.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).withColumn(
        "spread", F.xxhash64(F.lit(7), F.col("key"))
    )


def build_filter(keys: DataFrame) -> tuple[DataFrame, int]:
    """The filter as rows (block, w0 .. w7) and its number of blocks, for a column `key`."""
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // (64 * WORDS)))
    words = [F.bit_or(_bit(i)).alias(f"w{i}") for i in range(WORDS)]
    return staged(_place(keys, blocks).groupBy("block").agg(*words), "url-filter"), blocks


def possible_hits(candidates: DataFrame, bloom: tuple[DataFrame, int]) -> DataFrame:
    """Candidates (with a column `key`) that the filter can't rule out."""
    words, blocks = bloom
    side = F.broadcast(words) if blocks * 8 * (WORDS + 1) <= FILTER_BYTES else words
    tested = [F.col(f"w{i}").bitwiseAND(_bit(i)) != 0 for i in range(WORDS)]
    joined = _place(candidates, blocks).join(side, "block").where(reduce(Column.__and__, tested))
    return joined.select(*candidates.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule, listed, verdict for every row of `pages` (page_id, url).

    `rules` has host, path, verdict; a rule fits its host and every subdomain if the path starts
    with the rule's, and the longest fitting rule decides. Without one, a URL whose canonical form is
    in `listed` (url) is blocked and any other is allowed.

    Rules and listed URLs are keys of one blocked Bloom filter. Each distinct URL asks for its own
    canonical form and for each host suffix and path prefix that are as long as some rule's;
    what passes the filter meets the keys in an exact join, so a false positive changes nothing.

    * A null URL, or one without `://`, has an empty host and path and fits no rule.
    * Repeated pages get a row each. A rule repeated with both verdicts blocks.
    * A long URL asks no more often than a short one.
    * Empty rules, lists or pages are fine. Other columns are not read.
    """
    pages = pages.select("page_id", "url")
    rule_keys = rules.groupBy(
        F.concat(F.lit("r "), fold_case(F.col("host")), F.lit(" "), F.col("path")).alias("key"),
        F.concat(fold_case(F.col("host")), F.col("path")).alias("rule"),
    ).agg(F.max("verdict").alias("verdict")).where("key is not null")  # block sorts after allow
    url_keys = listed.where("url is not null").select(
        F.concat(F.lit("u "), canonical_url(F.col("url"))).alias("key"),
        F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"),
    ).distinct()
    keys = staged(rule_keys.unionByName(url_keys), "url-keys")
    # Path lengths and numbers of host labels of rules are bounded by the length of a URL, whatever the
    # number of rules.
    distinct = lambda value: [r[0] for r in rules.select(value).distinct().collect() if r[0] is not None]
    lengths, depths = distinct(F.length("path")), distinct(F.when(F.col("host").isNotNull(), F.size(F.split("host", r"\."))))

    urls = pages.select("url").where("url is not null").distinct().select(
        "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    ).where("host <> ''")
    labels = F.split("host", r"\.")
    counts = F.array(*[F.lit(n) for n in depths]).cast("array<int>")
    suffixes = F.transform(
        F.filter(counts, lambda n: n <= F.size(labels)),
        lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)),
    )
    sizes = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    prefixes = F.transform(
        F.filter(sizes, lambda n: n <= F.length("path")), lambda n: F.col("path").substr(F.lit(1), n)
    )
    asked = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r "), s, F.lit(" "), p))))
    own = F.array(F.concat(F.lit("u "), F.col("host"), F.col("path")))
    candidates = urls.select("url", F.explode(F.array_distinct(F.concat(own, asked))).alias("key"))

    hits = possible_hits(candidates, build_filter(keys)).join(keys, "key")
    found = hits.groupBy(F.col("url").alias("__url")).agg(
        F.max_by("rule", F.struct(F.length("rule"), "rule")).alias("rule"),
        F.max_by("verdict", F.struct(F.length("rule"), "rule")).alias("by_rule"),
        F.max(F.col("rule").isNull()).alias("listed"),
    )
    judged = pages.join(found, F.col("url") == F.col("__url"), "left")
    url, is_listed = F.col("url"), F.coalesce("listed", F.lit(False))
    verdict = F.when(F.col("rule").isNotNull(), F.col("by_rule")).when(is_listed, "block").otherwise("allow")
    return judged.select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), "rule",
        is_listed.alias("listed"), verdict.alias("verdict"),
    )
