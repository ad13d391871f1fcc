"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import sql
from tidemark.llm.audit import filter_audit
from tidemark.llm.bytepairs import decoded, encoded, load_ranks
from tidemark.llm.common import staged, tables
from tidemark.llm.contamination import contamination
from tidemark.llm.exact import exact_duplicates
from tidemark.llm.jaccard import jaccard_groups
from tidemark.llm.mixing import mixed, word_count
from tidemark.llm.ordering import write_training_order
from tidemark.llm.passages import repeated_passages
from tidemark.llm.pseudonyms import pseudonymised
from tidemark.llm.repair import repaired
from tidemark.llm.scoring import language_scores
from tidemark.llm.toxicity import toxicity, train
from tidemark.llm.urls import judge_urls
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


TOXIC_AT = 0.7


def held_out(doc_id, folds: int, which: int):
    """Whether crc32 of the id, as text, falls in the fold that isn't learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == which, F.lit(False))


RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@query("op1_token_order")
def token_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return write_training_order(docs, scratch_path(spark, "token-order"), RANKS, per_shard=2048)


@query("op2_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7, 2)
    scored = language_scores(tables(spark, sf_dir, "documents").select("doc_id", "text"), ~out)
    return scored.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    labels = tables(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)))
    scored = docs.withColumn("score", toxicity(docs, model))
    predicted = (F.col("score") >= TOXIC_AT).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", predicted)


@query("op4_benchmark_decontamination", sql.DECONTAMINATION)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, tables(spark, sf_dir, "benchmark")).select("doc_id", "hit.*")


@query("op5_exact_dedup", sql.EXACT)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(tables(spark, sf_dir, "documents"), keep="largest", fold=True)


@query("op7_source_mixing", sql.MIXING)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    rows = mixed(staged(docs, "mix-sizes"), size=F.col("words"))
    return rows.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


#: Where the key of the pseudonyms is looked for; without one, a fixed key links them over all runs.
PSEUDONYM_KEY = "spark.tidemark.pseudonymKey"


@query("op6_pii_pseudonyms")
def pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PSEUDONYM_KEY, "tidemark")
    rows = pseudonymised(tables(spark, sf_dir, "documents").select("doc_id", "text"), key=key)
    return rows.select("doc_id", "text", F.size("found").alias("n_found"), F.to_json("found").alias("found"))


#: host, path, verdict: the rules of the query, fixed values
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
@query("op8_ngram_jaccard", sql.JACCARD)
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_groups(docs, size=3, similarity=(9, 10))


@query("op9_url_filter", sql.URLS)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    # The list to look URLs up in: those of about one page in sixteen, by a hash of its id.
    listed = pages.where(F.substring(F.md5(F.col("page_id").cast("string")), 1, 1) == "0")
    return judge_urls(pages, rules, listed.select("url"))


@query("op10_substring_dedup", sql.PASSAGES)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeated_passages(tables(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "cut.n_words", "cut.n_removed", F.sha2("cut.kept", 256).alias("kept_sha256"))


@query("op11_filter_audit", sql.AUDIT)
def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit(docs, tables(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = repaired(tables(spark, sf_dir, "conversations"))
    return summary


@query("op13_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = load_ranks(RANKS)
    rows = decoded(encoded(tables(spark, sf_dir, "documents").select("doc_id", "text"), ranks), ranks)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
