import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import tidemark.llm.bytepairs as bytepairs
from tidemark.llm.bytepairs import Part, character_classes, decoded, encoded, load_ranks
from tidemark.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = (
    "a", "s", "t", "re", "ve", "ll", "d", "m", "'", " ", "  ", "\n", "\t", "\r", "5", "٣", "é", "日", "!", "'s", "'RE", "ʼ",
    "\x1c", "\x85", "　", "\U0001f600", "́", "࢏", "\U0001e5f0", "\x00", "ß", "K", "½",
)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def made(seed, n):
    pick = random.Random(seed)
    texts = ["".join(pick.choice(ALPHABET) for _ in range(pick.choice((0, 1, 2, 5, 40)))) for _ in range(n)]
    return texts + [None, "", " ", "'", "don't 's's'll  x\n\n", "<|endoftext|>", texts[0], "x  ", "  x"]


def test_words_are_the_matches_of_the_library(library):
    classes = character_classes()
    for seed in range(300):
        texts = [t or "" for t in made(seed, 6)]
        part = Part(pa.array(texts), classes)
        words = [part.data[s : s + n].tobytes() for s, n in zip(part.starts, part.lengths, strict=True)]
        words = [words[i] for i in np.argsort(part.ranks)]
        at = 0
        for text, count in zip(texts, part.counts, strict=True):
            own = [words[w] for w in part.places[at : at + count]]
            at += count
            assert b"".join(own).decode() == text
            assert [i for w in own for i in library._core_bpe.encode_single_piece(w)] == library.encode_ordinary(text)


def check(rows, docs, library):
    got = sorted(((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows.collect()), key=str)
    want = []
    for i, text in docs:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert got == sorted(want, key=str)


def test_ids_and_bytes_equal_the_library(texts, library, monkeypatch):
    """Small parts and buckets, so that words meet over many of them."""
    monkeypatch.setattr(bytepairs, "PART", 200)
    monkeypatch.setattr(bytepairs, "BUCKET", 100)
    rows = list(enumerate(made(1, 150))) + [(None, "no id"), (3, "again"), (3, "again")]
    ranks = load_ranks(PATH)
    check(decoded(encoded(texts(rows), ranks), ranks), rows, library)


def test_long_words_and_long_texts(texts, library):
    rows = [(1, "ab" * 200_000), (2, "word and " * 300_000), (3, " " * 500_000 + "x"), (4, "日本" * 100_000)]
    ranks = load_ranks(PATH)
    check(decoded(encoded(texts(rows), ranks), ranks), rows, library)


def test_string_ids_and_empty_tables(texts, library):
    ranks = load_ranks(PATH)
    docs = texts([(1, "one"), (None, "two")])
    rows = encoded(docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))), ranks)
    assert sorted((r["doc_id"] or "", r["n_tokens"]) for r in rows.collect()) == [
        ("", len(library.encode_ordinary("two"))), ("d1", len(library.encode_ordinary("one")))
    ]
    assert decoded(encoded(texts([]), ranks), ranks).collect() == []


def test_decoding_other_ids(spark, library):
    ranks = load_ranks(PATH)
    rows = spark.createDataFrame([(1, bytearray(np.array([0, 50255, 7], "<u4").tobytes())), (2, None), (3, bytearray())], "n int, ids binary")
    got = {r["n"]: bytes(r["decoded"]) for r in decoded(rows, ranks).collect()}
    assert got == {1: library.decode_bytes([0, 50255, 7]), 2: b"", 3: b""}
    with pytest.raises(Exception, match="no token"):
        decoded(rows.select(F.lit(bytearray(np.array([50300], "<u4").tobytes())).alias("ids")), ranks).collect()
    with pytest.raises(ValueError):
        decoded(rows.withColumn("Decoded", F.lit(1)), ranks)


def test_query_on_a_table(texts, tmp_path, spark, library):
    rows = list(enumerate(made(2, 40)))
    texts(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries()["op13_byte_bpe"](spark, str(tmp_path)).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want.add((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert got == want
