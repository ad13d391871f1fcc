"""Language-model scores of whole texts, with a smoothed unigram model to compare with."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, partitions, staged
from tidemark.llm.weighting import (
    MODEL, Counted, Top, all_keys, costs, deal_keys, deal_places, distinct, in_large_parts, normal_bytes, pack_keys,
    pack_planes, unpack_keys, unpack_model, unpack_planes,
)
from tidemark.llm.weighting import learn as learn_contexts
from tidemark.llm.words import Words, give_back, mix64, pack, pieces, unpack

#: What a row is: words asked for, rows of a block, what is said about its words, sums over all words; bytes of a block,
#: its contexts asked for, what they cost.
ASK, ROWS, TOLD, SUMS, BYTES, CONTEXTS, COST = 0, 1, 2, 3, 4, 5, 6
SCHEMA = "bucket int, kind int, block long, payload binary"
OUT = "doc_id long, learnt boolean, n_words long, n_known long, log_counts double, score double, tokens long, types long"


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "kind", "block", "payload"]
    )


def _home(block: int, buckets: int) -> int:
    return int(mix64(np.array([block], np.uint64))[0] % np.uint64(buckets))


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and the text it is in."""
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in pieces(bounds):
        words = Words(data, bounds, low, high, fold=True)
        hashes.append(words.hashes())
        owners.append(words.owner() + low)
    return np.concatenate(hashes), np.concatenate(owners)


def _ask(buckets: int):
    """Asks how often the words of a batch were learnt, and what its bytes cost after their contexts: each
    distinct word once, and each distinct byte with its context once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(in_large_parts(batches)):
            block = TaskContext.get().partitionId() << 32 | number
            home = _home(block, buckets)
            data, sizes = normal_bytes(batch.column("text"))
            keys, _ = distinct(all_keys(data, sizes))
            yield _batch([(b, CONTEXTS, block, pack_keys(keys[at])) for b, at in deal_keys(keys, buckets)])
            del keys
            learnt = batch.column("learnt").to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = batch.column("doc_id")
            table = pack(
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), learnt, sizes.astype(np.int64),
            )
            yield _batch([(home, ROWS, block, table), (home, BYTES, block, pack(data, level=3))])
            word, owner = _words(data, np.r_[0, np.cumsum(sizes)])
            word, place = np.unique(word, return_inverse=True)
            times = np.bincount(place, learnt[owner], len(word)).astype(np.int64)
            yield _batch([(b, ASK, block, pack(word[at], times[at])) for b, at in deal_places(word, buckets)])

    return run


def _costs(model: bytes | None, asked: list[tuple[int, bytes]], top: Top) -> Iterator[tuple[int, bytes]]:
    """(block, costs of its contexts in their order) in one bucket."""
    counted = Counted()
    if model is not None:
        counted.add(*unpack_model(model))
    for _, payload in asked:
        keys = unpack_keys(payload)
        counted.add(keys, np.zeros(len(keys), np.int64))
    counted.settle()
    cost = costs(counted.keys, counted.counts, top).astype(np.float32)
    for block, payload in asked:
        yield block, pack_planes(cost[np.searchsorted(counted.keys, unpack_keys(payload))])


def _answer(buckets: int, top):
    """Counts the learnt words of each bucket and tells each block what its rows have of them; weighs the
    contexts of each bucket and tells each block what it asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        contexts: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        models: dict[int, bytes] = {}
        for batch in batches:
            for bucket, kind, block, payload in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if kind == ASK:
                    waiting[bucket].append((block, payload))
                elif kind == CONTEXTS:
                    contexts[bucket].append((block, payload))
                elif kind == MODEL:
                    models[bucket] = payload
            yield batch.filter(pa.array(np.isin(batch.column("kind").to_numpy(), (ROWS, BYTES))))
        for bucket in list(contexts):
            for block, payload in _costs(models.pop(bucket, None), contexts.pop(bucket), top.value):
                yield _batch([(_home(block, buckets), COST, block, _signed(bucket, payload))])
            give_back()
        tokens = types = 0
        for bucket in list(waiting):
            asked, counted = waiting.pop(bucket), Counted()
            for _, payload in asked:
                counted.add(*unpack(payload, "u8", "i8"))
            counted.settle()
            tokens, types = tokens + int(counted.counts.sum()), types + int((counted.counts > 0).sum())
            yield _batch([
                (_home(block, buckets), TOLD, block, _signed(
                    bucket, pack(counted.counts[np.searchsorted(counted.keys, unpack(payload, "u8", "i8")[0])])
                ))
                for block, payload in asked
            ])
        yield _batch([(0, SUMS, 0, pack(np.array([tokens]), np.array([types])))])

    return run


def _signed(bucket: int, payload: bytes) -> bytes:
    """An answer, and behind it the bucket that it comes from."""
    return payload + bucket.to_bytes(4, "little")


def _by_bucket(told: list[bytes]) -> dict[int, bytes]:
    return {int.from_bytes(p[-4:], "little"): p[:-4] for p in told}


def _unigrams(data: np.ndarray, sizes: np.ndarray, told: list[bytes], buckets: int) -> tuple[np.ndarray, ...]:
    """Of each text of a block: words, learnt words among them, and the sum of the logarithms of one and the count."""
    word, owner = _words(data, np.r_[0, np.cumsum(sizes)])
    word, place = np.unique(word, return_inverse=True)
    counts, by_bucket = np.zeros(len(word), np.int64), _by_bucket(told)
    for bucket, at in deal_places(word, buckets):
        counts[at] = unpack(by_bucket[bucket], "i8")[0]
    known, logs = (counts > 0)[place], np.log10(counts + 1.0)[place]
    return (
        np.bincount(owner, minlength=len(sizes)), np.bincount(owner, known, len(sizes)).astype(np.int64),
        np.bincount(owner, logs, len(sizes)),
    )


def _scores(data: np.ndarray, sizes: np.ndarray, told: list[bytes], buckets: int) -> np.ndarray:
    """log10 probability of each text of a block, from the costs of its distinct contexts."""
    every = all_keys(data, sizes)
    keys, _ = distinct(every.copy())
    cost, by_bucket = np.zeros(len(keys)), _by_bucket(told)
    for bucket, at in deal_keys(keys, buckets):
        cost[at] = unpack_planes(by_bucket[bucket], "f4")
    bounds, scores = np.r_[0, np.cumsum(sizes)], np.zeros(len(sizes))
    for low, high in pieces(bounds):
        own = every[bounds[low] : bounds[high]]
        order = np.argsort(own)
        single = np.empty(len(own))
        single[order] = cost[np.searchsorted(keys, own[order])]
        scores[low:high] = np.add.reduceat(single, bounds[low:high] - bounds[low])
    return scores


def _gather(buckets: int):
    return lambda batches: _gathered(batches, buckets)


def _gathered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Puts the answers of each block together; totals are rows of their own."""
    names = ["doc_id", "learnt", "n_words", "n_known", "log_counts", "score", "tokens", "types"]
    blocks: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
    tokens = types = 0
    for batch in batches:
        for _, kind, block, payload in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if kind == SUMS:
                more = unpack(payload, "i8", "i8")
                tokens, types = tokens + int(more[0][0]), types + int(more[1][0])
            else:
                blocks[block].append((kind, payload))
    for block in list(blocks):
        parts = blocks.pop(block)
        ids, null, learnt, sizes = next(unpack(p, "i8", "u1", "u1", "i8") for k, p in parts if k == ROWS)
        data = next(unpack(p, "u1")[0] for k, p in parts if k == BYTES)
        scores = _scores(data, sizes, [p for k, p in parts if k == COST], buckets)
        counts, known, logs = _unigrams(data, sizes, [p for k, p in parts if k == TOLD], buckets)
        none = pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=null.astype(bool)), pa.array(learnt.astype(bool)), pa.array(counts), pa.array(known),
             pa.array(logs), pa.array(scores), none, none], names=names,
        )
        give_back()
    yield pa.RecordBatch.from_pydict(
        {n: pa.array([v], k) for n, v, k in zip(
            names, [None, None, None, None, None, None, tokens, types],
            [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()], strict=True,
        )}
    )


def language_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, learnt, n_tokens, n_known, train_tokens,
    base_score, score.

    `learn` says which rows the models learn from. Texts are their words with A-Z lower-cased, then an
    end. `score` is the log10 probability of the text under a context-tree weighted byte model of the
    learnt texts; base_score that of its tokens under unigram counts with one added to each.

    Neither model has a bound but the corpus: every context of up to seven bytes that was learnt counts, however
    rare. Counts lie in buckets, of contexts by their nearest bytes and of words by hash; a batch asks once for each
    of its distinct words and of its distinct bytes with their contexts. Only contexts of up to two bytes (at most
    2 ** 16) are broadcast.

    * Null and empty texts consist of an end. A null doc_id is kept; a null `learn` counts as false.
    * Rows are scored by themselves: repeated rows have equal scores. An empty table gives no rows.
    * With nothing to learn from, every decision has probability one half. Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learnt")
    )
    spark = docs.sparkSession
    wide = partitions(spark)
    buckets = 4 * wide
    with Scratch(spark) as scratch:
        model, top = learn_contexts(rows.where("learnt"), scratch, buckets)
        top = spark.sparkContext.broadcast(top)
        asked = rows.mapInArrow(_ask(buckets), SCHEMA).unionByName(model).repartition(wide, "bucket")
        told = asked.mapInArrow(_answer(buckets, top), SCHEMA).repartition(wide, "bucket")
        found = staged(told.mapInArrow(_gather(buckets), OUT), "scores")
    n = found.agg(
        F.sum("tokens").alias("words"), F.sum("types").alias("types"), F.count(F.when(F.col("learnt"), 1)).alias("ends")
    ).first()
    tokens, types = (n["words"] or 0) + n["ends"], (n["types"] or 0) + (n["ends"] > 0)
    n_tokens = F.col("n_words") + 1
    base = F.col("log_counts") + F.lit(float(np.log10(n["ends"] + 1))) - n_tokens * F.lit(float(np.log10(tokens + types + 1)))
    return found.where("n_words is not null").select(
        "doc_id", "learnt", n_tokens.alias("n_tokens"), (F.col("n_known") + int(n["ends"] > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
