"""Training-order materialisation: token ids in fixed-stride shards, in a keyed random order."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, narrow_side, staged
from tidemark.llm.words import mix64, trimmed

#: The pattern that splits text before the merges of the rank files (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROUNDS = 6
FRAME = b"\n"  # ends every record; a record is 2 * length + 1 bytes
SAMPLE = 256  # texts that a dictionary for the intermediate table is made from


class Encoder:
    """Token ids of a text under a file of byte-pair ranks, as little-endian 16-bit numbers. Nothing of a
    text is kept: a table of the words of a task took 80 to 146 MB and saved little or no time."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.inner = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return array("H", self.inner.encode_ordinary(text)).tobytes()


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 token and its id on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if len(ranks) >= 2**16:
        raise ValueError(f"{path} has {len(ranks)} tokens; ids of 16 bits and an end token are written")
    return ranks


class Permutation:
    """A keyed permutation of 0 .. size - 1.

    A Feistel network permutes the numbers of as many bits as `size` needs; a result beyond the end
    goes through it again (cycle-walking), which keeps it a permutation of what is inside.
    """

    def __init__(self, size: int, key: str):
        self.size = size
        bits = max(2, (size - 1).bit_length())
        self.low = bits // 2
        self.masks = np.uint64((1 << (bits - self.low)) - 1), np.uint64((1 << self.low) - 1)
        digest = hashlib.blake2b(key.encode(), digest_size=16 * ROUNDS // 2).digest()
        self.keys = np.frombuffer(hashlib.shake_256(digest).digest(16 * ROUNDS), np.uint64).reshape(ROUNDS, 2)

    def _once(self, x: np.ndarray) -> np.ndarray:
        high, low = x >> np.uint64(self.low), x & self.masks[1]
        for one, two in self.keys:
            high = (high + mix64(low ^ one)) & self.masks[0]
            low = (low + mix64(high ^ two)) & self.masks[1]
        return high << np.uint64(self.low) | low

    def _back(self, x: np.ndarray) -> np.ndarray:
        high, low = x >> np.uint64(self.low), x & self.masks[1]
        for one, two in self.keys[::-1]:
            low = (low - mix64(high ^ two)) & self.masks[1]
            high = (high - mix64(low ^ one)) & self.masks[0]
        return high << np.uint64(self.low) | low

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(x.astype(np.uint64))
        while (outside := np.flatnonzero(x >= np.uint64(self.size))).size:
            x[outside] = step(x[outside])
        return x.astype(np.int64)

    def slots(self, indices: np.ndarray) -> np.ndarray:
        return self._walk(indices, self._once)

    def indices(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self._back)


SEQUENCES = "part long, place long, n_tokens int, doc_ids array<long>, tokens_sha256 string, payload binary"


def _packed(ranks, dictionary: bytes, length: int):
    """The tokens of a partition's documents, each with an end token, cut into sequences of `length`;
    the last one is filled up with end tokens."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        encoder = Encoder(ranks.value)  # of this task: a worker that waits for the next one holds none
        end = len(ranks.value).to_bytes(2, "little")
        press = _press(dictionary)
        waiting, filled, size = [], 0, 2 * length
        ids: list[int | None] = []

        def record(tokens: bytes, documents: list[int | None]):
            nonlocal place
            row = (part, place, len(tokens) // 2, documents, tokens)
            place += 1
            return row

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            whole = [r[4] + end * (length - r[2]) for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                 pa.array([hashlib.sha256(t).hexdigest() for t in whole], pa.string()),
                 pa.array([press.compress(t) for t in whole], pa.binary())],
                names=["part", "place", "n_tokens", "doc_ids", "tokens_sha256", "payload"],
            )

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                tokens = encoder.encode(text.as_py() or "") + end
                at = 0
                while at < len(tokens):
                    piece = tokens[at : at + size - filled]
                    waiting.append(piece)
                    ids.append(doc_id)
                    at, filled = at + len(piece), filled + len(piece)
                    if filled == size:
                        rows.append(record(b"".join(waiting), ids))
                        waiting, filled, ids = [], 0, []
                        if len(rows) >= 1024:
                            yield batch_of(rows)
                            rows = []
            yield batch_of(rows)
        if filled:
            yield batch_of([record(b"".join(waiting), ids)])

    return run


def _press(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=5, dict_data=data, write_dict_id=False)


def _dictionary(docs: DataFrame, ranks: dict[bytes, int], length: int) -> bytes:
    """A zstandard dictionary for the intermediate table. It only makes that table smaller."""
    encoder = Encoder(ranks)
    texts = docs.select(F.substring("text", 1, 20_000).alias("text")).where("text is not null").limit(SAMPLE).collect()
    tokens = b"".join(encoder.encode(r["text"]) for r in texts)
    samples = [tokens[i : i + 2 * length] for i in range(0, len(tokens), 2 * length)]
    try:
        return zstandard.train_dictionary(64 << 10, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def write_training_order(
    docs: DataFrame, path: str, ranks_file: str, length: int = 2048, per_shard: int = 8192, key: str = "order"
) -> DataFrame:
    """Write all tokens of `docs` (doc_id, text) below `path` and return the index: slot, shard,
    byte_offset, n_tokens, doc_ids, tokens_sha256; one row per sequence.

    Documents are encoded, ended by an end token (the first free id) and packed into sequences of
    `length` ids. A keyed permutation of 0 .. sequences - 1 gives each its slot. Shard s holds the slots
    from s * per_shard on, in order: `shard=s` has one file of records of 2 * length + 1 bytes, ids as
    little-endian 16-bit numbers and a line feed. A reader that knows how many sequences it has used
    goes on at that slot (`read_slots`).

    * Null and empty texts are an end token. A null doc_id is written as null in the index.
    * Repeated rows are written as often as they occur. An empty table writes no shard.
    * Other columns are not read. Ids are those of the table's partitions in order, so the same table
      read in the same splits gives the same files.

    The ids go to the shared folder once, compressed, which numbers the sequences of every task; only
    counts by task are put together. One range exchange by shard follows. Spark's writer commits the
    files, so a retried task leaves no half of one, and any file system that Spark writes to will do.
    """
    spark = docs.sparkSession
    ranks = load_ranks(ranks_file)
    dictionary = _dictionary(docs, ranks, length)
    shared = spark.sparkContext.broadcast(ranks)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _packed(shared, dictionary, length), SEQUENCES
    )
    with Scratch(spark) as scratch:
        sequences = scratch.staged(rows, "order-sequences")
        parts = sequences.groupBy("part").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
        offsets = scratch.staged(parts.select("part", before.alias("before"), "n"), "order-offsets")  # a row per task
        total = offsets.agg(F.sum("n")).first()[0] or 0
        order = Permutation(max(1, total), key)

        @F.pandas_udf(T.LongType())
        def slot_of(index: pd.Series) -> pd.Series:
            return pd.Series(order.slots(index.to_numpy()))

        @F.pandas_udf(T.BinaryType())
        def plain(payload: pd.Series) -> pd.Series:
            data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            open_ = zstandard.ZstdDecompressor(dict_data=data)
            return pd.Series([open_.decompress(p) for p in payload])

        placed = sequences.join(narrow_side(offsets.drop("n")), "part").withColumn("slot", slot_of(F.col("before") + F.col("place")))
        shard: Column = F.expr(f"slot div {per_shard}").alias("shard")
        index = placed.select(
            "slot", shard, ((F.col("slot") % per_shard) * (2 * length + len(FRAME))).alias("byte_offset"),
            "n_tokens", "doc_ids", "tokens_sha256",
        )
        index = staged(index, "order-index")
        shards = -(-total // per_shard)
        (
            placed.select("slot", shard, "payload")
            .repartitionByRange(max(1, shards), "shard")
            .withColumn("value", plain("payload").cast("string"))  # bytes as they are
            .sortWithinPartitions("shard", "slot")
            .select("value", "shard")
            .write.partitionBy("shard").option("lineSep", FRAME.decode()).mode("overwrite").text(f"{path}/shards")
        )
        about = spark.createDataFrame(
            [(total, length, 2 * length + len(FRAME), per_shard, len(ranks))],
            "sequences long, length int, stride int, per_shard int, end_token int",
        )
        about.write.mode("overwrite").json(f"{path}/about")
    return index


def read_slots(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """slot, tokens of the slots [first, first + count), from the shards that hold them only."""
    about = spark.read.json(f"{path}/about").first()
    stride, per_shard, length = about["stride"], about["per_shard"], about["length"]
    last = min(first + count, about["sequences"])
    if last <= first:
        return spark.createDataFrame([], "slot long, tokens array<int>")
    wanted = F.col("shard").between(first // per_shard, (last - 1) // per_shard)
    files = spark.read.format("binaryFile").load(f"{path}/shards").where(wanted).select("shard", "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)[:, : 2 * length]
                slots = int(shard) * per_shard + np.arange(len(data))
                keep = (slots >= first) & (slots < last)
                tokens = np.ascontiguousarray(data[keep]).view("<u2").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[keep]), pa.array(list(tokens), pa.list_(pa.int32()))], names=["slot", "tokens"]
                )

    return files.mapInArrow(cut, "slot long, tokens array<int>")
