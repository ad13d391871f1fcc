"""Byte-level byte-pair encoding: each distinct word of the corpus is encoded once."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions
from tidemark.llm.spans import first_like, padded, span_hashes
from tidemark.llm.words import PIECE, in_parts, mix64, pack, pieces, text_bytes, unpack
from tidemark.session import scratch_path

PART = 8 * PIECE  # bytes of text whose distinct words are told apart together
BUCKET = 4 * PIECE  # bytes of words that are told apart together, over all parts
LETTER, NUMBER, OTHER, GAP = range(4)
#: What may follow an apostrophe that begins a word (fixed values of the pattern).
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
ID = np.dtype("<u4")


def load_ranks(path: str) -> dict[bytes, int]:
    """Bytes and id of every token: a base64 token and its id on each line of `path`. The vocabulary is a
    parameter of fixed size, not data."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def character_classes() -> np.ndarray:
    """LETTER, NUMBER, GAP or OTHER of every code point, as the tokenizer's own engine sees them: its
    Unicode version may be another than Python's."""
    import tiktoken

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (GAP, r"\s")):
        matches = tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        table[np.frombuffer(bytes(matches).decode().encode("utf-32-le"), "<u4")] = kind
    return table


def word_starts(codes: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the matches of public_tokenizers.PATTERN begin in `codes`; texts begin at `first`.

    Every code point is in a match. Runs of one class are matches, but
    * a space just before a run of another class belongs to it;
    * of a longer run of white space before something else, the last character is split off;
    * an apostrophe that begins a match takes one of SUFFIXES along.
    """
    size = len(codes)
    if not size:
        return np.zeros(0, np.int64)
    kind = classes[codes]
    fresh = np.zeros(size + 1, bool)
    fresh[first] = True
    fresh[size] = True
    begins = fresh[:size].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    gap = kind == GAP
    before_other = np.zeros(size, bool)
    before_other[:-1] = gap[:-1] & ~gap[1:] & ~fresh[1:size]
    starts = begins | before_other
    taken = np.flatnonzero(before_other & (codes == 32)) + 1
    starts[taken] = False
    quote = np.flatnonzero((codes == 39) & starts)
    for suffix in SUFFIXES:
        at, n = quote[quote + len(suffix) < size], len(suffix)
        fits = np.ones(len(at), bool)
        for i, letter in enumerate(suffix, 1):
            fits &= (codes[at + i] == ord(letter)) & ~fresh[at + i]
        at = at[fits]
        starts[at + 1] = False
        behind = at + n + 1
        starts[behind[behind < size]] = True
    return np.flatnonzero(starts)


class Part:
    """The distinct words of some texts, in the order of their hashes, and which of them stands where."""

    def __init__(self, texts: pa.Array, classes: np.ndarray):
        raw, bounds = text_bytes(texts)
        found = [np.zeros(0, np.int64)]
        for low, high in pieces(bounds):
            own, first = raw[bounds[low] : bounds[high]], bounds[low:high] - bounds[low]
            codes = np.frombuffer(own.tobytes().decode().encode("utf-32-le"), "<u4")
            at = np.flatnonzero((own & 0xC0) != 0x80)  # where each code point begins
            first = np.searchsorted(at, first)
            found.append(at[word_starts(codes, first[first < len(codes)], classes)] + bounds[low])
            del codes, at
        starts = np.concatenate(found)
        del found
        lengths = np.diff(starts, append=len(raw)).astype(np.int32)
        data = padded(raw)
        home = first_like(data, starts, lengths)
        own = np.flatnonzero(home == np.arange(len(starts)))
        # Places hold ranks by frequency, as small numbers pack well.
        times = np.bincount(home, minlength=len(starts))[own]
        by_times = np.argsort(-times, kind="stable")
        rank = np.empty(len(own), np.uint32)
        rank[by_times] = np.arange(len(own), dtype=np.uint32)
        number = np.empty(len(starts), np.uint32)
        number[own] = rank
        self.places = number[home]
        del number, home, times, by_times
        self.counts = np.diff(np.searchsorted(starts, bounds)).astype(np.uint32)
        by_hash = np.argsort(mix64(span_hashes(data, starts[own], lengths[own])), kind="stable")
        self.ranks, own = rank[by_hash], own[by_hash]
        self.starts, self.lengths, self.data = starts[own], lengths[own], data


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    return np.arange(int(counts.sum())) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def _bytes_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    return data[ragged(starts, lengths)].tobytes()


def _planes(numbers: np.ndarray) -> np.ndarray:
    """Low bytes first, then the next: planes compress better than numbers."""
    return np.ascontiguousarray(numbers.astype(ID).view(np.uint8).reshape(-1, 4).T)


def _from_planes(payload: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(payload, "u1")[0].reshape(4, -1).T).view(ID).ravel()


def _split(ids: T.StructField, classes):
    """One row for each part: its documents, which word stands where, and the distinct words."""
    schema = T.StructType([
        T.StructField("part", T.StringType()), T.StructField("ids", T.ArrayType(ids.dataType)),
        *[T.StructField(c, T.BinaryType()) for c in ("counts", "places", "ranks", "lengths", "words")],
        T.StructField("word_bytes", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, PART):
            part, ids = Part(batch.column("text"), classes.value), batch.column("doc_id")
            words = np.frombuffer(_bytes_of(part.data, part.starts, part.lengths), np.uint8)
            binary = [pack(_planes(n)) for n in (part.counts, part.places, part.ranks, part.lengths)] + [pack(words)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *[pa.array([x], pa.binary()) for x in binary], pa.array([len(words)], pa.int64())],
                names=schema.names,
            )

    return run, schema


ASKED = "part string, bucket int, first int, lengths binary, words binary"
TOLD = "part string, first int, sizes binary, tokens binary"


def _ask(buckets: int):
    """The distinct words of each part, dealt by ranges of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, lengths, words in zip(*(batch.column(c).to_pylist() for c in ("part", "lengths", "words")), strict=True):
                lengths, data = _from_planes(lengths).astype(np.int64), padded(unpack(words, "u1")[0])
                starts = np.cumsum(lengths) - lengths
                bucket = ((mix64(span_hashes(data, starts, lengths)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
                cuts = list(zip(first.tolist(), np.r_[first[1:], len(lengths)].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(cuts), pa.string()), pa.array(bucket[first].astype(np.int32)), pa.array(first.astype(np.int32)),
                     pa.array([pack(_planes(lengths[a:b])) for a, b in cuts], pa.binary()),
                     pa.array([pack(data[starts[a] : starts[b - 1] + lengths[b - 1]]) for a, b in cuts], pa.binary())],
                    names=["part", "bucket", "first", "lengths", "words"],
                )

    return run


def _encode(ranks):
    """The distinct words of each bucket, encoded once, and their ids told to every part that asked."""

    def run(key: tuple, asked: pa.Table) -> pa.Table:
        import tiktoken

        single = tiktoken.Encoding("own", pat_str=".", mergeable_ranks=ranks.value, special_tokens={})._core_bpe
        parts = [
            (_from_planes(lengths), unpack(words, "u1")[0])
            for lengths, words in zip(asked["lengths"].to_pylist(), asked["words"].to_pylist(), strict=True)
        ]
        lengths = np.concatenate([p[0] for p in parts]).astype(np.int64)
        data = padded(np.concatenate([p[1] for p in parts]))
        starts = np.cumsum(lengths) - lengths
        home = first_like(data, starts, lengths)
        own = np.flatnonzero(home == np.arange(len(home)))
        whole = data.tobytes()
        found = [single.encode_single_piece(whole[a:b]) for a, b in zip(starts[own].tolist(), (starts + lengths)[own].tolist(), strict=True)]
        sizes = np.array([len(f) for f in found], np.int64)
        ids = np.fromiter((i for f in found for i in f), ID, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        rank = np.empty(len(home), np.int64)
        rank[own] = np.arange(len(own))
        which = rank[home]
        told, upto = [], 0
        for own, _ in parts:
            mine = which[upto : upto + len(own)]
            upto += len(own)
            told.append((pack(_planes(sizes[mine])), pack(_planes(ids[ragged(first[mine], sizes[mine])]))))
        return pa.table({
            "part": asked["part"], "first": asked["first"],
            "sizes": pa.array([t[0] for t in told], pa.binary()), "tokens": pa.array([t[1] for t in told], pa.binary()),
        })

    return run


def _reassemble(ids: T.StructField):
    """Puts the ids of its words at their places, for each document of a part."""
    schema = T.StructType([
        T.StructField(ids.name, ids.dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(part: pa.Table, told: pa.Table) -> pa.Table:
        if not part.num_rows:
            return pa.table({f.name: pa.array([], pa.binary()) for f in schema})
        counts, places, ranks = (_from_planes(part[c][0].as_py()) for c in ("counts", "places", "ranks"))
        told = told.sort_by("first")  # words in the order of the part
        sizes_told = [_from_planes(x) for x in told["sizes"].to_pylist()]
        sizes, first = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        own = np.concatenate([np.zeros(0, ID), *sizes_told]).astype(np.int64)
        sizes[ranks], first[ranks] = own, np.cumsum(own) - own
        known = np.concatenate([np.zeros(0, ID), *[_from_planes(x) for x in told["tokens"].to_pylist()]])
        size = sizes[places]
        flat = known[ragged(first[places], size)]
        upto = np.cumsum(np.r_[0, size])[np.cumsum(np.r_[0, counts.astype(np.int64)])]
        raw, n = flat.tobytes(), np.diff(upto)
        buffers = pa.array([raw[a:b] for a, b in zip((ID.itemsize * upto[:-1]).tolist(), (ID.itemsize * upto[1:]).tolist(), strict=True)], pa.binary())
        return pa.table({ids.name: part["ids"].combine_chunks().flatten(), "n_tokens": pa.array(n), "ids": buffers})

    return run, schema


def encoded(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens and ids for every row of `docs` (doc_id, text): what the tiktoken library gives for
    public_tokenizers.PATTERN, without special tokens, as little-endian unsigned 32-bit numbers.

    Parts of the text are split into words with their positions. Each distinct word of a part goes to the
    bucket of its hash, where it is encoded once, whatever the number of parts that have it; the ids go
    back to the parts and are put at the positions. Words are told apart by their bytes. There are as
    many buckets as the measured bytes of words ask for.

    * A null text is empty and has no ids. A null doc_id is kept; repeated rows are encoded alike.
    * A part has about 8 MB of text, or is one longer text, which is worked on whole in memory.
    * An empty table gives no rows. Other columns are not read. doc_id may be of any type.

    A word that all documents have is one entry per part. What is split is staged in the shared folder
    and named by its part, so a task that runs again finds the same parts.
    """
    context, field = docs.sparkSession.sparkContext, docs.schema["doc_id"]
    split, schema = _split(field, context.broadcast(character_classes()))
    back, result = _reassemble(field)
    parts = _dealt_parts(docs.select("doc_id", "text").mapInArrow(split, schema))
    size = parts.agg(F.sum("word_bytes")).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-size // BUCKET))
    told = (
        parts.select("part", "lengths", "words").mapInArrow(_ask(buckets), ASKED)
        .groupBy("bucket").applyInArrow(_encode(context.broadcast(ranks)), TOLD)
    )
    places = parts.select("part", "ids", "counts", "places", "ranks")
    return places.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(back, result)


def _dealt_parts(parts: DataFrame) -> DataFrame:
    """Stages the parts in buckets by their name, so that what is joined to them moves and they stay."""
    spark = parts.sparkSession
    name, path = f"tidemark_{uuid4().hex}", scratch_path(spark, "bytepair-parts")
    parts.write.bucketBy(partitions(spark), "part").option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the catalog forgets it; the files stay in the scratch folder


def decoded(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The rows of `tokens` with a column `decoded`: the bytes of `ids` (little-endian unsigned 32-bit
    numbers), each looked up in the table of tokens.

    Null ids decode to no bytes; an id that is no token is an error. `decoded` must not exist; other
    columns pass through. The table is as large as the vocabulary and broadcast.
    """
    if "decoded" in {c.lower() for c in tokens.columns}:
        raise ValueError("the tokens have a column decoded already")
    sizes = np.full(max(ranks.values(), default=-1) + 2, -1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    first = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    letters = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
    table = tokens.sparkSession.sparkContext.broadcast((first, sizes, letters))
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sizes, letters = table.value
        for batch in batches:
            out = []
            for buffer in batch.column("ids"):
                ids = np.frombuffer(buffer.as_buffer() or b"", ID) if buffer.is_valid else np.zeros(0, ID)
                size = sizes[np.minimum(ids, len(sizes) - 1)]
                if (size < 0).any():
                    raise ValueError(f"{ids[size < 0][0]} is no token")
                out.append(letters[ragged(first[ids], size)].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)

    return tokens.mapInArrow(run, schema)
