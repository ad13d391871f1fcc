"""Benchmark decontamination: windows of benchmark items found in documents by prefix filtering."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged

WINDOW = 13
#: Benchmark bytes indexed at a time; a larger benchmark is searched for in blocks.
BLOCK_BYTES = 16 << 20

# Letters are lower-cased, digits and everything beyond ASCII are kept, the rest separates words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),  # start, end, start, end, ...
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "replace").translate(_TABLE).split()


def windows_of(words: list[bytes], length: int) -> list[tuple[bytes, ...]]:
    if len(words) < length:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        block.append((item, text))
        size += len(text or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


def _frequencies(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the block occurs, counted over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(words))

    def count(batches):
        wanted = shared.value
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                seen.update(wanted.intersection(words_of(text.as_py())))
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())}
            )

    counted = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n"))
    return {bytes(word): n for word, n in counted.collect()}  # as many rows as the block has words


def _index(block: list[tuple[str, str]], frequency: dict[bytes, int], length: int):
    """prefix word -> [(place of the word in the window, window, items)].

    A window must be contained whole, so its necessary prefix is a single word: the rarest.
    """
    owners = defaultdict(set)
    for item, text in block:
        for window in windows_of(words_of(text), length):
            owners[window].add(item)
    index = defaultdict(list)
    for window, items in owners.items():
        place = min(range(len(window)), key=lambda i: (frequency.get(window[i], 0), window[i]))
        # A window with a word that no document has cannot occur.
        if frequency.get(window[place], 0):
            index[window[place]].append((place, window, sorted(i for i in items if i is not None)))
    return dict(index)


def _find(text: str | None, index: dict) -> tuple[int, list[int], list[str]]:
    words = words_of(text)
    spans, items = [], set()
    for at in [i for i, word in enumerate(words) if word in index]:
        for place, window, owners in index[words[at]]:
            start = at - place
            end = start + len(window)
            # The window must lie inside the document before its words are compared.
            if start >= 0 and end <= len(words) and tuple(words[start:end]) == window:
                spans.append((start, end))
                items.update(owners)
    merged: list[int] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1]:
            merged[-1] = max(merged[-1], end)
        else:
            merged += [start, end]
    return len(words), merged, sorted(items)


def _search(docs: DataFrame, block: list[tuple[str, str]], length: int):
    """A column function that finds the block's windows in a text."""
    vocabulary = {word for _, text in block for word in words_of(text)}
    frequency = _frequencies(docs, vocabulary) if vocabulary else {}
    shared = docs.sparkSession.sparkContext.broadcast(_index(block, frequency, length))

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        index = shared.value
        return pd.DataFrame([_find(t, index) for t in texts], columns=FOUND.names)

    return find


SUMMARY = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
])


@F.pandas_udf(SUMMARY)
def _summary(n_words: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
    rows = []
    for n, span, names in zip(n_words, spans, items, strict=True):
        covered, upto = 0, 0
        for start, end in sorted(zip(span[::2], span[1::2], strict=True)):
            covered += max(0, end - max(start, upto))
            upto = max(upto, end)
        unique = sorted(set(names))
        digest = hashlib.sha256(",".join(unique).encode()).hexdigest()
        rows.append((n, covered, len(unique), digest, covered > 0 and 20 * covered >= n))
    return pd.DataFrame(rows, columns=SUMMARY.names)


@F.pandas_udf(T.LongType())
def _n_words(texts: pd.Series) -> pd.Series:
    return pd.Series([len(words_of(t)) for t in texts], dtype="int64")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of `docs` with a struct column `hit`: n_words, n_hit, n_items, items_sha256,
    contaminated.

    A window is `window` consecutive words of a benchmark item, or the whole of a shorter one. A
    document word inside an occurrence of a window is hit; a document is contaminated if hit words
    are at least a twentieth of its words.

    The join is on tokens in order of rarity over all documents: since a window must be contained
    whole, its prefix is its rarest word. Where a document has that word, the word's place in the
    window fixes the only possible position, which must lie inside the document, and the words there
    are compared. The benchmark is the query set; it is searched for in blocks of bounded size.

    * Null or wordless texts have no words and are never hit. Null items are ignored as owners of a
      window, but their windows count as hits. Equal windows of several items name all of them.
    * Repeated rows are judged alike. Empty documents or benchmarks are fine. Other columns pass
      through, except that a column `hit` must not exist.
    """
    if "hit" in docs.columns:
        raise ValueError("the documents have a column hit already")
    blocks = _blocks(benchmark)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        found = docs.withColumn("__found", _search(docs, first, window)("text"))
        summary = _summary("__found.n_words", "__found.spans", "__found.items")
        return found.withColumn("hit", summary).drop("__found")

    # Several blocks: what each finds is written sparsely, by text, and put together again.
    texts = docs.select("text").where("text is not null").withColumn("__key", F.sha2("text", 256))
    parts = [_part(texts, block, window) for block in chain([first, second], blocks)]
    union = reduce(DataFrame.unionByName, parts)
    merged = union.groupBy("__key").agg(
        F.flatten(F.collect_set("spans")).alias("__spans"), F.flatten(F.collect_set("items")).alias("__items")
    )
    empty = F.array().cast("array<long>"), F.array().cast("array<string>")
    joined = docs.withColumn("__key", F.sha2("text", 256)).join(merged, "__key", "left")
    return joined.withColumn(
        "hit",
        _summary(_n_words("text"), F.coalesce("__spans", empty[0]), F.coalesce("__items", empty[1])),
    ).select(*[joined[c] for c in docs.columns], "hit")


def _part(texts: DataFrame, block: list[tuple[str, str]], window: int) -> DataFrame:
    find = _search(texts, block, window)
    rows = texts.withColumn("f", find("text")).where("size(f.spans) > 0")
    return staged(rows.select("__key", "f.spans", "f.items").distinct(), "contamination-part")
