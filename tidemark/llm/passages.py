"""Passages that repeat across documents, found through difference-cover anchors."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_ROWS, Scratch, partitions, staged
from tidemark.llm.words import Words, deal, in_parts, pieces, runs_hash, text_bytes, unpack

WINDOW = 50
BUCKETS_PER_PARTITION = 4
SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall


def difference_cover(period: int) -> list[int]:
    """Residues such that any two positions, moved on together, both fall on one within `period`
    steps: every difference modulo the period is one between two residues. Built greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        gain = lambda r: len({d for c in cover for d in ((r - c) % period, (c - r) % period)} & missing)
        best = max((r for r in range(1, period) if r not in cover), key=lambda r: (gain(r), -r))
        missing -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
        cover.append(best)
    return sorted(cover)


def cover_for(window: int) -> tuple[int, list[int], int]:
    """(period, residues, anchor length) for matches of `window` words: an aligned anchor begins in
    the first `period` words of a match and ends inside it."""
    period = max(1, min(31, window // 2))
    return period, difference_cover(period) if period > 1 else [0], window - period + 1


def _ragged(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The numbers of each [start, stop), one run after another."""
    counts = np.maximum(stops - starts, 0)
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (the last key decides ties), and where each group of
    equal keys but the last begins."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    if len(order):
        fresh[0] = True
        for key in keys[:-1]:
            fresh[1:] |= key[order][1:] != key[order][:-1]
    return order, np.flatnonzero(fresh)


def _spread(fresh: np.ndarray, total: int) -> np.ndarray:
    """The number of the group of each ordered row."""
    mark = np.zeros(total, np.int64)
    mark[fresh] = 1
    return np.cumsum(mark) - 1


class _Rows:
    """Output rows: packed questions for the bucket of their hash, and packed places for the bucket of
    their document. What a batch says about all its documents takes a row per bucket, not per document."""

    schema = "bucket int, asks boolean, payload binary"

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.rows: list[tuple[int, bool, bytes]] = []

    def ask(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        self.rows += [(b, True, payload) for b, payload in deal(keys, self.buckets, keys, *columns)]

    def tell(self, ids: np.ndarray, marks: np.ndarray, places: np.ndarray) -> None:
        order = np.lexsort([places, marks, ids])
        columns = ids[order], marks[order].astype(np.uint32), places[order].astype(np.int32)
        self.rows += [(b, False, payload) for b, payload in deal(columns[0].astype(np.uint64), self.buckets, *columns)]

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[], [], []]
        kinds = (pa.int32(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "asks", "payload"]
        )


ANCHOR = ("u8", "i8", "i4")  # hash, doc_id, place; a place of -1 asks nothing
SPAN = ("u8", "u4", "i8", "u4", "i4")  # two hashes, doc_id, mark, place
PLACE = ("i8", "u4", "i4")  # doc_id, mark, place


def _anchors(buckets: int, window: int):
    """Aligned anchors of every batch. Those that two documents of the batch share are answered at
    once, and only the smallest and largest id go on, so that a frequent passage leaves each batch as
    two rows; the others ask."""
    period, residues, length = cover_for(window)
    aligned = np.zeros(period, bool)
    aligned[residues] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            found = []
            for low, high in pieces(bounds):
                words = Words(data, bounds, low, high, fold=False)
                owner = words.owner()
                place = np.arange(len(owner)) - words.first[owner]
                room = words.counts[owner]
                at = np.flatnonzero(aligned[place % period] & (room >= window) & (room - place >= length))
                hashes = runs_hash(words.hashes(), length)
                found.append((hashes[at], ids[owner[at] + low], place[at]))
            if not found:
                continue
            hashes, doc, place = (np.concatenate(x) for x in zip(*found, strict=True))
            order, fresh = _groups(hashes, doc)
            if not len(order):
                continue
            hashes, doc, place = hashes[order], doc[order], place[order].astype(np.int32)
            last = np.r_[fresh[1:] - 1, len(order) - 1]
            many = doc[fresh] != doc[last]
            shared = many[_spread(fresh, len(order))]
            rows = _Rows(buckets)
            rows.tell(doc[shared], np.zeros(int(shared.sum()), np.int64), place[shared])
            ends = np.r_[fresh[many], last[many]]
            rows.ask(
                np.r_[hashes[~shared], hashes[ends]], np.r_[doc[~shared], doc[ends]],
                np.r_[place[~shared], np.full(len(ends), -1, np.int32)],
            )
            yield rows.batch()

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch], waiting: dict[int, list[bytes]], asks: bool) -> Iterator[pa.RecordBatch]:
    """Collects the packed rows of a partition by bucket; yields what is of the other kind."""
    for batch in batches:
        for bucket, kind, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if kind == asks:
                waiting[bucket].append(payload)
        if asks:
            yield batch.filter(pc.invert(batch.column("asks")))


def _unpacked(parts: list[bytes], kinds: tuple[str, ...]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*[unpack(p, *kinds) for p in parts], strict=True)]


def _answered(kinds: tuple[str, ...], answer, buckets: int):
    """Answers the questions of a partition, bucket by bucket; places pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[bytes]] = defaultdict(list)
        yield from _by_bucket(batches, waiting, True)
        rows = _Rows(buckets)
        found = [answer(*_unpacked(waiting.pop(bucket), kinds)) for bucket in list(waiting)]
        if found:
            rows.tell(*(np.concatenate(c) for c in zip(*found, strict=True)))
        yield rows.batch()

    return run


def _ranges(before: int, after: int):
    """doc_id, mark and the union of [place - before, place + after) of every document of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[bytes]] = defaultdict(list)
        yield from _by_bucket(batches, waiting, False)
        for bucket in list(waiting):
            ids, marks, places = _unpacked(waiting.pop(bucket), PLACE)
            order = np.lexsort([places, marks, ids])
            ids, marks, places = ids[order], marks[order], places[order].astype(np.int64)
            starts, stops = np.maximum(places - before, 0), places + after
            fresh = np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])]
            cut = np.flatnonzero(fresh | np.r_[True, starts[1:] > stops[:-1]])
            ends = np.r_[cut[1:] - 1, len(places) - 1]
            first = np.flatnonzero(fresh[cut])
            pairs = np.stack([starts[cut], stops[ends]], 1).ravel().astype(np.int32)
            offsets = np.r_[2 * first, len(pairs)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[cut][first]), pa.array(marks[cut][first].astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(pairs))],
                names=["doc_id", "mark", "ranges"],
            )

    return run


def _shared_anchors(hashes, doc, place):
    """Places whose anchor another document has as well."""
    order, fresh = _groups(hashes, doc)
    last = np.r_[fresh[1:] - 1, len(order) - 1]
    ordered = doc[order]
    shared = (ordered[fresh] != ordered[last])[_spread(fresh, len(order))]
    at = order[shared]
    at = at[place[at] >= 0]
    return doc[at], np.zeros(len(at), np.int64), place[at]


def _later(first, second, doc, mark, place):
    """Windows of which a smaller document has another copy."""
    order, fresh = _groups(first, second, doc)
    ordered = doc[order]
    least = ordered[fresh][_spread(fresh, len(order))]
    at = order[ordered > least]
    return doc[at], mark[at].astype(np.int64), place[at]


def _windows(buckets: int, window: int):
    """Windows around shared anchors, by two hashes. Within a batch all but those of the smallest
    document are known to repeat; that one asks whether a smaller document has the window."""
    period, _, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            marks = batch.column("mark").to_numpy(zero_copy_only=False).astype(np.int64)
            ranges = batch.column("ranges")
            found = []
            for low, high in pieces(bounds):
                words = Words(data, bounds, low, high, fold=False)
                runs = [np.array(ranges[i].as_py() or [], np.int64).reshape(-1, 2) for i in range(low, high)]
                owner = np.repeat(np.arange(high - low), [len(r) for r in runs])
                cut = np.concatenate(runs) if runs else np.zeros((0, 2), np.int64)
                # An anchor of another row with this id may lie beyond this row's end.
                starts = np.minimum(cut[:, 0], words.counts[owner])
                stops = np.minimum(cut[:, 1], words.counts[owner] - window + 1)
                at = _ragged(starts, stops)
                owner = np.repeat(owner, np.maximum(stops - starts, 0))
                where = at + words.first[owner]
                one = runs_hash(words.hashes(0), window)[where]
                two = runs_hash(words.hashes(1), window)[where]
                found.append((one, (two >> np.uint64(32)).astype(np.uint32), owner + low, at))
            if not found:
                continue
            one, two, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, mark, at = ids[row], marks[row], at.astype(np.int32)
            order, fresh = _groups(one, two, doc)
            least = np.zeros(0, np.int64) if not len(order) else doc[order][fresh][_spread(fresh, len(order))]
            later = doc[order] > least
            out, asks = order[later], order[~later]
            rows = _Rows(buckets)
            rows.tell(doc[out], mark[out], at[out])
            rows.ask(one[asks], two[asks], doc[asks], mark[asks].astype(np.uint32), at[asks])
            yield rows.batch()

    return run


def _dealt(rows: DataFrame, mapper, kinds: tuple[str, ...], answer, reach: tuple[int, int], buckets: int) -> DataFrame:
    """Ask by hash, answer, and gather by document: (doc_id, mark, ranges)."""
    wide = partitions(rows.sparkSession)
    asked = rows.mapInArrow(mapper, _Rows.schema).repartition(wide, "bucket")
    told = asked.mapInArrow(_answered(kinds, answer, buckets), _Rows.schema).repartition(wide, "bucket")
    return told.mapInArrow(_ranges(*reach), "doc_id long, mark long, ranges array<int>")


def _by_document(docs: DataFrame, ranges: DataFrame, column: str, on: list[str], how: str) -> DataFrame:
    """Bring ranges to their documents: by broadcast if they are counted to be few and short."""
    rows, numbers = ranges.agg(F.count("*"), F.sum(F.size(column))).first()
    few = rows <= BROADCAST_ROWS and (numbers or 0) <= 8 * BROADCAST_ROWS
    return docs.join(F.broadcast(ranges) if few else ranges, on, how)


KEPT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.StringType()),
])


def _kept(window: int):
    @F.pandas_udf(KEPT)
    def cut(texts: pd.Series, copies: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for text, copy, spans in zip(texts, copies, ranges, strict=True):
            words = [] if text is None else SPLIT(text)
            if copy and len(words) >= window:
                rows.append((len(words), len(words), ""))
                continue
            kept, upto = [], 0
            for start, stop in zip(spans[::2], spans[1::2], strict=True) if spans is not None else ():
                kept += words[upto:start]
                upto = stop
            kept += words[upto:]
            rows.append((len(words), len(words) - len(kept), " ".join(kept)))
        return pd.DataFrame(rows, columns=KEPT.names)

    return cut


def _removed(docs: DataFrame, mark: Column, window: int, scratch: Scratch) -> DataFrame:
    """doc_id, mark, ranges and whether all of the text is a copy, for the rows that lose something."""
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    period, _, _ = cover_for(window)
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), mark, F.unhex(F.md5("text")).alias("hash"), "text"
    )
    ids = scratch.staged(rows.select("doc_id", "mark", "hash"), "passages-ids")
    groups = ids.groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = scratch.staged(
        ids.join(groups, "hash").where("doc_id > first").select("doc_id", "hash").distinct(), "passages-copies"
    )
    few = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    originals = rows.join(few, ["doc_id", "hash"], "left_anti").select("doc_id", "mark", "text")

    # Few rows: rebalanced, so that not every task writes a file of a few of them.
    candidates = scratch.staged(
        _dealt(originals, _anchors(buckets, window), ANCHOR, _shared_anchors, (period - 1, 1), buckets)
        .drop("mark").hint("rebalance"),
        "passages-candidates",
    )
    around = _by_document(originals, candidates, "ranges", ["doc_id"], "inner")
    windows = _dealt(around, _windows(buckets, window), SPAN, _later, (0, window), buckets)
    whole = copies.join(ids, ["doc_id", "hash"]).select("doc_id", "mark").distinct()
    return windows.withColumn("copy", F.lit(False)).unionByName(
        whole.select("doc_id", "mark", F.array().cast("array<int>").alias("ranges"), F.lit(True).alias("copy"))
    )


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of `docs` with a struct column `cut`: n_words, n_removed, kept (the words that stay,
    joined by one space).

    A word is removed if it lies in `window` consecutive words that also start somewhere in a
    document with a smaller doc_id; this is judged on the input.

    Two copies of a window need not begin at the same residue, but a difference cover of the period
    holds two residues of any difference: some anchor of `window - period + 1` words lies at a cover
    position in both. So only anchors at cover positions are hashed and dealt by hash. Windows around
    anchors that two documents share are then hashed (96 bits) and dealt to find the smallest id.
    Before that, exact copies of a text are settled by its 128-bit hash.

    * Null texts and texts of fewer words than a window lose nothing. A null doc_id is neither smaller
      nor larger than another: such rows lose nothing and cost nobody a word.
    * Rows that share a doc_id don't count against each other; repeated rows are treated alike.
    * Empty tables are fine. Other columns pass through; a column `cut` must not exist.

    A passage of any number of documents leaves each batch as two anchors and one window. Nothing is
    collected; memory is a batch, or a partition of dealt rows.
    """
    if "cut" in docs.columns:
        raise ValueError("the documents have a column cut already")
    mark = F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("mark")
    with Scratch(docs.sparkSession) as scratch:
        removed = staged(_removed(docs, mark, window, scratch).hint("rebalance"), "passages-removed")
    removed = removed.toDF("__id", "__mark", "__ranges", "__copy")
    marked = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__mark", mark)
    joined = _by_document(marked, removed, "__ranges", ["__id", "__mark"], "left")
    cut = _kept(window)("text", F.coalesce("__copy", F.lit(False)), "__ranges")
    return joined.withColumn("cut", cut).select(*docs.columns, "cut")
