"""Context-tree weighting over every context of a corpus, in buckets by the nearest bytes of a context.

A key is a byte with the seven bytes before it (`ctw.context_keys`). All contexts of `NEAR` bytes and more
are weighted in the bucket of their nearest bytes; what is left are contexts of up to two bytes, at most
2 ** 16 whatever the corpus, which are weighted from the sums of the buckets.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import Scratch, partitions
from tidemark.llm.ctw import DEPTH, context_keys, log_kt, normal_batch
from tidemark.llm.words import PIECE, give_back, in_parts, mix64, pack, pieces, unpack

NEAR = 3  # bytes of context that decide where a key is counted
PART = 16 * PIECE  # bytes of text whose distinct keys are sent at once
MODEL, TOP_NODES, TOP_PAIRS = 10, 11, 12
KEPT = "bucket int, kind int, block long, payload binary"
LOG2 = math.log(2)

_SMALL = 1 << 12
_HALF = np.array([math.lgamma(i + 0.5) - 0.5 * math.log(math.pi) for i in range(_SMALL)])
_WHOLE = np.array([math.lgamma(i + 1) for i in range(_SMALL)])


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """`ctw.log_kt` of counts, looked up where they are small."""
    total = zeros + ones
    large = total >= _SMALL
    if not large.any():
        return _HALF[zeros] + _HALF[ones] - _WHOLE[total]
    out = np.empty(len(total))
    out[large] = log_kt(zeros[large].astype(float), ones[large].astype(float))
    small = ~large
    out[small] = _HALF[zeros[small]] + _HALF[ones[small]] - _WHOLE[total[small]]
    return out


def pack_planes(values: np.ndarray) -> bytes:
    """Values byte by byte of their places: the high bytes of close values are alike."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_planes(payload: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return pack_planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(payload: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(payload, "u8"), dtype=np.uint64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts; `keys` is sorted in place."""
    keys.sort()
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[cut], np.diff(np.r_[cut, len(keys)])


def deal_keys(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in `keys`) for each bucket; places keep their order."""
    return deal_places(keys >> np.uint64(8 * (DEPTH + 1 - NEAR)), buckets)


def deal_places(values: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The same, by the hash of values."""
    if not len(values):
        return
    bucket = ((mix64(values) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield int(bucket[places[0]]), places


class Counted:
    """Sorted distinct keys and counts, added up from many short runs without holding them all apart."""

    def __init__(self) -> None:
        self.keys, self.counts, self._runs, self._held = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._runs.append((keys, counts))
        self._held += len(keys)
        if self._held > max(len(self.keys), PIECE):
            self.settle()

    def settle(self) -> Counted:
        keys = np.concatenate([self.keys, *(k for k, _ in self._runs)])
        counts = np.concatenate([self.counts, *(c for _, c in self._runs)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        self.keys, self.counts = keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts
        self._runs, self._held = [], 0
        return self


@dataclass
class Level:
    """The (context, byte) pairs of a depth, sorted, their counts, and where each is in the depth before."""

    pairs: np.ndarray
    counts: np.ndarray
    place: np.ndarray | None = None


def levels(pairs: np.ndarray, counts: np.ndarray, deepest: int, least: int) -> list[Level]:
    """The levels of depth `least` to `deepest`."""
    out = []
    for _ in range(deepest - least):
        # The byte farthest away lies next to the byte itself.
        shorter = (pairs >> np.uint64(16) << np.uint64(8)) | (pairs & np.uint64(255))
        order = np.argsort(shorter, kind="stable")
        shorter = shorter[order]
        fresh = np.r_[True, shorter[1:] != shorter[:-1]][: len(shorter)]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(fresh) - 1
        out.append(Level(pairs, counts, place))
        cut = np.flatnonzero(fresh)
        pairs, counts = shorter[cut], np.add.reduceat(counts[order], cut) if len(cut) else counts
    out.append(Level(pairs, counts))
    return out[::-1]


@dataclass
class Nodes:
    """The nodes of one level for one decision: a context and the bits of the byte that are decided already."""

    ids: np.ndarray
    node: np.ndarray  # of each pair
    parent: np.ndarray | None  # of each node, in the level before
    weight: np.ndarray  # the share of the node's own estimate
    ones: np.ndarray  # that estimate
    below: np.ndarray  # log of the weighted probability


def weigh(tree: list[Level], bit: int, split: np.ndarray | None = None) -> list[Nodes]:
    """The nodes of all levels for a decision. `split` is the log probability of what lies below the deepest
    nodes; without it they are leaves.

    Keys with a count of zero may be among the pairs. They weigh nothing: their nodes have probability one,
    and one half for each outcome.
    """
    raw, out, values = [], [], None
    for level in tree:
        ids = level.pairs >> np.uint64(8 - bit)
        fresh = np.r_[True, ids[1:] != ids[:-1]][: len(ids)]
        raw.append((ids, np.flatnonzero(fresh), np.cumsum(fresh) - 1))
    for depth in range(len(tree) - 1, -1, -1):
        level, (ids, first, node) = tree[depth], raw[depth]
        parent = None if level.place is None else raw[depth - 1][2][level.place[first]]
        is_one = (level.pairs >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        ones = np.add.reduceat(np.where(is_one, level.counts, 0), first) if len(first) else np.zeros(0, np.int64)
        total = np.add.reduceat(level.counts, first) if len(first) else np.zeros(0, np.int64)
        own = _log_kt(total - ones, ones)
        if depth == len(tree) - 1 and split is None:
            below, weight = own, np.full(len(own), 0.5)
        else:
            inner = split if depth == len(tree) - 1 else np.bincount(*values, minlength=len(own))
            below = np.logaddexp(own, inner) - LOG2
            weight = np.exp(own - LOG2 - below)
        values = (parent, below)
        out.append(Nodes(ids[first], node, parent, weight, (ones + 0.5) / (total + 1), below))
    return out[::-1]


class Top:
    """The weighted contexts of fewer than `NEAR` bytes, from what the buckets say about them."""

    def __init__(self, rows: list[tuple[int, int, bytes]]) -> None:
        """`rows`: (kind, decision, payload)."""
        found = [unpack(p, "u8", "i8") for kind, _, p in rows if kind == TOP_PAIRS]
        counted = Counted()
        for keys, counts in found:
            counted.add(keys, counts)
        counted.settle()
        tree = levels(counted.keys, counted.counts, NEAR - 1, 0)
        self.nodes = []
        for bit in range(8):
            ids = np.unique(counted.keys >> np.uint64(8 - bit))
            split = np.zeros(len(ids))
            for kind, own, payload in rows:
                if kind == TOP_NODES and own == bit:
                    node, below = unpack(payload, "u8", "f8")
                    split[np.searchsorted(ids, node)] += below
            self.nodes.append([(n.ids, n.weight, n.ones) for n in weigh(tree, bit, split)])

    def reach(self, ids: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """For nodes of `NEAR` - 1 bytes: what shorter contexts say about a one, and the share left to longer ones."""
        mixed, left = np.zeros(len(ids)), np.ones(len(ids))
        for depth, (known, weight, ones) in enumerate(self.nodes[bit]):
            own = (ids >> np.uint64(bit + 8 * (NEAR - 1 - depth)) << np.uint64(bit)) | (ids & np.uint64((1 << bit) - 1))
            share, estimate = np.full(len(ids), 0.5), np.full(len(ids), 0.5)
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = known[at] == own
                share[hit], estimate[hit] = weight[at[hit]], ones[at[hit]]
            mixed += left * share * estimate
            left *= 1 - share
        return mixed, left


def costs(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 of the probability of each key's byte after its context. The keys are those of one bucket, all that
    were learnt and any others with a count of zero."""
    out = np.zeros(len(keys))
    tree = levels(keys, counts, DEPTH, NEAR)
    for bit in range(8):
        nodes = weigh(tree, bit)
        first = nodes[0].ids
        shorter = (first >> np.uint64(bit + 8) << np.uint64(bit)) | (first & np.uint64((1 << bit) - 1))
        mixed, left = top.reach(shorter, bit)
        for depth, level in enumerate(nodes):
            if depth:
                mixed, left = mixed[level.parent], left[level.parent]
            if depth == len(nodes) - 1:
                mixed = mixed + left * level.ones
            else:
                mixed, left = mixed + left * level.weight * level.ones, left * (1 - level.weight)
        is_one = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        one = mixed[nodes[-1].node]
        out += np.log10(np.where(is_one, one, 1 - one))
    return out


def in_large_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut to about `PART` bytes of text: the more, the more often keys repeat."""
    held, size = [], 0
    for part in in_parts(batches, PART):
        own = part.column("text").nbytes
        if held and size + own > PART:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(part)
        size += own
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def normal_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and how many each has."""
    data, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for _, piece, ends in normal_batch(texts):
        data.append(piece)
        sizes.append(np.diff(ends, prepend=0))
    return np.concatenate(data), np.concatenate(sizes)


def all_keys(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The keys of all bytes, worked out for a few texts at a time."""
    bounds, out = np.r_[0, np.cumsum(sizes)], np.empty(len(data), np.uint64)
    for low, high in pieces(bounds):
        out[bounds[low] : bounds[high]] = context_keys(data[bounds[low] : bounds[high]])
    return out


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_large_parts(batches):
            keys, counts = distinct(all_keys(*normal_bytes(batch.column("text"))))
            rows = [(b, pack_keys(keys[at]), pack_planes(counts[at].astype(np.uint32))) for b, at in deal_keys(keys, buckets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                names=["bucket", "keys", "counts"],
            )

    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each bucket as one row, and what they add to the contexts that are shorter."""
    waiting: dict[int, list[tuple[bytes, bytes]]] = defaultdict(list)
    for batch in batches:
        for bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            waiting[bucket].append((keys, counts))
    for bucket in list(waiting):
        counted = Counted()
        for keys, counts in waiting.pop(bucket):
            counted.add(unpack_keys(keys), unpack_planes(counts, "u4").astype(np.int64))
        counted.settle()
        rows = [(bucket, MODEL, 0, pack_model(counted.keys, counted.counts))]
        tree = levels(counted.keys, counted.counts, DEPTH, NEAR - 1)
        rows.append((bucket, TOP_PAIRS, 0, pack(tree[0].pairs, tree[0].counts)))
        for bit in range(8):
            shortest = weigh(tree[1:], bit)[0]
            ids = (shortest.ids >> np.uint64(bit + 8) << np.uint64(bit)) | (shortest.ids & np.uint64((1 << bit) - 1))
            own, place = np.unique(ids, return_inverse=True)
            rows.append((bucket, TOP_NODES, bit, pack(own, np.bincount(place, shortest.below, len(own)))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
            names=["bucket", "kind", "block", "payload"],
        )
        give_back()


def pack_model(keys: np.ndarray, counts: np.ndarray) -> bytes:
    planes = pack_keys(keys)
    return len(planes).to_bytes(8, "little") + planes + pack_planes(counts)


def unpack_model(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = 8 + int.from_bytes(payload[:8], "little")
    return unpack_keys(payload[8:at]), unpack_planes(payload[at:], "i8")


def learn(texts: DataFrame, scratch: Scratch, buckets: int) -> tuple[DataFrame, Top]:
    """Every context of the column `text`: a row (bucket, kind, block, payload) with the counts of each bucket, for
    `costs`, and the weighted short contexts."""
    wide = partitions(texts.sparkSession)
    dealt = texts.select("text").mapInArrow(_count(buckets), "bucket int, keys binary, counts binary").repartition(wide, "bucket")
    kept = scratch.staged(dealt.mapInArrow(_weigh, KEPT), "contexts")
    # At most 2 ** 16 contexts in all, sums of the buckets they occur in.
    short = kept.where(f"kind <> {MODEL}").orderBy("bucket", "kind", "block").toArrow()
    top = Top(list(zip(*(short.column(n).to_pylist() for n in ("kind", "block", "payload")), strict=True)))
    return kept.where(f"kind = {MODEL}"), top
