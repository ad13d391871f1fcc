"""Context-tree weighting over bytes: keys of contexts, and a model of bounded size as a scoring automaton.

The automaton leaves out rare contexts. `weighting` has the model with all of them.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, partitions
from tidemark.llm.words import LOWER, PIECE, in_parts, mix64, pack, unpack

DEPTH = 7  # bytes of context; with the byte itself a key has 64 bits
WIDE = 4  # bytes of context that decide where a key is counted
#: A context is split further only if it has at least 2 ** -SHARE of all bytes, so no depth has more than
#: 2 ** SHARE contexts, whatever the size of the corpus. Rarer ones are one leaf of the context before.
SHARE = 16
END = 10  # a text is its words with single spaces, ended by a line feed; contexts don't reach beyond it


def normal_text(text: str | None) -> bytes:
    """A-Z in lower case, words joined by a space, one end."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(LOWER).split()) + b"\n"


def normal_batch(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, ends of texts) of pieces of a batch; each piece holds whole texts."""
    parts, size, low = [], 0, 0
    for i, text in enumerate(texts):
        parts.append(normal_text(text.as_py()))
        size += len(parts[-1])
        if size >= PIECE:
            yield low, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
            parts, size, low = [], 0, i + 1
    if parts:
        yield low, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def context_keys(data: np.ndarray) -> np.ndarray:
    """For each byte its context, the nearest byte highest, and the byte itself lowest."""
    key = data.astype(np.uint64)
    ended = np.zeros(len(data), bool)
    for back in range(1, DEPTH + 1):
        before = np.full(len(data), END, np.uint8)
        before[back:] = data[:-back]
        before[ended] = END
        ended |= before == END
        key |= before.astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
    return key


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = []
            for _, data, _ in normal_batch(batch.column("text")):
                keys = context_keys(data)
                keys.sort()
                cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                found.append((keys[cut], np.diff(np.r_[cut, len(keys)]).astype(np.uint32)))
            if not found:
                continue
            keys, counts = _merged(*(np.concatenate(c) for c in zip(*found, strict=True)))
            where = ((mix64(keys >> np.uint64(8 * (DEPTH + 1 - WIDE))) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(where, kind="stable")
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
                # Sorted keys are close to each other: their differences are short.
                steps = np.diff(keys[part], prepend=np.uint64(0))
                rows.append((int(where[part[0]]), pack(steps, counts[part].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], names=["bucket", "payload"]
            )

    return run


COUNTS = "depth int, context long, byte int, n long"


def _frequent(least: int):
    """Counts of the bytes after frequent contexts, and of all after the shortest that are counted here."""

    def table(depth: int, keys: np.ndarray, counts: np.ndarray, all_: bool) -> pa.RecordBatch:
        context = keys >> np.uint64(8 * (DEPTH + 1 - depth))
        if not all_:
            cut = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            keep = np.repeat(np.add.reduceat(counts, cut) >= least, np.diff(np.r_[cut, len(context)]))
            context, keys, counts = context[keep], keys[keep], counts[keep]
        pairs, n = _merged((context << np.uint64(8)) | (keys & np.uint64(255)), counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), depth, np.int32)), pa.array((pairs >> np.uint64(8)).astype(np.int64)),
             pa.array((pairs & np.uint64(255)).astype(np.int32)), pa.array(n)],
            names=["depth", "context", "byte", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[bytes]] = defaultdict(list)
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting[bucket].append(payload)
        for bucket in list(waiting):
            parts = [unpack(p, "u8", "u4") for p in waiting.pop(bucket)]
            keys = np.concatenate([np.cumsum(steps) for steps, _ in parts])
            keys, counts = _merged(keys, np.concatenate([c for _, c in parts]).astype(np.int64))
            yield table(WIDE - 1, keys, counts, True)
            for depth in range(WIDE, DEPTH + 1):
                yield table(depth, keys, counts, False)

    return run


def context_counts(texts: DataFrame, scratch: Scratch, share: int = SHARE) -> DataFrame:
    """(depth, context, byte, n) over the column `text`, for every context with a `share` of the bytes.

    Each batch counts its own keys first; keys are dealt by their nearest bytes, so all depths beyond
    those are complete where they are merged, and only frequent contexts leave that task.
    """
    spark = texts.sparkSession
    bytes_ = texts.select(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    least = max(1, bytes_ >> share)
    wide = partitions(spark)
    dealt = texts.select("text").mapInArrow(_count(4 * wide), "bucket int, payload binary").repartition(wide, "bucket")
    deep = dealt.mapInArrow(_frequent(least), COUNTS).groupBy("depth", "context", "byte").agg(F.sum("n").alias("n"))
    deep = scratch.staged(deep, "ctw-counts")
    near = deep.where(F.col("depth") == WIDE - 1)
    levels = near.select(F.explode(F.sequence(F.lit(0), F.lit(WIDE - 1))).alias("to"), "context", "byte", "n")
    shorter = levels.groupBy(
        F.col("to").alias("depth"), F.expr(f"shiftright(context, 8 * ({WIDE - 1} - to))").alias("context"), "byte"
    ).agg(F.sum("n").alias("n"))
    counts = shorter.unionByName(deep.where(F.col("depth") >= WIDE))
    kept = counts.groupBy("depth", "context").agg(F.sum("n").alias("total")).where((F.col("total") >= least) | (F.col("depth") == 0))
    return counts.join(kept.drop("total"), ["depth", "context"])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for i in range(6):
        out -= np.log(x + i)
    x = x + 6
    return out + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that Krichevsky and Trofimov's estimator gives to so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


class Automaton:
    """State = the longest known context: log10 of each byte's probability, and the state after it.

    Only contexts and probabilities travel; transitions follow from the contexts and are made where
    the automaton is used.
    """

    def __init__(self, contexts: list[np.ndarray], cost: np.ndarray):
        self.contexts, self.cost = contexts, cost  # by depth, sorted; states x 256
        self._after: np.ndarray | None = None
        self.start = 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_after": None}

    def _transitions(self) -> np.ndarray:
        """A state goes on like the one of its nearest bytes, unless a longer context is known."""
        contexts, base = self.contexts, _bases(self.contexts)
        after = np.zeros((base[-1], 256), np.int32)
        for depth, own in enumerate(contexts):
            if depth:
                shorter = np.searchsorted(contexts[depth - 1], own >> np.uint64(8))
                after[base[depth] : base[depth + 1]] = after[base[depth - 1] + shorter]
            if depth < DEPTH and len(longer := contexts[depth + 1]):
                byte = (longer >> np.uint64(8 * depth)).astype(np.int64)
                before = np.searchsorted(own, longer & np.uint64((1 << (8 * depth)) - 1))
                after[base[depth] + before, byte] = base[depth + 1] + np.arange(len(longer))
        ended = 0
        for depth in range(1, DEPTH + 1):
            ended = ended << 8 | END
            at = int(np.searchsorted(contexts[depth], np.uint64(ended)))
            if at == len(contexts[depth]) or int(contexts[depth][at]) != ended:
                break
            self.start = int(base[depth]) + at
        after[:, END] = self.start
        return after

    def score(self, data: np.ndarray, ends: np.ndarray, lane: int = 1024) -> np.ndarray:
        """log10 probability of each text of a piece, in lanes that run side by side: DEPTH bytes
        before a lane determine its state."""
        if self._after is None:
            self._after = self._transitions()
        lanes = -(-len(data) // lane)
        padded = np.full(DEPTH + lanes * lane, END, np.uint8)
        padded[DEPTH : DEPTH + len(data)] = data
        cost, after = self.cost.ravel(), self._after.ravel()
        found = np.empty((lane, lanes), np.float32)
        state = np.zeros(lanes, np.int64)
        state[0] = self.start
        begin = np.arange(lanes) * lane
        for step in range(DEPTH + lane):
            at = state * 256 + padded[begin + step]
            if step >= DEPTH:
                found[step - DEPTH] = cost[at]
            state = after[at]
        single = found.T.ravel()[: len(data)].astype(np.float64)
        return np.add.reduceat(single, np.r_[0, ends[:-1]]) if len(ends) else np.zeros(0)


def _bases(contexts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0] + [len(c) for c in contexts])


def _four_bits(leaves: list[np.ndarray], parents: list[np.ndarray | None]) -> np.ndarray:
    """log10 probability of each of 16 outcomes of four binary decisions, for the contexts of all
    depths one after another. `leaves` counts the outcomes by depth and context."""
    trees = []
    for leaf in leaves:
        tree = np.concatenate([np.zeros_like(leaf), leaf], 1)
        for node in range(15, 0, -1):
            tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
        trees.append(tree)

    def over_children(depth: int, values: np.ndarray) -> np.ndarray:
        """Sums over the children of each context of a depth; they are in the order of their parents."""
        out = np.zeros((len(leaves[depth]), values.shape[1]))
        if len(values):
            parent = parents[depth + 1]
            cut = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            out[parent[cut]] = np.add.reduceat(values, cut, axis=0)
        return out

    weights, rest_ones, below = [None] * (DEPTH + 1), [None] * (DEPTH + 1), None
    for depth in range(DEPTH, -1, -1):
        tree = trees[depth]
        own = log_kt(tree[:, 2::2], tree[:, 3::2])
        rest = tree if depth == DEPTH else np.maximum(tree - over_children(depth, trees[depth + 1]), 0)
        split = log_kt(rest[:, 2::2], rest[:, 3::2])
        if depth < DEPTH:
            split += over_children(depth, below)
        below = np.logaddexp(own, split) - math.log(2)
        weights[depth] = np.exp(own - math.log(2) - below)
        rest_ones[depth] = (rest[:, 3::2] + 0.5) / (rest[:, 2::2] + rest[:, 3::2] + 1)

    out, mixed, left = [], None, None
    for depth in range(DEPTH + 1):
        tree, weight = trees[depth], weights[depth]
        ones = (tree[:, 3::2] + 0.5) / (tree[:, 2::2] + tree[:, 3::2] + 1)
        if depth == 0:
            mixed, left = weight * ones, 1.0 - weight
        else:
            mixed = mixed[parents[depth]] + left[parents[depth]] * weight * ones
            left = left[parents[depth]] * (1.0 - weight)
        one = mixed + left * rest_ones[depth]
        bits = np.zeros((len(tree), 32))
        for node in range(1, 16):
            bits[:, 2 * node] = bits[:, node] + np.log10(1 - one[:, node - 1])
            bits[:, 2 * node + 1] = bits[:, node] + np.log10(one[:, node - 1])
        out.append(bits[:, 16:])
    return np.concatenate(out)


def automaton(counts: DataFrame) -> Automaton:
    """The weighted model of `context_counts`, whose size is bounded by the share that a context needs.

    Each of the 255 binary decisions that make up a byte has a context tree of its own. A node mixes
    its KT estimate, half and half, with the product over its children: the frequent longer contexts
    and one leaf for all others. What the corpus says about each node's weight is kept; scoring doesn't
    learn, so texts are scored independently of each other.

    The trees are worked out four decisions of a byte at a time, as they don't depend on each other.
    """
    table = counts.toArrow()
    columns = {n: table.column(n).to_numpy() for n in ("depth", "context", "byte", "n")}
    del table
    contexts, entries = [], []
    for depth in range(DEPTH + 1):
        rows = columns["depth"] == depth
        own, place = np.unique(columns["context"][rows].astype(np.uint64), return_inverse=True)
        if depth == 0 and not len(own):
            own, place = np.zeros(1, np.uint64), np.zeros(0, int)
        contexts.append(own)
        entries.append((place, columns["byte"][rows], columns["n"][rows]))
    parents = [None] + [np.searchsorted(contexts[d], contexts[d + 1] >> np.uint64(8)) for d in range(DEPTH)]

    def leaves(high: int | None) -> list[np.ndarray]:
        """Counts of the high halves of bytes, or of the low halves after one high half."""
        out = []
        for own, (place, byte, n) in zip(contexts, entries, strict=True):
            part = slice(None) if high is None else byte >> 4 == high
            half = byte >> 4 if high is None else byte & 15
            flat = np.bincount(place[part] * 16 + half[part], n[part], len(own) * 16)
            out.append(flat.astype(np.float64).reshape(len(own), 16))
        return out

    first = _four_bits(leaves(None), parents)
    cost = np.empty((len(first), 256), np.float32)
    for high in range(16):
        cost[:, 16 * high : 16 * high + 16] = first[:, high : high + 1] + _four_bits(leaves(high), parents)
    return Automaton(contexts, cost)
