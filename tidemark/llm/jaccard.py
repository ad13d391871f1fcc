"""Near-duplicate sets of word n-grams: group counts in an R-tree, exact verification."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, Scratch, partitions, staged
from tidemark.llm.components import components
from tidemark.llm.words import Words, deal, in_parts, mix64, pieces, runs_hash, text_bytes, trimmed, unpack

DIMENSIONS = 512  # token groups that are the coordinates of a point
FAN = 8  # entries of a tree node
BUCKETS_PER_PARTITION = 4
HASH_BITS = 53  # a piece holds at most 2 ** 11 texts
MOST_NEEDED = 2**14 - 1  # shared keys that are counted on, with two bits in two bytes
NO_ID = 2**63 - 1  # stands for a null doc_id: larger than any other

_HASH = np.uint64(2**HASH_BITS - 1)
NODE = "id long, mark long"


class Limit:
    """Jaccard similarity of at least part / whole, in integers."""

    def __init__(self, part: int, whole: int):
        if not 0 < part <= whole:
            raise ValueError(f"{part} / {whole} is no similarity")
        self.part, self.whole = part, whole

    def linked(self, shared: int, one: int, two: int) -> bool:
        return self.whole * shared >= self.part * (one + two - shared)

    def differences(self, total: int) -> int:
        """How many tokens only one of two similar sets may have, if their sizes add up to `total`."""
        return total * (self.whole - self.part) // (self.whole + self.part)

    def classes(self, largest: int) -> np.ndarray:
        """Lower ends of size classes: similar sets are in the same class or in neighbouring ones."""
        ends = [1]
        while ends[-1] <= largest:
            ends.append(ends[-1] * self.whole // self.part + 1)
        ends.append(ends[-1] * self.whole // self.part + 1)
        ends.append(ends[-1] * self.whole // self.part + 1)
        return np.array(ends, np.int64)

    def groups(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences allowed and token groups used where the larger set is in each class."""
        allowed = np.array([self.differences(2 * (int(e) - 1)) for e in ends[1:]], np.int64)
        return allowed, (allowed + 1) * 11 // 10 + 3


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, 53-bit hash) of the distinct runs of `size` words, in order; a shorter text is one run."""
    hashes = words.hashes()
    runs = runs_hash(hashes, size)
    owner = words.owner()
    whole = np.flatnonzero(words.counts[owner] - (np.arange(len(owner)) - words.first[owner]) >= size)
    owners, values = [owner[whole]], [runs[whole]]
    for short in range(1, size):
        texts = np.flatnonzero(words.counts == short)
        if len(texts):
            owners.append(texts)
            values.append(runs_hash(hashes, short)[words.first[texts]] + np.uint64(short))
    packed = (np.concatenate(owners).astype(np.uint64) << np.uint64(HASH_BITS)) | (
        mix64(np.concatenate(values)) & _HASH
    )
    packed.sort()
    if len(packed):
        packed = packed[np.r_[True, packed[1:] != packed[:-1]]]
    return (packed >> np.uint64(HASH_BITS)).astype(np.int64), packed & _HASH


def _signature(owner: np.ndarray, tokens: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit hash of each set."""
    sizes = np.bincount(owner, minlength=count)
    one, two = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    if len(tokens):
        filled = np.flatnonzero(sizes)
        begin = (np.cumsum(sizes) - sizes)[filled]
        one[filled] = np.add.reduceat(mix64(tokens + np.uint64(1)), begin)
        two[filled] = np.add.reduceat(mix64(tokens ^ np.uint64(0x5BF0_3635_DCF9_A6C1)), begin)
    return sizes, one, two


def _sets(size: int, fold: bool):
    """id, n_shingles and signature of every row."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            parts = []
            for low, high in pieces(bounds, most=2**11):
                words = Words(data, bounds, low, high, fold)
                parts.append(_signature(*shingles(words, size), high - low))
            if parts:
                sizes, one, two = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    names=["id", "key", "n_shingles", "one", "two"],
                )

    return run


def _keys(owner: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, limit: Limit):
    """(text, key, need): similar sets that differ share one of their keys, and `need` of those of a level.

    The tokens of a set are dealt to groups by hash. Sets that differ in at most d tokens differ in at
    most d groups, so a set with more than d filled groups has one in common, whole, with the other.
    The number of groups depends on the size class of the larger set, which is the own class or the
    next. A set with too few filled groups only misses others like it; these share an extra key, which is a
    level of its own. The lowest two bits of `need` tell the levels of a text apart.
    """
    texts, keys, needs = [], [], []
    if not len(tokens):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    ends = limit.classes(int(sizes.max()))
    allowed, groups = limit.groups(ends)
    own = np.searchsorted(ends, sizes, "right") - 1
    for up in (0, 1):
        level = np.maximum(own + up, 0)
        reach = sizes * limit.whole // limit.part
        used = (sizes > 0) & (allowed[level] > 0) & ((up == 0) | (reach >= ends[level]))
        width = np.where(used, groups[level], 0)
        base = np.cumsum(width) - width
        take = used[owner]
        who, token = owner[take], tokens[take]
        cell = base[who] + (token % groups[level][who].astype(np.uint64)).astype(np.int64)
        total = int(width.sum())
        value = np.zeros(total, np.uint64)
        np.add.at(value, cell, mix64(token + np.uint64(77)))
        filled = np.flatnonzero(np.bincount(cell, minlength=total))
        text = np.repeat(np.arange(len(sizes)), width)[filled]
        place = filled - base[text]
        salt = mix64((level[text].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1))
        texts.append(text)
        keys.append(mix64(value[filled] + salt))
        count = np.bincount(text, minlength=len(sizes))
        most = limit.differences(sizes + np.minimum(reach, ends[level + 1] - 1))
        needs.append(np.clip(count - most, 1, MOST_NEEDED)[text] * 4 + 2 * up)
        scarce = np.flatnonzero(used & (count <= allowed[level]))
        texts.append(scarce)
        keys.append(mix64(mix64(level[scarce].astype(np.uint64) + np.uint64(5)) + np.uint64(9)))
        needs.append(np.full(len(scarce), 4 + 2 * up + 1))
    return np.concatenate(texts), np.concatenate(keys), np.concatenate(needs).astype(np.uint16)


def _ordered(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the columns, the first one first, and where its values begin."""
    order = np.lexsort(columns[::-1])
    first = columns[0][order]
    return order, np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(order) else np.zeros(0, int)


def _shared(keys: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are the least node of each key, and rows of all nodes of keys that several nodes have."""
    order, _ = _ordered(keys, ids, marks)
    k, i, m = keys[order], ids[order], marks[order]
    if len(order):
        order = order[np.r_[True, (k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (m[1:] != m[:-1])]]
        k = keys[order]
    fresh = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(order) else np.zeros(0, int)
    counts = np.diff(np.r_[fresh, len(order)])
    return order[fresh], order[np.repeat(counts > 1, counts)]


MEMBER = ["key", "id", "mark", "need"]
MEMBERS = ", ".join(["bucket int", "payload binary", *(f"{name} long" for name in MEMBER)])


def _member_batch(packed: list[tuple[int, bytes]], keys: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    n, none = len(packed), np.zeros(len(packed), np.int64)
    told = np.r_[np.ones(n, bool), np.zeros(len(keys), bool)]
    anywhere = mix64(keys) % np.uint64(2**20)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([b for b, _ in packed] + anywhere.tolist(), pa.int32()),
            pa.array([p for _, p in packed] + [None] * len(keys), pa.binary()),
            *[pa.array(np.r_[none, c.astype(np.int64)], mask=told) for c in (keys.view(np.int64), *more)],
        ],
        names=["bucket", "payload", *MEMBER],
    )


def _batch_keys(batch: pa.RecordBatch, size: int, fold: bool, limit: Limit):
    """Row, key, need and mark of each key of a batch. A row that is a copy (`spare`) counts as empty."""
    data, bounds = text_bytes(batch.column("text"))
    parts, marks = [], np.zeros(batch.num_rows, np.int64)
    for low, high in pieces(bounds, most=2**11):
        words = Words(data, bounds, low, high, fold)
        owner, token = shingles(words, size)
        n, one, _ = _signature(owner, token, high - low)
        marks[low:high] = _mark(one)
        spare = batch.column("spare").slice(low, high - low).to_pylist()
        chosen = np.array([s is None or int(m) not in s for s, m in zip(spare, marks[low:high], strict=True)], bool)
        keep = chosen[owner]
        text, *found = _keys(owner[keep], token[keep], np.where(chosen, n, 0), limit)
        parts.append((text + low, *found))
    rows, keys, needs = (np.concatenate(c) for c in zip(*parts, strict=True))
    return rows, keys, needs, marks[rows]


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _mark(one: np.ndarray) -> np.ndarray:
    return (one >> np.uint64(32)).astype(np.int64)


def _first_round(size: int, fold: bool, limit: Limit, buckets: int):
    """Keys of every part of a batch, a frequent one once; nodes that share one are told at once."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows, keys, needs, marks = _batch_keys(batch, size, fold, limit)
            members = (keys, _longs(batch, "id")[rows], marks.astype(np.uint32), needs)
            heads, told = _shared(*members[:3])
            heads = np.sort(heads)
            packed = list(deal(keys[heads], buckets, *[c[heads] for c in members]))
            yield _member_batch(packed, *[c[told] for c in members])

    return run


@trimmed
def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of all batches that share a key."""
    waiting: dict[int, list[bytes]] = defaultdict(list)
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            if payload is not None:
                waiting[bucket].append(payload)
        yield batch.filter(batch.column("payload").is_null()).select(MEMBER)
    for bucket in list(waiting):
        parts = [unpack(p, "u8", "i8", "u4", "u2") for p in waiting.pop(bucket)]
        members = [np.concatenate(c) for c in zip(*parts, strict=True)]
        _, told = _shared(*members[:3])
        yield _member_batch([], *[c[told] for c in members]).select(MEMBER)


class RTree:
    """Points (group counts) packed into nodes of FAN entries, level by level, sorted along the
    coordinates that vary most; a node knows the largest count in each group and the least size."""

    def __init__(self, points: np.ndarray):
        order = np.arange(len(points))
        if len(points) > FAN:
            squares = np.einsum("ij,ij->j", points, points, dtype=np.int64)
            by_spread = np.argsort((points.sum(0) / len(points)) ** 2 - squares / len(points))[:3]
            order = np.lexsort([points[:, by_spread[1]], points[:, by_spread[0]], points.sum(1) // 4])
        self.order = order
        self.tops, self.least = [points[order]], [points[order].sum(1)]
        while len(self.tops[-1]) > 1:
            starts = np.arange(0, len(self.tops[-1]), FAN)
            self.tops.append(np.maximum.reduceat(self.tops[-1], starts, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], starts))

    def pairs(self, limit: Limit) -> Iterator[np.ndarray]:
        """Pairs (i < j) of points whose overlap, at most the sum of the smaller counts of each group,
        can reach the limit."""
        yield from self._below(np.zeros((1, 2), np.int64), len(self.tops) - 1, limit)

    def _below(self, pairs: np.ndarray, level: int, limit: Limit) -> Iterator[np.ndarray]:
        for part in np.array_split(pairs, max(1, len(pairs) // 2048)):
            tops, least = self.tops[level], self.least[level]
            bound = np.minimum(tops[part[:, 0]], tops[part[:, 1]]).sum(1)
            total = least[part[:, 0]] + least[part[:, 1]]
            part = part[(limit.whole + limit.part) * bound >= limit.part * total]
            if not len(part):
                continue
            if level == 0:
                part = np.sort(self.order[part[part[:, 0] != part[:, 1]]], axis=1)
                if len(part):
                    yield part
                continue
            steps = np.arange(FAN)
            left = (part[:, 0, None, None] * FAN + steps[None, :, None] + np.zeros((1, 1, FAN), int)).ravel()
            right = (part[:, 1, None, None] * FAN + steps[None, None, :] + np.zeros((1, FAN, 1), int)).ravel()
            own = np.repeat(part[:, 0] == part[:, 1], FAN * FAN)
            size = len(self.tops[level - 1])
            fits = (left < size) & (right < size) & (~own | (left <= right))
            yield from self._below(np.stack([left[fits], right[fits]], 1), level - 1, limit)


def _point_rows(column: pa.Array) -> np.ndarray:
    """Points of a batch, one row each, as wide as the widest of them."""
    rows = column.to_pylist()
    widths = {len(r) // DIMENSIONS for r in rows} or {1}
    if len(widths) == 1:
        return np.frombuffer(b"".join(rows), f"<u{max(widths)}").reshape(-1, DIMENSIONS)
    return np.stack([np.frombuffer(r, f"<u{len(r) // DIMENSIONS}") for r in rows])


def _point_bytes(counts: np.ndarray) -> bytes:
    """The counts of a point as the narrowest integers that hold them."""
    largest = int(counts.max())
    return counts.astype("<u1" if largest < 2**8 else "<u2" if largest < 2**16 else "<u4").tobytes()


def _search(limit: Limit):
    """Pairs of different components that share a key and may be similar by their group counts."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, columns, points = ("key", "id", "mark", "part_id", "part_mark"), [], []
        for batch in batches:
            columns.append([_longs(batch, n) for n in names])
            points.append(_point_rows(batch.column("point")))
        if not columns:
            return
        keys, ids, marks, part_ids, part_marks = (np.concatenate(c) for c in zip(*columns, strict=True))
        points = np.concatenate(points)
        order, fresh = _ordered(keys, part_ids, part_marks)
        for block in np.split(order, fresh[1:]) if len(order) else []:
            for pairs in RTree(points[block]).pairs(limit):
                a, b = block[pairs[:, 0]], block[pairs[:, 1]]
                other = (part_ids[a] != part_ids[b]) | (part_marks[a] != part_marks[b])
                a, b = a[other], b[other]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (ids[a], marks[a], ids[b], marks[b])], names=["id", "mark", "other_id", "other_mark"]
                )

    return run


def _possible(limit: Limit):
    """The pairs whose overlap, at most the sum of the smaller counts, can reach the limit."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = _point_rows(batch.column("point")), _point_rows(batch.column("other_point"))
            bound, total = np.minimum(one, two).sum(1), one.sum(1) + two.sum(1)
            keep = (limit.whole + limit.part) * bound >= limit.part * total
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return run


def _points(size: int, fold: bool):
    """How many tokens of chosen rows fall into each of the groups."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            wanted, ids = _longs(batch, "mark"), _longs(batch, "id")
            for low, high in pieces(bounds, most=2**11):
                owner, token = shingles(Words(data, bounds, low, high, fold), size)
                _, one, _ = _signature(owner, token, high - low)
                cells = owner * DIMENSIONS + (mix64(token) % np.uint64(DIMENSIONS)).astype(np.int64)
                counts = np.bincount(cells, minlength=(high - low) * DIMENSIONS).reshape(-1, DIMENSIONS)
                rows = np.flatnonzero(_mark(one) == wanted[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low + rows]), pa.array(wanted[low + rows]), pa.array([_point_bytes(counts[r]) for r in rows], pa.binary())],
                    names=["id", "mark", "point"],
                )

    return run


def _members(size: int, fold: bool):
    """The tokens of chosen rows."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            data, bounds = text_bytes(batch.column("text"))
            wanted = _longs(batch, "mark")
            ids, marks, sets = [], [], []
            for low, high in pieces(bounds, most=2**11):
                owner, token = shingles(Words(data, bounds, low, high, fold), size)
                n, one, _ = _signature(owner, token, high - low)
                ends = np.cumsum(n)
                for i in np.flatnonzero(_mark(one) == wanted[low:high]):
                    ids.append(batch.column("id")[low + int(i)].as_py())
                    marks.append(int(wanted[low + i]))
                    sets.append(token[ends[i] - n[i] : ends[i]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(sets, pa.binary())], names=["id", "mark", "tokens"]
            )

    return run


def _linked(limit: Limit):
    """The pairs whose sets are similar."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("tokens"), batch.column("other_tokens"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
                both = np.concatenate([a, b])
                both.sort()
                keep.append(limit.linked(int((both[1:] == both[:-1]).sum()), len(a), len(b)))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _node(prefix: str = ""):
    return F.struct(F.col(f"{prefix}id").alias("id"), F.col(f"{prefix}mark").alias("mark"))


class JaccardJoin:
    """One run of the join over the rows (id, text) of a table."""

    def __init__(self, rows: DataFrame, size: int, limit: Limit, fold: bool, scratch: Scratch):
        self.rows, self.size, self.limit, self.fold, self.scratch = rows, size, limit, fold, scratch
        self.spark = rows.sparkSession
        self.buckets = BUCKETS_PER_PARTITION * partitions(self.spark)

    def chosen(self, nodes: DataFrame, *more: str) -> DataFrame:
        """id, text and the columns of `nodes` (narrow rows), for their rows."""
        side = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
        return self.rows.join(side, "id").select("id", "mark", *more, "text")

    def points(self, nodes: DataFrame) -> DataFrame:
        """(node, point) of the nodes (id, mark)."""
        found = self.chosen(nodes).mapInArrow(_points(self.size, self.fold), f"{NODE}, point binary")
        return self.scratch.staged(found.dropDuplicates(["id", "mark"]).select(_node().alias("node"), "point"), "jaccard-points")

    def possible(self, pairs: DataFrame, points: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) that the points don't rule out."""
        others = points.select(F.col("node").alias("v"), F.col("point").alias("other_point"))
        both = pairs.join(others, "v").join(points.withColumnRenamed("node", "u"), "u").select("u", "v", "point", "other_point")
        return both.mapInArrow(_possible(self.limit), f"u struct<{NODE}>, v struct<{NODE}>")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) whose sets are similar."""
        pairs = self.scratch.staged(pairs.distinct(), "jaccard-pairs")
        nodes = self.scratch.staged(pairs.select("u.*").unionByName(pairs.select("v.*")).distinct(), "jaccard-nodes")
        found = self.chosen(nodes).mapInArrow(_members(self.size, self.fold), f"{NODE}, tokens binary")
        sets = self.scratch.staged(found.dropDuplicates(["id", "mark"]).select(_node().alias("u"), "tokens"), "jaccard-sets")
        others = sets.select(F.col("u").alias("v"), F.col("tokens").alias("other_tokens"))
        both = pairs.join(others, "v").join(sets, "u").select("u", "v", "tokens", "other_tokens")
        return both.mapInArrow(_linked(self.limit), f"u struct<{NODE}>, v struct<{NODE}>")

    def dealt(self, frame: DataFrame) -> DataFrame:
        return frame.repartition(partitions(self.spark), "bucket")


def _rare(members: DataFrame) -> DataFrame:
    """(key, node) without the most frequent keys of a node, as many of each level as it can do without.

    Similar sets share `need` keys of a level at least. Without the last need - 1 in an order of all keys,
    a set still has the first one that it shares with the other, and so has the other.
    """
    often = members.groupBy("key").agg(F.count("*").alias("often"))
    level = Window.partitionBy("node", F.col("need").bitwiseAND(3))
    rank = F.row_number().over(level.orderBy(F.desc("often"), "key"))
    ranked = members.join(often, "key").select("key", "node", F.min("need").over(level).alias("need"), rank.alias("rank"))
    return ranked.where("rank >= need div 4").select("key", "node")


def _telling(members: DataFrame) -> DataFrame:
    """(key, v): one key of each set of several nodes, which many keys may have, and its least node."""
    spread = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(20,0)")).alias(f"sum{k}") for k in (1, 2)]
    sets = members.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("n"), *spread).where("n > 1")
    return sets.groupBy("v", "n", "sum1", "sum2").agg(F.min("key").alias("key")).select("key", "v")


def _labels(docs: DataFrame, size: int, similarity: tuple[int, int], fold: bool) -> DataFrame:
    """id, key (of the text), n_shingles and label (the least node of its component; null if the set is
    empty) for every row."""
    limit = Limit(*similarity)
    with Scratch(docs.sparkSession) as scratch:
        return staged(_labelled(docs, size, limit, fold, scratch), "jaccard-labels")


def _labelled(docs: DataFrame, size: int, limit: Limit, fold: bool, scratch: Scratch) -> DataFrame:
    key = F.xxhash64("text").alias("key")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), key, "text")
    join = JaccardJoin(rows, size, limit, fold, scratch)
    sets = scratch.staged(
        rows.mapInArrow(_sets(size, fold), "id long, key long, n_shingles long, one long, two long"), "jaccard-sizes"
    )
    alike, mark = ["one", "two", "n_shingles"], F.shiftrightunsigned("one", 32).alias("mark")
    groups = scratch.staged(sets.where("n_shingles > 0").groupBy(*alike).agg(F.min("id").alias("first")), "jaccard-groups")

    # One row of each distinct set goes on; copies are told by id and mark.
    copies = sets.join(groups, alike).where("id > first").groupBy("id").agg(F.collect_set(mark).alias("spare"))
    copies = scratch.staged(copies, "jaccard-copies")
    side = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    first = rows.join(side, "id", "left").select("id", "spare", "text")
    asked = join.dealt(first.mapInArrow(_first_round(size, fold, limit, join.buckets), MEMBERS))
    met = asked.mapInArrow(_meet, ", ".join(f"{name} long" for name in MEMBER))
    met = met.groupBy("key", "id", "mark").agg(F.min("need").alias("need"))
    met = scratch.staged(met.select("key", _node().alias("node"), "need"), "jaccard-met")
    rare = scratch.staged(_rare(met), "jaccard-rare")
    members = scratch.staged(rare.join(_telling(rare), "key"), "jaccard-members")
    points = join.points(scratch.staged(members.select("node.*").distinct(), "jaccard-shared"))
    stars = members.where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    links = scratch.staged(join.verified(join.possible(stars, points)), "jaccard-links")
    found = components(links, scratch)

    # Keys whose nodes are not in one component yet.
    parts = members.join(found, "node", "left").select("key", "node", F.coalesce("least", "node").alias("part"))
    split = parts.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("key")
    pending = parts.join(split, "key").join(points, "node").select(
        "key", "node.*", F.col("part.id").alias("part_id"), F.col("part.mark").alias("part_mark"), "point"
    )
    pairs = pending.repartition(partitions(docs.sparkSession), "key").mapInArrow(
        _search(limit), "id long, mark long, other_id long, other_mark long"
    )
    more = scratch.staged(join.verified(pairs.select(_node().alias("u"), _node("other_").alias("v"))), "jaccard-links")
    if more.limit(1).count():
        found = components(links.unionByName(more), scratch)

    nodes = sets.join(groups, alike, "left").withColumn("node", F.when(F.col("first").isNotNull(), F.struct(F.col("first").alias("id"), mark)))
    return nodes.join(found, "node", "left").select("id", "key", "n_shingles", F.coalesce("least", "node").alias("label"))


def jaccard_groups(
    docs: DataFrame, size: int = 5, similarity: tuple[int, int] = (4, 5), fold: bool = True
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    A document's set is its distinct runs of `size` words (the whole text if it is shorter), with A-Z
    lower-cased if `fold`. Sets are linked if shared / united >= similarity; component_id is the
    smallest doc_id that links lead to.

    1. Equal sets become one node, named by the smallest id (a combined aggregate on a 128-bit hash).
    2. Tokens are hashed into groups. By the pigeonhole principle similar sets have whole groups in
       common (`_keys`), so groups are dealt by hash of their content; none of it depends on how
       frequent a token is. As they have several in common, a set can do without its most frequent
       ones (`_rare`); of groups that the same nodes have, one goes on (`_telling`).
    3. The counts of 512 token groups are a node's point; two sets overlap by the sum of the smaller
       counts at most. The nodes of a key are checked against its least node, if their points allow it,
       which settles groups of near copies with one check each. Where nodes of a key are still in
       different components, their points make an R-tree: a pair of subtrees is left out if the sum of
       the smaller counts can't reach the overlap that the limit asks for.
    4. Surviving pairs are verified on the sets themselves; links make components.

    * Null and wordless texts have an empty set, are linked with nothing, and are their own component.
    * A null doc_id names no component; a component without any other id has a null component_id.
    * Repeated rows are linked. An empty table gives no rows. Other columns are not read.

    Every link is found. Not all of a group's pairs are compared, only those that could join different
    components.
    """
    labels = _labels(docs, size, similarity, fold)
    real = lambda c: F.when(c != NO_ID, c)
    return labels.select(
        real(F.col("id")).alias("doc_id"), "n_shingles", real(F.coalesce("label.id", "id")).alias("component_id")
    )


def without_near_duplicates(
    docs: DataFrame, size: int = 5, similarity: tuple[int, int] = (4, 5), fold: bool = True
) -> DataFrame:
    """The rows of `docs` with one row of each component of `jaccard_groups`: that of the smallest
    doc_id (null last, then by a hash of the text). Rows with an empty set all stay. Every column is
    passed through."""
    labels = _labels(docs, size, similarity, fold).where("label is not null")
    own = F.struct("id", "key")
    stay = labels.groupBy("label").agg(F.min(own).alias("stay"))
    judged = staged(
        labels.join(stay, "label").groupBy("id", "key").agg(F.max(own == F.col("stay")).alias("stays"), F.count("*").alias("n"))
        .where("not stays or n > 1"),
        "jaccard-judged",
    ).toDF("__id", "__key", "__stays", "__n")
    side = F.broadcast(judged) if judged.count() <= BROADCAST_ROWS else judged
    marked = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("__key", F.xxhash64("text"))
    kept = marked.join(side, ["__id", "__key"], "left").where("__stays is null or __stays")
    single = kept.where("__n is null").select(*docs.columns)
    # Of rows that repeat both id and text, one stays.
    repeated = kept.where("__n > 1").dropDuplicates(["__id", "__key"]).select(*docs.columns)
    return single.unionByName(repeated)
