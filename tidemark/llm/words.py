"""Words of a batch of texts as numpy arrays, for use inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only
LOWER_TABLE = np.frombuffer(LOWER, np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_random = np.random.default_rng(20240501)
_BYTE = _random.integers(1, 2**64, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = _random.integers(1, 2**64, size=2, dtype=np.uint64) | np.uint64(1)
_STEP = _random.integers(1, 2**64, size=64, dtype=np.uint64) | np.uint64(1)

PIECE = 1 << 20  # bytes handled at a time


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings and the bounds of each text, without a copy; a null is empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


# Of the C library, where it has it: hands freed memory back to the system.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what this worker has freed to the system; other workers and the executor share its memory."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run`, which also gives back what it held at its end; the worker lives on, and so would its last batch's memory."""

    def ran(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return ran


def in_parts(batches: Iterator[pa.RecordBatch], limit: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """Batches whose column `text` has about `limit` bytes at most, whatever came as one."""
    for batch in batches:
        _, bounds = text_bytes(batch.column("text"))
        for low, high in pieces(bounds, limit):
            yield batch.slice(low, high - low)
        del batch
        give_back()


def pieces(bounds: np.ndarray, limit: int = PIECE, most: int = 2**20) -> Iterator[tuple[int, int]]:
    """Runs of at most `most` texts with about `limit` bytes at most, or a single longer text."""
    low, count = 0, len(bounds) - 1
    while low < count:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        high = min(high, count, low + most)
        yield low, high
        low = high


class Words:
    """Words of texts [low, high): byte positions, the text of each, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, low: int, high: int, fold: bool):
        self.bounds = bounds[low : high + 1] - bounds[low]
        data = data[bounds[low] : bounds[high]]
        self.data = LOWER_TABLE[data] if fold else data
        gap = SPACE[self.data]
        fresh = np.zeros(len(data) + 1, bool)
        fresh[self.bounds] = True
        starts = ~gap
        starts[1:] &= gap[:-1] | fresh[1:-1]
        stops = ~gap
        stops[:-1] &= gap[1:] | fresh[1:-1]
        self.starts = np.flatnonzero(starts)
        self.stops = np.flatnonzero(stops) + 1
        #: Words before each text; the last entry is their number.
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word. The two choices of `which` are independent of each other."""
        out = np.empty(len(self.starts), np.uint64)
        lengths = self.stops - self.starts
        done = 0
        while done < len(out):
            upto = max(done + 1, int(np.searchsorted(self.starts, self.starts[done] + PIECE)))
            begin, end = self.starts[done], self.stops[upto - 1]
            size = lengths[done:upto]
            powers = np.full(int(size.max()) + 1, _BASE[which], np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers)
            at = self.starts[done:upto] - begin
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum()), dtype=np.int32)
            place -= np.repeat(first.astype(np.int32), size)
            letters = self.data[begin:end][np.repeat(at.astype(np.int32), size) + place]
            values = powers[place]
            values *= _BYTE[which][letters]
            out[done:upto] = mix64(np.add.reduceat(values, first) + size.astype(np.uint64))
            done = upto
        return out


def runs_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each `length` consecutive entries, by doubling; len - length + 1 entries."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    power, size, result, covered, level = hashes, 1, None, 0, 0
    while size <= length:
        if length & size:
            if result is None:
                result = power
            else:
                n = min(len(power), len(result) - size)
                result = mix64(power[:n] * _STEP[level] + result[size : size + n])
            covered += size
        n = len(power) - size
        if n <= 0:
            break
        power = mix64(power[:n] * _STEP[32 + level] + power[size : size + n])
        size *= 2
        level += 1
    return result[: len(hashes) - length + 1]


def pack(*columns: np.ndarray, level: int = 1) -> bytes:
    """Columns of equal length as one compressed value; narrow exchanges carry many rows in each."""
    return zstandard.ZstdCompressor(level=level).compress(b"".join(c.tobytes() for c in columns))


def unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    widths = [np.dtype(k).itemsize for k in kinds]
    count, out, at = len(raw) // sum(widths), [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.frombuffer(raw, kind, count, at))
        at += width * count
    return out


def deal(keys: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed columns) for each bucket that a key falls in; rows keep their order."""
    if not len(keys):
        return
    bucket = ((mix64(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for begin, end in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True):
        rows = order[begin:end]
        yield int(bucket[begin]), pack(*[c[rows] for c in columns])
