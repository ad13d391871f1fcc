"""Byte spans told apart by a verified hash table, for use inside tasks."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
EIGHT = 8


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; `data` ends with at least eight spare bytes."""
    return np.ndarray((len(data) - EIGHT + 1,), "<u8", data, strides=(1,))


def padded(data: np.ndarray) -> np.ndarray:
    """A copy with eight spare bytes, as the functions below need them."""
    return np.concatenate([data, np.zeros(EIGHT, np.uint8)])


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of padded `data`, eight bytes at a time."""
    eights = _eights(data)
    hashes = mix64(lengths.astype(np.uint64) * _STEP ^ (eights[starts] & _MASKS[np.minimum(lengths, EIGHT)]))
    longer, done = np.flatnonzero(lengths > EIGHT), EIGHT
    while len(longer):
        rest = lengths[longer] - done
        more = eights[starts[longer] + done] & _MASKS[np.minimum(rest, EIGHT)]
        hashes[longer] = mix64(hashes[longer] * _STEP + more)
        longer, done = longer[rest > EIGHT], done + EIGHT
    return hashes


def equal_spans(data: np.ndarray, one: np.ndarray, two: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of the same lengths from `one` and from `two` on have the same bytes."""
    eights = _eights(data)
    same = np.ones(len(one), bool)
    left, done = np.arange(len(one), dtype=np.int32), 0
    while len(left):
        rest = lengths[left] - done
        keep = _MASKS[np.clip(rest, 0, EIGHT)]
        fits = ((eights[one[left] + done] ^ eights[two[left] + done]) & keep) == 0
        same[left[~fits]] = False
        left, done = left[fits & (rest > EIGHT)], done + EIGHT
    return same


def first_like(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """For each span of padded `data` the number of one span of the same bytes (and owner), the same for all of them.

    Spans are inserted into an open-addressing table, all at once and slot by slot: who finds another
    span in the slot compares length, owner and every byte, and moves on to the next slot if one differs.
    """
    hashes = span_hashes(data, starts, lengths)
    if owner is not None:
        hashes = mix64(hashes + owner.astype(np.uint64) * _STEP)
    # Four-byte numbers: a batch never has so many spans, and the table is the largest part of memory.
    bits = max(4, (2 * len(starts)).bit_length())
    table = np.full(1 << bits, -1, np.int32)
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int32)
    home, left = np.empty(len(starts), np.int32), np.arange(len(starts), dtype=np.int32)
    while len(left):
        at = slot[left]
        free = table[at] < 0
        table[at[free]] = left[free]
        there = table[at]
        same = (hashes[there] == hashes[left]) & (lengths[there] == lengths[left])
        if owner is not None:
            same &= owner[there] == owner[left]
        check = np.flatnonzero(same & (there != left))
        same[check] = equal_spans(data, starts[left[check]], starts[there[check]], lengths[left[check]])
        home[left[same]] = there[same]
        left = left[~same]
        slot[left] = (slot[left] + 1) & (len(table) - 1)
    return home
