import random
import re

import numpy as np
import pyarrow as pa

from tidemark.llm.passages import cover_for, difference_cover
from tidemark.llm.words import Words, deal, pieces, runs_hash, text_bytes, unpack

SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall


def test_words_of_a_batch():
    texts = ["One two  THREE", None, "", " \n", "ä b c\x0bd", "end", "of one"]
    data, bounds = text_bytes(pa.array(texts))
    words = Words(data, bounds, 0, len(texts), fold=True)
    said = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.stops, strict=True)]
    low = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    assert said == [low(w) for t in texts for w in SPLIT(t or "")]
    assert words.counts.tolist() == [len(SPLIT(t or "")) for t in texts]
    assert words.owner().tolist() == [i for i, t in enumerate(texts) for _ in SPLIT(t or "")]


def test_equal_words_and_runs_have_equal_hashes_wherever_they_are():
    pick = random.Random(1)
    texts = [" ".join(pick.choice(["a", "bb", "ccc", "dd", "a" * 50]) for _ in range(pick.randrange(90))) for _ in range(60)]
    data, bounds = text_bytes(pa.array(texts))
    seen, wanted = {}, set()
    for limit in (50, 1 << 20):
        for low, high in pieces(bounds, limit):
            words = Words(data, bounds, low, high, fold=False)
            for length in (1, 3, 20, 50):
                runs = runs_hash(words.hashes(), length)
                for t in range(high - low):
                    own = SPLIT(texts[low + t])
                    for k in range(len(own) - length + 1):
                        key = tuple(own[k : k + length])
                        wanted.add(key)
                        assert seen.setdefault(key, runs[words.first[t] + k]) == runs[words.first[t] + k]
    assert len(set(seen.values())) == len(wanted)


def test_dealt_rows_come_back_whole():
    keys = np.arange(1000, dtype=np.uint64)
    back = [unpack(p, "u8", "i4") for _, p in deal(keys, 7, keys, keys.astype(np.int32) * 2)]
    assert sorted(np.concatenate([b[0] for b in back]).tolist()) == list(range(1000))
    assert all((b[0] * 2 == b[1]).all() for b in back)
    assert list(deal(keys[:0], 7, keys[:0])) == []


def test_difference_covers_hold_every_difference():
    for window in (2, 3, 7, 20, 50, 51, 200):
        period, cover, length = cover_for(window)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
        assert period - 1 + length == window
    assert len(difference_cover(31)) <= 8


def test_memory_goes_back_once_a_task_has_ended(monkeypatch):
    from tidemark.llm import words

    seen = []

    def run(batches):
        yield from batches
        seen.append("ended")

    monkeypatch.setattr(words, "give_back", lambda: seen.append("given back"))
    assert list(words.trimmed(run)(iter([1, 2]))) == [1, 2]
    assert seen == ["ended", "given back"]
