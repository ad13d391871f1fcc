import hashlib
import re

import pytest

from tidemark.llm import contamination as module
from tidemark.llm.contamination import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, size):
    out = []
    for i, text in docs:
        own, hit, names = words(text), set(), set()
        for item, said in items:
            w = words(said)
            windows = [w] if 0 < len(w) < size else [w[k : k + size] for k in range(len(w) - size + 1)]
            for window in windows:
                for k in range(len(own) - len(window) + 1):
                    if window and own[k : k + len(window)] == window:
                        hit |= set(range(k, k + len(window)))
                        names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(own), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


@pytest.fixture
def case(prose):
    items = [(k, " ".join(prose(k, 18))) for k in range(6)] + [(10, "Kaben LODORS"), (2, "mifal"), (11, None), (12, " ... ")]
    items += [(13, items[0][1]), (14, " ".join(prose(0, 18)[4:] + prose(99, 5)))]
    item = lambda k, a=0, b=18: prose(k, 18)[a:b]
    docs = [
        (0, " ".join(prose(50, 40) + item(0) + prose(51, 30))),
        (1, " ".join(item(1, 2, 15)).upper() + "!"),
        (2, " ".join(item(2, 2, 14))),
        (3, ", ".join(prose(60, 400) + item(3, 0, 13))),
        (4, "kaben-lodors kaben lodors"),
        (5, None), (6, ""), (7, "12 ÄÖ 3"), (8, " ".join(item(4) * 3)), (8, " ".join(item(4) * 3)), (None, "mifal"),
        (9, " ".join(prose(70, 3000) + ["mifal"])),
    ]
    return docs, items


@pytest.mark.parametrize("block", [1 << 20, 120])
def test_matches_brute_force(spark, case, monkeypatch, block):
    """With a small block the benchmark is searched for in several."""
    docs, items = case
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    rows = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], "doc_id long, text string, n_words int, spans string")
    found = contamination(rows, spark.createDataFrame(items, "item_id long, text string"))
    assert found.columns == ["doc_id", "text", "n_words", "spans", "hit"]
    assert sorted(((r["doc_id"], *r["hit"]) for r in found.collect()), key=str) == brute(docs, items, 13)


def test_empty_tables(spark, case):
    docs, items = case
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contamination(rows.limit(0), bench).collect() == []
    assert not any(r["hit"]["contaminated"] for r in contamination(rows, bench.limit(0)).collect())
