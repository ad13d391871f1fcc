import re

import pytest

from tidemark.llm.passages import repeated_passages

SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall


def brute(rows, size):
    least = {}
    for i, text in rows:
        words = SPLIT(text or "")
        for k in range(len(words) - size + 1):
            key = tuple(words[k : k + size])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, text in rows:
        words, gone = SPLIT(text or ""), set()
        for k in range(len(words) - size + 1):
            if i is not None and least[tuple(words[k : k + size])] < i:
                gone |= set(range(k, k + size))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


@pytest.fixture
def rows(prose):
    p = lambda s, n: prose(s, n)
    passage, line = p(1, 70), p(2, 10)
    docs = [
        p(10, 30) + passage + p(11, 20), p(12, 7) + passage, passage[:50], passage[10:59], passage[5:60] + p(13, 9) + passage[20:],
        line * 30, p(14, 3) + line * 9, line * 4, p(15, 300), p(15, 300), p(15, 300)[:49], p(15, 300)[:50],
        p(16, 20) + p(15, 300)[100:230] + p(17, 20), [], ["x"],
    ]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    rows += [(100 + i, " ".join(p(100 + i, i % 13) + passage[i % 11 : 60 + i % 7])) for i in range(60)]
    # Shared ids, repeated rows, ids and texts that are null, other white space, copies of a large id.
    rows += [(3, " ".join(p(15, 300))), (3, "\n".join(passage)), (200, " ".join(p(20, 90))), (200, " ".join(p(20, 90)))]
    rows += [(None, " ".join(passage)), (None, None), (201, None), (199, " ".join(p(20, 90))), (-5, "  ".join(p(14, 3) + line * 9))]
    return rows


@pytest.mark.parametrize("size", [50, 5, 2, 1])
def test_matches_brute_force(spark, rows, size):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, mark int, ranges string")
    found = repeated_passages(docs.repartition(5), size)
    assert found.columns == ["doc_id", "text", "mark", "ranges", "cut"]
    assert sorted(((r["doc_id"], *r["cut"]) for r in found.collect()), key=str) == brute(rows, size)


def test_empty_table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeated_passages(docs.limit(0)).collect() == []
