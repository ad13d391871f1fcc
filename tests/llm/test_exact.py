import hashlib

from tidemark.llm import exact
from tidemark.llm.exact import exact_duplicates, without_exact_duplicates

ROWS = ["Same Text", "same text", None, "", "ÄB", "äb", "other", (7, "other"), (7, "other"), (None, "lone"), (None, None)]


def brute(rows, keep, fold):
    rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(rows)]
    low = lambda t: "".join(c.lower() if fold and c.isascii() else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t in rows:
        group = groups[low(t)]
        ids = [x for x in group if x is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        out.append((i, best, len(group), i == best, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force(texts):
    docs = texts(ROWS)
    for keep, fold in (("largest", True), ("smallest", False)):
        got = sorted((tuple(r) for r in exact_duplicates(docs, keep, fold).collect()), key=str)
        assert got == brute(ROWS, keep, fold)


def test_different_texts_under_one_hash(texts, monkeypatch):
    """With a hash of two values, groups come from comparing bytes alone."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact.F, "md5", lambda c: F.hex(F.pmod(F.length(c), F.lit(2)).cast("string")))
    got = sorted((tuple(r) for r in exact_duplicates(texts(ROWS), "largest", True).collect()), key=str)
    assert got == brute(ROWS, "largest", True)


def test_survivors_are_whole_rows_once(texts):
    rows = without_exact_duplicates(texts(ROWS), "smallest", True)
    kept = sorted((r["doc_id"], r["text"]) for r in rows.collect() if r["doc_id"] is not None)
    assert rows.columns == ["doc_id", "text", "hash", "source", "size"]
    assert kept == [(0, "Same Text"), (2, None), (4, "ÄB"), (5, "äb"), (6, "other")]


def test_empty_table(texts):
    assert exact_duplicates(texts([])).collect() == []
