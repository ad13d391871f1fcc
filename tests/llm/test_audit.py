import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.audit import COUNTS, failure_masks, filter_audit, text_counts, transduce
from tidemark.llm.queries import queries
from tidemark.llm.spans import first_like, padded

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    return (
        len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)),
    )


def brute(docs, labels):
    """Rows of the audit from documents (doc_id, text, lang) and labels (doc_id, quality, toxic)."""
    rows = []
    for doc_id, text, lang in docs:
        words, distinct, capitals, points, symbols = counts(text)
        same = [i for i, t, _ in docs if (t or "") == (text or "") and i is not None]
        fails = {"A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": symbols > 0}
        fails["E"] = doc_id is not None and min(same) < doc_id
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        names = {n for n, f in fails.items() if f}
        rows.append((lang or "", names, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                seen = set(order[: step - 1])
                here = [r for r in own if name in r[1] and not r[1] & seen]
                out.append((
                    part, order, step, sum(not r[1] & (seen | {name}) for r in own), len(here),
                    sum(name in r[1] and bool(r[1] & seen) for r in own), sum(r[1] == {name} for r in own),
                    sum(r[2] for r in here), sum(r[3] for r in here),
                    sum(factorial(5) // len(r[1]) for r in own if name in r[1]),
                ))
    return Counter(out)


def made(seed, n):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        words = [pick.choice(("A", "b", "cé", "日本", "X" * 9, "longer-word" * pick.randint(1, 4))) + str(pick.randint(0, 60)) for _ in range(pick.choice((0, 3, 99, 100, 140)))]
        text = pick.choice((" ", "\n", "\t\x0b", "  ")).join(words) + pick.choice(("", " ", "#", "\r\n"))
        rows.append((pick.choice((i, i, None, 7)), pick.choice((text, text, "copied text", None, "")), pick.choice(("de", "fr", None, ""))))
    return rows


LABELS = [(7, 1, 0), (7, 0, 1), (3, None, 1), (None, 1, 1), (9, 1, None), (11, 0, 0)]


def frames(spark, docs, labels=LABELS):
    made = spark.createDataFrame([(*r, 5, "own", 1) for r in docs], "doc_id long, text string, lang string, n int, part string, mask int")
    return made, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs = made(seed, 60)
    assert Counter(map(tuple, filter_audit(*frames(spark, docs)).collect())) == brute(docs, LABELS)


def test_masks_add_up_for_copies_in_a_third_of_all_rows(spark):
    docs = [(i, "one text" if i % 3 else f"text {i}", ("de", "en")[i % 2]) for i in range(600)]
    masks = failure_masks(*frames(spark, docs))
    assert masks.agg(F.sum("n")).first()[0] == 600
    assert Counter(map(tuple, filter_audit(*frames(spark, docs)).collect())) == brute(docs, LABELS)


def test_string_ids_empty_tables_and_clashing_names(spark):
    docs, labels = frames(spark, [])
    assert filter_audit(docs, labels).collect() == []
    docs, labels = frames(spark, [(2, "x", "de"), (10, "x", "de")])
    rows = filter_audit(docs.withColumn("doc_id", F.col("doc_id").cast("string")), labels.withColumn("doc_id", F.col("doc_id").cast("string")))
    least = rows.where("filter_order = 'EABCD' and step = 1").select("removed").first()[0]
    assert least == 1
    with pytest.raises(ValueError):
        text_counts(docs.withColumn("Words", F.lit(1)))


def test_long_texts_are_counted_whole(spark):
    texts = ["word " * 700_000, "x" * 3_000_000, "é" * 1_000_001 + " A#"]
    rows = text_counts(frames(spark, [(i, t, "de") for i, t in enumerate(texts)])[0]).collect()
    assert sorted(tuple(r[c] for c in COUNTS) for r in rows) == sorted(map(counts, texts))


def test_transducer_keeps_texts_apart():
    texts = ["ab", "", "ab cd", " ", "cd\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    found = transduce(data, bounds)
    assert list(zip(*(found[c].tolist() for c in COUNTS), strict=True)) == [counts(t) for t in texts]


def test_table_compares_bytes_when_hashes_agree(monkeypatch):
    """With one hash for all spans, only lengths, owners and bytes tell them apart."""
    import tidemark.llm.spans as spans

    monkeypatch.setattr(spans, "span_hashes", lambda data, starts, lengths: np.zeros(len(starts), np.uint64))
    pick = random.Random(4)
    words = [pick.choice("ab") * pick.choice((1, 2, 8, 9, 17)) + pick.choice(("", "c", "d" * 12)) for _ in range(200)]
    ends = np.cumsum([len(w) for w in words])
    starts, lengths = ends - [len(w) for w in words], np.array([len(w) for w in words])
    home = first_like(padded(np.frombuffer("".join(words).encode(), np.uint8)), starts, lengths)
    assert all(words[a] == words[h] for a, h in enumerate(home))
    assert len(set(home.tolist())) == len(set(words))


def test_query_on_a_table(spark, tmp_path):
    docs, labels = frames(spark, made(3, 30))
    docs.select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries()["op11_filter_audit"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, rows)) == brute(made(3, 30), LABELS)
