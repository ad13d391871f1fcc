import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ctw
from tidemark.llm.common import Scratch
from tidemark.llm.ctw import DEPTH, END, automaton, context_counts, normal_text
from tidemark.llm.scoring import language_scores


def kt(zeros, ones):
    """The estimator as it is defined: one symbol after another."""
    out, seen = 0.0, [0, 0]
    for bit in [0] * zeros + [1] * ones:
        out += math.log((seen[bit] + 0.5) / (sum(seen) + 1))
        seen[bit] += 1
    return out


class Reference:
    """Context-tree weighting written from its recursion, one node at a time."""

    def __init__(self, texts, least):
        self.counts = [Counter() for _ in range(DEPTH + 1)]  # (context, prefix of bits, bit)
        total = [Counter() for _ in range(DEPTH + 1)]
        for text in texts:
            for context, byte in self.walk(text):
                for depth in range(DEPTH + 1):
                    total[depth][context[:depth]] += 1
                    for k in range(8):
                        self.counts[depth][context[:depth], (byte | 256) >> (8 - k), byte >> (7 - k) & 1] += 1
        self.known = [{c for c, n in t.items() if n >= least or not d} for d, t in enumerate(total)]
        self.known[0].add(())
        self.memo = {}

    @staticmethod
    def walk(text):
        context = (END,) * DEPTH
        for byte in normal_text(text):
            yield context, byte
            context = ((byte, *context) if byte != END else (END,) * DEPTH)[:DEPTH]

    def pair(self, context, prefix):
        c = self.counts[len(context)]
        return c[context, prefix, 0], c[context, prefix, 1]

    def rest(self, context, prefix):
        zeros, ones = self.pair(context, prefix)
        for child in self.children(context):
            a, b = self.pair(child, prefix)
            zeros, ones = zeros - a, ones - b
        return zeros, ones

    def children(self, context):
        if len(context) == DEPTH:
            return []
        return [c for c in self.known[len(context) + 1] if c[:-1] == context]

    def weight(self, context, prefix):
        """log of the weighted probability, and the share of the node's own estimate in it."""
        if (context, prefix) not in self.memo:
            own = kt(*self.pair(context, prefix))
            below = kt(*self.rest(context, prefix)) + sum(self.weight(c, prefix)[0] for c in self.children(context))
            top = np.logaddexp(own, below) - math.log(2)
            self.memo[context, prefix] = top, math.exp(own - math.log(2) - top)
        return self.memo[context, prefix]

    def one(self, context, prefix, depth=0):
        node = context[:depth]
        zeros, ones = self.pair(node, prefix)
        share = self.weight(node, prefix)[1]
        if depth < DEPTH and context[: depth + 1] in self.known[depth + 1]:
            deeper = self.one(context, prefix, depth + 1)
        else:
            a, b = self.rest(node, prefix)
            deeper = (b + 0.5) / (a + b + 1)
        return share * (ones + 0.5) / (zeros + ones + 1) + (1 - share) * deeper

    def score(self, text):
        out = 0.0
        for context, byte in self.walk(text):
            for k in range(8):
                p = self.one(context, (byte | 256) >> (8 - k))
                out += math.log10(p if byte >> (7 - k) & 1 else 1 - p)
        return out


TEXTS = ["abra cadabra abra", "Abra  bad", "", None, "cab", "abra cadabra", "dab\ncab abra " * 5]
ASKED = [*TEXTS, "zzz ä abra", "abra cadabrax " * 100]


@pytest.mark.parametrize("least", [1, 4])
def test_model_is_the_weighting_as_defined(spark, least):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    size = sum(len((t or "").encode()) + 1 for t in TEXTS if t is not None)
    with Scratch(spark) as scratch:
        share = next(s for s in range(20) if max(1, size >> s) <= least)
        model = automaton(context_counts(docs, scratch, share))
    reference = Reference(TEXTS, max(1, size >> share))
    data = b"".join(normal_text(t) for t in ASKED)
    ends = np.cumsum([len(normal_text(t)) for t in ASKED])
    wanted = [reference.score(t) for t in ASKED]
    assert model.score(np.frombuffer(data, np.uint8), ends) == pytest.approx(wanted, rel=1e-5)
    assert model.score(np.frombuffer(data, np.uint8), ends, lane=16) == pytest.approx(wanted, rel=1e-5)


def test_every_state_is_a_distribution(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    with Scratch(spark) as scratch:
        model = automaton(context_counts(docs, scratch))
    assert (10.0**model.cost).sum(1) == pytest.approx(np.ones(len(model.cost)), rel=1e-4)


def unigram(rows, learnt):
    words = {i: normal_text(t).split() for i, (_, t) in enumerate(rows)}
    counts = Counter(w for i in words if learnt(rows[i][0]) for w in words[i])
    counts["end"] = sum(learnt(i) for i, _ in rows)
    n, v = sum(counts.values()), sum(c > 0 for c in counts.values())
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = [counts[w] for w in words[i]] + [counts["end"]]
        out.append((doc_id, len(own), sum(c > 0 for c in own), n, sum(math.log10((c + 1) / (n + v + 1)) for c in own)))
    return out


def test_scores(spark, prose):
    rows = [(i, " ".join(prose(i % 37, 20 + i % 50))) for i in range(120)]
    rows += [(120, None), (121, ""), (122, "Only Here"), (7, "shared id"), (5, rows[5][1]), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, learnt string")
    found = language_scores(docs.repartition(6), F.col("doc_id") % 5 != 0).collect()
    got = sorted((tuple(r)[:1] + tuple(r)[2:6] for r in found), key=str)
    wanted = sorted(unigram(rows, lambda i: i is not None and i % 5 != 0), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    assert [r["base_score"] for r in sorted(found, key=lambda r: str((r[0], r[2], r[3], r[4], r[5])))] == pytest.approx([w[4] for w in wanted])
    assert all(r["score"] < 0 for r in found)


def test_model_beats_unigrams_on_texts_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = language_scores(docs, F.col("doc_id") % 7 != 2).where("not learnt")
    total = rows.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert total["score"] > total["base"]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = language_scores(docs, F.lit(False)).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 2)
    assert row["score"] == pytest.approx(24 * math.log10(0.5)) and row["base_score"] == pytest.approx(0)
    assert language_scores(docs.limit(0), F.lit(True)).collect() == []
    assert ctw.SHARE <= 18


def test_rare_contexts_count_in_a_large_corpus(spark, monkeypatch):
    """Contexts that occur once among 2 ** 17 bytes and more are as they would be in a small corpus."""
    monkeypatch.setitem(globals(), "kt", lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi))
    common = "abra cadabra " * 20
    learnt = [*TEXTS, "xqa yqb zqc wqd vqe uqf tqg", *[common] * 520]
    reference = Reference(learnt, 1)
    rows = [(i, t) for i, t in enumerate([*learnt, *ASKED])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["score"] for r in language_scores(docs, F.col("doc_id") < len(learnt)).collect()}
    assert sum(len(normal_text(t)) for t in learnt) >= 2**17
    for i, text in enumerate(ASKED):
        assert got[len(learnt) + i] == pytest.approx(reference.score(text), rel=1e-5)
    own = learnt[: len(TEXTS) + 1]
    assert [got[i] for i in range(len(own))] == pytest.approx([reference.score(t) for t in own], rel=1e-5)
