import pytest

from tidemark.llm.mixing import mix_documents, mixed, source_targets


def shares(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above a limit is shared out again until nothing is."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(most * sizes[n] for n in capped)
        target = {n: rest * weight[n] / sum(weight[f] for f in free) for n in free}
        over = {n for n in free if target[n] > most * sizes[n] * (1 + 1e-12)}
        if not over:
            return target | {n: most * sizes[n] for n in capped}
        capped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 2, "c": 1000, "d": 30, None: 7},
        {"a": 0, "b": 50, "c": 0, "d": 1},
        {"z": 5, "é": 900, "A": 3, "b": 40, "c": 11, "d": 2, None: 100000},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    assert got == pytest.approx(shares(sizes))


@pytest.fixture
def corpus(spark, prose):
    rows = [(i, " ".join(prose(i, 20 + i % 60)), "abcd"[min(3, i % 9)], "m") for i in range(900)]
    rows += [(900, None, "a", "m"), (901, "", None, "m"), (None, "one\ttwo\n three", None, "m"), (5, "again", "b", "m")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")


def test_taken_words_come_near_targets(corpus):
    rows = [(r["doc_id"], r["text"], r["source"], *r["mix"]) for r in mixed(corpus).collect()]
    assert len(rows) == 904
    for source in ("a", "b", "c", "d"):
        own = [r for r in rows if r[2] == source]
        target, taken = own[0][5], sum(r[7] for r in own)
        assert sum(r[3] for r in own) == own[0][4]
        assert abs(taken - target) < 0.15 * target
    assert all(r[7] == r[6] * r[3] <= 3 * r[3] for r in rows)
    assert {r[3] for r in rows if not r[1]} == {0} and [r[3] for r in rows if r[0] is None] == [3]


def test_emits_each_document_as_often_as_taken_and_reruns_agree(corpus):
    wanted = sorted(str((r["doc_id"], r["text"])) for r in mixed(corpus).collect() for _ in range(r["mix"]["copies"]))
    first = mix_documents(corpus)
    assert first.columns == corpus.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in first.collect()) == wanted
    again = mix_documents(corpus.repartition(3))
    assert sorted(str((r["doc_id"], r["text"])) for r in again.collect()) == wanted


def test_empty_table(corpus):
    assert mixed(corpus.limit(0)).collect() == []
