import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.toxicity import THRESHOLDS, Model, Reader, codes, toxicity, train, units, windows_of


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents of made-up words; toxic ones have a few words of two stems that others don't have."""
    pick = random.Random(8)
    parts = ["an", "ber", "cho", "dre", "eli", "fur", "gan", "hil", "ise", "jor", "kel", "lum"]
    word = lambda: "".join(pick.choice(parts) for _ in range(pick.randrange(1, 4)))
    rows = []
    for i in range(1500):
        own = [word() for _ in range(pick.randrange(5, 200))]
        toxic = i % 8 == 0
        for _ in range(1 + len(own) // 30 if toxic else 0):
            own.insert(pick.randrange(len(own)), pick.choice(["zorg", "wrax"]) + pick.choice(parts))
        rows.append((i, " ".join(own).upper() if i % 11 == 0 else " ".join(own), int(toxic)))
    return spark.createDataFrame([(i, t, y, 0.0) for i, t, y in rows], "doc_id long, text string, truth int, score double")


@pytest.fixture(scope="module")
def model(corpus):
    return train(corpus, corpus.where("doc_id % 3 <> 1").select("doc_id", F.col("truth").alias("toxic")))


def test_held_out_accuracy(corpus, model):
    rows = corpus.where("doc_id % 3 = 1").withColumn("p", toxicity(corpus, model)).collect()
    assert all(0 <= r["p"] <= 1 for r in rows)
    toxic, plain = [r["p"] >= 0.7 for r in rows if r["truth"]], [r["p"] >= 0.7 for r in rows if not r["truth"]]
    assert sum(toxic) >= 0.97 * len(toxic) and sum(plain) <= 0.01 * len(plain)


def test_whole_text_counts_and_nothing_else(spark, corpus, model):
    long = " ".join(["anber", "chodre"] * 60_000)
    rows = [(1, None), (2, ""), (3, "1234 !!"), (4, long), (5, long + " zorgan wraxeli zorgber" * 400), (None, "wraxcho zorgan zorgkel"), (6, "zorg" * 9000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, toxic int")
    got = {r["doc_id"]: r["p"] for r in docs.withColumn("p", toxicity(docs, model)).collect()}
    assert got[1] == got[2] == got[3] < 0.7 and got[4] < 0.7 <= min(got[5], got[None])
    assert docs.limit(0).withColumn("p", toxicity(docs, model)).collect() == []


def test_windows_and_units():
    assert windows_of("Zorg-AN ab1c\n" + "x" * 70) == ["zorg", "an", "ab", "c", "x" * 32, "x" * 32, "x" * 6]
    assert units("ab") == ["^ab$"] and units("zorg") == ["^zorg", "zorg$"]


def test_a_window_gains_where_toxic_text_knows_more():
    reader = Reader(Model(units("zorgan"), units("zorgan"), units("anberchodre")))
    assert reader.gains("zorgan")[0] > 8 and reader.gains("anber") == (0, 0) and reader.gains("other") == (0, 0)


def test_labels_of_one_class_or_none(spark, corpus):
    labels = corpus.select("doc_id", F.lit(0).alias("toxic"))
    few = corpus.limit(3).select("doc_id", "text")
    assert all(r["p"] < 0.1 for r in few.withColumn("p", toxicity(few, train(corpus, labels))).collect())
    assert [r["p"] for r in few.withColumn("p", toxicity(few, train(corpus, labels.limit(0)))).collect()] == [0.5] * 3


def test_a_toxic_word_made_of_ordinary_pieces_is_found(spark):
    """Every five-letter piece of the toxic word is as frequent in ordinary words; only the whole isn't."""
    pick = random.Random(4)
    whole, around = "banderol", ["bandero", "anderol", "andero", "xanderol", "banderos", "bander", "derol", "miklos", "tarvun"]
    rows = []
    for i in range(900):
        own = [pick.choice(around) for _ in range(60)]
        if i % 6 == 0:
            own[7] = own[31] = whole
        rows.append((i, " ".join(own), int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = train(docs, docs.where("doc_id % 7 <> 1").select("doc_id", "toxic"))
    held = docs.where("doc_id % 7 = 1").withColumn("p", toxicity(docs, found)).collect()
    assert all((r["p"] >= 0.7) == bool(r["toxic"]) for r in held) and any(r["toxic"] for r in held)


def test_threshold_is_fitted_and_either_toxic_dictionary_counts(model):
    assert model.threshold in THRESHOLDS and codes("zorg") == ["^zorg", "zorg$", "^zor", "^zorg$"]
    assert Reader(Model(codes("zorgan"), [], codes("anber"))).gains("zorgan")[0] > 8


def test_contradicting_labels_count_as_toxic_in_any_order(spark):
    from tidemark.llm.toxicity import train

    docs = spark.createDataFrame([(i, ("vile hateful slur" if i % 2 else "calm river stone") + f" {i}") for i in range(80)], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(80)] + [(i, 1 - i % 2) for i in range(0, 80, 7)]
    models = [train(docs, spark.createDataFrame(order, "doc_id long, toxic int").repartition(n)) for order, n in ((rows, 1), (rows[::-1], 3))]
    one, two = models
    assert (one.strict, one.loose, one.ordinary, one.threshold, one.mixed) == (two.strict, two.loose, two.ordinary, two.threshold, two.mixed)
    assert one.weights == pytest.approx(two.weights)
