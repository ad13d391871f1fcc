import random

import numpy as np
import pytest
from test_contamination import brute as contaminated
from test_jaccard import brute as components
from test_mixing import shares

import corpus_pipeline
from tidemark.llm.ordering import Encoder, load_ranks
from tidemark.llm.toxicity import Reader, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(12)
    parts = ["an", "ber", "cho", "dre", "eli", "fur", "gan", "hil", "ise", "jor"]
    word = lambda: "".join(pick.choice(parts) for _ in range(pick.randrange(1, 4)))
    texts, labels = [], []
    for i in range(400):
        own = [word() for _ in range(pick.randrange(5, 120))]
        if i % 7 == 0:
            own += ["zorg" + pick.choice(parts) for _ in range(1 + len(own) // 20)]
            pick.shuffle(own)
        labels.append((i, int(i % 7 == 0)))
        texts.append(own)
    items = [[word() for _ in range(20)] for _ in range(5)]
    texts += [t[:-1] + ["changed"] for t in texts[1:60] if len(t) > 40]  # near copies
    texts += [texts[3], texts[3], texts[8] + items[0], items[1][2:16], items[2] + [word() for _ in range(600)]]
    rows = [(i, " ".join(t), "xx", ("s1", "s2", "s3", None)[i % 11 % 4], 1) for i, t in enumerate(texts)]
    rows += [(9000, None, None, "s1", None), (9001, "", "xx", "s2", 0), (9002, " ", "xx", None, 1), (3, rows[3][1], "xx", "s2", 1)]
    root = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    bench = [(k, " ".join(t)) for k, t in enumerate(items)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into each stage and what comes out of the last."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/out-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def pairs(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def test_toxic_documents_go_and_others_stay(spark, folder, stages):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    reader = Reader(train(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    assert pairs(stages[1]) == pairs(r for r in stages[0] if reader.score(r["text"]) < corpus_pipeline.TOXIC_AT)
    kept = {r["doc_id"] for r in stages[1]}
    toxic = {i for i in range(400) if i % 7 == 0}
    assert len(toxic & kept) <= 2 and len(set(range(400)) - toxic - kept) <= 4
    assert {9000, 9001, 9002} <= kept


def test_one_document_of_each_group_stays(stages):
    groups = {c for _, n, c in components([(r["doc_id"], r["text"]) for r in stages[1]], 5, 4, 5) if n}
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(groups | {9000, 9001, 9002})


def test_contaminated_documents_go(spark, folder, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    judged = contaminated([(r["doc_id"], r["text"]) for r in stages[2]], items, 13)
    bad = {i for i, *_, flag in judged if flag}
    assert bad and [p for p in pairs(stages[2]) if p[0] not in bad] == pairs(stages[3])


def test_sources_come_near_their_targets(stages):
    count = lambda rows, s: sum(len((r["text"] or "").split()) for r in rows if r["source"] == s)
    sizes = {s: count(stages[3], s) for s in {r["source"] for r in stages[3]}}
    for source, target in shares(sizes).items():
        assert abs(count(stages[4], source) - target) < 0.25 * target
    assert set(pairs(stages[4])) <= set(pairs(stages[3]))


def test_every_token_is_written_once(stages):
    encoder = Encoder(load_ranks(corpus_pipeline.RANKS))
    wanted = sum(len(np.frombuffer(encoder.encode(r["text"] or ""), "<u2")) + 1 for r in stages[4])
    assert sum(r["n_tokens"] for r in stages[5]) == wanted
    assert sorted(r["slot"] for r in stages[5]) == list(range(len(stages[5])))


def test_run_is_the_stages_in_order(spark, folder, stages):
    again = corpus_pipeline.run(spark, folder)
    assert sum(r["n_tokens"] for r in again.collect()) == sum(r["n_tokens"] for r in stages[5])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_order"]


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == [], name
