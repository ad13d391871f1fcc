import base64
import gc
import hashlib
import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.ordering import PATTERN, Encoder, Permutation, load_ranks, read_slots, write_training_order

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation(size):
    for key in ("a", "b"):
        order = Permutation(size, key)
        slots = order.slots(np.arange(size))
        assert sorted(slots.tolist()) == list(range(size))
        assert order.indices(slots).tolist() == list(range(size))
    if size > 64:
        assert (Permutation(size, "a").slots(np.arange(size)) != slots).mean() > 0.9
        assert abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.2


def test_encoder_agrees_with_the_library():
    import tiktoken

    ranks = load_ranks(RANKS)
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, pick = Encoder(ranks), random.Random(4)
    alphabet = ["the", "Étre", "don't", " ", " ", " ", "\n", "\t", "  ", "12", "a1", "!!", "'s", " ", "日本", "\0", "<|endoftext|>", "x" * 40]
    for _ in range(1500):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(12)))
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == plain.encode_ordinary(text), repr(text)


def test_an_encoder_keeps_nothing_of_its_texts():
    encoder = Encoder(load_ranks(RANKS))
    encoder.encode("warm up")
    tracemalloc.start()
    try:
        for i in range(5000):
            encoder.encode(f"word{i} other{i * 7}")
        assert tracemalloc.get_traced_memory()[0] < 100_000
    finally:
        tracemalloc.stop()


def test_waiting_workers_hold_no_encoder(spark, prose, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(prose(i, 40))) for i in range(80)], "doc_id long, text string")
    write_training_order(docs.repartition(8), str(tmp_path / "order"), RANKS, 32, 8).collect()

    def held(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(type(x).__name__ == "Encoder" for x in gc.get_objects())], pa.int64())})

    assert {r["n"] for r in spark.range(0, 80, 1, 8).mapInArrow(held, "n long").collect()} == {0}


@pytest.fixture
def written(spark, prose, tmp_path):
    rows = [(i, " ".join(prose(i, 5 + (i * 37) % 140))) for i in range(200)]
    rows += [(200, None), (201, ""), (None, "no id"), (3, "again"), (3, "again"), (202, " ".join(prose(9, 4000)))]
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, slot int, payload string")
    path = str(tmp_path / "order")
    index = write_training_order(docs.repartition(5, "doc_id"), path, RANKS, length=64, per_shard=16)
    return rows, path, index.collect()


def test_round_trip(spark, written):
    rows, path, index = written
    slots = {r["slot"]: list(r["tokens"]) for r in read_slots(spark, path, 0, 10**9).collect()}
    assert sorted(slots) == list(range(len(index)))
    end, encoder = len(load_ranks(RANKS)), Encoder(load_ranks(RANKS))
    for r in index:
        tokens = np.array(slots[r["slot"]], "<u2")
        assert hashlib.sha256(tokens.tobytes()).hexdigest() == r["tokens_sha256"]
        assert (tokens[r["n_tokens"] :] == end).all()
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 16, r["slot"] % 16 * 129)
    # Undo the order: what a task wrote one after another is its documents, each with its end.
    order = Permutation(len(index), "order")
    stream = [t for _, r in sorted((int(order.indices(np.array([r["slot"]]))[0]), r) for r in index) for t in slots[r["slot"]][: r["n_tokens"]]]
    documents, own = [], []
    for token in stream:
        if token == end:
            documents.append(tuple(own))
            own = []
        else:
            own.append(token)
    wanted = [tuple(np.frombuffer(encoder.encode(t or ""), "<u2").tolist()) for _, t in rows]
    assert sorted(documents) == sorted(wanted) and not own
    assert {i for r in index for i in r["doc_ids"]} == {i for i, _ in rows}


def test_shards_have_a_fixed_stride_and_reads_go_on_anywhere(spark, written):
    _, path, index = written
    sizes = []
    for name in sorted(os.listdir(f"{path}/shards")):
        if name.startswith("shard="):
            files = [f for f in os.listdir(f"{path}/shards/{name}") if f.endswith(".txt")]
            assert len(files) == 1
            sizes.append(os.path.getsize(f"{path}/shards/{name}/{files[0]}"))
    assert sorted(sizes)[1:] == [16 * 129] * (len(sizes) - 1) and sum(sizes) == 129 * len(index)
    slots = [r["slot"] for r in read_slots(spark, path, 21, 30).collect()]
    assert sorted(slots) == list(range(21, 51))


def test_same_key_same_order_other_key_other_order(spark, prose, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(prose(i, 40))) for i in range(60)], "doc_id long, text string").coalesce(1)
    digests = [
        {r["slot"]: r["tokens_sha256"] for r in write_training_order(docs, str(tmp_path / f"o{k}"), RANKS, 32, 8, key).collect()}
        for k, key in enumerate(("a", "a", "b"))
    ]
    assert digests[0] == digests[1] != digests[2] and sorted(digests[0].values()) == sorted(digests[2].values())


def test_empty_table_and_too_many_tokens(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert write_training_order(docs, str(tmp_path / "none"), RANKS).collect() == []
    assert read_slots(spark, str(tmp_path / "none"), 0, 5).collect() == []
    large = tmp_path / "large"
    large.write_bytes(b"".join(base64.b64encode(b"%d" % i) + b" %d\n" % i for i in range(2**16)))
    with pytest.raises(ValueError):
        load_ranks(str(large))
