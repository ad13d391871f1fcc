import random
import re

import numpy as np
import pytest

from tidemark.llm.jaccard import (
    DIMENSIONS, NODE, Limit, RTree, _keys, _point_bytes, _point_rows, _rare, _telling, jaccard_groups, without_near_duplicates,
)

SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = SPLIT("".join(c.lower() if c.isascii() else c for c in text or ""))
        runs = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        out.append(runs or ({tuple(words)} if words else set()))
    return out


def brute(rows, size, part, whole):
    sets = sets_of(rows, size)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and whole * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {k: min((x for x in g if x is not None), default=None) for k, g in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)


@pytest.fixture
def rows(prose):
    pick, rows = random.Random(3), []
    for family in range(40):
        base = prose(family, pick.choice([4, 9, 14, 25, 60, 150, 400]))
        for _ in range(pick.choice([1, 2, 5])):
            own = list(base)
            for _ in range(pick.randrange(0, 1 + len(base) // 25)):
                own[pick.randrange(len(own))] = pick.choice(["x", "yy", "zzz"])
            cut = pick.randrange(0, 1 + len(own) // 15)
            rows.append(own[cut:] if pick.random() < 0.5 else own + prose(900 + family, cut))
    # A chain whose ends aren't similar, a frequent passage, a large group of near copies.
    chain = prose(500, 120)
    rows += [chain[k : k + 60] for k in range(0, 24, 2)]
    passage = prose(501, 30)
    rows += [passage + prose(600 + k, 6 + k % 5) for k in range(40)]
    big = prose(502, 80)
    rows += [big[:k] + [f"q{k}"] + big[k + 1 :] for k in range(60)]
    out = [(i, " ".join(r)) for i, r in enumerate(rows)]
    out += [(700, None), (701, ""), (702, " "), (703, "a b"), (704, "A  B"), (705, "b a"), (706, "a"), (None, "a"), (None, "alone here")]
    out += [(3, out[20][1]), (3, out[20][1]), (20, " ".join(big))]
    return out


@pytest.mark.parametrize(("size", "limit"), [(3, (9, 10)), (5, (4, 5)), (1, (1, 2)), (2, (1, 1))])
def test_matches_brute_force(spark, rows, size, limit):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, id int, mark string")
    found = jaccard_groups(docs.repartition(4), size, limit)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, size, *limit)


def test_one_document_of_each_group_stays(spark, rows):
    plain = [(i, t) for i, t in rows if i is not None][:-3]
    docs = spark.createDataFrame([(i, t, 1) for i, t in plain] + [(0, plain[0][1], 1)], "doc_id long, text string, id int")
    kept = without_near_duplicates(docs)
    assert kept.columns == ["doc_id", "text", "id"]
    wanted = {c for _, _, c in brute(plain, 5, 4, 5)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(wanted)


def test_tree_leaves_out_only_what_cannot_reach_the_limit():
    random_ = np.random.default_rng(2)
    base = random_.poisson(4, (30, 16))
    points = np.concatenate([base + random_.integers(0, 2, base.shape) for _ in range(9)])
    limit = Limit(4, 5)
    bound = np.minimum(points[:, None], points[None]).sum(2)
    total = points.sum(1)[:, None] + points.sum(1)[None]
    wanted = {(i, j) for i, j in np.argwhere(9 * bound >= 4 * total).tolist() if i < j}
    got = [tuple(p) for part in RTree(points).pairs(limit) for p in part.tolist()]
    assert set(got) == wanted and len(got) == len(wanted)


@pytest.mark.parametrize(("limit", "several"), [((4, 5), True), ((9, 10), True), ((1, 2), False)])
def test_similar_sets_share_the_keys_that_are_counted_on(limit, several):
    limit, pick, sets = Limit(*limit), random.Random(8), []
    for n in (3, 8, 20, 45, 120, 300):
        base = [pick.getrandbits(53) for _ in range(n)]
        for off in range(12):
            sets.append(sorted({pick.getrandbits(53) if pick.random() < off / 40 else t for t in base} | {1} if off % 3 else set(base[off // 3 :])))
    sizes = np.array([len(x) for x in sets])
    owner, tokens = np.repeat(np.arange(len(sets)), sizes), np.concatenate([np.array(x, np.uint64) for x in sets])
    levels = {}
    for text, key, need in zip(*(c.tolist() for c in _keys(owner, tokens, sizes, limit)), strict=True):
        levels.setdefault((text, need), set()).add(key)
    checked = 0
    for i in range(len(sets)):
        for j in range(i):
            shared = len(set(sets[i]) & set(sets[j]))
            if sets[i] != sets[j] and limit.linked(shared, len(sets[i]), len(sets[j])):
                met = [(a[1] // 4, b[1] // 4, len(x & y)) for a, x in levels.items() for b, y in levels.items() if a[0] == i and b[0] == j]
                assert any(n >= max(one, two) for one, two, n in met)
                checked += not several or any(one > 1 for one, *_ in met)
    assert checked > 20


def member_rows(spark, rows):
    return spark.createDataFrame([(k, (n, 0), need) for k, n, need in rows], f"key long, node struct<{NODE}>, need long")


def test_the_most_frequent_keys_beyond_need_are_left_out(spark):
    # Node 1 needs three keys of level 0: two may go, the most frequent ones. Those of level 2 are counted by themselves.
    own = [(k, 1, 3 * 4) for k in (10, 11, 12, 13)] + [(20, 1, 1 * 4 + 2)]
    others = [(10, n, 4) for n in (2, 3)] + [(12, n, 4) for n in range(2, 9)] + [(13, n, 4) for n in range(2, 8)] + [(11, 2, 4), (20, 2, 4)]
    left = {(r["key"], r["node"]["id"]) for r in _rare(member_rows(spark, own + others)).collect()}
    assert {k for k, n in left if n == 1} == {10, 11, 20}
    assert {x for x in left if x[1] != 1} == {(k, n) for k, n, _ in others}


def test_a_set_of_nodes_is_searched_under_one_key(spark):
    rows = [(k, n, 4) for k in range(50) for n in (1, 2, 3)] + [(k, n, 4) for k in (70, 71) for n in (2, 3)] + [(90, 1, 4)]
    told = _telling(member_rows(spark, rows).select("key", "node")).collect()
    assert sorted((r["key"], r["v"]["id"]) for r in told) == [(0, 1), (70, 2)]


def test_points_are_as_wide_as_their_counts():
    import pyarrow as pa

    counts = np.ones((3, DIMENSIONS), np.int64)
    counts[1, 5], counts[2, 7] = 300, 70_000
    packed = [_point_bytes(c) for c in counts]
    assert [len(p) // DIMENSIONS for p in packed] == [1, 2, 4]
    assert (_point_rows(pa.array(packed, pa.binary())) == counts).all()
    assert (_point_rows(pa.array(packed[:1], pa.binary())) == counts[:1]).all()


def test_empty_table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").limit(0)
    assert jaccard_groups(docs).collect() == [] and without_near_duplicates(docs).collect() == []
