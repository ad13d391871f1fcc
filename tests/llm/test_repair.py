import hashlib
import random
import zlib
from functools import lru_cache
from itertools import groupby

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm.queries import queries
from tidemark.llm.repair import SETTLED, TOTALS, cheapest, damaged, edited, repaired, ways

GRAMMAR = regex.compile("(s?(ua)+)?")
COLUMNS = ["conv_id", *TOTALS, "audit", "repaired_sha256"]


def search(rows):
    """Least (cost, audit) and its turns, by trying all edits; rows are (role, text, must go, truncated)."""
    limit = 3 * len(rows)

    @lru_cache(None)
    def best(at, so_far, left):
        """From row `at` on, after roles of which just the last few matter, with `left` to spend."""
        found = []
        if at == len(rows) and GRAMMAR.fullmatch(so_far):
            found.append((0, "", ()))
        options = []
        for role in ("user", "assistant"):
            options.append((2, "I", role, "", 0))
        if at < len(rows):
            role, text, goes, truncated = rows[at]
            options.append((3, "D", None, None, 1))
            if not goes:
                if role[:1] != "":
                    options.append((truncated, "K", role, text, 1))
                options += [(2 + truncated, "R", r, text, 1) for r in ("user", "assistant")]
        for cost, edit, role, text, step in options:
            roles = so_far if role is None else so_far + role[:1]
            if cost > left or GRAMMAR.fullmatch(roles, partial=True) is None:
                continue
            if len(roles) > 3:
                roles = roles[:1] * (roles[0] == "s") + "ua" + ("u" if roles.count("u") > roles.count("a") else "")
            rest = best(at + step, roles, left - cost)
            if rest:
                line = () if role is None else ((role, text),)
                found.append((cost + rest[0], edit + rest[1], line + rest[2]))
        return min(found) if found else None

    return best(0, "", limit)


def brute(table):
    """Rows of the query from rows (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in table:
        own = by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        faults, seen, judged = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, role, text in rows:
            core = text.strip("\t\n\x0b\x0c\r ")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = search(tuple(judged))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, sha))
    return sorted(out, key=str)


ROLES = ("user", "assistant", "system", "tool", "", None, "User", "a", "ümlaut")
TEXTS = ("Yes.", "No", "what?", " \n", "", None, "Done!\t ", "a.b", "日本。", "...", "Long " * 40 + "end.")


def made(seed, convs, rows, turns=12):
    pick = random.Random(seed)
    return [
        (pick.choice((c, c, c, c, None)) if c % 7 == 0 else c, pick.choice((pick.randint(0, turns), t, None if t % 5 == 0 else t)), pick.choice(ROLES[: pick.choice((2, 3, 9))]), pick.choice(TEXTS))
        for c in range(convs)
        for t in range(pick.randint(1, rows))
    ]


@pytest.fixture
def conversations(spark):
    def make(rows):
        full = [(*r, "more", 1, 2) for r in rows]
        return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, audit string, piece long, kind int")

    return make


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_parser_against_all_edits():
    pick = random.Random(5)
    for _ in range(1500):
        letters = "".join(pick.choice("suaoSUAOD") for _ in range(pick.randint(0, 7)))
        rows = tuple(({"s": "s", "u": "u", "a": "a", "o": "x", "d": "x"}[x.lower()], "t", x == "D", int(x.isupper() and x != "D")) for x in letters)
        assert cheapest(letters) == search(rows)[:2], letters


def test_ways_through_pieces_add_up():
    pick = random.Random(6)
    for _ in range(200):
        letters = "".join(pick.choice("suaoSUAOD") for _ in range(9))
        whole = {(a, b): (c, t) for a, b, c, t in ways(letters)}
        joined = {}
        for a, b, c, t in ways(letters[:4]):
            for b2, d, c2, t2 in ways(letters[4:]):
                if b == b2:
                    joined[a, d] = min(joined.get((a, d), (999, "")), (c + c2, t + t2))
        assert joined == whole
        for (a, b), (_, audit) in whole.items():
            assert edited(a, audit, [(x.lower() if x.lower() in "sua" else "x", "") for x in letters])[1] == b
    assert {a for a, *_ in ways("")} == set(SETTLED)


@pytest.mark.parametrize("most_rows", [512, 2])
def test_matches_brute_force(conversations, most_rows):
    """Small pieces join conversations from many parts."""
    table = made(1, 60, 8) + made(2, 1, 40)
    summary, turns = repaired(conversations(table), most_rows=most_rows)
    want = brute(table)
    assert got(summary) == want
    rows = sorted(((r["conv_id"] is not None, r["conv_id"] or 0, r["piece"], r["place"], r["edit"], f"{r['role']}:{r['text']}") for r in turns.collect()))
    said = {k[1] if k[0] else None: list(v) for k, v in groupby(rows, key=lambda r: r[:2])}
    for conv, *_, audit, sha in want:
        own = said.get(conv, [])
        assert hashlib.sha256("\n".join(r[5] for r in own).encode()).hexdigest() == sha
        assert "".join(r[4] for r in own) == audit.replace("D", "")


def test_one_conversation_with_most_rows(conversations):
    pick = random.Random(9)
    table = [(1, t, pick.choice(ROLES[:3]), pick.choice(("Same first.", f"t{t}.", f"t{t // 9}"))) for t in range(400)]
    table += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(2, 60) for t in range(3)]
    assert got(repaired(conversations(table), most_rows=16)[0]) == brute(table)


def test_rows_all_alike(conversations):
    table = [(1, None, "user", "Same.")] * 500 + [(2, 7, None, None)] * 30
    assert got(repaired(conversations(table), most_rows=4)[0]) == brute(table)


def test_equal_rows_are_one_before_any_exchange(conversations):
    rows = damaged(conversations([(1, None, "user", "Same.")] * 500)).collect()
    assert len(rows) == 1 and rows[0]["copies"] in (0, 500, 1000)


def test_dropped_conversations_long_texts_and_empty_tables(conversations):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = [(gone, 0, "user", "Hello."), (5000, 1, "user", "x" * 2_000_000), (5000, 2, "assistant", "y " * 1_000_000 + ".")]
    assert got(repaired(conversations(table))[0]) == brute(table)
    assert brute(table)[0][1:8] == (0, 0, 0, 0, 0, 0, "") or brute(table)[1][1:8] == (0, 0, 0, 0, 0, 0, "")
    summary, turns = repaired(conversations([]))
    assert summary.collect() == [] and turns.collect() == []


def test_string_ids(conversations):
    table = [(c, t, "user", "Hi.") for c in (1, 10, 2) for t in range(3)]
    frame = conversations(table).withColumn("conv_id", F.col("conv_id").cast("string"))
    assert got(repaired(frame)[0]) == sorted(((str(r[0]), *r[1:]) for r in brute(table)), key=str)


def test_query_on_a_table(conversations, spark, tmp_path):
    table = made(11, 40, 6)
    conversations(table).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = queries()["op12_conversation_repair"](spark, str(tmp_path))
    assert rows.columns == COLUMNS and got(rows) == brute(table)
