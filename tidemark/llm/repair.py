"""Conversations whose roles don't alternate, repaired at least cost by a generalised LR parser."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged

# --- The grammar of roles, by their initials ------------------------------------------------------
#
#   Conversation -> (nothing) | Turns        Turns -> Head u a | Turns u a        Head -> (nothing) | s
#
# and its LR states, each named by what it has just read. Only one stack leads to each state, so
# merging stacks with equal tops loses none.
START, SYSTEM, HEAD, HEAD_U, HEAD_UA, TURNS, TURNS_U, TURNS_UA = range(8)
SHIFT = {
    (START, "s"): SYSTEM, (HEAD, "u"): HEAD_U, (HEAD_U, "a"): HEAD_UA, (TURNS, "u"): TURNS_U, (TURNS_U, "a"): TURNS_UA,
}
#: state -> (rows popped, what they become); with START only before `u`
REDUCE = {SYSTEM: (1, "Head"), HEAD_UA: (3, "Turns"), TURNS_UA: (3, "Turns")}
EMPTY_HEAD = (START, "u")
GOTO = {(START, "Head"): HEAD, (START, "Turns"): TURNS}
ACCEPTING = (START, TURNS)
SETTLED = {START: (START,), HEAD: (START, HEAD), HEAD_U: (START, HEAD, HEAD_U), TURNS: (START, TURNS), TURNS_U: (START, TURNS, TURNS_U)}
#: The one role of user and assistant that can follow in each state.
NEXT_ROLE = {START: "user", HEAD: "user", HEAD_U: "assistant", TURNS: "user", TURNS_U: "assistant"}
# Costs and initials of the edits.
KEEP, DELETE, INSERT, REROLE, TRUNCATED = 0, 3, 2, 2, 1
# A row is a letter to the parser: s, u, a or o (another initial), as a capital if it is truncated, or
# MUST_DELETE if it is blank or a duplicate.
MUST_DELETE = "D"
LEGAL = {"su", "ua", "au"}


class Vertex(NamedTuple):
    """A top of the graph-structured stack: the best way to get there, and the vertex below."""

    cost: int
    audit: str
    state: int
    below: Vertex | None


def _push(below: Vertex | None, state: int, cost: int, audit: str) -> Vertex:
    return Vertex(cost, audit, state, below)


def _reduced(top: Vertex, pops: int, name: str) -> Vertex:
    base = top
    for _ in range(pops):
        base = base.below
    return _push(base, GOTO[base.state, name], top.cost, top.audit)


def _shifted(top: Vertex, initial: str, cost: int, edit: str) -> Vertex | None:
    """The stack after reading an initial, reduced as far as it goes; None if it can't be read."""
    if (top.state, initial) == EMPTY_HEAD:
        top = _reduced(top, 0, "Head")
    state = SHIFT.get((top.state, initial))
    if state is None:
        return None
    top = _push(top, state, top.cost + cost, top.audit + edit)
    return _reduced(top, *REDUCE[state]) if state in REDUCE else top


Tops = dict[int, Vertex]


def _merge(tops: Tops, new: Vertex | None) -> bool:
    """Stacks with equal tops are merged: the least (cost, audit) stays."""
    old = None if new is None else tops.get(new.state)
    if new is None or (old is not None and old[:2] <= new[:2]):
        return False
    tops[new.state] = new
    return True


def _with_inserts(tops: Tops) -> Tops:
    pending = list(tops.values())
    while pending:
        top = pending.pop()
        if tops[top.state] is top:
            pending += [v for i in "ua" if _merge(tops, v := _shifted(top, i, INSERT, "I"))]
    return tops


def _read(tops: Tops, letter: str) -> Tops:
    after: Tops = {}
    for top in tops.values():
        _merge(after, Vertex(top.cost + DELETE, top.audit + "D", top.state, top.below))
        if letter == MUST_DELETE:
            continue
        extra = TRUNCATED if letter.isupper() else 0
        _merge(after, _shifted(top, letter.lower(), KEEP + extra, "K"))
        for initial in "ua":
            _merge(after, _shifted(top, initial, REROLE + extra, "R"))
    return _with_inserts(after)


def _entered(state: int) -> Tops:
    top = None
    for below in SETTLED[state]:
        top = _push(top, below, 0, "")
    return {state: top}


@lru_cache(maxsize=50_000)
def cheapest(letters: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    tops = _with_inserts(_entered(START))
    for letter in letters:
        tops = _read(tops, letter)
    return min(tops[s][:2] for s in ACCEPTING if s in tops)


@lru_cache(maxsize=20_000)
def ways(letters: str) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit): the cheapest way through a piece of a conversation."""
    found = []
    for state in SETTLED:
        tops = _entered(state)
        for letter in letters:
            tops = _read(tops, letter)
        found += [(state, v.state, v.cost, v.audit) for v in tops.values()]
    return tuple(found)


def edited(state: int, audit: str, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str, str]], int]:
    """(edit, role, text) of the turns that an audit leaves of rows (role, text), and the state behind."""
    top, out, at = _entered(state)[state], [], 0
    for edit in audit:
        if edit != "D":
            role, text = ("", "") if edit == "I" else rows[at]
            if edit != "K":
                role = NEXT_ROLE[top.state]
            out.append((edit, role, text))
            top = _shifted(top, role[:1], 0, "")
        at += edit != "I"
    return out, top.state


# --- Damage, and rows in order ----------------------------------------------------------------------

GAPS = "\t\n\x0b\x0c\r "
SEGMENT_ROWS, SEGMENT_CHARACTERS = 512, 1 << 20
PREFIX = 200  # characters of a text that ranges are told apart by


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of each distinct row after the damage.

    crc32("conv_id:turn") % 20 drops a row (0), empties its text (1), takes its .!? away (2), repeats it (3)
    or makes its role user (4). Nulls count as a space, but conv_id and turn stay null. A dropped row
    leaves its conv_id with no copies. Equal rows become one before any exchange.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("kind"))
    dropped = F.col("kind") == 0
    unless = lambda value, other: F.when(dropped, other).otherwise(value)
    return (
        rows.select(
            "conv_id", F.when(~dropped, F.col("turn")).alias("turn"),
            unless(F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "").alias("role"),
            unless(text, "").alias("text"),
            F.when(dropped, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows sorted over all partitions. No two are equal, so no conversation is too large to be cut."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role")]
    core = F.rtrim("text", F.lit(GAPS))
    fault = F.when(core == "", "blank").when(~F.right(core, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    ranges = rows.repartitionByRange(*order, F.asc(F.substring("text", 1, PREFIX)))
    return ranges.sortWithinPartitions(*order, F.asc("text")).withColumn("fault", fault)


class Piece:
    """Consecutive rows of one conversation: letters for the parser, and what is counted."""

    def __init__(self, rows: list[dict], repeated: set[int]):
        """`repeated`: the rows whose role and text an earlier piece has."""
        self.rows: list[tuple[str, str]] = []
        letters, turns, seen = [], [], set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        for number, row in enumerate(rows):
            copies, told = row["copies"], (row["role"], row["text"])
            if not copies:
                continue
            initial = told[0][:1]
            if self.rows and self.rows[-1][0][:1] + initial not in LEGAL:
                self.illegal += 1
            self.illegal += copies - 1
            if row["fault"] == "blank":
                self.blank += copies
                letters.append(MUST_DELETE * copies)
            else:
                again = number in repeated or told in seen
                self.duplicate += copies - (not again)
                self.truncated += not again and row["fault"] == "truncated"
                letter = initial if initial and initial in "sua" else "o"
                first = MUST_DELETE if again else letter.upper() if row["fault"] else letter
                letters.append(first + MUST_DELETE * (copies - 1))
                seen.add(told)
            self.rows += [told] * copies
            if row["turn"] is not None and (not turns or turns[-1] != row["turn"]):
                turns.append(row["turn"])
        self.letters = "".join(letters)
        self.turns = turns

    def edge(self, which: int) -> str | None:
        return self.rows[which][0][:1] if self.rows else None


def _sha(lines: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest()


TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LINE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("edit", "role", "text")]))


def _fields(conv: T.StructField, turn: T.StructField) -> tuple[T.StructType, T.StructType, T.StructType]:
    conv_id = T.StructField("conv_id", conv.dataType)
    totals = [T.StructField(c, T.LongType()) for c in TOTALS]
    audit = [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    row = T.StructType([
        T.StructField("turn", turn.dataType), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("copies", T.LongType()), T.StructField("fault", T.StringType()),
    ])
    pieces = T.StructType([
        conv_id, T.StructField("piece", T.LongType()), T.StructField("whole", T.BooleanType()), *totals, *audit,
        T.StructField("lines", LINE), T.StructField("rows", T.ArrayType(row)), T.StructField("hashes", T.ArrayType(T.BinaryType())),
    ])
    way = T.StructType([
        T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()),
        T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
    ])
    counted = T.StructType([
        conv_id, T.StructField("piece", T.LongType()), *totals[1:5], T.StructField("n_rows", T.LongType()),
        T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
        T.StructField("turns", T.ArrayType(T.LongType())), T.StructField("ways", T.ArrayType(way)),
    ])
    joined = T.StructType([
        conv_id, T.StructField("first_piece", T.LongType()), T.StructField("piece", T.LongType()), *totals, audit[0],
        T.StructField("before", T.IntegerType()),
    ])
    return pieces, counted, joined


def _batches(rows: Iterator[dict], schema: T.StructType, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about SEGMENT_CHARACTERS."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, waiting, held = to_arrow_schema(schema), [], 0
    for row in rows:
        waiting.append(row)
        held += weight(row)
        if held >= SEGMENT_CHARACTERS:
            yield pa.RecordBatch.from_pylist(waiting, arrow)
            waiting, held = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, arrow)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            yield from batch.slice(low, 1024).to_pylist()


def _cut(rows: Iterator[dict], most_rows: int) -> Iterator[tuple[list[dict], bool]]:
    """Pieces of conversations, and whether each is a whole one. What touches an end of the partition
    may go on in the next one."""
    first = True
    for _, own in groupby(rows, key=lambda r: r["conv_id"]):
        waiting, held, cut = [], 0, first
        for row in own:
            if len(waiting) >= most_rows or held > SEGMENT_CHARACTERS:
                yield waiting, False
                waiting, held, cut = [], 0, True
            waiting.append(row)
            held += len(row["text"])
        yield waiting, not cut
        first = False


def _last_is_open(pieces: Iterator[tuple[list[dict], bool]]) -> Iterator[tuple[list[dict], bool]]:
    before = None
    for piece in pieces:
        if before is not None:
            yield before
        before = piece
    if before is not None:
        yield before[0], False


def _hash(row: dict) -> bytes:
    role = row["role"].encode()
    return hashlib.sha256(len(role).to_bytes(4, "little") + role + row["text"].encode()).digest()


def _pieces(schema: T.StructType, most_rows: int):
    """Repairs whole conversations at once; others are kept as pieces with hashes of what they have said."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        base = TaskContext.get().partitionId() << 32
        for number, (rows, whole) in enumerate(_last_is_open(_cut(_rows(batches), most_rows))):
            out = {"conv_id": rows[0]["conv_id"], "piece": base | number, "whole": whole}
            if not whole:
                own = [{k: v for k, v in r.items() if k != "conv_id"} for r in rows]
                yield out | {"rows": own, "hashes": [_hash(r) if r["fault"] != "blank" and r["copies"] else None for r in rows]}
                continue
            piece = Piece(rows, set())
            cost, audit = cheapest(piece.letters)
            lines, _ = edited(START, audit, piece.rows)
            turns = piece.turns
            yield out | {
                "gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0, "blank": piece.blank, "duplicate": piece.duplicate,
                "truncated": piece.truncated, "illegal": piece.illegal, "cost": cost, "audit": audit, "repaired_sha256": _sha(lines),
                "lines": [dict(zip(("edit", "role", "text"), x, strict=True)) for x in lines],
            }

    weight = lambda r: 200 + sum(len(x["text"]) for x in r.get("lines", r.get("rows")))
    return lambda batches: _batches(made(batches), schema, weight)


def _count(schema: T.StructType):
    """Counts faults of each piece and finds the cheapest ways through it."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _rows(batches):
            piece = Piece(row["rows"], set(row["repeated"] or ()))
            turns = piece.turns
            yield {
                "conv_id": row["conv_id"], "piece": row["piece"], "blank": piece.blank, "duplicate": piece.duplicate,
                "truncated": piece.truncated, "illegal": piece.illegal, "n_rows": len(piece.rows),
                "first_initial": piece.edge(0), "last_initial": piece.edge(-1),
                "turns": [turns[0], turns[-1], len(turns)] if turns else [],
                "ways": [dict(zip(("before", "after", "cost", "audit"), w, strict=True)) for w in ways(piece.letters)],
            }

    return lambda batches: _batches(made(batches), schema, lambda r: 200 + sum(50 + len(w["audit"]) for w in r["ways"]))


def _slices(audit: str, counts: list[int]) -> list[str]:
    """The part of an audit that each piece of so many rows has; insertions belong to the rows before."""
    out, at = [], 0
    for number, count in enumerate(counts):
        begin = at
        if not number:
            at = len(audit) - len(audit.lstrip("I"))
        for _ in range(count):
            at += 1
            while at < len(audit) and audit[at] == "I":
                at += 1
        out.append(audit[begin:at])
    return out


def _follow(own: Iterator[dict]) -> Iterator[dict]:
    """The cheapest way through all pieces of one conversation, which come in order."""
    best = {s: (v.cost, v.audit) for s, v in _with_inserts(_entered(START)).items()}
    settled, path, pieces, counts = [], [], [], []
    totals = dict.fromkeys(TOTALS, 0)
    initial, turns = None, []  # of the row before; first, last and number of distinct turns
    for row in own:
        new: dict[int, tuple[int, str]] = {}
        came: dict[int, int] = {}
        for way in row["ways"]:
            if way["before"] in best:
                cost, audit = best[way["before"]]
                found = cost + way["cost"], audit + way["audit"]
                if way["after"] not in new or found < new[way["after"]]:
                    new[way["after"]], came[way["after"]] = found, way["before"]
        # What all have in common is settled, so that audits to compare stay short.
        common = os.path.commonprefix([a for _, a in new.values()])
        settled.append(common)
        best = {s: (c, a[len(common):]) for s, (c, a) in new.items()}
        path.append(came)
        pieces.append(row["piece"])
        counts.append(row["n_rows"])
        for c in TOTALS[1:5]:
            totals[c] += row[c]
        if row["first_initial"] is not None:
            totals["illegal"] += initial is not None and initial + row["first_initial"] not in LEGAL
            initial = row["last_initial"]
        if row["turns"]:
            low, high, n = row["turns"]
            turns = [turns[0], high, turns[2] + n - (turns[1] == low)] if turns else [low, high, n]
    state = min((best[s], s) for s in ACCEPTING if s in best)[1]
    totals["cost"], rest = best[state]
    audit = "".join(settled) + rest
    totals["gaps"] = turns[1] - turns[0] + 1 - turns[2] if turns else 0
    before = []
    for came in reversed(path):
        state = came[state]
        before.append(state)
    yield {"first_piece": pieces[0], "audit": audit, **totals}
    parts = _slices(audit, counts)
    for number, (piece, entered, part) in enumerate(zip(pieces, reversed(before), parts, strict=True)):
        yield {"first_piece": pieces[0], "piece": piece, "before": START if not number else entered, "audit": part}


def _join(schema: T.StructType):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, own in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            yield from ({"conv_id": conv, **row} for row in _follow(own))

    return lambda batches: _batches(made(batches), schema, lambda r: 200 + len(r["audit"]))


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that each piece is left with."""
    schema = T.StructType([
        T.StructField("first_piece", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("lines", LINE),
    ])

    def made() -> Iterator[dict]:
        for row in _rows(batches):
            lines, _ = edited(row["before"], row["audit"], Piece(row["rows"], set()).rows)
            named = [dict(zip(("edit", "role", "text"), x, strict=True)) for x in lines]
            yield {"first_piece": row["first_piece"], "piece": row["piece"], "lines": named}

    return _batches(made(), schema, lambda r: 200 + sum(len(x["text"]) for x in r["lines"]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over all turns of a conversation, whose pieces come in order; one piece is held at a time."""
    for first, own in groupby(_rows(batches), key=lambda r: r["first_piece"]):
        digest, empty = hashlib.sha256(), True
        for line in (x for row in own for x in row["lines"]):
            digest.update(("" if empty else "\n").encode() + f"{line['role']}:{line['text']}".encode())
            empty = False
        yield pa.RecordBatch.from_pydict({"first_piece": pa.array([first], pa.int64()), "repaired_sha256": [digest.hexdigest()]})


RENDERED = T.StructType([T.StructField("first_piece", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("lines", LINE)])


def repaired(conversations: DataFrame, damage=damaged, most_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Two frames from `conversations` (conv_id, turn, role, text) after `damage`:

    * one row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256;
    * the turns that are left: conv_id, piece, place, edit, role, text, in the order of piece and place.

    The initials of the repaired roles read `(s?(ua)+)?`. A row is kept (0), given the role user or assistant
    (2) or deleted (3, forced for blank rows and duplicates); turns without text are inserted (2); a
    truncated row that stays costs 1 more. Of the cheapest repairs the one with the least audit is taken.

    A generalised LR parser reads the initials: tops of a graph-structured stack are extended by the edits,
    and equal tops merged by the least (cost, audit). Every top has the costs of its whole past in it, and
    an audit is longer than its own beginnings only by costly insertions, so merging is exact.

    Rows are sorted over all partitions (ranges of conversation and turn). Conversations inside a partition
    are repaired there. Others are cut into pieces of at most `most_rows` rows, for which the cheapest ways from
    each state to each are found; the ways are joined in the order of pieces. So a conversation of any length
    is repaired, and what meets in one task is a summary per piece. Its digest passes over its pieces in
    order, as SHA-256 has to, and holds one at a time; its audit is one string, as it is one value.

    * Rows are ordered by turn (null first), then role and text. A null role or text is a space; a null
      conv_id is a conversation of its own; gaps ignore null turns.
    * A role without an initial of s, u, a (an empty one too) can't be kept. Equal rows are duplicates.
    * A conversation whose rows are all dropped has zeros, an empty audit and the hash of nothing.
    * An empty table gives no rows. Other columns are not read. Turns are whole numbers.
    """
    pieces_of, counted_of, joined_of = _fields(conversations.schema["conv_id"], conversations.schema["turn"])
    label = "conversation"
    ordered = _in_order(damage(conversations.select("conv_id", "turn", "role", "text")))
    pieces = staged(ordered.mapInArrow(_pieces(pieces_of, most_rows), pieces_of), f"{label}-pieces")
    cut = pieces.where("not whole")

    # Of each role and text that pieces of a conversation share, the first piece has the original.
    said = cut.select("conv_id", "piece", F.posexplode("hashes").alias("number", "hash")).where("hash is not null")
    once = said.groupBy("conv_id", "piece", "hash").agg(F.min("number").alias("number"))
    again = once.withColumn("n", F.row_number().over(Window.partitionBy("conv_id", "hash").orderBy("piece"))).where("n > 1")
    repeated = again.groupBy("piece").agg(F.collect_list("number").alias("repeated"))
    counted = cut.select("conv_id", "piece", "rows").join(repeated, "piece", "left").mapInArrow(_count(counted_of), counted_of)
    by_conversation = counted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    joined = staged(by_conversation.mapInArrow(_join(joined_of), joined_of), f"{label}-ways")

    ways_taken = joined.where("piece is not null").select("first_piece", "piece", "before", "audit")
    rendered = staged(cut.select("piece", "rows").join(ways_taken, "piece").mapInArrow(_render, RENDERED), f"{label}-turns")
    digests = (
        rendered.repartition("first_piece").sortWithinPartitions("first_piece", "piece")
        .mapInArrow(_digest, "first_piece long, repaired_sha256 string")
    )
    long_ones = joined.where("piece is null").drop("piece").join(digests, "first_piece")
    columns = ["conv_id", *TOTALS, "audit", "repaired_sha256"]
    summary = pieces.where("whole").select(*columns).unionByName(long_ones.select(*columns))

    names = joined.where("piece is null").select("conv_id", "first_piece")
    long_turns = rendered.join(names, "first_piece").select("conv_id", "piece", F.posexplode("lines").alias("place", "line"))
    turns = pieces.where("whole").select("conv_id", "piece", F.posexplode("lines").alias("place", "line")).unionByName(long_turns)
    return summary, turns.select("conv_id", "piece", "place", "line.*")
