"""Repair of the structure of conversations: the cheapest edits that give a legal order of roles.

A legal conversation is empty, or an optional system turn and then user and assistant in turns. Each row is kept, given
another role or deleted, and empty turns may be inserted. The edits are found as the lightest derivation of a weighted
hypergraph: an item (rows read, state) stands for all repairs of that many rows which end in the state; it follows
from an earlier item and an edit. Items wait in an agenda and are final when they are popped (Knuth), until the goal is.

A value is (cost, rows, audit), the audit being the letters of the edits. Costs add up, audits are joined, and every
conclusion is above its premises, as an edit without cost reads a row. Two audits of the same item and cost are never one the
beginning of the other (equal letters would cost the same), so their order outlives whatever follows or goes before.

Rows are sorted by conversation and turn over all tasks, so a long conversation lies in many of them. One that is
whole within a task is repaired there. The others are cut into blocks; the lightest values between any two states of a
block, and the order of their audits, are all that its neighbours need. Blocks are joined in a tree of fixed width, the
states are chosen from the top down, and each block then repairs its own rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import shuffle_partitions, sorted_groups, tidy
from precinct.session import materialize

# Rows and bytes of text of a block, and blocks (or joined blocks) that one step of the tree joins.
BLOCK_ROWS, BLOCK_BYTES, FAN = 256, 1 << 20, 64
NO_ID = -(1 << 63)
SPACES = " \t\n\x0b\x0c\r"

# --- Fixed values: costs and letters of the edits, and adjacent roles that are legal ---

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
LEGAL_PAIRS = {"su", "ua", "au"}

# States: nothing said yet, after the system, after a user, after an assistant (the first and the last may be the end).
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = 4
FOLLOWS = {
    (START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED,
}
GOAL = (-1, -1)
# What is inserted at the end, by the state there.
CLOSING = {START: 0, SYSTEM: 2, ASKED: 1, ANSWERED: 0}

# A row in a signature: its initial (x if it is no legal one), in capitals if it is truncated, or this if it must go.
FORCED = "-"


def row_sign(role: str, faulty: bool, truncated: bool) -> str:
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return FORCED if faulty else initial.upper() if truncated else initial


def _edits(sign: str) -> list[tuple[int, str, str | None]]:
    """(cost, letter, initial that it leaves or None) of the edits of a row."""
    if sign == FORCED:
        return [(DELETE, "D", None)]
    more = TRUNCATED if sign.isupper() else 0
    own = sign.lower()
    kept = [(more, "K", own)] if own != "x" else []
    return [*kept, (more + REROLE, "R", "u"), (more + REROLE, "R", "a"), (DELETE, "D", None)]


def lightest(signs: str, start: int = START, whole: bool = True) -> dict[tuple[int, int], tuple[int, str]]:
    """The lightest (cost, audit) of the items that were final before the goal was, GOAL among them.

    Without ``whole`` there is no goal, nothing is inserted behind the last row, and every item becomes final.
    """
    n = len(signs)
    chart: dict[tuple[int, int], tuple[int, str]] = {}
    # Premises of the second kind: the edits of each row, and insertions, which are premises at every place.
    ready: dict[int, list[tuple[int, str, str | None]]] = {}
    inserted: list[tuple[int, str, str]] = []
    states: dict[int, list[int]] = {}
    serial = count()  # equal values of different items are popped in the order of their arrival
    agenda: list[tuple[int, int, str, int, tuple]] = [(0, 0, "", next(serial), (0, start))]
    for i, sign in enumerate(signs):
        for cost, letter, initial in _edits(sign):
            agenda.append((cost, 0, letter, next(serial), ("edit", i, initial)))
    for initial in "ua":
        agenda.append((INSERT, 0, "I", next(serial), ("insert", initial)))
    heapify(agenda)

    def conclude(i: int, state: int, edit: tuple[int, str, str | None], reads: int) -> None:
        cost, letter, initial = edit
        after = state if initial is None else FOLLOWS.get((state, initial))
        if after is not None and (i + reads, after) not in chart:
            before, audit = chart[(i, state)]
            heappush(agenda, (before + cost, i + reads, audit + letter, next(serial), (i + reads, after)))

    while agenda:
        cost, _, audit, _, item = heappop(agenda)
        if item[0] == "edit":
            edit = (cost, audit, item[2])
            ready.setdefault(item[1], []).append(edit)
            for state in states.get(item[1], ()):
                conclude(item[1], state, edit, 1)
        elif item[0] == "insert":
            edit = (cost, audit, item[1])
            inserted.append(edit)
            for (i, state) in list(chart):
                if whole or i < n:
                    conclude(i, state, edit, 0)
        elif item not in chart:
            chart[item] = (cost, audit)
            if item == GOAL:
                break
            i, state = item
            states.setdefault(i, []).append(state)
            if whole and i == n and state in (START, ANSWERED):
                heappush(agenda, (cost, n + 1, audit, next(serial), GOAL))
            for edit in ready.get(i, ()):
                conclude(i, state, edit, 1)
            if whole or i < n:
                for edit in inserted:
                    conclude(i, state, edit, 0)
    return chart


@lru_cache(maxsize=4096)
def repair(signs: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these signs, the ASCII-least of equally cheap ones."""
    return lightest(signs)[GOAL]


def repaired(audit: str, rows: list[tuple[str, str] | None], state: int = START) -> list[tuple[str, str]]:
    """(role, text) of the rows after the edits of ``audit``, from ``state`` on."""
    out, at = [], 0
    for letter in audit:
        role, text = (ASSISTANT if state == ASKED else USER), ""
        if letter != "I":
            row, at = rows[at], at + 1
            if letter == "D":
                continue
            text = row[1]
            role = row[0] if letter == "K" else role
        out.append((role, text))
        state = FOLLOWS[(state, role[:1])]
    return out


# --- Blocks: tables of 4 x 4 values, from state to state; a cost of -1 says that there is no way ---

Table = tuple[list[int], list[int]]


def _ranked(costs: list[int], keys: list) -> Table:
    """Costs with the places of their ``keys`` in sorted order."""
    order = {key: place for place, key in enumerate(sorted({k for c, k in zip(costs, keys) if c >= 0}))}
    return costs, [order[k] if c >= 0 else 0 for c, k in zip(costs, keys)]


@lru_cache(maxsize=1024)
def _block_audits(signs: str) -> list[tuple[int, str]]:
    out = []
    for start in range(STATES):
        chart = lightest(signs, start, whole=False)
        out += [chart.get((len(signs), end), (-1, "")) for end in range(STATES)]
    return out


def block_table(signs: str) -> Table:
    found = _block_audits(signs)
    return _ranked([c for c, _ in found], [a for _, a in found])


def _join(a: Table, b: Table) -> tuple[Table, list[int]]:
    """The table of two neighbours, and the state between them for each pair of states."""
    costs, keys, through = [], [], []
    for start in range(STATES):
        for end in range(STATES):
            ways = [
                (a[0][start * STATES + k] + b[0][k * STATES + end], (a[1][start * STATES + k], b[1][k * STATES + end]), k)
                for k in range(STATES)
                if a[0][start * STATES + k] >= 0 and b[0][k * STATES + end] >= 0
            ]
            cost, key, middle = min(ways) if ways else (-1, (0, 0), 0)
            costs.append(cost)
            keys.append(key)
            through.append(middle)
    return _ranked(costs, keys), through


def joined_tables(tables: list[Table]) -> tuple[Table, list[list[int]]]:
    total, through = tables[0], []
    for table in tables[1:]:
        total, middle = _join(total, table)
        through.append(middle)
    return total, through


def path(through: list[list[int]], start: int, end: int) -> list[tuple[int, int]]:
    """The states before and after each of the joined blocks on the lightest way from ``start`` to ``end``."""
    bounds = [end]
    for middle in reversed(through):
        bounds.append(middle[start * STATES + bounds[-1]])
    bounds.append(start)
    bounds.reverse()
    return list(zip(bounds, bounds[1:]))


# --- The distributed steps ---

FAULTS = ("blank", "duplicate", "truncated", "illegal")
_COUNTS = (*FAULTS, "distinct_turns")
_ENDS = "first_turn long, last_turn long, first_initial string, last_initial string"
_STATS = ", ".join(f"{c} long" for c in _COUNTS) + f", rows long, {_ENDS}"
_TURNS = "array<struct<role: string, text: string>>"
_PIECE = f"conv_id long, part int, number int, whole boolean, {_STATS}, cost long, audit string, signs string, turns {_TURNS}"


class _Stats:
    """Counts of a stretch of rows, and what is at its ends."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct_turns = self.rows = 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None

    def row(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        initial = role[:1]
        if self.rows:
            self.illegal += self.last_initial + initial not in LEGAL_PAIRS
        else:
            self.first_initial = initial
        self.last_initial = initial
        self.rows += 1
        if turn is not None and turn != self.last_turn:
            self.distinct_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def add(self, other: _Stats) -> None:
        """What follows."""
        for name in _COUNTS:
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.rows and other.rows:
            self.illegal += self.last_initial + other.first_initial not in LEGAL_PAIRS
        if self.last_turn is not None and self.last_turn == other.first_turn:
            self.distinct_turns -= 1
        if not self.rows:
            self.first_initial = other.first_initial
        self.last_initial = other.last_initial if other.rows else self.last_initial
        self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if other.last_turn is None else other.last_turn
        self.rows += other.rows

    def gaps(self) -> int | None:
        if self.first_turn is None:
            return 0
        found = self.last_turn - self.first_turn + 1 - self.distinct_turns
        return found if found < 1 << 63 else None

    NAMES = (*_COUNTS, "rows", "first_turn", "last_turn", "first_initial", "last_initial")

    def values(self) -> list:
        return [getattr(self, name) for name in self.NAMES]

    @classmethod
    def of(cls, row: dict) -> _Stats:
        out = cls()
        for name in cls.NAMES:
            setattr(out, name, row[name])
        return out


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows of each conversation in their order, spread over tasks by ranges.

    Equal rows are one, with their number; the first row with a role and text carries the text, others carry none. Only
    digests of texts are compared besides.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = F.when(F.length(body) == 0, 1).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    rows = rows.withColumn("kind", kind)
    lost = F.col("copies") == 0
    key = [
        F.col("conv_id"),
        F.when(~lost, F.col("turn")).alias("turn"),
        F.when(lost, F.lit("")).otherwise(F.col("role")).alias("role"),
        F.when(lost, F.lit(b"")).otherwise(F.unhex(F.sha2("text", 256))).alias("digest"),
    ]
    order = ["conv_id", "turn", "role", "digest"]
    seen = rows.select(*key, "kind", "copies").groupBy(*order).agg(F.sum("copies").alias("copies"), F.max("kind").alias("kind"))
    said = rows.filter(~lost & (F.col("kind") != 1)).groupBy("conv_id", "role", "text")
    first = said.agg(F.min(F.struct("turn"))["turn"].alias("turn")).select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(None).cast("long").alias("copies"),
        F.lit(None).cast("int").alias("kind"), "text",
    )
    both = seen.withColumn("text", F.lit(None).cast("string")).unionByName(first)
    # A row is followed by the text that it is the first to say.
    spread = both.repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    return spread.sortWithinPartitions(*order, F.col("copies").asc_nulls_last())


def _first_pass(ordered: DataFrame) -> DataFrame:
    """Conversations that are whole within a task, repaired; of the others, blocks with their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = pa.schema(
            [("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int32()), ("whole", pa.bool_())]
            + [(c, pa.string() if "initial" in c else pa.int64()) for c in _Stats.NAMES]
            + [("cost", pa.int64()), ("audit", pa.string()), ("signs", pa.string())]
            + [("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
        )
        out: list[list] = []
        held_bytes = 0
        conv = stats = None
        signs: list[str] = []
        turns: list[tuple[str, str] | None] = []
        size = number = 0
        split = True  # the first conversation may have begun in another task

        def batch() -> pa.RecordBatch:
            nonlocal held_bytes
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)]
            out.clear()
            held_bytes = 0
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def close(whole: bool) -> None:
            nonlocal stats, size, number, held_bytes
            sign = "".join(signs)
            if whole:
                cost, audit = repair(sign)
                body = repaired(audit, turns)
            else:
                cost, audit, body = None, None, [t for t in turns if t]
            body = [{"role": r, "text": t} for r, t in body]
            out.append([conv, part, number, whole, *stats.values(), cost, audit, sign, body])
            held_bytes += size
            number += 1
            stats, size = _Stats(), 0
            signs.clear()
            turns.clear()

        def add(turn, role, text, fault) -> Iterator[pa.RecordBatch]:
            nonlocal split, size
            if len(signs) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                split = True
                close(False)
                if held_bytes >= BLOCK_BYTES:
                    yield batch()
            stats.row(turn, role, fault)
            forced = fault in ("blank", "duplicate")
            signs.append(row_sign(role, forced, fault == "truncated"))
            turns.append(None if forced else (role, text))
            size += 0 if forced else len(text)

        pending = None  # a row that may still get its text

        def settle(text: str | None) -> Iterator[pa.RecordBatch]:
            nonlocal pending
            _, turn, role, _, copies, kind = pending
            pending = None
            for copy in range(copies):
                if kind == 1:
                    yield from add(turn, role, None, "blank")
                elif copy or text is None:
                    yield from add(turn, role, None, "duplicate")
                else:
                    yield from add(turn, role, text, "truncated" if kind == 2 else None)

        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "copies", "kind", "text")]
            for conv_id, turn, role, digest, copies, kind, text in zip(*columns):
                if text is not None:
                    yield from settle(text)
                    continue
                if pending:
                    yield from settle(None)
                if stats is None or conv_id != conv:
                    if stats is not None:
                        close(not split)
                        split = False
                        if len(out) >= 1000 or held_bytes >= BLOCK_BYTES:
                            yield batch()
                    conv, stats, number = conv_id, _Stats(), 0
                pending = (conv_id, turn, role, digest, copies, kind)
        if pending:
            yield from settle(None)
        if stats is not None:
            close(False)  # it may go on in the next task
        if out:
            yield batch()

    columns = ordered.select("conv_id", "turn", "role", "digest", "copies", "kind", "text")
    return columns.mapInArrow(tidy(run), _PIECE)


_LEVEL = f"conv_id long, no long, costs array<long>, ranks array<long>, {_STATS}"


def _level_batch(rows: list[tuple[int, int, Table, _Stats]]) -> pa.RecordBatch:
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2][0] for r in rows], [r[2][1] for r in rows]]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns += [list(c) for c in zip(*(r[3].values() for r in rows))]
    types += [pa.string() if "initial" in c else pa.int64() for c in _Stats.NAMES]
    names = ["conv_id", "no", "costs", "ranks", *_Stats.NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _base(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _level_batch([(r["conv_id"], r["no"], block_table(r["signs"]), _Stats.of(r)) for r in batch.to_pylist()])

    return blocks.select("conv_id", "no", "signs", *_Stats.NAMES).mapInArrow(tidy(run), _LEVEL)


def _grouped(level: DataFrame) -> DataFrame:
    """``level`` with FAN neighbours side by side."""
    level = level.withColumn("above", F.floor(F.col("no") / FAN).cast("long"))
    return level.repartition("conv_id", "above").sortWithinPartitions("conv_id", "above", "no")


def _tables(group: list[dict]) -> tuple[Table, list[list[int]]]:
    return joined_tables([(r["costs"], r["ranks"]) for r in group])


def _level_above(level: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["conv_id", "above"]):
            rows = group.to_pylist()
            stats = _Stats.of(rows[0])
            for row in rows[1:]:
                stats.add(_Stats.of(row))
            yield _level_batch([(rows[0]["conv_id"], rows[0]["above"], _tables(rows)[0], stats)])

    return _grouped(level).mapInArrow(tidy(run), _LEVEL)


def _chosen_at_top(top: DataFrame) -> DataFrame:
    """(conv_id, no, start, end, cost and counts): the end that is cheapest with what must be inserted behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            if not rows:
                continue
            found = []
            for r in rows:
                ways = [(r["costs"][q] + INSERT * CLOSING[q], r["ranks"][q], q) for q in range(STATES) if r["costs"][q] >= 0]
                cost, _, end = min(ways)
                stats = _Stats.of(r)
                found.append((r["conv_id"], 0, START, end, cost, stats.gaps(), *(getattr(stats, c) for c in FAULTS)))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["conv_id", "no", "start", "end", "cost", "gaps", *FAULTS]
    return top.mapInArrow(tidy(run), ", ".join(f"{n} long" for n in names))


def _chosen_below(level: DataFrame, above: DataFrame) -> DataFrame:
    """(conv_id, no, start, end) of the blocks of ``level``, from those of the level above."""
    chosen = above.select("conv_id", F.col("no").alias("above"), "start", "end")
    joined = level.withColumn("above", F.floor(F.col("no") / FAN).cast("long")).join(chosen, ["conv_id", "above"])
    rows = joined.repartition("conv_id", "above").sortWithinPartitions("conv_id", "above", "no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["conv_id", "above"]):
            rows = group.to_pylist()
            way = path(_tables(rows)[1], rows[0]["start"], rows[0]["end"])
            columns = [[r["conv_id"] for r in rows], [r["no"] for r in rows], [a for a, _ in way], [b for _, b in way]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["conv_id", "no", "start", "end"])

    return rows.select("conv_id", "above", "no", "costs", "ranks", "start", "end").mapInArrow(
        tidy(run), "conv_id long, no long, start long, end long"
    )


def _split_pieces(blocks: DataFrame) -> DataFrame:
    """Pieces of the conversations that no task has seen whole."""
    # One row for each conversation and task: at most as many of a conversation as there are tasks.
    runs = blocks.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    blocks = materialize(
        blocks.join(runs, ["conv_id", "part"]).withColumn("no", F.col("before") + F.col("number")), "conversation-blocks"
    )
    levels = [materialize(_base(blocks), "conversation-levels")]
    while levels[-1].agg(F.max("no")).first()[0]:
        levels.append(materialize(_level_above(levels[-1]), "conversation-levels"))
    top = materialize(_chosen_at_top(levels[-1]), "conversation-choices")
    chosen = top.select("conv_id", "no", "start", "end")
    for level in reversed(levels[:-1]):
        chosen = materialize(_chosen_below(level, chosen), "conversation-choices")
    last = blocks.groupBy("conv_id").agg((F.max("no") + 1).alias("pieces"))
    found = blocks.select("conv_id", "no", "signs", F.col("turns").alias("body")).join(chosen, ["conv_id", "no"])
    found = found.join(top.drop("no", "start", "end"), "conv_id").join(last, "conv_id")
    names = ["conv_id", "piece", "pieces", "gaps", *FAULTS, "cost", "audit", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                start, end = r["start"], r["end"]
                audit = _block_audits(r["signs"])[start * STATES + end][1]
                texts = iter((t["role"], t["text"]) for t in r["body"])
                rows = [None if sign == FORCED else next(texts) for sign in r["signs"]]
                if r["no"] + 1 == r["pieces"]:
                    audit += "I" * CLOSING[end]
                body = [{"role": role, "text": text} for role, text in repaired(audit, rows, start)]
                out.append([r["conv_id"], r["no"], r["pieces"], r["gaps"], *(r[c] for c in FAULTS), r["cost"], audit, body])
            if out:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [pa.int64()] * 9 + [pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]
    return found.mapInArrow(tidy(run), _PIECES)


_PIECES = f"conv_id long, piece long, pieces long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns {_TURNS}"


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, piece, pieces, gaps, blank, duplicate, truncated, illegal, cost, audit, turns): the repaired conversations.

    ``rows`` has conv_id, turn, role, text, and copies: how often a row stands there, 0 for one that only names its
    conversation. A conversation comes in one piece or, if it is long or lies at the border of two tasks, in several; the
    counts and the cost are those of the whole conversation, audit and turns (role, text) those of the piece.

    Rows go by turn, null turns first, equal turns by role and a digest of the text. A null role or text counts as one
    blank. Equal rows follow one another; all but the first are duplicates. A role without a legal initial, an empty one
    too, cannot be kept. A null conv_id is a conversation of its own (as is -2^63, which is the same one). Other columns
    are not read; no rows give no rows.
    """
    blank = F.lit(" ")
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), F.col("copies").cast("long").alias("copies"),
    )
    found = materialize(_first_pass(_ordered(rows)), "conversations")
    gaps = F.try_subtract(F.col("last_turn"), F.col("first_turn")) + 1 - F.col("distinct_turns")
    whole = found.filter("whole").select(
        "conv_id", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("pieces"),
        F.when(F.col("first_turn").isNull(), F.lit(0)).otherwise(gaps).cast("long").alias("gaps"), *FAULTS, "cost", "audit", "turns",
    )
    out = whole.unionByName(_split_pieces(found.filter("not whole")))
    return out.withColumn("conv_id", F.when(F.col("conv_id") != NO_ID, F.col("conv_id")))


def digests(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: its counts and cost, the whole audit, and repaired_sha256 of its ``role:text`` lines.

    The hash of a conversation in several pieces is fed piece by piece, in their order; only its state is held.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    names = ["conv_id", "gaps", *FAULTS, "cost", "audit", "repaired_sha256"]
    whole = pieces.filter("pieces = 1").withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audits, begun = hashlib.sha256(), [], False
        for batch in batches:
            for row in batch.to_pylist():
                for line in row["lines"]:
                    digest.update(("\n" * begun + line).encode())
                    begun = True
                audits.append(row["audit"])
                if row["piece"] + 1 == row["pieces"]:
                    values = [*(row[c] for c in names[:-2]), "".join(audits), digest.hexdigest()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)
                    digest, audits, begun = hashlib.sha256(), [], False

    types = [pa.int64()] * 7 + [pa.string()] * 2
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    long = pieces.filter("pieces > 1").withColumn("lines", lines).drop("turns")
    long = long.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(tidy(run), schema)
    return whole.unionByName(long)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as ``repair_conversations`` takes them, damaged by a checksum of ``conv_id:turn``; a null counts as one blank.

    Of 20 rows, one each is lost, emptied, without its closing marks, there twice, or said by the user.
    """
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    draw = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return rows.select(
        "conv_id",
        "turn",
        F.when(draw == 4, F.lit(USER)).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
