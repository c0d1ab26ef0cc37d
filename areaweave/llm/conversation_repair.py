"""Repair of conversations whose turns are lost, empty, repeated, cut off or under a wrong role.

The roles of a sound conversation, by their initials, are a system turn or none, then pairs of user
and assistant, or nothing at all: ``(s?(ua)+)?``.  A repair keeps a turn (no cost), gives it another
role (3), deletes it (4), or inserts an empty turn (3); blank and repeated turns can only be deleted,
and a cut-off turn that stays costs 3 more.  The cheapest repair is found by weighted CYK parsing.

The grammar is in Chomsky normal form.  A nonterminal (p, q) stands for turns that lead from state p
to state q of the pattern: (p, q) -> (p, r) (r, q), and (p, q) -> a turn with one of its edits.  A
cell of the chart is a span's least (cost, audit) for each nonterminal, the audit being the initials
of its edits.  Cells of single turns are closed under insertion on both sides.  Whatever leads from p
to q passes some state r at any inner boundary, so every split of a span gives the same cell, and one
split is enough: spans of twice the length are combined bottom-up, all of a length before the next.
Two audits of one span and cost are never a beginning of one another (further insertions cost more),
so a least audit stays least whatever it is joined to.

Turns are put in order by a range partitioning over conversation and turn, so a conversation of any
length spreads over many tasks; each combines its stretch, and the stretches' cells, one for a task,
are combined in a second step.  Texts stay out of all that: a digest tells them apart.  They are
moved once, to be read in order beside the audit, a row at a time.

Turns come in order of ``turn``, nulls first; turns of one number by role and the text's digest.
Null roles and texts are one space.  The initial of a role is its first character; a role that
begins with none of s, u, a, or an empty one, can't be kept.  Conversations whose rows are all
missing from ``rows`` are the caller's to add.  An empty table gives no rows.  Null conversation ids
are one conversation.  Columns besides the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import pick, stored, wide

KEEP, ROLE, DELETE, INSERT = "K", "R", "D", "I"
ROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 3, 4, 3, 3
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}

#: Nonterminals that derive anything, and for each the states at which it splits.
REACH = {p: {START: (0, 1, 2, 3), SYSTEM: (1, 2, 3), USER: (2, 3), ASSISTANT: (2, 3)}[p] for p in range(4)}
NONTERMINALS = [(p, q) for p in range(4) for q in REACH[p]]
RULES = [(p, q, [(NONTERMINALS.index((p, r)), NONTERMINALS.index((r, q))) for r in REACH[p] if q in REACH[r]])
         for p, q in NONTERMINALS]

#: A cell: cost and audit by nonterminal, None where nothing can be derived.
Cell = list[tuple[int, str] | None]

#: ASCII white space and anything else, the end of a sentence before it, as Java regular expressions.
SOMETHING = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

CHARTS = "key string, stretch int, first string, last string, illegal long, costs array<long>, audits array<string>"
AUDITS = "key string, cost long, audit string, illegal long"
TURNS = "key string, seq long, role string, text string, edit string"


def _least(cell: Cell, n: int, cost: int, audit: str) -> None:
    if cell[n] is None or (cost, audit) < cell[n]:
        cell[n] = cost, audit


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out: Cell = [None] * len(NONTERMINALS)
    for n, (_, _, splits) in enumerate(RULES):
        best = None
        for i, j in splits:
            a, b = left[i], right[j]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
                best = cost, a[1] + b[1]
        out[n] = best
    return out


def _insertions() -> Cell:
    """The cell of no turn at all: what insertions alone lead to."""
    cell: Cell = [None] * len(NONTERMINALS)
    for p in range(4):
        _least(cell, NONTERMINALS.index((p, p)), 0, "")
    for _ in range(4):  # no state is more than two insertions from another
        for n, (p, q) in enumerate(NONTERMINALS):
            for (state, initial), after in STEPS.items():
                if cell[n] is not None and state == q and initial in NAMES:
                    _least(cell, NONTERMINALS.index((p, after)), cell[n][0] + INSERT_COST, cell[n][1] + INSERT)
    return cell


EMPTY = _insertions()


def turn_cell(initial: str, cut: bool, must_go: bool) -> Cell:
    """The cell of one turn, closed under insertions before and after it."""
    cell: Cell = [None] * len(NONTERMINALS)
    for p in range(4):
        _least(cell, NONTERMINALS.index((p, p)), DELETE_COST, DELETE)
    if not must_go:
        extra = CUT_COST if cut else 0
        for (state, symbol), after in STEPS.items():
            n = NONTERMINALS.index((state, after))
            if symbol == initial:
                _least(cell, n, extra, KEEP)
            if symbol in NAMES:
                _least(cell, n, ROLE_COST + extra, ROLE)
    return combine(combine(EMPTY, cell), EMPTY)


def parse(cells: list[Cell]) -> Cell:
    """The cell of all spans in a row: lengths doubled until one is left."""
    while len(cells) > 1:
        paired = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = paired + ([cells[-1]] if len(cells) % 2 else [])
    return cells[0] if cells else EMPTY


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the best accepted parse; deleting everything is always one."""
    return min(cell[NONTERMINALS.index((START, q))] for q in ACCEPTED if cell[NONTERMINALS.index((START, q))])


def _legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _out(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                      [name for name, _ in fields])


def _batched(rows: Iterator[tuple], schema: str, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _out(held, schema)
            held = []
    yield _out(held, schema)


class _Stretch:
    """The turns of one conversation that a task has, as they come: spans of falling length, like a binary counter."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []
        self.first: str | None = None
        self.last = ""
        self.illegal = 0

    def add(self, initial: str, cell: Cell) -> None:
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not _legal(self.last, initial)
        self.last = initial
        length = 1
        while self.spans and self.spans[-1][0] == length:
            cell, length = combine(self.spans.pop()[1], cell), 2 * length
        self.spans.append((length, cell))

    def cell(self) -> Cell:
        cell = self.spans[-1][1]
        for _, before in reversed(self.spans[:-1]):
            cell = combine(before, cell)
        return cell


def _chart(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation's stretch of turns in this task."""
    def rows() -> Iterator[tuple]:
        cells: dict[tuple, Cell] = {}
        here, stretch, part = None, _Stretch(), 0

        def done() -> tuple:
            cell = stretch.cell()
            return (here, part, stretch.first, stretch.last, stretch.illegal,
                    [c and c[0] for c in cell], [c and c[1] for c in cell])

        for key, part, initial, blank, again, cut, n in _rows(batches):
            if key != here:
                if here is not None:
                    yield done()
                here, stretch = key, _Stretch()
            for copy in range(n):
                turn = initial, bool(cut), bool(blank or again or copy)
                if turn not in cells:
                    cells[turn] = turn_cell(*turn)
                stretch.add(initial, cells[turn])
        if here is not None:
            yield done()

    yield from _batched(rows(), CHARTS)


def _join_stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best repair of every conversation, from the cells of its stretches in order."""
    def rows() -> Iterator[tuple]:
        here, cells, last, illegal = None, [], "", 0

        def done() -> tuple:
            cost, audit = cheapest(parse(cells))
            return here, cost, audit, illegal

        for key, _, first, end, inside, costs, audits in _rows(batches):
            cell = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
            if key != here:
                if here is not None:
                    yield done()
                here, cells, illegal = key, [cell], inside
            else:
                cells.append(cell)
                illegal += inside + (not _legal(last, first))
            last = end
        if here is not None:
            yield done()

    yield from _batched(rows(), AUDITS)


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns in order; each conversation's audit comes before its turns."""
    def rows() -> Iterator[tuple]:
        here, audit, at, state, seq = None, "", 0, START, 0

        def inserted() -> Iterator[tuple]:
            nonlocal at, state, seq
            while at < len(audit) and audit[at] == INSERT:
                initial = "a" if state == USER else "u"
                state = STEPS[state, initial]
                yield here, seq, NAMES[initial], "", INSERT
                at, seq = at + 1, seq + 1

        for key, kind, given, role, text in _rows(batches):
            if kind == 0:
                if here is not None:
                    yield from inserted()
                here, audit, at, state, seq = key, given, 0, START, 0
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == DELETE:
                continue
            initial = role[0] if edit == KEEP else "a" if state == USER else "u"
            state = STEPS[state, initial]
            yield here, seq, role if edit == KEEP else NAMES[initial], text, edit
            seq += 1
        if here is not None:
            yield from inserted()

    yield from _batched(rows(), TURNS)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, read in order."""
    def rows() -> Iterator[tuple]:
        here, state = None, None
        for key, _, role, text, _ in _rows(batches):
            if key != here:
                if here is not None:
                    yield here, state.hexdigest()
                here, state = key, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if here is not None:
            yield here, state.hexdigest()

    yield from _batched(rows(), "key string, repaired_sha256 string")


def key_of(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, turn, role and text alone, nulls of the last two a space."""
    rows = pick(df, conv_id=conv_id, turn=turn, role=role, text=text)
    return rows.select(key_of(F.col("conv_id")).alias("key"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Different turns of ``turns`` by key, turn, role and text's digest, how many there are of each, and their faults.

    ``again`` is whether role and text stood at a lesser turn; all copies but the first of one turn are repeated anyway.
    """
    thin = rows.select("key", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
                       (~F.col("text").rlike(SOMETHING)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"))
    entries = thin.groupBy("key", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n"))
    first = entries.groupBy("key", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    return entries.join(first, ["key", "role", "digest"]).select(
        "key", "turn", "role", "digest", "blank", "cut", "n", (F.col("first") < F.struct("turn")).alias("again"))


def audits(entries: DataFrame) -> DataFrame:
    """key, cost, audit and illegal (neighbours that the pattern rules out) of every conversation."""
    order = ["key", "turn", "role", "digest"]
    ordered = entries.repartitionByRange(wide(entries.sparkSession), *order).sortWithinPartitions(*order)
    charts = ordered.select("key", F.spark_partition_id().alias("stretch"), F.substring("role", 1, 1).alias("initial"),
                            "blank", "again", "cut", "n").mapInArrow(_chart, CHARTS)
    return charts.repartition("key").sortWithinPartitions("key", "stretch").mapInArrow(_join_stretches, AUDITS)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """key, seq, role, text and edit of every turn that the repair leaves or inserts, in order within partitions.

    ``rows`` comes from ``turns`` and ``found`` from ``audits``.  A conversation is read by one task, a row at a time.
    """
    both = rows.select("key", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"),
                       F.lit(None).cast("string").alias("audit"), "text").unionByName(
        found.select("key", F.lit(0).alias("kind"), "audit"), allowMissingColumns=True)
    ordered = both.repartition("key").sortWithinPartitions("key", "kind", "turn", "role", "digest")
    return ordered.select("key", "kind", "audit", "role", "text").mapInArrow(_apply, TURNS)


def figures(entries: DataFrame) -> DataFrame:
    """gaps, blank, duplicate and truncated of every conversation; a turn counts for its first fault alone."""
    n, fresh = F.col("n"), ~F.col("again")
    by_turn = entries.groupBy("key", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), n - fresh.cast("long")).otherwise(0)).alias("duplicate"),
        F.sum((~F.col("blank") & fresh & F.col("cut")).cast("long")).alias("truncated"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("key").agg(F.coalesce(span.cast("long"), F.lit(0)).alias("gaps"),
                                      *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Figures, cost and audit of every conversation, and its repaired turns."""
    rows = turns(df, conv_id, turn, role, text)
    entries = stored(faults(rows), "entries")
    found = stored(audits(entries), "audits")
    return figures(entries).join(found, "key"), repaired_turns(rows, found)


def damaged(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with known faults, chosen by the CRC of their id and turn; nulls are one space.

    One row in 20 each is dropped, emptied, robbed of its full stops, repeated, and given to the user.
    """
    rows = pick(df, conv_id=conv_id, turn=turn, role=role, text=text)
    place = F.concat_ws(":", key_of(F.col("conv_id")), key_of(F.col("turn")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(place) % 20).alias("fault"))
    rows = rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.expr("explode(sequence(1, if(fault = 3, 2, 1))) as copy"))
    return rows.drop("copy")


def digests(turns_in_order: DataFrame) -> DataFrame:
    """key and repaired_sha256 of the conversations that keep a turn, from ``repaired_turns``."""
    return turns_in_order.mapInArrow(_digest, "key string, repaired_sha256 string")
