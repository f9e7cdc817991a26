"""Repair of conversation structure by generalised LR parsing with weighted edits.

The roles of a conversation must read ``(s?(ua)+)?``. Its grammar (``GRAMMAR``) gives an LR
automaton; a parse keeps a graph-structured stack, whose tops are extended at every row by
keeping, reroling or deleting it and between rows by inserting one. Stacks with equal tops
are merged into the one of least (cost, audit), the audit being the initials of the edits so
far. In this grammar a top determines all that lies below it, so tops can be numbered and
nothing is lost by merging.

Long conversations. A parse from one top to another needs nothing else of what came before,
so a conversation is parsed in pieces: rows are dealt out by range of (conversation, turn),
each task parses its part, from every top where the part does not begin its conversation,
and the pieces are chained. Audits are never compared from their begin: equal-cost audits
of different tops are never prefixes of one another once a row was consumed, so their order
at one row decides all later comparisons.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Role initials: an optional system turn, then pairs of user and assistant turns.
GRAMMAR = (("S", ""), ("S", "B"), ("B", "Hua"), ("B", "Bua"), ("H", ""), ("H", "s"))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows after which a parse writes its audits down and goes on with empty ones.
SEGMENT_ROWS = 1024
#: ASCII white space.
_BLANKS = " \t\n\x0b\f\r"


def _closure(items: frozenset) -> frozenset:
    todo, seen = list(items), set(items)
    while todo:
        rule, dot = todo.pop()
        right = GRAMMAR[rule][1]
        for other, (left, _) in enumerate(GRAMMAR):
            if dot < len(right) and left == right[dot] and (other, 0) not in seen:
                seen.add((other, 0))
                todo.append((other, 0))
    return frozenset(seen)


def _goto(state: frozenset, symbol: str) -> frozenset:
    moved = {(r, d + 1) for r, d in state if GRAMMAR[r][1][d : d + 1] == symbol}
    return _closure(frozenset(moved)) if moved else frozenset()


START = (_closure(frozenset((r, 0) for r, (left, _) in enumerate(GRAMMAR) if left == "S")),)


def _reductions(stack: tuple) -> list[tuple]:
    """The stacks that a stack turns into by one reduction of a rule of S's parts."""
    out = []
    for rule, dot in stack[-1]:
        left, right = GRAMMAR[rule]
        if dot == len(right) and left != "S":
            below = stack[: len(stack) - dot]
            out.append((*below, _goto(below[-1], left)))
    return [s for s in out if s[-1]]


def _reduced(stack: tuple) -> set[tuple]:
    seen, todo = set(), [stack]
    while todo:
        one = todo.pop()
        if one not in seen:
            seen.add(one)
            todo += _reductions(one)
    return seen


def _shift(stack: tuple, symbol: str) -> tuple | None:
    """The stack after reading a symbol; a full right side without alternatives is reduced."""
    for one in _reduced(stack):
        state = _goto(one[-1], symbol)
        if state:
            after = (*one, state)
            while all(d == len(GRAMMAR[r][1]) for r, d in after[-1]) and (less := _reductions(after)):
                after = less[0]
            return after
    return None


def _tables() -> tuple[list[dict[str, int]], list[bool]]:
    """For every top what each symbol makes of it, and whether a parse may end there."""
    stacks, at = [START], 0
    after: list[dict[str, int]] = []
    while at < len(stacks):
        step = {}
        for symbol in "sua":
            new = _shift(stacks[at], symbol)
            if new is not None:
                if new not in stacks:
                    stacks.append(new)
                step[symbol] = stacks.index(new)
        after.append(step)
        at += 1
    ends = [any(GRAMMAR[r][0] == "S" and d == len(GRAMMAR[r][1]) for r, d in s[-1]) for s in stacks]
    return after, ends


AFTER, ENDS = _tables()
TOPS = range(len(AFTER))


class Parse:
    """Least (cost, audit) of every stack top, from one top on.

    ``best`` has (cost, rank, audit since the last note, top at that note) by top; ``rank``
    is the order of the whole audits at that note.
    """

    def __init__(self, start: int = 0):
        self.best = {start: (0, 0, "", start)}
        self.notes: list[dict[int, tuple[str, int]]] = []
        self.rows = 0

    def _inserted(self) -> dict[int, tuple]:
        """The tops with insertions that come before the next row."""
        best, todo = dict(self.best), list(self.best)
        while todo:
            top = todo.pop()
            cost, rank, audit, origin = best[top]
            new = (cost + INSERT, rank, audit + "I", origin)
            for symbol in ROLES:
                after = AFTER[top].get(symbol)
                if after is not None and (after not in best or new < best[after]):
                    best[after] = new
                    todo.append(after)
        return best

    def row(self, initial: str, drop: bool, truncated: bool) -> None:
        """One more row: ``drop`` means that it must be deleted."""
        more = TRUNCATED if truncated else 0
        out: dict[int, tuple] = {}
        for top, (cost, rank, audit, origin) in self._inserted().items():
            moves = [(top, cost + DELETE, "D")]
            if not drop:
                for symbol, after in AFTER[top].items():
                    if symbol == initial:
                        moves.append((after, cost + KEEP + more, "K"))
                    elif symbol in ROLES:
                        moves.append((after, cost + REROLE + more, "R"))
            for after, price, edit in moves:
                new = (price, rank, audit + edit, origin)
                if after not in out or new < out[after]:
                    out[after] = new
        self.best = out
        self.rows += 1
        if self.rows % SEGMENT_ROWS == 0:
            self._note()

    def _note(self) -> None:
        order = sorted(self.best, key=lambda top: self.best[top][1:3])
        self.notes.append({top: self.best[top][2:] for top in self.best})
        self.best = {top: (self.best[top][0], rank, "", top) for rank, top in enumerate(order)}

    def piece(self, moves: list[tuple[int, int, int, str]]) -> None:
        """Rows parsed elsewhere: (top before, top after, cost, audit) for pairs of tops."""
        out: dict[int, tuple] = {}
        for start, end, cost, audit in moves:
            if start in self.best:
                sofar, rank, before, origin = self.best[start]
                new = (sofar + cost, rank, before + audit, origin)
                if end not in out or new < out[end]:
                    out[end] = new
        self.best = out
        self._note()

    def moves(self, start: int) -> list[tuple[int, int, int, str]]:
        """What ``piece`` takes, of the rows so far."""
        return [(start, top, self.best[top][0], self._audit(top, self.best[top])) for top in self.best]

    def _audit(self, top: int, end: tuple) -> str:
        parts, top = [end[2]], end[3]
        for note in reversed(self.notes):
            part, top = note[top]
            parts.append(part)
        return "".join(reversed(parts))

    def result(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        ended = {top: x for top, x in self._inserted().items() if ENDS[top]}
        top = min(ended, key=lambda t: ended[t][:3])
        return ended[top][0], self._audit(top, ended[top])


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by a checksum of their place.

    A null role or text counts as one space, and so does a null in the checksum.
    Of 20 remainders, 0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 doubles
    it, 4 makes it a user's. Equal rows are one row here, with their number.
    """

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    return (
        rows.where(kind != 0)
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
            text.alias("text"),
            F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``blank``, ``again`` (role and text of an earlier turn), ``cut`` (truncated) and ``said``.

    ``rows`` must be distinct but for ``copies``, and stored, since they are read twice.
    """
    solid = F.rtrim("text", F.lit(_BLANKS))
    key = ("conv_id", "role", "digest")
    keyed = rows.withColumn("digest", F.sha2("text", 256))
    # Only what was said in several turns takes part in the join.
    first = (
        keyed.groupBy(*key)
        .agg(F.min("turn").alias("low"), F.max(F.col("turn").isNull()).alias("unplaced"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "low", "unplaced")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    # Null turns come first.
    later = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("low")))
    return keyed.join(first, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        (solid == "").alias("blank"),
        F.coalesce(later, F.lit(False)).alias("again"),
        (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.concat("role", F.lit(":"), "text").alias("said"),
    )


_MOVE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_PIECE = "conv_id long, piece int, stats array<long>, first string, last string, moves array<struct<start int, end int, cost long, audit string>>"


class _Piece:
    """A conversation's rows in one task: its parses, and what is counted of it."""

    def __init__(self, conv_id, starts):
        self.conv_id = conv_id
        self.parses = {start: Parse(start) for start in starts}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, copies: int, blank: bool, again: bool, cut: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.first is None:
            self.first = initial
        else:
            self.illegal += (self.last + initial) not in ("su", "ua", "au")
        self.last = initial
        self.illegal += copies - 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not again)
            self.truncated += cut and not again
        for copy in range(copies):
            drop = blank or again or copy > 0
            for parse in self.parses.values():
                parse.row(initial, drop, cut and not drop)

    def row(self, number: int) -> tuple:
        stats = [self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high]
        moves = [m for start, parse in self.parses.items() for m in parse.moves(start)]
        return self.conv_id, number, stats, self.first, self.last, moves


def pieces(rows: DataFrame) -> DataFrame:
    """Rows of ``faults`` parsed where they lie: one row per conversation and task."""

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        moves = [[dict(zip(("start", "end", "cost", "audit"), m)) for m in each] for each in columns[5]]
        arrays = [
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int32()),
            pa.array(columns[2], pa.list_(pa.int64())),
            pa.array(columns[3], pa.string()),
            pa.array(columns[4], pa.string()),
            pa.array(moves, pa.list_(_MOVE)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "piece", "stats", "first", "last", "moves"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_piece, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if open_piece is None or open_piece.conv_id != conv_id:
                    # Only the first conversation of a task can have begun in another task.
                    starts = TOPS if open_piece is None else (0,)
                    if open_piece is not None:
                        done.append(open_piece.row(number))
                    open_piece = _Piece(conv_id, starts)
                open_piece.add(*row)
            if len(done) >= 4096:
                yield batch_of(done)
                done = []
        if open_piece is not None:
            yield batch_of([*done, open_piece.row(number)])

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    # A prefix bounds what the ranges are sampled from; the order within a range is by all of it.
    dealt = rows.repartitionByRange(*order, F.left("said", F.lit(64)).asc())
    narrow = dealt.sortWithinPartitions(*order, "said", "role").select(
        "conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "copies", "blank", "again", "cut"
    )
    return narrow.mapInArrow(run, _PIECE)


class _Repair:
    """One conversation of the last pass: its pieces chained, then its rows walked."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.parse = Parse()
        self.counts = [0, 0, 0, 0]
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.cost = self.audit = None
        self.at = self.out = self.led = 0
        self.digest = hashlib.sha256()

    def chain(self, stats: list, first: str, last: str, moves: list[dict]) -> None:
        self.counts = [a + b for a, b in zip(self.counts, stats)]
        if self.last is not None:
            self.counts[3] += (self.last + first) not in ("su", "ua", "au")
        self.last = last
        turns, low, high = stats[4:]
        if turns:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        self.parse.piece([(m["start"], m["end"], m["cost"], m["audit"]) for m in moves])

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.parse.result()

    def _line(self, role: str | None, text: str) -> None:
        if role is None:
            role = ROLES["ua"[(self.out - self.led) % 2]]
        self.digest.update(f"{chr(10) if self.out else ''}{role}:{text}".encode())
        self.out += 1

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(None, "")
            self.at += 1

    def walk(self, role: str, text: str, copies: int) -> None:
        self.settle()
        for _ in range(copies):
            self._inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                if not self.out:
                    self.led = int(role[:1] == "s")
                self._line(role, text)
            elif edit == "R":
                self._line(None, text)

    def row(self) -> tuple:
        self.settle()
        self._inserts()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.counts, self.cost, self.audit, self.digest.hexdigest()


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = [field.split()[0] for field in _REPORT.split(", ")]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    current, done = None, []
    for batch in batches:
        for conv_id, kind, stats, first, last, moves, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                if current is not None:
                    done.append(current.row())
                current = _Repair(conv_id)
            elif kind == 1:
                current.chain(stats, first, last, moves)
            else:
                current.walk(role, text, copies)
        if len(done) >= 4096:
            yield batch_of(done)
            done = []
    if current is not None:
        yield batch_of([*done, current.row()])


def repair_report(rows: DataFrame) -> DataFrame:
    """Damages conversations and repairs them: one row per ``conv_id`` of ``rows``, null included.

    Returns gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256. Rows
    of a conversation are taken by turn, nulls first, equal turns by ``role:text``. Null
    roles and texts count as one space; repeated rows stay and are duplicates. A conversation
    all of whose rows are dropped has zeros, an empty audit and the digest of nothing; an
    empty table gives no rows. Other columns are not read.

    A conversation of any length is parsed in parallel. Its digest is one over all its text,
    so it is made by one task, which streams sorted rows and holds the audit (a letter a row)
    but never the conversation's text.
    """
    return repaired(damaged(rows), rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct())


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``repair_report`` for distinct rows with ``copies``, and all conversations to report."""
    checked = stored(faults(stored(rows, "turns")), "faults")
    parsed = pieces(checked)

    def piece_columns(*values: Column) -> list[Column]:
        names = ("kind", "piece", "stats", "first", "last", "moves", "turn", "role", "text", "copies", "said")
        types = ("int", "int", "array<long>", "string", "string", "array<struct<start int, end int, cost long, audit string>>")
        types += ("long", "string", "string", "long", "string")
        return [v.cast(t).alias(n) for v, n, t in zip(values, names, types)]

    none = F.lit(None)
    heads = conversations.select("conv_id", *piece_columns(F.lit(0), *[none] * 10))
    told = [F.col(c) for c in ("piece", "stats", "first", "last", "moves")]
    chained = parsed.select("conv_id", *piece_columns(F.lit(1), *told, *[none] * 5))
    turns = [F.col(c) for c in ("turn", "role", "text", "copies", "said")]
    walked = checked.select("conv_id", *piece_columns(F.lit(2), *[none] * 5, *turns))
    return (
        heads.unionByName(chained)
        .unionByName(walked)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "piece", F.col("turn").asc_nulls_first(), "said", "role")
        .select("conv_id", "kind", "stats", "first", "last", "moves", "role", "text", "copies")
        .mapInArrow(_walk, _REPORT)
    )
