r"""Conversation structure repair by Four-Russians block tables.

A conversation's rows (``conv_id``, ``turn``, ``role``, ``text``), in order of
turn, are edited at least cost until their role initials read ``(s?(ua)+)?``:

* Keep (K, 0), Rerole to user/assistant (R, 2), Insert an empty user/assistant
  row anywhere (I, 2), Delete (D, 3; the only edit of blank and duplicate rows);
* a truncated row that stays adds 1;
* of cheapest edit sequences the ASCII-least one is taken.

A row is blank without a character of ``[^\x20\x09-\x0D]``, else duplicate if
its role and text stand earlier in the conversation, else truncated if its last
such character is not ``.``, ``!`` or ``?``; its first fault counts.

Method.  What is left to pay from a place of the conversation is a vector over
the four states of the role automaton; less its minimum, only a few such
vectors exist.  ``Tables`` enumerates them, and precomputes for every vector
and every block of ``BLOCK`` symbols (a symbol is a row's role initial with its
fault) the vector one block earlier and the cost added.  A conversation is read
from its end by one lookup a block.  The trace goes forward: each block is
expanded backward into its inner vectors, and at each row the least letter that
stays on a cheapest path is taken, so ties are resolved exactly.

Scale.  Copies of a row collapse in an aggregation before any shuffle.  Rows
without their texts are sorted by conversation over range partitions, so a
conversation of any size is spread over tasks.  One that lies within a task is
solved there.  Of one that crosses tasks, or has more than ``PIECE`` rows in a
task, each piece is summed up as a map (vector after it -> vector before it,
and end state for each start state); a scan over these maps, a few hundred
bytes for up to ``PIECE`` rows, gives each piece its vector and start state.
Only then do texts move, once: rows and their letters are sorted together and
merged as streams, nothing is joined or collected.  A digest over a whole
conversation (``repair_digest``) has to read it in order in one task, as a
stream in constant memory.

Defined cases: null role and text count as one space; a null turn stands first;
null conv_ids are one conversation; rows of one turn stand by role, then by a
digest of the text, copies together.  Role initials other than s, u and a must
be edited away.  Repeated rows are duplicates.  Empty tables give no rows.
Further columns are not read.
"""

from __future__ import annotations

import collections
import hashlib
import io
import itertools
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ._stage import small_batches, stage

BLOCK = 4
#: most rows of one conversation that a task solves as one piece
PIECE = 4096

KEEP, REROLE, INSERT, DELETE, CUT = 0, 2, 2, 3, 1
#: Role initial that each automaton state takes next, and the state it leads to (0 start, 1 after s, 2 after u, 3 after a).
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
FAR = 1 << 20

#: symbols: (initial, truncated), then the row that must go
SYMBOLS = [(i, cut) for i in ("s", "u", "a", "") for cut in (False, True)]
GONE = len(SYMBOLS)


def symbol_of(initial: str, fault: int) -> int:
    """Symbol of a row; fault 1 blank, 2 duplicate, 3 truncated, 0 none."""
    if fault in (1, 2):
        return GONE
    return 2 * ("sua".index(initial) if initial and initial in "sua" else 3) + (fault == 3)


def _coded(letter: str, to: int) -> str:
    """An inserted or changed row's letter, in lower case where the assistant speaks."""
    return letter.lower() if letter in "IR" and to == MOVES[2]["a"] else letter


def _with_inserts(v: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may be inserted first."""
    v = list(v)
    for _ in range(4):
        for q in range(4):
            for role in ROLES:
                if role in MOVES[q]:
                    v[q] = min(v[q], INSERT + v[MOVES[q][role]])
    return tuple(min(x, FAR) for x in v)


class Tables:
    """All normalised cost vectors, their row and block transitions, and the tie-safe steps of the trace."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _with_inserts([0 if q in ACCEPTING else FAR for q in range(4)])
        self.vectors: list[tuple[int, ...]] = []
        index: dict[tuple[int, ...], int] = {}

        def number(v: tuple[int, ...]) -> tuple[int, int]:
            low = min(v)
            v = tuple(x - low if x < FAR else FAR for x in v)
            if v not in index:
                index[v] = len(self.vectors)
                self.vectors.append(v)
            return index[v], low

        self.end = number(end)[0]
        rows: list[list[tuple[int, int]]] = []
        steps: list[list[list[tuple[str, int]]]] = []
        while len(rows) < len(self.vectors):
            after = self.vectors[len(rows)]
            here, trace = [], []
            for symbol in range(GONE + 1):
                edits = [self._edits(q, symbol) for q in range(4)]
                before = _with_inserts([min(cost + after[to] for _, cost, to in e) for e in edits])
                here.append(number(before))
                trace.append([self._least(q, before, after, edits) for q in range(4)])
            rows.append(here)
            steps.append(trace)
        self.row = np.array([[b for b, _ in r] for r in rows], np.int64)
        self.row_cost = np.array([[c for _, c in r] for r in rows], np.int64)
        self.step = steps
        self.step_to = np.array([[[to for _, to in t] for t in r] for r in steps], np.int64)
        # every block of symbols, by composition of rows from its last one back
        n = len(SYMBOLS) + 1
        self.block_to = np.tile(np.arange(len(rows))[:, None], (1, n**block))
        self.block_cost = np.zeros_like(self.block_to)
        digits = np.array(list(itertools.product(range(n), repeat=block)), np.int64)
        for j in range(block - 1, -1, -1):
            self.block_cost += self.row_cost[self.block_to, digits[:, j]]
            self.block_to = self.row[self.block_to, digits[:, j]]
        self.weights = n ** np.arange(block - 1, -1, -1)
        self.last = [self._tail(q) for q in range(4)]

    @staticmethod
    def _edits(q: int, symbol: int) -> list[tuple[str, int, int]]:
        """(letter, cost, state after) of the edits of one row."""
        out = [("D", DELETE, q)]
        if symbol != GONE:
            initial, cut = SYMBOLS[symbol]
            if initial in MOVES[q]:
                out.append(("K", KEEP + CUT * cut, MOVES[q][initial]))
            out += [("R", REROLE + CUT * cut, MOVES[q][role]) for role in ROLES if role in MOVES[q]]
        return out

    @staticmethod
    def _least(q: int, before, after, edits) -> tuple[str, int]:
        """Least letters on a cheapest path from state ``q`` through one row, and the state after it."""
        letters = ""
        while before[q] < FAR:
            choices = [(a, to, True) for a, cost, to in edits[q] if cost + after[to] == before[q]]
            choices += [("I", MOVES[q][role], False) for role in ROLES if role in MOVES[q] and INSERT + before[MOVES[q][role]] == before[q]]
            letter, q, done = min(choices)
            letters += _coded(letter, q)
            if done:
                break
        return letters, q

    def _tail(self, q: int) -> str:
        """Rows inserted after the last one."""
        letters = ""
        while q not in ACCEPTING:
            q = next(to for role, to in MOVES[q].items() if role in ROLES)
            letters += _coded("I", q)
        return letters

    def boundaries(self, symbols: np.ndarray, after: int) -> tuple[list[int], int, int]:
        """Vector at the right end of each block, from the last one back, by lookup; also the vector before all and the cost added."""
        n, b = len(symbols), self.block
        head = n % b
        codes = symbols[head:].reshape(-1, b) @ self.weights
        right, v, cost = [0] * len(codes), after, 0
        for i in range(len(codes) - 1, -1, -1):
            right[i] = v
            cost += int(self.block_cost[v, codes[i]])
            v = int(self.block_to[v, codes[i]])
        right.insert(0, v)
        for s in symbols[:head][::-1]:
            cost += int(self.row_cost[v, s])
            v = int(self.row[v, s])
        return right, v, cost

    def trace(self, symbols: np.ndarray, after: int, start: int) -> tuple[list[str], int]:
        """Letters of each row (inserts before it included) and the state after the last."""
        right, _, _ = self.boundaries(symbols, after)
        out: list[str] = []
        q, begin = start, 0
        listed = symbols.tolist()
        for k, v in enumerate(right):
            stop = len(listed) % self.block + k * self.block
            inner = [v]
            for s in listed[begin + 1 : stop][::-1]:  # the block, expanded backward
                inner.append(int(self.row[inner[-1], s]))
            for s, v_after in zip(listed[begin:stop], inner[::-1]):
                letters, q = self.step[v_after][s][q]
                out.append(letters)
            begin = stop
        return out, q

    def piece_map(self, symbols: np.ndarray) -> bytes:
        """For each vector after the piece: the vector before it and the end state of each start state."""
        v = np.arange(len(self.vectors))
        inner = [v]
        for s in symbols[::-1]:
            v = self.row[v, s]
            inner.append(v)
        state = np.tile(np.arange(4), (len(self.vectors), 1))
        for s, after in zip(symbols, inner[-2::-1]):
            state = self.step_to[after[:, None], s, state]
        return np.column_stack([v, state]).astype(np.int32).tobytes()


@lru_cache
def tables() -> Tables:
    return Tables()


# ------------------------------------------------------------ rows and marks ----
def damage(convs: DataFrame) -> DataFrame:
    """The contract's damaged rows: by crc32 of ``conv_id:turn`` (null: one space) mod 20, 0 drops a row, 1 empties its
    text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 sets the role user; null role and text are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    rows = convs.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.withColumn("again", F.explode(F.expr("CASE WHEN kind = 3 THEN array(0, 1) ELSE array(0) END"))).drop("kind", "again")


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest of role and text, own fault (0, 1 blank, 3 truncated), text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    end = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(end == "", 1).when(end.endswith(".") | end.endswith("!") | end.endswith("?"), 0).otherwise(3)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"), fault.alias("fault"), text.alias("text"))


def _marks(keyed: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: their number and their first fault with duplicates of earlier turns known."""
    marks = stage(keyed.groupBy("conv_id", "turn", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("fault").alias("fault")), "repair-marks")
    # rows whose text stands in several turns only: the rest has nothing to compare
    first = (marks.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
             .filter("turns > 1").drop("turns"))
    later = ~F.struct("turn").eqNullSafe(F.col("first"))
    return marks.join(first, marks["conv_id"].eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv_id", "turn", "role", "digest", "n", F.when((F.col("fault") != 1) & F.col("first").isNotNull() & later, 2).otherwise(F.col("fault")).alias("fault"))


_KEYS = ("conv_id", "turn", "role", "digest")


def _order(*names: str):
    return [F.asc_nulls_first(n) for n in names]


def _letter_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), T.StructField("ord", T.IntegerType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                         T.StructField("digest", T.BinaryType()), T.StructField("piece", T.LongType()), T.StructField("fault", T.IntegerType()), T.StructField("letters", T.StringType())])


def _solve_schema(conv: T.DataType) -> T.StructType:
    """Letters of solved rows, or an open piece: its rows, symbols and map."""
    return T.StructType([*_letter_schema(conv).fields, T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("symbols", T.BinaryType()),
                         T.StructField("map", T.BinaryType()), T.StructField("turns", T.ArrayType(T.LongType())), T.StructField("roles", T.ArrayType(T.StringType())),
                         T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("faults", T.ArrayType(T.IntegerType())), T.StructField("sizes", T.ArrayType(T.IntegerType()))])


def _symbols(pieces: list[tuple]) -> np.ndarray:
    """Symbols of (turn, role, digest, fault of the first row, rows): copies after the first are duplicates."""
    out: list[int] = []
    for _, role, _, fault, n in pieces:
        out.append(symbol_of(role[:1], fault))
        out += [GONE] * (n - 1)
    return np.array(out, np.int64)


def _letters_of(conv, pieces: list[tuple], letters: list[str], piece: int, tail: str | None) -> list[tuple]:
    rows, at = [], 0
    for turn, role, digest, fault, n in pieces:
        rows.append((conv, 1, turn, role, digest, piece, fault, "".join(letters[at : at + n])))
        at += n
    if tail:
        rows.append((conv, 2, None, None, None, piece, None, tail))
    return rows


def _batches(rows, schema: pa.Schema, size: int = 4096):
    buffer: list[tuple] = []

    def made():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in buffer], f.type) for i, f in enumerate(schema)], schema=schema)

    for row in rows:
        buffer.append(row)
        if len(buffer) >= size:
            yield made()
            buffer.clear()
    if buffer:
        yield made()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _solve(marks: DataFrame) -> DataFrame:
    """Letters of every conversation that lies within a range partition; the others' pieces, summed up as maps."""
    conv = marks.schema["conv_id"].dataType
    schema = _solve_schema(conv)
    none = (None,) * 9

    def run(batches):
        t = tables()
        part = TaskContext.get().partitionId()

        def closed(key, pieces):
            symbols = _symbols(pieces)
            letters, q = t.trace(symbols, t.end, 0)
            for row in _letters_of(key, pieces, letters, 0, t.last[q]):
                yield (*row, *none)

        def opened(key, pieces, number):
            symbols = _symbols(pieces)
            yield (key, 1, None, None, None, None, None, None, part, number, symbols.astype(np.uint8).tobytes(), t.piece_map(symbols), *map(list, zip(*pieces)))

        def rows():
            started, first, key, pieces, size = False, True, None, [], 0
            number, cut = 0, False  # open pieces of this task so far; whether this conversation has one
            for batch in batches:
                for conv_id, turn, role, digest, n, fault in zip(*(c.to_pylist() for c in batch.columns)):
                    if started and conv_id != key:
                        if pieces:  # a task's first conversation may have begun in the task before
                            yield from opened(key, pieces, number) if first or cut else closed(key, pieces)
                            number += first or cut
                        first, cut, pieces, size = False, False, [], 0
                    started, key = True, conv_id
                    while n:
                        some = min(n, PIECE - size)
                        pieces.append((turn, role, digest, fault, some))
                        n, size, fault = n - some, size + some, fault if fault == 1 else 2
                        if size == PIECE:
                            yield from opened(key, pieces, number)
                            pieces, size, number, cut = [], 0, number + 1, True
            if pieces:  # the last one may go on in the next task
                yield from opened(key, pieces, number)

        yield from _batches(rows(), _arrow(schema), 512)

    ordered = marks.repartitionByRange(*_order(*_KEYS)).sortWithinPartitions(*_order(*_KEYS))
    return ordered.select(*_KEYS, "n", "fault").mapInArrow(run, schema)


def _scan(opened: DataFrame) -> DataFrame:
    """(part, run) of each open piece with the vector after it, its start state, and the rows inserted at the conversation's end."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("after", T.IntegerType()),
                           T.StructField("start", T.IntegerType()), T.StructField("tail", T.StringType()), T.StructField("place", T.LongType())])

    def run(batches):
        t = tables()

        def solved(pieces: list[tuple]):
            q = 0
            for i, (part, number, after, ends) in enumerate(reversed(pieces)):
                to = ends[q]
                yield (part, number, after, q, t.last[to] if i + 1 == len(pieces) else None, i)
                q = to

        def rows():
            key, v, pieces = None, t.end, []
            for batch in batches:
                for conv_id, part, number, summed in zip(*(c.to_pylist() for c in batch.columns)):
                    if pieces and conv_id != key:
                        yield from solved(pieces)
                        pieces, v = [], t.end
                    key = conv_id
                    before, *ends = np.frombuffer(summed, np.int32).reshape(-1, 5)[v].tolist()
                    pieces.append((part, number, v, bytes(ends)))
                    v = before
            if pieces:
                yield from solved(pieces)

        yield from _batches(rows(), _arrow(schema))

    maps = opened.select("conv_id", "part", "run", "map").repartition("conv_id")
    return maps.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc("part"), F.desc("run")).mapInArrow(run, schema)


def _expand(opened: DataFrame, scanned: DataFrame) -> DataFrame:
    schema = _letter_schema(opened.schema["conv_id"].dataType)

    def run(batches):
        t = tables()

        def rows():
            for batch in batches:
                for conv_id, symbols, turns, roles, digests, faults, sizes, after, start, tail, place in zip(*(c.to_pylist() for c in batch.columns)):
                    letters, _ = t.trace(np.frombuffer(symbols, np.uint8).astype(np.int64), after, start)
                    yield from _letters_of(conv_id, list(zip(turns, roles, digests, faults, sizes)), letters, place, tail)

        yield from _batches(rows(), _arrow(schema), 512)

    both = opened.join(scanned, ["part", "run"]).select("conv_id", "symbols", "turns", "roles", "digests", "faults", "sizes", "after", "start", "tail", "place")
    return both.mapInArrow(run, schema)


def edit_letters(keyed: DataFrame) -> DataFrame:
    """Letters of each conversation's cheapest edits: one row for the equal rows of a turn, one for rows inserted at the end."""
    solved = stage(_solve(_marks(keyed)), "repair-solved")
    names = [f.name for f in _letter_schema(solved.schema["conv_id"].dataType)]
    opened = solved.filter("map IS NOT NULL")
    return solved.filter("map IS NULL").select(*names).unionByName(_expand(opened, _scan(opened)))


# -------------------------------------------------------------------- repair ----
_ONE_ROW = re.compile("[Ii]*[DKRr]")


def repair(convs: DataFrame, ids: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """Every edit of every conversation, in order: (conv_id, edit, turn, was, fault, role, text).

    ``edit`` is D, I, K or R; ``turn`` and ``was`` are the row's own turn and role
    (null for an inserted row), ``fault`` its first fault (0 none, 1 blank, 2
    duplicate, 3 truncated), ``role`` and ``text`` what stands there afterwards
    (null for a deleted row).  With ``ids`` each conversation of that table,
    whether it has rows or not, begins with a row whose edit is null.

    The partitions of the result hold its rows in order.  By default a long
    conversation may go on in the next partition; with ``whole`` each lies
    within one, for readers that need it as one stream.
    """
    keyed = _keyed(convs)
    conv = keyed.schema["conv_id"].dataType
    fields = _letter_schema(conv).fields
    null = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    no_text = F.lit(None).cast("string").alias("text")
    own = {"conv_id", "turn", "role", "digest"}
    rows = edit_letters(keyed).select(*[f.name for f in fields], no_text).unionByName(
        keyed.select(*own, F.lit(1).alias("ord"), *[null(f) for f in fields if f.name not in own | {"ord"}], "text"))
    if ids is not None:
        rows = rows.unionByName(ids.select("conv_id").distinct().select("conv_id", F.lit(0).alias("ord"), *[null(f) for f in fields[2:]], no_text))
    order = _order("conv_id", "ord", "turn", "role", "digest")
    # the letters of equal rows, in the order of their pieces, stand before the rows
    rows = (rows.repartition("conv_id") if whole else rows.repartitionByRange(*order)).sortWithinPartitions(*order, *_order("text", "piece"))
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()), T.StructField("was", T.StringType()),
                           T.StructField("fault", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def inserts(conv_id, letters):
        for c in letters:
            yield conv_id, "I", None, None, None, ROLES["a" if c == "i" else "u"], ""

    def run(batches):
        key, waiting = None, collections.deque()
        for batch in batches:
            out = []
            for conv_id, ord_, turn, role, digest, fault, letters, text in zip(*(c.to_pylist() for c in batch.columns)):
                if ord_ == 0:
                    out.append((conv_id, None, None, None, None, None, None))
                elif ord_ == 2:
                    out += inserts(conv_id, letters)
                elif letters is not None:
                    if key != (conv_id, turn, role, digest):
                        key, waiting = (conv_id, turn, role, digest), collections.deque()
                    for one in _ONE_ROW.findall(letters):
                        waiting.append((one, fault))
                        fault = fault if fault == 1 else 2
                else:
                    one, fault = waiting.popleft()
                    out += inserts(conv_id, one[:-1])
                    c = one[-1]
                    out.append((conv_id, c.upper(), turn, role, fault, None if c == "D" else role if c == "K" else ROLES["a" if c == "r" else "u"], None if c == "D" else text))
            yield from _batches(out, _arrow(schema))

    small_batches(convs.sparkSession)
    return rows.select("conv_id", "ord", "turn", "role", "digest", "fault", "letters", "text").mapInArrow(run, schema)


def repair_digest(edits: DataFrame) -> DataFrame:
    """One row for each conversation of a ``repair(..., ids, whole=True)``, read as a stream.

    gaps, blank, duplicate, truncated, illegal and cost count over its rows
    before the repair; audit holds the edits, repaired_sha256 the digest of
    the repaired ``role:text`` lines.
    """
    conv = edits.schema["conv_id"].dataType
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([T.StructField("conv_id", conv), *[T.StructField(n, T.LongType()) for n in longs], T.StructField("audit", T.StringType()),
                           T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        key = audit = None
        faults, turns, was, illegal, cost, lines, sha = [0] * 4, [], None, 0, 0, 0, None

        def row():
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            return (key, gaps, *faults[1:], illegal, cost, audit.getvalue(), sha.hexdigest())

        for batch in batches:
            out = []
            for conv_id, edit, turn, old, fault, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if edit is None:
                    if sha is not None:
                        out.append(row())
                    key, audit, sha = conv_id, io.StringIO(), hashlib.sha256()
                    faults, turns, was, illegal, cost, lines = [0] * 4, [], None, 0, 0, 0
                    continue
                audit.write(edit)
                cost += {"K": KEEP, "R": REROLE, "I": INSERT, "D": DELETE}[edit]
                if edit != "I":
                    faults[fault] += 1
                    cost += CUT * (fault == 3 and edit != "D")
                    illegal += was is not None and was + old[:1] not in ("su", "ua", "au")
                    was = old[:1]
                    if turn is not None:  # rows come by turn
                        turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
                if edit != "D":
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            yield from _batches(out, _arrow(schema))
        if sha is not None:
            yield from _batches([row()], _arrow(schema))

    return edits.mapInArrow(run, schema)


def repaired_conversations(convs: DataFrame) -> DataFrame:
    """The registered query: the damaged table repaired, one row for every conversation of ``convs``."""
    return repair_digest(repair(damage(convs), convs, whole=True))
