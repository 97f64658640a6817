"""Repair of conversation structure by depth-first branch and bound.

Rows of a conversation are kept, given another role, deleted, or joined by new ones, until their role initials read ``(s?(ua)+)?``. The
cheapest edits are searched with an explicit stack: a node is (rows consumed, last role), a prefix (cost, audit) is dropped if its node has
a better one, or if its cost and a lower bound of the rest can not improve on the best complete one.

Rows are ranged by conversation and turn, and searched in blocks of ``BLOCK`` rows, so a very long conversation is spread over many tasks:
a block's part of it is searched from every role before to every role after, and these small tables are put together. Only what the result
itself holds as one value, the audit and the digest of the repaired rows, passes through one task per conversation, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.arrays import written

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: States: nothing said yet, or who spoke last.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LETTER = {USER: "u", ASSISTANT: "a"}
#: States that a whole conversation may end in.
ENDS = frozenset({START, ASSISTANT})

_NEVER = float("inf")
_BLOCK_BITS = 9
BLOCK = 1 << _BLOCK_BITS

CLEAN, BLANK, DUPLICATE, CUT = range(4)
_SPACE = r"\x20\x09-\x0D"


class Row(NamedTuple):
    """What the search sees of a row."""

    initial: str
    fault: int


class Bounds:
    """Lower bounds of what the rows from any place on cost in any state.

    Every row is charged what it costs at least by itself: its deletion, its truncation, a role that nothing allows. Between two of the rows
    that might stay as they are ("fixed" ones), rows of no allowed role can take turns only if their number has the right parity; else an
    insertion or a deletion more is due there, unless one of the two fixed rows is changed, which serves the places on both its sides.
    The cheapest choice between these, over all places from the end on, is the bound.
    """

    def __init__(self, rows: list[Row], ends: frozenset[int]):
        self.ends = ends
        self.spoken = bool(ends & {USER, ASSISTANT})
        n = len(rows)
        self.fixed = [r.initial for r in rows if r.fault in (CLEAN, CUT) and r.initial in ("u", "a")]
        m = len(self.fixed)
        self.alone, self.system, self.next = [0] * (n + 1), [False] * (n + 1), [m] * (n + 1)
        #: Rows of no allowed role before the next fixed one, and whether one of them is truncated.
        self.loose, self.cut = [0] * (n + 1), [False] * (n + 1)
        #: Least cost of the places after a fixed row that stays, from the end on.
        self.after = [0] * (m + 2)
        k = m
        for i in range(n - 1, -1, -1):
            initial, fault = rows[i]
            cut = fault == CUT
            self.alone[i], self.system[i] = self.alone[i + 1], self.system[i + 1]
            self.loose[i], self.cut[i] = self.loose[i + 1], self.cut[i + 1]
            if fault in (BLANK, DUPLICATE):
                self.alone[i] += DELETE
            elif initial in ("u", "a"):
                k -= 1
                self.after[k] = self._least(USER if initial == "u" else ASSISTANT, i + 1, k + 1)
                self.alone[i] += cut
                self.loose[i], self.cut[i] = 0, False
            else:
                self.alone[i] += REROLE + cut
                self.system[i] |= initial == "s"
                self.loose[i] += 1
                self.cut[i] |= cut
            self.next[i] = k

    def _least(self, state: int, i: int, k: int) -> int:
        """Least cost of the place before fixed row ``k`` and of those after it, from a state at row ``i``."""
        loose = self.loose[i]
        odd = loose % 2 == 1
        turn = _NEXT[state]
        if k == len(self.fixed):
            last = state if not loose else turn if odd else _NEXT[turn]
            clash = last not in self.ends
        else:
            clash = (_LETTER[turn] == self.fixed[k]) == odd
        due = 0 if not clash else INSERT if not loose else 0 if self.cut[i] else DELETE - REROLE
        return min(due + self.after[k], REROLE + self.after[k + 1])

    def __call__(self, i: int, state: int) -> int | float:
        if not self.spoken and (state in (USER, ASSISTANT) or (state == SYSTEM and SYSTEM not in self.ends)):
            return _NEVER
        k = self.next[i]
        least = self._least(state, i, k)
        if state == START and self.system[i]:
            # One system row may stay.
            least = min(least, self.after[k] - REROLE)
        return self.alone[i] + least


def repair(rows: list[Row], start: int = START, ends: frozenset[int] = ENDS) -> tuple[int, str, int] | None:
    """The cheapest edits from a state to one of ``ends``: (cost, audit, end). Of equal costs, the audit that is least as text.

    None if there are none, as from a spoken state to silence.
    """
    n = len(rows)
    bound = Bounds(rows, ends)
    best: tuple[int, str] | None = None
    end = START
    reached: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if reached[i, state] < (cost, audit) or _hopeless(cost + bound(i, state), audit, best):
            continue
        if i == n and state in ends:
            # Not hopeless, so better than the best one so far.
            best, end = (cost, audit), state
            continue
        found = [(i, _NEXT[state], cost + INSERT, audit + "I")]
        if i < n:
            initial, fault = rows[i]
            found.append((i + 1, state, cost + DELETE, audit + "D"))
            if fault in (CLEAN, CUT):
                extra = TRUNCATED if fault == CUT else 0
                found.append((i + 1, _NEXT[state], cost + REROLE + extra, audit + "R"))
                if state in _KEPT.get(initial, {}):
                    found.append((i + 1, _KEPT[initial][state], cost + extra, audit + "K"))
        ranked = []
        for j, after, c, a in found:
            least = c + bound(j, after)
            if least == _NEVER or _hopeless(least, a, best) or reached.get((j, after), (c + 1, "")) <= (c, a):
                continue
            reached[j, after] = (c, a)
            ranked.append((least, a, j, after, c))
        # The most promising prefix is taken first.
        stack += [(j, after, c, a) for _, a, j, after, c in sorted(ranked, reverse=True)]
    return None if best is None else (*best, end)


def _hopeless(least: float, audit: str, best: tuple[int, str] | None) -> bool:
    """No completion can be cheaper than the best, or as cheap and less as text."""
    return best is not None and (least > best[0] or (least == best[0] and (audit > best[1][: len(audit)] or audit == best[1])))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by the CRC of ``conv_id:turn`` modulo 20; missing values count as one space.

    0 drops a row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes its role ``user``.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    copies = F.when(kind == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    kept = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(known("role")).alias("role"), text.alias("text"), kind.alias("kind"), copies.alias("copies"))
    return kept.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn (missing ones first; ties by role and text), written once with a place that rises in this order."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), known("role"), known("text"))
    # The last key spreads equal rows; they are interchangeable.
    order = ["conv_id", "turn", "role", "text", "_row"]
    ranged = plain.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place")), "turns")


def _fault(text: Column) -> Column:
    """What a text shows by itself: blank, truncated or clean."""
    end = F.regexp_extract(text, rf"([^{_SPACE}])[{_SPACE}]*\z", 1)
    return F.when(end == "", F.lit(BLANK)).when(end.isin(".", "!", "?"), F.lit(CLEAN)).otherwise(F.lit(CUT))


def _in_blocks(stored: DataFrame) -> DataFrame:
    """Narrow rows by block and place; before each row that is the first of its role and text in its conversation comes a mark."""
    like = F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256)
    rows = stored.select("place", F.lit(1).alias("kind"), "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), _fault(F.col("text")).alias("fault"))
    firsts = stored.select("conv_id", "place", like.alias("like")).groupBy("conv_id", "like").agg(F.min("place").alias("place"))
    both = rows.unionByName(firsts.select("place", F.lit(0).alias("kind")), allowMissingColumns=True)
    return both.repartition(F.shiftright("place", _BLOCK_BITS)).sortWithinPartitions("place", "kind")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` characters."""
    held, weight = [], 0
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    for row in rows:
        held.append(row)
        weight += 100 + sum(len(v) for v in row if isinstance(v, str))
        if weight >= size:
            yield pack()
            held, weight = [], 0
    if held:
        yield pack()


_WAY = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in _COUNTS]
    + [("ways", pa.list_(_WAY))]
)
_PIECE_DDL = "conv_id long, place long, low long, high long, turns long, first string, last string, blank long, duplicate long, truncated long, illegal long, ways array<struct<start: int, end: int, cost: long, audit: string>>"


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _piece(run: list[tuple], continued: bool, open_end: bool) -> tuple:
    """One conversation's rows in one block: counts, and the cheapest edits between all states that its ends may have."""
    rows = [Row(initial, fault) for _, _, _, initial, fault in run]
    turns = [t for _, _, t, _, _ in run if t is not None]
    ways = []
    for start in range(4) if continued else [START]:
        for ends in [frozenset({e}) for e in range(4)] if open_end else [ENDS]:
            if way := repair(rows, start, ends):
                ways.append({"start": start, "end": way[2], "cost": way[0], "audit": way[1]})
    illegal = sum(not legal(a.initial, b.initial) for a, b in zip(rows, rows[1:]))
    counts = [sum(r.fault == f for r in rows) for f in (BLANK, DUPLICATE, CUT)]
    return (
        run[0][1], run[0][0], min(turns, default=None), max(turns, default=None), len(set(turns)),
        rows[0].initial, rows[-1].initial, *counts, illegal, ways,
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple]:
        run: list[tuple] = []
        marked = None
        for place, kind, conv_id, turn, initial, fault in _rows(batches):
            if kind == 0:
                marked = place
                continue
            block = place >> _BLOCK_BITS
            if run and (run[-1][0] >> _BLOCK_BITS != block or run[-1][1] != conv_id):
                yield _piece(run, run[0][0] % BLOCK == 0, run[-1][0] >> _BLOCK_BITS != block)
                run = []
            run.append((place, conv_id, turn, initial, DUPLICATE if marked != place and fault != BLANK else fault))
        if run:
            yield _piece(run, run[0][0] % BLOCK == 0, True)

    yield from _batches(pieces(), _PIECE)


_TOTALS = ["gaps", *_COUNTS, "cost"]
_PLAN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()), ("start", pa.int32()), ("audit", pa.string())] + [(c, pa.int64()) for c in _TOTALS])
_PLAN_DDL = "conv_id long, place long, kind int, start int, audit string, " + ", ".join(f"{c} long" for c in _TOTALS)
_KNOWN, _TOTAL, _EDITS, _TURN = range(4)


class _Joined:
    """The pieces of one conversation put together: per state after them, the cheapest way there."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}
        self.taken: list[tuple[int, dict[int, tuple[int, str]]]] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, place, low, high, turns, first, last, *rest) -> None:
        *counts, ways = rest
        for name, n in zip(_COUNTS, counts):
            self.counts[name] += n
        self.counts["illegal"] += self.last is not None and not legal(self.last, first)
        self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        after: dict[int, tuple[int, str]] = {}
        taken: dict[int, tuple[int, str]] = {}
        for way in ways:
            if way["start"] in self.best:
                cost, audit = self.best[way["start"]]
                found = (cost + way["cost"], audit + way["audit"])
                if way["end"] not in after or found < after[way["end"]]:
                    after[way["end"]], taken[way["end"]] = found, (way["start"], way["audit"])
        self.best = after
        self.taken.append((place, taken))

    def plan(self) -> Iterator[tuple]:
        (cost, audit), state = min((self.best[e], e) for e in ENDS if e in self.best)
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        yield (self.conv_id, -1, _TOTAL, None, audit, gaps, *self.counts.values(), cost)
        for place, taken in reversed(self.taken):
            state, part = taken[state]
            yield (self.conv_id, place, _EDITS, state, part, *[None] * len(_TOTALS))


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def plans() -> Iterator[tuple]:
        now = None
        for conv_id, *piece in _rows(batches):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield from now.plan()
                now = _Joined(conv_id)
            now.add(*piece)
        if now is not None:
            yield from now.plan()

    yield from _batches(plans(), _PLAN)


class _Editor:
    """Applies the audits to the rows of conversations that come one after another."""

    def __init__(self, say: Callable[[str, str | None, str], None]):
        self.say = say
        self.state, self.audit, self.at = START, "", 0

    def edits(self, state: int, audit: str) -> None:
        self.state, self.audit, self.at = state, audit, 0

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = _NEXT[self.state]
            self.say("I", _ROLE[self.state], "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = _NEXT[self.state]
            role = _ROLE[self.state]
        elif edit == "K":
            self.state = _KEPT[role[:1]][self.state]
        if edit != "D":
            self.say(edit, role, text)
        self.inserts()


def _planned(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Per conversation in order: that it is known, its totals, and before the rows of each block their edits."""
    stored = ordered(rows)
    pieces = _in_blocks(stored).mapInArrow(_pieces, _PIECE_DDL)
    plans = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_plans, _PLAN_DDL)
    known = (stored if ids is None else ids).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    parts = [
        known.withColumns({"place": F.lit(-1).cast("long"), "kind": F.lit(_KNOWN)}),
        stored.select("conv_id", "place", F.lit(_TURN).alias("kind"), "role", "text"),
    ]
    for part in parts:
        plans = plans.unionByName(part, allowMissingColumns=True)
    columns = ["conv_id", "place", "kind", "start", "audit", *_TOTALS, "role", "text"]
    return plans.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")


_ROW = pa.schema([("conv_id", pa.int64()), ("number", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_SUMMARY = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in _TOTALS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> Iterator[tuple]:
        said: list[tuple] = []
        editor = _Editor(lambda edit, role, text: said.append((edit, role, text)))
        number = 0
        for conv_id, _, kind, start, audit, *rest in _rows(batches):
            if kind == _KNOWN:
                number = 0
            elif kind == _EDITS:
                editor.edits(start, audit)
            elif kind == _TURN:
                editor.turn(*rest[-2:])
                for edit, role, text in said:
                    number += 1
                    yield conv_id, number, edit, role, text
                said.clear()

    yield from _batches(out(), _ROW)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> Iterator[tuple]:
        digest = hashlib.sha256()
        separator = b""

        def say(_: str, role: str | None, text: str) -> None:
            nonlocal separator
            digest.update(separator + f"{role}:{text}".encode())
            separator = b"\n"

        editor = _Editor(say)
        open_row: tuple | None = None
        for conv_id, _, kind, start, audit, *rest in _rows(batches):
            if kind == _KNOWN:
                if open_row is not None:
                    yield (*open_row, digest.hexdigest())
                open_row, digest, separator = (conv_id, *[0] * len(_TOTALS), ""), hashlib.sha256(), b""
            elif kind == _TOTAL:
                open_row = (conv_id, *rest[: len(_TOTALS)], audit)
            elif kind == _EDITS:
                editor.edits(start, audit)
            else:
                editor.turn(*rest[-2:])
        if open_row is not None:
            yield (*open_row, digest.hexdigest())

    yield from _batches(out(), _SUMMARY)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: rows (conv_id, number, edit, role, text), numbered from 1 in each conversation.

    ``edit`` is K (kept), R (role changed) or I (inserted, with an empty text); see :func:`audited` for odd input.
    """
    return _planned(rows, None).mapInArrow(_repaired_rows, "conv_id long, number long, edit string, role string, text string")


def audited(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one per conversation.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. It should be a table or computed row by row from one. A
    missing conv_id is a conversation of its own, a missing turn comes first, a missing role or text is one space. Rows of one turn go by
    role and text, and a repeated row is a duplicate. With ``ids`` (column conv_id) there is one row for each of these conversations, also for
    those without rows: zeros, an empty audit and the digest of nothing; every conv_id of ``rows`` must be among them. An empty table
    gives no rows. ``gaps`` stops at the greatest 64-bit number.
    """
    ddl = "conv_id long, " + ", ".join(f"{c} long" for c in _TOTALS) + ", audit string, repaired_sha256 string"
    return _planned(rows, ids).mapInArrow(_summaries, ddl)
