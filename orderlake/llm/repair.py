"""Conversation structure repair by iterative-deepening A*.

A conversation is in order if its roles' initials read ``(s?(ua)+)?`` and no turn is blank or
repeats an earlier one. Edits, named by their initial: Delete a turn (3), Insert an empty one of
the user or assistant (2), Keep a turn (0), Rerole it to user or assistant (2); a turn that is cut
off and not deleted costs 1 more. Blank and repeated turns have to be deleted.

The search goes depth first in ASCII order of the edits, under cost bounds that rise to the least
estimate beyond the last bound, so the first accepting path is the cheapest and of these the
ASCII-least. The estimate is the exact cost of a simpler problem, in which a system turn may stand
alone; a table of states with the budget they failed under keeps them from being searched again.

Turns are taken by turn number (nulls first), then role, then text; a null role or text is one
space, as is none of the three initials. A null conv_id is a conversation of its own. Repeated rows
are turns that repeat an earlier one. An empty table gives no rows.

Rows are dealt by conversation, sorted, and read as a stream: of a conversation a byte and a digest
per turn stay in memory, and its text up to ``HELD_BYTES``, beyond which it goes to an unnamed
spill file of the task. A conversation is one task's work, as its digest covers it whole in order.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import ready

HELD_BYTES = 16 << 20
SPACE = " \t\n\x0b\x0c\r"
START, OPENED, ASKED, PAIRED = range(4)
AFTER = {(START, "s"): OPENED, (START, "u"): ASKED, (OPENED, "u"): ASKED, (PAIRED, "u"): ASKED, (ASKED, "a"): PAIRED}
LEGAL = {"su", "ua", "au"}
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


@dataclass(frozen=True, slots=True)
class Turn:
    """What the search knows of a turn: its role's initial, whether it must go, whether it is cut off."""

    initial: str
    must_go: bool = False
    cut_off: bool = False


def expected(state: int) -> str:
    """The initial of user or assistant that may follow."""
    return "a" if state == ASKED else "u"


def estimates(turns: list[Turn]) -> list[tuple[int, int, int, int]]:
    """Per place and state a lower bound of the cost still to come.

    Exact but for one thing: OPENED may end as PAIRED may, so both share one value.
    """
    ends = (0, 0, COST["I"], 0)
    found = [ends]
    for turn in reversed(turns):
        later = found[-1]
        own = []
        for state in (START, PAIRED, ASKED):
            best = COST["D"] + later[state]
            if not turn.must_go:
                kept = AFTER.get((state, turn.initial))
                if kept is not None:
                    best = min(best, turn.cut_off + later[kept])
                best = min(best, COST["R"] + turn.cut_off + later[AFTER[state, expected(state)]])
            own.append(best)
        start, paired, asked = own
        ask, pair = min(asked, COST["I"] + paired), min(paired, COST["I"] + asked)
        found.append((min(start, COST["I"] + ask), pair, ask, pair))
    return found[::-1]


def search(turns: list[Turn]) -> tuple[int, list[tuple[str, str]]]:
    """Least cost and the edits in order, each with the initial of the role it leaves ('' for none)."""
    toward = estimates(turns)
    bound = toward[0][START]
    failed: dict[int, int] = {}
    while True:
        path, bound_after = _within(turns, toward, bound, failed)
        if path is not None:
            edits = []
            while path:
                path, edit, role = path
                edits.append((edit, role))
            return bound, edits[::-1]
        bound = bound_after


def _within(turns: list[Turn], toward: list, bound: int, failed: dict[int, int]) -> tuple[tuple | None, int]:
    """The first accepting path of cost ``bound`` or less, else the least estimate beyond."""
    beyond = 1 << 60
    stack = [(0, START, 0, ())]
    while stack:
        at, state, spent, path = stack.pop()
        if at == len(turns) and state in (START, PAIRED):
            return path, bound
        if failed.get(4 * at + state, -1) >= bound - spent:
            continue
        # nothing found below returns here: the first accepting path ends the search
        failed[4 * at + state] = bound - spent
        role = expected(state)
        steps = []
        if at < len(turns):
            turn = turns[at]
            if not turn.must_go:
                steps.append((at + 1, AFTER[state, role], COST["R"] + turn.cut_off, "R", role))
                if (state, turn.initial) in AFTER:
                    steps.append((at + 1, AFTER[state, turn.initial], COST["K"] + turn.cut_off, "K", turn.initial))
        steps.append((at, AFTER[state, role], COST["I"], "I", role))
        if at < len(turns):
            steps.append((at + 1, state, COST["D"], "D", ""))
        for to, after, cost, edit, left in steps:  # the ASCII-least on top of the stack
            estimate = spent + cost + toward[to][after]
            if estimate <= bound:
                stack.append((to, after, spent + cost, (path, edit, left)))
            else:
                beyond = min(beyond, estimate)
    return None, beyond


class Texts:
    """Roles and texts of one conversation in order, beyond ``HELD_BYTES`` in a file of the task."""

    def __init__(self) -> None:
        self.held: list[tuple[str, str]] = []
        self.bytes, self.file = 0, None

    def add(self, role: str, text: str) -> None:
        self.held.append((role, text))
        self.bytes += len(role) + len(text)
        if self.bytes > HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            for pair in self.held:
                for part in pair:
                    raw = part.encode()
                    self.file.write(struct.pack("<Q", len(raw)) + raw)
            self.held, self.bytes = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            self.file.seek(0)

            def part() -> str:
                return self.file.read(struct.unpack("<Q", head)[0]).decode()

            while head := self.file.read(8):
                role = part()
                head = self.file.read(8)
                yield role, part()
            self.file.close()
        yield from self.held


@dataclass
class Conversation:
    """One conversation as it streams in."""

    conv_id: int | None
    turns: list[Turn] = field(default_factory=list)
    texts: Texts = field(default_factory=Texts)
    seen: set[bytes] = field(default_factory=set)
    numbers: int = 0
    first: int | None = None
    last: int | None = None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def add(self, number: int | None, role: str, text: str) -> None:
        if number is not None and number != self.last:
            self.first = number if self.first is None else self.first
            self.last, self.numbers = number, self.numbers + 1
        body = text.strip(SPACE)
        digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
        blank, repeated = not body, digest in self.seen
        self.seen.add(digest)
        cut_off = not blank and not repeated and body[-1] not in ".!?"
        turn = _TURNS.get((role[:1], blank or repeated, cut_off)) or Turn(role[:1], blank or repeated, cut_off)
        if self.turns and self.turns[-1].initial + turn.initial not in LEGAL:
            self.illegal += 1
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut_off
        self.turns.append(turn)
        self.texts.add(role, text)

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.numbers

    def repaired(self, edits: list[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of every turn left."""
        given = iter(self.texts)
        for edit, initial in edits:
            role, text = ("", "") if edit == "I" else next(given)
            if edit != "D":
                yield edit, role if edit == "K" else {"u": "user", "a": "assistant"}[initial], text


_TURNS = {(i, g, c): Turn(i, g, c) for i in "sua" for g in (False, True) for c in (False, True)}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    held = None
    for batch in batches:
        for conv_id, number, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held.conv_id != conv_id:
                if held:
                    yield held
                held = Conversation(conv_id)
            if present:
                held.add(number, role, text)
    if held:
        yield held


def _audit(conversation: Conversation) -> list[tuple]:
    cost, edits = search(conversation.turns)
    digest, first = hashlib.sha256(), True
    for _, role, text in conversation.repaired(edits):
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    c = conversation
    letters = "".join(edit for edit, _ in edits)
    return [(c.conv_id, c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost, letters, digest.hexdigest())]


def _turns(conversation: Conversation) -> Iterator[tuple]:
    _, edits = search(conversation.turns)
    for place, (edit, role, text) in enumerate(conversation.repaired(edits)):
        yield conversation.conv_id, place, edit, role, text


def _run(df: DataFrame, present: str | None, make: Callable, schema: str) -> DataFrame:
    spark = df.sparkSession
    ready(spark)
    empty = spark.createDataFrame([], schema)
    arrow = pa.schema([(f.name, pa.string() if f.dataType.simpleString() == "string" else pa.int64()) for f in empty.schema])

    def run(batches):
        made, size = [], 0
        for conversation in _conversations(batches):
            for row in make(conversation):
                made.append(row)
                size += 1 + sum(len(v) for v in row if isinstance(v, str)) // 1000
                if size >= 4000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)
                    made, size = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        (F.col(present) if present else F.lit(True)).alias("present"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.mapInArrow(run, schema)


def audits(df: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: counted faults, cost and edits of the repair, digest of its result.

    ``present`` names a boolean column; rows in which it is not true are no turns, they only
    name their conversation.
    """
    return _run(df, present, _audit, AUDIT)


def repaired(df: DataFrame, present: str | None = None) -> DataFrame:
    """The turns of all conversations after repair: conv_id, place, edit (I, K or R), role, text."""
    return _run(df, present, _turns, "conv_id long, place long, edit string, role string, text string")


def damage(df: DataFrame) -> DataFrame:
    """Rows with faults planted by the checksum of ``conv_id:turn``, and whether they are ``present``."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    case = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = df.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        (case != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(case == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")
