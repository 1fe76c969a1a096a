"""Repair of conversations whose turns lack, repeat or break off, with the fewest edits.

A repaired conversation is empty or an optional system turn followed by user and assistant
turns in alternation, ending with the assistant. Turns are kept (cost 0), given another role
(2), deleted (3) or inserted empty (2); blank and repeated turns must be deleted, and a
truncated one that stays costs 1 more. Among the cheapest edits the ones whose initials
(D, I, K, R) come first are taken.

Turns are dealt by conversation and sorted by turn; which of them repeat an earlier one is
decided by the same deal, sorted by content. A task then reads them as a stream: the state
of the search is one cost and one rank for each of four positions in the pattern, whatever
the length, and passes from one Arrow batch to the next. Back-pointers take four bytes a
turn. They and the turns themselves spill beyond a bound to an unnamed file in the folder
Spark spills to, which goes with the task, so memory is bounded for a conversation of any
length; only its audit, one letter an edit, is held as the value it is returned as.

Nulls: a null conversation id is a conversation of its own, turns without a number come
first, a null role or text is one space. Turns of one number are taken by role, then text.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from assayline.llm.tables import pick

# What an edit costs, and the white space of the blank test.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
# Whole numbers beside nulls pass as text, as pandas would make them floating-point.
_COUNTED = ", ".join(f"{c} string" for c in _COUNTS)
_REPAIRED = f"conv_id string, position bigint, edit string, role string, text string, {_COUNTED}"
_DIGEST = f"conv_id string, {_COUNTED}, repaired_sha256 string"
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
_MOST = (1 << 63) - 1


@dataclass(frozen=True)
class RepairSettings:
    # Bytes of a conversation's turns, and of its back-pointers, held in memory.
    held: int = 16 << 20
    # Rows and text characters of a batch that is handed on.
    rows: int = 2_000
    characters: int = 4 << 20


# --- the search

# Positions in the pattern: nothing yet, after the system, a user, an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_EMITS = ("u", "u", "a", "u")
_NEVER = 1 << 60
_EDITS = ("D", "K", "R", "IK", "IR")
# Ends: from each position the insertions that complete the pattern.
_ENDS = {_START: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}


def _moves(initial: str, must_go: bool, cut: bool):
    """(from, to, edit, cost) for one turn. More than one insertion before a turn leads to
    a position that fewer reach, so one is enough."""
    moves = [(q, q, "D", DELETE) for q in range(4)]
    if must_go:
        return moves
    extra = TRUNCATED if cut else 0
    for q in range(4):
        for inserted in (0, 1):
            at = _NEXT[q] if inserted else q
            before, cost = "I" * inserted, INSERT * inserted + extra
            if initial == _EMITS[at]:
                moves.append((q, _NEXT[at], before + "K", cost + KEEP))
            moves.append((q, _NEXT[at], before + "R", cost + REROLE))
    if initial == "s":
        moves.append((_START, _SYSTEM, "K", KEEP + extra))
    return moves




class _Search:
    """Cheapest way to every position, extended turn by turn.

    Strings of edits that lead to two positions are never equal and, as each ends with the
    edit of the same turn, never one the beginning of the other. So the order of longer
    strings follows from the order of these and the edits added: a rank is all that is kept.
    """

    _steps: dict[tuple, tuple] = {}

    def __init__(self):
        self.total = 0
        self.costs = (0, _NEVER, _NEVER, _NEVER)
        self.ranks = (0, 1, 2, 3)

    def step(self, kind: tuple) -> bytes:
        """Read one turn; returns for each position where the best way came from and how."""
        known = self._steps.get((kind, self.costs, self.ranks))
        if known is None:
            known = self._steps[kind, self.costs, self.ranks] = self._extend(kind)
        least, self.costs, self.ranks, back = known
        self.total += least
        return back

    def _extend(self, kind: tuple) -> tuple:
        best: list = [None] * 4
        for q, to, edit, cost in _moves(*kind):
            if self.costs[q] >= _NEVER:
                continue
            way = (self.costs[q] + cost, self.ranks[q], edit, q)
            if best[to] is None or way < best[to]:
                best[to] = way
        least = min(way[0] for way in best if way)
        costs = tuple(way[0] - least if way else _NEVER for way in best)
        by_string = sorted(range(4), key=lambda to: best[to][1:3] if best[to] else (9, ""))
        ranks = tuple(by_string.index(to) for to in range(4))
        back = bytes(w[3] * len(_EDITS) + _EDITS.index(w[2]) if w else 255 for w in best)
        return least, costs, ranks, back

    def end(self) -> tuple[int, int]:
        """(cost, position) of the best way that ends there."""
        ways = [
            (self.costs[q] + INSERT * len(more), self.ranks[q], q)
            for q, more in _ENDS.items()
            if self.costs[q] < _NEVER
        ]
        cost, _, position = min(ways)
        return self.total + cost, position


def _spill_folder() -> str | None:
    """Where Spark itself lets Python spill; None is Python's own choice."""
    folders = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")
    return next((f for f in folders if f and os.path.isdir(f)), None)


def _spool(limit: int):
    return tempfile.SpooledTemporaryFile(max_size=limit, dir=_spill_folder())


@dataclass
class _Conversation:
    """One conversation while its turns pass by."""

    id: str | None
    settings: RepairSettings
    search: _Search = field(default_factory=_Search)
    size: int = 0
    low: int | None = None
    high: int | None = None
    numbers: int = 0
    last: str | None = None
    faults: dict = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0

    def __post_init__(self):
        self.turns, self.back = _spool(self.settings.held), _spool(self.settings.held)

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            turn = int(turn)
            if turn != self.high:
                self.numbers += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.size and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        known = initial if initial in ("s", "u", "a") else ""
        self.back.write(self.search.step((known, fault in ("blank", "duplicate"), fault == "truncated")))
        for value in (role, text):
            raw = value.encode("utf-8", "surrogatepass")
            self.turns.write(struct.pack("<q", len(raw)))
            self.turns.write(raw)
        self.size += 1

    def edits(self) -> tuple[int, str]:
        """Cost and initials of the best edits, from the back-pointers read backwards."""
        if not self.size:
            return 0, ""
        cost, at = self.search.end()
        parts = [_ENDS[at]]
        block = 1 << 16
        for first in range((self.size - 1) // block * block, -1, -block):
            self.back.seek(4 * first)
            held = self.back.read(4 * min(block, self.size - first))
            for k in range(len(held) - 4, -4, -4):
                at, edit = divmod(held[k + at], len(_EDITS))
                parts.append(_EDITS[edit])
        return cost, "".join(reversed(parts))

    def rows(self):
        """A first row at position 0 with counts and audit, then the repaired turns."""
        cost, audit = self.edits()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.numbers, _MOST)
        counts = [gaps, *self.faults.values(), self.illegal, cost]
        yield (self.id, 0, None, None, None, *map(str, counts), audit)
        at, position = _START, 0
        self.turns.seek(0)
        for edit in audit:
            role, text = ("", "") if edit == "I" else (self._read(), self._read())
            if edit == "D":
                continue
            if edit == "K":
                at = _SYSTEM if role[:1] == "s" else _NEXT[at]
            else:
                role, at = _ROLES[_EMITS[at]], _NEXT[at]
            position += 1
            yield (self.id, position, edit, role, text, *[None] * len(_COUNTS))

    def _read(self) -> str:
        (length,) = struct.unpack("<q", self.turns.read(8))
        return self.turns.read(length).decode("utf-8", "surrogatepass")

    def close(self) -> None:
        self.turns.close()
        self.back.close()


def _frames(rows, settings: RepairSettings):
    columns = [c.split()[0] for c in _REPAIRED.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4] or "") + len(row[-1] or "")
        if len(held) >= settings.rows or size >= settings.characters:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _repairing(settings: RepairSettings):
    def rows(batches):
        now = None
        for batch in batches:
            for conv_id, turn, role, text, fault, present in zip(
                *[batch[c] for c in ("conv_id", "turn", "role", "text", "fault", "present")]
            ):
                if now is None or conv_id != now.id:
                    if now:
                        yield from now.rows()
                        now.close()
                    now = _Conversation(conv_id, settings)
                if present:
                    now.add(turn, role, text, fault)
        if now:
            yield from now.rows()
            now.close()

    return lambda batches: _frames(rows(batches), settings)


# --- Spark steps


def _prepared(turns: DataFrame) -> DataFrame:
    """Turns dealt by conversation, in order, each with its first fault."""
    ended = F.rtrim("text", F.lit(SPACE))
    seen = Window.partitionBy("conv_id", "role", "text", "present").orderBy(
        F.col("turn").asc_nulls_first()
    )
    fault = (
        F.when(ended == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.substring(ended, -1, 1).isin(".", "!", "?"), "truncated")
    )
    dealt = turns.repartition("conv_id").withColumn("seen", F.row_number().over(seen))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return dealt.sortWithinPartitions(*order).select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("string").alias("turn"),
        "role",
        "text",
        fault.alias("fault"),
        "present",
    )


def repair(
    conversations: DataFrame,
    settings: RepairSettings = RepairSettings(),
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: str | None = None,
) -> DataFrame:
    """The repaired turns, and for every conversation a row at position 0 with its counts.

    Position 0 holds gaps (missing numbers between the lowest and the highest), blank,
    duplicate, truncated (turns by first fault), illegal (neighbours out of turn), cost and
    audit; positions from 1 the edit (K, R, I), role and text of each turn that stays. The
    rows of a conversation lie together and in order. Rows where the column `present` is
    false name a conversation and are no turns; a conversation of such rows only has zeros,
    an empty audit and no turns. An empty table gives no rows. conv_id comes back in its own
    type; other columns are left out.
    """
    kind = conversations.schema[conv_id].dataType
    turns = conversations.select(
        conversations[conv_id].alias("conv_id"),
        conversations[turn].alias("turn"),
        F.coalesce(conversations[role], F.lit(" ")).alias("role"),
        F.coalesce(conversations[text], F.lit(" ")).alias("text"),
        (conversations[present] if present else F.lit(True)).alias("present"),
    )
    made = _prepared(turns).mapInPandas(_repairing(settings), _REPAIRED)
    whole = {c: F.col(c).cast("bigint") for c in _COUNTS[:-1]}
    return made.withColumns(whole | {"conv_id": F.col("conv_id").cast(kind)})


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """conv_id, position, role, text and edit of the turns alone."""
    return repaired.where("position > 0").select("conv_id", "position", "role", "text", "edit")


def _digests(batches):
    """One row a conversation; `role:text` of its turns goes into a running digest."""
    now, digest = None, None
    columns = ["conv_id", *_COUNTS, "repaired_sha256"]
    for batch in batches:
        out = []
        for position, role, text, *named in zip(
            *[batch[c] for c in ("position", "role", "text", "conv_id", *_COUNTS)]
        ):
            if position == 0:
                if now:
                    out.append((*now, digest.hexdigest()))
                now, digest = named, hashlib.sha256()
            else:
                whole = ("\n" if position > 1 else "") + role + ":" + text
                digest.update(whole.encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(out, columns=columns)
    if now:
        yield pd.DataFrame([(*now, digest.hexdigest())], columns=columns)


def audit(repaired: DataFrame) -> DataFrame:
    """conv_id, the counts of position 0 and the digest of the repaired turns.

    Reads the rows of `repair` where they lie, without another shuffle.
    """
    kinds = {c: repaired.schema[c].dataType for c in ("conv_id", *_COUNTS)}
    as_text = {c: F.col(c).cast("string") for c in kinds}
    made = repaired.withColumns(as_text).mapInPandas(_digests, _DIGEST)
    return made.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by crc32 of `conv_id:turn` modulo 20, to test the repair with.

    0 drops the turn (it stays as a row that is not `present`), 1 empties its text, 2 takes
    its full stops, question and exclamation marks, 3 repeats it, 4 makes it the user's.
    Nulls count as one space; columns come back under their own names.
    """
    space = F.lit(" ")
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    text, what = F.coalesce("text", space), F.crc32(name) % 20
    times = F.when(what == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(what == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (what != 0).alias("present"),
        F.explode(times).alias("time"),
    ).drop("time")
