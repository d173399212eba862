"""Conversation structure repair: cheapest edits, decided by whole-number weights.

A conversation should go: perhaps one system turn, then user and assistant by turns. The
edits that make it so form paths through a graph without cycles: rows by roles that may
follow. A path's weight is one big whole number. Its high digits are the cost. The
low ones, of fixed width, hold a letter per edit by position, with zeros behind the last
one, so that of equal costs the smaller number has the letters that come first in ASCII
order. The least number per node is all the search keeps.

Rows arrive in order. Letters that all nodes still in question share are decided: they
leave the numbers, and their rows leave memory. Numbers stay short, and a conversation
of any length takes time in proportion to it, save where undecided edits pile up.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cost of an edit; a truncated row that stays costs KEEP_TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, KEEP_TRUNCATED = 0, 2, 3, 2, 1
#: Digits of the letters, in ASCII order. 0 is no letter.
LETTERS = " DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_BITS = 3
#: Rows after which shared letters are taken out of the numbers.
STEP = 16

#: What the last turn was: nothing yet, the system's, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
FAULTS = ("blank", "duplicate", "truncated")


class Search:
    """The least weight per node after the rows so far, and the letters decided."""

    def __init__(self) -> None:
        self.width = 3 * STEP + 8  # letters that the low digits hold
        self.nodes = {START: (0, 0)}  # weight, letters in it
        self.paid = 0  # cost taken out of the weights
        self.rows = 0

    def _edge(self, into: dict, to: int, node: tuple[int, int], cost: int, letter: int) -> None:
        weight, used = node
        weight += (cost << _BITS * self.width) + (letter << _BITS * (self.width - 1 - used))
        if to not in into or weight < into[to][0]:
            into[to] = (weight, used + 1)

    def _inserted(self) -> None:
        """Up to two inserted turns; more would only go round in a circle."""
        layer = self.nodes
        for _ in range(2):
            further: dict = {}
            for state, node in layer.items():
                self._edge(further, _NEXT[state], node, INSERT, _I)
            for state, node in further.items():
                if state not in self.nodes or node[0] < self.nodes[state][0]:
                    self.nodes[state] = node
            layer = further

    def row(self, initial: str, must_go: bool, truncated: bool) -> str:
        """One more row; the letters decided by it, mostly none."""
        self._inserted()
        extra = KEEP_TRUNCATED if truncated else 0
        after: dict = {}
        for state, node in self.nodes.items():
            self._edge(after, state, node, DELETE, _D)
            if not must_go:
                self._edge(after, _NEXT[state], node, REROLE + extra, _R)
                kept = _KEPT.get(initial, {}).get(state)
                if kept is not None:
                    self._edge(after, kept, node, KEEP + extra, _K)
        self.nodes = after
        self.rows += 1
        return self._decided() if self.rows % STEP == 0 else ""

    def _prune(self) -> None:
        """Drops nodes whose every continuation another one beats in cost."""
        shift = _BITS * self.width
        cost = {state: weight >> shift for state, (weight, _) in self.nodes.items()}
        for state, by, more in ((START, ASSISTANT, DELETE), (START, USER, DELETE + INSERT), (SYSTEM, ASSISTANT, 0), (SYSTEM, USER, INSERT)):
            if by in cost and state in self.nodes and cost[state] > cost[by] + more:
                del self.nodes[state]

    def _decided(self) -> str:
        self._prune()
        shift = _BITS * self.width
        low = (1 << shift) - 1
        first = next(iter(self.nodes.values()))[0] & low
        differ = 0
        for weight, _ in self.nodes.values():
            differ |= (weight & low) ^ first
        shared = min((shift - differ.bit_length()) // _BITS, min(used for _, used in self.nodes.values()))
        letters = "".join(LETTERS[first >> _BITS * (self.width - 1 - k) & 7] for k in range(shared))
        least = min(weight >> shift for weight, _ in self.nodes.values())
        self.paid += least
        longest = max(used for _, used in self.nodes.values()) - shared
        wider = self.width if longest + 3 * STEP + 8 > self.width else 0  # doubles the room
        self.nodes = {
            state: (
                ((((weight >> shift) - least) << shift) + ((weight & low) << _BITS * shared & low)) << _BITS * wider,
                used - shared,
            )
            for state, (weight, used) in self.nodes.items()
        }
        self.width += wider
        return letters

    def finish(self) -> tuple[int, str]:
        """The least cost, and the letters not yet given."""
        self._inserted()
        weight, used = min(self.nodes[state] for state in (START, ASSISTANT) if state in self.nodes)
        letters = "".join(LETTERS[weight >> _BITS * (self.width - 1 - k) & 7] for k in range(used))
        return self.paid + (weight >> _BITS * self.width), letters


class Conversation:
    """One conversation, row by row: its counts, its edits and the repaired turns."""

    def __init__(self) -> None:
        self.search = Search()
        self.waiting: deque[tuple[str, str]] = deque()
        self.counts = dict.fromkeys((*FAULTS, "illegal"), 0)
        self.last = START
        self.before: str | None = None
        self.turns: list[int | None] = [None, None, 0]  # least, largest, distinct

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator[tuple[str, str, str]]:
        """Yields (letter, role, text) of the edits that are decided now; a deleted row as it was."""
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        if turn is not None:
            least, largest, distinct = self.turns
            self.turns = [turn if least is None else least, turn, distinct + (turn != largest)]
        self.waiting.append((role, text))
        yield from self._apply(self.search.row(initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def _apply(self, letters: str) -> Iterator[tuple[str, str, str]]:
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.waiting.popleft()
            if letter in "IR":
                self.last = _NEXT[self.last]
                role = NAMES[self.last]
            elif letter == "K":
                self.last = _KEPT[role[:1]][self.last]
            yield letter, role, text

    def finish(self) -> Iterator[tuple[str, str, str]]:
        self.cost, letters = self.search.finish()
        yield from self._apply(letters)

    @property
    def gaps(self) -> int:
        least, largest, distinct = self.turns
        return 0 if least is None else min(largest - least + 1 - distinct, (1 << 63) - 1)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) after the damage that crc32 of `conv_id:turn`
    modulo 20 asks for: 0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` out of it,
    3 repeats it, 4 makes its role `user`.

    Null roles and texts, and null numbers in the hashed key, are one blank. A dropped row
    stays as one without copy, role and text, so that no conversation gets lost.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    kind = F.col("kind")
    marked = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").when(kind != 0, F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).when(kind != 0, F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    )


def _fault(seen: Column) -> Column:
    """The first fault of a row; `seen`: how many equal rows come before it."""
    # What the text ends in, blanks aside; no regular expression looks at the whole text.
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    return (
        F.when(F.col("copy").isNull(), None)
        .when(end == "", "blank")
        .when(seen > 0, "duplicate")
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    )


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_EDITS = "place bigint, edit string, role string, text string"


def repair(rows: DataFrame, output: str = "edits") -> DataFrame:
    """Repairs conversations with rows (conv_id, turn, role, text, copy: null for a row that
    isn't there). The turns, then the roles and texts, are in ascending order, null first.

    output "edits": one row per edit in order, (conv_id, place, edit, role, text): K keeps a
    row, R gives it another role, D deletes it (role and text as before), I inserts an
    empty turn. What is left without D are the repaired conversations. "report": one row
    per conversation with the faults found, the cost, all edits' letters and the SHA-256 of
    the repaired turns.

    Null conv_ids form one conversation; a conversation without rows gives zeros and no
    letters; an empty table gives an empty one. Roles go by their first character, whatever
    follows; one without s, u or a in front, or empty, can't be kept. Gaps beyond a bigint
    count as the largest. Other columns are ignored.

    One shuffle, by conversation. Tasks read their conversations as sorted streams, and
    hold only the rows whose edits are undecided, beside the letters of the one they are at.
    A hash is computed in order, so one conversation stays in one task, but never in memory.
    """
    dealt = rows.select("conv_id", F.col("turn").cast("bigint"), "role", "text", "copy").repartition("conv_id")
    order = ("turn", "role", "text", "copy")
    # Rows of a conversation are in one place already: this window only sorts.
    equal = Window.partitionBy("conv_id", F.col("copy").isNull(), "role", F.sha2("text", 256)).orderBy(*order)
    marked = dealt.withColumn("fault", _fault(F.row_number().over(equal) - 1)).sortWithinPartitions("conv_id", *order)
    report = output == "report"
    kept = rows.schema["conv_id"]
    names = [field.split()[0] for field in (_REPORT if report else _EDITS).split(", ")]
    types = [pa.int64() if field.endswith("bigint") else pa.string() for field in (_REPORT if report else _EDITS).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, None
        letters: list[str] = []
        digest = hashlib.sha256()
        place = 0
        made: list[list] = [[] for _ in range(len(names) + 1)]

        def take(edits):
            nonlocal place
            for letter, role, text in edits:
                if report:
                    letters.append(letter)
                    if letter != "D":
                        digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                        place += 1
                else:
                    for column, value in zip(made, (at, place, letter, role, text)):
                        column.append(value)
                    place += 1

        def close():
            take(now.finish())
            if report:
                values = (at, now.gaps, *now.counts.values(), now.cost, "".join(letters), digest.hexdigest())
                for column, value in zip(made, values):
                    column.append(value)

        def sent(schema):
            arrays = [pa.array(made[0], schema.field("conv_id").type)]
            arrays += [pa.array(column, kind) for column, kind in zip(made[1:], types)]
            for column in made:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *names])

        schema = None
        for batch in batches:
            schema = batch.schema
            for values in zip(*[column.to_pylist() for column in batch.columns]):
                conv, turn, role, text, copy, fault = values
                if now is None or conv != at:
                    if now is not None:
                        close()
                    at, now, letters, digest, place = conv, Conversation(), [], hashlib.sha256(), 0
                if copy is not None:
                    take(now.row(turn, role, text, fault))
            yield sent(schema)
        if now is not None:
            close()
            yield sent(schema)

    out = _REPORT if report else _EDITS
    fields = [T.StructField("conv_id", kept.dataType)] + T.StructType.fromDDL(out).fields
    return marked.mapInArrow(run, T.StructType(fields))


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations, in order."""
    return repair(rows).filter("edit <> 'D'").drop("edit")
