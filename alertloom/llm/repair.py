"""Repair of the structure of conversations by the cheapest edits.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Its rows are kept (0), given the other of the roles user
and assistant (3) or deleted (4); empty turns of user or assistant are put in (3); a truncated row that isn't deleted costs 3 more,
and blank and repeated rows have to go. A dynamic programme over the rows knows for each of the four states (nothing yet, after
system, user, assistant) the least cost and of the cheapest ways the one whose audit, the initials of its edits, comes first in ASCII.

Audits are not kept as strings. An edit is a node that points to the edit before it, so that all states share their prefixes; a
node has the length and a rolling hash of its audit and its 2^k-th ancestors. Two audits of one cost are compared by a search
for their longest common prefix, down the powers of two; hashes that agree are then verified letter by letter
as far as the two audits are not the same nodes, and audits whose hashes collide are compared in full.

Conversations are dealt by conv_id and sorted by Spark; a task reads its rows as a stream and holds one conversation.

Defined cases: null role or text counts as one blank, so such a role fits nowhere and such a text is blank; rows without turn come first,
rows of one turn go by role and text; repeated rows are faults by definition; rows with null conv_id are one conversation.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alertloom.llm.shared import partitions

BLANKS = " \t\n\x0b\f\r"
RELABEL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The states from which a turn of a role may follow.
BEFORE = {"s": (SYSTEM, (NOTHING,)), "u": (USER, (NOTHING, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
LEGAL = {"su", "ua", "au"}
MODULUS, BASE = (1 << 61) - 1, 911_382_323


class Audits:
    """Edit sequences that share their prefixes; 0 is the empty one."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.length, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]

    def add(self, before: int, letter: str) -> int:
        self.letter.append(letter)
        self.length.append(self.length[before] + 1)
        self.hash.append((self.hash[before] * BASE + ord(letter)) % self.modulus)
        ups, k = [before], 0
        while k < len(self.up[ups[k]]) and self.up[ups[k]][k]:
            ups.append(self.up[ups[k]][k])
            k += 1
        self.up.append(ups)
        return len(self.letter) - 1

    def ancestor(self, node: int, steps: int) -> int:
        while steps and node:
            k = min(steps.bit_length(), len(self.up[node])) - 1
            node, steps = self.up[node][k], steps - (1 << k)
        return node

    def string(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are the same, letter by letter down to their first shared node."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether the audit of ``x`` comes before that of ``y``."""
        a = self.ancestor(x, max(0, self.length[x] - self.length[y]))
        b = self.ancestor(y, max(0, self.length[y] - self.length[x]))
        if self.hash[a] == self.hash[b]:
            return self.length[x] < self.length[y] if self.same(a, b) else self.string(x) < self.string(y)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and k < len(self.up[b]):
                above, other = self.up[a][k], self.up[b][k]
                if self.hash[above] != self.hash[other]:
                    a, b = above, other
        if not self.same(self.up[a][0], self.up[b][0]) or self.letter[a] == self.letter[b]:
            return self.string(x) < self.string(y)
        return self.letter[a] < self.letter[b]


def cheapest(rows: list[tuple[str, bool, bool]], modulus: int = MODULUS) -> tuple[int, str]:
    """Cost and audit for rows of (initial of the role, whether it must go, whether it is truncated)."""
    audits = Audits(modulus)
    best: list[tuple[int, int] | None] = [(0, 0), None, None, None]

    def offer(to: list, state: int, came: tuple[int, int] | None, cost: int, letter: str) -> None:
        if came is None:
            return
        cost += came[0]
        if to[state] is None or cost < to[state][0]:
            to[state] = (cost, audits.add(came[1], letter))
        elif cost == to[state][0]:
            node = audits.add(came[1], letter)
            if audits.less(node, to[state][1]):
                to[state] = (cost, node)

    def inserted() -> None:
        for state in (NOTHING, SYSTEM, ASSISTANT):
            offer(best, USER, best[state], INSERT, "I")
        offer(best, ASSISTANT, best[USER], INSERT, "I")

    for initial, must_go, cut_off in rows:
        inserted()
        after: list[tuple[int, int] | None] = [None] * 4
        for state in range(4):
            offer(after, state, best[state], DELETE, "D")
        if not must_go:
            extra = CUT_OFF * cut_off
            state, before = BEFORE.get(initial, (NOTHING, ()))
            for b in before:
                offer(after, state, best[b], extra, "K")
            for name in "ua":
                state, before = BEFORE[name]
                for b in before:
                    offer(after, state, best[b], RELABEL + extra, "R")
        best = after
    inserted()
    offered = [x for x in (best[NOTHING], best[ASSISTANT]) if x is not None]
    cost, node = offered[0]
    if len(offered) > 1 and (offered[1][0] < cost or offered[1][0] == cost and audits.less(offered[1][1], node)):
        cost, node = offered[1]
    return cost, audits.string(node)


def applied(audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The turns that an audit makes of rows of (role, text). Which role it means follows from the turn before."""
    out: list[tuple[str, str]] = []
    left = iter(rows)
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(left)
        if letter in "RI":
            role = ROLES[ASSISTANT if out and out[-1][0][:1] == "u" else USER]
        if letter != "D":
            out.append((role, text))
    return out


SCHEMA = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<role:string,text:string>>")
TURN = pa.struct([("role", pa.string()), ("text", pa.string())])


class Conversation:
    """The rows of a conversation so far."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.seen, self.rows, self.edits = set(), set(), [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, text: str, last: str) -> None:
        if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        blank, repeated = last == "", (role, text) in self.seen
        truncated = not blank and not repeated and last not in ".!?"
        self.seen.add((role, text))
        self.turns.add(turn)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += truncated
        self.rows.append((role, text))
        self.edits.append((role[:1], blank or repeated, truncated))

    def result(self) -> tuple:
        turns = self.turns - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(self.edits)
        turns = [{"role": r, "text": t} for r, t in applied(audit, self.rows)]
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, turns


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.list_(TURN)]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    now, done, held, kind = None, [], 0, None
    for batch in batches:
        kind = batch.schema.field(0).type
        for conv_id, turn, role, text, last in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                    held += len(now.rows)
                now = Conversation(conv_id)
                if held > 4096:  # so that repaired texts go out in parts
                    yield out(done, kind)
                    done, held = [], 0
            now.add(turn, role, text, last)
    if now is not None:
        yield out([*done, now.result()], kind)


def text_or_blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the counts of its faults (gaps, blank, duplicate, truncated, illegal), the cost and the audit of its
    repair, and the repaired turns in order (array of role and text)."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", text_or_blank("role").alias("role"), text_or_blank("text").alias("text"))
    rows = rows.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).alias("last")
    kind = dict(conversations.dtypes)["conv_id"]
    return rows.select("conv_id", "turn", "role", "text", last).mapInArrow(_repair, f"conv_id {kind}, {SCHEMA}")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a damaged copy: by the checksum of conversation and turn, of twenty kinds 0 is lost, 1 loses its text, 2 its ends of
    sentences, 3 is there twice, and 4 gets the role user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text, role = text_or_blank("text"), text_or_blank("role")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"),
                                F.explode(F.array_repeat(F.lit(0), times)))
    return rows.drop("col")
