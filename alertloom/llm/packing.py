"""Best-fit packing after a dominance reduction.

How many pieces there are of each length is all that a packing depends on, and that table has at most ``capacity`` rows, however
many documents there are. On it the dominance criterion of Martello and Toth fixes small sets of pieces that provably belong to
an optimal packing: a piece that nothing else fits beside, a piece and the partner that fills the sequence, a piece and its
largest partner if whatever else fits beside it would fit in the partner's place, and likewise a piece with two others. What is left is
packed best-fit, longest first. Either way equal sequences are handled together, as one range of sequence numbers, so
the plan is small and its size doesn't depend on the corpus; each piece then finds its place by its rank among the pieces of its
length, which is counted by partition and length, so that a length that holds most pieces is counted by many tasks.

Defined cases: null text counts as empty and is a piece of one token, the end id. Repeated rows are packed each; they and null
ids are told apart by their rank alone. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from alertloom.llm.shared import stored, text_of
from alertloom.llm.tokens import from_file, public_path

VOCABULARY = "byte_bpe_50k.json"
END_ID, CAPACITY = 2, 1024


@dataclass(frozen=True)
class Segment:
    """The ``count`` pieces of ``length`` from rank ``first`` on go to the sequences from ``sequence`` on, ``each`` to a sequence,
    behind each other from ``offset`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class Plan:
    """The segments so far, and the pieces of each length that have no place yet."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left, self.used = dict(counts), dict.fromkeys(counts, 0)
        self.lengths = sorted(k for k, n in counts.items() if n)
        self.capacity, self.segments, self.sequences = capacity, [], 0

    def place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.segments.append(Segment(length, self.used[length], count, sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            self.lengths.remove(length)

    def fix(self, *lengths: int) -> None:
        """As many sequences of these pieces as there are pieces for."""
        n = min(self.left[x] // lengths.count(x) for x in lengths)
        offset = 0
        for x in lengths:
            self.place(x, n, self.sequences, 1, offset)
            offset += x
        self.sequences += n


def reachable(lengths: list[int], most: int) -> int:
    """The largest sum of two or more of ``lengths``, each as often as wanted, up to ``most``; 0 if there is none."""
    sums, mask = 1, (1 << (most + 1)) - 1
    many = 0
    for x in lengths:
        if x > most:
            break
        step = x
        many |= (many << x | (sums & ~1) << x) & mask
        sums |= sums << x & mask
        while step <= most:  # again and again, by doubling
            many |= (many << step | (sums & ~1) << step) & mask
            sums |= sums << step & mask
            step *= 2
    return many.bit_length() - 1 if many else 0


def dominating(plan: Plan, length: int) -> tuple[int, ...] | None:
    """A set with a piece of ``length``, no shorter than any other, which dominates every other set with it."""
    room = plan.capacity - length
    beside = plan.lengths[: bisect_right(plan.lengths, room)]
    if beside and beside[-1] == length and plan.left[length] == 1:
        beside = beside[:-1]
    if not beside:
        return (length,)
    largest, smallest = beside[-1], beside[0]
    if largest == room or 2 * smallest > room:
        return (length, largest)
    if largest + smallest <= room:
        return None  # more fits than the largest partner has room for
    if reachable(beside, room) <= largest:
        return (length, largest)
    # Two others: no third may fit; the longer is the longest that has any company, the shorter the longest that ever keeps it company.
    if 3 * smallest > room:
        second = beside[bisect_right(beside, room - smallest) - 1]
        partner = max((x for x in beside if 2 * x <= room), default=0)
        if partner and largest <= second and second + partner <= room:
            wanted = (length, second, partner)
            if all(plan.left[x] >= wanted.count(x) for x in wanted):
                return wanted
    return None


def reduce(plan: Plan) -> None:
    """Fix dominating sets, longest pieces first, until there is none."""
    again = True
    while again:
        again = False
        for length in reversed(list(plan.lengths)):
            while plan.left[length] and (found := dominating(plan, length)):
                plan.fix(*found)
                again = True


def best_fit(plan: Plan) -> None:
    """The rest, longest first, each into the fullest sequence with room for it; sequences alike are handled as one range."""
    rooms: list[tuple[int, int, int]] = []  # room, first sequence, sequences
    for length in reversed(list(plan.lengths)):
        while n := plan.left[length]:
            at = bisect_left(rooms, (length, -1, 0))
            if at < len(rooms):
                room, first, wide = rooms.pop(at)
            else:
                room, first, wide = plan.capacity, plan.sequences, -(-n // (plan.capacity // length))
                plan.sequences += wide
            each = min(room // length, n)
            full = min(wide, n // each)
            plan.place(length, full * each, first, each, plan.capacity - room)
            if room > each * length:
                insort(rooms, (room - each * length, first, full))
            if full < wide:
                insort(rooms, (room, first + full, wide - full))


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A packing of ``counts[length]`` pieces of each length."""
    plan = Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return plan


PIECES = "piece int, start long, length int, ids_crc32 long, part int"


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    coder = from_file(public_path(vocabulary), False)
    part, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            owner, number, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(coder.encode(rows.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(k)
                    number.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array([part] * len(owner), pa.int32()),
            ], ["doc_id", "piece", "start", "length", "ids_crc32", "part"])


def cut_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all texts, stored; ``part`` is the task that cut them."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {PIECES}"
    rows = docs.select("doc_id", text_of().alias("text"))
    return stored(rows.mapInArrow(partial(_cut, vocabulary=vocabulary, end_id=end_id, capacity=capacity), schema), "pieces")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = cut_pieces(docs, vocabulary, end_id, capacity)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan = spark.createDataFrame(
        [(s.length, s.first, s.count, s.sequence, s.each, s.offset) for s in pack_counts(total, capacity).segments],
        "length int, first long, count long, sequence long, each int, base int")
    bases = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(own) - 1).join(bases, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(plan), "length").filter("rank >= first and rank < first + count")
    at = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("base") + at % F.col("each") * F.col("length")).cast("long").alias("offset"))
