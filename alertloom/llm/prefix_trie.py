"""The trie of all prefixes of conversations.

A conversation is a path of turn digests (128 bits of role and text). Spark sorts the paths over ranges; within a range a path shares
with the one before it a longest common prefix (LCP), an edge between neighbours. The edges are taken in descending depth, and
each one joins the components of its two ends by union-find: what both hold beneath that depth is finished, and a node, branching
there, stands for the joined component. Chains of nodes with one child are kept as one and unfolded at the end.

What is finished inside a range is final unless it lies on the path of the range's first or last conversation, which may go on next door. So
a range is contracted to these two paths and the sums of what hangs from their nodes; contracted ranges are joined
``FAN`` neighbours at a time by the same edges and unions, until one is left. A range is read as a stream, each batch joined to the contraction
of what came before. No task ever holds the members of a group: equal conversations may fill many ranges.

Defined cases: null role or text counts as empty; rows without turn come first, and rows of one turn go by role and text; repeated rows
are repeated turns. Rows with null conv_id belong to no conversation and are left out. An empty table has no node.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.llm.shared import SPACE, partitions, salted_join, stored, text_of

#: Bytes of the digest of a turn.
DIGEST = 16
#: Contracted ranges that are joined at a time.
FAN = 16
NOBODY = hashlib.sha256(b"").hexdigest()


class Node:
    """A node that isn't finished: what its finished branches add up to, and the rows that wait for its smallest member."""

    __slots__ = ("children", "depth", "ended", "ends", "least", "leaves", "members", "named", "saved", "waiting")

    def __init__(self, depth: int):
        self.depth, self.members, self.least, self.leaves, self.saved, self.children = depth, 0, None, 0, 0, 0
        self.ends: list[int] = []  # of this batch, in order
        self.ended = self.named = False  # whether some were written apart; whether rows name this node
        self.waiting: list[list] = []

    def take(self, members: int, least: int | None, leaves: int, saved: int, children: int) -> None:
        self.members += members
        self.least = least if self.least is None else self.least if least is None else min(self.least, least)
        self.leaves, self.saved, self.children = self.leaves + leaves, self.saved + saved, self.children + children

    def join(self, other: Node) -> None:
        """``other`` is the same node, as seen from the right."""
        self.take(other.members, other.least, other.leaves, other.saved, other.children)
        self.ends += other.ends
        self.waiting += other.waiting
        self.ended, self.named = self.ended or other.ended, self.named or other.named

    def hold(self) -> tuple:
        return self.depth, self.members, self.least, self.leaves, self.saved, self.children, self.ended, self.named

    @classmethod
    def of(cls, held: tuple) -> Node:
        node = cls(held[0])
        node.take(*held[1:6])
        node.ended, node.named = held[6:]
        return node


class Item:
    """A path with the unfinished nodes on it, of ascending depth: a conversation, or one side of a contracted range."""

    __slots__ = ("nodes", "path", "words")

    def __init__(self, path: bytes, words: list[int], nodes: list[Node]):
        self.path, self.words, self.nodes = path, words, nodes

    @classmethod
    def conversation(cls, conv_id: int, path: bytes, words: list[int]) -> Item:
        node = Node(len(path) // DIGEST)
        node.take(1, conv_id, 0, 0, 0)
        node.ends = [conv_id]
        return cls(path, words, [node])

    def name(self, node: Node) -> bytes:
        return hashlib.blake2b(self.path[: node.depth * DIGEST], digest_size=16).digest()


def common_depth(a: bytes, b: bytes) -> int:
    """The number of turns that two paths have in common at their beginning."""
    if a == b:
        return len(a) // DIGEST
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * DIGEST] == b[: middle * DIGEST] else (low, middle - 1)
    return low


def sha(ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


class Forest:
    """Neighbouring items joined to a trie. Rows (depth, conv_id, parent_conv_id, parent's name, own name, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 or None) of finished nodes, and parts (name, ids) of the ends of unfinished ones, are left in ``rows`` and ``parts``."""

    def __init__(self):
        self.rows: list[list] = []
        self.parts: list[tuple[bytes, str]] = []

    def finish(self, item: Item, above: int) -> tuple | None:
        """Finish the nodes of ``item`` deeper than ``above``: what they add to the node there, and the row that waits for it."""
        below = None
        while item.nodes and item.nodes[-1].depth > above:
            node = item.nodes.pop()
            if below:
                node.take(*below[0])
                node.waiting.append(below[1])
            if not node.children:
                node.leaves += 1
            for row in node.waiting:
                row[2] = node.least
            top = max(above, item.nodes[-1].depth) if item.nodes else above
            ends = None if node.ended else sha(node.ends)
            name = item.name(node) if node.named or node.ended else None
            children, saved = node.children, node.saved
            for depth in range(node.depth, top, -1):
                if depth:
                    saved += (node.members - 1) * item.words[depth - 1]
                row = [depth, node.least, node.least if depth > top + 1 else None, None, name, node.members, children, node.leaves, saved, ends]
                self.rows.append(row)
                children, ends, name = 1, NOBODY, None
            below = (node.members, node.least, node.leaves, saved, 1), row
        return below

    def join(self, items: list[Item], depths: list[int], whole: bool) -> tuple | None:
        """Join items whose neighbours have ``depths`` turns in common. What may go on outside stays unfinished and is returned as the
        contraction (first item, last item or None if there is one only, their common depth), unless this is the ``whole``."""
        to = list(range(len(items)))
        last_of = list(range(len(items)))
        final = len(items) - 1
        left: list[Node] = []
        right: list[Node] = []

        def root(i: int) -> int:
            while to[i] != i:
                to[i] = to[to[i]]
                i = to[i]
            return i

        for edge in sorted(range(final), key=depths.__getitem__, reverse=True):
            depth, a, b = depths[edge], root(edge), root(edge + 1)  # a component's root is its first item
            for c in (a, b):
                item = items[c]
                if not whole and (c == 0 or last_of[c] == final):
                    side = left if c == 0 else right
                    below = None
                    while item.nodes and item.nodes[-1].depth > depth:
                        side.append(item.nodes.pop())
                else:
                    below = self.finish(item, depth)
                if not item.nodes or item.nodes[-1].depth < depth:
                    item.nodes.append(Node(depth))
                if below:
                    item.nodes[-1].take(*below[0])
                    item.nodes[-1].waiting.append(below[1])
            mine, theirs = items[a].nodes, {n.depth: n for n in items[b].nodes}
            for node in mine:
                if node.depth in theirs:
                    node.join(theirs.pop(node.depth))
            items[a].nodes = sorted([*mine, *theirs.values()], key=lambda n: n.depth)
            to[b], last_of[a] = a, last_of[b]

        first, last = items[0], items[final]
        if whole:
            self.finish(first, -1)
            return None
        for item, nodes in ((first, first.nodes), (first, left), (last, right)):
            for node in nodes:
                name = item.name(node)
                for row in node.waiting:
                    row[3], node.named = name, True
                node.waiting = []
                if node.ends:
                    self.parts.append((name, ",".join(map(str, node.ends))))
                    node.ends, node.ended = [], True
        common = min(depths) if depths else len(first.path) // DIGEST
        one = Item(first.path, first.words, [*first.nodes, *sorted(left, key=lambda n: n.depth)])
        return one, Item(last.path, last.words, sorted(right, key=lambda n: n.depth)) if final else None, common


def sides(contraction: tuple | None) -> tuple[list[Item], list[int]]:
    if contraction is None:
        return [], []
    first, last, common = contraction
    return ([first], []) if last is None else ([first, last], [common])


def joined(forest: Forest, before: tuple | None, items: list[Item], depths: list[int], whole: bool = False) -> tuple | None:
    """The contraction ``before`` joined with the items to the right of it."""
    mine, within = sides(before)
    if mine and items:
        within = [*within, common_depth(mine[-1].path, items[0].path)]
    return forest.join([*mine, *items], [*within, *depths], whole) if mine or items else None


def held(contraction: tuple) -> bytes:
    first, last, common = contraction
    return pickle.dumps(([(x.path, x.words, [n.hold() for n in x.nodes]) for x in (first, last) if x is not None], common))


def released(data: bytes) -> tuple:
    found, common = pickle.loads(data)  # noqa: S301  our own bytes
    items = [Item(path, words, [Node.of(n) for n in nodes]) for path, words, nodes in found]
    return items[0], items[1] if len(items) > 1 else None, common


SCHEMA = ("kind int, number long, depth long, conv_id long, parent_conv_id long, parent binary, name binary, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, ids string, contraction binary")
KINDS = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary()]
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
ROW, PART, CONTRACTION = range(3)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS)], NAMES)


def _written(forest: Forest, number: int) -> Iterator[pa.RecordBatch]:
    """What a forest has finished so far; parts of ends go by ``number``."""
    rows = [(ROW, None, *row, None, None) for row in forest.rows]
    rows += [(PART, number, *[None] * 4, name, *[None] * 5, ids, None) for name, ids in forest.parts]
    forest.rows, forest.parts = [], []
    if rows:
        yield _table(rows)


def _contracted(contraction: tuple, number: int) -> pa.RecordBatch:
    return _table([(CONTRACTION, number, *[None] * 11, held(contraction))])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of a sorted range of (conv_id, path, words)."""
    forest, before, part, count = Forest(), None, TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            ids, paths, words = (c.to_pylist() for c in batch.slice(at, 4096).columns)
            items = [Item.conversation(c, b"".join(p), w) for c, p, w in zip(ids, paths, words)]
            before = joined(forest, before, items, [common_depth(a.path, b.path) for a, b in zip(items, items[1:])])
            yield from _written(forest, part << 32 | count)
            count += 1
    if before is not None:
        yield _contracted(before, part)


def _merge(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Contracted ranges (group, number, contraction), sorted, joined to one for each group."""
    forest, before, group, waits = Forest(), None, None, None
    for batch in batches:
        for of, _, data in zip(*(c.to_pylist() for c in batch.columns)):
            if of != group and before is not None:
                yield _contracted(before, group)
                before = None
            group = of
            if waits is not None:  # in the whole, the last one is joined as such
                before = joined(forest, before, *sides(waits))
            waits = released(data) if whole else None
            if not whole:
                before = joined(forest, before, *sides(released(data)))
            yield from _written(forest, 0)
    if waits is not None:
        joined(forest, before, *sides(waits), whole=True)
        yield from _written(forest, 0)
    elif before is not None:
        yield _contracted(before, group)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the ids of each name, of parts (name, number, ids) in order; ids are hashed as they come."""
    name, digest = None, None
    for batch in batches:
        done = []
        for of, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if of != name:
                if name is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = of, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["name", "sha"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["name", "sha"])


def turn_digest(role: Column, text: Column) -> Column:
    """The first 128 bits of the SHA-256 of a turn; the length keeps role and text apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST)


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and words of every turn; stored, so that texts are read and shuffled once."""
    rows = conversations.filter("conv_id is not null").select("conv_id", "turn", text_of("role").alias("role"), text_of().alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    words = F.regexp_count("text", F.lit(SPACE.replace("[", "[^") + "+")).cast("long")
    return stored(rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.row_number().over(order).alias("pos"),
                              turn_digest(F.col("role"), F.col("text")).alias("digest"), words.alias("words")), "turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The digests of conversations that begin with turns of another one: c with the first h turns of c - c % 20 in place of its own
    first h, h being the checksum of c modulo 4. A conversation without turns has one row, without digest."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    ids = turns.filter("pos = 1").select("conv_id")
    base = F.col("conv_id") - F.col("conv_id") % 20
    heads = turns.filter("pos <= 3 and conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    heads = ids.withColumn("base", base).join(heads, "base").filter(F.col("pos") <= h)
    own = turns.filter(F.col("pos") > h)
    none = ids.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(heads.select("conv_id", "pos", "digest", "words")).unionByName(none)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations of ``turns`` (as ``digests`` gives them; a null digest is no turn): conv_id (its
    smallest member), depth, parent_conv_id (the smallest member of its parent), n_convs (members), n_children, n_leaves, saved_tokens (of
    the subtree: what members beyond the first would repeat, in words) and ends_sha256 (of the ids that end there)."""
    spark = turns.sparkSession
    turn = F.when(F.col("digest").isNotNull(), F.struct("pos", "digest", "words"))
    paths = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    paths = stored(paths.select("conv_id", F.col("t.digest").alias("path"), F.col("t.words").alias("words")), "paths")
    sorted_paths = paths.repartitionByRange(partitions(spark), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    grown = stored(sorted_paths.mapInArrow(_grow, SCHEMA), "trie")
    made, number = [grown], grown.filter(F.col("kind") == CONTRACTION).select("number", "contraction")
    width = partitions(spark)
    while True:
        whole = width <= FAN
        groups = number.select(F.floor(F.col("number") / FAN).alias("of"), "number", "contraction") if not whole else number.select(F.lit(0).cast("long").alias("of"), "number", "contraction")
        width = -(-width // FAN)
        dealt = groups.repartition(max(1, width), "of").sortWithinPartitions("of", "number")
        merged = stored(dealt.mapInArrow(lambda b, whole=whole: _merge(b, whole), SCHEMA), "trie")
        made.append(merged)
        if whole:
            break
        number = merged.filter(F.col("kind") == CONTRACTION).select("number", "contraction")

    rows = made[0]
    for m in made[1:]:
        rows = rows.unionByName(m)
    parts = grown.filter(F.col("kind") == PART).select("name", "number", "ids").repartition(partitions(spark), "name").sortWithinPartitions("name", "number")
    hashes = stored(parts.mapInArrow(_hashed, "name binary, sha string"), "ends")
    rows = rows.filter(F.col("kind") == ROW).drop("kind", "number", "ids", "contraction")
    open_ = F.col("parent").isNotNull() | F.col("ends_sha256").isNull()
    names = rows.filter("name is not null").select(F.col("name").alias("parent"), F.col("conv_id").alias("of_parent"))
    late = salted_join(rows.filter(open_), names, "parent", F.struct("conv_id", "depth")).join(hashes, "name", "left")
    late = late.withColumns({"parent_conv_id": F.coalesce("parent_conv_id", "of_parent"), "ends_sha256": F.coalesce("ends_sha256", "sha")})
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return rows.filter(~open_).select(*columns).unionByName(late.select(*columns))
