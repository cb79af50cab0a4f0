"""Documents whose word n-grams overlap, by a join on adaptive multi-match prefixes.

A document is the set of its distinct runs of ``width`` words, each a 64-bit hash. All sets are sorted by one order, rare n-grams
first. Of two sets of sizes n and m that are near enough, with at least o = ceil(t * n) n-grams in common, the first ``l`` common
ones in this order lie within the first n - o + l of the one, and likewise of the other: after the l-th common n-gram
there are still o - l others to come. So prefixes of that length share ``l`` n-grams at least. Every document chooses its own ``l``:
a longer prefix meets more n-grams of others but asks more matches of a candidate before its full set is verified, and the
``l`` of least estimated cost is taken. Two documents are a candidate if their prefixes share the smaller of their two ``l``; their first
common n-gram is within the prefixes for l = 1 of both, so only those are posted.

The prefixes also bound the whole overlap. Of two sets let x be the one whose prefix ends first in the order. A common n-gram in x's prefix
is in the other's prefix too, so there are at most as many common ones as the prefixes share and x has beyond its prefix. A pair whose bound
is too small is no candidate, and its full sets are not fetched.

How often n-grams occur is counted over all documents in a table of ``CELLS`` counters by hash, whose size is fixed; it only
decides the order and the choice of ``l``, and the result is exact whatever it says.

Documents with the same set are one class; only classes are compared. Posting lists with the same members are one. A list isn't
expanded into pairs: its members are compared to one of them, its hub, and those that are then still apart from another member
in blocks, of which only links leave. Links inside a component change nothing and aren't looked for.

Defined cases: null text counts as empty. A document without words has an empty set and is linked to nothing. Repeated rows and copies
share a class; two texts with one doc_id are two classes, both with this id. A row without doc_id represents nothing: its component
is that of its class, null if no row of the class has an id. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alertloom.functions.sizing import BROADCAST_BYTES, broadcast_if_small, estimated_bytes
from alertloom.llm.near_dedup import Linker, same_size, shingles
from alertloom.llm.shared import partitions, salted_join, stored, text_of

CELL_BITS = 20
CELLS = 1 << CELL_BITS
#: The parts in which the counters are added up.
SLICES = 64
#: The most matches that a prefix may ask for.
LEVELS = 8
#: Elements of two full sets that can be compared in the time of one match of a posting.
MERGED = 32
#: Members of a block of a list.
BLOCK = 1024

Share = tuple[int, int]


def set_name(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def least_overlap(n: int, share: Share) -> int:
    """The n-grams that a set of ``n`` has at least in common with any other that is near enough."""
    return -(-n * share[0] // share[1])


def cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def prefix(s: np.ndarray, counts: np.ndarray, usual: int, share: Share) -> tuple[int, int, np.ndarray, int]:
    """The matches ``l`` that a set asks for, the length of its prefix for one match, its prefix for ``l``, and where that ends: a number
    that never falls along the order (equal for n-grams that lie close)."""
    of = counts[cells(s)]
    order = np.lexsort((s, of))
    overlap = least_overlap(len(s), share)
    one = len(s) - overlap + 1
    most = min(LEVELS, overlap)
    met = np.cumsum(np.maximum(of[order[: one + most - 1]] - usual, 0))[one - 1 :]  # by the prefixes for 1, 2, … matches
    asked = np.arange(1, most + 1)
    at = int(np.argmin(met * (1 + len(s) / MERGED / asked)))
    end = order[one + at - 1]
    return at + 1, one, s[order[: one + at]], (min(int(of[end]), (1 << 40) - 1) << 23) | (int(s[end]) >> 41)


def _profile(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Size and name of every row's set, and at the end the task's counters."""
    names = ["doc_id", "n_shingles", "set_id", "slice", "counts"]
    counts = np.zeros(CELLS, np.uint32)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sets = [shingles(t, width) for t in part.column(1).to_pylist()]
            np.add.at(counts, cells(np.concatenate(sets)), np.uint32(1))
            n, ids = len(sets), [set_name(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            kind = part.column(0).type
    if counts.any():
        parts = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.nulls(SLICES, kind), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.binary()),
                                          pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, part in zip(*(c.to_pylist() for c in batch.columns)):
            total.setdefault(at, np.zeros(CELLS // SLICES, np.int64))
            total[at] += np.frombuffer(zlib.decompress(part), np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())], ["slice", "counts"])


def added(profiles: DataFrame) -> np.ndarray:
    """The counters over all documents: ``CELLS`` numbers, whatever the size of the corpus."""
    parts = profiles.filter("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    counts = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for at, part in parts.mapInArrow(_added, "slice int, counts binary").collect():
        counts[at] = np.frombuffer(zlib.decompress(part), np.int64)
    return counts.reshape(-1)


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, share: Share, held) -> Iterator[pa.RecordBatch]:
    counts = np.frombuffer(zlib.decompress(held.value), np.int64)
    usual = int(np.median(counts))  # what other n-grams leave in a cell
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            sets = [s for t in batch.column(0).slice(at, 256).to_pylist() if len(s := shingles(t, width))]
            found = [prefix(s, counts, usual, share) for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(map(set_name, sets), pa.binary()), pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
                pa.array([f[2].view(np.int64) for f in found], pa.list_(pa.int64())), pa.array([f[3] for f in found], pa.int64())],
                ["set_id", "asked", "one", "prefix", "end"])


def _named_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of the rows (id, set_id, text) whose text has the named set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = [(i, s) for i, name, t in zip(*(c.to_pylist() for c in part.columns)) if set_name(s := shingles(t, width)) == name]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].view(np.int64) for r in rows], pa.list_(pa.int64()))],
                                             ["id", "shingles"])


class ClassLinker(Linker):
    """Confirms pairs of classes, whose texts are found by a document of theirs."""

    def __init__(self, docs: DataFrame, width: int, share: Share, classes: DataFrame):
        super().__init__(docs, width, share)
        self.classes = classes
        self.repeats = not classes.filter("times > 1").isEmpty()

    def sets(self, ids: DataFrame) -> DataFrame:
        of = stored(self.classes.join(ids.select("id").distinct(), "id").select("id", "set_id", "doc_id", "times"), "wanted")

        def made(of: DataFrame) -> DataFrame:
            texts = broadcast_if_small(of).join(self.docs.select("doc_id", text_of().alias("text")), "doc_id").select("id", "set_id", "text")
            return texts.mapInArrow(partial(_named_sets, width=self.width), "id long, shingles array<long>")

        sets = made(of.filter("times = 1"))
        return stored(sets.unionByName(made(of.filter("times > 1")).dropDuplicates(["id"])) if self.repeats else sets, "sets")

    def confirm(self, pairs: DataFrame, sets: DataFrame) -> None:
        pairs = stored(pairs, "pairs")
        ids = stored(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "ids")
        if estimated_bytes(ids) <= BROADCAST_BYTES:
            sets = sets.join(F.broadcast(ids), "id", "left_semi")
        both = pairs.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
        both = salted_join(both, sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u", F.col("v"), "inner", counts=pairs.groupBy("u").agg(F.count("*").alias("_n")))
        of, in_ = self.share
        shared = both.select("u", "v", (F.size("a") + F.size("b")).cast("long").alias("total"), F.size(F.array_intersect("a", "b")).cast("long").alias("same"))
        self.add(shared.filter(F.col("same") * in_ >= (F.col("total") - F.col("same")) * of))


def shared_counts(prefixes: list[np.ndarray]) -> np.ndarray:
    """How many n-grams any two of the prefixes share."""
    owner = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    _, token, times = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
    common = times[token] > 1
    owner, (_, token) = owner[common], np.unique(token[common], return_inverse=True)
    out = np.zeros((len(prefixes), len(prefixes)), np.float32)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        a, b = np.searchsorted(token, (low, low + 4096))
        has = np.zeros((len(prefixes), 4096), np.float32)
        has[owner[a:b], token[a:b] - low] = 1
        out += has @ has.T
    return out


def most_overlap(shared: np.ndarray, n: np.ndarray, prefixes: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """The most n-grams that any two sets can have in common, if their prefixes have ``shared``."""
    beyond = n - np.array([len(p) for p in prefixes])
    first, last = end[:, None] < end, end[:, None] > end
    return shared + np.where(first, beyond[:, None], np.where(last, beyond, np.maximum.outer(beyond, beyond)))


def fitting(key: int, whole: bool, side, component, asked, n, end, prefixes, lists, share: Share) -> np.ndarray:
    """Which pairs (i < j) of a block are of different components, of different sides unless the block is ``whole``, of near sizes, share
    enough of their prefixes, and no earlier list."""
    of, in_ = share
    shared = shared_counts(prefixes)
    fit = np.triu(shared >= np.minimum.outer(asked, asked), 1)
    fit &= most_overlap(shared, n, prefixes, end) * (of + in_) >= np.add.outer(n, n) * of
    fit &= (component[:, None] != component) & (np.minimum.outer(n, n) * in_ >= np.maximum.outer(n, n) * of)
    if not whole:
        fit &= side[:, None] != side
    return fit & (shared_counts([x[x < key] for x in lists]) == 0) if fit.any() else fit


def block_links(fit: np.ndarray, ids, component, sets, share: Share) -> list[tuple[int, int]]:
    """Links among the fitting pairs. A link joins two components, between which no further one is sought."""
    of, in_ = share
    to: dict[int, int] = {}
    found = []

    def root(x: int) -> int:
        while x in to:
            x = to[x]
        return x

    for i, j in zip(*np.nonzero(fit)):
        x, y = root(int(component[i])), root(int(component[j]))
        if x != y:
            both = same_size(sets[i], sets[j])
            if both * in_ >= (len(sets[i]) + len(sets[j]) - both) * of:
                to[x] = y
                found.append((int(ids[i]), int(ids[j])))
    return found


def _blocks(batches: Iterator[pa.RecordBatch], share: Share, confirm: bool) -> Iterator[pa.RecordBatch]:
    """Of blocks of sorted rows (key, low, high, side, id, component, asked, n, end, prefix, lists, then shingles) the links, or if not yet to
    ``confirm`` the members that fit to another one."""
    def seen(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, low, high, side, ids, component, asked, n, end = (batch.column(i).to_numpy() for i in range(9))
        arrays = [[batch.column(i)[k].values.to_numpy() for k in range(batch.num_rows)] for i in range(9, batch.num_columns)]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        found, kept = [], np.zeros(len(key), bool)
        for a, b in zip(new, [*new[1:], len(key)]):
            fit = fitting(key[a], low[a] == high[a], side[a:b], component[a:b], asked[a:b], n[a:b], end[a:b], arrays[0][a:b], arrays[1][a:b], share)
            if confirm:
                found += block_links(fit, ids[a:b], component[a:b], [s.view(np.uint64) for s in arrays[2][a:b]], share)
            else:
                kept[a:b] = fit.any(axis=0) | fit.any(axis=1)
        if confirm:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"])
        return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (key, low, high, ids)], ["key", "low", "high", "id"])

    held = None  # the last block so far, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        name = [batch.column(i).to_numpy() for i in range(3)]
        other = np.flatnonzero((name[0] != name[0][-1]) | (name[1] != name[1][-1]) | (name[2] != name[2][-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        held = batch.slice(cut)
        if cut:
            yield seen(batch.slice(0, cut))
    if held is not None:
        yield seen(held)


def ngram_join(docs: DataFrame, width: int = 5, share: Share = (4, 5)) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest id that links lead to. Documents are linked if the
    intersection of their sets has at least ``share`` (numerator, denominator) of their union's size."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", text_of().alias("text"))
    profiles = stored(texts.mapInArrow(partial(_profile, width=width), f"doc_id {kind}, n_shingles long, set_id binary, slice int, counts binary"), "profiles")
    rows = profiles.filter("slice is null").select("doc_id", "n_shingles", "set_id")
    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id", "doc_id").agg(F.count("*").alias("times"), F.first("n_shingles").alias("n"))
    classes = classes.groupBy("set_id").agg(F.min(F.struct("doc_id", "times", "n")).alias("c")).select("set_id", "c.*")
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    counts = spark.sparkContext.broadcast(zlib.compress(added(profiles).tobytes(), 1))
    made = texts.select("text").mapInArrow(partial(_prefixes, width=width, share=share, held=counts), "set_id binary, asked int, one int, prefix array<long>, end long")
    made = made.groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("asked", "one", "prefix", "end")])
    own = stored(classes.join(made, "set_id").select("id", "n", "asked", "one", "prefix", "end"), "prefixes")
    sizes_of = own.select("id", "n")

    # Lists with company; of those with the same members one.
    postings = own.select("id", F.explode(F.slice("prefix", F.lit(1), F.col("one"))).alias("key"))
    lists = postings.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("a"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("b"))
    lists = stored(lists.filter("size > 1").groupBy("size", "a", "b").agg(F.min("key").alias("key")).select("key", "size"), "lists")
    sizes = lists.select("key", F.col("size").alias("_n"))
    members = stored(salted_join(postings, lists, "key", F.col("id"), "inner", counts=sizes), "members")
    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    hubs = members.join(company, "id").groupBy("key").agg(F.max(F.struct("company", -F.col("id"))).alias("h")).select("key", (-F.col("h.col2")).alias("hub"))
    members = stored(salted_join(members, hubs, "key", F.col("id"), "inner", counts=sizes), "members")

    # Members and their hubs, of each member first the likeliest hub, then the others still apart.
    of, in_ = share
    pairs = members.filter("id != hub").select("hub", "id").distinct().join(sizes_of, "id")
    pairs = salted_join(pairs, sizes_of.select(F.col("id").alias("hub"), F.col("n").alias("m")), "hub", F.col("id"), "inner")
    pairs = stored(pairs.filter(F.least("n", "m") * in_ >= F.greatest("n", "m") * of), "near")
    pairs = pairs.join(own.drop("one", "n"), "id")
    pairs = salted_join(pairs, own.select(F.col("id").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in ("asked", "prefix", "end")]), "hub", F.col("id"), "inner")
    pairs = pairs.withColumn("shared", F.explode(F.array(F.size(F.array_intersect("prefix", "hub_prefix"))))).filter("shared >= least(asked, hub_asked)")
    beyond, hub_beyond = F.col("n") - F.size("prefix"), F.col("m") - F.size("hub_prefix")
    most = F.col("shared") + F.when(F.col("end") < F.col("hub_end"), beyond).when(F.col("end") > F.col("hub_end"), hub_beyond).otherwise(F.greatest(beyond, hub_beyond))
    pairs = pairs.filter(most * (of + in_) >= (F.col("n") + F.col("m")) * of)
    pairs = stored(pairs.select("hub", "id", (F.col("shared") / F.least("n", "m")).alias("likely")), "candidates")
    linker = ClassLinker(docs, width, share, classes)
    first = pairs.groupBy("id").agg(F.max(F.struct("likely", "hub")).alias("p")).select(F.col("p.hub").alias("u"), F.col("id").alias("v"))
    sets = linker.sets(pairs.select(F.explode(F.array("hub", "id")).alias("id")))
    linker.confirm(first, sets)
    rest = pairs.select(F.col("hub").alias("u"), F.col("id").alias("v")).join(first, ["u", "v"], "left_anti")
    rest = linker.component(linker.component(rest, "u", "cu"), "v", "cv").filter("cu != cv")
    linker.confirm(rest.select("u", "v"), sets)

    # Members that are still apart from another one of near size than the hub, in blocks. Near sizes lie in one step or in neighbouring ones.
    step = F.floor(F.log("n") / (math.log(in_ / of) * 1.001 if of < in_ else 1e-9))
    others = linker.component(members.filter("id != hub").filter("size > 2"), "id", "component").join(sizes_of, "id")
    others = stored(others.select("key", "id", "component", F.struct("key", step.alias("step")).alias("slot")), "others")
    slots = others.groupBy("slot").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("own"))
    slots = slots.select("a", "b", "own", "slot.*").withColumn("by", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)])))
    slots = slots.groupBy("key", (F.col("step") + F.col("by")).alias("step")).agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.sum(F.when(F.col("by") == 0, F.col("own"))).alias("own"))
    slots = stored(slots.filter("a != b and own > 0").select(F.struct("key", "step").alias("slot"), "own"), "slots")
    apart = slots.join(slots.groupBy(F.col("slot.key").alias("_key")).agg(F.sum("own").alias("members")), F.col("slot.key") == F.col("_key")).select("slot", "members")
    others = salted_join(others, apart, "slot", F.col("id"), "inner", counts=slots.withColumnRenamed("own", "_n"))
    others = stored(others.select("key", "id", "component", "members"), "others")
    of_one = others.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("lists"))  # at most the length of a prefix
    whole = stored(own.select("id", F.col("asked").cast("long").alias("asked"), "n", "end", "prefix").join(of_one, "id"), "whole")
    blocks = F.ceil(F.col("members") / BLOCK)
    others = others.withColumn("side", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    others = others.select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "id", "component")

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        rows = rows.select("key", "low", "high", "side", "id", "component", "asked", "n", "end", "prefix", "lists", *more)
        return rows.repartition(partitions(spark), "key", "low", "high").sortWithinPartitions("key", "low", "high", "id")

    fit = dealt(others.join(whole.hint("merge"), "id")).mapInArrow(partial(_blocks, share=share, confirm=False), "key long, low long, high long, id long")
    fit = stored(fit, "fit")  # only these need their full sets
    fitting_rows = stored(others.join(fit, ["key", "low", "high", "id"]), "fitting")
    sets = linker.sets(fit)
    linker.add(dealt(fitting_rows.join(whole, "id").join(sets, "id"), "shingles").mapInArrow(partial(_blocks, share=share, confirm=True), "u long, v long"))

    linked = stored(classes.join(linker.found, "id", "left").select("set_id", "doc_id", F.coalesce("component", "id").alias("component")), "linked")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    marked = salted_join(rows, linked.join(least, "component").select("set_id", "component_id"), "set_id", F.col("doc_id"))
    return marked.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
