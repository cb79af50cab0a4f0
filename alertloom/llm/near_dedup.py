"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct runs of ``width`` words, each a 64-bit hash. Its sketch has ``REGISTERS`` buckets; a hash falls into
a bucket by its first bits, and a bucket keeps of its least hash only the number of leading zeros and ``MANTISSA`` bits after
the first one, 16 bits in all. An empty bucket takes the register of another, the same way in every document. Bands of registers make
the candidates, the share of equal registers, corrected for chance collisions, gives an estimate, and what is near enough is
confirmed on the full sets.

Documents with the same set are one class, represented by its smallest id; only classes are compared. A bucket of a band is not
expanded into pairs. Its members are compared to one of them, its hub (the member with the most company over all
bands); what is then still apart from another member is compared in blocks: pairs of different components that
the sketches estimate near are confirmed there on their full sets, and only links leave the block. Which link is found first doesn't
matter, as a link within a component changes nothing.

Defined cases: null text counts as empty. A document without words has an empty set, is linked to nothing and stays. Repeated rows
and copies share a class and are marked alike. A row without doc_id represents nothing; it is its own component (null) unless it is the copy of one with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alertloom.llm.components import components
from alertloom.llm.shared import partitions, salted_join, stored, text_of

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
#: The probability with which a link just at the threshold may share no band.
MISS = 1e-6
#: An estimate may be so far below the threshold: five standard errors of ``REGISTERS`` registers.
SLACK = 0.18
#: Members of a block of a bucket.
BLOCK = 256


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 64-bit numbers spread over all places, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, width: int) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``width`` words; of fewer words the one of them all."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: folds A-Z and splits at ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    runs = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        runs = mix(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - n + 1 + k])
    return np.unique(runs)


def probes() -> np.ndarray:
    """For each register the order in which an empty one asks the others."""
    return np.argsort(mix(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64)).reshape(REGISTERS, REGISTERS), axis=1)


def registers(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The sketch of a set that isn't empty, given its sorted hashes."""
    shift = np.uint64(64 - BUCKET_BITS)
    at = np.searchsorted(hashes, np.arange(REGISTERS, dtype=np.uint64) << shift)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & (least >> shift == np.arange(REGISTERS, dtype=np.uint64))
    rest = (least << np.uint64(BUCKET_BITS)) >> np.uint64(11)  # 53 bits, which a float holds
    zeros = (53 - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((rest << zeros) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        asked = order[empty]
        out[empty] = out[asked[np.arange(len(empty)), full[asked].argmax(axis=1)]]
    return out


def band_rows(threshold: float) -> int:
    """The most registers a band may have for a link at the threshold to be missed with probability ``MISS`` at most."""
    return max(r for r in range(1, 9) if r == 1 or (1 - threshold**r) ** (REGISTERS // r) <= MISS)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """The keys of the bands of each sketch; the band's number is part of a key."""
    n = REGISTERS // rows
    bands = sketches[:, : n * rows].reshape(len(sketches), n, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(sketches), n)).copy()
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return keys.view(np.int64)


def collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of different least hashes agree, for sets of ``n`` and ``m`` elements: the sum over all cells of
    (leading zeros, mantissa) of the product of both probabilities, by powers of two of the sizes."""
    sizes = 2.0 ** np.arange(0, 40) / REGISTERS
    zeros = np.repeat(np.arange(0, 46), 1 << 5)  # 32 cells a power of two stand for 2**MANTISSA
    part = np.tile(np.arange(1 << 5), 46)
    low, high = 2.0 ** -(zeros + 1) * (1 + part / 32), 2.0 ** -(zeros + 1) * (1 + (part + 1) / 32)
    cells = np.exp(-np.outer(sizes, low)) - np.exp(-np.outer(sizes, high))
    cells /= cells.sum(axis=1, keepdims=True)
    table = cells @ cells.T / 2 ** (MANTISSA - 5)
    of = lambda x: np.clip(np.round(np.log2(np.maximum(x, 1))), 0, 39).astype(int)
    return table[of(n), of(m)]


def estimate(a: np.ndarray, b: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of pairs of sketches."""
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _sketch(batches: Iterator[pa.RecordBatch], width: int, rows: int) -> Iterator[pa.RecordBatch]:
    order = probes()
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sets = [shingles(t, width) for t in part.column(1).to_pylist()]
            found = [k for k, s in enumerate(sets) if len(s)]
            sketches = np.array([registers(sets[k], order) for k in found], np.uint16).reshape(-1, REGISTERS)
            keys = [None] * len(sets)
            regs, names = list(keys), list(keys)
            for k, key, sketch in zip(found, band_keys(sketches, rows), sketches):
                keys[k], regs[k], names[k] = key, sketch.tobytes(), hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(regs, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_id", "registers", "bands"])


def sketch_documents(docs: DataFrame, width: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_id (a 128-bit digest of the set), registers and bands of every row; stored."""
    made = docs.select("doc_id", text_of().alias("text")).mapInArrow(
        partial(_sketch, width=width, rows=rows), "doc_id long, n_shingles long, set_id binary, registers binary, bands array<long>")
    return stored(made, "sketches")


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingles(t, width).view(np.int64) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _near(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (hub, id, hub_n, n, hub_registers, registers) whose estimate is ``least`` or more."""
    for batch in batches:
        if batch.num_rows:
            near = estimate(_sketches(batch.column(4)), _sketches(batch.column(5)), collision(batch.column(2).to_numpy(), batch.column(3).to_numpy()))
            keep = near >= least
            hub, other = batch.column(0).to_numpy()[keep], batch.column(1).to_numpy()[keep]
            yield pa.RecordBatch.from_arrays([pa.array(hub), pa.array(other), pa.array(near[keep])], ["hub", "id", "near"])


def same_size(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets that aren't empty."""
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _apart(batches: Iterator[pa.RecordBatch], least: float, rows: int, share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Links between the members of a block (key, low, high) that are of different components, of different sides if low isn't
    high, estimated near, share no earlier band, and have ``share`` of their sets in common. The rows (key, low, high, side, id,
    component, band, shingles) are sorted. A link found joins two components, between which no further one is looked for."""
    order, (of, in_) = probes(), share

    def links(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, low, high, side, ids, component, band = (batch.column(i).to_numpy() for i in range(7))
        offsets, values = batch.column(7).offsets.to_numpy(), batch.column(7).values.to_numpy().view(np.uint64)
        n = np.diff(offsets)
        _, first, place = np.unique(ids, return_index=True, return_inverse=True)
        sketches = np.array([registers(values[offsets[i] : offsets[i + 1]], order) for i in first])[place]
        to: dict[int, int] = {}

        def root(x: int) -> int:
            while x in to:
                x = to[x]
            return x

        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        ends = np.repeat(np.r_[new[1:], len(key)], np.diff(np.r_[new, len(key)]))
        found, step, at = [], 1, np.arange(len(key))
        while len(at := at[at + step < ends[at]]):
            a = at[(component[at] != component[at + step]) & ((low[at] == high[at]) | (side[at] != side[at + step]))]
            if len(a):
                a = a[estimate(sketches[a], sketches[a + step], collision(n[a], n[a + step])) >= least]
                same = (sketches[a] == sketches[a + step])[:, : REGISTERS // rows * rows].reshape(len(a), REGISTERS // rows, rows).all(axis=2)
                for i in a[same.argmax(axis=1) == band[a]].tolist():
                    x, y = root(int(component[i])), root(int(component[i + step]))
                    if x != y:
                        both = same_size(values[offsets[i] : offsets[i + 1]], values[offsets[i + step] : offsets[i + step + 1]])
                        if both * in_ >= int(n[i] + n[i + step] - both) * of:
                            to[x] = y
                            found.append((int(ids[i]), int(ids[i + step])))
            step += 1
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    held = None  # the last block so far, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        name = [batch.column(i).to_numpy() for i in range(3)]
        last = np.flatnonzero((name[0] != name[0][-1]) | (name[1] != name[1][-1]) | (name[2] != name[2][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        held = batch.slice(cut)
        if cut:
            yield links(batch.slice(0, cut))
    if held is not None:
        yield links(held)


class Linker:
    """Confirms candidate pairs of classes and keeps their components."""

    def __init__(self, docs: DataFrame, width: int, share: tuple[int, int]):
        self.docs, self.width, self.share = docs, width, share
        self.links: DataFrame | None = None
        self.found: DataFrame | None = None

    def component(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the component of the id in ``column``."""
        if self.found is None:
            return df.withColumn(out, F.col(column))
        found = self.found.select(F.col("id").alias(column), F.col("component").alias("_c"))
        return salted_join(df, found, column, F.monotonically_increasing_id()).withColumn(out, F.coalesce("_c", column)).drop("_c")

    def sets(self, ids: DataFrame) -> DataFrame:
        """id and shingles of the documents with these ids (a column doc_id); stored."""
        texts = self.docs.select("doc_id", text_of().alias("text")).join(ids.distinct().hint("merge"), "doc_id", "left_semi")
        return stored(texts.dropDuplicates(["doc_id"]).mapInArrow(partial(_sets, width=self.width), "id long, shingles array<long>"), "sets")

    def add(self, links: DataFrame) -> None:
        links = stored(links.select("u", "v"), "confirmed")
        self.links = links if self.links is None else self.links.unionByName(links)
        self.found = components(self.links)

    def confirm(self, pairs: DataFrame, sets: DataFrame) -> None:
        """Link those of ``pairs`` (u, v) whose full sets have the share in common. Many pairs may have the same u."""
        pairs = stored(pairs, "pairs")
        both = pairs.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")).hint("merge"), "v")
        both = salted_join(both, sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u", F.col("v"), "inner", counts=pairs.groupBy("u").agg(F.count("*").alias("_n")))
        of, in_ = self.share
        shared = both.select("u", "v", (F.size("a") + F.size("b")).cast("long").alias("total"), F.size(F.array_intersect("a", "b")).cast("long").alias("same"))
        self.add(shared.filter(F.col("same") * in_ >= (F.col("total") - F.col("same")) * of))


def near_duplicates(docs: DataFrame, width: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id of its component), kept. Documents are linked if
    the intersection of their sets has at least ``share`` (numerator, denominator) of their union's size."""
    spark, threshold = docs.sparkSession, share[0] / share[1]
    rows, least = band_rows(threshold), threshold - SLACK
    docs = docs.select("doc_id", "text")
    sketches = sketch_documents(docs, width, rows)
    by_set = stored(sketches.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("id")).filter("id is not null"), "classes")
    classes = sketches.join(by_set.withColumnRenamed("id", "doc_id"), ["doc_id", "set_id"]).dropDuplicates(["doc_id"])
    classes = stored(classes.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "registers", "bands"), "classes")
    linker = Linker(docs, width, share)

    # Buckets with company, and their hubs.
    bands = classes.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = stored(bands.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1"), "buckets")
    members = stored(salted_join(bands, sizes.withColumnRenamed("_n", "size"), "key", F.col("id"), "inner", counts=sizes), "members")
    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    hubs = members.join(company, "id").groupBy("key").agg(F.max(F.struct("company", -F.col("id"))).alias("h")).select("key", (-F.col("h.col2")).alias("hub"))
    members = stored(salted_join(members, hubs, "key", F.col("id"), "inner", counts=sizes), "members")

    # Members and their hubs: of each member first the nearest hub, then the others still apart.
    own = classes.select("id", "n", "registers")
    pairs = members.filter("id != hub").select("hub", "id").distinct().join(own, "id")
    pairs = salted_join(pairs, own.toDF("hub", "hub_n", "hub_registers"), "hub", F.col("id"), "inner")
    pairs = pairs.select("hub", "id", "hub_n", "n", "hub_registers", "registers")
    pairs = stored(pairs.mapInArrow(partial(_near, least=least), "hub long, id long, near double"), "near")
    first = pairs.groupBy("id").agg(F.max(F.struct("near", "hub")).alias("p")).select(F.col("p.hub").alias("u"), F.col("id").alias("v"))
    sets = linker.sets(pairs.select(F.explode(F.array("hub", "id")).alias("doc_id")))
    linker.confirm(first, sets)
    rest = pairs.select(F.col("hub").alias("u"), F.col("id").alias("v")).join(first, ["u", "v"], "left_anti")
    rest = linker.component(linker.component(rest, "u", "cu"), "v", "cv").filter("cu != cv")
    linker.confirm(rest.select("u", "v"), sets)

    # Members that are still apart from another one than the hub, in blocks.
    others = stored(linker.component(members.filter("id != hub").filter("size > 2"), "id", "component"), "others")
    apart = others.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("_n")).filter("a != b")
    apart = stored(apart.select("key", "_n"), "apart")
    others = stored(salted_join(others.select("key", "band", "id", "component"), apart.withColumnRenamed("_n", "members"), "key", F.col("id"), "inner", counts=apart), "others")
    blocks = F.ceil(F.col("members") / BLOCK)
    others = others.withColumn("side", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    sets = linker.sets(others.select(F.col("id").alias("doc_id")))
    others = others.join(sets.hint("merge"), "id").select(
        "key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "id", "component",
        F.col("band").cast("long").alias("band"), "shingles")
    others = others.repartition(partitions(spark), "key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
    linker.add(others.mapInArrow(partial(_apart, least=least, rows=rows, share=share), "u long, v long"))

    found = by_set.join(linker.found, "id", "left").select("set_id", F.coalesce("component", "id").alias("component"))
    marked = salted_join(sketches.select("doc_id", "n_shingles", "set_id"), found, "set_id", F.col("doc_id"))
    component = F.coalesce("component", "doc_id")
    return marked.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of each component the one with the smallest id."""
    gone = near_duplicates(docs, width, share).filter("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
