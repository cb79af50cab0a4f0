import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from edge import TEXTS, documents, nothing

from alertloom.llm import near_dedup
from alertloom.llm.components import components


def runs(text, width):
    words = (text or "").encode().lower().split()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def by_hand(rows, width, of, in_):
    sets = [runs(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and in_ * len(sets[a] & sets[b]) >= of * len(sets[a] | sets[b]):
            group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), least.get(root(k)), i == least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def corpus():
    """Chains of edits, a hub that alone links its copies, a passage that many share, and copies of all."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = list(TEXTS)
    at = 1000
    for _ in range(6):  # each a few words from the one before
        words = [word() for _ in range(120)]
        for _ in range(8):
            rows.append((at, " ".join(words)))
            words[rnd.randrange(120)] = word()
            words[rnd.randrange(120)] = word()
            at += 3
    hub = [word() for _ in range(200)]
    for k in range(60):  # far enough from each other, near to the hub
        copy = list(hub)
        for j in rnd.sample(range(2, 198, 3), 5):
            copy[j] = word()
        rows.append((5000 + k, " ".join(copy)))
    rows.append((5900, " ".join(hub)))
    passage = " ".join(word() for _ in range(80))
    rows += [(7000 + k, passage + " " + " ".join(word() for _ in range(40))) for k in range(60)]
    rows += [(9000 + k, rows[20 + k][1]) for k in range(30)] + [(9500, rows[25][1].upper())]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, share", [(3, (85, 100)), (5, (4, 5))])
def test_components_are_those_of_all_pairs(spark, monkeypatch, width, share):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)  # so that buckets have several blocks
    rows = corpus()
    got = near_dedup.near_duplicates(documents(spark, rows).repartition(6), width, share).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_hand(rows, width, *share)


def test_no_rows_and_no_links(spark):
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0
    docs = documents(spark, [(1, None), (2, ""), (3, "a b c d e f"), (4, "g h i j k l")])
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4]


def test_estimates_are_near_the_truth():
    rnd, order = np.random.default_rng(1), near_dedup.probes()
    for n, share in ((2000, 0.9), (2000, 0.3), (40, 0.85), (300, 0.0)):
        off = []
        for _ in range(60):
            both = rnd.integers(0, 2**64, int(n * share), np.uint64)
            a, b = (np.unique(np.r_[both, rnd.integers(0, 2**64, (n - len(both)) // 2, np.uint64)]) for _ in range(2))
            x, y = (near_dedup.registers(s, order)[None] for s in (a, b))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            off.append(near_dedup.estimate(x, y, near_dedup.collision(np.array([len(a)]), np.array([len(b)])))[0] - true)
        assert abs(np.mean(off)) < 0.02 and max(map(abs, off)) < near_dedup.SLACK


def test_bands_of_close_sets_meet():
    rnd, order = np.random.default_rng(2), near_dedup.probes()
    rows, missed = near_dedup.band_rows(0.85), 0
    for n in [8, 12, 20, 60, 300] * 60:
        both = rnd.integers(0, 2**64, n, np.uint64)
        sets = [np.unique(np.r_[both, rnd.integers(0, 2**64, max(0, int(n * 0.17 / 2)), np.uint64)]) for _ in range(2)]
        keys = near_dedup.band_keys(np.array([near_dedup.registers(s, order) for s in sets]), rows)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_links_of_blocks_over_batches():
    rnd, n, share = np.random.default_rng(4), 40, (85, 100)
    base = [rnd.integers(0, 2**64, 200, np.uint64) for _ in range(4)]
    sets = [np.unique(np.r_[base[i // 10], rnd.integers(0, 2**64, 5, np.uint64)]) for i in range(n)]
    zero = np.zeros(n)
    table = [np.arange(n) // 20, zero, zero, zero, np.arange(n), np.arange(n) // 10 * 10 + np.arange(n) % 3]
    sketches = np.array([near_dedup.registers(s, near_dedup.probes()) for s in sets])
    rows, links = near_dedup.band_rows(0.85), []
    for band in range(near_dedup.REGISTERS // rows):  # every band a bucket, in which all have the same key
        columns = [pa.array(x.astype(np.int64)) for x in [*table, zero + band]] + [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
        batch = pa.RecordBatch.from_arrays(columns, list("abcdefgh"))
        for b in near_dedup._apart((batch.slice(k, 7) for k in range(0, n, 7)), 0.6, rows, share):
            links += zip(*(c.to_pylist() for c in b.columns))
    assert links and all(u // 10 == v // 10 and u % 3 != v % 3 for u, v in links)
    joined = {(g, c): (g, c) for g in range(4) for c in range(3)}
    for u, v in links:
        x, y = joined[u // 10, u % 3], joined[v // 10, v % 3]
        joined = {k: y if r == x else r for k, r in joined.items()}
    assert len(set(joined.values())) == 4 and len(sketches) == n


def test_components_of_links(spark):
    rnd = random.Random(6)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    links += [(rnd.randrange(3000, 3400), rnd.randrange(3000, 3400)) for _ in range(200)]
    rnd.shuffle(links)
    group = {x: x for p in links for x in p}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        group[y] = x
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: root(x) for x in group}
