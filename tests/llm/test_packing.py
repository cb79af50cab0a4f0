import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from edge import TEXTS, documents, nothing
from tokenizers import Tokenizer

from alertloom.llm import packing


def bins_of(plan):
    bins = defaultdict(list)
    for s in plan.segments:
        for t in range(s.count):
            bins[s.sequence + t // s.each].append((s.offset + t % s.each * s.length, s.length))
    return bins


def check(counts, capacity):
    plan = packing.pack_counts(counts, capacity)
    bins = bins_of(plan)
    assert Counter(n for b in bins.values() for _, n in b) == Counter({k: v for k, v in counts.items() if v})
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    ranks = defaultdict(list)
    for s in plan.segments:
        ranks[s.length] += range(s.first, s.first + s.count)
    assert all(sorted(r) == list(range(counts[k])) for k, r in ranks.items())
    assert set(bins) == set(range(plan.sequences))
    return plan


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {rooms[j]: j for j in range(len(rooms)) if rooms[j] >= items[i]}.values():
            rooms[j] -= items[i]
            go(i + 1, rooms)
            rooms[j] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rnd, worse = random.Random(3), 0
    for _ in range(500):
        capacity = rnd.choice([10, 13, 20, 30])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 9))]
        counts, best = dict(Counter(items)), fewest(items, capacity)
        plan = packing.Plan(counts, capacity)
        packing.reduce(plan)
        assert plan.sequences + fewest([k for k, n in plan.left.items() for _ in range(n)], capacity) == best
        worse += check(counts, capacity).sequences > best
    assert worse <= 5


def test_plan_of_large_counts():
    rnd = random.Random(1)
    for counts in ({k: rnd.randint(0, 300) for k in range(1, 1025)}, {k: 700 for k in range(300, 400)}, {600: 999, 300: 5000, 7: 12}, {1024: 50}, {}):
        plan = check(counts, 1024)
        assert len(plan.segments) < 5000


def test_documents(spark):
    rows = TEXTS + [(100 + i, "word " * (i % 400)) for i in range(300)]
    got = [r.asDict() for r in packing.pack_documents(documents(spark, rows).repartition(5)).collect()]
    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    expected = Counter()
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        cuts = list(range(len(ids), 0, -1024))[::-1]
        for piece, (a, b) in enumerate(zip([0, *cuts], cuts)):
            expected[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        assert [o for o, _ in sorted(s)] == np.cumsum([0, *(n for _, n in sorted(s))]).tolist()[:-1] and sum(n for _, n in s) <= 1024
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 1024) + 1


def test_no_rows(spark):
    assert packing.pack_documents(nothing(spark)).count() == 0
