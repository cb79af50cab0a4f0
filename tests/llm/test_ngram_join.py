import random

import numpy as np
import pytest
from edge import LONG, TEXTS, documents, nothing

from alertloom.llm import ngram_join
from alertloom.llm.near_dedup import shingles
from alertloom.llm.ngram_join import least_overlap, most_overlap, prefix, shared_counts


def by_hand(rows, width, of, in_):
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text) by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        words = [w for w in (text or "").encode().lower().split()]
        n = min(width, len(words))
        sets.append({b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) * in_ >= len(sets[i] | sets[j]) * of:
                at[root(i)] = root(j)
    for i, (a, _) in enumerate(rows):  # one id stands for all its rows
        for j in range(i):
            if a is not None and rows[j][0] == a and not sets[i] and not sets[j]:
                at[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def families(rnd, n, words, edits):
    """Texts in families of edited copies, with passages that many share."""
    passage = [f"p{k}" for k in range(words // 2)]
    out = []
    while len(out) < n:
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(2, words))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice((1, 1, 3, 6))):
            text = list(base)
            for _ in range(rnd.randint(0, edits)):
                text[rnd.randrange(len(text))] = f"e{rnd.randrange(3000)}"
            out.append((len(out) * 7 % 1009, " ".join(text)))
    return out


@pytest.mark.parametrize("width, share", [(4, (85, 100)), (2, (1, 2))])
def test_against_all_pairs(spark, width, share):
    rows = families(random.Random(width), 350, 60, 3)
    assert rows_of(ngram_join.ngram_join(documents(spark, rows), width, share)) == by_hand(rows, width, *share)


def test_small_sets(spark):
    """Texts of a few words, where one word decides."""
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 14)))) for i in range(300)]
    assert rows_of(ngram_join.ngram_join(documents(spark, rows), 4, (85, 100))) == by_hand(rows, 4, 85, 100)


def test_blocks_of_a_large_family(spark, monkeypatch):
    """Many that are close but not linked, some of which are: chains over blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for k in rnd.sample(range(20, 120, 5), rnd.choice((1, 4, 5))):
            text[k] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(text)))
    expected = by_hand(rows, 4, 85, 100)
    assert 5 < len({c for _, _, c in expected}) < 140
    assert rows_of(ngram_join.ngram_join(documents(spark, rows), 4, (85, 100))) == expected


def test_edges(spark):
    rows = [*TEXTS, (20, LONG + " more"), (21, "two texts of one id are here now"), (21, "and this is quite another one, really"), (22, "TWO texts of one id are here now"),
            (19, "and this is quite another one, really")]
    assert rows_of(ngram_join.ngram_join(documents(spark, rows), 4, (85, 100))) == by_hand(rows, 4, 85, 100)
    assert ngram_join.ngram_join(nothing(spark)).count() == 0


def test_prefixes_share_what_they_ask_for():
    rnd = np.random.default_rng(0)
    counts = rnd.integers(0, 50, ngram_join.CELLS)
    share, asked = (85, 100), set()
    for _ in range(400):
        n = int(rnd.integers(1, 200))
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        kept = a[rnd.permutation(len(a))[: least_overlap(len(a), share)]]
        b = np.unique(np.r_[kept, rnd.integers(0, 1 << 63, int(rnd.integers(0, max(1, n // 10))), dtype=np.uint64)])
        common = np.intersect1d(a, b)
        if 100 * len(common) >= 85 * (len(a) + len(b) - len(common)):
            la, oa, pa, ea = prefix(a, counts, 0, share)
            lb, ob, pb, eb = prefix(b, counts, 0, share)
            asked |= {la, lb}
            most = most_overlap(shared_counts([pa, pb]), np.array([len(a), len(b)]), [pa, pb], np.array([ea, eb]))
            assert most[0, 1] == most[1, 0] >= len(common)
            assert len(np.intersect1d(pa, pb)) >= min(la, lb) and len(np.intersect1d(pa[:oa], pb[:ob])) >= 1
    assert len(asked) > 2  # the choice adapts


def test_counts_of_shared_ngrams():
    rnd = np.random.default_rng(1)
    prefixes = [np.unique(rnd.integers(0, 9000, 600)) for _ in range(20)]
    got = ngram_join.shared_counts(prefixes)
    assert all(got[i, j] == len(np.intersect1d(prefixes[i], prefixes[j])) for i in range(20) for j in range(20) if i != j)


def test_added_counters_are_those_of_all_documents(spark):
    rows = [(i, f"some words of document {i % 50} are here and there") for i in range(400)]
    texts = documents(spark, rows).select("doc_id", "text").repartition(7)
    profiles = texts.mapInArrow(lambda b: ngram_join._profile(b, 4), "doc_id long, n_shingles long, set_id binary, slice int, counts binary")
    expected = np.bincount(ngram_join.cells(np.concatenate([shingles(t, 4) for _, t in rows])), minlength=ngram_join.CELLS)
    assert (ngram_join.added(profiles) == expected).all()
