import hashlib
import random
import zlib

import pytest
from compare import difference, oracle
from pyspark.sql import functions as F

from alertloom.llm import prefix_trie as trie
from alertloom.llm.oracle import ORACLE
from alertloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth string, name string, pos string"
SF = "/root/testdata/sf0.001"


def by_hand(conversations):
    """The nodes of the trie of {conv_id: [(role, text)]}, by their prefixes."""
    members, kids = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if len(conversations[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode().split()) for q in below if q)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), sum(q not in kids for q in below), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([r + ("other",) * 4 for r in rows], SCHEMA)


def ordered(rows):
    out = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_random_forests(spark):
    rnd = random.Random(3)
    for seed in range(4):
        rows = []
        for c in range(rnd.randint(30, 120)):
            name = rnd.choice((1, -1)) * (c + 1)
            same = rnd.random() < 0.3
            rows += [(name, t, "ua"[t % 2], "all the same" if same else rnd.choice(("x", "y z", "")) ) for t in range(rnd.choice((1, 2, 3, 5, 9)))]
        got = trie.prefix_trie(trie.digests(frame(spark, rows)))
        assert rows_of(got) == by_hand(ordered(rows)), seed


@pytest.mark.parametrize("cuts", [1, 2, 3, 7])
def test_forests_joined_over_any_boundaries(cuts):
    """Ranges cut anywhere, contracted and joined in several rounds, give the rows of one range."""
    rnd = random.Random(cuts)
    for _ in range(60):
        paths = {c: [rnd.choice(("a", "b")) for _ in range(rnd.choice((0, 1, 2, 2, 4, 6)))] for c in range(rnd.randint(1, 14))}
        digest = lambda x: hashlib.md5(x.encode()).digest()
        items = sorted((b"".join(map(digest, p)), c, [len(x) for x in p]) for c, p in paths.items())
        places = sorted(rnd.randint(0, len(items)) for _ in range(cuts))
        forest, contractions = trie.Forest(), []
        for a, b in zip([0, *places], [*places, len(items)]):
            part = [trie.Item.conversation(c, p, w) for p, c, w in items[a:b]]
            if part:
                contractions.append(trie.held(trie.joined(forest, None, part, [trie.common_depth(x.path, y.path) for x, y in zip(part, part[1:])])))
        half = rnd.randint(0, len(contractions) - 1)
        before = None
        for data in contractions[:half]:
            before = trie.joined(forest, before, *trie.sides(trie.released(data)))
        rest = None
        for data in contractions[half:]:
            rest = trie.joined(forest, rest, *trie.sides(trie.released(data)))
        trie.joined(forest, before and trie.released(trie.held(before)), *trie.sides(trie.released(trie.held(rest))), whole=True)
        names = {r[4]: r[1] for r in forest.rows if r[4] is not None}
        ends = {}
        for name, ids in forest.parts:
            ends.setdefault(name, []).extend(ids.split(","))
        got = sorted(((r[1], r[0], r[2] if r[2] is not None else names.get(r[3]), *r[5:9], r[9] or trie.sha(ends.get(r[4], []))) for r in forest.rows), key=str)
        assert got == by_hand({c: [("", x) for x in p] for c, p in paths.items()})


def test_edges(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, None), (2, None, "user", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "a"),
            (None, 0, "user", "a"), (4, 0, "user", "a"), (4, 1, "", ""), (-5, 2, "x", "é " * 40_000), (6, 1, "user", "b"), (6, 1, "user", "a")]
    assert rows_of(trie.prefix_trie(trie.digests(frame(spark, rows)))) == by_hand(ordered(rows))
    assert trie.prefix_trie(trie.digests(frame(spark, rows).limit(0))).count() == 0


def test_deep_paths_and_copies(spark):
    """Copies of one conversation that fill several ranges, and one of many turns."""
    rows = [(c, t, "user", f"t{t}") for c in range(3000) for t in range(2)] + [(5000, t, "user", f"t{t}") for t in range(700)]
    got = trie.prefix_trie(trie.digests(frame(spark, rows)))
    counts = {r["depth"]: r for r in got.collect()}
    assert len(counts) == 701 and counts[2]["n_convs"] == 3001 and counts[2]["n_children"] == 1 and counts[700]["n_convs"] == 1
    assert counts[2]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert counts[0]["saved_tokens"] == 6000 and counts[0]["parent_conv_id"] is None and counts[3]["parent_conv_id"] == 0


def test_rebuilding(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in (*range(45), -3, 61) for t in range(c % 5)]
    got = {}
    for r in trie.rebuilt(trie.digests(frame(spark, rows))).orderBy("conv_id", "pos").collect():
        got.setdefault(r["conv_id"], []).extend([bytes(r["digest"])] if r["digest"] else [])
    own = ordered(rows)
    turn = {bytes(r["d"]): r["text"] for r in frame(spark, rows).select("text", trie.turn_digest(F.col("role"), F.col("text")).alias("d")).collect()}
    assert {c: [turn[d] for d in p] for c, p in got.items()} == {
        c: [x[1] for x in own.get(c - c % 20 if c >= 0 else 0, [])[:h] + own[c][h:]] for c in own for h in [zlib.crc32(str(c).encode()) % 4]}


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_conversation_repair"])
def test_query_matches_sql_over_nulls(spark, tmp_path, name):
    rnd = random.Random(11)
    some = lambda *x: rnd.choice(x)
    rows = [(c, some(None, *range(4)), some(None, "user", "assistant", "system", "tool", ""), some(None, "", " \n", "Yes.", "no", "a b? ", "É!"))
            for c in range(60) for _ in range(some(1, 2, 3, 5))]
    spark.createDataFrame(list(dict.fromkeys(rows)), "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = oracle(SF)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert difference(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name]) is None
