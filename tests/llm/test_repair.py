import itertools
import random
import zlib

import pytest
from compare import oracle
from pyspark.sql import functions as F

from alertloom.llm import repair
from alertloom.llm.queries import QUERIES
from alertloom.llm.repair import Audits, applied, cheapest

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost string, last string, repaired string"
SF = "/root/testdata/sf0.001"


def well_formed(initials: str) -> bool:
    rest = initials.removeprefix("s")
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def by_search(rows, most_inserted):
    """The cheapest audit by trying all scripts with so many inserted turns at most."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(most_inserted + 1), repeat=len(rows) + 1):
            if sum(gaps) > most_inserted:
                continue
            audit = "".join("I" * g + x for g, x in zip(gaps, letters)) + "I" * gaps[-1]
            if any(must and x != "D" for x, (_, must, _) in zip(letters, rows)):
                continue
            turns = applied(audit, [(initial, "") for initial, _, _ in rows])
            if well_formed("".join(r[:1] or "?" for r, _ in turns)):
                cost = 3 * sum(gaps) + sum({"K": 3 * t, "R": 3 + 3 * t, "D": 4}[x] for x, (_, _, t) in zip(letters, rows))
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("modulus", [repair.MODULUS, 3, 2])
def test_cheapest_audit_against_all_scripts(modulus):
    rnd = random.Random(modulus % 97)
    cases = [[(i, False, t) for i, t in zip(initials, cut)] for n in range(4)
             for initials in itertools.product("suax", repeat=n) for cut in itertools.product((False, True), repeat=min(n, 2)) if len(cut) == n]
    cases += [[(rnd.choice("suuaa "), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.choice((3, 4)))] for _ in range(60)]
    for rows in cases:
        assert cheapest(rows, modulus) == by_search(rows, len(rows) + 2 if len(rows) < 4 else 4), rows


def test_audits_compare_like_strings():
    rnd = random.Random(5)
    for modulus in (repair.MODULUS, 7):
        audits, nodes = Audits(modulus), [0]
        for _ in range(400):
            nodes.append(audits.add(rnd.choice(nodes[-30:]), rnd.choice("DK")))
        for _ in range(3000):
            a, b = rnd.choice(nodes), rnd.choice(nodes)
            assert audits.less(a, b) == (audits.string(a) < audits.string(b))
            k = rnd.randint(0, 40)
            assert audits.string(audits.ancestor(a, k)) == audits.string(a)[: max(0, len(audits.string(a)) - k)]


def test_long_conversation():
    rows = [("ua"[k % 2], k % 7 == 0, k % 5 == 0) for k in range(20_000)]
    cost, audit = cheapest(rows)
    assert cost >= 4 * sum(m for _, m, _ in rows) and sum(x != "I" for x in audit) == len(rows)
    assert well_formed("".join(r[:1] for r, _ in applied(audit, [(i, "") for i, _, _ in rows])))


def test_faults_and_edges(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 3, "assistant", "Yes!"),
            (2, 0, "user", "a"), (2, 0, "user", "a"), (2, None, "assistant", " \t"), (3, None, None, "text."), (3, None, "user", None),
            (None, 1, "user", "No id?"), (4, 5, "", ""), (5, -3, "assistant", "x. "), (5, 3, "assistant", "é" * 50_000)]
    df = spark.createDataFrame([r + ("other",) * 4 for r in rows], SCHEMA)
    got = {r["conv_id"]: r for r in repair.repair_conversations(df).collect()}
    shown = {c: tuple(r[1:8]) for c, r in got.items()}
    assert shown == {
        1: (1, 0, 0, 0, 0, 0, "KKK"), 2: (0, 1, 1, 1, 1, 12, "DDD"), 3: (0, 1, 0, 0, 1, 8, "DD"), None: (0, 0, 0, 0, 0, 3, "KI"),
        4: (0, 1, 0, 0, 0, 4, "D"), 5: (5, 0, 0, 1, 1, 6, "RK")}
    assert got[5]["repaired"] == [("user", "x. "), ("assistant", "é" * 50_000)] and got[2]["repaired"] == []
    assert repair.repair_conversations(df.limit(0)).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {c}?") for c in range(40) for t in (None, *range(8))]
    got = {}
    for r in repair.damaged(spark.createDataFrame([r + ("other",) * 4 for r in rows], SCHEMA)).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else f"One Two {c}" if kind == 2 else text
        assert got.get((c, t), []) == [("user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)


def test_query_returns_every_conversation(spark):
    out = QUERIES["op12_conversation_repair"](spark, SF)
    ids = {r[0] for r in oracle(SF).execute("SELECT DISTINCT conv_id FROM conversations").fetchall()}
    assert {r["conv_id"] for r in out.collect()} == ids and out.filter(F.length("audit") > 0).count() > 10
