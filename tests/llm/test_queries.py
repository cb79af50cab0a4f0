"""The registered queries against their SQL, and the pipeline against its stages by hand."""

import pytest
from compare import difference, oracle
from edge import documents

import corpus_pipeline
from alertloom.llm.oracle import ORACLE
from alertloom.llm.queries import QUERIES
from test_near_dedup import by_hand

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), oracle(SF), ORACLE[name]) is None


def test_every_operator_has_its_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark):
    words = "the cat and the dog of this house went to sea in a boat with some honey and money".split()
    text = lambda k: " ".join(words[(k * j + j) % len(words)] + str(k % 7) * (j % 5 == 0) for j in range(60))
    rows = [(i, text(i)) for i in range(40)] + [(50, "12 !"), (51, None), (52, text(3).replace(" ", "  ")), (53, text(4) + " end"),
                                                (54, text(5)[:160] + " password=abcdefgh12 " + text(6)[:160]), (55, ""), (None, "no id here")]
    docs = documents(spark, rows, clashing=False)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, SF), name)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        assert name == "best_fit_packing" or docs.columns == before.columns
    assert set(dict(rows)) - set(seen["language_id"]) == {50, 51, 55}
    assert 52 not in seen["exact_dedup"]
    left = [(i, r["text"]) for i, r in seen["exact_dedup"].items()]
    assert set(seen["near_dedup"]) == {i for i, _, c, kept in by_hand(left, 5, 4, 5) if kept or c is None}
    assert 53 not in seen["near_dedup"] and "password" not in seen["secret_scan"][54]["text"] and "[SECRET]" in seen["secret_scan"][54]["text"]
    assert set(seen["best_fit_packing"]) == set(seen["secret_scan"])


def test_pipeline_runs_over_a_table(spark):
    assert corpus_pipeline.run(spark, SF).count() >= 150
