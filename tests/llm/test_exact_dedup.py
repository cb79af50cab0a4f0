import hashlib
import re

from edge import TEXTS, documents, nothing

from alertloom.llm import exact_dedup


def expected(rows):
    by = {}
    for i, t in rows:
        by.setdefault(re.sub("[ \t-\r]+", " ", t or ""), []).append(i)
    out = []
    for i, t in rows:
        s = re.sub("[ \t-\r]+", " ", t or "")
        keep = min((x for x in by[s] if x is not None), default=None)
        out.append((i, keep, len(by[s]), i == keep, hashlib.sha256(s.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edge_cases(spark):
    got = exact_dedup.exact_dedup(documents(spark)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(TEXTS)


def test_one_group_over_all_runs(spark):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(3000)]
    got = exact_dedup.exact_dedup(documents(spark, rows).repartition(17)).filter("text_sha256 = sha2('same', 256)").collect()
    assert len(got) == 2000 and {r["keep_id"] for r in got} == {1} and {r["group_size"] for r in got} == {2000} and sum(r["kept"] for r in got) == 1


def test_no_rows(spark):
    assert exact_dedup.exact_dedup(nothing(spark)).count() == 0 and exact_dedup.drop_copies(nothing(spark)).count() == 0


def test_filter_returns_whole_rows(spark):
    docs = documents(spark)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 5, 6, 7, 8, 9, 10, 11]
