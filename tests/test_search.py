"""Searches by postings against the scan they replace."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from alertloom.operators import analytics as g, postings, store
from alertloom.operators.table import edit_rows, read_table, upsert_rows
from test_store import T0, row, table

WORDS = ["web", "WEB-srv-1", "corp\\web", "ΑΣ", "ΟΔΟΣ ΑΣΑ", "İstanbul", "a_b", "100%", 'say "hi"', "😀 smile", "sql injection", "line\nbreak", "", "x"]


def rows(spark, n=120):
    rnd = random.Random(5)
    made = []
    for i in range(n):
        raw = None if i % 17 == 0 else {"incident_id": f"{i}", "correlation_key": rnd.choice(WORDS) + rnd.choice(WORDS)}
        made.append(row(i, created_at=T0 + dt.timedelta(days=i % 5), category=None if i % 13 == 0 else rnd.choice(WORDS) or "none", raw_incident=raw,
                        target_hosts=None if i % 11 == 0 else [None, rnd.choice(WORDS)] if i % 7 == 0 else [rnd.choice(WORDS) for _ in range(i % 3)]))
    return table(spark, *made)


@pytest.fixture(scope="module")
def searchable(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("searched") / "t")
    store.write_incidents(rows(spark), path)
    stored = store.read_incidents(spark, path)
    postings.write_postings(stored, path)
    return stored, path


def ids(found):
    return sorted(r["id"] for r in found.select("id").collect())


def test_searches_are_those_of_the_scan(searchable):
    stored, path = searchable
    rnd, some = random.Random(1), 0
    texts = [*WORDS, "web%srv", "a_b", "we_", "____", "%%", "\\", "corp\\%", "rp\\w", "σ", "αςα", "οδος", "istanbul", "smi", "no such text"]
    for _ in range(14):
        text = list(rnd.choice([w for w in WORDS if len(w) > 3]))
        text[rnd.randrange(len(text))] = rnd.choice("%_")
        texts.append("".join(text)[rnd.randrange(2):])
    for text in texts:
        expected = ids(stored.filter(g.Filters(search=text).condition()))
        assert ids(postings.search(stored, path, g.Filters(search=text))) == expected, text
        some += 0 < len(expected) < 120
    assert some > 15


def test_other_filters_hold_too(searchable):
    stored, path = searchable
    for filters in (g.Filters(search="web-srv", severity=3), g.Filters(search="web-srv", category="web"), g.Filters(status="open"), g.Filters()):
        assert ids(postings.search(stored, path, filters)) == ids(stored.filter(filters.condition()))


def test_only_days_with_all_grams_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_incidents(table(spark, *[row(i, created_at=T0 + dt.timedelta(days=i), category="needle" if i == 4 else "needy") for i in range(9)]), path)
    stored = store.read_incidents(spark, path)
    postings.write_postings(stored, path)
    for day in (tmp_path / "t").glob("created_date=*"):
        if day.name != f"created_date={T0 + dt.timedelta(days=4):%Y-%m-%d}":
            shutil.rmtree(day)  # a search that looked there would fail
    assert ids(postings.search(stored, path, g.Filters(search="needle"))) == [f"{4:032d}"]
    assert postings.search(stored, path, g.Filters(search="no such text")).count() == 0


def test_postings_follow_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_rows(path, table(spark, row(1, category="first words"), row(2, created_at=T0 + dt.timedelta(days=3), category="second words")))
    assert not postings.has_postings(spark, path)
    postings.write_postings(read_table(spark, path), path)

    def found(text):
        return ids(postings.search(read_table(spark, path), path, g.Filters(search=text)))

    upsert_rows(path, table(spark, row(3, category="third words")))
    edit_rows(path, spark.createDataFrame([(f"{1:032d}", "closed")], "id string, status string"), F.to_timestamp(F.lit("2027-01-01")))
    assert [found(t) for t in ("first", "second", "third", "words")] == [[f"{i:032d}" for i in of] for of in ([1], [2], [3], [1, 2, 3])]


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    none = table(spark).withColumn("created_date", F.to_date("created_at"))
    postings.write_postings(none, path)
    assert postings.search(none, path, g.Filters(search="words")).count() == 0


def test_postings_are_far_fewer_than_grams_of_all_incidents(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_incidents(table(spark, *[row(i, category="the same long category of all these incidents") for i in range(300)]), path)
    stored = store.read_incidents(spark, path)
    postings.write_postings(stored, path)
    assert spark.read.parquet(postings.postings_path(path)).count() < 300 * 20
    assert len(ids(postings.search(stored, path, g.Filters(search="LONG category")))) == 300


def test_a_block_is_left_out_by_its_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_ROWS", 4)
    path = str(tmp_path / "t")
    store.write_incidents(table(spark, *[row(i, category="needle" if i in (5, 17) else "needy") for i in range(40)]), path)
    stored = store.read_incidents(spark, path)
    postings.write_postings(stored, path)
    assert ids(postings.search(stored, path, g.Filters(search="needle"))) == [f"{i:032d}" for i in (5, 17)]
    blocks = spark.read.parquet(postings.postings_path(path)).filter("gram = 'dle'").select("from_id", "to_id").collect()
    assert sorted((int(b[0]), int(b[1])) for b in blocks) == [(4, 7), (16, 19)]
