"""Training set, classifier and scoring."""

import pytest
from pyspark.sql import functions as F

from alertloom.constants import ATTACK_CLASSES, FEATURES, TRAINING_PATTERNS
from alertloom.operators import evaluate, model as m
from alertloom.operators.features import training_set
from alertloom.plans import derive
from conftest import SF


@pytest.fixture(scope="module")
def fitted(spark):
    return m.train(training_set(spark))


def test_training_set(spark):
    rows = training_set(spark).cache()
    assert rows.count() == 1998 == 111 * len(TRAINING_PATTERNS)
    low, high = rows.agg(*[F.min(f"f_{n}").alias(n) for n in FEATURES]).first(), rows.agg(*[F.max(f"f_{n}").alias(n) for n in FEATURES]).first()
    assert (low["severity"], high["severity"]) == (0, 4) and low["event_count"] == 1
    assert (low["threshold"], high["threshold"], low["hour_of_day"], high["hour_of_day"]) == (1, 20, 0, 23)
    assert {r[0] for r in rows.select("f_window_sec").distinct().collect()} == {30, 60, 120, 180, 300}
    again = training_set(spark).repartition(3)
    assert rows.exceptAll(again.select(*rows.columns)).count() == 0


def test_classes_and_quality(spark, fitted):
    assert m.classes(fitted) == sorted(ATTACK_CLASSES)
    fresh = training_set(spark, seed=7)
    rows = m.predict(fitted, fresh).select("label", F.col("attack_class").alias("prediction"))
    names = spark.createDataFrame([(c,) for c in ATTACK_CLASSES], "label string")
    score = evaluate.macro_f1(rows, names).first()[0]
    baseline = evaluate.majority_baseline(fresh, rows, names).first()["macro_f1"]
    assert score > 0.5 > baseline


def test_scores(spark, fitted):
    scored = m.score(fitted, derive.incidents(spark, SF)).select("incident_id", "ai_inference.*").collect()
    assert len(scored) == 570
    for r in scored:
        probabilities = r["all_probabilities"]
        assert set(probabilities) == set(ATTACK_CLASSES) and abs(sum(probabilities.values()) - 1) < 0.001
        assert r["confidence"] == max(probabilities.values()) == probabilities[r["attack_class"]]
        if abs(r["confidence"] - 0.6) > 1e-4:
            assert r["is_true_positive"] == (r["confidence"] > 0.6 and r["attack_class"] != "normal_activity")


def test_load_or_train(spark, tmp_path):
    path = str(tmp_path / "model")
    rows = training_set(spark, 360)
    first = m.load_or_train(spark, path, rows)
    second = m.load_or_train(spark, path)
    a = m.predict(first, rows).select("attack_class", "confidence")
    assert a.exceptAll(m.predict(second, rows).select("attack_class", "confidence")).count() == 0
