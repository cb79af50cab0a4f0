"""Labelling, encoding, splits and metrics on hand-made rows and against brute force."""

import datetime as dt
import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from alertloom.operators import evaluate as ev, forests, labeling
from alertloom.schemas import RAW_ALERT
from alertloom.sources.tables import read_labelled, run_windows, write_labelled

BASE = dt.datetime(2026, 7, 16, 11, 0, tzinfo=dt.timezone.utc)
RUN_SCHEMA = "scenario_id string, attack_class string, tool_cmd string, target string, start_time_utc string, end_time_utc string, run_note string, run_idx bigint"


def at(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).isoformat()


def runs(spark, rows):
    return spark.createDataFrame(
        [(f"S{i}", f"c{i}", "", target, at(a), at(b), "", i) for i, (a, b, target) in enumerate(rows)], RUN_SCHEMA)


def alerts(spark, rows):
    data = [{"id": str(i), "timestamp": t if isinstance(t, str) else at(t), "data": {"srcip": ip}} for i, (t, ip) in enumerate(rows)]
    return spark.createDataFrame(data, RAW_ALERT).withColumn("_event_id", F.col("id"))


def label(spark, alert_rows, run_rows, pad=5, bucket=600):
    got = labeling.label_alerts(alerts(spark, alert_rows), run_windows(runs(spark, run_rows), pad), bucket)
    return {int(r["event_id"]): r["label"] for r in got.collect()}


def test_label_cases(spark):
    two = [(100, 110, "10.0.0.1"), (112, 120, "10.0.0.2")]
    cases = [(95, "x"), (94.999, "x"), (115, None), (110, "10.0.0.2"), (110, "10.0.0.9"), (118, "10.0.0.1"), (125, "x"),
             ("not a time", "x"), (125.000001, "x")]
    assert label(spark, cases, two) == {0: "c0", 2: "c0", 3: "c1", 4: "c0", 5: "c1", 6: "c1"}


@pytest.mark.parametrize("bucket", [7, 60, 100_000])
def test_label_against_brute_force(spark, bucket):
    rnd = random.Random(bucket)
    run_rows = []
    for _ in range(60):
        a = rnd.uniform(0, 3000)
        run_rows.append((a, a + rnd.choice([0, 3, 50, 900]), rnd.choice(["", "10.0.0.1", "10.0.0.2", "0.0"])))
    alert_rows = [(rnd.choice([rnd.uniform(-20, 3500), r[0], r[1], r[0] - 5, r[1] + 5]),
                   rnd.choice([None, "10.0.0.1", "10.0.0.23", "8.8.8.8"])) for r in run_rows for _ in range(4)]

    def micro(s):
        return round((BASE + dt.timedelta(seconds=s)).timestamp() * 1e6)

    expected = {}
    for i, (t, ip) in enumerate(alert_rows):
        held = [k for k, (a, b, _) in enumerate(run_rows) if micro(a) - 5_000_000 <= micro(t) <= micro(b) + 5_000_000]
        if held:
            hit = [k for k in held if ip and run_rows[k][2] and run_rows[k][2] in ip] if len(held) > 1 else []
            expected[i] = f"c{(hit or held)[0]}"
    assert label(spark, alert_rows, run_rows, bucket=bucket) == expected


def test_identical_alerts_are_all_labelled(spark):
    a = alerts(spark, [(105, "x")])
    got = labeling.label_alerts(a.unionByName(a).unionByName(a), run_windows(runs(spark, [(100, 110, "")])))
    assert got.count() == 3


def test_labelled_csv(spark, tmp_path):
    df = labeling.label_alerts(alerts(spark, [(105, "x"), (900, "x")]), run_windows(runs(spark, [(100, 110, "")])))
    assert write_labelled(df, str(tmp_path / "out")) and read_labelled(spark, str(tmp_path / "out")).first()["label"] == "c0"
    assert not write_labelled(df.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label string, prediction string")


def test_report_with_absent_class(spark):
    rows = pairs(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")])
    classes = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")
    r = {x["label"]: x for x in ev.classification_report(rows, classes).collect()}
    assert (r["a"]["precision"], r["a"]["recall"], r["a"]["support"]) == (1.0, 0.5, 2)
    assert (r["c"]["precision"], r["c"]["recall"], r["c"]["f1"], r["c"]["support"]) == (0.0, 0.0, 0.0, 0)
    assert r["macro avg"]["f1"] == pytest.approx((2 / 3 + 0.8) / 3)
    assert r["accuracy"]["f1"] == 0.75 and r["weighted avg"]["f1"] == pytest.approx((2 / 3 + 0.8) / 2)
    cm = {x["label"]: (x["a"], x["b"], x["c"]) for x in ev.confusion_matrix(rows, ["a", "b", "c"]).collect()}
    assert cm == {"a": (1, 1, 0), "b": (0, 2, 0), "c": (0, 0, 0)}
    m = ev.majority_baseline(pairs(spark, [("b", ""), ("b", ""), ("a", "")]), rows, classes).first()
    assert (m["majority"], m["accuracy"]) == ("b", 0.5) and m["macro_f1"] == pytest.approx(2 * 0.5 / 1.5 / 3)
    assert ev.benign_false_positives(rows).first().asDict() == {
        "benign": 0, "wrong": 0, "fp_rate": None, "note": "no benign rows"}


def test_calibration_edges(spark):
    rows = spark.createDataFrame([("a", p) for p in (0.0, 0.2, 0.20001, 0.6, 1.0)] + [("b", 0.5)], "label string, prob double")
    got = {r["bin"]: (r["n"], round(r["mean_predicted"], 6)) for r in ev.calibration(rows).collect()}
    assert got == {0: (2, 0.1), 1: (1, 0.20001), 2: (2, 0.55), 4: (1, 1.0)}


def test_level_coercion(spark):
    df = spark.createDataFrame([("",), ("x",), ("10",), ("9.5",), (None,)], "rule_level string")
    assert [r[0] for r in df.select(ev.numeric_level()).collect()] == [0.0, 0.0, 10.0, 9.5, 0.0]


def test_ordinal_codes(spark):
    values = [f"v{i % 37:02d}" for i in range(300)] + [None]
    df = spark.createDataFrame([(v, "z" if i % 2 else "a") for i, v in enumerate(values)], "x string, y string")
    got = {(r["column"], r["value"]): r["code"] for r in ev.ordinal_codes(df, ["x", "y"]).collect()}
    distinct = sorted({v if v is not None else "nan" for v in values})
    assert got == {**{("x", v): i for i, v in enumerate(distinct)}, ("y", "a"): 0, ("y", "z"): 1}


def test_hash_rank_is_a_rank(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    rows = ev.hash_rank(df, ["g"], "h").collect()
    for group in range(3):
        mine = sorted((r for r in rows if r["g"] == group), key=lambda r: r["h"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r["group_size"] for r in mine} == {len(mine)}


def test_split_falls_back_when_a_class_has_one_run(spark):
    rows = spark.range(400).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 4 == 0, "only").otherwise(F.concat(F.lit("r"), F.col("id") % 20)).alias("run_id"),
        F.when(F.col("id") % 4 == 0, "rare").otherwise("common").alias("label"),
        F.md5(F.col("id").cast("string")).alias("digest"))
    out, method = ev.split(rows, "digest")
    assert method == "stratified"
    assert ev.covers_classes(out).first()["viable"]
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert n["test"] == 60 and sum(n.values()) == 400
    groups, method = ev.split(rows.filter("label = 'common'"), "digest")
    assert method == "grouped" and groups.groupBy("run_id").agg(F.count_distinct("split").alias("k")).filter("k > 1").count() == 0


def test_small_grid_search(spark):
    rows = spark.range(240).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("label"),
        (F.col("id") % 3 * 2 + F.col("id") % 2).alias("x"), F.md5(F.col("id").cast("string")).alias("digest"))
    search, names = ev.grid_search(rows, ["x"], "digest", depths=(1, 4), trees=(5,), parallelism=2)
    assert names == ["a", "b", "c"] and len(search.avgMetrics) == 2
    assert max(search.avgMetrics) == pytest.approx(1.0)


def noisy(spark):
    return spark.range(600).repartition(3, "id").sortWithinPartitions("id").select(
        F.pmod(F.xxhash64("id"), F.lit(3)).cast("double").alias("_label"), (F.col("id") % 2).cast("int").alias("_fold"),
        array_to_vector(F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(9)).cast("double") for k in range(4)])).alias("_features")).persist()


def test_shallower_forests_are_the_top_of_the_deepest(spark):
    rows = noisy(spark)
    made = dict(labelCol="_label", featuresCol="_features", predictionCol="_prediction", seed=42)
    deep = forests.Saved(RandomForestClassifier(**made, numTrees=9, maxDepth=5, cacheNodeIds=True).fit(rows))
    for depth in (0, 1, 3):
        plain = RandomForestClassifier(**made, numTrees=9, maxDepth=depth).fit(rows)
        top = deep.cut(depth)
        assert top.getMaxDepth() == depth and top.getNumTrees == 9
        nodes = [sorted(map(str, forests.Saved(m).nodes().collect())) for m in (plain, top)]
        assert nodes[0] == nodes[1]


@pytest.mark.parametrize("kinds", [0, 9])
def test_one_walk_scores_a_forest_at_all_depths(spark, kinds, monkeypatch):
    named = {"ml_attr": {"attrs": {"nominal": [{"vals": list("abcdefghi"), "idx": k, "name": str(k)} for k in range(2)], "numeric": [
        {"idx": k, "name": str(k)} for k in (2, 3)]}, "num_attrs": 4}}
    rows = noisy(spark)
    if kinds:  # two of the columns are categories
        rows = rows.withMetadata("_features", named)
    made = dict(labelCol="_label", featuresCol="_features", predictionCol="_prediction", seed=42)
    deep = forests.Saved(RandomForestClassifier(**made, numTrees=9, maxDepth=5).fit(rows.filter("_fold = 0")))
    assert bool(kinds) == (deep.nodes().filter("nodeData.split.numCategories > 0").count() > 0)
    held = rows.filter("_fold = 1")
    want = {}
    for depth in (0, 2, 5):
        said = deep.cut(depth).transform(held).groupBy("_label", "_prediction").count().collect()
        want |= {(depth, r["_label"], r["_prediction"]): r["count"] for r in said}
    monkeypatch.setattr(forests.Saved, "cut", None)
    assert {tuple(r)[:3]: r["n"] for r in deep.counts(held, [0, 2, 5]).collect()} == want
    assert deep.counts(held.limit(0), [2]).count() == 0


def test_grid_of_depths_is_fitted_once(spark, monkeypatch):
    rows = noisy(spark)
    fits = []
    fit = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (fits.append(self.getMaxDepth()), fit(self, df))[1])
    made = dict(labelCol="_label", featuresCol="_features", predictionCol="_prediction", seed=42)
    found = []
    for search, forest in ((CrossValidator, RandomForestClassifier(**made)), (ev.SideBySide, forests.Forests(**made))):
        grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 3]).addGrid(forest.numTrees, [3, 5]).build()
        found.append(search(estimator=forest, estimatorParamMaps=grid, evaluator=ev.MacroF1(), numFolds=2, foldCol="_fold").fit(rows))
    assert found[0].avgMetrics == found[1].avgMetrics and found[0].stdMetrics == found[1].stdMetrics
    assert found[0].bestModel.toDebugString.split("\n")[1:] == found[1].bestModel.toDebugString.split("\n")[1:]
    fits.clear()
    alerts_of = spark.range(300).select(
        F.when(F.col("id") < 2, "rare").otherwise("common").alias("label"), F.pmod(F.xxhash64("id"), F.lit(9)).alias("x"), F.md5(F.col("id").cast("string")).alias("digest"))
    search, _ = ev.grid_search(alerts_of, ["x"], "digest", depths=(1, 2, 3), trees=(3, 5))
    assert len(search.avgMetrics) == 6 and fits[:-1] == [3] * 4 and len(fits) == 5  # two folds, two numbers of trees; the best


def test_model_on_the_test_split(spark, tmp_path):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("label"),
        (F.col("id") % 3 * 2 + F.col("id") % 2).alias("x"), F.md5(F.col("id").cast("string")).alias("digest"))
    search, names = ev.grid_search(rows, ["x"], "digest", depths=(4,), trees=(5,), parallelism=1)
    ev.save_best(search, str(tmp_path / "best"))
    got = ev.test_predictions(search.bestModel, names, rows, ["x"])
    assert got.filter("label = prediction").count() == 300
    top = ev.calibration(got.withColumn("prob", F.col("probabilities")["a"])).collect()
    assert sum(r["n"] for r in top) == 300
    assert (tmp_path / "best" / "metadata").exists()


def test_pieces_of_overlapping_runs_grow_with_the_runs(spark):
    counts = []
    for n in (100, 400):
        run_rows = [(i, 5000 + i, f"10.0.{i // 250}.{i % 250}.") for i in range(n)]
        alert_rows = [(4000, "10.0.0.7.1"), (4000, "8.8.8.8"), (4000, None)]
        windows = run_windows(runs(spark, run_rows), 0)
        timed = alerts(spark, alert_rows)
        sources = timed.select(F.col("data.srcip").alias("source")).filter("source is not null").distinct()
        pairs = labeling.targets_in(sources, windows)
        assert [tuple(r) for r in pairs.collect()] == [("10.0.0.7.1", "10.0.0.7.")]
        bounds = spark.sql("SELECT 0L AS _low, 10000000L AS _high")
        counts.append(labeling.segments(windows, pairs, bounds, 100_000_000).count())
        assert label(spark, alert_rows, run_rows) == {0: "c7", 1: "c0", 2: "c0"}
    assert counts[1] <= 4 * counts[0] + 4 and counts[0] <= 2 * 100 + 2


def test_endless_window_costs_no_more_than_the_alerts_span(spark):
    got = label(spark, [(105, "x"), (900, "x")], [(100, 4_000_000_000, "")], bucket=1)
    assert got == {0: "c0", 1: "c0"}


def test_boosted_search_has_a_learning_rate(spark):
    rnd = random.Random(2)
    rows = [(c, float("abc".index(c) * 3 + rnd.random()), rnd.random(), f"{i:04x}") for i, c in enumerate("abc" * 20)]
    df = spark.createDataFrame(rows, "label string, x double, y double, digest string").withColumn("digest", F.md5("digest"))
    search, names = ev.boosted_search(df, ["x", "y"], "digest", depths=(2,), rounds=(2,), steps=(0.05, 0.5), parallelism=1)
    assert names == ["a", "b", "c"] and len(search.avgMetrics) == 2 and max(search.avgMetrics) > 0.9
    assert {p.name for g in search.getEstimatorParamMaps() for p in g} == {"maxDepth", "maxIter", "stepSize"}


def test_a_run_given_twice_ends_when_it_ends(spark):
    twice = runs(spark, [(100, 110, ""), (50, 500, "")])
    twice = twice.unionByName(twice.filter("run_idx = 0"))
    got = labeling.label_alerts(alerts(spark, [(105, "x"), (300, "x")]), run_windows(twice)).select("event_id", "label").collect()
    assert sorted(tuple(r) for r in got) == [("0", "c0"), ("0", "c0"), ("1", "c1")]


def test_long_windows_are_swept_where_they_end(spark, monkeypatch):
    marks = []
    swept = labeling._swept
    monkeypatch.setattr(labeling, "_swept", lambda m, width: (marks.append(m.count()), swept(m, width))[1])
    run_rows = [(i, 100_000 + i, "10.0.0.1") for i in range(300)]
    assert label(spark, [(50_000, "10.0.0.1"), (100_290, "x"), (5, "10.0.0.1")], run_rows) == {0: "c0", 1: "c285", 2: "c0"}
    assert marks[0] < 10_000 and marks[1] < 5_000  # a mark for every run and bucket would be 100 000
