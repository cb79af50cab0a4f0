import numpy as np
from edge import TEXTS, documents, nothing
from pyspark.sql import functions as F

from alertloom.llm import lang_id, quality
from alertloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op4_language_id"](spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(langs) and len(held) > 250 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97


def test_language_edge_cases(spark):
    english = [(100 + i, "the cat and the dog of this house " * (i % 5 + 1)) for i in range(30)]
    docs = documents(spark, [*TEXTS, (50, "123 !?"), *english])
    langs, net = lang_id.train(docs)
    got = {(r["doc_id"], r["lang_pred"]) for r in lang_id.identify(docs, langs, net).collect()}
    assert langs == ["en"] and {i for i, p in got if p == "und"} == {3, 4, 5, 50, None} and (8, "en") in got
    assert sorted(r["doc_id"] for r in lang_id.keep_identified(docs.filter("doc_id < 60")).collect()) == [1, 2, 6, 7, 8, 9, 10, 11, 12, 12]
    assert lang_id.keep_identified(docs).columns == docs.columns
    assert lang_id.train(nothing(spark)) == ([], None) and lang_id.keep_identified(nothing(spark)).count() == 0
    assert {r["lang_pred"] for r in lang_id.identify(docs, [], None).collect()} == {"und"}


def test_number_like_characters_are_no_letters(spark):
    docs = documents(spark, [(1, "½ ² Ⅷ ๒ _ 7"), (2, "½ é"), (3, "語"), (4, "ʰ"), (5, "\u0301")])
    langs, net = lang_id.train(docs)
    assert [r["lang_pred"] for r in lang_id.identify(docs, langs, net).orderBy("doc_id").collect()] == ["und", "en", "en", "en", "und"]
    assert sorted(r["doc_id"] for r in lang_id.keep_identified(docs).collect()) == [2, 3, 4]


def test_forward_pass_is_a_plain_convolution():
    rnd = np.random.default_rng(3)
    net, x = lang_id.Network(4), rnd.integers(0, 256, (3, lang_id.LENGTH)).astype(np.uint8)
    embedding, filters, bias, out, out_bias = (w.astype(np.float64) for w in net.weights)
    kinds = [w for w in lang_id.WIDTHS for _ in range(lang_id.FILTERS)]
    for window, got in zip(x, net.probabilities(x)):
        padded = [*window, *[0] * (max(lang_id.WIDTHS) - 1)]
        pooled = []
        for f, width in enumerate(kinds):
            places = [sum(embedding[padded[at + k]] @ filters[k * lang_id.EMBEDDING : (k + 1) * lang_id.EMBEDDING, f] for k in range(width))
                      for at in range(lang_id.LENGTH)]
            pooled.append(max(0.0, max(places) + bias[f]))
        z = np.exp(np.array(pooled) @ out + out_bias)
        assert np.allclose(got, z / z.sum(), atol=1e-5)


def test_language_stage_keeps_an_unlabelled_corpus(spark):
    docs = documents(spark, [*TEXTS, (50, "123 !?")]).withColumn("lang", F.lit(None).cast("string"))
    kept = lang_id.keep_identified(docs)
    assert lang_id.train(docs) == ([], None) and kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "6", "7", "8", "9", "10", "11", "12", "12", "None"])


def test_every_language_is_learned(spark, monkeypatch):
    docs = documents(spark, [(i, f"word{'abcdefghij'[i % 10]} and more") for i in range(420)], clashing=False)
    many = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 210))
    assert len(lang_id.train(many)[0]) == 210
    drawn = []
    monkeypatch.setattr(lang_id, "fit", lambda x, y, classes: drawn.append(np.bincount(y, minlength=classes)))
    monkeypatch.setattr(lang_id, "TEXTS", 120)
    lang_id.train(docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 3)))
    assert len(drawn[0]) == 3 and drawn[0].min() > 0 and 60 < drawn[0].sum() < 200


def test_gradients_are_those_of_the_loss():
    rnd = np.random.default_rng(0)
    net, x, y = lang_id.Network(3), rnd.integers(1, 256, (5, lang_id.LENGTH)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    net.weights = [w.astype(np.float64) for w in net.weights]

    def loss():
        pooled = np.maximum(net.filtered(x)[1].max(axis=1) + net.weights[2], 0)
        return -np.log(lang_id.softmax(pooled @ net.weights[3] + net.weights[4])[np.arange(5), y]).mean()

    for w, g in zip(net.weights, net.gradients(x, y)):
        for k in np.argsort(-np.abs(g).ravel())[:3]:
            at, old = np.unravel_index(k, w.shape), w.ravel()[k]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op8_quality_classifier"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([r["score"] for r in held if labels[r["doc_id"]] == k] for k in (1, 0))
    assert good and bad and np.mean([[g > b for g in good] for b in bad]) > 0.95
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_quality_edge_cases(spark):
    docs = documents(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 3).alias("label"))
    weights = quality.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, weights).collect()}
    assert len(scores) == 13 and all(0 <= s <= 1 for s in scores.values())
    one = quality.train(docs, labels.filter("label = 1"))
    assert all(r["score"] > 0.99 for r in quality.score(docs, one).collect())
    none = quality.train(nothing(spark), nothing(spark).select("doc_id", F.col("n_chars").alias("label")))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(nothing(spark), weights).count() == 0


def test_sparse_score_is_the_dot_product():
    rnd = np.random.default_rng(2)
    weights = rnd.normal(size=(1 << quality.BITS) + 1)
    for _, text in TEXTS:
        places, values = quality.vector(text or "")
        assert abs(quality.margin(text or "", weights) - float(weights[places] @ values)) < 1e-6
