"""Quality scores by a logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

The words of a text are its runs of letters, of digits and of other marks. Features are the words, pairs of words, and the pairs and
triples of their shapes (lower case, capitalised, upper case, mixed, digits, marks as they are) and whether a triple repeats a word, hashed to ``2**BITS`` places; a feature's value is
its share of the text's n-grams of its kind. A score is the sparse dot product of these with the weights, through the logistic function. The weights are
fitted on a bounded sample of labelled texts, ``EACH`` of a class at most; the intercept is then set right for the share that
each class has among all labelled rows.

Defined cases: null text counts as empty, and an empty text is scored by the intercept alone. Without rows of both classes every score is
the share of label 1, or 0.5 without any. A document with several labels is learned once for each. Labels other than 0 and 1, and null ones, are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alertloom.llm.sampling import per_class
from alertloom.llm.shared import once, text_of

BITS = 18
#: Labelled texts of a class to learn from, at most (by expectation; they are chosen by hash).
EACH = 4000
EPOCHS = 3
#: Of the learner: step, smoothing of steps, and the two regularisations.
ALPHA, BETA, L1, L2 = 0.5, 0.1, 1e-4, 1e-4
#: Features are small shares; this is what they are multiplied by.
SCALE = 8.0
#: A score from here on predicts label 1.
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Words whose hashes a process keeps, at most.
WORDS = 300_000


def shape(word: str) -> str:
    if not word[0].isalpha():
        return "0" if word[0].isdigit() else word
    if word.islower():
        return "a"
    if len(word) > 1 and word.isupper():
        return "AA"
    return "Aa" if word[1:] == word[1:].lower() else "aA"


class Hashes(dict):
    """The hash of a word and the hash of its shape."""

    def __missing__(self, word: str) -> tuple[int, int]:
        from xxhash import xxh64_intdigest

        if len(self) >= WORDS:
            self.clear()
        out = self[word] = (xxh64_intdigest(word.encode()), xxh64_intdigest(shape(word).encode(), 1))
        return out


def features(text: str) -> list[np.ndarray]:
    """The places of the text's n-grams, one array for each kind."""
    hashes = once("hashes of words", Hashes)
    words = WORD.findall(text)
    pairs = np.array(list(map(hashes.__getitem__, words)), np.uint64).reshape(-1, 2)
    w, s = pairs[:, 0], pairs[:, 1]
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    again = 2 * (w[:-2] == w[1:-1]) + (w[:-2] == w[2:])
    kinds = [w, w[:-1] * a + w[1:] * b, s[:-1] * b + s[1:] * c, s[:-2] * a + s[1:-1] * c + s[2:] * b, again.astype(np.uint64) + b]
    return [((k * a) >> np.uint64(64 - BITS)).astype(np.int64) for k in kinds]


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The sparse vector of a text: places in order and values."""
    kinds = [k for k in features(text) if len(k)]
    if not kinds:
        return np.empty(0, np.int64), np.empty(0)
    places, at = np.unique(np.concatenate(kinds), return_inverse=True)
    return places, np.bincount(at, np.concatenate([np.full(len(k), SCALE / len(k)) for k in kinds]))


def margin(text: str, weights: np.ndarray) -> float:
    """The dot product of a text's vector with the weights, the intercept left out."""
    return float(sum(SCALE * weights[k].mean() for k in features(text) if len(k)))


class Learner:
    """Follow the regularised leader, with a step for each weight; the last weight is the intercept's."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(places, 1 << BITS), np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        more = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - more * w
        self.n[at] += g * g


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 5) -> np.ndarray:
    """The weights, the intercept last."""
    learner, rnd = Learner(), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rnd.permutation(len(rows)):
            learner.learn(*rows[k])
    return learner.weights()


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            made = [vector(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array([p.astype("<i4").tobytes() for p, _ in made], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())], ["doc_id", "label", "of", "places", "values"])


def train(docs: DataFrame, labels: DataFrame, each: int = EACH) -> np.ndarray:
    """Weights from documents (doc_id, text) and labels (doc_id, label: 0 or 1). The sample is drawn from the labels, and its
    2 * ``each`` rows go to the texts."""
    rows = labels.filter("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = per_class(rows, "label", each, 2).select("doc_id", "label", F.col("_of").alias("of"))
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    seen = texts.select("doc_id", "text", "label", "of").mapInArrow(_vectors, "doc_id long, label int, of long, places binary, values binary").collect()  # 2 * each rows
    seen.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["places"])))
    n, of = [sum(r["label"] == k for r in seen) for k in (0, 1)], [max([r["of"] for r in seen if r["label"] == k], default=0) for k in (0, 1)]
    weights = np.zeros((1 << BITS) + 1)
    if all(n):
        weights = fit([(np.frombuffer(r["places"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float), r["label"]) for r in seen])
        weights[-1] += np.log(of[1] / of[0]) - np.log(n[1] / n[0])
    elif any(n):
        weights[-1] = 35.0 if n[1] else -35.0
    return weights


def _score(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    intercept = float(weights[-1])
    for batch in batches:
        margins = np.array([margin(t, weights) for t in batch.column(1).to_pylist()]) + intercept
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margins, -35, 35))), pa.float64())], ["doc_id", "score"])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score, from 0 to 1, of every row."""
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(partial(_score, weights=weights.astype(np.float32)), f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def held_out(modulus: int = 5, rest: int = 0) -> Column:
    """Whether a document is kept from learning, by its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))
