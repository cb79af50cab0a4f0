"""Language identification by a convolutional network over bytes.

The bytes of the lower-cased text are cut into windows of ``LENGTH``, the last filled up with zeros, and every window of the whole
text is scored: an embedding of the bytes, filters of several widths, the maximum of each filter over the window, and a softmax. A
text's probabilities are the mean over its windows, by the bytes they hold. The network is trained in numpy, by Adam, on a bounded sample of
the labelled texts: ``EACH`` texts of a language, fewer of each if the languages are so many that these would be more than ``TEXTS`` in
all, and ``WINDOWS`` windows spread evenly over each. Every language is learned.

Defined cases: a text that is null or has no letter (of Unicode's category L) is ``und`` with score 0, as is every text if there is nothing to learn from. Repeated
rows get equal predictions. Rows without language or doc_id are not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from alertloom.llm.sampling import per_class

LENGTH = 256
EMBEDDING, WIDTHS, FILTERS = 8, (2, 3, 4), 8
#: Texts of a language to learn from, texts in all, and windows of a text, at most.
EACH, TEXTS, WINDOWS = 400, 80_000, 6
#: Of a language with so many texts or more about this many are drawn at least, however many languages there are; none is drawn of one in
#: less than one of 10**8 cases.
LEAST = 20
EPOCHS, BATCH, RATE = 6, 64, 0.01
UNKNOWN = "und"
#: Letters, and the number-like characters among those of words.
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def windows_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    out = np.zeros((max(1, -(-len(data) // LENGTH)), LENGTH), np.uint8)
    out.reshape(-1)[: len(data)] = data
    return out


class Network:
    """``weights``: embedding, filters (all of the greatest width; narrower ones have zeros), their bias, output and its bias."""

    def __init__(self, classes: int, seed: int = 7):
        rnd, widest, n = np.random.default_rng(seed), max(WIDTHS), FILTERS * len(WIDTHS)
        self.mask = np.concatenate([np.repeat((np.arange(widest) < w)[:, None], FILTERS, 1) for w in WIDTHS], axis=1)
        self.mask = np.repeat(self.mask, EMBEDDING, axis=0).astype(np.float32)
        shapes = [(256, EMBEDDING), (widest * EMBEDDING, n), (n,), (n, classes), (classes,)]
        self.weights = [(rnd.normal(0, 0.3, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in shapes]
        self.weights[1] *= self.mask
        self.weights[0][0] = 0

    def filtered(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For windows of bytes: the patches at each place and the filters' outputs there."""
        widest = max(WIDTHS)
        padded = np.zeros((len(x), LENGTH + widest - 1), np.uint8)
        padded[:, :LENGTH] = x
        embedded = self.weights[0][padded].reshape(len(x), -1)
        patches = sliding_window_view(embedded, widest * EMBEDDING, axis=1)[:, ::EMBEDDING]
        patches = np.ascontiguousarray(patches).reshape(-1, widest * EMBEDDING)
        return patches, (patches @ self.weights[1]).reshape(len(x), LENGTH, -1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.weights[4])), np.float32)
        for at in range(0, len(x), BATCH):
            pooled = self.filtered(x[at : at + BATCH])[1].max(axis=1)
            out[at : at + BATCH] = softmax(np.maximum(pooled + self.weights[2], 0) @ self.weights[3] + self.weights[4])
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the cross-entropy; only the place of each filter's maximum has a part in it."""
        patches, h = self.filtered(x)
        places = h.argmax(axis=1)
        pooled = np.take_along_axis(h, places[:, None], axis=1)[:, 0] + self.weights[2]
        active = np.maximum(pooled, 0)
        off = softmax(active @ self.weights[3] + self.weights[4])
        off[np.arange(len(y)), y] -= 1
        off /= len(y)
        back = (off @ self.weights[3].T) * (pooled > 0)
        at = patches.reshape(len(x), LENGTH, -1)[np.arange(len(x))[:, None], places]  # window, filter, patch
        filters = np.einsum("nf,nfp->pf", back, at) * self.mask
        to_bytes = np.einsum("nf,pf->nfp", back, self.weights[1]).reshape(len(x), places.shape[1], -1, EMBEDDING)
        padded = np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))
        seen = padded[np.arange(len(x))[:, None, None], places[:, :, None] + np.arange(max(WIDTHS))]
        embedding = np.zeros_like(self.weights[0])
        np.add.at(embedding, seen.reshape(-1), to_bytes.reshape(-1, EMBEDDING))
        embedding[0] = 0
        return [embedding, filters, back.sum(axis=0), active.T @ off, off.sum(axis=0)]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, classes: int, seed: int = 7) -> Network:
    """A network trained on windows ``x`` of the classes ``y``; half of the windows are cut to a random length each time."""
    net, rnd = Network(classes, seed), np.random.default_rng(seed)
    first, second, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    share = np.bincount(y, minlength=classes)[y]
    for _ in range(EPOCHS):
        order = rnd.choice(len(y), len(y), p=(1 / share) / (1 / share).sum())  # classes alike
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            batch, cut = x[rows].copy(), rnd.integers(6, 2 * LENGTH, len(rows))
            batch[np.arange(LENGTH) >= cut[:, None]] = 0
            step += 1
            for k, g in enumerate(net.gradients(batch, y[rows])):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                rate = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                net.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, langs, parts = [], [], []
        for doc_id, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if has_letter(text):
                every = windows_of(text)
                chosen = np.unique(np.linspace(0, len(every) - 1, min(WINDOWS, len(every))).astype(int))
                ids.append(doc_id)
                langs.append(lang)
                parts.append(every[chosen].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["doc_id", "lang", "windows"])


def train(labelled: DataFrame, each: int = EACH) -> tuple[list[str], Network | None]:
    """The languages and a network for them, from rows (doc_id, text, lang)."""
    rows = labelled.filter("doc_id is not null and lang is not null and text is not null").select("doc_id", "lang", "text")
    languages = rows.select("lang").distinct().count()
    each = min(each, max(LEAST, TEXTS // max(1, languages)))
    chosen = per_class(rows, "lang", each).select("doc_id", "lang", "text")
    seen = chosen.mapInArrow(_sample, "doc_id long, lang string, windows binary").collect()  # about TEXTS rows of WINDOWS windows at most, or LEAST a language
    seen.sort(key=lambda r: (r["lang"], r["doc_id"], r["windows"]))
    langs = sorted({r["lang"] for r in seen})
    if not langs:
        return [], None
    parts = [np.frombuffer(r["windows"], np.uint8).reshape(-1, LENGTH) for r in seen]
    place = {name: k for k, name in enumerate(langs)}
    y = np.repeat([place[r["lang"]] for r in seen], [len(p) for p in parts])
    return langs, fit(np.concatenate(parts), y, len(langs))


def _predict(batches: Iterator[pa.RecordBatch], langs: list[str], net: Network | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            texts = part.column(1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [k for k, t in enumerate(texts) if net and t and has_letter(t)]
            if known:
                windows = [windows_of(texts[k]) for k in known]
                every = np.concatenate(windows)
                held = (every != 0).sum(axis=1)[:, None] + 1e-9
                first = np.cumsum([0, *map(len, windows[:-1])])
                p = np.add.reduceat(net.probabilities(every) * held, first) / np.add.reduceat(held, first)
                for k, row in zip(known, p):
                    names[k], scores[k] = langs[int(row.argmax())], float(min(1.0, row.max()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, langs: list[str], net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, langs=langs, net=net), f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def held_out(modulus: int = 3, rest: int = 1) -> Column:
    """Whether a document is kept from learning, by its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose texts have a letter, with their own columns. The network learns from those not held out and names a
    language for every text with a letter, however unlike its languages, so its answer removes no row. Without languages to learn
    there is no network, and the letters alone decide."""
    langs, net = train(docs.filter(~held_out()))
    return docs.mapInArrow(partial(_keep, langs=langs, net=net), docs.schema)


def _keep(batches: Iterator[pa.RecordBatch], langs: list[str], net: Network | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if net is None:
            yield batch.filter(pa.array([bool(t and has_letter(t)) for t in batch.column("text").to_pylist()], pa.bool_()))
            continue
        pair = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text")], ["doc_id", "text"])
        said = pa.Table.from_batches(_predict(iter([pair]), langs, net)).to_pydict()
        yield batch.filter(pa.array([n != UNKNOWN for n in said["lang_pred"]], pa.bool_()))
