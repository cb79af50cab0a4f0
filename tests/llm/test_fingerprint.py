import base64
import hashlib
import re
import struct

import pytest
import xxhash
from edge import LONG, TEXTS, documents, nothing

from alertloom.llm import fingerprint
from alertloom.llm.queries import QUERIES


def chained(values, seed=42):
    for x in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed=seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def anchors(text):
    """By the definition: (place, hash) of every run whose least inner run is its first or last."""
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.findall(fingerprint.SYMBOL, text or "")]
    if len(h) < fingerprint.K:
        out = fingerprint.K
        for x in h:
            out = chained([out, x])
        return [(0, out & fingerprint.MASK)] if h else []
    out = []
    for i in range(len(h) - fingerprint.K + 1):
        inner = [chained(h[j : j + 2]) for j in range(i, i + fingerprint.WINDOW)]
        if min(inner, key=signed) in (inner[0], inner[-1]):
            out.append((i, chained([chained([inner[0], inner[2]]), inner[-1]]) & fingerprint.MASK))
    return out


def string(found):
    return base64.b64encode(b"".join(struct.pack(">I", h)[1:] for _, h in found)).decode()


def dice(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def test_anchors(spark):
    rows = [(i, t) for i, t in TEXTS if t != LONG] + [(40, LONG[:5000]), (41, "x" * 100), (42, "a b c d e"), (43, "a b c d")]
    got = fingerprint.fingerprints(documents(spark, rows)).collect()
    expected = [(i, anchors(t), string(anchors(t))) for i, t in rows]
    assert sorted(((r["doc_id"], [tuple(a) for a in r["anchors"]], r["fingerprint"]) for r in got), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_query(spark, folder):
    sf = f"/root/testdata/{folder}"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op10_fingerprints"](spark, sf).collect()}
    ids = sorted(texts, reverse=True)
    assert len(got) == len(ids)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, after = texts[i], texts[following]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b = anchors(text), anchors(edited)
        assert tuple(got[i]) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), string(a), string(b), dice(a, b), dice(a, anchors(after)))


def test_next_ids(spark):
    pairs = fingerprint.next_ids(documents(spark, [(i, "") for i in (5, -3, 90, 17, 17, None)]))
    assert {tuple(r) for r in pairs.collect()} == {(90, 17), (17, 5), (5, -3), (-3, 90)}
    assert [tuple(r) for r in fingerprint.next_ids(documents(spark, [(7, "x")])).collect()] == [(7, 7)]


def test_edited_edge_cases(spark):
    got = {(r["doc_id"], r["n_chars"]): r["edited"] for r in fingerprint.edited_documents(documents(spark, [(1, "abcd"), (2, None), (3, "wxyz12"), (None, "abc")])).collect()}
    assert got == {(1, 4): "abwx", (2, 0): "", (3, 6): "wxy", (None, 3): "ab"}
    assert fingerprint.edited_documents(nothing(spark)).count() == 0
