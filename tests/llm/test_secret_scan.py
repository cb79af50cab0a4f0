import base64
import random
import re

import duckdb
from edge import TEXTS, documents, nothing
from pyspark.sql import functions as F

from alertloom.llm import secret_scan
from alertloom.llm.secret_scan import Rule


def by_hand(text):
    """The base as its contract words it, and the added kinds by their patterns."""
    text, out = text or "", []
    base = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
            ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    for k, (kind, pattern, group, least) in enumerate(base + [(r.kind, r.pattern, 0, 1) for r in secret_scan.RULES[3:]]):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out)


MORE = [
    (20, "Token=secret=abcdefgh12 token: secret: abcdefghij api_key: 'x1234567' APIKEY=short"),
    (21, "é😀 AKIAAKIAABCDEFGH AKIA12 AKIA" + "Z" * 40),
    (22, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " xoxb-1234567890-abc eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"),
    (23, "deadbeef" * 5 + " " + "0" * 31 + " password = " + "f" * 33),
    (24, "token=" + "x" * 8 + " " + "secret: 12345678 " * 5000),
]


def test_spans(spark):
    rows = TEXTS + MORE
    got = secret_scan.find_secrets(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in got), key=str) == sorted(((i, by_hand(t)) for i, t in rows), key=str)


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger, rules = str(tmp_path / "ledger"), secret_scan.RULES[:3]
    scanned = lambda: spark.read.parquet(f"{ledger}/scanned").count()
    first = documents(spark, MORE[:2])
    secret_scan.find_secrets(first, ledger, rules)
    assert scanned() == 6
    secret_scan.find_secrets(first, ledger, rules)
    assert scanned() == 6
    both = secret_scan.find_secrets(documents(spark, MORE[:3]), ledger, rules)
    assert scanned() == 9
    assert {r["doc_id"]: len(r["spans"]) for r in both.collect()} == {i: len([s for s in by_hand(t) if s[1] < 3]) for i, t in MORE[:3]}
    newer = [*rules[:2], Rule("hex", "[0-9a-f]{40}", version=2)]
    found = secret_scan.find_secrets(documents(spark, MORE[3:4]), ledger, newer).collect()[0]["spans"]
    assert scanned() == 12 and [s["end"] - s["start"] for s in found if s["kind"] == "hex"] == [40]
    # Findings written twice, as after a lost job, count once.
    spark.read.parquet(f"{ledger}/found").filter("version = 2").write.mode("append").parquet(f"{ledger}/found")
    assert len(secret_scan.find_secrets(documents(spark, MORE[3:4]), ledger, newer).collect()[0]["spans"]) == len(found)


def test_redacted_texts(spark):
    docs = documents(spark, TEXTS + MORE + [(30, MORE[0][1])])
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = {r["doc_id"]: r for r in got.filter("doc_id > 7").collect()}
    assert texts[8]["text"] == TEXTS[7][1] and texts[30]["text"] == texts[20]["text"]
    assert texts[20]["text"] == "[SECRET] token: secret: abcdefghij [SECRET]' APIKEY=short"
    assert texts[23]["text"] == "[SECRET] " + "0" * 31 + " [SECRET]" and texts[23]["n_chars"] == len(texts[23]["text"])
    assert got.filter("doc_id = 4").select(F.col("text").isNull()).first()[0]


def private_keys():
    """doc_id: a text with a private key, the pieces of its body, and what stays of the text around the mask."""
    data = base64.b64encode(random.Random(1).randbytes(1217)).decode()
    body = [data[at : at + 64] for at in range(0, len(data), 64)]
    begin, end, lines = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "\n".join(body)
    sealed = f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123\n\n{lines}\n"
    long = [data] * 6000
    return {k: (f"see\n{key}{rest}", body, rest) for k, (key, rest) in enumerate([
        (f"{begin}\n{lines}\n{end}", "\nand on"),
        (f"{begin}\r\n" + "\r\n".join(body) + f"\r\n{end}", " and on"),
        (f"{begin} {' '.join(body)} {end}", " and on"),
        (begin + "\\n" + "\\n".join(body) + "\\n" + end, '"}'),
        ("-" + f"{begin}\n{lines}\n{end}".replace("\n", "\n-"), "\n+fixed"),
        (sealed + end, "\n-----BEGIN CERTIFICATE-----\nabcd\n"),
        (f"{begin}\n{lines}\n", "And on, in prose.\n"),
        (f"{begin}\n{lines}", ""),
        (sealed, "And on."),
        (f"{begin}\n    " + "\n    ".join(body) + "\n", "    and: on"),
        (f"{begin}\n> " + "\n> ".join(body) + "\n", "> and on"),
        (f"{begin} {' '.join(body)}", ", and on"),
        (f"{begin}\n" + "\n".join(body[:-1]), " and on"),
        (f"{begin}\n{lines}\n", f"and then {begin[:10]} prose-with-marks " * 3000),
        (begin, " is the first line-of-it " * 20000),
        (f"{begin}\n" + "\n".join(long) + "\n", "and on"),
        ("-" + f"{begin}\n" + "\n-".join(long[:390]) + "\n", "and on"),
    ], 100)}


def test_private_keys_go_with_their_bodies(spark):
    keys = private_keys()
    docs = documents(spark, [(k, text) for k, (text, _, _) in keys.items()])
    got = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    rule = next(r for r in secret_scan.RULES if r.kind == "private")
    assert rule.version == 2 and set(got) == set(keys)
    for k, (text, body, rest) in keys.items():
        assert got[k].removeprefix("see\n").removeprefix("-") == "[SECRET]" + rest, k
        assert not any(piece in got[k] for piece in body), k
        assert duckdb.execute("SELECT regexp_extract_all(?, ?)", [text, rule.pattern]).fetchone()[0] == re.findall(rule.pattern, text, re.ASCII), k


def test_no_rows(spark):
    assert secret_scan.find_secrets(nothing(spark)).count() == 0 and secret_scan.redact(nothing(spark)).count() == 0
