import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge import TEXTS, documents, nothing
from pyarrow import fs
from tokenizers import Tokenizer

from alertloom.llm import packing, token_store
from alertloom.llm.tokens import from_file


@pytest.mark.parametrize("width", [1, 5, 16, 17, 31, 32])
def test_packing_of_bits(width):
    ids = np.array([random.Random(width).randrange(2**width) for _ in range(1001)], "<u4")
    data = token_store.pack(ids, width)
    assert len(data) == (1001 * width + 7) // 8 and (token_store.unpack(data, width, 1001) == ids).all()


@pytest.mark.parametrize("width", [16, 13])
def test_file_has_random_access(tmp_path, width):
    rnd = random.Random(3)
    docs = [np.array([rnd.randrange(2**width) for _ in range(n)], "<u4") for n in (0, 1, 5000, 0, 4096, 9000, 3)]
    path = str(tmp_path / "x.ids")
    writer = token_store.Writer(fs.LocalFileSystem(), path, width)
    for k, ids in enumerate(docs):
        writer.add(None if k == 4 else k, ids.tobytes())
    writer.close()
    reader = token_store.Reader(fs.LocalFileSystem(), path)
    assert [reader.document(k).tolist() for k in (6, 2, 0, 5, 4, 3, 1)] == [docs[k].tolist() for k in (6, 2, 0, 5, 4, 3, 1)]
    every = np.concatenate(docs)
    for _ in range(50):
        a, b = sorted(rnd.sample(range(len(every) + 1), 2))
        assert (reader.ids(a, b) == every[a:b]).all()


@pytest.mark.parametrize("file_ids", [8_000_000, 100])
def test_documents(spark, monkeypatch, file_ids):
    monkeypatch.setattr(token_store, "FILE_IDS", file_ids)  # many files a shard
    got = [tuple(r) for r in token_store.token_index(documents(spark)).collect()]
    whole = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    at, expected = 0, []
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, token_store.END_ID], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected


@pytest.mark.parametrize("name, words, special, n", [(packing.VOCABULARY, False, 50256, 9), (token_store.VOCABULARY, True, 49407, 8)])
def test_special_strings_are_plain_text(name, words, special, n):
    path, text = public_tokenizers.path(name), "a <|endoftext|> b"
    ids = np.frombuffer(from_file(path, words).encode([text])[0], "<u4").tolist()
    assert special not in ids and len(ids) == n
    assert special in Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_no_rows(spark):
    assert token_store.token_index(nothing(spark)).count() == 0
