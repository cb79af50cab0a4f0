"""Byte-level BPE by a rank file, encoding and decoding.

The rank file becomes a BPE model of the tokenizers library: every byte is written as one character, and every way to put a
token together from two others is a merge with the token's rank, so that the model merges whatever neighbours make the
token of lowest rank, as the file's own library does. Decoding looks up the bytes of each id in the reversed table and joins
them before reading them as UTF-8, so characters that were split over tokens come out whole.

Defined cases: null text counts as empty and has no ids. Rows that repeat are encoded each.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from alertloom.llm.shared import once, text_of
from alertloom.llm.tokens import BYTE_CHARS, ByteEncoder, public_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fewer than of the other encoders, as the merges of a rank file take much room themselves.
PIECES = 200_000


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def build(path: str) -> ByteEncoder:
    import public_tokenizers
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    of = ranks(path)
    chars = {token: "".join([BYTE_CHARS[b] for b in token]) for token in of}
    merges = [(chars[t[:i]], chars[t[i:]]) for t in sorted(of, key=of.get) for i in range(1, len(t)) if t[:i] in of and t[i:] in of]
    tokenizer = Tokenizer(models.BPE({chars[t]: r for t, r in of.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return ByteEncoder(tokenizer, PIECES)


def encoder(path: str) -> ByteEncoder:
    """The encoder of a rank file, built once in a Python process."""
    return once(f"encoder of {path}", lambda: build(path))


def byte_table(path: str) -> list[bytes]:
    """The bytes of each id."""
    def make() -> list[bytes]:
        of = ranks(path)
        out = [b""] * (max(of.values()) + 1)
        for token, rank in of.items():
            out[rank] = token
        return out

    return once(f"bytes of {path}", make)


def char_starts(text: str, ids: np.ndarray, table: list[bytes]) -> np.ndarray:
    """The code point in which each token begins."""
    data = np.frombuffer(text.encode(), np.uint8)
    char_of_byte = np.cumsum((data & 0xC0) != 0x80) - 1
    lengths = np.fromiter((len(table[i]) for i in ids.tolist()), np.int64, len(ids))
    return char_of_byte[np.cumsum(lengths) - lengths].astype(np.int32)


def decode(ids: Iterable[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def decode_parts(parts: Iterable[list[int]], table: list[bytes]) -> Iterator[str]:
    """Text as ids arrive, each part as far as its characters are complete."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for ids in parts:
        yield decoder.decode(decode(ids, table))
    yield decoder.decode(b"", final=True)


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values) if values else np.empty(0), kind))


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str, offsets: bool) -> Iterator[pa.RecordBatch]:
    path = public_path(vocabulary)
    coder, table = encoder(path), byte_table(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # so that a batch of long texts goes out in parts
            part = batch.slice(at, 256)
            texts = part.column(1).to_pylist()
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in coder.encode(texts)]
            columns = [part.column(0), _lists(ids, pa.int32())]
            if offsets:
                columns.append(_lists([char_starts(t, i, table) for t, i in zip(texts, ids)], pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "char_starts"][: len(columns)])


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    table = byte_table(public_path(vocabulary))
    for batch in batches:
        values = batch.column(1)
        out = [decode(values[i].values.to_numpy().tolist(), table) for i in range(len(values))]
        yield pa.RecordBatch.from_arrays([batch.column(0), values, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, offsets: bool = False) -> DataFrame:
    """doc_id and ids of every text; with ``offsets`` also char_starts, the code point in which each token begins."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>" + ", char_starts array<int>" * offsets
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(partial(_encode, vocabulary=vocabulary, offsets=offsets), schema)


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and the decoded bytes."""
    schema = f"doc_id {dict(encoded.dtypes)['doc_id']}, ids array<int>, decoded binary"
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, vocabulary=vocabulary), schema)
