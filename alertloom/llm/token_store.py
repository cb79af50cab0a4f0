"""Token ids in fixed-width binary files.

Every id takes the least number of bits that the vocabulary needs. A file is

    magic, format version, width, ids a block | blocks | doc ids, doc starts, block offsets | their number, magic

with all numbers little-endian. Within a block the bits of the ids follow each other from the lowest; blocks hold a fixed
number of ids, each block's place is in the offsets, and numpy unpacks a block at once, so that any range of ids, or one
document, is read from the blocks that hold it.

Documents are dealt by ranges of their ids; each task writes its range as files of bounded size under names of its own, and
only files that the stored manifest lists are read, so what a lost task left behind does no harm.

Defined cases: null text counts as empty and gives the end id alone. A null doc_id comes first. Repeated rows are written each.
An empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from alertloom.llm.shared import file_system, new_path, partitions, stored, text_of
from alertloom.llm.tokens import from_file, public_path

VOCABULARY = "word_bpe_49k.json"
#: Ids of the vocabulary and the id that ends a document.
N_IDS, END_ID = 49_408, 1
BLOCK = 4096
#: A file takes no further document once it has so many ids.
FILE_IDS = 8_000_000
MAGIC = b"idpack01"
HEAD, TAIL = "<8sII", "<QQQ8s"
#: Stands for a null doc_id in a file.
NO_ID = -(2**63)


def bits_for(n_ids: int) -> int:
    return max(1, (n_ids - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Unsigned 32-bit ids as ``width`` bits each, from the lowest bit on; the last byte is filled with zeros."""
    if width == 16:
        return ids.astype("<u2").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, "<u2", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: count * width].reshape(count, width)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    """One file; ``add`` documents in order, then ``close``."""

    def __init__(self, fs, path: str, width: int):
        self.out, self.path, self.width = fs.open_output_stream(path), path, width
        self.out.write(struct.pack(HEAD, MAGIC, width, BLOCK))
        self.at, self.rest, self.n = struct.calcsize(HEAD), b"", 0
        self.docs: list[int] = []
        self.starts: list[int] = []
        self.offsets: list[int] = []

    def _blocks(self, size: int) -> None:
        while len(self.rest) >= size > 0:
            block, self.rest = self.rest[: 4 * BLOCK], self.rest[4 * BLOCK :]
            data = pack(np.frombuffer(block, "<u4"), self.width)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.starts.append(self.n)
        self.n += len(ids) // 4
        self.rest += ids
        self._blocks(4 * BLOCK)

    def close(self) -> None:
        self._blocks(4)
        for numbers in (self.docs, self.starts, self.offsets):
            self.out.write(np.array(numbers, "<i8").tobytes())
        self.out.write(struct.pack(TAIL, len(self.docs), len(self.offsets), self.n, MAGIC))
        self.out.close()


class Reader:
    """Random access to one file."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n_docs, n_blocks, self.n, magic = struct.unpack(TAIL, self._read(size - struct.calcsize(TAIL), struct.calcsize(TAIL)))
        head, self.width, self.block = struct.unpack(HEAD, self._read(0, struct.calcsize(HEAD)))
        if not head == magic == MAGIC:
            raise ValueError(f"{path} is not a file of packed ids")
        table = np.frombuffer(self._read(size - struct.calcsize(TAIL) - 8 * (2 * n_docs + n_blocks), 8 * (2 * n_docs + n_blocks)), "<i8")
        self.docs, self.starts, self.offsets = np.split(table, [n_docs, 2 * n_docs])
        self.ends = np.append(self.starts[1:], self.n)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        count = min(self.n, (last + 1) * self.block) - first * self.block
        size = (self.block * self.width + 7) // 8
        data = self._read(int(self.offsets[first]), (last - first) * size + ((count - (last - first) * self.block) * self.width + 7) // 8)
        if self.block * self.width % 8 == 0:
            out = unpack(data, self.width, count)
        else:
            out = np.concatenate([unpack(data[k * size : (k + 1) * size], self.width, min(self.block, count - k * self.block)) for k in range(last - first + 1)])
        return out[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        """The ids of the ``k``-th document of the file."""
        return self.ids(int(self.starts[k]), int(self.ends[k]))


MANIFEST = "shard int, file int, path string, docs long, ids long, before long"


def _write(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int, n_ids: int) -> Iterator[pa.RecordBatch]:
    fs, root = file_system(folder)
    coder = from_file(public_path(vocabulary), True)
    shard, end, width = TaskContext.get().partitionId(), struct.pack("<I", end_id), bits_for(n_ids)
    rows, writer, before = [], None, 0

    def close() -> int:
        writer.close()
        rows.append((shard, len(rows), writer.path, len(writer.docs), writer.n, before))
        return before + writer.n

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1).to_pylist())):
                if writer and writer.n >= FILE_IDS:
                    before, writer = close(), None
                if not writer:
                    fs.create_dir(root, recursive=True)
                    writer = Writer(fs, f"{root}/{shard:06d}-{len(rows):05d}-{uuid.uuid4().hex}.ids", width)
                writer.add(doc_id, ids + end)
    if writer:
        close()
    names = ["shard", "file", "path", "docs", "ids", "before"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def write_ids(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, n_ids: int = N_IDS) -> DataFrame:
    """Encode and write all texts in ascending order of doc_id; the stored manifest: one row per file, ``before`` being the ids of the
    shard's earlier files."""
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(rows.mapInArrow(partial(_write, folder=folder, vocabulary=vocabulary, end_id=end_id, n_ids=n_ids), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, _ = file_system(folder)
    for batch in batches:
        for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = Reader(fs, path)
            for at in range(0, len(reader.docs), 1024):
                end = min(at + 1024, len(reader.docs))
                low = int(reader.starts[at])
                data = reader.ids(low, int(reader.ends[end - 1])).tobytes()  # 1024 documents at a time
                spans = [(int(a) - low, int(b) - low) for a, b in zip(reader.starts[at:end], reader.ends[at:end])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if d == NO_ID else d for d in reader.docs[at:end].tolist()], pa.int64()),
                    pa.array(reader.starts[at:end] + first, pa.int64()),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    n = partitions(manifest.sparkSession)
    shards = manifest.groupBy("shard").agg(F.sum("ids").alias("ids"))  # as many rows as tasks have written
    sums = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shards_before"))
    files = manifest.join(F.broadcast(sums), "shard").select("path", (F.col("before") + F.col("shards_before")).alias("first"))
    return files.repartition(n, "path").mapInArrow(partial(_read, folder=folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all documents to ``folder`` (a new one in the shared folder) and give the index read back from the files."""
    folder = folder or new_path(docs.sparkSession, "ids")
    return read_index(write_ids(docs, folder), folder)
