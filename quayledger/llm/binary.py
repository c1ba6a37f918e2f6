"""Token files in directly addressable codes: any token is read without decoding a block."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayledger.llm.shared import Workspace, slices, texts_of
from quayledger.llm.tokens import RUN_BYTES, words_of

#: File: MAGIC, then the numbers of documents, tokens and levels as int64, the documents' ids (int64, the smallest for null)
#: and first tokens (int64, one more at the end), then for each level its number of chunks (int64), the chunks (one byte each),
#: the continuation bitmap (bit k: chunk k goes on in the next level), and the set bits before each BLOCK of it (int64).
MAGIC, BLOCK = b"TOKDAC01", 512
NO_ID = -(1 << 63)
#: First characters of a text by which the rows of one doc_id are dealt; short, since a sample of them goes to the driver.
DEALT = 64


def encode_file(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A file of the documents' ids. Level k holds byte k of every id that has more than k bytes."""
    values = np.concatenate([np.zeros(0, "<u4"), *ids]).astype("<u4")
    starts = np.cumsum([0, *map(len, ids)])
    levels, part = [], values
    while part.size or not levels:
        more = part >> 8 > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, BLOCK // 8)).sum(1, dtype=np.int64)
        levels.append(struct.pack("<q", part.size) + (part & 255).astype(np.uint8).tobytes() + bits.tobytes() + (np.cumsum(ones) - ones).astype("<i8").tobytes())
        part = part[more] >> 8
    head = struct.pack("<qqq", len(doc_ids), values.size, len(levels))
    keys = np.array([NO_ID if d is None else d for d in doc_ids], "<i8").tobytes()
    return MAGIC + head + keys + starts.astype("<i8").tobytes() + b"".join(levels)


class TokenFile:
    """A file's content; token(i) reads one chunk, bit and count per level, ids(first, last) a run of tokens."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        docs, self.tokens, depth = struct.unpack_from("<qqq", data, 8)
        at = 32
        take = lambda kind, n: np.frombuffer(data, kind, n, at)
        self.doc_ids, at = take("<i8", docs), at + 8 * docs
        self.starts, at = take("<i8", docs + 1), at + 8 * (docs + 1)
        self.levels = []
        for _ in range(depth):
            (n,) = struct.unpack_from("<q", data, at)
            at += 8
            chunks, at = take(np.uint8, n), at + n
            wide = -(-n // BLOCK) * (BLOCK // 8)
            bits, at = take(np.uint8, wide), at + wide
            ranks, at = take("<i8", wide * 8 // BLOCK), at + wide * 64 // BLOCK
            self.levels.append((chunks, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit i."""
        _, bits, ranks = self.levels[level]
        if i >= 8 * len(bits):
            return int(ranks[-1]) + int(np.bitwise_count(bits[-(BLOCK // 8) :]).sum()) if len(ranks) else 0
        block = i // BLOCK * (BLOCK // 8)
        whole = int(np.bitwise_count(bits[block : i // 8]).sum())
        return int(ranks[i // BLOCK]) + whole + int(bits[i // 8] & ((1 << i % 8) - 1)).bit_count()

    def token(self, i: int) -> int:
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def ids(self, first: int, last: int) -> np.ndarray:
        out = np.zeros(last - first, "<u4")
        on = np.arange(last - first)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if not on.size:
                break
            out[on] |= chunks[first:last].astype("<u4") << 8 * level
            byte = first // 8
            more = np.unpackbits(bits[byte : -(-last // 8)], bitorder="little")[first - 8 * byte :][: last - first].astype(bool)
            on = on[more]
            first = self._rank(level, first)
            last = first + on.size
        return out


def write_files(docs: DataFrame, folder: str, end_id: int = 2, path: str | None = None, file_tokens: int = 4_000_000) -> DataFrame:
    """Write all documents in ascending doc_id order to files `folder`/<partition>-<number>.tok; a row per file once it runs.

    Documents are dealt by ranges of doc_id and the text's first DEALT characters, so the files' names give the order and the
    rows of one id, or of none, are many tasks' work unless their texts begin alike. A task holds one file's tokens at a time. A file
    is written under another name and then moved, so a task that runs twice leaves one file. Null doc_ids come first, equal
    ones are ordered by their texts."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = words_of(path), end_id.to_bytes(4, "little")
        store, root = fs.FileSystem.from_uri(folder)
        part, number, held, doc_ids, ids = TaskContext.get().partitionId(), 0, 0, [], []

        def flush() -> pa.RecordBatch:
            name = f"{root}/{part:08d}-{number:08d}.tok"
            other = f"{root}/_{uuid.uuid4().hex}"
            with store.open_output_stream(other) as f:
                f.write(encode_file(doc_ids, ids))
            store.move(other, name)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "tokens": pa.array([held], pa.int64())})

        store.create_dir(root, recursive=True)
        for some, texts in slices(batches, RUN_BYTES):
            for doc, data in zip(some, words.encode_all(texts)):
                doc_ids.append(doc)
                ids.append(np.frombuffer(data + end, "<u4"))
                held += len(ids[-1])
                if held >= file_tokens:
                    yield flush()
                    number, held, doc_ids, ids = number + 1, 0, [], []
        if doc_ids:
            yield flush()

    ordered = texts_of(docs).repartitionByRange("doc_id", F.substring("text", 1, DEALT)).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(write, "part long, number long, tokens long")


def read_files(spark, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document in the files. `files`: what write_files returned."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                part, number = name.rsplit("/", 1)[1][:-4].split("-")
                f = TokenFile(content.as_buffer())
                for a in range(0, len(f.doc_ids), 512):
                    rows = [(int(d), int(s), f.ids(int(s), int(e)).tobytes()) for d, s, e in zip(f.doc_ids[a : a + 512], f.starts[a : a + 512], f.starts[a + 1 : a + 513])]
                    n = len(rows)
                    columns = [[int(part)] * n, [int(number)] * n, [None if d == NO_ID else d for d, _, _ in rows], [s for _, s, _ in rows], [len(x) // 4 for *_, x in rows], [zlib.crc32(x) for *_, x in rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array([x for *_, x in rows], pa.binary())], names=["part", "number", "doc_id", "in_file", "n_tokens", "ids_crc32", "ids"])

    # A row per file; sums by partition of the write and within it, so no task sees all files of a large corpus.
    parts = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    firsts = files.join(parts, "part").select("part", "number", (F.col("before_part") + F.sum("tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("tokens")).alias("first"))
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    found = found.mapInArrow(read, "part long, number long, doc_id long, in_file long, n_tokens long, ids_crc32 long, ids binary")
    return found.join(firsts, ["part", "number"]).select("doc_id", (F.col("first") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32", "ids")


def token_files(docs: DataFrame, ws: Workspace, end_id: int = 2, path: str | None = None, file_tokens: int = 4_000_000) -> DataFrame:
    """Write the token files of all documents and read them back, a row per document.

    Null texts are empty documents of the end id alone; null doc_ids and repeated rows keep a place of their own; an empty
    table leaves no file and no rows."""
    folder = ws.path("tokens")
    files = ws.save(write_files(docs, folder, end_id, path, file_tokens), "files")
    if files.isEmpty():
        return ws.spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return read_files(ws.spark, folder, files)
