"""Token-id files: a documents' table and independently coded, checksummed blocks of ids."""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, SLICE_ROWS, TEXT, keyed_texts
from reachmark.llm.mixing_coder import Mixture, checksum, decode_blocks, encode_learned
from reachmark.llm.tokens import word_encoder
from reachmark.runtime import materialize, scratch_path

MAGIC = b"RTOK0002"
#: Ids of a block, and blocks that are coded side by side: what a task holds at a time.
BLOCK, LANES = 1024, 8192
_NULL = -(1 << 63)


def segment(keys: list[int], rows: list[np.ndarray]) -> bytes:
    """Documents as bytes: sizes; keys, lengths and the blocks' mixture (deflated, checksummed); block table, blocks."""
    lengths = np.array(list(map(len, rows)), "<u4")
    ids = np.concatenate(rows) if rows else np.zeros(0, "<u4")
    blocks = [ids[a : a + BLOCK] for a in range(0, len(ids), BLOCK)]
    payloads, mixture = encode_learned(blocks)
    table = zlib.compress(np.array(keys, "<i8").tobytes() + lengths.tobytes() + mixture.to_bytes(), 1)
    head = struct.pack("<IIQII", len(rows), len(blocks), len(ids), len(table), zlib.crc32(table))
    entries = np.array([(len(b), len(p), checksum(b)) for b, p in zip(blocks, payloads, strict=True)], "<u4").reshape(-1, 3)
    return b"".join([head, table, entries.tobytes(), *payloads])


def segments(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, lengths, ids) of every segment of a file; raises if a checksum does not hold."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    at, size = 8, struct.calcsize("<IIQII")
    while at < len(data):
        docs, blocks, total, width, crc = struct.unpack_from("<IIQII", data, at)
        table = data[at + size : at + size + width]
        if zlib.crc32(table) != crc:
            raise ValueError("the table of documents is damaged")
        raw = zlib.decompress(table)
        at += size + width
        entries = np.frombuffer(data, "<u4", 3 * blocks, at).reshape(-1, 3)
        at += 12 * blocks
        edges = at + np.concatenate(([0], np.cumsum(entries[:, 1], dtype=np.int64)))
        parts = decode_blocks([data[a:b] for a, b in zip(edges, edges[1:])], entries[:, 0].tolist(), Mixture.from_bytes(raw[12 * docs :]))
        if any(checksum(p) != c for p, c in zip(parts, entries[:, 2].tolist(), strict=True)):
            raise ValueError("a block is damaged")
        at = int(edges[-1])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if len(ids) != total:
            raise ValueError("blocks are missing")
        yield np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "<u4", docs, 8 * docs), ids


def write_files(docs: DataFrame, path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts into files in ``folder``, in ascending order of ``key`` (integers, null
    first); one row per file: ``name, first, docs, tokens``.

    Files hold ranges of keys. Each is written whole under a name of its own by the task that
    returns its row, so what a lost or repeated task leaves is not in the result. ``folder`` has
    to be reachable for all executors.
    """
    src = keyed_texts(docs, key, text).select(F.coalesce(F.col(KEY).cast("bigint"), F.lit(_NULL)).alias(KEY), TEXT)
    dealt = src.repartitionByRange(KEY).sortWithinPartitions(KEY, F.xxhash64(TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        enc = word_encoder(path)
        name, out = f"{uuid.uuid4().hex}.tok", None
        keys, rows, held, first, docs, tokens = [], [], 0, None, 0, 0

        def flush() -> None:
            nonlocal keys, rows, held, out
            if out is None:
                out = store.open_output_stream(posixpath.join(at, name))
                out.write(MAGIC)
            out.write(segment(keys, rows))
            keys, rows, held = [], [], 0

        parts = (batch.slice(a, SLICE_ROWS) for batch in batches for a in range(0, batch.num_rows, SLICE_ROWS))
        for part in parts:
            for k, ids in zip(part.column(0).to_pylist(), enc.encode_all(part.column(1).to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = k if first is None else first
                keys.append(k)
                rows.append(ids)
                held, docs, tokens = held + len(ids), docs + 1, tokens + len(ids)
                if held >= BLOCK * LANES:
                    flush()
        if rows:
            flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"name": [name], "first": pa.array([first], pa.int64()), "docs": pa.array([docs], pa.int64()), "tokens": pa.array([tokens], pa.int64())}
            )

    return materialize(dealt.mapInArrow(run, "name string, first bigint, docs bigint, tokens bigint"), "files")


def _from_files(files: DataFrame, folder: str, fields: str, columns: Callable[[np.ndarray, np.ndarray], list[pa.Array]]) -> DataFrame:
    """``_key, start, n_tokens`` and ``fields``: ``columns`` of the edges of a segment's documents and its ids."""
    spark = files.sparkSession
    at, rows = 0, []
    for f in sorted(files.collect(), key=lambda f: f["first"]):  # one short row per file
        rows.append((f["name"], at))
        at += f["tokens"]
    bases = spark.createDataFrame(rows, "name string, base bigint")
    schema = f"{KEY} bigint, start bigint, n_tokens bigint, {fields}"
    names = [x.split()[0] for x in schema.split(", ")]
    if not rows:
        return spark.createDataFrame([], schema)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    found = found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "content").join(F.broadcast(bases), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, base in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for keys, lengths, ids in segments(content.as_py()):
                    edges = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                    own = pa.array([None if k == _NULL else k for k in keys.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(edges[:-1] + base), pa.array(lengths.astype(np.int64)), *columns(edges, ids)], names
                    )
                    base += len(ids)

    return found.select("content", "base").mapInArrow(run, schema)


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """``_key, start, n_tokens, ids`` of every document in the files, read and checked whole.

    ``files``: what ``write_files`` returned. ``start`` counts the ids of all documents before.
    """

    def columns(edges: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32)))]

    return _from_files(files, folder, "ids array<int>", columns)


def round_trip(docs: DataFrame, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents to files in the shared folder and read them back: ``_key, start,
    n_tokens, ids_crc32``. Null and empty texts are one end id. Repeated keys stay apart."""
    folder = scratch_path(docs.sparkSession, "tokens")

    def columns(edges: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        data = memoryview(ids.astype("<u4").tobytes())
        return [pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.int64())]

    return _from_files(write_files(docs, path, folder, end_id, key, text), folder, "ids_crc32 bigint", columns)
