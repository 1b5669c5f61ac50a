"""Token ids in binary files: one zstandard frame per document, one dictionary for all.

A file holds consecutive documents in ascending doc_id order::

    magic "TMTOK001" | sha256 of the dictionary (32 bytes) | frames | index | index offset (8) | documents (8) | magic

and an index entry is doc_id, frame offset, number of ids, doc position of its first id in the file (4 x 8 bytes,
little-endian; a negative number of ids marks a document without doc_id).  A frame compresses the ids as little-endian unsigned 16-bit integers, or 32-bit ones if the
vocabulary needs them (flag byte in front), so a short document is read with one range request.

Files are written by tasks through the Arrow file systems (local mounts, object stores, HDFS), each attempt
under its own name; the manifest lists the files of the attempts that Spark accepted, so a lost executor leaves at most an
unlisted file.  The dictionary is trained on a bounded sample; null and empty texts hold the end id only;
repeated rows stay; rows without doc_id come first and come back without one; an empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from trackmetrics.llm.bpe import encoded_batches
from trackmetrics.session import materialise, work_folder

MAGIC = b"TMTOK001"
END_ID = 2
#: Bounds of the training sample of the dictionary: documents (chosen by a hash of the id; never twice as many), and the longest one taken.
SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MANIFEST = "file string, part int, first_doc long, last_doc long, docs long, ids long"


def open_file_system(path: str):
    """(file system, path in it) of a path or URI that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def serialise(raw: bytes) -> bytes:
    """Ids (unsigned 32-bit) with a width flag: 16 bits each where they fit."""
    ids = np.frombuffer(raw, dtype="<u4")
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x04" + raw


def deserialise(data: bytes) -> bytes:
    return data[1:] if data[0] == 4 else np.frombuffer(data, dtype="<u2", offset=1).astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """Dictionary from a bounded sample of whole documents; empty if the sample is too small to train on."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sample = docs.where((F.char_length(text) > 0) & (F.char_length(text) <= SAMPLE_CHARS)).select(text.alias("text"), F.xxhash64(F.col(id_col)).alias("h"))
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    chosen = sample.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).orderBy("h", "text").limit(2 * SAMPLE_DOCS)
    some = [r["text"] for r in chosen.select("text").collect()]
    arrays = [serialise(raw) for _, batch in encoded_batches(pa.array(some, pa.string()), vocabulary, end_id) for raw in batch]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:  # fewer samples than the trainer needs
        return b""


def _compressor(dictionary: bytes):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def write_store(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and the dictionary below ``folder``; returns the manifest, one row per file."""
    dictionary = train_dictionary(docs, vocabulary, end_id, id_col, text_col)
    files, root = open_file_system(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    digest = hashlib.sha256(dictionary).digest()

    def write(batches):
        from pyspark import TaskContext

        part, out, name = TaskContext.get().partitionId(), None, f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
        compress, index, at, ids = _compressor(dictionary).compress, [], len(MAGIC) + 32, 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, encoded in encoded_batches(batch.column("text"), vocabulary, end_id):
                if out is None:
                    local, path = open_file_system(folder)
                    out = local.open_output_stream(f"{path}/{name}")
                    out.write(MAGIC + digest)
                for k, raw in enumerate(encoded):
                    frame = compress(serialise(raw))
                    out.write(frame)
                    index.append((doc_ids[first + k].as_py(), at, len(raw) // 4, ids))
                    at, ids = at + len(frame), ids + len(raw) // 4
        if out is None:
            return
        table = np.array([(0, a, -n, s) if d is None else (d, a, n, s) for d, a, n, s in index], dtype="<i8")
        out.write(table.tobytes() + struct.pack("<QQ", at, len(index)) + MAGIC)
        out.close()
        known = [d for d, *_ in index if d is not None]
        yield pa.RecordBatch.from_pydict(
            {"file": [name], "part": [part], "first_doc": [min(known, default=None)], "last_doc": [max(known, default=None)], "docs": [len(index)], "ids": [ids]},
            schema=pa.schema([("file", pa.string()), ("part", pa.int32()), *[(c, pa.int64()) for c in ("first_doc", "last_doc", "docs", "ids")]]),
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialise(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_index(folder: str, file: str) -> tuple[np.ndarray, bytes]:
    """Index rows (doc_id, offset, ids, first id in the file) and dictionary hash of one file, without its frames."""
    files, root = open_file_system(folder)
    with files.open_input_file(f"{root}/{file}") as f:
        size = f.size()
        tail = f.read_at(24, size - 24)
        at, n = struct.unpack("<QQ", tail[:16])
        head = f.read_at(len(MAGIC) + 32, 0)
        if tail[16:] != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{file} is not a token file")
        return np.frombuffer(f.read_at(32 * n, at), dtype="<i8").reshape(n, 4), head[len(MAGIC) :]


def read_document(folder: str, file: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document by its index entry: reads the index and one frame."""
    index, _ = read_index(folder, file)
    files, root = open_file_system(folder)
    with files.open_input_file(f"{root}/dictionary") as f:
        dictionary = f.read()
    rows = np.flatnonzero((index[:, 0] == doc_id) & (index[:, 2] > 0))
    if not len(rows):
        return None
    with files.open_input_file(f"{root}/{file}") as f:
        start = int(index[rows[0], 1])
        stop = int(index[rows[0] + 1, 1]) if rows[0] + 1 < len(index) else struct.unpack("<Q", f.read_at(8, f.size() - 24))[0]
        return np.frombuffer(deserialise(_decompressor(dictionary).decompress(f.read_at(stop - start, start))), dtype="<u4")


def read_store(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the listed files: doc_id, file, start (ids of all documents before), n_tokens, ids_crc32 (and ids)."""
    schema = "doc_id long, file string, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    arrow = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else []))
    files, root = open_file_system(folder)
    with files.open_input_file(f"{root}/dictionary") as f:
        dictionary = f.read()
    digest = hashlib.sha256(dictionary).digest()

    def read(batches):
        decompress = _decompressor(dictionary).decompress
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                index, found = read_index(folder, file)
                if found != digest:
                    raise ValueError(f"{file} was written with another dictionary")
                local, path = open_file_system(folder)
                with local.open_input_stream(f"{path}/{file}") as f:
                    f.read(len(MAGIC) + 32)
                    stops = [*index[1:, 1].tolist(), None]
                    for lo in range(0, len(index), 1000):
                        rows = {n: [] for n in arrow.names}
                        for (doc, at, n, s), stop in zip(index[lo : lo + 1000].tolist(), stops[lo : lo + 1000]):
                            # the last frame ends where the index begins; a frame ends by itself, so what follows is not read
                            raw = deserialise(decompress(f.read(stop - at)) if stop is not None else _last(decompress, f, index, path, local, file))
                            doc, n = (None, -n) if n < 0 else (doc, n)
                            if len(raw) != 4 * n:
                                raise ValueError(f"{file}: document {doc} has {len(raw) // 4} ids, its index says {n}")
                            for name, value in (("doc_id", doc), ("file", file), ("start", first + s), ("n_tokens", n), ("ids_crc32", zlib.crc32(raw))):
                                rows[name].append(value)
                            if with_ids:
                                rows["ids"].append(raw)
                        yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    # One row per file (tens of MB each): the running total needs the files in order, not the documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("part", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartition(tasks, "file").select("file", "start").mapInArrow(read, schema)


def _last(decompress, stream, index, path, local, file) -> bytes:
    with local.open_input_file(f"{path}/{file}") as f:
        end = struct.unpack("<Q", f.read_at(8, f.size() - 24))[0]
    return decompress(stream.read(end - int(index[-1, 1])))


def tokenise_to_files(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Write the corpus to token files and read it back; ``folder`` defaults to a new one in the shared work folder."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "tokens")
    return read_store(spark, folder, write_store(docs, folder, vocabulary, end_id), with_ids)
