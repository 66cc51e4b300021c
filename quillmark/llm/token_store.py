"""Operator 2, token-id output: documents' ids as seekable zstandard files.

A file holds one independent zstandard frame for each document, a last frame with the doc_ids, and at its end the
seek table of the public zstandard seekable format: a skippable frame with each frame's compressed size, decompressed
size and checksum (the low 32 bits of the XXH64 of its content). A reader fetches the table and the index, then only
the frames it wants, and checks each.

Files follow one another in ascending doc_id order, null ids first; rows with the same id follow by their ids' bytes.
A null or empty text has the end id alone. Extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, shared_files
from .tokens import encoder

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
#: Most frames a format file may have.
MOST_FRAMES = 0x8000000 - 1


class Writer:
    def __init__(self, out, level: int = 3) -> None:
        self.out, self.entries = out, []
        self.compressor = zstandard.ZstdCompressor(level=level)

    def frame(self, content: bytes) -> None:
        self.add(self.compressor.compress(content), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)

    def add(self, compressed: bytes, size: int, checksum: int) -> None:
        """A frame compressed elsewhere."""
        self.out.write(compressed)
        self.entries.append((len(compressed), size, checksum))

    def close(self) -> None:
        table = b"".join(struct.pack("<III", *x) for x in self.entries)
        body = table + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


class Reader:
    """Random access to the frames of a seekable file."""

    def __init__(self, source) -> None:
        self.source, size = source, source.size()
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums")
        source.seek(size - 9 - 12 * n - 8)
        head = struct.unpack("<II", source.read(8))
        if head != (SKIPPABLE_MAGIC, 12 * n + 9):
            raise ValueError("the seek table's size is wrong")
        self.table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        self.decompressor = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.table)

    def frame(self, k: int, compressed: bytes | None = None) -> bytes:
        if compressed is None:
            self.source.seek(int(self.at[k]))
            compressed = self.source.read(int(self.table[k, 0]))
        content = self.decompressor.decompress(compressed, max_output_size=max(1, int(self.table[k, 1])))
        if len(content) != self.table[k, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def doc_ids(self) -> list[int | None]:
        """Null ids are marked in a bitmap after the ids."""
        raw = self.frame(len(self) - 1)
        n = len(self) - 1
        ids, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "u1", n, 8 * n)
        return [None if z else int(i) for i, z in zip(ids, null, strict=True)]

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """Ids of all documents in file order, or of the wanted ones; only their frames are decompressed."""
        for k, doc_id in enumerate(self.doc_ids()):
            if wanted is None or doc_id in wanted:
                yield doc_id, self.frame(k)


def encode(docs: DataFrame, tokenizer: str, end_id: int, special_as_text: bool = False) -> DataFrame:
    """(doc_id, size, checksum, frame): every document as one compressed frame."""

    def run(batches):
        enc, compressor = encoder(tokenizer, special_as_text), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            body, offsets = common.text_column(batch.column("text"))
            for a, b in common.pieces(offsets):
                ids, bounds = enc.encode(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
                data, at = memoryview(ids.astype("<u4").view(np.uint8)), (4 * bounds).tolist()
                contents = [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(4 * np.diff(bounds)),
                        pa.array([xxhash.xxh64_intdigest(c) & 0xFFFFFFFF for c in contents], pa.int64()),
                        pa.array(map(compressor.compress, contents), pa.binary()),
                    ],
                    ["doc_id", "size", "checksum", "frame"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, size long, checksum long, frame binary")


def _in_order(docs: DataFrame, frames: DataFrame, files: int) -> DataFrame:
    """``frames`` in ``files`` ranges of ascending doc_id, bounds taken from the ids alone so that texts are read once."""
    cuts = docs.select(F.col("doc_id").cast("long").alias("d")).where("d is not null").approxQuantile("d", [k / files for k in range(1, files)], 0.2 / files)
    cuts = sorted({int(c) for c in cuts})
    part = F.lit(0)
    if cuts:
        # the number of cuts at or below the id, by halves of the sorted list
        def place(lo: int, hi: int):
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(F.col("doc_id") < F.lit(cuts[mid]), place(lo, mid)).otherwise(place(mid + 1, hi))

        part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place(0, len(cuts)))
    return frames.repartitionById(len(cuts) + 1, part.cast("int")).sortWithinPartitions("doc_id", "size", "checksum", "frame")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, special_as_text: bool = False, files: int | None = None) -> DataFrame:
    """Write the files; returns the manifest (part, seq, path, documents, tokens), which names those that count."""
    spark = docs.sparkSession
    common.prepare(spark)
    files = files or common.shuffle_partitions(spark)
    frames = _in_order(docs, encode(docs, tokenizer, end_id, special_as_text), files)

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        rows = (r for b in batches for r in zip(*(b.column(c) for c in ("doc_id", "size", "checksum", "frame")), strict=True))
        row = next(rows, None)
        while row is not None:
            ids, tokens = [], 0
            with shared_files.new_file(folder, f"ids-{part:06d}-{seq:04d}", ".zst") as (path, out):
                w = Writer(out)
                while row is not None and len(ids) < MOST_FRAMES:
                    doc_id, size, checksum, frame = (x.as_py() for x in row)
                    w.add(frame, size, checksum)
                    ids.append(doc_id)
                    tokens += size // 4
                    row = next(rows, None)
                w.frame(np.array([i or 0 for i in ids], "<i8").tobytes() + np.array([i is None for i in ids], "u1").tobytes())
                w.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": path, "documents": len(ids), "tokens": tokens}], schema=manifest)
            seq += 1

    manifest = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
    return common.held(frames.mapInArrow(run, "part int, seq int, path string, documents long, tokens long"))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` of a file is the sum of the files before it: one row a file, so one task's window over the manifest.
    """
    from pyspark.sql import Window

    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long")).select("path", "first")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with shared_files.opened(row["path"]) as source:
                    reader, at = Reader(source), row["first"]
                    out = []
                    for doc_id, content in reader.documents():
                        out.append((doc_id, at, len(content) // 4, zlib.crc32(content)))
                        at += len(content) // 4
                for first in range(0, len(out), 20_000):
                    cols = list(zip(*out[first : first + 20_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return files.repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to a scratch folder, read the files back, and hold what they say."""
    folder = common.scratch(spark, "token-ids")
    out = common.held(read(spark, write(docs, folder, tokenizer, end_id)))
    common.drop(spark, folder)
    return out
