"""What the operators share: the scratch folder, written tables, Arrow column access."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver and they share a disk.

    On a cluster the package is installed or sent with ``--py-files``; the extra path is then simply absent there.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Only where the setting is absent (a local session, as in tests) a temporary folder takes its place.
    """
    prepare(spark)
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillmark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quillmark/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(spark: SparkSession, *uris: str) -> None:
    """Delete scratch folders that no later plan reads."""
    for uri in uris:
        path, fs = _hadoop_path(spark, uri)
        fs.delete(path, True)


def written(df: DataFrame, uri: str) -> DataFrame:
    """``df`` as a Parquet table at ``uri``: lineage ends there, and later plans prune its columns."""
    df.write.mode("overwrite").parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def held(df: DataFrame) -> DataFrame:
    """``df`` in the reliable checkpoint folder, cleaned once no plan refers to it."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        scratch(df.sparkSession, "checkpoint")
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; it counts no further."""
    return df.limit(limit + 1).count() <= limit


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null's bytes, if any, do not count
        lengths = np.where(np.asarray(column.is_valid()), np.diff(at), 0)
        if int(lengths.sum()) != int(at[-1] - at[0]):
            return text_column(column.fill_null(""))
    return body[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def filtered(docs: DataFrame, chosen: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` marks in each Arrow batch, with all their columns and without a shuffle."""

    def run(batches):
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(chosen(batch)))

    return docs.mapInArrow(run, docs.schema)


def stable_order(*cols: str):
    """A deterministic pseudo-random order key of a row."""
    return F.xxhash64(*[F.col(c).cast("string") for c in cols])
