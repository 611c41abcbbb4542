"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import time
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.session import scratch_path

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` cuts UTF-8 at exactly these characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), under private names."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def id_remainder(col: Column, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; the split used for held-out rows."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)


def id_remainder_py(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def stored(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts lineage, and a lost
    executor costs a re-read only."""
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps whose results are stored.

    Two rounds: Python's references to a finished plan go first, and the plan's own references with the next one.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def lay_out(ids: list[bytes], unit: np.ndarray, cuts: np.ndarray, dtype: str) -> list[bytes]:
    """The joined ids of each text: ``ids`` of the distinct units, the unit at each place, and the texts' first places and the end."""
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(dtype).itemsize
    start, n = np.cumsum(size) - size, size[unit]
    end = np.concatenate([[0], np.cumsum(n)])
    laid = np.frombuffer(b"".join(ids), dtype)[np.arange(end[-1]) + np.repeat(start[unit] - end[:-1], n)]
    at = end[cuts].tolist()
    return [laid[lo:hi].tobytes() for lo, hi in zip(at, at[1:])]


def byte_letters() -> dict[int, str]:
    """Byte -> the character that stands for it in byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the others for the characters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BoundedCache(dict):
    """A dict of at most ``2 * entries`` items that computes what it lacks.  Two generations: entries in use survive a
    turn-over."""

    def __init__(self, compute, entries: int):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
