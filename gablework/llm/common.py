"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch handed to Python; whole texts can be long, so batches stay bounded.
BATCH_ROWS, BATCH_BYTES = 6000, 4 << 20


def give_back() -> None:
    """Give free memory back to the system."""
    pa.default_memory_pool().release_unused()
    # The C library keeps what was freed unless it is asked; other libraries have no such call.
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f for mapInArrow, giving free memory back after each BATCH_BYTES of its input and at its task's end: what batches
    leave behind doesn't add up, and a worker lives on between stages."""

    def spaced(batches: Iterator) -> Iterator:
        held = 0
        for batch in batches:
            held += batch.nbytes
            yield batch
            del batch
            if held >= BATCH_BYTES:
                give_back()
                held = 0

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(spaced(batches))
        finally:
            give_back()

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts can hold, so that long documents don't fill a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    The setting is read from the session. Only a local session without one (tests) gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            base = set_dir.get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            base = tempfile.mkdtemp(prefix="spark-")
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/gablework/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files: Spark deletes a write's own at its end. Else they stay until
    the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage and survives lost executors."""
    return Scratch(df.sparkSession).table(df, name)


class Scratch:
    """Tables in the shared folder that an operator needs for a while."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def table(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """df, written to the shared folder (in Spark's usual compression if none is named) and read again."""
        path = shared_dir(self.spark, name)
        with swept(self.spark):
            df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((path, out))
        return out

    def drop(self, *keep: DataFrame) -> None:
        """Delete all tables but those that are still read."""
        stays = {id(x) for x in keep}
        for path, out in self.held:
            if id(out) not in stays:
                remove(self.spark, path)
        self.held = [x for x in self.held if id(x[1]) in stays]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def with_lit_crc(column: Column) -> Column:
    """Unsigned crc32 of a value's text."""
    return F.crc32(column.cast("string").cast("binary"))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column (nulls as empty) and the offsets of its rows, without copying rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if offs is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def crc_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated arange(s, s + n) for each start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return out + np.arange(total)
