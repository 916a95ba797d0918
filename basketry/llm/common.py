"""What the corpus operators share: input columns, kept tables and Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows in an Arrow batch: whole texts travel in batches, so a batch must stay small with long texts.
BATCH_ROWS = 512
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that the driver and all executors see: below ``spark.checkpoint.dir``, else in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write rows once to the shared folder and read them back: a lost executor takes nothing with it."""
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.kept_in = (path,)
    return table


def drop(*tables: DataFrame) -> None:
    """Remove kept tables that nothing will read again: what was made of them has been kept itself."""
    for table in tables:
        spark = table.sparkSession
        for path in getattr(table, "kept_in", ()):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release() -> None:
    """Give memory that a task has freed back to the system: workers live on, and one executor has several."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do without
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over batches of at most BATCH_ROWS rows."""
    spark = df.sparkSession
    if int(spark.conf.get(BATCH_CONF)) > BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return df.mapInArrow(task, schema)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a Spark schema string, for batches made in tasks. To be called on the driver."""
    return to_arrow_schema(StructType.fromDDL(schema))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. A null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and its offsets (rows + 1); a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    at = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    at = at.astype(np.int64)
    return data[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes, one longer text at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)
