"""Small helpers for operators that run Python on the executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import tidemark

BATCH = 4 << 20
#: Returns free heap pages to the system, where the C library can.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def with_code(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once for each Spark
    context, so that Python workers can import them wherever they start; and
    has Arrow batches cut at ``BATCH`` bytes, as rows of whole texts differ in
    size by thousands."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_code", False):
        return
    top = os.path.dirname(os.path.abspath(tidemark.__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="run-"), "tidemark_code.zip")
    with zipfile.ZipFile(made, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tidemark", os.path.relpath(path, top)))
    sc.addPyFile(os.path.realpath(made))
    sc._tidemark_code = True


def extended(df: DataFrame, name: str, kind) -> StructType:
    """The schema of ``df`` with one more column; refuses a clash."""
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    if isinstance(kind, str):
        kind = StructType.fromDDL(f"`{name}` {kind}")[name].dataType
    return StructType([*df.schema.fields]).add(name, kind)


def slices(batch: pa.RecordBatch, col: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of the column, so
    that a run of very long texts is not held at once.  What a run took is
    given back to the system before the next: a worker that keeps it counts
    against its executor for as long as it lives."""
    if batch.num_rows <= 1 or batch.column(col).nbytes <= limit:
        yield batch
        pa.default_memory_pool().release_unused()
        if _TRIM:
            _TRIM(0)
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), col, limit)
    yield from slices(batch.slice(half), col, limit)
