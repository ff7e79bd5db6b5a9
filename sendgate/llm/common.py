"""Small helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import SparkSession

# A batch of rows sent to a Python worker, or back, holds about so many bytes at most.
BATCH_BYTES = 1 << 20
# A task that writes texts holds a row group of this size before it goes to the file.
ROW_GROUP_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what executors and their Python workers hold of long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("parquet.block.size", str(ROW_GROUP_BYTES))


def return_memory() -> None:
    """Give what this worker has freed back to the machine: it is kept for later tasks, which need less."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has its own ways
        pass


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name like ``name`` that is not taken."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name = f"_{name}"
    return name
