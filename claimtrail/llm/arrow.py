"""Arrow functions over partitions, with batches that fit small executors."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_ROWS = 1_000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow(function, schema)`` on batches of at most ``BATCH_ROWS`` rows.

    Batches are cut by rows only, and the default of 10,000 holds too much text in the JVM and in Python at a time; a session that
    allows more is set to ``BATCH_ROWS``. A worker gives memory that it no longer uses back after each task.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(SETTING)) <= BATCH_ROWS:
        conf.set(SETTING, BATCH_ROWS)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(AttributeError, OSError):  # only the GNU C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)
