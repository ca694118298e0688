"""Arrow batches in parts of bounded size, for work that makes Python values of them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

PART_ROWS = 256
PART_BYTES = 4 << 20
SENT_BYTES = 2 << 20
SENT_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30}


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's limit of an Arrow batch to SENT_BYTES, unless it is lower already.

    Spark's limit is 64 MB, and an executor holds a batch several times over for each task: as Arrow vectors and as the
    buffer they are sent from in the JVM, then in the worker. Batches say nothing of results, so the setting stays.
    """
    told = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(SENT_LIMIT, "64m").strip().lower())
    if not told or int(told[1]) << _UNITS[told[2]] > SENT_BYTES:
        spark.conf.set(SENT_LIMIT, str(SENT_BYTES))


def small_parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in parts of at most PART_ROWS rows, which hold PART_BYTES of `column` at most, or one row.

    Parts are views of the batch, so that only one part at a time is there as Python values.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if at > start and (held + size > PART_BYTES or at - start == PART_ROWS):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += int(size)
        if start < len(sizes):
            yield batch.slice(start)
