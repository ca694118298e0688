"""CSV records with line ends in their values, split so that many tasks read one file.

Whether a line end closes a record depends on the number of quotes before it in the file: inside
quotes it belongs to a value. Each block of a file is read twice. First every task counts, for
its block, whether the quotes are odd and how many records would end in it, for either state it
may begin in. One row a block gives, by prefix sums, the true state and the number of records
before each block. Then every task puts its own records together; only the ends of a record that
crosses a block's border leave their task, to be joined by the block it began in.

A doubled quote inside a value leaves the parity as it is, so this holds for files that escape
quotes by doubling them, which is what tables.py writes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.sources.staging import stage

_LINES = "file STRING, block BIGINT, value STRING"
_BLOCKS = "file STRING, block BIGINT, odd INT, ends_out BIGINT, ends_in BIGINT, closed_out BOOLEAN, closed_in BOOLEAN"
_RECORDS = "file STRING, block BIGINT, number BIGINT, part INT, record STRING"
# What a row of a block's records is: a whole record, the end of one begun before, or the start of one.
WHOLE, END, START = 0, 1, 2


def _lines(spark: SparkSession, location: str) -> DataFrame:
    """Lines as they are, in file order inside each block."""
    text = spark.read.option("lineSep", "\n").text(location)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(given: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of a batch, cut where another block begins."""
    for batch in given:
        if not batch.num_rows:
            continue
        blocks = batch.column(1).to_numpy()
        names = batch.column(0)
        change = (blocks[1:] != blocks[:-1]) | pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            yield (names[start].as_py(), int(blocks[start])), batch.column(2).slice(start, end - start)


def _odd(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1


def _blank(lines: pa.Array) -> np.ndarray:
    return pc.is_in(lines, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)


def _count(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list] = {}
    for key, lines in _runs(given):
        # Parity so far, records ended if the block begins outside of quotes, and if it begins inside.
        held = found.setdefault(key, [0, 0, 0, False, False])
        after = (held[0] + np.cumsum(_odd(lines))) & 1
        real = ~_blank(lines)
        held[1] += int(((after == 0) & real).sum())
        held[2] += int(((after == 1) & real).sum())
        held[3] |= bool((after == 0).any())
        held[4] |= bool((after == 1).any())
        held[0] = int(after[-1])
    columns = list(zip(*([*key, *held] for key, held in found.items()))) or [()] * 7
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["file", "block", "odd", "ends_out", "ends_in", "closed_out", "closed_in"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _put_together(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block_state struct columns, value) to records; lines of an open record wait for the next batch."""

    def rows(key: tuple, number: list[int], part: list[int], records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]] * n, pa.string()),
                pa.array([key[1]] * n, pa.int64()),
                pa.array(number, pa.int64()),
                pa.array(part, pa.int32()),
                records.cast(pa.string()),
            ],
            names=["file", "block", "number", "part", "record"],
        )

    key, state, number, waiting, crossing = None, 0, 0, [], False

    def rest() -> Iterator[pa.RecordBatch]:
        # What is open at the end of a block; one that crosses the whole block is the middle of a record.
        if waiting:
            text = pa.array(["\n".join(waiting)])
            yield rows(key, [number], [END if crossing else START], text)

    for batch in given:
        inside = dict(zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())))
        for here, lines in _runs([batch]):
            if here != key:
                yield from rest()
                key, waiting = here, []
                state, number = inside[here]
                crossing = bool(state)
            after = (state + np.cumsum(_odd(lines))) & 1
            closed = np.flatnonzero(after == 0)
            if not len(closed):
                waiting += lines.to_pylist()
                state = int(after[-1])
                continue
            state = int(after[-1])
            end = int(closed[-1]) + 1
            bounds = pa.array(np.append(0, closed + 1), pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(0, end)), "\n")
            if waiting:
                first = pa.array(["\n".join([*waiting, records[0].as_py()])])
                records = pa.concat_arrays([first, records.slice(1)])
            real = ~_blank(records)
            if crossing:
                real[0] = True  # the end of a longer record, even where it is an empty line
            numbers = number + np.cumsum(real) - 1
            parts = np.zeros(len(records), np.int32)
            if crossing:
                parts[0] = END
            keep = pa.array(real)
            yield rows(key, numbers[real].tolist(), parts[real].tolist(), records.filter(keep))
            number, crossing = number + int(real.sum()), False
            waiting = lines.slice(end).to_pylist()
    yield from rest()


def read_records(spark: SparkSession, location: str) -> DataFrame:
    """(file, number, record): every record of the files, numbered from 0 in each; empty lines are none."""
    lines = _lines(spark, location)
    counted = stage(lines.mapInArrow(_count, _BLOCKS), "blocks")
    # One row for each block of a file, of spark.sql.files.maxPartitionBytes.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = counted.withColumn("inside", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    states = states.withColumn("ends", F.when(F.col("inside") == 1, F.col("ends_in")).otherwise(F.col("ends_out")))
    states = states.withColumn("closed", F.when(F.col("inside") == 1, F.col("closed_in")).otherwise(F.col("closed_out")))
    begins = F.when((F.col("odd") + F.col("inside")) % 2 == 1, F.when(F.col("closed") | (F.col("inside") == 0), F.col("block")))
    blocks = stage(
        states.select(
            "file",
            "block",
            "inside",
            F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("first"),
            # The block that began what is open where this one begins.
            F.last(begins, ignorenulls=True).over(before).alias("begun"),
        ),
        "block-states",
    )
    stated = lines.join(F.broadcast(blocks.drop("begun")), ["file", "block"]).select("file", "block", "value", "inside", "first")
    found = stage(stated.mapInArrow(_put_together, _RECORDS), "records")
    whole = found.where(F.col("part") == WHOLE).select("file", "number", "record")
    pieces = found.where(F.col("part") != WHOLE).join(F.broadcast(blocks.select("file", "block", "begun")), ["file", "block"])
    group = F.when(F.col("part") == START, F.col("block")).otherwise(F.col("begun"))
    joined = (
        pieces.withColumn("group", group)
        .groupBy("file", "group")
        .agg(F.sort_array(F.collect_list(F.struct("block", "number", "record"))).alias("parts"))
        .select(
            "file",
            F.element_at("parts", -1)["number"].alias("number"),
            F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
        )
    )
    return whole.unionByName(joined)


def parsed(records: DataFrame, schema: str, options: dict[str, str]) -> DataFrame:
    """The columns of the records, beside file and number; the first record of every file is its header."""
    fields = F.from_csv(F.regexp_replace("record", r"\r\z", ""), schema, options)
    return records.where("number > 0").select("file", "number", fields.alias("_row")).select("file", "number", "_row.*")
