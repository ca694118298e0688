"""Tables of one run that become visible together.

A run writes its tables under a version of its own, where nobody looks. One commit record names the
version and its tables; it gets the next free number, and the highest number is what readers see.
A run that breaks off before its record leaves the earlier version as it was, and a reader that
opened a version keeps it while later ones are written.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ledgerfold.sources.stores import open_store

_RECORD = re.compile(r"^([0-9]{10})\.json$")


class NoSnapshot(LookupError):
    """There is no committed version, or not this one."""


@dataclass(frozen=True)
class Snapshot:
    """A committed version: its number and where its tables are."""

    spark: SparkSession
    location: str
    number: int
    version: str
    schemas: dict[str, str]

    def table(self, name: str) -> DataFrame:
        if name not in self.schemas:
            raise NoSnapshot(f"version {self.number} of {self.location} has no table {name}")
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.location}/versions/{self.version}/{name}")


def _numbers(location: str) -> list[int]:
    store, path = open_store(f"{location}/commits")
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(int(m[1]) for info in found if (m := _RECORD.match(info.base_name)))


def open_snapshot(spark: SparkSession, location: str, number: int | None = None) -> Snapshot:
    """The last committed version, or the one of a number."""
    location = location.rstrip("/")
    numbers = _numbers(location)
    if not numbers or number is not None and number not in numbers:
        raise NoSnapshot(f"{location} has no version {'yet' if number is None else number}")
    chosen = numbers[-1] if number is None else number
    store, path = open_store(f"{location}/commits/{chosen:010}.json")
    with store.open_input_stream(path) as data:
        record = json.loads(data.read())
    return Snapshot(spark, location, chosen, record["version"], record["schemas"])


def _commit(location: str, record: dict) -> int:
    """Write the record under the next free number; two runs that commit at once get two numbers."""
    store, commits = open_store(f"{location}/commits")
    store.create_dir(commits, recursive=True)
    whole = f"{commits}/{record['version']}.tmp"
    with store.open_output_stream(whole) as out:
        out.write(json.dumps(record).encode())
    number = (_numbers(location) or [0])[-1] + 1
    try:
        while True:
            target = f"{commits}/{number:010}.json"
            if store.type_name == "local":
                try:
                    os.link(whole, target)
                    return number
                except FileExistsError:
                    number += 1
            elif store.get_file_info(target).type == fs.FileType.NotFound:
                # Stores without a create-if-absent: runs that commit at the same moment need a lock of their own.
                store.copy_file(whole, target)
                return number
            else:
                number += 1
    finally:
        store.delete_file(whole)  # our own, written above


def write_snapshot(spark: SparkSession, location: str, tables: dict[str, DataFrame]) -> Snapshot:
    """Write all tables, then make them visible at once; a failure before that changes nothing for readers."""
    location, version = location.rstrip("/"), uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{location}/versions/{version}/{name}")
    schemas = {name: df.schema.toDDL() for name, df in tables.items()}
    number = _commit(location, {"version": version, "schemas": schemas})
    return Snapshot(spark, location, number, version, schemas)
