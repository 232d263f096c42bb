"""A connector for tests: tables of one folder, read by file and written in two phases."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    file: str | None


def manifest(root: str, table: str) -> dict | None:
    path = f"{root}/{table}.json"
    return json.load(open(path)) if os.path.exists(path) else None


class Writer(DataSourceArrowWriter):
    def __init__(self, root: str, table: str, schema: StructType, overwrite: bool):
        self.root, self.table, self.schema, self.overwrite = root, table, schema.json(), overwrite

    def write(self, iterator) -> Written:
        batches = [b for b in iterator if b.num_rows]
        if not batches:
            return Written(None)
        name = f"{self.table}-{uuid.uuid4().hex}.parquet"
        pq.write_table(pa.Table.from_batches(batches), f"{self.root}/{name}")
        return Written(name)

    def commit(self, messages) -> None:
        old = manifest(self.root, self.table)
        files = [] if self.overwrite or old is None else old["files"]
        files += [m.file for m in messages if m is not None and m.file]
        temporary = f"{self.root}/{self.table}.{uuid.uuid4().hex}"
        with open(temporary, "w") as out:
            json.dump({"schema": self.schema, "files": files}, out)
        os.replace(temporary, f"{self.root}/{self.table}.json")

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and m.file:
                os.remove(f"{self.root}/{m.file}")


class Reader(DataSourceReader):
    def __init__(self, root: str, table: str):
        self.root, self.table = root, table

    def partitions(self):
        return [InputPartition(f) for f in manifest(self.root, self.table)["files"]] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is not None:
            yield from pq.read_table(f"{self.root}/{partition.value}").to_batches()


class Shelf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shelf"

    def schema(self):
        found = manifest(self.options["root"], self.options["table"])
        if found is None:
            raise ValueError(f"no such shelf: {self.options['table']}")
        return StructType.fromJson(json.loads(found["schema"]))

    def reader(self, schema):
        return Reader(self.options["root"], self.options["table"])

    def writer(self, schema, overwrite):
        return Writer(self.options["root"], self.options["table"], schema, overwrite)
