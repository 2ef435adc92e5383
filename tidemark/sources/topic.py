"""A replayable topic in files, on Spark's Python data source API: no server.

A micro-batch that is written becomes one segment: its tasks write part files, and the commit puts a manifest
that names them.  Segments are numbered in the order of their commits and never change, so an offset is the number of segments
taken in.  A batch that is committed again after a failure finds its manifest and adds nothing; part files that no manifest
names are never read.

A topic has one writing query at a time; any number may read.  Paths may be of any file system pyarrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

FORMAT = "segments"
READ_BYTES = 1 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Part(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    part: str | None


class Topic:
    """The manifests of a topic: `manifests/<number>-<writer>-<batch>`."""

    def __init__(self, path: str) -> None:
        self.files, self.path = _opened(path)

    def manifests(self) -> dict[int, tuple[str, str]]:
        """Segment number -> name of the manifest and what wrote it."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/manifests", allow_not_found=True))
        names = [i.base_name for i in found if i.is_file and not i.base_name.startswith(("_", "."))]
        return {int(n.split("-", 1)[0]): (n, n.split("-", 1)[1]) for n in names}

    def count(self) -> int:
        return max(self.manifests(), default=-1) + 1

    def parts(self, number: int) -> list[str]:
        with self.files.open_input_stream(f"{self.path}/manifests/{self.manifests()[number][0]}") as stream:
            return [f"{self.path}/parts/{name}" for name in json.loads(stream.read())]

    def write_part(self, values: Iterator[str]) -> str | None:
        name = f"{uuid.uuid4().hex}.txt"
        first = next(values, None)
        if first is None:
            return None
        self.files.create_dir(f"{self.path}/parts")
        with self.files.open_output_stream(f"{self.path}/parts/{name}") as out:
            out.write(json.dumps(first).encode() + b"\n")
            for value in values:
                out.write(json.dumps(value).encode() + b"\n")
        return name

    def commit(self, parts: list[str], writer: str, batch: int) -> None:
        known = self.manifests()
        if any(by == f"{writer}-{batch}" for _, by in known.values()) or not parts:
            return
        self.files.create_dir(f"{self.path}/manifests")
        draft = f"{self.path}/manifests/_{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as out:
            out.write(json.dumps(parts).encode())
        self.files.move(draft, f"{self.path}/manifests/{max(known, default=-1) + 1}-{writer}-{batch}")


class TopicReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str) -> None:
        if starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is earliest or latest")
        self.path, self.starting = path, starting

    def initialOffset(self) -> dict:
        """Asked for only where the checkpoint holds no offset yet."""
        return {"segment": 0 if self.starting == "earliest" else Topic(self.path).count()}

    def latestOffset(self) -> dict:
        return {"segment": Topic(self.path).count()}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        topic = Topic(self.path)
        return [Part(p) for number in range(start["segment"], end["segment"]) for p in topic.parts(number)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(self.path)
        rest = b""
        with files.open_input_stream(partition.path) as stream:
            while block := stream.read(READ_BYTES):
                *lines, rest = (rest + block).split(b"\n")
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array([json.loads(x) for x in lines], pa.string())], names=["value"])

    def commit(self, end: dict) -> None:
        pass


class TopicWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str) -> None:
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        values = (v for batch in iterator for v in batch.column(batch.schema.get_field_index("value")).to_pylist() if v is not None)
        return Written(Topic(self.path).write_part(values))

    def commit(self, messages: list[Written], batchId: int) -> None:
        Topic(self.path).commit([m.part for m in messages if m is not None and m.part], self.writer, batchId)

    def abort(self, messages: list[Written], batchId: int) -> None:
        pass


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"], self.options.get("startingoffsets", "latest"))

    def streamWriter(self, schema, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options["path"], self.options.get("writer", "0"))


def read_topic(spark: SparkSession, path: str, starting: str = "latest") -> DataFrame:
    """Stream of the topic's messages in column `value`; a restart goes on at the offset its checkpoint holds.

    `starting` tells where a query without a checkpoint begins: at `earliest` or `latest`.
    """
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format(FORMAT).option("startingOffsets", starting).load(path)


def publish_stream(messages: DataFrame, path: str, writer: str = "0") -> DataStreamWriter:
    """Writer of a stream's column `value` to a topic.  `writer` names the checkpoint folder's series of batches."""
    messages.sparkSession.dataSource.register(SegmentSource)
    return messages.select("value").writeStream.format(FORMAT).option("path", path).option("writer", writer)
