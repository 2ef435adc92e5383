"""Stored upserts: an append log of versioned rows beside generations of its current state.

A micro-batch is appended to the log as one folder; nothing is rewritten.  Compaction merges the newest generation with the folders
after it into the next generation, one file for each bucket of the key.  A generation counts only once its marker
stands, and markers are put in place by one rename, so readers see a whole generation or the one before it.  Of the older state
the last generation and the folders it needs are kept, for readers that have begun with it; what is older goes.

One compaction runs at a time; readers and the writer of the log need not wait for it.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.sources.sinks import VERSION, latest_by_key

BUCKETS = 64


class Version(NamedTuple):
    run: int
    batch_id: int


# Before every version there is.
START = Version(-1, -1)


class Folder:
    """File operations below one path, through Spark's own file system classes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self._jvm = path, spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def found(self, pattern: str) -> list[str]:
        """Paths relative to the folder."""
        depth = pattern.count("/") + 1
        return ["/".join(s.getPath().toString().split("/")[-depth:]) for s in self._fs.globStatus(self._at(pattern)) or []]

    def put(self, name: str, text: str) -> None:
        """Write a small file that appears at once and whole, and must not be there yet."""
        draft = self._at(f"_draft-{name.replace('/', '-')}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        self._fs.mkdirs(self._at(name).getParent())
        if not self._fs.rename(draft, self._at(name)):
            raise FileExistsError(f"{self.path}/{name}")

    def get(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class Generations:
    """Numbered whole states of a table, each with a small note beside it."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, Folder(spark, path), keys, buckets

    def numbers(self) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in self.folder.found("ready/gen-*"))

    def note(self, number: int) -> dict:
        return json.loads(self.folder.get(f"ready/gen-{number}"))

    def read(self, number: int, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder.path}/gen-{number}").select(*schema.names)

    def write(self, rows: DataFrame, note: dict) -> int:
        """Store the next generation, let it count, and retire all but it and the one before."""
        before = self.numbers()
        number = (before[-1] if before else 0) + 1
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        # the bucket's folder is written over if an earlier attempt has left one without a marker
        rows.withColumn("_bucket", bucket).repartition(self.buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{self.folder.path}/gen-{number}")
        self.folder.put(f"ready/gen-{number}", json.dumps(note))
        for old in before[:-1]:
            self.folder.remove(f"ready/gen-{old}")
            self.folder.remove(f"gen-{old}")
        return number


class KeyedTable:
    """The current row of each key of the log at `log`, compacted under `base`.

    `schema` is that of the rows without their version (run, batch_id), which the log's folders carry.
    """

    def __init__(self, spark: SparkSession, log: str, base: str, keys: list[str], schema: StructType, buckets: int = BUCKETS) -> None:
        self.spark, self.keys = spark, keys
        self.log, self.generations = Folder(spark, log), Generations(spark, base, keys, buckets)
        self.schema = StructType([*schema.fields, *[StructField(c, LongType()) for c in VERSION]])

    def versions(self) -> list[Version]:
        """Those of the log's finished folders, rising."""
        found = self.log.found("run=*/batch_id=*/_SUCCESS")
        return sorted(Version(*(int(part.split("=")[1]) for part in name.split("/")[:2])) for name in found)

    def newest(self) -> Version:
        """The newest version that readers can see."""
        return max([START, *self.versions(), *[self._merged(n) for n in self.generations.numbers()[-1:]]])

    def _merged(self, number: int) -> Version:
        """The last version that a generation holds."""
        return Version(*self.generations.note(number)["merged"])

    def _log_rows(self, after: Version, upto: Version) -> DataFrame:
        paths = [f"{self.log.path}/run={v.run}/batch_id={v.batch_id}" for v in self.versions() if after < v <= upto]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.log.path).parquet(*paths)

    def _rows(self, upto: Version) -> DataFrame:
        numbers = self.generations.numbers()
        if not numbers:
            return self._log_rows(START, upto)
        base = self.generations.read(numbers[-1], self.schema)
        return base.unionByName(self._log_rows(self._merged(numbers[-1]), upto))

    def current(self) -> DataFrame:
        """The current rows with their version."""
        return latest_by_key(self._rows(self.newest()), self.keys)

    def changes(self, after: Version, upto: Version) -> DataFrame:
        """Rows of versions after the first and up to the second.

        Only the log's folders in between are read.  Where some of them are retired already, the current rows of the newest
        generation stand for them; what these have replaced is not told.
        """
        numbers = self.generations.numbers()
        retired = Version(*self.generations.note(numbers[-1])["retired"]) if numbers else START
        if after >= retired:
            return self._log_rows(after, upto)
        merged = self._merged(numbers[-1])
        newer = F.struct(*VERSION) > F.struct(*[F.lit(v).alias(c) for c, v in zip(VERSION, after)])
        return self.generations.read(numbers[-1], self.schema).where(newer).unionByName(self._log_rows(max(after, merged), upto))

    def compact(self) -> bool:
        """Store the current state as the next generation and shorten the log; False where nothing has come since the last."""
        numbers, newest = self.generations.numbers(), self.newest()
        merged = self._merged(numbers[-1]) if numbers else START
        if newest == merged:
            return False
        self.generations.write(latest_by_key(self._rows(newest), self.keys), {"merged": newest, "retired": merged})
        for version in self.versions():
            if version <= merged:
                self.log.remove(f"run={version.run}/batch_id={version.batch_id}")
        return True
