"""Tables that grow by whole generations.

A generation is the list of parts of each table, in one small commit file. Parts are written first, under names
that no other run uses; the commit file is created last and only if no other run has created it. Until then readers
see the generation before, so a run that fails in between changes nothing, and what it has written is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Parts of a table past which they are merged.
MOST_PARTS = 8


class VersionedStore:
    """Named tables below one path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, *names: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """Number of the last generation, 0 if there is none."""
        fs, path = self._file("commits")
        if not fs.exists(path):
            return 0
        return max((int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(path) if s.getPath().getName().endswith(".json")), default=0)

    def parts(self, version: int | None = None) -> dict[str, list[str]]:
        """Parts of each table in a generation, the last one by default."""
        version = self.version() if version is None else version
        if version == 0:
            return {}
        fs, path = self._file("commits", f"{version:010d}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        """A table as of one generation; empty if that has no part of it."""
        parts = self.parts(version).get(name, [])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in parts])

    def commit(self, added: dict[str, DataFrame], replacing: bool = False) -> int:
        """Add parts to the tables, or put them in their place, as the next generation; returns its number.

        Raises FileExistsError if another run has committed meanwhile; nothing is changed then.
        """
        version = self.version()
        parts = self.parts(version)
        for name, rows in added.items():
            part = f"data/{name}-{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.path}/{part}")
            parts[name] = [part] if replacing else [*parts.get(name, []), part]
        self._publish(version + 1, parts)
        return version + 1

    def _publish(self, version: int, parts: dict[str, list[str]]) -> None:
        fs, path = self._file("commits", f"{version:010d}.json")
        # A whole file appears at once: it is written aside and moved to a name that must be free.
        aside_fs, aside = self._file("commits", f".{uuid.uuid4().hex}")
        stream = aside_fs.create(aside, False)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        if fs.exists(path) or not fs.rename(aside, path):
            fs.delete(aside, False)
            raise FileExistsError(f"generation {version} of {self.path} was committed by another run")
