"""Intermediate tables in the shared folder that go when their reader is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varspark.session import removed, scratch_path, shuffles_removed


class Stages:
    """Tables written by one call of an operator. ``drop`` deletes them once the result no longer depends on them.

    With ``remove_shuffles`` the shuffle files of each write go as soon as its table is there.
    """

    def __init__(self, spark: SparkSession, remove_shuffles: bool = False) -> None:
        self.spark, self.remove_shuffles = spark, remove_shuffles
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """The rows as a table, which outlives any executor."""
        path = self.path(name)
        if self.remove_shuffles:
            with shuffles_removed(self.spark):
                df.write.parquet(path)
        else:
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names, or all."""
        for path in [p for p in self.paths if not names or p.rpartition("/")[2].rpartition("-")[0] in names]:
            removed(self.spark, path)
            self.paths.remove(path)
