"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it isn't set a local master gets a temporary folder; on any other that is
    an error, since executors wouldn't see it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = os.path.join(tempfile.gettempdir(), "inkplane-shared")  # one machine
        spark.sparkContext.setCheckpointDir(found)
    return found


class Scratch:
    """Tables written to the shared folder. An operator drops those that its result doesn't read; the rest
    go when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.names = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
        """Writes df and reads it again."""
        df.write.mode("overwrite").options(**(options or {})).parquet(self.path(name))
        if not self.names:
            root, files = self._at(self.root)
            files.deleteOnExit(root)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path, files = self._at(self.path(name))
            files.delete(path, True)
            self.names.discard(name)

    def drop_all_but(self, *names: str) -> None:
        self.drop(*(self.names - set(names)))
