"""Stages of a long run, each done once even if the driver is started again."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ebbtide.sources.manifest import Folder, Manifest
from ebbtide.sources.sinks import stamped


class Stages:
    """What the run ``key`` has finished, in ``_runs`` of the output folder.

    Every attempt writes to a path of its own; the path counts once it is recorded. So a
    stage that was cut off is done again and never read half.
    """

    def __init__(self, spark: SparkSession, output: str, key: str) -> None:
        self.spark = spark
        self.output = output.rstrip("/")
        self.folder = f"{self.output}/_runs/{key}"
        self.finished = Manifest(spark, f"{self.folder}/finished")

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table between stages, written as Parquet by the first attempt that ends."""
        facts = self.finished.facts(name)
        if facts is None:
            path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
            made = make()
            made.write.mode("error").parquet(path)
            facts = self.finished.commit(name, {"path": path, "schema": made.schema.json()})
        schema = T.StructType.fromJson(json.loads(facts["schema"]))
        return self.spark.read.schema(schema).parquet(facts["path"])

    def path(self, name: str, write: Callable[[str], str]) -> str:
        """An output of the run under a dated name, and where it is."""
        facts = self.finished.facts(name)
        if facts is None:
            path = stamped(self.output, name)
            if Folder(self.spark, self.output).has(path.rsplit("/", 1)[1]):
                path = f"{path}_{uuid.uuid4().hex[:8]}"
            facts = self.finished.commit(name, {"path": write(path)})
        return facts["path"]
