"""Writers: prediction files, appended order items, report tables."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.manifest import Folder, Manifest, version_of
from ebbtide.sources.tables import conform

log = logging.getLogger(__name__)


def stamped(folder: str, stem: str, now: dt.datetime | None = None) -> str:
    moment = now or dt.datetime.now()
    return f"{folder.rstrip('/')}/{stem}_{moment:%Y%m%d_%H%M%S}"


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("error").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("error").parquet(path)
    return path


@dataclass
class AppendResult:
    rows: int = 0
    appended: list[str] = field(default_factory=list)
    # Inputs that an earlier call, or an earlier place of the list, has brought in.
    repeated: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)


@dataclass
class _Append:
    """Appends to one table, each input once.

    An input is written to a staging folder, then noted as ready with the names of its
    files, then its files are moved into the table, then it is noted as done. A crash before
    the first note leaves only a staging folder that nobody reads; after it the next call
    moves the files that are still to be moved. The notes lie in ``_appended`` of the table,
    which readers pass over.
    """

    spark: SparkSession
    target: str

    def __post_init__(self) -> None:
        self.target = self.target.rstrip("/")
        self.table = Folder(self.spark, self.target)
        self.ready = Manifest(self.spark, f"{self.target}/_appended/ready")
        self.done = Manifest(self.spark, f"{self.target}/_appended/done")

    def recover(self) -> dict[str, dict]:
        """Finish what earlier calls left ready; the facts by input."""
        left = sorted(set(self.ready.names()) - set(self.done.names()))
        return {name: self.move(name, self.ready.facts(name)) for name in left}

    def stage(self, name: str, rows: DataFrame, path: str) -> dict:
        folder = f"{self.target}/_appended/staged-{uuid.uuid4().hex}"
        written = Folder(self.spark, folder)
        count = Observation()
        try:
            rows.observe(count, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        except Exception:
            written.remove()
            raise
        files = sorted(n for n in written.sizes() if not n.startswith(("_", ".")))
        facts = {
            "path": path,
            "rows": count.get.get("rows", 0),
            "folder": folder,
            "files": files,
        }
        return self.ready.commit(name, facts)

    def move(self, name: str, facts: dict) -> dict:
        staged = Folder(self.spark, facts["folder"])
        for file in facts["files"]:
            self.table.take(staged, file)
        self.done.commit(name, {"path": facts["path"], "rows": facts["rows"]})
        staged.remove()
        return facts


def append_inputs(
    spark: SparkSession,
    paths: list[str],
    target: str,
    schema: T.StructType,
    skip_first: bool = True,
) -> AppendResult:
    """Append several Parquet or CSV inputs to one Parquet table, each of them once.

    The first input is a cover sheet and is left out. An input that cannot be
    read, lacks a column or holds a value that does not cast is skipped as a whole
    and recorded; the others still go in. An input is known by the paths, lengths and times
    of its files: a call that is repeated, after a crash at any point or by mistake, adds
    only what is not in yet. The table may hold rows of other origin. Readers may see some
    files of an input and not others while these are moved. One call at a time may write
    to a table.
    """
    result = AppendResult()
    append = _Append(spark, target)
    recovered = append.recover()
    for path in paths[1:] if skip_first else paths:
        try:
            if path.endswith(".csv"):
                raw = spark.read.option("header", True).csv(path)
            else:
                raw = spark.read.parquet(path)
            name = version_of(spark, raw.inputFiles())
            facts = recovered.pop(name, None)
            if facts is None:
                if append.done.facts(name) is not None:
                    result.repeated.append(path)
                    continue
                facts = append.stage(name, conform(raw, schema), path)
                append.move(name, facts)
            result.rows += facts["rows"]
            result.appended.append(path)
        except Exception as error:
            log.error("input %s left out: %s", path, error)
            result.failed[path] = type(error).__name__
    return result


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> str:
    """Save ``df`` as a table hashed and sorted by ``key``.

    Two tables with the same key and bucket count join without moving either: meant
    for order_header and order_item by order_number, whose join is the largest shuffle
    of the feature set.
    """
    (
        df.write.mode("error")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    return table
