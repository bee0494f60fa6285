"""Records of finished work, kept beside the work itself.

A record is one small file that appears whole and last, so after a crash work without a
record counts as not done. Any file system that Spark can write to will do.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


class Folder:
    """A folder in the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._files = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._hadoop(f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        return self._files.exists(self.at(name))

    def sizes(self) -> dict[str, tuple[int, int]]:
        """Length and time of change of the files directly inside, by name."""
        if not self._files.exists(self._hadoop(self.path)):
            return {}
        return {
            s.getPath().getName(): (s.getLen(), s.getModificationTime())
            for s in self._files.listStatus(self._hadoop(self.path))
            if s.isFile()
        }

    def read(self, name: str) -> str:
        stream = self._files.open(self.at(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> bool:
        """Create the file with its whole text; False if it is there already."""
        draft = self.at(f".{name}-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not self.has(name) and self._files.rename(draft, self.at(name)):
            return True
        self._files.delete(draft, False)
        return False

    def take(self, other: Folder, name: str) -> None:
        """Move a file of ``other`` here, unless an earlier attempt has moved it."""
        self._files.mkdirs(self._hadoop(self.path))
        if other.has(name):
            if not self._files.rename(other.at(name), self.at(name)):
                raise OSError(f"cannot move {name} to {self.path}")
        elif not self.has(name):
            raise FileNotFoundError(f"{name} is neither in {other.path} nor in {self.path}")

    def remove(self) -> None:
        self._files.delete(self._hadoop(self.path), True)


class Manifest:
    """Facts on finished pieces of work, by name (a word of letters, digits and hyphens)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._folder = Folder(spark, path)

    def facts(self, name: str) -> dict | None:
        held = f"{name}.json"
        return json.loads(self._folder.read(held)) if self._folder.has(held) else None

    def commit(self, name: str, facts: dict) -> dict:
        """Record ``name``; the facts of the first commit count and are returned."""
        if self._folder.write(f"{name}.json", json.dumps(facts)):
            return facts
        return self.facts(name)

    def names(self) -> list[str]:
        held = (n for n in self._folder.sizes() if not n.startswith("."))
        return sorted(n.removesuffix(".json") for n in held if n.endswith(".json"))


def version_of(spark: SparkSession, files: Iterable[str]) -> str | None:
    """A digest of the paths, lengths and times of change of ``files``, None without files.

    Every folder is listed once; contents are not read.
    """
    by_folder: dict[str, set[str]] = {}
    for file in files:
        # Paths of files come as URIs, names of listings plain.
        folder, name = posixpath.split(file)
        by_folder.setdefault(folder, set()).add(name)
    if not by_folder:
        return None
    digest = hashlib.sha256()
    for folder in sorted(by_folder):
        sizes = Folder(spark, _plain(spark, folder)).sizes()
        wanted = {posixpath.basename(_plain(spark, n)) for n in by_folder[folder]}
        for name in sorted(wanted):
            digest.update(json.dumps([folder, name, sizes.get(name)]).encode())
    return digest.hexdigest()[:32]


def _plain(spark: SparkSession, uri: str) -> str:
    """A path as the file system names it: URIs of Spark escape spaces and the like."""
    if "%" not in uri:
        return uri
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()
