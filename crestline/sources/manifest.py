"""Numbered small documents that are published one after the other, never twice under one number."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class WriteConflict(RuntimeError):
    """Another writer published since the state was read."""


class Manifest:
    """JSON documents ``v0000000001.json`` onwards below ``path``; a reader sees a whole one or none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def at(self, name: str = ""):
        jvm = self.spark.sparkContext._jvm
        return self.fs().makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/")))

    def fs(self):
        sc = self.spark.sparkContext
        return sc._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(sc._jsc.hadoopConfiguration())

    def names(self, folder: str = "") -> list[str]:
        fs, root = self.fs(), self.at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self.names() if n.startswith("v") and n.endswith(".json")]

    def load(self, version: int | None = None) -> tuple[int, dict | None]:
        """(version, document) of the newest version or of the one asked for; (0, None) before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return 0, None
        stream = self.fs().open(self.at(f"v{version:010d}.json"))
        try:
            return version, json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, version: int, doc: dict) -> None:
        """Put ``doc`` in place as ``version`` by a rename that fails if the number is taken."""
        sc = self.spark.sparkContext
        draft, final = self.at(f".{uuid.uuid4().hex}"), self.at(f"v{version:010d}.json")
        out = self.fs().create(draft, True)
        out.write(bytearray(json.dumps(doc), "utf-8"))
        out.close()
        files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), sc._jsc.hadoopConfiguration())
        never = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, final, never)
        except Py4JJavaError as exc:
            self.fs().delete(draft, False)
            if "FileAlreadyExistsException" not in str(exc.java_exception):
                raise
            raise WriteConflict(f"version {version} of {self.path} was written by another job") from None

    def published_at(self, version: int) -> int:
        return self.fs().getFileStatus(self.at(f"v{version:010d}.json")).getModificationTime()

    def drop(self, version: int) -> None:
        self.fs().delete(self.at(f"v{version:010d}.json"), False)
