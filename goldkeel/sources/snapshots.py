"""State tables as Parquet segments, made visible by one small commit file.

A table's content is the list of segment folders its latest commit names. A
job writes new segments with plain Spark writers first and its commit last, so
a job that dies leaves the state as it was, and readers always see tables that
belong together. Appending adds a segment; changing rows replaces them.

A commit file is written under another name and then renamed, which fails if
the version exists: it is there whole or not at all, and of two writers one
wins. That needs a file system with such a rename; an object store without one
needs a conditional put in its place. A commit also holds the last key issued
for a table, which outlives deleted rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from goldkeel.session import shuffling

KEPT_SECONDS = 7 * 24 * 3600.0


class StateStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _filesystem(self):
        return self._path("commits").getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _latest(self) -> tuple[int, dict[str, list[str]], dict[str, int]]:
        files, folder = self._filesystem(), self._path("commits")
        if not files.exists(folder):
            return 0, {}, {}
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
        return self._commit(max(versions)) if versions else (0, {}, {})

    def _commit(self, last: int) -> tuple[int, dict[str, list[str]], dict[str, int]]:
        if not last:
            return 0, {}, {}
        stream = self._filesystem().open(self._path(f"commits/{last:010d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        content = json.loads(text)
        return last, content["tables"], content["keys"]

    def version(self) -> int:
        return self._latest()[0]

    def last_key(self, table: str) -> int:
        """The last key issued for a table, 0 if none was."""
        return self._latest()[2].get(table, 0)

    def read(self, table: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
        """Content now, or as of an earlier version whose segments are still
        kept; an unknown table is empty. Without a schema that of the segments
        counts, of which there must be some."""
        segments = (self._latest() if version is None else self._commit(version))[1].get(table, [])
        paths = [f"{self.root}/{s}" for s in segments]
        if schema is None:
            return self.spark.read.parquet(*paths)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def stage(self, df: DataFrame, name: str, rows: int = 0) -> DataFrame:
        """Write a stage once and go on from the written rows. ``rows`` are
        those shuffled on the way, as for ``goldkeel.session.stage``."""
        path = f"{self.root}/staging/{name}-{uuid.uuid4().hex}"
        with shuffling(self.spark, rows):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_segment(self, df: DataFrame, table: str) -> str:
        segment = f"{table}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{segment}")
        return segment

    def commit(
        self,
        base: int,
        append: Mapping[str, str] | None = None,
        replace: Mapping[str, str] | None = None,
        keys: Mapping[str, int] | None = None,
    ) -> int:
        """Publish segments, and last issued keys, on top of version ``base``;
        fails if another job committed in between."""
        last, tables, issued = self._latest()
        if last != base:
            raise RuntimeError(f"state moved from version {base} to {last}; run the job again")
        for table, segment in (append or {}).items():
            tables.setdefault(table, []).append(segment)
        for table, segment in (replace or {}).items():
            tables[table] = [segment]
        content = {"tables": tables, "keys": {**issued, **(keys or {})}}
        draft = self._path(f"drafts/{uuid.uuid4().hex}.json")
        stream = self._filesystem().create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            stream.close()
        self._publish(draft, self._path(f"commits/{base + 1:010d}.json"), base)
        return base + 1

    def remove_unused(self, older_than: float = KEPT_SECONDS) -> None:
        """Delete stages, drafts and segments that the latest commit does not
        name and that no job has touched for so many seconds. Choose more than
        the longest job takes and a report is read for."""
        files = self._filesystem()
        _, tables, _ = self._latest()
        used = {segment for segments in tables.values() for segment in segments}
        before = (time.time() - older_than) * 1000
        for name in ("staging", "drafts", *tables):
            if not files.exists(self._path(name)):
                continue
            for status in files.listStatus(self._path(name)):
                entry = f"{name}/{status.getPath().getName()}"
                if entry not in used and status.getModificationTime() < before:
                    files.delete(self._path(entry), True)

    def _publish(self, draft, final, base: int) -> None:
        """Rename without overwriting."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        self._filesystem().mkdirs(final.getParent())
        context = hadoop.FileContext.getFileContext(self._filesystem().getUri(), conf)
        never = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(final), never)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise RuntimeError(f"state moved on from version {base}; run the job again") from error
            raise
