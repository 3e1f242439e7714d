"""Tables replaced as a whole: data first, then one small commit file.

A reader sees the last committed version, so a job that dies half-way leaves
the old table in place, and running it again is safe. A commit file is created without
overwriting, so two writers cannot both take a version; one that was
never written to its end is no commit.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._log = self._hadoop.Path(f"{self.path}/_commits")
        self._fs = self._log.getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[str]:
        """Names of the commit files, oldest first."""
        if not self._fs.exists(self._log):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._log)]
        return sorted(n for n in names if n.endswith(".json"))

    def _commit(self, name: str) -> dict | None:
        """What a commit file says; None if its writer has not ended it."""
        stream = self._fs.open(self._hadoop.Path(self._log, name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _last(self, skip: int = 0) -> tuple[str, dict] | None:
        """The last commit, or the one ``skip`` commits before it."""
        for name in reversed(self._versions()):
            found = self._commit(name)
            if found is not None:
                if not skip:
                    return name, found
                skip -= 1
        return None

    def exists(self) -> bool:
        return self._last() is not None

    def version(self) -> str | None:
        """Name of the last commit; None before the first."""
        last = self._last()
        return last and last[0]

    def last_note(self) -> str | None:
        last = self._last()
        return last and last[1]["note"]

    def bytes(self) -> int:
        """Size of the last version's files; 0 before the first."""
        last = self._last()
        return self._fs.getContentSummary(self._hadoop.Path(last[1]["data_path"])).getLength() if last else 0

    def drop_before_last(self) -> None:
        """Delete the data of the second version before the last; its readers have had the time of a version to end."""
        old = self._last(skip=2)
        if old:
            self._fs.delete(self._hadoop.Path(old[1]["data_path"]), True)

    def notes(self) -> list[str]:
        return [c["note"] for c in map(self._commit, self._versions()) if c is not None]

    def replace(self, df: DataFrame, note: str = "", partition_by: tuple[str, ...] = ()) -> None:
        """Write the next version; ``df`` may read the current one."""
        versions = self._versions()
        number = int(versions[-1].removesuffix(".json")) + 1 if versions else 0
        data = f"{self.path}/v{number:06d}-{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*partition_by).parquet(data)
        try:
            out = self._fs.create(self._hadoop.Path(self._log, f"{number:06d}.json"), False)
        except Py4JJavaError as e:
            raise RuntimeError(f"version {number} of {self.path} was committed by another writer") from e
        out.write(bytearray(json.dumps({"data_path": data, "note": note, "schema": df.schema.json()}).encode()))
        out.close()

    def read(self) -> DataFrame:
        last = self._last()
        if last is None:
            raise FileNotFoundError(self.path)
        return self.spark.read.schema(StructType.fromJson(json.loads(last[1]["schema"]))).parquet(last[1]["data_path"])

    def apply_once(self, note: str, change) -> bool:
        """Run a named change unless its note is already in the log."""
        if note in self.notes():
            return False
        self.replace(change(self.read()), note)
        return True
