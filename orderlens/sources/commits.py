"""A commit log of numbered entries, each created by exactly one writer.

An entry is one file named by its number, and to commit is to create the file of the next number, which
fails if it is there. So entries have one order that does not depend on any clock, and of two writers
that both build on the same state the second finds the number taken, reads what the first committed,
and is refused if that concerns it.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "version long, kind string, run_id string, parent_id string, committed_at timestamp, schema_version string, "
    "as_of_date date, tables array<string>, row_count bigint, buckets int, bucketed map<string,string>"
)


# A creator that was stopped between creating and closing its file leaves a number without an entry.
_WAITS = 30


class ConcurrentRun(RuntimeError):
    """Another run of the same kind was committed since this one began."""


def now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    folder: str

    def entries(self) -> DataFrame | None:
        """All entries, None before the first."""
        try:
            return self.spark.read.schema(SCHEMA).json(f"{self.folder}/*.json")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def version(self, kind: str | None = None) -> int:
        """Number of the newest entry, or of the newest of a kind; 0 if there is none."""
        entries = self.entries()
        if entries is None:
            return 0
        if kind is not None:
            entries = entries.where(F.col("kind") == kind)
        return entries.agg(F.max("version").alias("newest")).first()["newest"] or 0

    def append(self, entry: dict, based_on: int | None = None) -> int:
        """Commit an entry and return its number.

        ``based_on`` is the newest version of the entry's kind that the run began from. If another has
        been committed since, ConcurrentRun is raised and nothing changes; entries of other kinds do not
        matter. None commits in any case, after whatever is there.
        """
        taken, waits = 0, 0
        while True:
            newest = self.version()
            waits = waits + 1 if newest + 1 == taken else 0
            if waits > _WAITS:
                raise RuntimeError(f"commit {taken} was begun and never finished; remove its file")
            if waits:
                time.sleep(1)
            if based_on is not None and (latest := self.version(entry["kind"])) != based_on:
                raise ConcurrentRun(
                    f"{entry['kind']}: version {latest} was committed since version {based_on}, from which this run began"
                )
            version = newest + 1
            row = {"version": version, "committed_at": now().isoformat(), **entry}
            if self._create(f"{version:020d}.json", json.dumps(row) + "\n"):
                return version
            taken = version

    def _create(self, name: str, text: str) -> bool:
        """Create a file unless it exists; whether it was created."""
        place = urlparse(self.folder)
        if place.scheme in ("", "file"):
            return _create_local(unquote(place.path), name, text)
        return self._create_remote(f"{self.folder}/{name}", text)

    def _create_remote(self, path: str, text: str) -> bool:
        """Through Hadoop, which leaves it to the file system that one of two creators fails. HDFS does so;
        an object store must be set to create files only where there are none."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            stream = system.create(where, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True


def _create_local(folder: str, name: str, text: str) -> bool:
    """A link to a finished file: it appears whole, and only if the name is free."""
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{uuid.uuid4()}"
    with open(draft, "w", encoding="utf-8") as file:
        file.write(text)
    try:
        os.link(draft, f"{folder}/{name}")
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)

