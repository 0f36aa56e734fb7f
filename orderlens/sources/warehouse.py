"""A versioned warehouse: whole runs become visible at once, or not at all.

Every run writes its tables under its own id and then creates the next entry of a commit log. Readers
take the newest committed run, so a run that fails halfway changes nothing anyone reads, and a run that
was overtaken by another of its kind is refused. Nothing is renamed or replaced, which object stores
could not do atomically.

Tables may be stored in buckets of a key, sorted by it within each: tables that are all bucketed by the
same key are then joined and grouped by it without moving a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from orderlens.contracts import SCHEMA_VERSION
from orderlens.sources.commits import CommitLog

CODEC = "zstd"
"""Of the tables' files: most of their columns are text that repeats."""


@dataclass(frozen=True)
class Warehouse:
    """``buckets`` is how many buckets new runs store their bucketed tables in at least; 0 stores plain
    files. Committed runs are read as they were stored."""

    spark: SparkSession
    root: str
    buckets: int = 0

    def path(self, kind: str, run_id: str, table: str) -> str:
        return f"{self.root}/{kind}/run_id={run_id}/{table}"

    def catalog_name(self, kind: str, run_id: str, table: str) -> str:
        """Every run of every warehouse has tables of its own in the catalog, so none replaces another's."""
        place = hashlib.sha256(self.root.encode()).hexdigest()[:12]
        return f"orderlens_{place}_{kind}_{run_id.replace('-', '_')}_{table}".lower()

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_commits")

    def write(
        self,
        kind: str,
        run_id: str,
        name: str,
        frame: DataFrame,
        key: str | None = None,
        buckets: int = 0,
        dealt: bool = False,
    ) -> tuple[DataFrame, int]:
        """Write one table of a run and count its rows on the way; returns the stored table. With a key
        and a number of buckets the rows are dealt to that many files by the key; ``dealt`` says that the
        frame is partitioned so already."""
        seen = Observation()
        path = self.path(kind, run_id, name)
        counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        if key is None or not buckets:
            counted.write.parquet(path, compression=CODEC)
            return self.spark.read.schema(frame.schema).parquet(path), seen.get["rows"]
        catalog_name = self.catalog_name(kind, run_id, name)
        if not dealt:
            counted = counted.repartition(buckets, key)
        writer = counted.write.bucketBy(buckets, key).sortBy(key)
        writer.option("path", path).option("compression", CODEC).format("parquet").saveAsTable(catalog_name)
        return self.spark.table(catalog_name), seen.get["rows"]

    def commit(
        self,
        kind: str,
        run_id: str,
        tables: Mapping[str, int],
        parent_id: str | None = None,
        as_of: date | None = None,
        bucketed: Mapping[str, str] | None = None,
        buckets: int = 0,
        based_on: int | None = None,
    ) -> int:
        """Make a fully written run the current one of its kind; its version. ``bucketed`` gives the keys
        of tables stored in ``buckets``. With ``based_on``, the version of the kind that the run began
        from, a run that was overtaken is refused."""
        entry = {
            "kind": kind,
            "run_id": run_id,
            "parent_id": parent_id,
            "schema_version": SCHEMA_VERSION,
            "as_of_date": None if as_of is None else as_of.isoformat(),
            "tables": list(tables),
            "row_count": sum(tables.values()),
            "buckets": buckets,
            "bucketed": dict(bucketed or {}),
        }
        return self.commits.append(entry, based_on)

    def log(self) -> DataFrame | None:
        """The commit log, None before the first commit."""
        return self.commits.entries()

    def version(self, kind: str) -> int:
        """Version of the current run of a kind, 0 if there is none."""
        return self.commits.version(kind)

    def current(self, kind: str) -> Row | None:
        """The run of a kind that was committed last, whatever the clocks said."""
        log = self.log()
        if log is None:
            return None
        return log.filter(F.col("kind") == kind).orderBy(F.desc("version")).limit(1).first()

    def tables(self, kind: str, run: Row | None = None) -> dict[str, DataFrame]:
        """Tables of a run looked up before, or of the current run of a kind."""
        run = run or self.current(kind)
        if run is None:
            raise FileNotFoundError(f"No existe el warehouse: falta {kind}.")
        return {name: self._table(kind, run, name) for name in run["tables"]}

    def _table(self, kind: str, run: Row, name: str) -> DataFrame:
        path = self.path(kind, run["run_id"], name)
        plain = self.spark.read.parquet(path)
        key = (run["bucketed"] or {}).get(name)
        if key is None:
            return plain
        # The catalog may be another session's; the files are the same.
        catalog_name = self.catalog_name(kind, run["run_id"], name)
        if not self.spark.catalog.tableExists(catalog_name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {catalog_name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                f"SORTED BY (`{key}`) INTO {run['buckets']} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(catalog_name)

    def ingest_state(self) -> DataFrame | None:
        """Lineage of the current ingest, one row."""
        run = self.current("ingest")
        if run is None:
            return None
        return self.log().filter(F.col("run_id") == run["run_id"]).select(
            F.col("run_id").alias("ingest_run_id"),
            F.col("committed_at").alias("ingested_at"),
            "schema_version",
            F.size("tables").alias("source_tables"),
            F.col("row_count").alias("source_rows"),
        )
