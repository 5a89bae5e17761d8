"""Stored Parquet tables that are changed file by file, with a record per version.

A change finds the files that hold rows to change (`_metadata.file_path`), writes their rows anew beside the others, and
then publishes one record: the files of the new version, and the mark of the load that made it. Files without such rows
are neither read whole nor written. A reader takes the newest complete record, so a change is seen whole or not at all:
a job that dies after its data and before its record leaves files that no version lists, and can be run again. Older
versions stay readable until `drop_unused`, and `revert` publishes one of them again.

A record is created, never overwritten: of two writers that start from one version the second fails. That needs a file
system on which creating a file is exclusive, as on HDFS. The driver holds the list of files, as Spark does for any
table it reads; rows and keys stay on the executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.grouping import one_per_key
from tabularium.session import written

RECORDS = "_versions"


class Conflict(RuntimeError):
    """Another writer published a version in between."""


@dataclass(frozen=True)
class Version:
    number: int
    files: tuple[str, ...]  # below the table's folder
    mark: Mapping[str, str | None] = field(default_factory=dict)
    note: str = ""


def true(where: Column) -> Column:
    """An unknown predicate does not hold."""
    return F.coalesce(where, F.lit(False))


class StoredTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, df: DataFrame, path: str, cluster: Sequence[str] = (), mark: Mapping[str, str | None] | None = None) -> StoredTable:
        """A new table. Rows are put in ranges of the `cluster` columns, so that a later change by them meets few files."""
        table = cls(df.sparkSession, path, df.schema)
        if table._numbers():
            raise ValueError(f"there is a table at {path}")
        rows = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster) if cluster else df
        files, _ = table.put(rows)
        table.publish(Version(0, ()), files, mark or {}, "create")
        return table

    # ---- versions -------------------------------------------------------------------

    def _record(self, number: int):
        return self._at(f"{self.path}/{RECORDS}/{number:012d}.json")

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/{RECORDS}")
        found = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        return sorted(int(s.getPath().getName()[:12]) for s in found if s.getPath().getName().endswith(".json"))

    def version(self, number: int) -> Version | None:
        """The version of a record; None if its writer did not finish it."""
        stream = self._fs.open(self._record(number))
        try:
            found = json.loads(self._text(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()
        return Version(found["number"], tuple(found["files"]), found["mark"], found["note"])

    def versions(self) -> list[Version]:
        return [v for n in self._numbers() if (v := self.version(n))]

    def current(self) -> Version:
        for number in reversed(self._numbers()):
            if found := self.version(number):
                return found
        return Version(0, ())

    def publish(self, base: Version, files: Iterable[str], mark: Mapping[str, str | None] | None = None, note: str = "") -> Version:
        """The record of a version that follows `base`; without `mark` the mark stays."""
        if self.current().number != base.number:
            raise Conflict(f"{self.path} has version {self.current().number}, the change began at {base.number}")
        new = Version(max(self._numbers(), default=0) + 1, tuple(files), base.mark if mark is None else mark, note)
        out = self._fs.create(self._record(new.number), False)
        out.write(bytearray(json.dumps(asdict(new)).encode()))
        out.close()
        return new

    # ---- rows -----------------------------------------------------------------------

    def read(self, version: Version | None = None) -> DataFrame:
        return self.read_files((version or self.current()).files)

    def read_files(self, files: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in files]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    @staticmethod
    def file_of() -> Column:
        """The file a row was read from, as versions name it."""
        return F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+/[^/]+)$", 1)

    def files_with(self, base: Version, where: Column) -> list[str]:
        """Files that hold a row for which `where` is true; reads the columns of the predicate only."""
        if not base.files:
            return []
        hit = self.read(base).filter(true(where)).select(self.file_of().alias("file")).distinct()
        return [r.file for r in hit.collect()]  # at most the files of the version

    def put(self, df: DataFrame) -> tuple[list[str], int]:
        """New files that no version lists yet, and how many rows they hold."""
        folder, seen = f"data/{uuid.uuid4().hex}", Observation()
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(f"{self.path}/{folder}"))]
        n = seen.get["n"]
        return [f"{folder}/{x}" for x in sorted(names) if x.startswith("part-")] if n else [], n

    def append(self, df: DataFrame, mark: Mapping[str, str | None] | None = None, note: str = "append") -> int:
        """Rows added in files of their own; returns how many."""
        base = self.current()
        files, n = self.put(df)
        self.publish(base, (*base.files, *files), mark, note)
        return n

    def replace_where(self, where: Column, rows: DataFrame, check: Callable[[DataFrame], None] | None = None, note: str = "replace") -> Version:
        """`rows` in place of the rows for which `where` is true; other rows of the files that hold those are written again.

        `check` gets the staged rows; if it raises, the table stays as it was.
        """
        base = self.current()
        hit = self.files_with(base, where)
        staged, _ = self.put(rows)
        if check is not None:
            check(self.read_files(staged))
        kept, _ = self.put(self.read_files(hit).filter(~true(where))) if hit else ([], 0)
        return self.publish(base, [f for f in base.files if f not in set(hit)] + staged + kept, note=note)

    def merge(self, src: DataFrame, key: str, compare: Sequence[str], note: str = "merge") -> DataFrame:
        """Upsert; returns (key, action) of the source's keys: inserted, updated or kept.

        Only files that hold a key with a changed value are written again, and new keys go to files of their own. NULL
        is a key like any other; of several source rows of a key one counts.
        """
        base, columns = self.current(), self.schema.names
        new = written(one_per_key(src.select(*columns), key), "merge-source")
        values = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(compare)])
        changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(compare)])
        slim = self.read(base)
        place = self.file_of() if base.files else F.lit("")
        slim = slim.select(key, *[c for c in compare if c != key], place.alias("_file"))
        met = slim.join(values, F.col(key).eqNullSafe(F.col("_k"))).select("_k", "_file", changed.alias("_changed"))
        met = written(met, "merge-keys")
        hit = [r._file for r in met.filter("_changed").select("_file").distinct().collect()]  # at most the files of the version
        updated, known = met.filter("_changed").select("_k"), met.select("_k")
        inserted = new.join(known, F.col(key).eqNullSafe(F.col("_k")), "left_anti")
        kept = self.read_files(hit).join(updated, F.col(key).eqNullSafe(F.col("_k")), "left_anti")
        renewed = new.join(updated, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
        files, _ = self.put(kept.unionByName(renewed))
        added, _ = self.put(inserted)
        self.publish(base, [f for f in base.files if f not in set(hit)] + files + added, note=note)
        action = F.when(F.col("_changed"), "updated").otherwise("kept")
        return met.select(F.col("_k").alias(key), action.alias("action")).unionByName(
            inserted.select(key, F.lit("inserted").alias("action")))

    # ---- the way back ----------------------------------------------------------------

    def revert(self, number: int) -> Version:
        """An older version once more, as a new one."""
        old = self.version(number)
        if old is None:
            raise ValueError(f"no version {number}")
        return self.publish(self.current(), old.files, old.mark, f"revert to {number}")

    def drop_unused(self, keep: int = 1) -> int:
        """Remove files that none of the last `keep` versions lists, and the records before them; returns how many files.

        Not while a change is being written: its files are not listed yet.
        """
        versions = self.versions()
        live = {f for v in versions[-keep:] for f in v.files}
        gone = 0
        data = self._at(f"{self.path}/data")
        for folder in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = folder.getPath().getName()
            files = [s.getPath() for s in self._fs.listStatus(folder.getPath())]
            parts = [p for p in files if p.getName().startswith("part-")]
            dead = [p for p in parts if f"data/{name}/{p.getName()}" not in live]
            gone += len(dead)
            if len(dead) == len(parts):
                self._fs.delete(folder.getPath(), True)
            else:
                for p in dead:
                    self._fs.delete(p, False)
        for v in versions[:-keep]:
            self._fs.delete(self._record(v.number), False)
        return gone
