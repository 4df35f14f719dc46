"""Table versions: which run wrote each snapshot of a table, with which columns and how many rows."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

#: The one key of a table without snapshots.
WHOLE = ""


def merged(schemas: Iterable[StructType]) -> StructType:
    """The columns of all schemas, in the order they first come; names agree whatever their case.

    A column with two types is an error: no read could give both.
    """
    found: dict[str, StructField] = {}
    for schema in schemas:
        for column in schema:
            same = found.setdefault(column.name.lower(), column)
            if same.dataType != column.dataType:
                names = (same.dataType.simpleString(), column.dataType.simpleString())
                raise ValueError(f"column {column.name!r} is {names[0]} in one run and {names[1]} in another")
    return StructType([StructField(c.name, c.dataType) for c in found.values()])


@dataclass(frozen=True)
class Run:
    """What one write left: the columns of its files, and what it measured."""

    schema: StructType
    measured: dict[str, object] = field(default_factory=dict)
    #: into how many buckets by customer its rows are dealt; 0 if they aren't
    buckets: int = 0


@dataclass(frozen=True)
class Manifest:
    """One version of a table. Its size grows with the number of snapshots, not with their rows."""

    version: int = 0
    #: all columns the table ever had, without the snapshot's
    schema: StructType = field(default_factory=StructType)
    #: snapshot → (run that wrote it, its rows); snapshots without rows aren't in it
    snapshots: dict[str, tuple[str, int]] = field(default_factory=dict)
    #: the runs that wrote them, by id, and the newest run
    runs: dict[str, Run] = field(default_factory=dict)
    committed_at: str = ""

    @property
    def whole(self) -> bool:
        """Is the table one without snapshots?"""
        return WHOLE in self.snapshots

    def columns(self, runs: set[str]) -> StructType:
        """The columns that these runs have, in the order of the table; all of them, if there is no run."""
        if not runs:
            return self.schema
        names = {c.name.lower() for r in runs for c in self.runs[r].schema}
        return StructType([c for c in self.schema if c.name.lower() in names])

    def buckets(self, runs: set[str]) -> int:
        """The number of buckets that all these runs share, 0 if there is none."""
        numbers = {self.runs[r].buckets for r in runs}
        return numbers.pop() if len(numbers) == 1 else 0

    def after(self, run_id: str, run: Run, rows: dict[str, int]) -> Manifest:
        """The next version: the snapshots in ``rows`` are those of the run, all others stay."""
        snapshots = {k: v for k, v in self.snapshots.items() if k not in rows}
        snapshots |= {k: (run_id, n) for k, n in rows.items() if n or k == WHOLE}
        live = {r for r, _ in snapshots.values()} | {run_id}
        runs = {r: found for r, found in (self.runs | {run_id: run}).items() if r in live}
        now = datetime.now(timezone.utc).isoformat(timespec="seconds")
        return replace(
            self,
            version=self.version + 1,
            schema=merged([*(r.schema for r in runs.values()), *([self.schema] if not self.snapshots else [])]),
            snapshots=dict(sorted(snapshots.items())),
            runs=runs,
            committed_at=now,
        )

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "committed_at": self.committed_at,
                "schema": self.schema.jsonValue(),
                "snapshots": {k: {"run": r, "rows": n} for k, (r, n) in self.snapshots.items()},
                "runs": {
                    k: {"schema": r.schema.jsonValue(), "measured": r.measured, "buckets": r.buckets}
                    for k, r in self.runs.items()
                },
            },
            indent=1,
        )

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(
            found["version"],
            StructType.fromJson(found["schema"]),
            {k: (s["run"], s["rows"]) for k, s in found["snapshots"].items()},
            # manifests of earlier releases know no buckets
            {
                k: Run(StructType.fromJson(r["schema"]), r["measured"], r.get("buckets", 0))
                for k, r in found["runs"].items()
            },
            found["committed_at"],
        )


class Versions:
    """The manifests of one table, numbered files in its folder ``_manifests``; the greatest number counts.

    A manifest is written under another name and then renamed to its number, which fails if that
    number is there. So a reader sees a version whole or not at all, and of two writers that end at the
    same time one tries again on top of the other's version.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._spark = spark._jvm, spark
        self.folder = f"{path}/_manifests"
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        folder = self._path(self.folder)
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def get(self, number: int | None = None) -> Manifest | None:
        """A version, by default the newest; None if the table has none."""
        if number is None:
            found = self.numbers()
            if not found:
                return None
            number = found[-1]
        path = self._path(f"{self.folder}/{number:010d}.json")
        if not self._files.exists(path):
            raise ValueError(f"no version {number} in {self.folder}")
        stream = self._files.open(path)
        try:
            raw = self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        return Manifest.from_json(bytes(raw).decode())

    def commit(self, change: Callable[[Manifest], Manifest], tries: int = 50) -> Manifest:
        """Publish ``change`` of the newest version; again, if another writer was first."""
        for _ in range(tries):
            after = change(self.get() or Manifest())
            if self._publish(after):
                return after
        raise RuntimeError(f"{tries} other commits came first in {self.folder}")

    def _publish(self, manifest: Manifest) -> bool:
        name = f"{self.folder}/{manifest.version:010d}.json"
        staged = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self._files.create(staged, False)
        try:
            out.write(bytearray(manifest.to_json().encode()))
        finally:
            out.close()
        target = self._path(name)
        if not self._renamed(self._files.makeQualified(staged), self._files.makeQualified(target)):
            self._files.delete(staged, False)
            return False
        return True

    def _renamed(self, staged, target) -> bool:
        """Give the staged file the name of its version; False if another writer has it."""
        if target.toUri().getScheme() == "file":
            # Hadoop's local rename looks first and renames then, so two writers could both succeed. A
            # link fails if the name is there.
            try:
                os.link(staged.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            self._files.delete(staged, False)
            return True
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self._spark._jsc.hadoopConfiguration()
        )
        keep = self._spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(staged, target, keep)
        except Exception:
            if self._files.exists(target):
                return False
            self._files.delete(staged, False)
            raise
        return True

    def forget(self, number: int) -> None:
        self._files.delete(self._path(f"{self.folder}/{number:010d}.json"), False)
