"""Lake tables: Parquet files by ``snapshot_date``, and manifests that say which of them count."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from loanstrata.operators.dedup import END, pack, unpack
from loanstrata.operators.normalize import quoted
from loanstrata.schemas import CUSTOMER, FIXED, SNAPSHOT, ddl
from loanstrata.sources.manifest import WHOLE, Manifest, Run, Versions

#: How Spark names files by default: those of a table that other tools wrote.
_FOREIGN = "part"
#: The count of all rows of a write.
_ALL = "all rows"
#: The counts by snapshot of a write, and the day from which dates are numbered there.
_DAYS = "days"
_EPOCH = date(1970, 1, 1).toordinal()
#: The bucket of a row, while a write deals by it.
_BUCKET = "__bucket"
#: The text columns of a row while they are dealt as one, and how many there are at least for that.
_CELLS, _PACK_FROM = "__cells", 8


@dataclass(frozen=True)
class Lake:
    """A lake under one root path; tables live at ``<root>/<layer>/<table>``.

    A write adds files whose names start with the id of its run, and then commits a manifest that names
    the run for each of its snapshots. Readers open the files of the newest manifest's runs and no
    others: a write that is killed midway, or fails in its last task, changes nothing, and neither
    does one that is still at work. The manifest also holds the columns of every run, so a read opens no
    file for its schema, and the rows of every snapshot.
    """

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def versions(self, layer: str, table: str) -> Versions:
        return Versions(self.spark, self.path(layer, table))

    def manifest(self, layer: str, table: str, version: int | None = None) -> Manifest | None:
        """A table's version, by default the newest; None if it was never written."""
        return self.versions(layer, table).get(version)

    def read(
        self,
        layer: str,
        table: str,
        snapshots: Sequence[date] | None = None,
        version: int | None = None,
    ) -> DataFrame | None:
        """A table, opened at the files of the given snapshots only; None if it was never written.

        The gold tables have fixed schemas. Others have the columns of all runs that are opened: a
        column that some snapshots lack is NULL there. If no snapshot asked for has rows, the table is
        empty and has all its columns. ``version`` reads the table as it was.
        """
        manifest = self.manifest(layer, table, version)
        if manifest is None:
            return None
        return self._open(manifest, layer, table, snapshots)

    def _open(self, manifest: Manifest, layer: str, table: str, snapshots: Sequence[date] | None) -> DataFrame:
        found = _found(manifest, snapshots)
        fixed = FIXED.get((layer, table))
        if fixed:
            schema = StructType.fromDDL(ddl(fixed))
        else:
            schema = manifest.columns(set(found.values()))
            if not manifest.whole:
                schema = StructType([*schema, StructField(SNAPSHOT, DateType())])
        if not found:
            return self.spark.createDataFrame([], schema)
        path = self.path(layer, table)
        files = [f"{path}/{_folder(k)}{run}-*.parquet" for k, run in found.items()]
        return self.spark.read.schema(schema).option("basePath", path).parquet(*files)

    @contextmanager
    def by_customer(
        self, layer: str, table: str, snapshots: Sequence[date] | None = None
    ) -> Iterator[DataFrame | None]:
        """A table as `read` gives it, known to Spark as dealt by customer if its writes dealt it so.

        If all runs that are opened have the same number of buckets, an aggregate or a join by customer,
        or by customer and snapshot, needs no exchange, nor does one over a union of such tables with
        that number. Spark learns of buckets from its catalog only, so the rows can be read while the
        context lasts: an external table of it, which names the snapshots asked for, ends with it.
        """
        manifest = self.manifest(layer, table)
        found = {} if manifest is None else _found(manifest, snapshots)
        buckets = manifest.buckets(set(found.values())) if found else 0
        if not buckets:
            yield None if manifest is None else self._open(manifest, layer, table, snapshots)
            return
        columns = manifest.columns(set(found.values()))
        with self._catalogued(layer, table, columns, buckets, {}) as name:
            partitions = " ".join(f"PARTITION ({SNAPSHOT} = '{k}')" for k in found)
            self.spark.sql(f"ALTER TABLE {name} ADD {partitions}")
            days: dict[str, list[date]] = {}
            for k, run in found.items():
                days.setdefault(run, []).append(date.fromisoformat(k))
            # files of runs that don't count lie in the same folders
            file = F.col("_metadata.file_name")
            counts = [F.col(SNAPSHOT).isin(d) & file.startswith(f"{run}-") for run, d in days.items()]
            rows = self.spark.table(name).where(reduce(Column.__or__, counts))
            # New names for the columns: a union keeps the buckets only of columns that don't carry the
            # table's name.
            yield rows.toDF(*rows.columns)

    @contextmanager
    def _catalogued(
        self, layer: str, table: str, columns: StructType, buckets: int, options: dict[str, object]
    ) -> Iterator[str]:
        """A table's folder as an external table of Spark's catalog, for a while; gives its name."""
        name = f"lake_{uuid.uuid4().hex}"
        types = [c.dataType.simpleString() for c in columns]
        fields = ", ".join(f"{c} {t}" for c, t in zip(quoted(columns.names), types))
        given = ", ".join(f"'{k}' = '{str(v).lower() if isinstance(v, bool) else v}'" for k, v in options.items())
        # a relative location would be one below the warehouse
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        location = files.makeQualified(folder).toString().replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({fields}, {SNAPSHOT} date) USING parquet"
            f"{f' OPTIONS ({given})' if given else ''} PARTITIONED BY ({SNAPSHOT})"
            f" CLUSTERED BY ({CUSTOMER}) SORTED BY ({CUSTOMER}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        try:
            yield name
        finally:
            # an external table: its files stay
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def runs(self, layer: str, table: str) -> dict[str, str]:
        """The run that wrote each snapshot, by its ISO date: another run, other rows."""
        manifest = self.manifest(layer, table)
        return {} if manifest is None else {k: run for k, (run, _) in manifest.snapshots.items()}

    def made_from(self, layer: str, table: str) -> dict[str, str]:
        """For each snapshot the run of the source table that its rows were made from, as `runs` gave it."""
        manifest = self.manifest(layer, table)
        if manifest is None:
            return {}
        made = {r: run.measured.get("made_from", {}) for r, run in manifest.runs.items()}
        return {k: made[run][k] for k, (run, _) in manifest.snapshots.items() if k in made[run]}

    def rows(self, layer: str, table: str) -> dict[date, int]:
        """Rows of every snapshot that has any, as the writes counted them; reads no data."""
        manifest = self.manifest(layer, table)
        found = {} if manifest is None else manifest.snapshots
        return {date.fromisoformat(k): n for k, (_, n) in found.items() if k != WHOLE}

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        snapshots: Sequence[date],
        rebalance: bool = True,
        measured: Callable[[dict[date, int]], dict] | None = None,
        buckets: int = 0,
        since: int | None = None,
    ) -> dict[date, int]:
        """Replace the given snapshots of a table with the rows of ``df`` and leave all others.

        All snapshots change at once, when the manifest is committed; two writers of different snapshots
        don't disturb each other, and of two writers of one snapshot the later commit counts. The
        rebalance lets AQE size the files: small snapshots share a task, one that holds most of the rows
        is split over many. Without it the tasks of ``df`` write what they have, which saves a shuffle
        where rows lie in well-sized partitions by snapshot already. A snapshot that had rows before
        and has none now is empty, so a rerun with other parameters leaves nothing behind.

        With ``buckets`` the rows are dealt by customer instead, one file for each bucket and snapshot, or
        more if they are large, and `by_customer` can read them without an exchange. AQE sizes the tasks as
        those of a rebalance: they are as many as the rows need, however few the buckets. A table without
        the column isn't dealt. With ``since`` the write fails, and changes nothing, if the table is
        no longer at that version (0: never written) when it ends.

        Returns the rows of each snapshot, counted by the tasks that write them. What ``measured`` makes of
        them is kept with the run. A column may be new, but may not change its type while other snapshots
        have it. A table exists from its first row on, one of a fixed schema from its first write on.
        """
        run = _new_run()
        versions = self.versions(layer, table)
        buckets = buckets if CUSTOMER in df.columns else 0
        rows = df.where(F.col(SNAPSHOT).isin(list(snapshots)))
        left = Run(rows.drop(SNAPSHOT).schema, buckets=buckets)
        none = {s.isoformat(): 0 for s in snapshots}
        # a conflict of types ends the write before its job
        before = versions.get()
        (before or Manifest()).after(run, left, none | dict.fromkeys(none, 1))
        if buckets:
            # a month of a bucket goes to one task if it is small, and to several if it is large
            bucket = F.pmod(F.hash(CUSTOMER), F.lit(buckets))
            rows = rows.withColumn(_BUCKET, bucket).hint("rebalance", SNAPSHOT, _BUCKET).drop(_BUCKET)
        elif rebalance:
            rows = _rebalanced(rows)
        counted = self._append(rows, layer, table, run, snapshots, buckets)
        counted.pop(_ALL)
        result = {date.fromisoformat(k): n for k, n in counted.items()}
        if any(counted.values()) or before is not None or (layer, table) in FIXED:
            left = replace(left, measured=measured(result) if measured else {})

            def change(newest: Manifest) -> Manifest:
                if since is not None and newest.version != since:
                    raise RuntimeError(f"{self.path(layer, table)} changed: version {newest.version}, not {since}")
                return newest.after(run, left, none | counted)

            versions.commit(change)
        return result

    def replace(self, df: DataFrame, layer: str, table: str, measured: dict[str, object] | None = None) -> int:
        """Write a table that has no snapshots, or no readable ones, in place of what was there."""
        run = _new_run()
        left = Run(df.schema, measured or {})
        counted = self._append(df, layer, table, run)[_ALL]
        # the only run: columns of earlier ones are forgotten
        self.versions(layer, table).commit(lambda newest: Manifest(newest.version).after(run, left, {WHOLE: counted}))
        return counted

    def _append(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        run: str,
        snapshots: Sequence[date] | None = None,
        buckets: int = 0,
    ) -> dict[str, int]:
        """Add files of a run; what its last stage counts on the way, where every row is counted once:
        all rows and, if the table has snapshots, those of each of them.

        Tasks leave their files in a folder of this run's own until the job ends, for another job may be
        adding files to the table at the same time.
        """
        path, attempt = self.path(layer, table), int(run[1:8], 16)
        seen = Observation()
        own = {
            "mapreduce.output.basename": run,
            "mapreduce.job.application.attempt.id": attempt,
            "mapreduce.fileoutputcommitter.cleanup.skipped": True,
            "compression": "zstd",
        }
        try:
            counted = df.observe(seen, F.count("*").alias(_ALL), *_tally(snapshots))
            if buckets:
                columns = counted.drop(SNAPSHOT).schema
                with self._catalogued(layer, table, columns, buckets, own) as name:
                    counted.select(*quoted(columns.names), SNAPSHOT).write.insertInto(name)
            else:
                by = [] if snapshots is None else [SNAPSHOT]
                counted.write.mode("append").options(**own).partitionBy(*by).parquet(path)
        finally:
            pending = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_temporary/{attempt}")
            pending.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(pending, True)
        found = _tallied(seen.get, snapshots)
        del counted, seen
        let_go(self.spark)
        return found

    def adopt(self, layer: str, table: str) -> None:
        """Take over a table that is partitioned by snapshot but was written by other tools.

        Its files must be named as Spark names them. They are opened once, for columns and counts.
        """
        versions = self.versions(layer, table)
        if versions.get() is not None:
            raise ValueError(f"{self.path(layer, table)} has a manifest already")
        reader = self.spark.read.option("mergeSchema", True).option("pathGlobFilter", f"{_FOREIGN}-*.parquet")
        df = reader.parquet(self.path(layer, table))
        counted = {r[0].isoformat(): r[1] for r in df.groupBy(SNAPSHOT).count().collect()}
        run = Run(df.drop(SNAPSHOT).schema)
        versions.commit(lambda newest: newest.after(_FOREIGN, run, counted))

    def expire(self, layer: str, table: str, keep: int = 1, older_than_s: float = 7 * 86_400) -> int:
        """Delete the manifests before the last ``keep``, and files that none of those kept names.

        Files younger than ``older_than_s`` stay: they may belong to a write that isn't committed yet. So
        must the time be longer than any write or read takes. Returns the number of files deleted.
        """
        path, versions = self.path(layer, table), self.versions(layer, table)
        numbers = versions.numbers()
        kept = [versions.get(n) for n in numbers[-keep:]]
        live = {(_folder(k), run) for m in kept for k, (run, _) in m.snapshots.items()}
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        latest = jvm.java.lang.System.currentTimeMillis() - 1000 * older_than_s
        deleted = 0
        for pattern in ("*.parquet", f"{SNAPSHOT}=*/*.parquet"):
            for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []:
                file = status.getPath()
                folder = f"{file.getParent().getName()}/" if "/" in pattern else ""
                run = file.getName().split("-", 1)[0]
                if (folder, run) not in live and status.getModificationTime() <= latest:
                    deleted += files.delete(file, False)
        for n in numbers[:-keep]:
            versions.forget(n)
        return deleted


def let_go(spark: SparkSession) -> None:
    """Delete the shuffle files of jobs that nothing refers to any more.

    Spark does that when the driver's collector finds a job gone: at once, or the shuffles of all writes of
    a load would lie on the executors' disks together.
    """
    spark._jvm.java.lang.System.gc()


def _new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def _rebalanced(rows: DataFrame) -> DataFrame:
    """The rows dealt by snapshot. Where most columns are text, as in bronze, they travel as one text each,
    which takes half the bytes."""
    texts = [c for c, dtype in rows.dtypes if dtype == "string"]
    others = [c for c in rows.columns if c not in texts]
    if len(texts) < _PACK_FROM or SNAPSHOT in texts:
        return rows.hint("rebalance", SNAPSHOT)
    cells = pack([F.col(c) for c in quoted(texts)]).alias(_CELLS)
    dealt = rows.select(*quoted(others), cells).hint("rebalance", SNAPSHOT)
    split = dealt.select(*quoted(others), F.split(_CELLS, END, -1).alias(_CELLS))
    column = {c: unpack(F.col(_CELLS)[i]).alias(c) for i, c in enumerate(texts)}
    return split.select(*[column[c] if c in column else F.col(*quoted([c])) for c in rows.columns])


def _found(manifest: Manifest, snapshots: Sequence[date] | None) -> dict[str, str]:
    """The run of each snapshot that is asked for and has rows."""
    asked = None if snapshots is None else {s.isoformat() for s in snapshots}
    return {k: run for k, (run, n) in manifest.snapshots.items() if n and (asked is None or k in asked)}


def _tally(snapshots: Sequence[date] | None) -> list[Column]:
    """An aggregate that counts the rows of each snapshot. It costs a row one step, however many snapshots
    there are: a histogram that has a bin for every date it can meet keeps them apart."""
    days = len(set(snapshots or []))
    return [F.histogram_numeric(F.unix_date(SNAPSHOT).cast("double"), F.lit(max(2, days))).alias(_DAYS)] if days else []


def _tallied(seen: dict, snapshots: Sequence[date] | None) -> dict[str, int]:
    """The count of all rows, and of each snapshot by its ISO date, from what `_tally` found."""
    counted = {_ALL: seen[_ALL]} | {s.isoformat(): 0 for s in snapshots or []}
    for day, n in seen.get(_DAYS) or []:
        # tasks' bins of one date are merged by a mean: the same date but for rounding
        counted[date.fromordinal(_EPOCH + round(day)).isoformat()] += round(n)
    if snapshots is not None and sum(counted.values()) != 2 * counted[_ALL]:
        raise RuntimeError(f"counted {counted}: the rows of the snapshots are not all rows")
    return counted


def _folder(snapshot: str) -> str:
    return f"{SNAPSHOT}={snapshot}/" if snapshot != WHOLE else ""


def export_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a table as a folder of headered CSV files, one per task; each is read by one task if compressed."""
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)
    let_go(df.sparkSession)


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table from `export_csv`: a blank cell is NULL, a quoted empty one is empty text."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "\0").csv(path)
