"""Manifests: writes that fail, run at the same time, or change columns; counts, old versions, clean-up."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanstrata.functions.dates import month_starts
from loanstrata.sources.lake import Lake
from loanstrata.sources.manifest import Manifest, Run, Versions, merged

DAYS = month_starts("2023-01-01", "2024-12-01")
A, B, C = DAYS[:3]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def table(spark, *rows, columns="v int"):
    return spark.createDataFrame(list(rows), f"{columns}, snapshot_date date")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(lake, layer="silver", name="t"):
    return sorted(p for p in Path(lake.path(layer, name)).rglob("*.parquet"))


def test_a_failed_write_changes_nothing(spark, lake):
    lake.write(table(spark, (1, A), (2, B)), "silver", "t", [A, B])
    before = files(lake)
    # the task of A ends well and may leave its file, the one of B fails
    broken = spark.range(4000).select(
        F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise(F.lit(7)).cast("int").alias("v"),
        F.when(F.col("id") < 2000, F.lit(A)).otherwise(F.lit(B)).alias("snapshot_date"),
    )
    with pytest.raises(Exception, match="lost"):
        lake.write(broken, "silver", "t", [A, B])
    assert found(lake.read("silver", "t")) == [(1, A), (2, B)]
    assert set(before) <= set(files(lake)) and lake.manifest("silver", "t").version == 1


def test_files_that_no_manifest_names_are_not_read(spark, lake):
    """As after a driver that died between the job and the commit, or during a write that is at work."""
    lake.write(table(spark, (1, A), (2, B)), "silver", "t", [A, B])
    half = table(spark, (9, B), (9, C)).write.mode("append").option("mapreduce.output.basename", "rdead")
    half.partitionBy("snapshot_date").parquet(lake.path("silver", "t"))
    assert len(files(lake)) == 4
    assert found(lake.read("silver", "t")) == [(1, A), (2, B)]
    assert lake.read("silver", "t", [C]).isEmpty()
    lake.write(table(spark, (3, B)), "silver", "t", [B])
    assert found(lake.read("silver", "t")) == [(1, A), (3, B)]


def test_a_first_write_that_fails_leaves_no_table(spark, lake):
    broken = table(spark, (1, A)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        lake.write(broken, "silver", "t", [A])
    assert lake.read("silver", "t") is None and lake.rows("silver", "t") == {}


def test_writers_of_different_snapshots(spark, lake):
    def write(day, v):
        lake.write(table(spark, (v, day)), "silver", "t", [day])

    threads = [threading.Thread(target=write, args=(day, i)) for i, day in enumerate(DAYS[:6])]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found(lake.read("silver", "t")) == sorted(((i, d) for i, d in enumerate(DAYS[:6])), key=str)
    assert lake.versions("silver", "t").numbers() == [1, 2, 3, 4, 5, 6]
    assert list(Path(lake.path("silver", "t")).glob("_temporary/*")) == []


def test_of_two_commits_one_is_first(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    late = []

    def change(newest):
        if not late:
            late.append(versions.commit(lambda m: m.after("rother", Run(StructType()), {"2023-01-01": 1})))
        return newest.after("rmine", Run(StructType()), {"2023-02-01": 2})

    assert versions.commit(change).version == 2
    assert versions.get().snapshots == {"2023-01-01": ("rother", 1), "2023-02-01": ("rmine", 2)}
    with pytest.raises(RuntimeError, match="other commits"):
        versions.commit(lambda m: Manifest().after("rnever", Run(StructType()), {"2023-03-01": 1}), tries=3)
    # nothing staged is left behind
    assert all(p.name.endswith(".crc") for p in (tmp_path / "_manifests").glob(".*"))


def test_many_commits_at_once_lose_none(spark, tmp_path):
    """Writers that find the same newest version: each commit is there in the end."""
    tables = [Versions(spark, str(tmp_path / "t")) for _ in range(8)]
    days = [f"2023-01-{d:02d}" for d in range(1, 25)]

    def commit(i):
        for day in days[i::8]:
            tables[i].commit(lambda m: m.after(f"r{day}", Run(StructType()), {day: 1}))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(commit, range(8)))
    last = tables[0].get()
    assert sorted(last.snapshots) == days and last.version == len(days)
    assert tables[0].numbers() == list(range(1, len(days) + 1))
    left = [p.name for p in (tmp_path / "t" / "_manifests").iterdir()]
    assert sorted(left) == [f"{n:010d}.json" for n in range(1, len(days) + 1)]


def test_no_file_is_opened_for_a_schema(spark, lake):
    """Files emptied of all content still plan a read of 24 months, with the columns of all runs."""
    wide = "v int, w string"
    lake.write(spark.createDataFrame([(1, d) for d in DAYS[:12]], "v int, snapshot_date date"), "silver", "t", DAYS[:12])
    lake.write(table(spark, *[(1, "x", d) for d in DAYS[12:]], columns=wide), "silver", "t", DAYS[12:])
    for file in files(lake):
        file.write_bytes(b"")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    df = lake.read("silver", "t")
    assert df.dtypes == [("v", "int"), ("w", "string"), ("snapshot_date", "date")]
    assert len(df.inputFiles()) == 24
    assert lake.read("silver", "t", DAYS[:3]).columns == ["v", "snapshot_date"]
    assert lake.rows("silver", "t") == dict.fromkeys(DAYS, 1)


def test_columns_that_come_go_and_conflict(spark, lake):
    lake.write(table(spark, (1, A)), "silver", "t", [A])
    lake.write(table(spark, ("x", 2, B), columns="w string, V int"), "silver", "t", [B])
    assert lake.read("silver", "t").columns == ["v", "w", "snapshot_date"]
    assert found(lake.read("silver", "t")) == [(1, None, A), (2, "x", B)]
    n = len(files(lake))
    with pytest.raises(ValueError, match="'v' is int in one run and string"):
        lake.write(table(spark, ("no", C), columns="v string"), "silver", "t", [C])
    assert len(files(lake)) == n
    # no other snapshot has the old type any more
    lake.write(table(spark, ("yes", A), columns="v string"), "silver", "t", [A, B])
    assert found(lake.read("silver", "t")) == [("yes", A)]
    assert merged([StructType(), StructType()]) == StructType()


def test_old_versions_and_clean_up(spark, lake):
    lake.write(table(spark, (1, A), (2, B)), "silver", "t", [A, B])
    lake.write(table(spark, (3, B)), "silver", "t", [B])
    lake.write(table(spark), "silver", "t", [A])
    assert found(lake.read("silver", "t", version=1)) == [(1, A), (2, B)]
    assert found(lake.read("silver", "t", version=2)) == [(1, A), (3, B)]
    assert found(lake.read("silver", "t")) == [(3, B)]
    assert lake.expire("silver", "t", keep=2, older_than_s=3600) == 0
    with pytest.raises(ValueError, match="no version 1"):
        lake.read("silver", "t", version=1)
    assert lake.expire("silver", "t", keep=2, older_than_s=0) == 1
    assert found(lake.read("silver", "t", version=2)) == [(1, A), (3, B)]
    assert lake.expire("silver", "t", older_than_s=0) == 1
    assert found(lake.read("silver", "t")) == [(3, B)] and len(files(lake)) == 1


def test_a_table_without_snapshots(spark, lake):
    df = spark.range(3).select("id", F.lit(A).alias("snapshot_date"))
    assert lake.replace(df, "quality", "m", {"why": "test"}) == 3
    assert sorted(r.id for r in lake.read("quality", "m").collect()) == [0, 1, 2]
    lake.replace(spark.range(2).toDF("other"), "quality", "m")
    assert lake.read("quality", "m").columns == ["other"]
    assert lake.replace(spark.range(0), "quality", "m") == 0
    assert lake.read("quality", "m").isEmpty() and lake.read("quality", "m").columns == ["id"]
    assert lake.expire("quality", "m", older_than_s=0) > 0
    assert lake.read("quality", "m").isEmpty()


def test_rows_are_counted_by_the_write(spark, lake):
    n = 5000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(A)).otherwise(F.lit(B)).alias("snapshot_date"))
    for rebalance in (True, False):
        written = lake.write(df, "silver", "t", [A, B, C], rebalance)
        assert written == {A: 1667, B: 3333, C: 0}
        assert lake.rows("silver", "t") == {A: 1667, B: 3333}
        assert dict(lake.read("silver", "t").groupBy("snapshot_date").count().collect()) == {A: 1667, B: 3333}


def test_nothing_to_write(spark, lake):
    assert lake.write(table(spark), "silver", "t", [A]) == {A: 0}
    assert lake.read("silver", "t") is None
    assert lake.write(table(spark, (1, A)), "silver", "t", []) == {}
    assert lake.read("silver", "t") is None


def test_tables_of_other_tools(spark, lake):
    both = table(spark, (1, A), (2, A), (3, B))
    both.write.partitionBy("snapshot_date").parquet(lake.path("silver", "t"))
    assert lake.read("silver", "t") is None
    lake.adopt("silver", "t")
    assert found(lake.read("silver", "t")) == [(1, A), (2, A), (3, B)]
    assert lake.rows("silver", "t") == {A: 2, B: 1}
    lake.write(table(spark, (9, A)), "silver", "t", [A])
    assert found(lake.read("silver", "t")) == [(3, B), (9, A)]
    with pytest.raises(ValueError, match="manifest already"):
        lake.adopt("silver", "t")


def test_manifest_round_trip():
    schema = StructType.fromDDL("a string, b array<double>")
    one = Manifest().after("r1", Run(schema, {"rows_loaded": 3}), {"2023-01-01": 3, "2023-02-01": 0})
    assert one.snapshots == {"2023-01-01": ("r1", 3)}
    two = one.after("r2", Run(schema), {"2023-01-01": 4})
    assert list(two.runs) == ["r2"] and two.version == 2
    assert Manifest.from_json(two.to_json()) == two
    emptied = two.after("r3", Run(schema), {"2023-01-01": 0})
    assert emptied.snapshots == {} and emptied.columns(set()) == schema
    assert isinstance(date.fromisoformat(emptied.committed_at[:10]), date)
