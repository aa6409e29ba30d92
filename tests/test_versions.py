"""Replacement in one step and appends that count only when they are complete."""

import pytest
from pyspark.sql import functions as F

from plumbline.schemas import LONG, TEXT, struct
from plumbline.sources import files, versions
from plumbline.streaming import incremental

TEXTS = struct(id=LONG, t=TEXT)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_job_replaces_the_table_that_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(10), path)
    old = files.table_scan(spark, path)
    new = files.replace_table(files.table_scan(spark, path).filter("id < 4"), path)
    assert ids(new) == ids(files.table_scan(spark, path)) == [0, 1, 2, 3]
    assert ids(old) == list(range(10))  # a reader stays with the version that it found
    assert versions.versions(spark, path) == [1, 2] and ids(versions.read_version(spark, path, 1)) == list(range(10))
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path, 3)
    versions.drop_versions(spark, path)
    assert versions.versions(spark, path) == [2] and ids(files.table_scan(spark, path)) == [0, 1, 2, 3]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 1


def test_a_stopped_or_running_write_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path)
    broken = spark.range(8).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("stopped")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stopped"):
        files.replace_table(broken, path)
    spark.range(99).write.parquet(f"{path}/data-halfway")  # all files there, not marked yet
    assert ids(files.table_scan(spark, path)) == [0, 1, 2]
    assert ids(files.replace_table(spark.range(5), path)) == [0, 1, 2, 3, 4]


def test_two_jobs_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(1), path)
    found = iter([[1], [1, 2]])  # another job publishes while this one writes
    monkeypatch.setattr(versions, "versions", lambda *_: next(found))
    with pytest.raises(RuntimeError, match="published meanwhile"):
        versions.publish_version(spark.range(2), path)
    monkeypatch.undo()
    assert ids(files.table_scan(spark, path)) == [0]


def test_a_stopped_run_keeps_its_finished_slices(spark, tmp_path):
    target, df = str(tmp_path / "t"), spark.createDataFrame([(i, "x") for i in range(40)], TEXTS)
    seen, calls = [], []

    def work(rows):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        seen.append(ids(rows))
        return rows

    with pytest.raises(RuntimeError):
        incremental.resume_append(df, target, work, "id", TEXTS, slices=4)
    kept = sorted(sum(seen, []))
    assert 0 < len(kept) < 40 and ids(versions.read_parts(spark, target, TEXTS)) == kept
    (tmp_path / "t" / "part-left").mkdir()  # what a stopped job leaves
    spark.createDataFrame([(99, "half")], TEXTS).write.mode("overwrite").parquet(f"{target}/part-left")
    seen.clear()
    out = incremental.resume_append(df, target, work, "id", TEXTS, slices=4)
    assert ids(out) == list(range(40)) and sorted(sum(seen, [])) == sorted(set(range(40)) - set(kept))
