"""CSV files cut by many tasks against a read by one."""

import csv
import io
import random

import pytest

from plumbline.schemas import DOUBLE, INT, LONG, TEXT, struct
from plumbline.sources import files
from plumbline.sources.csv_records import csv_records

SCHEMA = struct(id=LONG, t=TEXT, v=DOUBLE)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts(seed, n):
    rnd = random.Random(seed)
    parts = ["word", ",", '"', "\n", "\n\n", "\r\n", "é", " ", '""', "'", "long " * 40, "\n" * 30, "x\n" * 400]
    weights = [9, 3, 2, 2, 1, 1, 2, 6, 1, 1, 1, 0.2, 0.05]
    return [(i, "a" + "".join(rnd.choices(parts, weights, k=rnd.randint(0, 14))) + "z", i / 4) for i in range(n)]


def written(rows, order=("id", "t", "v"), end="\r\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(order)
    for row in rows:
        named = dict(zip(("id", "t", "v"), row))
        writer.writerow([named.get(c, "more") for c in order])
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_many_splits(spark, small_splits, tmp_path, end):
    rows = texts(1, 300)
    (tmp_path / "t.csv").write_bytes(written(rows, end=end).encode())
    records, headers = csv_records(spark, str(tmp_path / "t.csv"))
    assert headers == [["id", "t", "v"]] and records.count() == 300
    assert records.rdd.getNumPartitions() > 20
    found = files.csv_scan(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert sorted(map(tuple, found.collect())) == rows


def test_each_file_of_a_folder_by_its_own_header(spark, small_splits, tmp_path):
    rows = texts(2, 240)
    for n, order in enumerate([("id", "t", "v"), ("v", "extra", "id", "t"), ("t", "v", "id")]):
        (tmp_path / f"{n}.csv").write_bytes(("﻿" if n == 2 else "").encode() + written(rows[80 * n : 80 * n + 80], order).encode())
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,t,v")
    assert sorted(map(tuple, files.csv_scan(spark, str(tmp_path), SCHEMA).collect())) == rows
    kept, rejects = files.csv_scan_skip_errors(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, kept.collect())) == rows and rejects.count() == 0
    assert files.csv_scan(spark, str(tmp_path), struct(v=DOUBLE)).count() == 240


def test_one_record_over_many_splits_and_an_open_quote(spark, small_splits, tmp_path):
    rows = [(1, "a", 1.0), (2, "line\n" * 3000 + "end", 2.0), (3, "b", 3.0)]
    (tmp_path / "t.csv").write_text(written(rows, end="\n"))
    assert sorted(map(tuple, files.csv_scan(spark, str(tmp_path / "t.csv"), SCHEMA).collect())) == rows
    (tmp_path / "open.csv").write_text('id,t,v\n1,a,1\n2,"open' + " and on\n" * 400)
    kept, rejects = files.csv_scan_skip_errors(spark, str(tmp_path / "open.csv"), SCHEMA)
    assert [tuple(r) for r in kept.collect()] == [(1, "a", 1.0)] and rejects.count() == 1


def test_no_plan_leaves_a_fault_out(spark, tmp_path):
    (tmp_path / "short.csv").write_text("id,v\n2,x\n3\n")
    (tmp_path / "value.csv").write_text("id,v\n1,2\n2,x\n")
    for name in ("short.csv", "value.csv"):
        for multi_line in (True, False):
            rows = files.csv_scan(spark, str(tmp_path / name), struct(id=LONG, v=INT), multi_line=multi_line)
            for act in (lambda df: df.count(), lambda df: df.select("id").collect(), lambda df: df.limit(0).unionAll(df).count()):
                with pytest.raises(Exception, match="wrong number of fields|v holds x"):
                    act(rows)


def test_header_over_several_lines_and_missing_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text('"id","two\nlines"\n1,x\n')
    assert csv_records(spark, str(tmp_path / "t.csv"))[1] == [["id", "two\nlines"]]
    (tmp_path / "u.csv").write_text("id,t,v\n1,x,1\n")
    with pytest.raises(ValueError, match="missing columns: t, v"):
        files.csv_scan(spark, str(tmp_path), SCHEMA)
