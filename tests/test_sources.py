import pytest
from pyspark.sql import functions as F

from plumbline import storage
from plumbline.schemas import DOUBLE, INT, LONG, TEXT, struct
from plumbline.sources import files, publish
from plumbline.streaming import incremental

TEXTS = struct(id=LONG, t=TEXT)


def test_csv_keeps_line_breaks_quotes_and_blanks(spark, tmp_path):
    rows = [(1, 'a\n"b", c\\'), (2, "  x \r\n y "), (3, None), (4, "")]
    df = spark.createDataFrame(rows, TEXTS)
    files.write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, files.csv_scan(spark, str(tmp_path / "t"), TEXTS).collect())) == [
        *rows[:3],
        (4, None),  # an empty field reads as missing
    ]


def test_bad_rows_are_kept_apart_whatever_is_selected(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,v\n1,2.5\n2,x\nz,3\n4,4.0\n5\n6,1,1\n7,\n")
    kept, rejects = files.csv_scan_skip_errors(spark, str(tmp_path / "t.csv"), struct(id=LONG, v=DOUBLE))
    assert sorted(r["id"] for r in kept.select("id").collect()) == [1, 4, 7]
    assert sorted(r["line"] for r in rejects.collect()) == ["2,x", "5", "6,1,1", "z,3"]


def test_no_snapshot_is_an_error(spark, tmp_path):
    (tmp_path / "other.csv").write_text("id\n1\n")
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, str(tmp_path), "orders_")


def test_date_bounds_reach_the_scan(spark, capsys):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    files.date_window_extract(orders, "o_orderdate", "1996-01-01", None).select("o_orderkey").explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_totalprice" not in plan


def test_open_date_windows(spark):
    df = spark.sql("select date'2026-01-01' as d union all select date'2026-02-01'")
    assert files.date_window_extract(df, "d", None, None).count() == 2
    assert files.date_window_extract(df, "d", None, "2026-01-31").count() == 1


def test_publishing_stops_at_an_id_without_a_fold(spark, tmp_path):
    golden = spark.createDataFrame([(1, "p", "t", 1), (2, "p", "t", 0)], "complaint_id long, product string, narrative string, churn_signal int")
    folds = spark.createDataFrame([(1, 0)], "complaint_id long, fold int")
    preds = golden.select("complaint_id", F.lit(1).alias("predicted_label"))
    model = golden.select(
        "complaint_id", "product", F.col("churn_signal").alias("true_label"), F.lit(1).alias("predicted_label"),
        F.lit(False).alias("parse_failed"), F.lit("r").alias("rationale"), F.lit(1.0).alias("eval_duration_ms"),
    )
    with pytest.raises(Exception, match="no entry for complaint_id 2"):
        publish.publish_dataset(spark, str(tmp_path), golden, folds, preds, model, 1)


def test_resumed_runs_do_only_what_is_missing(spark, tmp_path):
    seen = []

    def work(df):
        seen.append(sorted(r["id"] for r in df.collect()))
        return df

    target, df = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], TEXTS)
    incremental.resume_append(df.filter("id < 3"), target, work, "id", TEXTS)
    out = incremental.resume_append(df, target, work, "id", TEXTS)
    assert seen == [[1, 2], [3]] and out.count() == 3


def test_a_repeated_drop_changes_nothing(spark, tmp_path):
    schema = struct(id=LONG, version=INT, t=TEXT)
    source, target, state = (str(tmp_path / n) for n in ("in", "table", "state"))

    def ingest(rows):
        files.append_table(spark.createDataFrame(rows, schema), source)
        table = incremental.monthly_drop_ingest(spark, source, schema, target, state, "id", "version")
        return sorted((r["id"], r["version"], r["t"]) for r in table.collect())

    first = ingest([(1, 1, "a"), (2, 1, "b")])
    assert ingest([(1, 1, "a")]) == first
    assert ingest([(2, 3, "new"), (2, 2, "older")]) == [(1, 1, "a"), (2, 3, "new")]


def test_scorer_is_tried_again_then_fails(spark, tmp_path):
    marks = tmp_path / "marks"
    marks.mkdir()

    def flaky(batch):
        tries = len(list(marks.iterdir()))
        (marks / str(tries)).write_text("")
        if tries < 2:
            raise ConnectionError("busy")
        return batch

    df = spark.createDataFrame([(1, "a")], TEXTS).coalesce(1)
    assert incremental.score_with(df, flaky, TEXTS, attempts=3, delay_s=0).count() == 1

    def broken(batch):
        raise ConnectionError("down for good")

    with pytest.raises(Exception, match="down for good"):
        incremental.score_with(df, broken, TEXTS, attempts=2, delay_s=0).collect()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default):
            return self.value

    class Fake:
        def __init__(self, value):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": "yarn"})()

    assert storage.shared_root(Fake("hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    with pytest.raises(RuntimeError):
        storage.shared_root(Fake(None))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("v,extra,id\n2.5,x,1\n,y,2\n")
    rows = files.csv_scan(spark, str(tmp_path / "t.csv"), struct(id=LONG, v=DOUBLE)).collect()
    assert [tuple(r) for r in rows] == [(1, 2.5), (2, None)]
    kept, rejects = files.csv_scan_skip_errors(spark, str(tmp_path / "t.csv"), struct(id=LONG, v=DOUBLE), multi_line=False)
    assert [tuple(r) for r in kept.collect()] == [(1, 2.5), (2, None)] and rejects.count() == 0


def test_csv_faults_are_errors(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,v\n1,2.5\n2,x\n")
    (tmp_path / "short.csv").write_text("id,v\n1\n")
    with pytest.raises(ValueError, match="missing columns: w"):
        files.csv_scan(spark, str(tmp_path / "t.csv"), struct(id=LONG, w=DOUBLE))
    for name in ("t.csv", "short.csv"):
        with pytest.raises(Exception):
            files.csv_scan(spark, str(tmp_path / name), struct(id=LONG, v=DOUBLE)).collect()


def test_keyed_json_over_lines_and_unreadable_documents(spark):
    docs = spark.createDataFrame([('{"1": 5,\n "2": 6}',), (None,)], "d string")
    assert sorted(map(tuple, files.explode_keyed_json(docs, "d", "int", "id", "n").collect())) == [(1, 5), (2, 6)]
    with pytest.raises(Exception, match="not a map of ids"):
        files.explode_keyed_json(spark.createDataFrame([("{1",)], "d string"), "d", "int", "id", "n").collect()
