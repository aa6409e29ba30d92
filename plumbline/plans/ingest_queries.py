"""Files in and out, profiles, publishing, incremental jobs. Each run writes to a fresh shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import metrics
from plumbline.operators.models import phrase_signal_classifier
from plumbline.operators.validation import validate_required_columns
from plumbline.plans.registry import query
from plumbline.plans.views import K, PHRASES, sql
from plumbline.schemas import DOUBLE, FLAG, INT, LONG, TEXT, struct
from plumbline.sources import files, profile, publish
from plumbline.storage import run_folder
from plumbline.streaming import incremental

LABELLED_TEXT = struct(complaint_id=LONG, product=TEXT, source=TEXT, narrative=TEXT, n_chars=LONG)
GOLDEN_CSV = struct(complaint_id=LONG, product=TEXT, narrative=TEXT, churn_signal=INT, ambiguous=FLAG)


@query(
    "s1_csv_scan",
    sql("complaints", "SELECT complaint_id, product, source, narrative, n_chars FROM complaints"),
)
def s1(v):
    path = run_folder(v.spark, "csv")
    even = F.col("complaint_id") % 2 == 0
    swapped = v.complaints.filter(even).select("narrative", "n_chars", F.lit("x").alias("further"), "product", "source", "complaint_id")
    files.write_csv(swapped, f"{path}/swapped")
    files.write_csv(v.complaints.filter(~even).select(*LABELLED_TEXT.fieldNames()), f"{path}/plain")
    return files.csv_scan(v.spark, f"{path}/*", LABELLED_TEXT)


@query(
    "s2_csv_scan_skip_errors",
    "SELECT event_id, value FROM events WHERE event_type <> 'error'",
)
def s2(v):
    path = run_folder(v.spark, "csv-errors")
    shown = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    rows, early = v.read("events").withColumn("value", shown), F.col("event_id") < 500
    files.write_csv(rows.filter(early).select("value", "event_id"), f"{path}/early")
    files.write_csv(rows.filter(~early).select("event_id", "user_id", "value"), f"{path}/late")
    kept, _ = files.csv_scan_skip_errors(v.spark, f"{path}/*", struct(event_id=LONG, value=DOUBLE))
    return kept


@query("s2_rejected_lines", "SELECT concat('n/a,', event_id) AS line FROM events WHERE event_type = 'error'")
def s2_rejects(v):
    path = run_folder(v.spark, "csv-errors")
    shown = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    files.write_csv(v.read("events").select(shown.alias("value"), "event_id"), path)
    _, rejects = files.csv_scan_skip_errors(v.spark, path, struct(event_id=LONG, value=DOUBLE), multi_line=False)
    return rejects


@query(
    "s3_latest_snapshot",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= DATE '1998-01-01'",
)
def s3(v):
    root = run_folder(v.spark, "snapshots")
    orders = v.read("orders")
    for name, since in (("2026-02", "1995-01-01"), ("2026-03", "1998-01-01"), ("2026-01", "2000-01-01")):
        part = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("date")).select("o_orderkey", "o_custkey")
        files.write_csv(part, f"{root}/orders_{name}.csv")
    newest = files.latest_snapshot(v.spark, root, "orders_")
    return files.csv_scan(v.spark, newest, struct(o_orderkey=LONG, o_custkey=LONG), multi_line=False)


@query("s4_replace_table", "SELECT c_custkey, c_mktsegment FROM customer")
def s4(v):
    path = run_folder(v.spark, "replaced")
    rows = v.read("customer").select("c_custkey", "c_mktsegment")
    files.replace_table(rows.filter("c_acctbal > 0"), path)
    return files.replace_table(rows, path)


@query("s5_table_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def s5(v):
    return files.table_scan(v.spark, f"{v.folder}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query(
    "s6_ingest_profile",
    """SELECT 'customer' AS table_name, count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM customer
       UNION ALL SELECT 'documents', count(*), 5 FROM documents""",
)
def s6(v):
    return profile.ingest_profile({name: v.read(name) for name in ("customer", "documents")})


@query(
    "s7_describe_table",
    """SELECT 'doc_id' AS column_name, 'bigint' AS column_type, count(doc_id) AS n_values FROM documents
       UNION ALL SELECT 'text', 'string', count(text) FROM documents
       UNION ALL SELECT 'lang', 'string', count(lang) FROM documents
       UNION ALL SELECT 'source', 'string', count(source) FROM documents
       UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM documents""",
)
def s7(v):
    return profile.describe_table(v.read("documents"))


@query(
    "s8_date_window_extract",
    """SELECT o_orderkey, '19960101_19970630' AS suffix FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
)
def s8(v):
    from plumbline.functions.text import snapshot_suffix

    bounds = ("1996-01-01", "1997-06-30")
    kept = files.date_window_extract(v.read("orders"), "o_orderdate", *bounds)
    return kept.select("o_orderkey", F.lit(snapshot_suffix(*bounds)).alias("suffix"))


@query(
    "s9_read_golden_csv",
    sql("golden_raw", "SELECT complaint_id, product, narrative, churn_signal, ambiguous FROM golden_raw"),
)
def s9(v):
    path = run_folder(v.spark, "golden-csv")
    names, first = GOLDEN_CSV.fieldNames(), F.col("churn_signal") == 1
    files.write_csv(v.golden_raw.filter(first).select(*names), f"{path}/first")
    files.write_csv(v.golden_raw.filter(~first).select(*reversed(names)), f"{path}/second")
    return validate_required_columns(files.csv_scan(v.spark, f"{path}/*", GOLDEN_CSV))


@query("s10_write_csv", sql("folds", "SELECT complaint_id, fold FROM folds"))
def s10(v):
    path = run_folder(v.spark, "folds-csv")
    files.write_csv(v.folds.select("complaint_id", "fold").orderBy("complaint_id"), path)
    return files.csv_scan(v.spark, path, struct(complaint_id=LONG, fold=INT))


@query(
    "s11_atomic_replace_write",
    sql("complaints", "SELECT complaint_id, CASE WHEN product = 'fr' THEN 0 ELSE n_chars END AS n_chars, product FROM complaints"),
)
def s11(v):
    path = run_folder(v.spark, "partitions")
    rows = v.complaints.select("complaint_id", "n_chars", "product")
    files.atomic_replace_write(rows, path, "product")
    fixed = rows.filter("product = 'fr'").withColumn("n_chars", F.lit(0).cast("long"))
    files.atomic_replace_write(fixed, path, "product")
    return files.table_scan(v.spark, path, ["complaint_id", "n_chars", "product"])


@query(
    "s12_write_result_document",
    sql("fold_scores", """SELECT model, fold, n_test, n_positive_test, round_even(f1, 3) AS f1, tn, tp FROM fold_scores"""),
)
def s12(v):
    path = run_folder(v.spark, "result-json")
    per_fold = metrics.per_fold_metrics(v.judged, "churn_signal", "predicted_label", ["model", "fold"])
    fields = ["fold", "n_test", "n_positive_test", F.bround("f1", 3).alias("f1"), "matrix"]
    document = per_fold.groupBy("model").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("per_fold"))  # k entries
    files.write_result_document(document, path)
    fold = "fold int, n_test bigint, n_positive_test bigint, f1 double, matrix array<array<bigint>>"
    read = v.spark.read.schema(f"model string, per_fold array<struct<{fold.replace(' ', ':').replace(',:', ', ')}>>").json(path)
    rows = read.select("model", F.inline("per_fold"))
    return rows.select(
        "model", "fold", "n_test", "n_positive_test", "f1", F.col("matrix")[0][0].alias("tn"), F.col("matrix")[1][1].alias("tp")
    )


@query(
    "s13_explode_keyed_json",
    sql("preds", """SELECT complaint_id, predicted_label FROM preds WHERE model = 'length'"""),
)
def s13(v):
    path = run_folder(v.spark, "keyed-json")
    entry = F.create_map(F.col("complaint_id").cast("string"), F.col("predicted_label"))
    v.pred("length").select(F.to_json(entry).alias("value")).write.text(path)
    documents = v.spark.read.text(path)
    return files.explode_keyed_json(documents, "value", "int", "complaint_id", "predicted_label")


@query(
    "s14_publish_dataset",
    sql(
        "golden",
        f"""SELECT p.predictions, r."check", CAST(CASE r.v WHEN 'n' THEN n WHEN 'pos' THEN pos WHEN 'k' THEN {K} ELSE 0 END AS BIGINT)
                AS found, CAST(CASE r.v WHEN 'k' THEN {K} WHEN '0' THEN 0 END AS BIGINT) AS expected, true AS ok
            FROM (SELECT count(*) AS n, CAST(sum(churn_signal) AS BIGINT) AS pos FROM golden),
                 (VALUES ('tfidf_predictions'), ('llm_predictions')) AS p(predictions),
                 (VALUES ('golden_rows', 'n'), ('golden_positives', 'pos'), ('golden_bad_labels', '0'), ('fold_rows', 'n'),
                         ('fold_values', 'k'), ('fold_bad_values', '0'), ('prediction_rows', 'n'),
                         ('prediction_null_labels', '0'), ('prediction_null_folds', '0')) AS r("check", v)""",
    ),
)
def s14(v):
    ids = v.golden.select("complaint_id", "product", F.col("churn_signal").alias("true_label"))
    text = v.pred("lexicon").join(ids.select("complaint_id"), "complaint_id")
    model = (
        v.pred("length")
        .join(ids, "complaint_id")
        .withColumns(
            {"parse_failed": F.lit(False), "rationale": F.lit("by length"), "eval_duration_ms": F.lit(1.5)}
        )
    )
    golden = v.golden.select("complaint_id", "product", "narrative", "churn_signal")
    return publish.publish_dataset(v.spark, run_folder(v.spark, "published"), golden, v.folds, text, model, K)


SIGNALS = struct(complaint_id=LONG, evidence=TEXT, predicted_label=INT)
_SIGNAL_SQL = rf"""SELECT complaint_id,
                      regexp_extract(lower(narrative), '(?:^|[^\p{{L}}\p{{N}}_])({"|".join(PHRASES)})(?:[^\p{{L}}\p{{N}}_]|$)', 1) AS evidence,
                      CASE WHEN regexp_matches(lower(narrative), '(?:^|[^\p{{L}}\p{{N}}_])({"|".join(PHRASES)})(?:[^\p{{L}}\p{{N}}_]|$)')
                           THEN 1 ELSE 0 END AS predicted_label
                  FROM complaints"""


def signals(df):
    return phrase_signal_classifier(df, "narrative", PHRASES).select(*SIGNALS.fieldNames())


@query("x1_resume_append", sql("complaints", _SIGNAL_SQL))
def x1(v):
    """A run over one product, then a run over everything: the second adds only what is missing."""
    target = run_folder(v.spark, "signals")
    incremental.resume_append(v.complaints.filter("product = 'fr'"), target, signals, "complaint_id", SIGNALS)
    return incremental.resume_append(v.complaints, target, signals, "complaint_id", SIGNALS)


@query("x1_stream_append", sql("complaints", _SIGNAL_SQL))
def x1_stream(v):
    """The same from a folder of drops; each run takes the files that are new."""
    folder = run_folder(v.spark, "drops")
    source, target, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    for is_first in (True, False):
        rows = v.complaints.filter((F.col("product") == "en") == F.lit(is_first))
        files.append_table(rows, source)
        done = incremental.stream_append(v.spark, source, LABELLED_TEXT, target, checkpoint, signals)
    return done.select(*SIGNALS.fieldNames())


@query(
    "x2_monthly_drop_ingest",
    """SELECT doc_id, source, CASE WHEN l THEN 2 ELSE 1 END AS version, CASE WHEN l THEN n_chars + 1 ELSE n_chars END AS n_chars
       FROM documents LEFT JOIN (SELECT doc_id, true AS l FROM labels) USING (doc_id)""",
)
def x2(v):
    """A drop with all texts, then one that brings new versions of the labelled ones."""
    folder = run_folder(v.spark, "monthly")
    source, target, checkpoint = f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint"
    first = v.read("documents").select("doc_id", "source", F.lit(1).alias("version"), "n_chars")
    newer = first.join(v.read("labels").select("doc_id"), "doc_id", "left_semi")
    second = newer.withColumns({"version": F.lit(2), "n_chars": F.col("n_chars") + 1})
    for drop in (first, second):
        files.append_table(drop, source)
        table = incremental.monthly_drop_ingest(v.spark, source, first.schema, target, checkpoint, "doc_id", "version")
    return table


@query("x3_idempotent_rerun", sql("folds", "SELECT complaint_id, churn_signal, fold FROM folds"))
def x3(v):
    target = run_folder(v.spark, "rerun")
    incremental.idempotent_rerun(lambda: v.folds, target)
    return incremental.idempotent_rerun(lambda: v.folds, target)


@query(
    "x4_retry_missing",
    sql(
        "complaints",
        """SELECT complaint_id FROM complaints WHERE substr(md5(CAST(complaint_id AS VARCHAR)), 1, 1) = '0'""",
    ),
)
def x4(v):
    """The first run gets replies for half of the ids, the second for all but one in sixteen."""
    from plumbline.plans.views import hex_digit

    target = run_folder(v.spark, "proposals")
    layout = struct(complaint_id=LONG, narrative=TEXT, proposed_label=INT, evidence_quote=TEXT, confidence=TEXT, evidence_verbatim=FLAG, labeler_model=TEXT)
    template = v.complaints.select("complaint_id", "narrative")

    def ask(from_digit):
        def reply(todo):
            answered = todo.filter(hex_digit("complaint_id") >= from_digit)
            return answered.select(
                F.col("complaint_id").alias("id"),
                F.lit(0).alias("position"),
                F.lit(0).alias("label"),
                F.lit("").alias("evidence"),
                F.lit("low").alias("confidence"),
            )

        return reply

    for digit in ("8", "1"):
        missing = incremental.retry_missing(template, target, ask(digit), "complaint_id", "rule v1", layout)
    return missing.select("complaint_id")


@query(
    "l8_scorer_plugin",
    sql("complaints", "SELECT complaint_id, CASE WHEN length(narrative) > 1000 THEN 1 ELSE 0 END AS predicted_label FROM complaints"),
)
def l8(v):
    def by_length(batch):
        label = (batch["narrative"].str.len() > 1000).astype("int32")
        return batch[["complaint_id"]].assign(predicted_label=label)

    rows = v.complaints.select("complaint_id", "narrative")
    return incremental.score_with(rows, by_length, "complaint_id bigint, predicted_label int")
