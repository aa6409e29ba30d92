"""The driver's tables in the shape the operators expect, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import id_hash, padded
from plumbline.operators.joins import label_fold_join
from plumbline.operators.models import AccountColumns, phrase_signal_classifier
from plumbline.operators.sampling import stratified_kfold
from plumbline.plans.registry import Tables

K = 5
PHRASES = ("que la", "nicht", "of the")
FILLER = " More words."
CUTOFF = "2001-01-01"

ACCOUNT_ROLES = AccountColumns(
    key="customer_id",
    label="churn",
    categorical=("segment", "nation"),
    boolean=("urgent",),
    numeric=("tenure", "monthly"),
    text_numbers=("total",),
)


def hex_digit(key: str) -> Column:
    """First hex digit of the id's hash, to vary replies from row to row."""
    return F.substring(id_hash(F.col(key)), 1, 1)


class Views(Tables):
    @property
    def complaints(self) -> DataFrame:
        """One text per id, with a product and a source."""
        return self.read("documents").select(
            F.col("doc_id").alias("complaint_id"),
            F.col("lang").alias("product"),
            "source",
            F.col("text").alias("narrative"),
            "n_chars",
        )

    @property
    def golden_raw(self) -> DataFrame:
        """Labelled texts, ambiguous ones included."""
        labels = self.read("labels").select(
            F.col("doc_id").alias("complaint_id"),
            (1 - F.col("quality")).cast("int").alias("churn_signal"),
            (F.col("toxic") == 1).alias("ambiguous"),
        )
        return self.complaints.join(labels, "complaint_id")

    @property
    def golden(self) -> DataFrame:
        return self.golden_raw.filter(~F.col("ambiguous")).drop("ambiguous")

    @property
    def folds(self) -> DataFrame:
        return stratified_kfold(self.golden, "complaint_id", "churn_signal", K)

    @property
    def preds(self) -> DataFrame:
        """Predictions of two simple rules for every text, long: one row per model and id."""
        lexicon = phrase_signal_classifier(self.complaints, "narrative", PHRASES)
        length = self.complaints.withColumn("predicted_label", (F.col("n_chars") > 600).cast("int"))
        columns = ["complaint_id", "model", "predicted_label"]
        return (
            lexicon.withColumn("model", F.lit("lexicon"))
            .select(*columns)
            .unionByName(length.withColumn("model", F.lit("length")).select(*columns))
        )

    def pred(self, model: str) -> DataFrame:
        return self.preds.filter(F.col("model") == model).drop("model")

    @property
    def judged(self) -> DataFrame:
        """Labels, folds and predictions of both rules."""
        labelled = label_fold_join(self.golden.drop("narrative"), self.folds, "complaint_id")
        return labelled.join(self.preds, "complaint_id")

    @property
    def scored(self) -> DataFrame:
        """Labels with a score that has many ties."""
        p = F.floor(F.col("n_chars") * 1000 / (F.col("n_chars") + 1000)) / F.lit(1000.0)
        rows = self.golden.select("complaint_id", "product", F.col("churn_signal").alias("y"), p.alias("p"))
        return rows.withColumn("predicted_label", (F.col("p") >= 0.5).cast("int"))

    @property
    def outputs(self) -> DataFrame:
        """Repeated outputs per setting."""
        return self.read("conversations").select(
            F.col("conv_id").alias("setting"), F.col("turn").alias("repeat"), F.col("text").alias("output")
        )

    @property
    def calls(self) -> DataFrame:
        """Model calls with reply, token counts and durations; some replies are cut short."""
        k = F.get_json_object("props", "$.k").cast("long")
        cut = F.substring("props", F.lit(1), F.length("props") - 1)
        ns = F.when(F.col("value") < 1, 0).otherwise(F.round(F.col("value") * 1000000)).cast("long")
        digit = hex_digit("event_id")
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("model"),
            F.when(F.col("value") < 5, cut).otherwise(F.col("props")).alias("response"),
            k.alias("prompt_eval_count"),
            (k * 2 + F.col("user_id") % 7).alias("eval_count"),
            ns.alias("eval_duration_ns"),
            F.round(F.col("value") * 250000).cast("long").alias("load_duration_ns"),
            F.when(digit == "0", "cold").when(digit == "1", "warm").otherwise("sample").alias("phase"),
            "value",
        )

    @property
    def classified(self) -> DataFrame:
        """A classifier reply per text, in all the shapes a model returns."""
        h = hex_digit("complaint_id")
        plain = F.concat(
            F.lit('{"churn_signal": '),
            F.when(F.col("n_chars") > 1500, "true").otherwise("false"),
            F.lit(', "rationale": "length '),
            F.col("n_chars").cast("string"),
            F.lit('"}'),
        )
        reply = (
            F.when(h == "0", '{"churn_signal": tr')
            .when(h == "1", '{"rationale": "none given"}')
            .when(h == "2", '{"churn_signal": "false", "rationale": "said so"}')
            .when(h == "3", '{"churn_signal": null, "rationale": "unsure"}')
            .when(h == "4", '{"churn_signal": 0, "rationale": 7}')
            .when(h == "5", "[1, 2]")
            .when(h == "6", "")
            .when(h == "7", '{"churn_signal": [], "rationale": "list"}')
            .when(h == "8", '{"churn_signal": "", "rationale": ""}')
            .otherwise(plain)
        )
        return self.complaints.select(
            "complaint_id", "product", reply.alias("response"), (F.col("n_chars") * 1000003).alias("eval_duration_ns")
        )

    @property
    def extracted(self) -> DataFrame:
        """An extraction reply per text, valid or broken in one of several ways."""
        h = hex_digit("complaint_id")
        product = F.when(h < "8", F.concat(F.lit("desk of "), F.upper("product"))).otherwise(F.col("source"))
        urgency = F.when(h == "1", "severe").when(F.col("n_chars") > 2000, "high").otherwise("low")
        flag = F.when(h == "2", '"true"').otherwise("true")
        summary = F.when(h == "3", "null").otherwise(F.concat(F.lit('"about '), F.col("source"), F.lit('"')))
        tail = F.when(h == "4", "").when(h == "5", ', "note": [1]}').otherwise("}")
        reply = F.concat(
            F.lit('{"product": "'),
            product,
            F.lit('", "issue_summary": '),
            summary,
            F.when(h == "6", F.lit("")).otherwise(F.concat(F.lit(', "urgency": "'), urgency, F.lit('"'))),
            F.lit(', "mentions_legal_action": '),
            flag,
            tail,
        )
        return self.complaints.select(
            "complaint_id",
            F.concat("product", F.lit(" desk")).alias("true_product"),
            F.col("product").alias("model"),
            reply.alias("response"),
            (F.col("n_chars") * 1.5).alias("ms"),
        )

    @property
    def turn_pairs(self) -> DataFrame:
        """Each user turn (candidate a) with the assistant turn after it (candidate b)."""
        turns = self.read("conversations")
        user = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("a"))
        answer = turns.filter(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b")
        )
        joined = user.join(answer, ["conv_id", "turn"])
        return joined.select((F.col("conv_id") * 100 + F.col("turn")).alias("complaint_id"), "a", "b")

    @property
    def comparisons(self) -> DataFrame:
        """Two judges' choices in both orders, one of them swayed by position at times."""
        pairs = self.turn_pairs.select(
            "complaint_id", F.length("a").alias("la"), F.length("b").alias("lb"), hex_digit("complaint_id").alias("h")
        )
        longer = F.when(F.col("la") > F.col("lb"), "A").when(F.col("la") < F.col("lb"), "B").otherwise("tie")
        turned = F.when(F.col("la") > F.col("lb"), "B").when(F.col("la") < F.col("lb"), "A").otherwise("tie")
        first = pairs.select(
            "complaint_id",
            F.lit("judge_a").alias("judge"),
            F.lit("a").alias("own_model"),
            longer.alias("forward"),
            F.when(F.col("h") < "4", "A").otherwise(turned).alias("swapped"),
        )
        second = pairs.select(
            "complaint_id",
            F.lit("judge_b").alias("judge"),
            F.lit("b").alias("own_model"),
            F.when(F.col("h") < "8", "B").otherwise("A").alias("forward"),
            F.when(F.col("h") < "6", "A").when(F.col("h") < "9", "tie").otherwise("B").alias("swapped"),
        )
        return first.unionByName(second)

    @property
    def judge_scores(self) -> DataFrame:
        """Groundedness scores of the originals, some missing."""
        score = F.least(F.lit(5), 1 + F.floor(F.length("a") / 100)).cast("int")
        return self.turn_pairs.select(
            "complaint_id", F.when(hex_digit("complaint_id") != "0", score).alias("score")
        )

    @property
    def padded_scores(self) -> DataFrame:
        """Scores of the padded texts, others missing."""
        length = F.length(padded(F.col("a"), FILLER))
        score = F.least(F.lit(5), 1 + F.floor(length / 100)).cast("int")
        return self.turn_pairs.select(
            "complaint_id", F.when(hex_digit("complaint_id") != "1", score).alias("score")
        )

    @property
    def accounts(self) -> DataFrame:
        """One row per customer with features, text fields to clean and a churn label."""
        price = F.col("o_totalprice").cast("decimal(18,2)")
        facts = (
            self.read("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(
                F.min("o_orderdate").alias("first_order"),
                F.max("o_orderdate").alias("last_order"),
                F.sum(price).alias("spent"),
                F.count(F.lit(1)).alias("n_orders"),
                F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"),
            )
        )
        nations = self.read("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
        joined = self.read("customer").join(facts, "c_custkey", "left").join(nations, "c_nationkey", "left")
        blank = (F.col("c_acctbal") < -900) | F.col("spent").isNull()
        tenure = F.coalesce(F.datediff(F.lit(CUTOFF).cast("date"), F.col("first_order")), F.lit(0))
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            "nation",
            F.when(F.col("urgent") == 1, "Yes").otherwise("No").alias("urgent"),
            F.when(blank, 0).otherwise(tenure).cast("int").alias("tenure"),
            F.coalesce(F.col("spent").cast("double") / F.col("n_orders"), F.lit(0.0)).alias("monthly"),
            F.when(blank, F.lit(" ")).otherwise(F.col("spent").cast("string")).alias("total"),
            F.when(F.col("last_order") >= F.lit(CUTOFF).cast("date"), "No").otherwise("Yes").alias("churn"),
        )


_PATTERN = r"(?:^|[^\p{L}\p{N}_])(" + "|".join(PHRASES) + r")(?:[^\p{L}\p{N}_]|$)"
_DIGIT = "substr(md5(CAST({} AS VARCHAR)), 1, 1)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "complaints": (
        (),
        "SELECT doc_id AS complaint_id, lang AS product, source, text AS narrative, n_chars FROM documents",
    ),
    "golden_raw": (
        ("complaints",),
        """SELECT c.complaint_id, c.product, c.source, c.narrative, c.n_chars,
               CAST(1 - l.quality AS INTEGER) AS churn_signal, l.toxic = 1 AS ambiguous
           FROM complaints c JOIN labels l ON l.doc_id = c.complaint_id""",
    ),
    "golden": (
        ("golden_raw",),
        """SELECT complaint_id, product, source, narrative, n_chars, churn_signal
           FROM golden_raw WHERE NOT ambiguous""",
    ),
    "folds": (
        ("golden",),
        f"""SELECT complaint_id, churn_signal,
               CAST((row_number() OVER (ORDER BY churn_signal, md5(CAST(complaint_id AS VARCHAR)), complaint_id) - 1)
                    % {K} AS INTEGER) AS fold
           FROM golden""",
    ),
    "preds": (
        ("complaints",),
        f"""SELECT complaint_id, 'lexicon' AS model,
               CASE WHEN regexp_matches(lower(narrative), '{_PATTERN}') THEN 1 ELSE 0 END AS predicted_label
           FROM complaints
           UNION ALL
           SELECT complaint_id, 'length', CASE WHEN n_chars > 600 THEN 1 ELSE 0 END FROM complaints""",
    ),
    "judged": (
        ("folds", "preds"),
        """SELECT g.complaint_id, g.product, g.n_chars, g.churn_signal, f.fold, p.model, p.predicted_label
           FROM golden g JOIN folds f USING (complaint_id) JOIN preds p USING (complaint_id)""",
    ),
    "cells": (
        ("judged",),
        """SELECT model, fold,
               count(*) FILTER (WHERE churn_signal = 0 AND predicted_label = 0) AS tn,
               count(*) FILTER (WHERE churn_signal = 0 AND predicted_label = 1) AS fp,
               count(*) FILTER (WHERE churn_signal = 1 AND predicted_label = 0) AS fn,
               count(*) FILTER (WHERE churn_signal = 1 AND predicted_label = 1) AS tp
           FROM judged GROUP BY model, fold""",
    ),
    "fold_scores": (
        ("cells",),
        """SELECT model, fold, tn, fp, fn, tp, tn + fp + fn + tp AS n_test, fn + tp AS n_positive_test,
               coalesce((tp + tn) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0.0) AS accuracy,
               coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
               coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
               coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
           FROM cells""",
    ),
    "fold_long": (
        ("fold_scores",),
        """SELECT model, fold, 'accuracy' AS metric, accuracy AS value FROM fold_scores
           UNION ALL SELECT model, fold, 'precision', precision FROM fold_scores
           UNION ALL SELECT model, fold, 'recall', recall FROM fold_scores
           UNION ALL SELECT model, fold, 'f1', f1 FROM fold_scores""",
    ),
    "scored": (
        ("golden",),
        """SELECT complaint_id, product, churn_signal AS y, floor(n_chars * 1000 / (n_chars + 1000)) / 1000.0 :: DOUBLE AS p,
               CASE WHEN floor(n_chars * 1000 / (n_chars + 1000)) / 1000.0 :: DOUBLE >= 0.5 THEN 1 ELSE 0 END AS predicted_label
           FROM golden""",
    ),
    "outputs": ((), "SELECT conv_id AS setting, turn AS repeat, text AS output FROM conversations"),
    "calls": (
        (),
        f"""SELECT event_id AS id, event_type AS model,
               CASE WHEN value < 5 THEN substr(props, 1, length(props) - 1) ELSE props END AS response,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS prompt_eval_count,
               CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 + user_id % 7 AS eval_count,
               CAST(CASE WHEN value < 1 THEN 0 ELSE round(value * 1000000) END AS BIGINT) AS eval_duration_ns,
               CAST(round(value * 250000) AS BIGINT) AS load_duration_ns,
               CASE {_DIGIT.format("event_id")} WHEN '0' THEN 'cold' WHEN '1' THEN 'warm' ELSE 'sample' END AS phase,
               value
           FROM events""",
    ),
    "classified": (
        ("complaints",),
        f"""SELECT complaint_id, product, n_chars * 1000003 AS eval_duration_ns,
               CASE {_DIGIT.format("complaint_id")}
                   WHEN '0' THEN '{{"churn_signal": tr'
                   WHEN '1' THEN '{{"rationale": "none given"}}'
                   WHEN '2' THEN '{{"churn_signal": "false", "rationale": "said so"}}'
                   WHEN '3' THEN '{{"churn_signal": null, "rationale": "unsure"}}'
                   WHEN '4' THEN '{{"churn_signal": 0, "rationale": 7}}'
                   WHEN '5' THEN '[1, 2]'
                   WHEN '6' THEN ''
                   WHEN '7' THEN '{{"churn_signal": [], "rationale": "list"}}'
                   WHEN '8' THEN '{{"churn_signal": "", "rationale": ""}}'
                   ELSE concat('{{"churn_signal": ', CASE WHEN n_chars > 1500 THEN 'true' ELSE 'false' END,
                               ', "rationale": "length ', n_chars, '"}}')
               END AS response
           FROM complaints""",
    ),
    "classified_read": (
        ("classified",),
        """SELECT complaint_id, product, eval_duration_ns,
               CASE WHEN json_valid(response) THEN json_type(json_extract(response, '$.churn_signal')) END AS t,
               CASE WHEN json_valid(response) THEN json_extract_string(response, '$.churn_signal') END AS v,
               CASE WHEN json_valid(response) THEN json_extract_string(response, '$.rationale') END AS r
           FROM classified""",
    ),
    "classified_rows": (
        ("classified_read",),
        """SELECT complaint_id, product,
               CASE WHEN t IS NULL THEN 0 WHEN t = 'NULL' THEN 0
                    WHEN t = 'BOOLEAN' THEN CASE WHEN v = 'true' THEN 1 ELSE 0 END
                    WHEN t = 'VARCHAR' THEN CASE WHEN v <> '' THEN 1 ELSE 0 END
                    WHEN t = 'ARRAY' THEN CASE WHEN v <> '[]' THEN 1 ELSE 0 END
                    ELSE CASE WHEN CAST(v AS DOUBLE) <> 0 THEN 1 ELSE 0 END END AS predicted_label,
               t IS NULL AS parse_failed,
               CASE WHEN t IS NULL THEN '' ELSE coalesce(r, '') END AS rationale,
               round_even(eval_duration_ns / 1000000.0 :: DOUBLE, 1) AS eval_duration_ms
           FROM classified_read""",
    ),
    "extracted": (
        ("complaints",),
        f"""SELECT complaint_id, product || ' desk' AS true_product, product AS model, n_chars * 1.5 :: DOUBLE AS ms,
               concat('{{"product": "', CASE WHEN h < '8' THEN concat('desk of ', upper(product)) ELSE source END,
                      '", "issue_summary": ',
                      CASE WHEN h = '3' THEN 'null' ELSE concat('"about ', source, '"') END,
                      CASE WHEN h = '6' THEN '' ELSE concat(', "urgency": "',
                          CASE WHEN h = '1' THEN 'severe' WHEN n_chars > 2000 THEN 'high' ELSE 'low' END, '"') END,
                      ', "mentions_legal_action": ', CASE WHEN h = '2' THEN '"true"' ELSE 'true' END,
                      CASE WHEN h = '4' THEN '' WHEN h = '5' THEN ', "note": [1]}}' ELSE '}}' END) AS response
           FROM (SELECT *, {_DIGIT.format("complaint_id")} AS h FROM complaints)""",
    ),
    "extracted_flags": (
        ("extracted",),
        """SELECT complaint_id, true_product, model, ms, json_parsed,
               json_parsed AND p IS NOT NULL AND s IS NOT NULL AND u IS NOT NULL AND m IS NOT NULL AS has_keys,
               coalesce(json_parsed AND p = 'VARCHAR' AND s = 'VARCHAR' AND m = 'BOOLEAN'
                        AND urgency IN ('low', 'medium', 'high'), false) AS schema_valid,
               product,
               coalesce(json_parsed AND p = 'VARCHAR' AND s = 'VARCHAR' AND m = 'BOOLEAN'
                        AND urgency IN ('low', 'medium', 'high')
                        AND contains(lower(product), lower(split_part(true_product, ' ', 1))), false) AS loose_match
           FROM (SELECT complaint_id, true_product, model, ms, json_valid(response) AS json_parsed,
                     CASE WHEN json_valid(response) THEN json_type(json_extract(response, '$.product')) END AS p,
                     CASE WHEN json_valid(response) THEN json_type(json_extract(response, '$.issue_summary')) END AS s,
                     CASE WHEN json_valid(response) THEN json_type(json_extract(response, '$.urgency')) END AS u,
                     CASE WHEN json_valid(response) THEN json_type(json_extract(response, '$.mentions_legal_action')) END AS m,
                     CASE WHEN json_valid(response) THEN json_extract_string(response, '$.urgency') END AS urgency,
                     CASE WHEN json_valid(response) THEN json_extract_string(response, '$.product') END AS product
                 FROM extracted)""",
    ),
    "turn_pairs": (
        (),
        """SELECT u.conv_id * 100 + u.turn AS complaint_id, u.text AS a, v.text AS b
           FROM conversations u JOIN conversations v ON v.conv_id = u.conv_id AND v.turn = u.turn + 1
           WHERE u.role = 'user' AND v.role = 'assistant'""",
    ),
    "comparisons": (
        ("turn_pairs",),
        f"""SELECT complaint_id, 'judge_a' AS judge, 'a' AS own_model,
               CASE WHEN la > lb THEN 'A' WHEN la < lb THEN 'B' ELSE 'tie' END AS forward,
               CASE WHEN h < '4' THEN 'A' WHEN la > lb THEN 'B' WHEN la < lb THEN 'A' ELSE 'tie' END AS swapped
           FROM (SELECT complaint_id, length(a) AS la, length(b) AS lb, {_DIGIT.format("complaint_id")} AS h
                 FROM turn_pairs)
           UNION ALL
           SELECT complaint_id, 'judge_b', 'b', CASE WHEN h < '8' THEN 'B' ELSE 'A' END,
               CASE WHEN h < '6' THEN 'A' WHEN h < '9' THEN 'tie' ELSE 'B' END
           FROM (SELECT complaint_id, {_DIGIT.format("complaint_id")} AS h FROM turn_pairs)""",
    ),
    "winners": (
        ("comparisons",),
        """SELECT *, CASE forward WHEN 'A' THEN 'a' WHEN 'B' THEN 'b' ELSE 'tie' END AS forward_winner,
               CASE swapped WHEN 'A' THEN 'b' WHEN 'B' THEN 'a' ELSE 'tie' END AS swapped_winner
           FROM comparisons""",
    ),
    "judge_scores": (
        ("turn_pairs",),
        f"""SELECT complaint_id, CASE WHEN {_DIGIT.format("complaint_id")} <> '0'
               THEN CAST(least(5, 1 + length(a) // 100) AS INTEGER) END AS score FROM turn_pairs""",
    ),
    "padded_scores": (
        ("turn_pairs",),
        f"""SELECT complaint_id, CASE WHEN {_DIGIT.format("complaint_id")} <> '1'
               THEN CAST(least(5, 1 + length(rtrim(a, '.') || '.' || '{FILLER}') // 100) AS INTEGER) END AS score
           FROM turn_pairs""",
    ),
    "accounts": (
        (),
        f"""SELECT c_custkey AS customer_id, c_mktsegment AS segment, n_name AS nation,
               CASE WHEN urgent = 1 THEN 'Yes' ELSE 'No' END AS urgent,
               CAST(CASE WHEN blank THEN 0 ELSE coalesce(date_diff('day', CAST(first_order AS DATE), DATE '{CUTOFF}'), 0)
                    END AS INTEGER) AS tenure,
               coalesce(CAST(spent AS DOUBLE) / n_orders, 0.0) AS monthly,
               CASE WHEN blank THEN ' ' ELSE CAST(spent AS VARCHAR) END AS total,
               CASE WHEN last_order >= DATE '{CUTOFF}' THEN 'No' ELSE 'Yes' END AS churn
           FROM (SELECT *, c_acctbal < -900 OR spent IS NULL AS blank FROM customer
                 LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
                                sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS spent, count(*) AS n_orders,
                                max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent
                            FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
                 LEFT JOIN nation ON n_nationkey = c_nationkey)""",
    ),
}


def _needed(name: str, found: list[str]) -> None:
    for other in CTES[name][0]:
        _needed(other, found)
    if name not in found:
        found.append(name)


def sql(names: str, body: str, **more: str) -> str:
    """`body` with the named views, and further ones, as common table expressions."""
    found: list[str] = []
    for name in names.split():
        _needed(name, found)
    parts = [f"{name} AS ({CTES[name][1]})" for name in found]
    parts += [f"{name} AS ({text})" for name, text in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
