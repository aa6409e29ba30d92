"""Filters, samples, folds, splits, batches and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import id_hash
from plumbline.operators import joins, sampling
from plumbline.plans.registry import query
from plumbline.plans.views import K, sql

QUOTAS = {"en": 167, "fr": 41, "de": 41}
ORDER = "md5(CAST(complaint_id AS VARCHAR)), complaint_id"


@query(
    "p1_project_rename",
    "SELECT o_orderkey AS complaint_id, o_orderpriority AS product FROM orders",
)
def p1(v):
    from plumbline.sources.files import project_rename

    raw = v.read("orders").select(F.col("o_orderkey").alias("Complaint ID"), F.col("o_orderpriority").alias("Product"))
    return project_rename(raw, {"Complaint ID": "complaint_id", "Product": "product"})


@query(
    "p2_narrative_filter",
    sql(
        "complaints",
        """SELECT complaint_id, product, length(narrative) AS n FROM complaints
           WHERE narrative IS NOT NULL AND length(narrative) BETWEEN 200 AND 2000""",
    ),
)
def p2(v):
    kept = sampling.narrative_filter(v.complaints, "narrative", 200, 2000)
    return kept.select("complaint_id", "product", F.length("narrative").cast("long").alias("n"))


@query(
    "p3_eq_param_filter",
    sql("complaints", "SELECT complaint_id, source FROM complaints WHERE product = 'fr'"),
)
def p3(v):
    return sampling.equals(v.complaints, "product", "fr").select("complaint_id", "source")


@query(
    "w1_hash_ordered_sample",
    sql(
        "complaints",
        f"""SELECT complaint_id, product, narrative FROM
           (SELECT *, row_number() OVER (PARTITION BY product ORDER BY {ORDER}) AS rn FROM complaints
            WHERE length(narrative) BETWEEN 200 AND 2000)
           WHERE rn <= CASE product WHEN 'en' THEN 167 WHEN 'fr' THEN 41 WHEN 'de' THEN 41 ELSE 0 END""",
    ),
)
def w1(v):
    kept = sampling.narrative_filter(v.complaints, "narrative", 200, 2000)
    sample = sampling.hash_ordered_sample(kept, "product", QUOTAS, "complaint_id")
    return sample.select("complaint_id", "product", "narrative")


@query(
    "w1_hash_ordered_sample_large_quota",
    """SELECT o_orderkey, o_orderstatus FROM
       (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn
        FROM orders) WHERE rn <= CASE o_orderstatus WHEN 'F' THEN 4000 WHEN 'O' THEN 2500 ELSE 0 END""",
)
def w1_large(v):
    orders = v.read("orders").select("o_orderkey", "o_orderstatus")
    return sampling.hash_ordered_sample(orders, "o_orderstatus", {"F": 4000, "O": 2500}, "o_orderkey")


@query(
    "w2_ordered_limit",
    sql(
        "complaints",
        """SELECT complaint_id, narrative FROM complaints WHERE length(narrative) BETWEEN 300 AND 600
           ORDER BY complaint_id LIMIT 15""",
    ),
)
def w2(v):
    kept = sampling.narrative_filter(v.complaints, "narrative", 300, 600)
    return sampling.ordered_limit(kept, "complaint_id", 15).select("complaint_id", "narrative")


@query(
    "w3_sort_head_desc",
    sql("", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
)
def w3(v):
    return sampling.sort_head_desc(v.read("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query(
    "w4_sort_for_publish",
    sql("folds", "SELECT complaint_id, fold FROM folds ORDER BY complaint_id"),
)
def w4(v):
    return sampling.sort_for_publish(v.folds.select("complaint_id", "fold"), "complaint_id")


@query("w5_stratified_kfold", sql("folds", "SELECT complaint_id, churn_signal, fold FROM folds"))
def w5(v):
    return v.folds


@query(
    "w5_stratified_kfold_orders",
    """SELECT o_orderkey, y, CAST((row_number() OVER (ORDER BY y, md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 10
           AS INTEGER) AS fold
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS y FROM orders)""",
)
def w5_orders(v):
    rows = v.read("orders").select("o_orderkey", (F.col("o_orderstatus") == "P").cast("int").alias("y"))
    return sampling.stratified_kfold(rows, "o_orderkey", "y", 10)


@query(
    "w6_stratified_split",
    sql(
        "accounts",
        """SELECT customer_id, y, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS part
           FROM (SELECT customer_id, y, row_number() OVER (PARTITION BY y
                        ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) AS rn FROM labelled)
           JOIN quotas USING (y)""",
        labelled="SELECT customer_id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS y FROM accounts",
        shares="""SELECT y, count(*) AS c, sum(count(*)) OVER () AS n, ceil(0.2 * sum(count(*)) OVER ()) AS t
                  FROM labelled GROUP BY y""",
        bases="SELECT y, floor(t * c / n) AS base, t, (t * c) - n * floor(t * c / n) AS rest FROM shares",
        quotas="""SELECT y, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= t - sum(base) OVER ()
                      THEN 1 ELSE 0 END AS quota FROM bases""",
    ),
)
def w6(v):
    labelled = v.accounts.select("customer_id", (F.col("churn") == "Yes").cast("int").alias("y"))
    return sampling.stratified_split(labelled, "customer_id", "y", 0.2)


@query(
    "w7_batch_assign",
    sql(
        "complaints",
        """SELECT complaint_id, (row_number() OVER (ORDER BY complaint_id) - 1) // 10 AS batch,
               CAST((row_number() OVER (ORDER BY complaint_id) - 1) % 10 AS INTEGER) AS position FROM complaints""",
    ),
)
def w7(v):
    return sampling.batch_assign(v.complaints.select("complaint_id"), "complaint_id", 10)


@query(
    "w8_seeded_sample",
    sql(
        "golden",
        """SELECT complaint_id, product FROM golden
           ORDER BY md5('42:' || CAST(complaint_id AS VARCHAR)), complaint_id LIMIT 30""",
    ),
)
def w8(v):
    return sampling.seeded_sample(v.golden, "complaint_id", 30, 42).select("complaint_id", "product")


@query(
    "w9_first_n_sample",
    sql("golden", "SELECT complaint_id, product FROM golden ORDER BY complaint_id LIMIT 8"),
)
def w9(v):
    return sampling.first_n_sample(v.golden, ["complaint_id"], 8).select("complaint_id", "product")


@query(
    "w10_fold_holdout",
    sql(
        "folds",
        """SELECT CAST(k AS INTEGER) AS held_out, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS role,
               count(*) AS n, CAST(sum(churn_signal) AS BIGINT) AS n_positive
           FROM folds, range(5) AS r(k) GROUP BY 1, 2""",
    ),
)
def w10(v):
    parts = sampling.fold_holdout(v.folds, K)
    return parts.groupBy("held_out", "role").agg(
        F.count(F.lit(1)).alias("n"), F.sum("churn_signal").alias("n_positive")
    )


@query(
    "u1_union_strata",
    sql(
        "complaints",
        f"""SELECT complaint_id, product FROM
           (SELECT *, row_number() OVER (PARTITION BY product ORDER BY {ORDER}) AS rn FROM complaints)
           WHERE rn <= CASE product WHEN 'en' THEN 30 WHEN 'es' THEN 20 ELSE 0 END""",
    ),
)
def u1(v):
    samples = [
        sampling.hash_ordered_sample(v.complaints, "product", {product: n}, "complaint_id")
        for product, n in (("en", 30), ("es", 20))
    ]
    return sampling.union_strata(samples).select("complaint_id", "product")


@query(
    "u2_id_difference",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
def u2(v):
    return joins.id_difference(v.read("documents"), v.read("labels"), "doc_id")


@query(
    "u3_set_equality_check",
    """SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_in_a,
              (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_in_b,
              (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) = 0 AND
              (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) = 0 AS equal""",
)
def u3(v):
    return joins.set_equality_check(v.read("documents"), v.read("labels"), "doc_id")


_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[ \t\n\r\f\x0B]+'), lambda x: x <> ''))"


@query(
    "u4_word_set_ops",
    sql(
        "turn_pairs",
        """SELECT complaint_id, length(list_intersect(x, y)) AS n_shared,
               length(list_distinct(list_concat(x, y))) AS n_either,
               round(CASE WHEN length(list_concat(x, y)) = 0 THEN 1.0
                     ELSE length(list_intersect(x, y)) / CAST(length(list_distinct(list_concat(x, y))) AS DOUBLE) END, 6)
                   AS jaccard
           FROM words""",
        words=f"SELECT complaint_id, {_WORDS.format('a')} AS x, {_WORDS.format('b')} AS y FROM turn_pairs",
    ),
)
def u4(v):
    from plumbline.functions.text import jaccard, word_set

    words = v.turn_pairs.select("complaint_id", word_set(F.col("a")).alias("x"), word_set(F.col("b")).alias("y"))
    return words.select(
        "complaint_id",
        F.size(F.array_intersect("x", "y")).cast("long").alias("n_shared"),
        F.size(F.array_union("x", "y")).cast("long").alias("n_either"),
        F.round(jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"),
    )


@query(
    "u5_append_results",
    sql("preds", "SELECT model, count(*) AS n, CAST(sum(predicted_label) AS BIGINT) AS n_positive FROM preds GROUP BY model"),
)
def u5(v):
    both = joins.append_results(v.preds.filter("model = 'lexicon'"), v.preds.filter("model = 'length'"))
    return both.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("predicted_label").alias("n_positive"))


@query(
    "f2_id_hash",
    "SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS h FROM documents",
)
def f2(v):
    return v.read("documents").select("doc_id", id_hash(F.col("doc_id")).alias("h"))


@query(
    "f5_verbatim_evidence",
    sql(
        "turn_pairs",
        r"""SELECT complaint_id, contains(trim(lower(regexp_replace(a, '\s+', ' ', 'g'))),
                trim(lower(regexp_replace(replace(substr(a, 5, 20), ' ', chr(10) || ' '), '\s+', ' ', 'g')))) AS own_quote,
                contains(trim(lower(regexp_replace(a, '\s+', ' ', 'g'))),
                trim(lower(regexp_replace(substr(b, 1, 12), '\s+', ' ', 'g')))) AS other_quote
            FROM turn_pairs""",
    ),
)
def f5(v):
    from plumbline.functions.text import is_verbatim

    return v.turn_pairs.select(
        "complaint_id",
        is_verbatim(F.replace(F.substring("a", 5, 20), F.lit(" "), F.lit("\n ")), F.col("a")).alias("own_quote"),
        is_verbatim(F.substring("b", 1, 12), F.col("a")).alias("other_quote"),
    )


@query(
    "f11_single_prompt",
    sql(
        "complaints",
        r"""SELECT complaint_id, md5(concat('Label this.', chr(10), chr(10), 'NARRATIVE:', chr(10), narrative)) AS prompt_md5
            FROM complaints""",
    ),
)
def f11(v):
    from plumbline.operators.responses import single_prompt

    prompt = single_prompt(F.col("narrative"), "Label this.")
    return v.complaints.select("complaint_id", F.md5(prompt).alias("prompt_md5"))


@query(
    "f13_padding",
    sql("turn_pairs", "SELECT complaint_id, rtrim(a, '.') || '.' || ' More words.' AS padded FROM turn_pairs"),
)
def f13(v):
    from plumbline.functions.text import padded

    return v.turn_pairs.select("complaint_id", padded(F.col("a"), " More words.").alias("padded"))


@query(
    "f14_strip_truncate",
    sql("complaints", "SELECT complaint_id, substr(trim(narrative), 1, 80) AS head FROM complaints"),
)
def f14(v):
    return v.complaints.select("complaint_id", F.substring(F.trim("narrative"), 1, 80).alias("head"))


@query(
    "f18_json_serialise",
    sql("folds", """SELECT complaint_id, concat('{"', complaint_id, '":', fold, '}') AS document FROM folds"""),
)
def f18(v):
    entry = F.create_map(F.col("complaint_id").cast("string"), F.col("fold"))
    return v.folds.select("complaint_id", F.to_json(entry).alias("document"))


