import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ranking, sampling


def ids(spark, n, label):
    return spark.range(n).select(F.col("id"), label.cast("int").alias("y")).repartition(7)


def test_fold_sizes_of_the_published_set(spark):
    folds = sampling.stratified_kfold(ids(spark, 1001, F.col("id") < 48), "id", "y", 5)
    rows = folds.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect()
    assert sorted(r["n"] for r in rows) == [200, 200, 200, 200, 201]
    assert sorted(r["pos"] for r in rows) == [9, 9, 10, 10, 10]
    assert folds.select("id").distinct().count() == 1001


def test_split_sizes_of_the_published_accounts(spark):
    split = sampling.stratified_split(ids(spark, 7043, F.col("id") < 1869), "id", "y", 0.2)
    rows = {(r["part"], r["y"]): r["n"] for r in split.groupBy("part", "y").agg(F.count("*").alias("n")).collect()}
    assert rows == {("test", 0): 1035, ("test", 1): 374, ("train", 0): 4139, ("train", 1): 1495}


def test_larger_quotas_only_add_rows(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("s"))
    small, large, huge = (
        {r["id"] for r in sampling.hash_ordered_sample(df, "s", {"hot": n, "cold": 20}, "id").collect()}
        for n in (50, 300, 2000)
    )
    assert small < large < huge and len(huge) == 2020


def test_hash_rank_is_exact_for_hot_groups_and_null_groups(spark):
    group = F.when(F.col("id") < 3000, "hot").when(F.col("id") < 3100, F.lit(None)).otherwise("rest")
    df = spark.range(4000).select("id", group.alias("g")).repartition(5)
    found = {r["id"]: r["rank"] for r in ranking.hash_ranked(df, "id", ["g"]).collect()}
    for members in (range(3000), range(3000, 3100), range(3100, 4000)):
        ordered = sorted(members, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        assert [found[i] for i in ordered] == list(range(1, len(ordered) + 1))


def test_batches_are_consecutive_for_uneven_ids(spark):
    values = [0, 1, 2, 3, 10**15, *range(500, 700), -5]
    df = spark.createDataFrame([(v,) for v in values], "id bigint").repartition(4)
    rows = sampling.batch_assign(df, "id", 10).orderBy("id").collect()
    assert [(r["batch"], r["position"]) for r in rows] == [(i // 10, i % 10) for i in range(len(values))]


def test_top_per_group_equals_the_full_sort(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).alias("g")).repartition(9)
    kept = ranking.top_per_group(df, ["g"], [F.desc("id")], 4)
    assert sorted(r["id"] for r in kept.collect()) == sorted([2997, 2994, 2991, 2988, 2999, 2998, 2996, 2995])
    with pytest.raises(ValueError):
        ranking.top_per_group(df, ["g"], [F.desc("id")], 5000)


def test_narrative_filter_includes_both_ends(spark):
    df = spark.createDataFrame([("x" * n,) for n in (199, 200, 2000, 2001)] + [(None,)], "t string")
    assert sampling.narrative_filter(df, "t", 200, 2000).count() == 2


def test_seeds_give_other_samples(spark):
    df = spark.range(1000)
    one, again, other = ({r[0] for r in sampling.seeded_sample(df, "id", 30, s).collect()} for s in (42, 42, 7))
    assert one == again != other


def test_rows_without_a_label_are_split_too(spark):
    from plumbline.operators.sampling import stratified_split

    df = spark.range(40).selectExpr("id", "CASE WHEN id % 5 < 4 THEN CAST(id % 2 AS INT) END AS y")
    assert stratified_split(df, "id", "y", 0.25).count() == 40


def test_strict_lookup_fails_whatever_is_selected(spark):
    import pytest

    from plumbline.operators.joins import strict_lookup_join

    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    right = spark.createDataFrame([(1, 0)], "id long, fold int")
    joined = strict_lookup_join(left, right, "id", ["fold"])
    for df in (joined.select("v", "fold"), joined.groupBy("fold").count(), joined, joined.select("v"), joined.groupBy().count()):
        with pytest.raises(Exception, match="no entry for id 2"):
            df.collect()
    with pytest.raises(Exception, match="no entry for id 2"):
        joined.count()


def test_phrases_are_whole_words_and_plain_text(spark):
    from plumbline.operators.models import phrase_signal_classifier

    df = spark.createDataFrame([("axb",), ("so a.b it",), ("\u00fcnicht",), ("nicht!",), ("nicht_",)], "t string")
    found = {r["t"]: r["predicted_label"] for r in phrase_signal_classifier(df, "t", ("a.b", "nicht")).collect()}
    assert found == {"axb": 0, "so a.b it": 1, "\u00fcnicht": 0, "nicht!": 1, "nicht_": 0}


def test_unscored_rows_are_shown_or_refused(spark):
    import pytest

    from plumbline.operators import metrics

    df = spark.createDataFrame([(1, 1), (0, 0), (1, None), (0, 2)], "y int, p int")
    assert metrics.unscored_rows(df, "y", "p").count() == 2
    with pytest.raises(Exception, match="unscored row"):
        metrics.confusion_matrix(metrics.every_row_scored(df, "y", "p"), "y", "p").collect()


def test_one_path_for_small_and_large_quotas(spark):
    df = spark.range(60_000).select("id", F.when(F.col("id") < 50_000, "hot").when(F.col("id") < 50_003, F.lit(None)).otherwise(F.concat(F.lit("cold"), F.col("id") % 2)).alias("s"))
    order = lambda ids: sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    strata = {"hot": order(range(50_000)), "cold0": order(range(50_004, 60_000, 2)), "cold1": order(range(50_003, 60_000, 2))}
    for quotas in ({"hot": 10, "cold0": 4_000, "cold1": 10**6}, {"hot": 30_000, "cold0": 1, "cold1": 0, "none": 5}):
        for rows in (50, 10_000):
            ends = sampling.hash_thresholds(df, "s", quotas, "id", rows)
            assert "none" not in ends
            found = sampling.hash_ordered_sample(df, "s", quotas, "id") if rows == 10_000 else None
            for s, ids in strata.items():
                n = quotas[s]
                last = hashlib.md5(str(ids[n - 1]).encode()).hexdigest() if 0 < n <= len(ids) else None if n else ""
                assert ends[s] == last
                if found is not None:
                    assert {r["id"] for r in found.filter(F.col("s") == s).collect()} == set(ids[:n])
    plan = sampling.hash_ordered_sample(df, "s", {"hot": 10}, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_totals_over_a_deep_tree_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FAN", 3)
    monkeypatch.setattr(ranking, "width", lambda _: 200)
    df = spark.range(3000).select("id", F.when(F.col("id") < 2600, "hot").when(F.col("id") < 2700, F.lit(None)).otherwise("rest").alias("g")).repartition(5)
    order = lambda ids: sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    groups = [order(range(2600, 2700)), order(range(2600)), order(range(2700, 3000))]  # the null group first
    apart = {r["id"]: r["rank"] for r in ranking.hash_ranked(df, "id", ["g"]).collect()}
    through = {r["id"]: r["rank"] for r in ranking.hash_ranked(df, "id", ["g"], across_groups=True).collect()}
    assert all(apart[i] == at + 1 for ids in groups for at, i in enumerate(ids))
    assert [through[i] for ids in groups for i in ids] == list(range(1, 3001))
    assert {r["rank"]: r["id"] for r in ranking.order_ranked(df, "id").collect()} == {i + 1: i for i in range(3000)}


def test_a_hot_group_is_spread_over_the_shuffle_partitions(spark):
    df = spark.range(40_000).select("id", F.lit("one").alias("g"))
    keyed = ranking.hash_ranked(df, "id", ["g"]).select("id", F.spark_partition_id().alias("p"))
    largest = keyed.groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < 40_000
