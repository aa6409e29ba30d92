"""Connected components of a graph whose edges never leave the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.storage import run_folder


def landed(df: DataFrame, path: str) -> DataFrame:
    """df written to the shared folder and read again: nothing of its plan is left."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(node: Column) -> Column:
    """A node behind its hash: in this order neighbours in a chain do not hook one by one."""
    return F.struct(F.xxhash64(node).alias("place"), node.alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs to (node, root): equal roots for connected nodes, one row for each node of an edge.

    Each round sends every node to the smallest of itself and its neighbours and contracts the edges, so a round leaves a
    fraction of the nodes. Rounds are written to the shared folder. All steps are aggregates and equi-joins, which Spark
    can split when one node has most edges. Null ends and loops are ignored; repeated edges count once; no edges give no
    rows.
    """
    folder = run_folder(edges.sparkSession, "components")
    known = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    left = landed(known.select(_placed(F.col("a")).alias("a"), _placed(F.col("b")).alias("b")).distinct(), f"{folder}/edges-0")
    names = left.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root"))
    number = 0
    while not left.isEmpty():
        number += 1
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = landed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), f"{folder}/steps-{number}")
        ends = left.join(step.select("a", F.col("to").alias("ta")), "a").join(step.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
        kept = ends.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        left = landed(kept, f"{folder}/edges-{number}")
        moved = names.join(step.select(F.col("a").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        names = landed(moved, f"{folder}/names-{number}")
    return names.select(F.col("node.node").alias("node"), F.col("root.node").alias("root"))
