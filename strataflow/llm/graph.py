"""Connected components as joins and aggregations, and checkpoints in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import shared_folder

#: Edges of one node that go to one task of a round; a hub's are dealt over as many parts as it needs.
SPLIT = 256
#: Parts that the nodes of one label are dealt over where labels are looked up.
JUMP = 32


def keep(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """keep(), for tables that a loop joins round after round. A checkpoint keeps its plan's size estimate, and that of a
    join is the product of its tables': its digits double with each round, until the driver's memory holds nothing else.
    The rows made a DataFrame anew have an estimate of their own."""
    kept, session = keep(df), df.sparkSession
    return DataFrame(session._jsparkSession.createDataFrame(kept._jdf.toJavaRDD(), kept._jdf.schema()), session)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b) reaches.

    Rounds of minimum over neighbours, from the third on with a jump: all nodes of a label go on to the smallest label that
    one of them has come to or that the label's own node has. So a chain takes rounds as the logarithm of its length,
    however its nodes are named. The aggregations combine before their shuffle, and a hub's edges are dealt over parts,
    each with a copy of its label, so that no task holds them all. Joins are by merging: tables of a round that are small
    enough to broadcast would each pass through the driver, round after round. Ends when no label changes. Null nodes take
    no part; loops and repeated edges have no effect; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null and a != b").select("a", "b")
    both = edges.union(edges.select("b", "a")).toDF("a", "b").distinct()
    degree = F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("parts")
    # Both directions are in the edges, so a node's own rows are as many as those that ask for its label.
    labels = keep(both.groupBy("a").agg(F.min("b").alias("m"), degree).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), "parts"))
    hubs = labels.where("parts > 1").select(F.col("node").alias("b"), "parts")
    part = F.coalesce(F.pmod(F.xxhash64("a"), F.col("parts")), F.lit(0)).cast("int").alias("part")
    both = keep(both.join(hubs.hint("merge"), "b", "left").select("a", "b", part))
    for i in range(rounds):
        told = labels.select(F.col("node").alias("b"), "label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        near = both.join(told.hint("merge"), ["b", "part"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("n"))
        new = labels.join(near.hint("merge"), "node").select("node", "parts", F.col("label").alias("old"), F.least("label", "n").alias("label"))
        if i > 1:  # stars have settled by now; chains are halved by jumps
            # Labels with a smaller one to go on to, each for all parts, since many nodes share a label.
            asked = new.select("label").distinct()
            told = F.inline(F.array(F.struct(F.col("old").alias("label"), F.col("label").alias("up")), F.struct(F.col("node").alias("label"), F.col("label").alias("up"))))
            up = new.select(told).groupBy("label").agg(F.min("up").alias("up")).where("up != label").join(asked.hint("merge"), "label", "left_semi")
            up = up.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(JUMP - 1))))
            new = new.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(JUMP)).cast("int")).join(up.hint("merge"), ["label", "part"], "left")
            new = new.select("node", "parts", "old", F.coalesce("up", "label").alias("label"))
        new = settled(new)
        changed = new.where("old != label").limit(1).count()
        labels = new.select("node", "label", "parts")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
