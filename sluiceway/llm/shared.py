"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.sinks.staging import staging_folder

# The characters that separate words, as a character class of Java's and RE2's expressions.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: what is computed once is not computed again, also not
    when an executor is lost, since the files lie outside the executors.
    """
    path = staging_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, df: DataFrame) -> str:
    """`name`, with as many underscores in front as make it none of the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, then) -> Column:
    """`then` of a value. Lambdas that use it many times find it computed, where a plain expression is computed each time."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): one row (node, root) per node that has a link.

    `root` is the smallest node of the component. Nodes are long. Parents are
    hooked onto smaller grandparents and paths are halved in every round, so
    the rounds grow with the logarithm of a component's width. Every round is
    joins and minima over the distributed links; one count comes back.
    """
    edges = staged(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), "edges"
    )
    state = staged(
        edges.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("parent"))
        .withColumn("top", F.col("parent")),
        "parents",
    )
    while True:
        left = state.select(F.col("node").alias("a"), F.col("parent").alias("of_a"))
        right = state.select(F.col("node").alias("b"), F.col("top").alias("of_b"))
        hooks = (
            edges.join(left, "a")
            .join(right, "b")
            .select(F.explode(F.array("a", "of_a")).alias("node"), "of_b")
            .groupBy("node")
            .agg(F.min("of_b").alias("hook"))
        )
        moved = staged(
            state.join(hooks, "node", "left").select(
                "node", F.least("parent", "top", "hook").alias("parent"), F.col("parent").alias("was")
            ),
            "hooked",
        )
        above = moved.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        after = staged(moved.join(above, "parent").select("node", "parent", "top", "was"), "parents")
        if after.where("parent <> was or parent <> top").isEmpty():
            return after.select("node", F.col("top").alias("root"))
        state = after.drop("was")
