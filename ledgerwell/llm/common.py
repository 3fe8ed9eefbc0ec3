"""Helpers of the training-data operators: tables, checkpoints, words and connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.session import shared_folder


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from the shared checkpoint folder, with its lineage cut.

    The folder is the cluster's ``spark.checkpoint.dir``; only a local session without one gets its own.
    Spark removes the files once nothing refers to them any more, if so configured.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files and checkpoints that nothing refers to any more.

    It learns of them when the driver's memory is collected, which a driver with room to spare may not do for hours;
    a job of many rounds would keep the files of all rounds until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(stem: str) -> str:
    """A column name that no input column has."""
    return f"_{stem}_{uuid.uuid4().hex[:8]}"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components: (``node``, ``component``) for each node of a link, component being its smallest node.

    Alternating star contractions: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours, until the links are stars around the smallest nodes. The minima combine before the
    shuffle and hot nodes are inner joins that adaptive execution may split, so one component may hold much
    of the input. The number of rounds grows with the logarithm of the longest path. Self-links and NULLs
    are ignored. Empty links give no rows.
    """
    edges = checkpointed(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter(F.col(left).isNotNull() & F.col(right).isNotNull())
        .filter("u > v")
        .distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        edges = checkpointed(small.filter("u > v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
