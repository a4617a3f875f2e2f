"""Connected components of an edge list, as Spark joins."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (columns a, b, long).

    component is the smallest id reachable. Each round gives every vertex the
    smallest label among itself and its neighbours, then the label of its
    label (pointer jumping), so rounds grow with the logarithm of a
    component's diameter. Labels are cut from their lineage by
    ``checkpoint()`` into the shared folder, so lost executors cost no rerun
    of earlier rounds. Loops and nulls are ignored; no edges give no rows.
    """
    both = (
        edges.where("a <> b")
        .select("a", "b")
        .union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct()
        .checkpoint()
    )
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("l"))
    labels = labels.checkpoint()
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("l").alias("n"))
        )
        step = labels.join(near, "id").select("id", "l", F.least("l", "n").alias("n"))
        of = step.select(F.col("id").alias("n"), F.col("n").alias("nn"))
        step = step.join(of, "n").select("id", "l", F.least("n", "nn").alias("n")).checkpoint()
        moved = step.where("l <> n").limit(1).count()
        labels = step.select("id", F.col("n").alias("l"))
        if not moved:
            return labels.select("id", F.col("l").alias("component"))


def persist(df: DataFrame) -> DataFrame:
    """Kept on the executors' disks; lost blocks are computed again."""
    return df.persist(StorageLevel.DISK_ONLY)
