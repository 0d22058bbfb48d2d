"""Connected components of a table of links, by rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.session import scratch_path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node of a link.

    Each round gives every node the smallest label among itself and its neighbours and then the
    label of its label, so that chains shorten by more than half; rounds end when nothing changes.
    Every round is a written table, so a lost executor costs one round at most. The links stay
    distributed; only one number a round comes to the driver. Links with a null end are passed over.
    """
    spark = links.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL AND x <> y"
    )
    both = written(ends.union(ends.select("y", "x")).distinct(), "links")
    if not both.limit(1).count():
        return both.select(F.col("x").alias("node"), F.col("y").alias("component"))
    labels = written(
        both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.min("x")).alias("label")),
        "labels",
    )
    while True:
        other = labels.select(F.col("node").alias("y"), F.col("label").alias("near"))
        lower = (
            both.join(other, "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        stepped = labels.join(lower, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        stepped = written(stepped, "labels")
        jump = stepped.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = stepped.join(jump, "label").select(
            "node", "old", F.least("label", "further").alias("label")
        )
        jumped = written(jumped, "labels")
        changed = jumped.where("old <> label").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
