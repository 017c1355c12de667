"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspark.llm.stages import Stages
from varspark.session import stored


def connected(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) of all ends of the links a, b.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label, so paths halve. Rounds are stored tables, dropped at the end; only the number of changed
    labels comes to the driver. A node's neighbours are aggregated, never listed.
    """
    stages = Stages(links.sparkSession, remove_shuffles=True)
    both = stages.stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stages.stored(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        low = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("lower"))
        after = stages.stored(low.join(jump, "low").select("id", F.col("label").alias("was"), F.least("low", "lower").alias("label")), "labels")
        if not after.where("was != label").take(1):
            found = stored(after.select("id", F.col("label").alias("component")), "components")
            stages.drop()
            return found
        labels = after.select("id", "label")
