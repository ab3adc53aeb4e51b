"""Connected components of links between long ids, as joins and grouped minima; no link leaves the executors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewick.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node in ``links``; ``root`` is the smallest node of its component.

    Every round takes the least label of a node's neighbours and then the label of the label, so labels travel
    twice as far each round; rounds end when nothing changes.  Each round is stored, so a lost executor costs a round.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = materialise(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = materialise(both.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("root")), "labels")
    while True:
        heard = (
            both.join(labels, both.y == labels.node).groupBy("x").agg(F.min("root").alias("heard"))
            .select(F.col("x").alias("node"), "heard")
        )
        step = labels.join(heard, "node").select("node", "root", F.least("root", "heard").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        step = materialise(step.join(far, "near").select("node", F.col("root").alias("was"), F.least("near", "far").alias("root")), "labels")
        labels = step.select("node", "root")
        if not step.where("was <> root").take(1):
            return labels
