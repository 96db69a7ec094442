"""Connected components by minimum labels with pointer jumping; nothing of the graph reaches the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace

#: Rounds after which the driver gives back what their plans left in its memory.
ROUNDS = 4


def connected_components(edges: DataFrame, space: Workspace, tag: str) -> DataFrame:
    """edges (a, b) -> (id, comp) for every end of an edge, comp being the smallest id that can be reached.

    Each round takes the smallest label among a vertex's neighbours and then the label of that label, so the rounds
    grow with the logarithm of a component's diameter.  The sums per vertex are combined before the shuffle, and the
    joins may be split by adaptive execution, so a vertex with very many edges doesn't land in one task.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = space.save(both.distinct(), f"{tag}-edges")
    labels = space.save(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), f"{tag}-0")
    step = 0
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        low = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("comp").alias("far"))
        step += 1
        grown = space.save(low.join(jump, "low").select("id", "old", F.least("low", "far").alias("comp")), f"{tag}-{step}")
        changed = grown.where("comp <> old").limit(1).count()
        space.drop(f"{tag}-{step - 1}")
        labels = grown.select("id", "comp")
        if not changed or step % ROUNDS == 0:
            space.release()
        if not changed:
            return labels
