"""Connected components by contraction, with every level written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import staged


def _plain(edges: DataFrame) -> DataFrame:
    """Each link once, whichever way round, without loops."""
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).filter("src <> dst").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node of ``edges`` (src, dst) that is linked to another.

    A level gives each node the smallest node around it (summed up in tasks first, so a hub costs no more than its
    edges), and then the label of its label until that is its own. Nodes of one label become one, the label, and links within it are gone: the
    next level has only what lies between labels, so a link is read about once, not once in each round. The smallest node
    of a component is its own label at every level. Levels follow the logarithm of a component's size."""
    rest, levels = staged(_plain(edges), "edges"), []
    while not levels or not rest.isEmpty():
        both = rest.union(rest.select("dst", "src"))
        near = staged(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
        own = near.select("node", F.col("label").alias("component"))
        changed = True
        while changed:
            up = own.select(F.col("node").alias("at"), F.col("component").alias("up"))
            jumped = staged(own.join(up, own["component"] == up["at"]).select("node", F.col("component").alias("was"), F.col("up").alias("component")), "labels")
            changed = not jumped.filter("component <> was").isEmpty()
            own = jumped.select("node", "component")
        levels.append(own)
        low, high = [own.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label")) for c in ("src", "dst")]
        moved = rest.join(high, "dst").join(low, "src").select(F.col("src_label").alias("src"), F.col("dst_label").alias("dst"))
        rest = staged(_plain(moved), "edges")
    found = levels.pop()
    while levels:
        top = found.select(F.col("node").alias("at"), F.col("component").alias("top"))
        lower = levels.pop()
        found = lower.join(top, lower["component"] == top["at"], "left").select("node", F.coalesce("top", "component").alias("component"))
    return staged(found, "components")
