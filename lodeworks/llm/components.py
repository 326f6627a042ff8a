"""Connected components of an undirected graph, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest node.

    In each round every component takes the smallest name among itself and its neighbours, then the name
    that this one takes, until nothing changes. All but the locally smallest components merge in a round,
    so rounds are few, and there is no bound on them. Names and edges are read back from the shared folder
    each time: lineage stays short, nothing is held by one executor alone, and joins shuffle both sides
    from files, where adaptive execution splits the rows of a hub or of a large component.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "edges")
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    names = written(nearest.select("node", F.least("node", "b").alias("component")), "names")
    while True:
        near = both.join(names, F.col("b") == F.col("node")).groupBy(F.col("a").alias("at"))
        near = near.agg(F.min("component").alias("best"))
        seen = names.withColumnRenamed("component", "was").join(near, F.col("node") == F.col("at"))
        seen = written(seen.select("node", "was", F.least("was", "best").alias("best")), "seen")
        takes = seen.groupBy("was").agg(F.min("best").alias("takes"))
        above = takes.select(F.col("was").alias("up"), F.col("takes").alias("top"))
        takes = takes.join(above, F.col("takes") == F.col("up"), "left")
        takes = takes.select(F.col("was").alias("old"), F.coalesce("top", "takes").alias("component"))
        names = written(seen.join(takes, F.col("was") == F.col("old")).select("node", "component", "was"), "names")
        changed = names.filter("component <> was").limit(1).count()
        names = names.select("node", "component")
        if not changed:
            return names
