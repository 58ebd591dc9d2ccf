"""Connected components of a table of links, by repeated contraction; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def _through(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    p = parents.select(F.col("v").alias("_v"), F.col("parent").alias("_parent"))
    joined = df.join(p, F.col(column) == F.col("_v"), "left")
    return joined.withColumn(column, F.coalesce("_parent", column)).drop("_v", "_parent")


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every end of ``links`` (a, b); the root is the smallest end that can be reached.

    Each round points every vertex at its smallest neighbour, shortens the pointers until they are flat, and replaces
    the ends of links by their roots; links inside one root vanish. Every table is written, so a lost executor costs
    one step. The joins are on single keys whose other side is unique; Spark splits the hot ones.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("to")))
        parents = both.groupBy("v").agg(F.min("to").alias("to")).select("v", F.least("v", "to").alias("parent"))
        parents = stored(parents, "parents")
        while True:
            shorter = stored(_through(parents.withColumn("was", F.col("parent")), "parent", parents), "parents")
            parents = shorter.select("v", "parent")
            if shorter.where("was <> parent").isEmpty():
                break
        found = parents.select("v", F.col("parent").alias("root"))
        roots = found if roots is None else _through(roots, "root", parents).unionByName(found.join(roots.select("v"), "v", "left_anti"))
        roots = stored(roots, "roots")
        edges = stored(_through(_through(edges, "a", parents), "b", parents).where("a <> b").distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots
