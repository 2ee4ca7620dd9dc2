"""Connected components of a link table, by alternating large and small stars.

Each step is one aggregate and one join on node ids, written to the shared
folder. Aggregates combine before the shuffle and Spark splits skewed joins, so
a node that holds a third of all links is no single task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame):
    mark = F.xxhash64("u", "v")
    return edges.agg(F.count("*"), F.bit_xor(mark), F.sum(F.shiftright(mark, 20))).first()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) of every id in ``links``; component is its smallest linked id.

    Links are undirected and may repeat; self links and nulls are ignored.
    """
    edges = links.where(f"{a} != {b}").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct(), "links")
    before = _signature(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "stars")
        after = _signature(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.union(roots)
