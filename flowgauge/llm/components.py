"""Connected components of a graph that is too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.tables import stored


#: A node with more than one edge in this many, and more than FEW, is a hub; there are fewer than twice this many hubs.
SHARE, FEW = 1_000, 256


def _with_least(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """Edges with ``m`` of their node ``a``. The edges of hubs stay where they are: a hub's number is sent to them.

    ``least`` has a, m and degree. At most 2 * n_edges ends of edges make fewer than 2 * SHARE hubs, whatever the graph.
    """
    hub = (F.col("degree") > FEW) & (F.col("degree") * SHARE > n_edges)
    hubs = F.broadcast(least.where(hub).select("a", "m"))
    return edges.join(hubs, "a").unionByName(edges.join(hubs, "a", "left_anti").join(least.where(~hub).select("a", "m"), "a"))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count("*").alias("degree"))
    moved = _with_least(both.where("b > a"), least, n_edges)
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every node hands its smallest smaller neighbour to its other smaller neighbours, and takes it."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    moved = _with_least(edges, least, n_edges).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node that it reaches.

    Links may come in any direction and more than once; loops and nulls are left out. Alternating large and small stars
    shrink every component to a star around its smallest node in a number of rounds that grows with the logarithm of
    the path lengths. Minima are combined before the shuffle, and the edges of a node with very many links are not brought
    together (``_with_least``); each round is written to the shared folder. Only a count and a sum of hashes reach the
    driver.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        # Between the stars the edges are written: both read them more than once.
        large = stored(_large_star(edges, state[0]), "links")
        edges = stored(_small_star(large, state[0]), "links")
