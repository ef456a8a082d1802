"""Interactive questions about a finished graph."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranking import global_rank
from .graph import STRENGTH_FIRST, ends, ordered

# Weights of a community's size and of its distance from the middle, when names are placed.
NEAR, FAR = 0.78, 0.65


def search(nodes: DataFrame, text: str, fields: list[str], most: int = 7) -> DataFrame:
    """Nodes whose fields hold the text (2 characters at least), names that begin with it first, then by rank."""
    t = text.strip().lower()
    if len(t) < 2:
        return nodes.limit(0)
    body = F.lower(F.concat_ws(" ", *fields))
    return nodes.filter(F.contains(body, F.lit(t))).orderBy(F.when(F.lower("name").startswith(t), 0).otherwise(1), F.desc("rank"), "id").limit(most)


def facet_values(areas: DataFrame, facet: str, hidden: tuple[str, ...] = ("Non-AI",)) -> DataFrame:
    return areas.filter((F.col("facet") == facet) & ~F.col("value").isin(*hidden)).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def visible(edges: DataFrame, mode: str, least: float = 0.0) -> DataFrame:
    """Edges of a view: all; network (backbone or the first 20,000); signal (backbone, else the first 7,500)."""
    e = edges.filter(F.col("strength") >= least)
    if mode == "all":
        return e
    first = {"network": 20_000, "signal": 7_500}[mode]
    best = e.orderBy(*ordered(e, STRENGTH_FIRST)).limit(first)
    spine = e.filter(F.col("b") == 1)
    if mode == "signal":
        return spine if spine.limit(1).count() else best
    return spine.unionByName(best).distinct()


def ego(edges: DataFrame, node) -> DataFrame:
    """The node, its neighbours and all edges among them."""
    near = ends(edges).filter(F.col("node") == node).select("other").union(edges.sparkSession.createDataFrame([(node,)], f"other {edges.schema['s'].dataType.simpleString()}")).distinct()
    a, b = near.withColumnRenamed("other", "s"), near.withColumnRenamed("other", "t")
    return edges.join(a, "s", "left_semi").join(b, "t", "left_semi")


def neighbours(edges: DataFrame, node, most: int = 5) -> DataFrame:
    return ends(edges).filter(F.col("node") == node).orderBy(F.desc("strength"), F.desc("weight"), "other").limit(most).select("other", "weight", "shared", "strength")


def strongest_pair(edges: DataFrame) -> DataFrame:
    return edges.orderBy(*ordered(edges, STRENGTH_FIRST)).limit(1)


def skeleton(edges: DataFrame) -> DataFrame:
    """The strongest tenth of the edges, 720 at least and 2,400 at most."""
    n = edges.count()
    return edges.orderBy(*ordered(edges, STRENGTH_FIRST)).limit(min(2400, max(720, n // 10)))


def in_view(points: DataFrame, x0: float, x1: float, y0: float, y1: float) -> DataFrame:
    return points.agg(F.count_if(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).alias("n"))


def nearest(points: DataFrame, x: float, y: float, within: float) -> DataFrame:
    d = F.hypot(F.col("x") - x, F.col("y") - y)
    return points.withColumn("d", d).filter(F.col("d") <= within).orderBy("d", "node").limit(1).select("node", F.round("d", 9).alias("d"))


def tiers(nodes: DataFrame, score: str = "score") -> DataFrame:
    """landmark: the first 1 in 100 nodes by score; core: the first 1 in 10; star: the rest.
    Cuts are exact ranks, found without one task that sorts all nodes."""
    placed = global_rank(nodes, [F.desc(score), F.asc("node")], "__place")
    n = placed.count()
    first, tenth = (max(1, math.ceil(n * share)) for share in (0.01, 0.10))
    return placed.withColumn("tier", F.when(F.col("__place") < first, "landmark").when(F.col("__place") < tenth, "core").otherwise("star")).drop("__place")


def dominant(areas: DataFrame) -> DataFrame:
    """(community, value): the most frequent value of each community, first by name on a tie."""
    n = areas.groupBy("community", "value").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("community").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("value"))


def annotations(centres: list[tuple[int, float, float, int]], most: int = 16, apart: float = 0.2) -> list[int]:
    """Communities (id, x, y, size) to annotate: by size times a weight that grows with the distance
    from the middle, each more than ``apart`` radians from those chosen before."""
    out: list[tuple[int, float]] = []
    for c, x, y, _ in sorted(centres, key=lambda r: (-r[3] * (NEAR + FAR * math.hypot(r[1], r[2])), r[0])):
        a = math.atan2(y, x)
        if all(abs((a - b + math.pi) % (2 * math.pi) - math.pi) > apart for _, b in out):
            out.append((c, a))
        if len(out) == most:
            break
    return [c for c, _ in out]


def ranked(nodes: DataFrame, by: str, most: int) -> DataFrame:
    """The first nodes by rank, with their place."""
    top = nodes.orderBy(F.desc(by), "id").limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(by), "id")))
