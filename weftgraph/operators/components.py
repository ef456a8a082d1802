"""Connected components by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import materialize


#: Edges, or less, that one task finishes at once: rounds of jobs over so few cost more than the work.
SMALL = 8_000


def roots(pairs) -> dict:
    """The least vertex that each vertex of the pairs reaches."""
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(up)}


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if batches:
        kind = batches[0].schema.field(0).type
        found = roots(p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), kind), pa.array(found.values(), kind)], names=["u", "to"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", written: bool = False) -> DataFrame:
    """(id, component): each vertex of an edge, and the least vertex that it can reach.

    Every round points each vertex at its least neighbour, or itself, and contracts the
    edges to the pointed-at vertices. A vertex that is not the least around it vanishes,
    so the vertices that still have edges at least halve: log2(n) rounds, each on a
    smaller graph. The rounds' maps are then composed. Minima are partial aggregates,
    so a vertex with very many edges is no burden to one task. Once SMALL edges are left, one
    task finishes them; edges that are a ``written`` table are counted for that before the first round.
    """
    a, b = F.col(src), F.col(dst)
    if written:
        few = edges.select(a.alias("u"), b.alias("v")).filter("u is not null and v is not null")
        if few.count() <= SMALL:
            kind = few.schema["u"].dataType.simpleString()
            return few.coalesce(1).mapInArrow(_at_once, f"u {kind}, to {kind}").select(F.col("u").alias("id"), F.col("to").alias("component"))
    both = edges.select(a.alias("u"), b.alias("v")).union(edges.select(b, a)).filter("u is not null and v is not null").distinct()
    left = materialize(both, "edges")
    maps: list[DataFrame] = []
    while True:
        if left.count() <= SMALL:
            kind = left.schema["u"].dataType.simpleString()
            maps.append(left.coalesce(1).mapInArrow(_at_once, f"u {kind}, to {kind}"))
            break
        step = materialize(left.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to")), "map")
        maps.append(step)
        s, t = step.select(F.col("u"), F.col("to").alias("p")), step.select(F.col("u").alias("v"), F.col("to").alias("q"))
        left = materialize(left.join(s, "u").join(t, "v").filter("p != q").select(F.col("p").alias("u"), F.col("q").alias("v")).distinct(), "edges")
    out = maps[0].select(F.col("u").alias("id"), F.col("to").alias("component"))
    for step in maps[1:]:
        nxt = step.select(F.col("u").alias("component"), "to")
        out = out.join(nxt, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return out
