"""Graph operators over edges (s, t, weight, shared, strength) with s < t."""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formulas import affinity
from ..plans.ranking import global_rank
from ..plans.tables import materialize
from .components import SMALL, connected_components

STRENGTH_FIRST = ("strength", "weight", "shared")
WEIGHT_FIRST = ("weight", "strength", "shared")


def ordered(edges: DataFrame, by: tuple[str, ...] = WEIGHT_FIRST) -> list:
    return [*(F.desc(c) for c in by), F.asc("s"), F.asc("t")]


def ends(edges: DataFrame) -> DataFrame:
    """Every edge seen from either end: node, other and the edge's columns."""
    both = F.explode(F.array(F.struct(F.col("s").alias("node"), F.col("t").alias("other")), F.struct(F.col("t").alias("node"), F.col("s").alias("other"))))
    return edges.withColumn("_end", both).select("_end.*", *edges.columns)


def degrees(edges: DataFrame) -> DataFrame:
    e = ends(edges)
    return e.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("weighted_degree"), F.sum("strength").alias("strength"), F.sum(affinity(F.col("weight"), F.col("strength"))).alias("volume"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component, size, place): components by falling size, then least node; lone nodes too."""
    found = connected_components(edges, "s", "t")
    named = nodes.select("node").join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sizes = global_rank(sizes, [F.desc("size"), F.asc("component")]).withColumn("place", F.col("place").cast("int"))
    return named.join(sizes, "component").select("node", "component", "size", "place")


def _greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (s, t, rank, a, b) in the order of rank, each kept if it joins two parts a and b."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for r in sorted(rows, key=lambda r: tuple(r["rank"].values())):
        x, y = find(r["a"]), find(r["b"])
        if x != y:
            up[x] = y
            kept.append((r["s"], r["t"]))
    if kept:
        kind = pa.array([rows[0]["s"]]).type
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*kept, strict=True)], names=["s", "t"])


def spanning_forest(edges: DataFrame, by: tuple[str, ...] = WEIGHT_FIRST) -> DataFrame:
    """The maximum spanning forest under a total order of edges, by Boruvka's rounds.

    The order is total, so the forest is the one that a greedy walk over the sorted edges
    would keep. Each round every component takes its first edge, those edges contract, and
    edges inside a component go; components at least halve. Once few edges are left, one
    task walks them."""
    rank = F.struct(*((-F.col(c)).alias(c) for c in by), F.col("s"), F.col("t"))
    kind = edges.schema["s"].dataType.simpleString()
    left = materialize(edges.select("s", "t", rank.alias("rank"), F.col("s").alias("a"), F.col("t").alias("b")), "forest")
    kept = edges.select("s", "t").limit(0)
    while True:
        if left.count() <= SMALL:
            return kept.unionByName(left.coalesce(1).mapInArrow(_greedy, f"s {kind}, t {kind}"))
        e = F.struct("s", "t", "a", "b")
        sides = left.select(F.col("a").alias("c"), e.alias("e"), "rank").unionByName(left.select(F.col("b").alias("c"), e.alias("e"), "rank"))
        chosen = materialize(sides.groupBy("c").agg(F.min_by("e", "rank").alias("e")).select("e.*").distinct(), "chosen")
        kept = kept.unionByName(chosen.select("s", "t"))
        parts = connected_components(chosen, "a", "b")
        x, y = parts.select(F.col("id").alias("a"), F.col("component").alias("x")), parts.select(F.col("id").alias("b"), F.col("component").alias("y"))
        now = left.join(x, "a", "left").join(y, "b", "left").select("s", "t", "rank", F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        left = materialize(now.filter("a != b"), "forest")


def strongest_of_node(edges: DataFrame, most: int = 2, by: tuple[str, ...] = WEIGHT_FIRST) -> DataFrame:
    w = Window.partitionBy("node").orderBy(*ordered(edges, by))
    return ends(edges).withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most).select("s", "t").distinct()


def backbone(edges: DataFrame, top: int = 1500, own: int = 2) -> DataFrame:
    """The forest, every node's two strongest edges and the strongest edges of all."""
    best = edges.orderBy(*ordered(edges)).limit(top).select("s", "t")
    return spanning_forest(edges).unionByName(strongest_of_node(edges, own)).unionByName(best).distinct()


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, core) of a whole graph (node, other, both ways): nodes leave by falling-in degree."""
    near: dict = defaultdict(list)
    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            near[x].append(y)
    degree = {v: len(n) for v, n in near.items()}
    levels: list[list] = [[] for _ in range(max(degree.values(), default=0) + 1)]
    for v, d in degree.items():
        levels[d].append(v)
    core: dict = {}
    k = at = 0
    while at < len(levels):
        if not levels[at]:
            at += 1
            continue
        v = levels[at].pop()
        if v in core or degree[v] != at:
            continue
        k = max(k, at)
        core[v] = k
        for u in near[v]:
            if u not in core:
                degree[u] -= 1
                levels[degree[u]].append(u)
                at = min(at, degree[u])
    if core:
        yield pa.RecordBatch.from_arrays([pa.array(core.keys(), kind), pa.array(core.values(), pa.int32())], names=["node", "core"])


def core_numbers(edges: DataFrame) -> DataFrame:
    """(node, core): the largest k for which the node lies in a subgraph of least degree k.

    Up to SMALL edges one task peels them. Beyond, every node takes the h-index of its
    neighbours' numbers, from degrees on, until none changes; a hub's neighbours are counted by
    number first. Long tails of degree 1 or 2 take a round for each of their nodes."""
    kind = edges.schema["s"].dataType.simpleString()
    plain = edges.filter("s != t").select(F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t")).distinct()
    e = materialize(ends(plain).select("node", "other"), "core")
    if e.count() <= 2 * SMALL:
        return e.coalesce(1).mapInArrow(_peel, f"node {kind}, core int")
    now = materialize(e.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("core")), "cores")
    while True:
        own = now.select("node", F.col("core").alias("own"))
        seen = e.join(now.withColumnRenamed("node", "other"), "other").join(own, "node")
        counts = seen.groupBy("node", "own", F.least("core", "own").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        above = F.sum("n").over(Window.partitionBy("node").orderBy(F.desc("v")))
        h = counts.withColumn("h", F.least(F.col("v").cast("long"), above)).groupBy("node", "own").agg(F.max("h").cast("int").alias("core"))
        step = materialize(h, "cores")
        now = step.select("node", "core")
        if step.filter("core != own").isEmpty():
            return now


def propagate(edges: DataFrame, sweeps: int = 32, resolution: float = 1.15) -> DataFrame:
    """(node, label): synchronous label propagation with a modularity penalty, for graphs of
    any size. In a sweep the nodes of one half, by hash and turn, move to the label of best
    gain, so that neighbours don't swap for ever; it ends when both halves stand still.
    Its results differ from ``communities``, which visits nodes one by one."""
    aff = affinity(F.col("weight"), F.col("strength"))
    e = materialize(ends(edges).select("node", "other", aff.alias("a")), "affinity")
    vol = materialize(e.groupBy("node").agg(F.sum("a").alias("vol")), "volume")
    total = vol.agg(F.sum("vol")).first()[0] or 1.0
    now, quiet = vol.select("node", F.col("node").alias("label"), "vol"), 0
    for turn in range(sweeps):
        held = now.groupBy("label").agg(F.sum("vol").alias("cv"))
        to = now.select(F.col("node").alias("other"), "label")
        near = e.join(to, "other").groupBy("node", "label").agg(F.sum("a").alias("near"))
        mine = now.select("node", F.col("label").alias("own"), "vol")
        near = near.unionByName(now.select("node", "label", F.lit(0.0).alias("near"))).groupBy("node", "label").agg(F.sum("near").alias("near"))
        gain = near.join(mine, "node").join(held, "label")
        rest = F.col("cv") - F.when(F.col("label") == F.col("own"), F.col("vol")).otherwise(0.0)
        gain = gain.withColumn("gain", F.round(F.col("near") - F.lit(resolution / total) * F.col("vol") * rest, 9))
        best = gain.groupBy("node").agg(F.max_by("label", F.struct("gain", F.col("label") == F.col("own"), -F.col("label"))).alias("best"))
        moves = F.pmod(F.xxhash64("node", F.lit(turn // 2)), F.lit(2)) == turn % 2
        step = now.join(best, "node").select("node", F.when(moves, F.col("best")).otherwise(F.col("label")).alias("label"), "vol", (moves & (F.col("best") != F.col("label"))).alias("moved"))
        step = materialize(step, "labels")
        quiet = 0 if step.filter("moved").limit(1).count() else quiet + 1
        now = step.drop("moved")
        if quiet == 2:
            break
    return now.select("node", "label")


def _unit(text: str) -> float:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big") / 2**64


class _Communities:
    """Sequential label moves over one connected component, held in one task. ``total`` is the
    volume of the whole graph, of which the component may be a part."""

    def __init__(self, rows: pd.DataFrame, resolution: float, total: float, prefix: str):
        self.near: dict = defaultdict(dict)
        for s, t, a in rows[["s", "t", "a"]].itertuples(index=False):
            self.near[s][t] = self.near[s].get(t, 0.0) + a
            self.near[t][s] = self.near[t].get(s, 0.0) + a
        self.volume = {v: sum(n.values()) for v, n in self.near.items()}
        self.resolution, self.total = resolution, max(1e-12, total)
        self.label = {v: v for v in self.near}
        self.load = dict(self.volume)
        self.name = {v: f"{prefix}{v}" for v in self.near}
        self.order = sorted(self.near, key=lambda v: (-self.volume[v], _unit(self.name[v]), self.name[v]))

    def _pulls(self, v, barred=()) -> dict:
        out: dict = {}
        for u, a in self.near[v].items():
            c = self.label[u]
            if c not in barred:
                out[c] = out.get(c, 0.0) + a
        return out

    def sweep(self) -> bool:
        """Each node moves to the label of best gain, or stays where no gain is above 0; of gains
        that rounding can not tell apart the own label wins, else the first."""
        moved = False
        for v in self.order:
            own, vol = self.label[v], self.volume[v]
            self.load[own] -= vol
            best, most = own, 0.0
            for c, pull in sorted(self._pulls(v).items()):
                gain = pull - self.resolution * vol * self.load[c] / self.total
                near = max(1.0, abs(most), abs(gain)) * 1e-12
                if gain > most + near or (c == own != best and abs(gain - most) <= near):
                    best, most = c, gain
            self.load[best] += vol
            self.label[v] = best
            moved |= best != own
        return moved

    def absorb(self, least: int, passes: int) -> None:
        """Nodes of communities of less than ``least`` go, one by one in the order of their names,
        to the larger community that binds each most. What counts as small is fixed for a pass."""
        names = sorted(self.near, key=self.name.get)
        for _ in range(passes):
            sizes = Counter(self.label.values())
            small = {c for c, n in sizes.items() if n < least}
            moved = False
            for v in names if small else ():
                if self.label[v] in small and (pulls := self._pulls(v, small)):
                    most = max(pulls.values())
                    self.label[v] = min(c for c, x in pulls.items() if most - x <= max(1.0, abs(most)) * 1e-12)
                    moved = True
            if not moved:
                return


def communities(edges: DataFrame, sweeps: int = 32, resolution: float = 1.15, least: int = 12, passes: int = 5, parts: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """(node, label): asynchronous, modularity-penalised label propagation with absorption of
    fragments, one task per connected component; the penalty is against the whole graph's volume.
    Nodes are visited by falling volume, then by a hash of their name, which is ``prefix`` and
    the id. The visiting order makes it sequential, so a component must fit one task: builds
    bound the graph (``Parameters.max_rows``), and ``propagate`` is the way beyond that."""
    parts = connected_components(edges, "s", "t") if parts is None else parts
    rows = edges.select("s", "t", affinity(F.col("weight"), F.col("strength")).alias("a"))
    total = 2 * (rows.agg(F.sum("a")).first()[0] or 0.0)
    rows = rows.join(parts.withColumnRenamed("id", "s"), "s")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g = _Communities(rows.sort_values(["s", "t"]), resolution, total, prefix)
        for _ in range(sweeps):
            if not g.sweep():
                break
        g.absorb(least, passes)
        return pd.DataFrame({"node": list(g.label), "label": list(g.label.values())})

    kind = edges.schema["s"].dataType.simpleString()
    return rows.groupBy("component").applyInPandas(run, f"node {kind}, label {kind}")


def renumber(labels: DataFrame, rank: DataFrame) -> DataFrame:
    """(node, community): labels numbered by falling size, falling total rank, least node."""
    sized = labels.join(rank, "node", "left").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("rank", F.lit(0.0))).alias("r"), F.min("node").alias("least"))
    sized = sized.withColumn("r", F.round("r", 6))
    numbered = global_rank(sized, [F.desc("n"), F.desc("r"), F.asc("least")], "community").select("label", F.col("community").cast("int").alias("community"))
    return labels.join(numbered, "label").select("node", "community")


def affinities(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, affinity) between communities a < b."""
    x, y = labels.select(F.col("node").alias("s"), F.col("community").alias("cs")), labels.select(F.col("node").alias("t"), F.col("community").alias("ct"))
    j = edges.join(x, "s").join(y, "t").filter("cs != ct")
    return j.groupBy(F.least("cs", "ct").alias("a"), F.greatest("cs", "ct").alias("b")).agg(F.sum(affinity(F.col("weight"), F.col("strength"))).alias("affinity"))


def macro_count(n: int) -> int:
    return 18 if n >= 8000 else 14 if n >= 1500 else 10


def _joined(nodes, links: dict) -> list[list]:
    """The connected parts of some nodes, each sorted."""
    left, out = set(nodes), []
    while left:
        part = [left.pop()]
        for x in part:
            near = links[x].keys() & left
            left -= near
            part += near
        out.append(sorted(part))
    return out


def macros(sizes: pd.DataFrame, near: pd.DataFrame, n_nodes: int) -> dict[int, int]:
    """Macro community of each micro community (community, size; a, b, affinity).

    The largest communities of the main part (the one of most nodes) are seeds; then, one by
    one, the community and macro of best affinity over a load penalty join; where no affinity
    leads on, the largest left goes to the least loaded. Other parts stay whole: a hash of
    their least community picks one of the macros that the seeds left free, or of all. Bounded
    by the graph's communities: this runs on the driver, in the time of sorting the affinities."""
    size = dict(zip(sizes["community"].tolist(), sizes["size"].tolist(), strict=True))
    if not size:
        return {}
    links: dict = defaultdict(dict)
    for a, b, x in near[["a", "b", "affinity"]].itertuples(index=False):
        links[a][b] = links[b][a] = x
    parts = sorted(_joined(size, links), key=lambda p: (-sum(size[c] for c in p), p[0]))
    main, k = parts[0], min(macro_count(n_nodes), len(size))
    seeds = sorted(main, key=lambda c: (-size[c], c))[:k]
    out: dict = {}
    load = [0] * len(seeds)
    ideal = sum(size[c] for c in main) / len(seeds)
    # Within a macro the penalty is the same for all, so each needs its strongest candidate only.
    heaps: list[list] = [[] for _ in seeds]
    pulls: dict = defaultdict(float)

    def put(c, m: int) -> None:
        out[c] = m
        load[m] += size[c]
        for d, x in links[c].items():
            if d not in out:
                pulls[d, m] += x
                heapq.heappush(heaps[m], (-pulls[d, m], d))

    for m, c in enumerate(seeds):
        put(c, m)
    rest = iter(sorted(main, key=lambda c: (-size[c], c)))
    while len(out) < len(main):
        best = None
        for m, heap in enumerate(heaps):
            while heap and (heap[0][1] in out or -heap[0][0] != pulls[heap[0][1], m]):
                heapq.heappop(heap)
            if heap:
                key = (-heap[0][0] / (1 + load[m] / ideal) ** 1.45, -heap[0][1], -m)
                best = key if best is None else max(best, key)
        if best is None:
            put(next(c for c in rest if c not in out), min(range(len(seeds)), key=lambda m: (load[m], m)))
        else:
            put(-best[1], -best[2])
    free = list(range(len(seeds), k)) or list(range(len(seeds)))
    for part in parts[1:]:
        m = free[min(len(free) - 1, int(_unit(f"satellite-macro:{part[0]}") * len(free)))]
        out |= dict.fromkeys(part, m)
    return out


def micro_counts(labels: DataFrame, macro: DataFrame) -> DataFrame:
    """(macro, members, micros): nodes and distinct micro communities of each macro community;
    ``labels`` have node, community, ``macro`` has community, macro."""
    sizes = labels.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(macro, "community").groupBy("macro").agg(F.sum("n").alias("members"), F.count(F.lit(1)).alias("micros"))


def split_edges(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges with both communities and whether they lie inside one."""
    x, y = labels.select(F.col("node").alias("s"), F.col("community").alias("c_s")), labels.select(F.col("node").alias("t"), F.col("community").alias("c_t"))
    return edges.join(x, "s").join(y, "t").withColumn("inside", F.col("c_s") == F.col("c_t"))


def golden_place(index: int, total: int) -> tuple[float, float]:
    """Places in the unit disc that fill it evenly."""
    r, angle = math.sqrt((index + 0.5) / max(1, total)), index * math.pi * (3 - math.sqrt(5))
    return r * math.cos(angle), r * math.sin(angle)
