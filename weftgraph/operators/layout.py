"""Layout geometry: island placement, metrics, ellipses and density."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formulas import affinity, md5_unit
from ..plans.ranking import global_rank, quantiles
from ..plans.tables import materialize

GOLDEN = math.pi * (3 - math.sqrt(5))
# Fixed value: the greatest radius of a finished layout.
EDGE = 0.965
GRID = 144
LEVELS = (0.64, 0.84, 0.95)


def place_macros(sizes: pd.DataFrame, near: pd.DataFrame, sweeps: int = 108) -> pd.DataFrame:
    """(macro, x, y, radius): discs of area by size, drawn together by affinity and kept from
    overlapping. At most 18 macro communities take part, so this runs on the driver."""
    s = sizes.sort_values(["size", "macro"], ascending=[False, True]).reset_index(drop=True)
    total = max(1, int(s["size"].sum()))
    place = {int(m): [0.75 * math.sqrt((i + 0.5) / len(s)) * math.cos(i * 2.399963229728653), 0.75 * math.sqrt((i + 0.5) / len(s)) * math.sin(i * 2.399963229728653)] for i, m in enumerate(s["macro"])}
    radius = {int(m): 0.62 * math.sqrt(n / total) for m, n in zip(s["macro"], s["size"], strict=True)}
    most = max([1e-12, *near["affinity"]]) if len(near) else 1.0
    ids = list(place)
    for k in range(sweeps):
        cool = 0.05 * (1 - k / sweeps)
        push = {m: [-0.02 * place[m][0], -0.02 * place[m][1]] for m in ids}
        for a, b, x in near[["a", "b", "affinity"]].itertuples(index=False):
            dx, dy = place[b][0] - place[a][0], place[b][1] - place[a][1]
            f = 0.3 * x / most
            push[a][0] += f * dx
            push[a][1] += f * dy
            push[b][0] -= f * dx
            push[b][1] -= f * dy
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                dx, dy = place[b][0] - place[a][0], place[b][1] - place[a][1]
                d = math.hypot(dx, dy) or 1e-9
                over = (radius[a] + radius[b]) * 1.08 - d
                if over > 0:
                    for m, sign in ((a, -1), (b, 1)):
                        push[m][0] += sign * over * dx / d
                        push[m][1] += sign * over * dy / d
        for m in ids:
            size = math.hypot(*push[m]) or 1e-9
            step = min(size, cool + 0.02) / size
            place[m][0] += push[m][0] * step
            place[m][1] += push[m][1] * step
    return pd.DataFrame([(m, place[m][0], place[m][1], radius[m]) for m in ids], columns=["macro", "x", "y", "radius"])


def _places(nodes: DataFrame, group: str, order: list) -> DataFrame:
    """The nodes with their place in the group, from 0, and the group's size. A group may be a large
    part of all nodes: places come from one global order, not from a sorted task each."""
    placed = materialize(global_rank(nodes, [F.asc(group), *order]), "places")
    first = placed.groupBy(group).agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("total"))
    return placed.join(first, group).withColumn("place", F.col("place") - F.col("_first")).drop("_first")


def _spiral(radius, place, total) -> tuple:
    """Golden-angle places that fill a disc evenly, the first innermost."""
    r, angle = radius * F.sqrt((place + 0.5) / total), place * F.lit(GOLDEN)
    return r * F.cos(angle), r * F.sin(angle)


def _hashed(what: str, key) -> Column:
    return md5_unit(F.concat(F.lit(f"{what}:"), key.cast("string")))


def lobes(nodes: DataFrame, discs: DataFrame) -> DataFrame:
    """(macro, community, lx, ly, extent, tilt, stretch): a lobe for each micro community of a macro
    one, in its disc: the largest in the middle, the others on a spiral around it, turned by a
    hash, with an extent by its share of the macro's nodes."""
    size = nodes.groupBy("macro", "community").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("macro")
    size = size.withColumns({"k": F.row_number().over(own.orderBy(F.desc("n"), "community")) - 1, "of": F.count(F.lit(1)).over(own), "all": F.sum("n").over(own)})
    x, y = _spiral(F.col("radius") * 0.66, F.col("k") + F.when(F.col("k") == 0, -0.5).otherwise(0.0), F.col("of"))
    turn = F.atan2("y", "x") + 2 * math.pi * 0.05 * _hashed("lobe", F.col("community"))
    extent = F.col("radius") * F.least(F.lit(0.55), F.greatest(F.lit(0.1), 0.1 + 0.55 * F.sqrt(F.col("n") / F.col("all"))))
    j = size.join(discs, "macro").withColumns({"sx": x, "sy": y, "turn": turn})
    return j.select(
        "macro", "community", (F.col("x") + F.col("sx") * F.cos("turn") - F.col("sy") * F.sin("turn")).alias("lx"), (F.col("y") + F.col("sx") * F.sin("turn") + F.col("sy") * F.cos("turn")).alias("ly"),
        extent.alias("extent"), (2 * math.pi * _hashed("tilt", F.col("community"))).alias("tilt"), (1.1 + 0.5 * _hashed("stretch", F.col("community"))).alias("stretch"),
    )


def islands(nodes: DataFrame, discs: DataFrame, backbone: DataFrame) -> DataFrame:
    """(node, x, y): the whole island layout around discs of macro communities (macro, x, y, radius).

    ``nodes``: node, macro, community, component (its place, 0 the main one), rank, degree;
    ``backbone``: s, t, weight, strength. Nodes of the main component lie on a spiral in the lobe of
    their community, the strongest innermost, stretched and tilted. Each further component is a
    small satellite on the outer ring, at an angle and radius from its hash. Ends of backbone edges
    between macro communities are pulled towards the other side. At last all is centred on
    the main component and scaled to a greatest radius of EDGE."""
    strongest = [F.desc("rank"), F.desc("degree"), F.asc("node")]
    main = _places(nodes.filter("component = 0").withColumn("lobe", F.concat_ws(":", F.col("macro").cast("string"), F.col("community").cast("string"))), "lobe", strongest)
    sx, sy = _spiral(F.col("extent"), F.col("place"), F.col("total"))
    main = main.join(lobes(nodes.filter("component = 0"), discs), ["macro", "community"]).withColumns({"sx": sx * F.col("stretch"), "sy": sy / F.col("stretch")})
    main = main.select("node", "macro", F.lit(True).alias("main"), (F.col("lx") + F.col("sx") * F.cos("tilt") - F.col("sy") * F.sin("tilt")).alias("x"), (F.col("ly") + F.col("sx") * F.sin("tilt") + F.col("sy") * F.cos("tilt")).alias("y"))
    rest = _places(nodes.filter("component > 0"), "component", strongest)
    angle, far = 2 * math.pi * _hashed("satellite-angle", F.col("component")), 0.6 + 0.3 * _hashed("satellite-radius", F.col("component"))
    sx, sy = _spiral(F.least(F.lit(0.03), 0.003 + 0.003 * F.sqrt("total")), F.col("place"), F.col("total"))
    rest = rest.select("node", "macro", F.lit(False).alias("main"), (far * F.cos(angle) + sx).alias("x"), (far * F.sin(angle) + sy).alias("y"))
    placed = main.unionByName(rest)
    side = nodes.select(F.col("node").alias("other"), F.col("macro").alias("there"))
    pull = affinity(F.col("weight"), F.col("strength")).alias("pull")
    pulls = backbone.select(F.col("s").alias("node"), F.col("t").alias("other"), pull).unionByName(backbone.select(F.col("t").alias("node"), F.col("s").alias("other"), pull))
    here, there = (discs.select(F.col("macro").alias(m), F.col("x").alias(f"{m}_x"), F.col("y").alias(f"{m}_y")) for m in ("macro", "there"))
    pulls = pulls.join(nodes.select("node", "macro"), "node").join(side, "other").filter("macro != there").join(here, "macro").join(there, "there")
    long = F.hypot(F.col("there_x") - F.col("macro_x"), F.col("there_y") - F.col("macro_y")) + 1e-9
    pulls = pulls.groupBy("node").agg(F.sum("pull").alias("mass"), *(F.sum(F.col("pull") * (F.col(f"there_{c}") - F.col(f"macro_{c}")) / long).alias(f"p{c}") for c in "xy"))
    j = placed.join(pulls, "node", "left").join(discs.select("macro", "radius"), "macro", "left")
    shift = F.col("radius") * (0.04 + 0.1 * F.tanh(F.col("mass") / 6)) / (F.hypot("px", "py") + 1e-9)
    moved = materialize(j.select("node", "main", *((F.col(c) + F.coalesce(F.col(f"p{c}") * shift, F.lit(0.0))).alias(c) for c in "xy")), "islands")
    centre = moved.filter("main").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    most = moved.join(centre).agg(F.greatest(F.max(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))), F.lit(1e-9)).alias("most"))
    scaled = moved.join(centre).join(most)
    return scaled.select("node", *(F.round((F.col(c) - F.col(f"c{c}")) * EDGE / F.col("most"), 5).alias(c) for c in "xy"))


def metrics(points: DataFrame, backbone: DataFrame) -> DataFrame:
    """One row of layout metrics. ``points``: node, x, y, community, rank of the main component;
    ``backbone``: s, t."""
    p = points.withColumn("r", F.hypot("x", "y"))
    q = p.agg(F.max("r").alias("top"), F.count(F.lit(1)).alias("n"), F.corr(F.log1p("rank"), "r").alias("corr"))
    q = q.join(quantiles(p, "r", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, True).withColumn("p99", F.greatest("p99", F.lit(1e-9))))
    turn = (F.atan2("y", "x") + math.pi) / (2 * math.pi)
    rad = F.least(F.lit(0.999999), F.col("r") / F.col("p99"))
    bins = p.join(q.select("p99")).select(F.least(F.lit(7), F.floor(rad * rad * 8)).alias("a"), F.least(F.lit(23), F.floor(turn * 24)).alias("b")).distinct().agg((F.count(F.lit(1)) / 192).alias("coverage"))
    x, y = p.select(F.col("node").alias("s"), F.col("x").alias("x1"), F.col("y").alias("y1")), p.select(F.col("node").alias("t"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    e = backbone.join(x, "s").join(y, "t").select((F.col("x2") - F.col("x1")).alias("ex"), (F.col("y2") - F.col("y1")).alias("ey"), ((F.col("x1") + F.col("x2")) / 2).alias("mx"), ((F.col("y1") + F.col("y2")) / 2).alias("my"))
    e = e.withColumn("len", F.hypot("ex", "ey")).withColumn("mid", F.hypot("mx", "my"))
    along = F.when((F.col("len") > 1e-9) & (F.col("mid") > 0.08), F.abs(F.col("ex") * F.col("mx") + F.col("ey") * F.col("my")) / (F.col("len") * F.col("mid")))
    line = e.agg(F.coalesce(F.count_if(along >= 0.78) / F.nullif(F.count(along), F.lit(0)), F.lit(0.0)).alias("radial"))
    line = line.join(quantiles(e, "len", {"length": 0.5}, True))
    sector = p.groupBy("community", F.least(F.lit(15), F.floor(turn * 16)).alias("sector")).agg(F.count(F.lit(1)).alias("c"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    size = F.sum("c").over(Window.partitionBy("community"))
    sector = sector.withColumn("n", size).filter("n >= 12")
    com = sector.groupBy("community", "n").agg((-F.sum(F.col("c") / F.col("n") * F.log(F.col("c") / F.col("n"))) / math.log(16)).alias("h"), (F.hypot(F.sum("x"), F.sum("y")) / F.col("n")).alias("centre"))
    com = com.agg(F.coalesce(F.sum(F.col("h") * F.col("n")) / F.sum("n"), F.lit(0.0)).alias("entropy"), F.coalesce(F.median("centre"), F.lit(0.0)).alias("centre"))
    one = q.join(bins).join(line).join(com)
    return one.select(
        F.col("n").alias("main_nodes"), F.round("p50", 5).alias("radius_p50"), F.round("p95", 5).alias("radius_p95"), F.round("top", 5).alias("radius_max"), F.round("coverage", 4).alias("polar_coverage"),
        F.round("length", 5).alias("backbone_median_length"), F.round("radial", 4).alias("radial_share"), F.round("entropy", 4).alias("angular_entropy"), F.round("centre", 5).alias("centroid_radius_median"),
        F.round(F.coalesce(F.nanvl("corr", F.lit(0.0)), F.lit(0.0)), 4).alias("rank_radius_correlation"),
    )


def ellipses(points: DataFrame) -> DataFrame:
    """(community, x, y, radius, angle, aspect): the covariance envelope of each community."""
    m = points.groupBy("community").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("c"))
    far = points.join(m, "community").groupBy("community").agg(F.percentile(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), F.lit(0.92)).alias("q"))
    disc = F.sqrt(F.greatest(F.lit(0.0), F.pow(F.col("vx") - F.col("vy"), 2) + 4 * F.col("c") * F.col("c")))
    j = m.join(far, "community").withColumn("major", F.greatest((F.col("vx") + F.col("vy") + disc) / 2, F.lit(1e-8)))
    j = j.withColumn("minor", F.greatest((F.col("vx") + F.col("vy") - disc) / 2, F.col("major") * 0.12))
    return j.select(
        "community", F.round("cx", 5).alias("x"), F.round("cy", 5).alias("y"), F.round(F.greatest(F.lit(0.025), F.col("q") * 1.08), 5).alias("radius"),
        F.round(0.5 * F.atan2(2 * F.col("c"), F.col("vx") - F.col("vy")), 5).alias("angle"),
        F.round(F.greatest(F.lit(1.05), F.least(F.lit(2.35), F.sqrt(F.col("major") / F.col("minor")))), 4).alias("aspect"),
    )


def frame(points: DataFrame) -> DataFrame:
    """Origin and step of a square grid around the points."""
    b = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(0.001)) * 1.12
    return b.select(((F.col("x0") + F.col("x1") - span) / 2).alias("ox"), ((F.col("y0") + F.col("y1") - span) / 2).alias("oy"), (span / (GRID - 1)).alias("step"))


def density(points: DataFrame) -> DataFrame:
    """(gx, gy, value): kernel density on the grid. A point adds to at most 10 x 10 cells around it."""
    g = points.join(frame(points)).select(((F.col("x") - F.col("ox")) / F.col("step")).alias("px"), ((F.col("y") - F.col("oy")) / F.col("step")).alias("py"))

    def near(c: str):
        return F.sequence(F.greatest(F.lit(0), F.floor(c) - 4).cast("int"), F.least(F.lit(GRID - 1), F.ceil(c) + 4).cast("int"))

    cells = g.withColumn("gx", F.explode(near("px"))).withColumn("gy", F.explode(near("py")))
    return cells.groupBy("gx", "gy").agg(F.sum(F.exp(-(F.pow(F.col("px") - F.col("gx"), 2) + F.pow(F.col("py") - F.col("gy"), 2)) / 5)).alias("value"))


def thresholds(field: DataFrame) -> DataFrame:
    """(level, threshold): the value at place floor((n - 1) q) of the cells above 0.5. At most
    GRID * GRID cells are sorted."""
    w = Window.orderBy("value", "gx", "gy")
    placed = field.filter("value > 0.5").withColumn("k", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    out = None
    for level, q in enumerate(LEVELS):
        one = placed.filter(F.col("k") == F.floor((F.col("n") - 1) * q)).select(F.lit(level).alias("level"), F.col("value").alias("threshold"))
        out = one if out is None else out.unionByName(one)
    return out


def contours(field: DataFrame, at: DataFrame, grid: DataFrame) -> DataFrame:
    """(level, x1, y1, x2, y2) in the points' coordinates: segments by marching triangles, two to
    a cell. ``grid`` is the frame that the field was made on."""
    full = field.sparkSession.range(GRID * GRID).select((F.col("id") % GRID).cast("int").alias("gx"), F.expr(f"cast(id div {GRID} as int)").alias("gy"))
    f = full.join(field, ["gx", "gy"], "left").select("gx", "gy", F.coalesce("value", F.lit(0.0)).alias("v"))

    def corner(dx: int, dy: int, name: str):
        return f.select((F.col("gx") - dx).alias("gx"), (F.col("gy") - dy).alias("gy"), F.col("v").alias(name))

    cells = f.withColumnRenamed("v", "a").join(corner(1, 0, "b"), ["gx", "gy"]).join(corner(1, 1, "c"), ["gx", "gy"]).join(corner(0, 1, "d"), ["gx", "gy"])

    def point(dx: int, dy: int, v: str):
        return F.struct((F.col("gx") + dx).cast("double").alias("x"), (F.col("gy") + dy).cast("double").alias("y"), F.col(v).alias("v"))

    a, b, c, d = point(0, 0, "a"), point(1, 0, "b"), point(1, 1, "c"), point(0, 1, "d")
    tri = cells.select(F.explode(F.array(F.array(a, b, c), F.array(a, c, d))).alias("p")).join(at)
    t = F.col("threshold")

    def cross(i: int, j: int):
        p, q = F.col("p")[i], F.col("p")[j]
        k = (t - p["v"]) / (q["v"] - p["v"])
        return F.when((p["v"] >= t) != (q["v"] >= t), F.struct((p["x"] + (q["x"] - p["x"]) * k).alias("x"), (p["y"] + (q["y"] - p["y"]) * k).alias("y")))

    cut = tri.select("level", F.filter(F.array(cross(0, 1), cross(1, 2), cross(2, 0)), lambda x: x.isNotNull()).alias("x")).filter(F.size("x") == 2)
    return cut.join(grid).select("level", *((F.col(o) + F.col("x")[k][c] * F.col("step")).alias(f"{c}{k + 1}") for k in (0, 1) for c, o in (("x", "ox"), ("y", "oy"))))
