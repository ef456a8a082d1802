"""Further registered queries: single functions, filters, lookups and gates, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formulas, text
from ..operators import explore, graph, labels, layout, quality, taxonomy
from ..sources import stand_ins
from .catalog import CURATED_SQL, GRAPH, NODES, POINTS_SQL, PRUNED, P, Steps, query, with_views

# --- Graph views ------------------------------------------------------------------------


@query("ui3_visible_all", with_views(GRAPH + "z as (select 1) select s, t from g where strength >= 0.5"))
def visible_all(spark, sf):
    return explore.visible(Steps(spark, sf).g.withColumn("b", F.lit(0)), "all", 0.5).select("s", "t")


@query("ui3_visible_network", with_views(GRAPH + "e as (select *, s % 7 = 0 as b from g where strength >= 0.2), best as (select s, t from e order by strength desc, weight desc, shared desc, s, t limit 20000) select s, t from e where b union select s, t from best"))
def visible_network(spark, sf):
    g = Steps(spark, sf).g.withColumn("b", (F.col("s") % 7 == 0).cast("int"))
    return explore.visible(g, "network", 0.2).select("s", "t")


@query("tk7_neighbours", with_views(GRAPH + "m as (select min(node) as m from both_ends) select other, weight, shared, strength from both_ends, m where node = m order by strength desc, weight desc, other limit 5"))
def neighbours(spark, sf):
    g = Steps(spark, sf).g
    return explore.neighbours(g, g.agg(F.min(F.least("s", "t"))).first()[0])


@query("tk7_skeleton", with_views(GRAPH + "n as (select least(2400, greatest(720, count(*) // 10)) as n from g), r as (select s, t, row_number() over (order by strength desc, weight desc, shared desc, s, t) as r from g) select s, t from r, n where r <= n"))
def skeleton(spark, sf):
    return explore.skeleton(Steps(spark, sf).g).select("s", "t")


@query("tk5_ranked_nodes", with_views(NODES + "r as (select id, openrank_sum, row_number() over (order by openrank_sum desc, id) as place from kept) select * from r where place <= 50"))
def ranked_nodes(spark, sf):
    return explore.ranked(Steps(spark, sf).kept, "openrank_sum", 50).select("id", "openrank_sum", "place")


@query(
    "ui7_annotations",
    f"""with recursive {POINTS_SQL}, m as (select community, avg(x) as x, avg(y) as y, count(*) as n from p group by community),
c as (select community, atan2(y, x) as angle, row_number() over (order by n * (0.78 + 0.65 * sqrt(x * x + y * y)) desc, community) as k from m),
r as (select 0 as i, cast([] as double[]) as angles, cast([] as int[]) as ids
  union all select i + 1, case when fits then list_append(angles, angle) else angles end, case when fits then list_append(ids, community) else ids end
  from (select r.*, c.angle, c.community, len(ids) < 16 and len(list_filter(angles, lambda a: least(abs(c.angle - a), 2 * pi() - abs(c.angle - a)) <= 0.2)) = 0 as fits from r join c on c.k = r.i + 1))
select cast(unnest(ids) as int) as community, cast(unnest(range(len(ids))) as int) as place from r where i = (select max(i) from r)""",
)
def annotations(spark, sf):
    m = stand_ins.points(spark, sf).groupBy("community").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
    # A label of each of at most a few thousand communities is weighed on the driver, as a view does.
    chosen = explore.annotations([tuple(r) for r in m.collect()])
    return spark.createDataFrame([(c, i) for i, c in enumerate(chosen)], "community int, place int")


@query("ag27_micro_counts", "select n_regionkey as macro, count(*) as members, count(distinct n_nationkey) as micros from customer join nation on c_nationkey = n_nationkey group by n_regionkey")
def micro_counts(spark, sf):
    nodes = stand_ins.table(spark, sf, "customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("community"))
    return graph.micro_counts(nodes, stand_ins.table(spark, sf, "nation").select(F.col("n_nationkey").alias("community"), F.col("n_regionkey").alias("macro")))


# --- Gates over a view with planted faults --------------------------------------------------

_BAD_EDGES = [
    (f"{stand_ins.PLATFORM}:1", f"{stand_ins.PLATFORM}:1", 1.0, 3, 1.0), (f"{stand_ins.PLATFORM}:9", f"{stand_ins.PLATFORM}:4", 0.5, 2, 0.5), (f"{stand_ins.PLATFORM}:2", f"{stand_ins.PLATFORM}:900001", -1.0, 2, 1.0),
    (f"{stand_ins.PLATFORM}:2", f"{stand_ins.PLATFORM}:900002", 1.0, 1, 1.0), (f"{stand_ins.PLATFORM}:2", f"{stand_ins.PLATFORM}:900003", float("nan"), 2, 1.0), (f"{stand_ins.PLATFORM}:2", f"{stand_ins.PLATFORM}:900004", 1.0, 2, float("inf")),
    ("Other:2", f"{stand_ins.PLATFORM}:900005", 1.0, 2, 1.0), (f"{stand_ins.PLATFORM}:x", f"{stand_ins.PLATFORM}:900006", 1.0, 2, 1.0), (f"{stand_ins.PLATFORM}:2", f"{stand_ins.PLATFORM}:900001", 2.0, 5, 1.0),
]


def _number(x: float) -> str:
    return f"cast('{x}' as double)"


_BAD_EDGES_SQL = ", ".join(f"('{s}', '{t}', {_number(w)}, {n}, {_number(c)})" for s, t, w, n, c in _BAD_EDGES)


@query(
    "qa4_edge_faults",
    with_views(
        PRUNED
        + f"""f as (select 'TPCH:' || source as source, 'TPCH:' || target as target, weight, shared_contributors, collaboration_strength as strength from pruned
  union all select * from (values {_BAD_EDGES_SQL}) v(source, target, weight, shared_contributors, strength)),
k as (select *, try_cast(regexp_extract(source, '^TPCH:([0-9]+)$', 1) as bigint) as s, try_cast(regexp_extract(target, '^TPCH:([0-9]+)$', 1) as bigint) as t, not (isfinite(weight) and isfinite(strength)) as odd from f)
select count(*) as n_edges, count(*) filter (s is null or t is null) as bad_ids, count(*) filter (s = t) as self_loops, count(*) filter (s > t) as misordered, count(*) filter (odd) as not_finite,
  count(*) filter (not odd and (weight <= 0 or strength <= 0)) as not_positive, count(*) filter (shared_contributors < 2) as too_few_shared,
  (select cast(sum(n - 1) as bigint) from (select count(*) as n from f group by source, target)) as duplicates from k"""
    ),
)
def edge_faults(spark, sf):
    bad = spark.createDataFrame(_BAD_EDGES, "source string, target string, weight double, shared_contributors long, collaboration_strength double")
    return quality.edge_counters(Steps(spark, sf).named.unionByName(bad), P.platform, P.min_shared).select("n_edges", *quality.FAULTS)


@query(
    "qa5_node_faults",
    with_views(
        NODES
        + """f as (select id, platform, repo_id, case when repo_id % 5 = 0 then -openrank_sum when repo_id % 5 = 1 then cast('nan' as double) else openrank_sum end as openrank_sum, openrank_avg, openrank_max,
  case when repo_id % 3 = 0 then 13 else months_present end as months_present, normalized_contribution from kept union all select 'TPCH:0' || repo_id, platform, repo_id, openrank_sum, openrank_avg, openrank_max, 0, normalized_contribution from kept where repo_id % 4 = 0
  union all select id, platform, repo_id, openrank_sum, openrank_avg, openrank_max, months_present, normalized_contribution from kept where repo_id % 6 = 0)
select count(*) as n_nodes, count(*) - count(distinct id) as duplicates, count(*) filter (id != platform || ':' || repo_id) as bad_identity, count(*) filter (isnan(openrank_sum) or openrank_sum < 0) as bad_numbers,
  count(*) filter (months_present < 1 or months_present > 12) as bad_months from f"""
    ),
)
def node_faults(spark, sf):
    steps = Steps(spark, sf)
    k = F.col("repo_id")
    one = steps.kept.withColumns({"openrank_sum": F.when(k % 5 == 0, -F.col("openrank_sum")).when(k % 5 == 1, float("nan")).otherwise(F.col("openrank_sum")), "months_present": F.when(k % 3 == 0, 13).otherwise(F.col("months_present"))})
    two = steps.kept.filter(k % 4 == 0).withColumns({"id": F.concat(F.lit("TPCH:0"), k.cast("string")), "months_present": F.lit(0)})
    bad = one.unionByName(two).unionByName(steps.kept.filter(k % 6 == 0))
    return quality.node_counters(bad, steps.named, P.labels).select("n_nodes", "duplicates", "bad_identity", "bad_numbers", "bad_months")


# --- Labels and lookups -----------------------------------------------------------------------


@query("flt4_labels_of_ids", f"with {CURATED_SQL} select repo_id, id, k.name as name, k.type as type from l where repo_id in (select l_partkey from lineitem where l_quantity = 7)")
def labels_of_ids(spark, sf):
    ids = stand_ins.table(spark, sf, "lineitem").filter("l_quantity = 7").select(F.col("l_partkey").alias("id"))
    return labels.of_ids(stand_ins.labels(spark, sf), ids).select(F.col("entity_id").alias("repo_id"), "id", "name", "type")


@query(
    "jn9_curated_lookup",
    "select s_suppkey as repo_id, s_name as name, case when s_suppkey % 3 = 0 then 'by id ' || s_suppkey when s_suppkey % 2 = 0 then 'by name ' || lower(s_name) end as record from supplier",
)
def curated_lookup(spark, sf):
    s = stand_ins.table(spark, sf, "supplier")
    k, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    by_id = s.filter("s_suppkey % 3 = 0").select(F.concat(F.lit("repo:"), k).alias("key"), F.concat(F.lit("by id "), k).alias("record"))
    by_name = s.filter("s_suppkey % 2 = 0").select(F.concat(F.lit("name:"), F.upper(name)).alias("key"), F.concat(F.lit("by name "), F.lower(name)).alias("record"))
    return taxonomy.lookup_curated(s.select(F.col("s_suppkey").alias("repo_id"), name.alias("name")), by_id.unionByName(by_name))


def _label_sql(aliases: dict[str, str], names: list[str], parts: list[tuple[str, str]]) -> str:
    rows = [(taxonomy_text, name) for name, text_ in aliases.items() for taxonomy_text in text_.split(", ")]
    cases = [f"when c = trim(regexp_replace(lower('{n}'), '[^a-z0-9+#.]+', ' ', 'g')) then '{n}'" for n in names]
    cases += [f"when c = '{a}' then '{n}'" for a, n in rows]
    cases += [f"when {'ends_with' if p.endswith('$') else 'contains'}(c, '{p.rstrip('$')}') then '{n}'" for p, n in parts]
    return f"case {' '.join(cases)} end"


#: Every alias, name and part once, with noise around it, dealt over the parts.
_WORDS = [*labels.DOMAINS, *labels.AREAS, *(a for t in (labels.DOMAIN_ALIASES, labels.AREA_ALIASES) for x in t.values() for a in x.split(", ")), *(p.rstrip("$") for p, _ in labels.AREA_PARTS), "nothing of the kind"]
_WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in _WORDS) + "]"


@query(
    "tx5_canonical_labels",
    f"""with w as (select p_partkey, {_WORDS_SQL} as ws from part), l as (select p_partkey, unnest([{{'i': 0, 'x': p_partkey}}, {{'i': 1, 'x': p_partkey // 7}}, {{'i': 2, 'x': p_partkey // 3}}], recursive := true), ws from w),
c as (select p_partkey, i, trim(regexp_replace(lower(' ' || ws[x % len(ws) + 1] || case when x % 5 = 0 then '-x' else '!' end), '[^a-z0-9+#.]+', ' ', 'g')) as c from l),
d as (select p_partkey, i, {_label_sql(labels.DOMAIN_ALIASES, labels.DOMAINS, [])} as d, {_label_sql(labels.AREA_ALIASES, labels.AREAS, labels.AREA_PARTS)} as a from c)
select p_partkey, arg_min(d, i) filter (d is not null) as domain, arg_min(a, i) filter (a is not null) as area from d group by p_partkey""",
)
def canonical_labels(spark, sf):
    k = F.col("p_partkey")
    ws = F.lit(_WORDS)

    def one(x):
        return F.concat(F.lit(" "), F.element_at(ws, (x % len(_WORDS) + 1).cast("int")), F.when(x % 5 == 0, "-x").otherwise("!"))

    held = F.array(one(k), one(F.expr("p_partkey div 7")), one(F.expr("p_partkey div 3")))
    return stand_ins.table(spark, sf, "part").select("p_partkey", held.alias("held")).select("p_partkey", labels.domain_of(F.col("held")).alias("domain"), labels.area_of(F.col("held")).alias("area"))


@query(
    "tx7_library",
    """select p_partkey, case when p_size % 4 = 0 then p_brand when p_type != 'PROMO' then p_type else 'model-hub' end as model, case when p_size % 3 = 0 then lower(p_type) else 'datasets' end as dataset,
  case when p_size % 4 = 0 then p_brand else 'static' end as space from part""",
)
def library(spark, sf):
    named = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(" "), "p_brand")).otherwise(F.lit(" "))
    tags = F.array(F.lit("region:us"), F.lit("pytorch"), F.lit("library:"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("library: "), F.lower("p_type"))).otherwise(F.lit("a:b")), F.col("p_type"))
    return stand_ins.table(spark, sf, "part").select("p_partkey", *(taxonomy.library(kind, named, tags, ["PROMO"]).alias(kind) for kind in ("model", "dataset", "space")))


@query("tx1_builtin_lexicon", f"""with words(category, keyword) as (values {", ".join(f"('{c}', '{w}')" for kind in ("domains", "areas") for c, ws in taxonomy.builtin(kind).items() for w in ws)})
select category, count(*) as n, min(keyword) as first from words group by category""")
def builtin_lexicon(spark, sf):
    both = taxonomy.lexicon(spark, taxonomy.builtin("domains")).unionByName(taxonomy.lexicon(spark, taxonomy.builtin("areas")))
    return both.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("keyword").alias("first"))


# --- Functions -------------------------------------------------------------------------------


def _channel(offset: str) -> str:
    """A colour channel of (h, l, s), all in [0, 1), as hex digits."""
    up = "case when l <= 0.5 then l * (1 + s) else l + s - l * s end"
    h = f"((h + {offset}) - floor(h + {offset}))"
    low = f"(2 * l - ({up}))"
    x = f"case when {h} < 1 / 6.0 then {low} + (({up}) - {low}) * {h} * 6 when {h} < 0.5 then ({up}) when {h} < 2 / 3.0 then {low} + (({up}) - {low}) * (2 / 3.0 - {h}) * 6 else {low} end"
    return f"lpad(lower(hex(cast(round(255 * ({x})) as int))), 2, '0')"


@query(
    "sc10_colours",
    f"""with k as (select c_custkey, cast(0.1 as double) + c_custkey * cast(0.618033988749895 as double) as k from customer), c as (select c_custkey, k - floor(k) as h, cast(0.5 as double) as l, cast(0.6 as double) as s from k)
select c_custkey, round(h, 9) as hue, '#' || {_channel("1 / 3.0")} || {_channel("0.0")} || {_channel("2 / 3.0")} as colour from c""",
)
def colours(spark, sf):
    c = stand_ins.table(spark, sf, "customer").withColumn("h", formulas.golden_hue(F.col("c_custkey"), 0.1))
    return c.select("c_custkey", F.round("h", 9).alias("hue"), formulas.hue_color(F.col("h"), F.lit(0.5), F.lit(0.6)).alias("colour"))


@query(
    "sc12_sc14_tags",
    r"""with c as (select c_custkey, c_mktsegment as m, trim(regexp_replace(lower(c_name), '[^a-z0-9+#.]+', ' ', 'g')) as n from customer)
select c_custkey, contains(' ' || n || ' ', ' customer ') as has, array_to_string(list_sort(list_distinct([lower(m), 'a'])), '|') as stripped, array_to_string(list_filter([m, 'x'], lambda t: t != ''), '|') as trimmed from c""",
)
def tags(spark, sf):
    m = F.col("c_mktsegment")
    held = F.array(F.concat(F.lit("license: "), F.lower(m)), F.lit("license:a"), F.lit("license:"), F.lit("license: "), m, F.lit("license:a "))
    return stand_ins.table(spark, sf, "customer").select(
        "c_custkey", text.has_phrase(text.canonical(F.col("c_name")), F.lit("customer")).alias("has"), F.array_join(text.stripped_tags(held, "license:"), "|").alias("stripped"),
        F.array_join(text.trimmed_tags(F.array(F.concat(F.lit(" "), m), F.lit(" "), m, F.lit("x"), F.lit(""))), "|").alias("trimmed"),
    )


@query(
    "sc16_sc22_numbers",
    """select c_custkey, case when round(c_acctbal / 7, 2) = 0 then '0' else regexp_replace(regexp_replace(format('{:.2f}', round(c_acctbal / 7, 2)), '0+$', ''), '\\.$', '') end as compact,
  round(1.55 * ln(1 + greatest(c_acctbal, 0)) + 0.9 * ln(1 + c_nationkey) + 0.22 * ln(1 + c_custkey), 8) as score from customer""",
)
def numbers(spark, sf):
    c = stand_ins.table(spark, sf, "customer")
    return c.select("c_custkey", formulas.compact(F.col("c_acctbal") / 7, 2).alias("compact"), F.round(formulas.visual_score(F.greatest("c_acctbal", F.lit(0.0)), F.col("c_nationkey"), F.col("c_custkey")), 8).alias("score"))


# --- Layout ----------------------------------------------------------------------------------

_METRICS_SQL = f"""with {POINTS_SQL}, q as (select *, sqrt(x * x + y * y) as r, (atan2(y, x) + pi()) / (2 * pi()) as turn from p),
a as (select quantile_cont(r, 0.5) as p50, quantile_cont(r, 0.95) as p95, greatest(quantile_cont(r, 0.99), 1e-9) as p99, max(r) as top, count(*) as n, corr(ln(1 + rank), r) as c from q),
bins as (select count(distinct (least(7, floor(power(least(0.999999, r / p99), 2) * 8)), least(23, floor(turn * 24)))) / 192 as coverage from q, a),
e as (select t.x - s.x as ex, t.y - s.y as ey, (s.x + t.x) / 2 as mx, (s.y + t.y) / 2 as my from q s join q t on t.node = s.node + 1),
f as (select sqrt(ex * ex + ey * ey) as len, case when sqrt(ex * ex + ey * ey) > 1e-9 and sqrt(mx * mx + my * my) > 0.08 then abs(ex * mx + ey * my) / (sqrt(ex * ex + ey * ey) * sqrt(mx * mx + my * my)) end as along from e),
line as (select quantile_cont(len, 0.5) as length, coalesce(count(*) filter (along >= 0.78) / nullif(count(along), 0), 0) as radial from f),
sec as (select community, least(15, floor(turn * 16)) as sector, count(*) as k, sum(x) as x, sum(y) as y from q group by all),
com as (select community, sum(k) as n, -sum(k * ln(k)) as z, sqrt(power(sum(x), 2) + power(sum(y), 2)) / sum(k) as centre from sec group by community having sum(k) >= 12),
h as (select coalesce(sum((z / n + ln(n)) / ln(16) * n) / sum(n), 0) as entropy, coalesce(quantile_cont(centre, 0.5), 0) as centre from com)
select n as main_nodes, round(p50, 5) as radius_p50, round(p95, 5) as radius_p95, round(top, 5) as radius_max, round(coverage, 4) as polar_coverage, round(length, 5) as backbone_median_length, round(radial, 4) as radial_share,
  round(entropy, 4) as angular_entropy, round(centre, 5) as centroid_radius_median, round(coalesce(c, 0), 4) as rank_radius_correlation from a, bins, line, h"""


@query("gr17_ag18_ag19_ag21_ag23_layout_metrics", _METRICS_SQL)
def layout_metrics(spark, sf):
    pts = stand_ins.points(spark, sf)
    return layout.metrics(pts, pts.select(F.col("node").alias("s"), (F.col("node") + 1).alias("t")))


_FIELD_SQL = f"""with {POINTS_SQL}, b as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, greatest(max(x) - min(x), max(y) - min(y), 0.001) * 1.12 as span from p),
gr as (select (x0 + x1 - span) / 2 as ox, (y0 + y1 - span) / 2 as oy, span / 143 as step from b),
g as (select (x - ox) / step as px, (y - oy) / step as py from p, gr),
c as (select px, py, unnest(range(cast(greatest(0, floor(px) - 4) as bigint), cast(least(143, ceil(px) + 4) as bigint) + 1)) as gx from g), d as (select *, unnest(range(cast(greatest(0, floor(py) - 4) as bigint), cast(least(143, ceil(py) + 4) as bigint) + 1)) as gy from c),
field as (select gx, gy, sum(exp(-((px - gx) ** 2 + (py - gy) ** 2) / 5)) as v from d group by all)"""


@query(
    "gr19_contours",
    f"""{_FIELD_SQL}, pos as (select v, row_number() over (order by v, gx, gy) - 1 as k, count(*) over () as n from field where v > 0.5),
cuts as (select l.level, v as t from pos, (values (0, 0.64), (1, 0.84), (2, 0.95)) l(level, q) where k = floor((n - 1) * q)),
cells as (select x.range as x, y.range as y from range(144) x, range(144) y), f as (select x, y, coalesce(v, 0.0) as v from cells left join field on gx = x and gy = y),
tri as (select unnest([[{{'x': a.x, 'y': a.y, 'v': a.v}}, {{'x': b.x, 'y': b.y, 'v': b.v}}, {{'x': c.x, 'y': c.y, 'v': c.v}}], [{{'x': a.x, 'y': a.y, 'v': a.v}}, {{'x': c.x, 'y': c.y, 'v': c.v}}, {{'x': d.x, 'y': d.y, 'v': d.v}}]]) as q
  from f a join f b on b.x = a.x + 1 and b.y = a.y join f c on c.x = a.x + 1 and c.y = a.y + 1 join f d on d.x = a.x and d.y = a.y + 1),
side as (select level, row_number() over () as id, t, q from tri, cuts), s as (select level, id, t, unnest([0, 1, 2]) as i, q from side),
cut as (select level, id, i, q[i + 1] as a, q[(i + 1) % 3 + 1] as b, t from s where (q[i + 1].v >= t) != (q[(i + 1) % 3 + 1].v >= t)),
pt as (select level, id, i, ox + (a.x + (b.x - a.x) * (t - a.v) / (b.v - a.v)) * step as x, oy + (a.y + (b.y - a.y) * (t - a.v) / (b.v - a.v)) * step as y from cut, gr)
select cast(level as int) as level, round(arg_min(x, i), 6) as x1, round(arg_min(y, i), 6) as y1, round(arg_max(x, i), 6) as x2, round(arg_max(y, i), 6) as y2 from pt group by level, id""",
)
def contours(spark, sf):
    points = stand_ins.points(spark, sf)
    field = layout.materialize(layout.density(points), "field")
    return layout.contours(field, layout.thresholds(field), layout.frame(points)).select("level", *(F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")))
