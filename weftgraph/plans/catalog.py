"""The registered queries over the stand-in sources, each with its SQL where SQL can express it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formulas, months, text
from ..operators import explore, graph, hub, layout, projection, quality, taxonomy
from ..sources import sinks, stand_ins
from .parameters import Parameters, preset
from .tables import materialize

#: A build of the smaller preset over a year of the stand-in sources.
P = preset("preview", stand_ins.PLATFORM, 199712)
TODAY = dt.date(1999, 3, 15)

# A small lexicon of words that the invented texts hold.
SIGNALS = {"Agents & RAG": ["the thing", "src1"], "Vision": ["ation", "src2", "the"], "Audio": ["der", "src3"]}
DOMAINS = {"Database": ["que", "en"], "Big Data": ["les", "fr de"], "Web Frameworks": ["fr", "es"]}
FAMILIES = {"Cloud Native": ["de"], "Application Software": ["en", "fr"]}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql.replace(":top_repos", str(P.top_repos)).replace(":edges", str(P.max_edges_per_node)).replace(":labels", str(P.labels))
        return f

    return put


def with_views(rest: str) -> str:
    return f"with recursive {stand_ins.SQL},\n{rest}"


# SQL of the pipeline's steps, in their order.
MONTHLY = """monthly as (select repo_id, yyyymm, max(openrank) as month_openrank, arg_max(repo_name, (openrank, repo_name)) as repo_name, arg_max(org_login, (openrank, org_login)) as org_login
  from scores where platform = 'TPCH' and type = 'Repo' and yyyymm between 199701 and 199712 and repo_id != 0 group by all),"""
YEARLY = (
    MONTHLY
    + """
yearly as (select repo_id, arg_max(repo_name, (yyyymm, month_openrank, repo_name)) as repo_name, arg_max(org_login, (yyyymm, month_openrank, org_login)) as org_login, sum(month_openrank) as openrank_sum,
  avg(month_openrank) as openrank_avg, max(month_openrank) as openrank_max, cast(count(*) as int) as months_present from monthly group by repo_id),"""
)
LATEST = """latest as (select id, status, isFork as is_fork, primary_language, p_brand, p_type, description from info
  qualify row_number() over (partition by id order by updated_at desc, isFork desc, status desc, primary_language desc, description desc, p_brand desc) = 1),"""
TOP = (
    YEARLY
    + LATEST
    + """
top as (select y.* from yearly y left join latest i on i.id = y.repo_id where i.id is null or is_fork = 0 order by openrank_sum desc, repo_id limit :top_repos),"""
)
DEGREES = """degrees as (select actor_id, count(distinct repo_id) as degree from contributions where yyyymm between 199701 and 199712 and actor_id != 0 group by actor_id having degree between 2 and 30),"""
PAIRS = (
    TOP
    + DEGREES
    + """
am as (select actor_id, repo_id, yyyymm, max(openrank) as v from contributions where yyyymm between 199701 and 199712 and actor_id in (select actor_id from degrees) and repo_id in (select repo_id from top) group by all),
ar as (select actor_id, repo_id, sum(v) as contribution from am group by all having sum(v) > 0),
pairs as (select a.actor_id, a.repo_id as source, b.repo_id as target, a.contribution as source_contribution, b.contribution as target_contribution, 2.0 / (cast(degree as double) * (degree - 1)) as actor_weight
  from ar a join ar b on a.actor_id = b.actor_id and a.repo_id < b.repo_id join degrees d on d.actor_id = a.actor_id),"""
)
EDGES = (
    PAIRS
    + """
edges as (select source, target, round(sum(actor_weight), 8) as weight, count(*) as shared_contributors, round(sum(actor_weight * sqrt(source_contribution * target_contribution)), 6) as collaboration_strength
  from pairs group by all having count(*) >= 2),"""
)
PRUNED = (
    EDGES
    + """
inc as (select source as node, target as neighbor, weight, shared_contributors, collaboration_strength from edges union all select target, source, weight, shared_contributors, collaboration_strength from edges),
rk as (select *, row_number() over (partition by node order by weight desc, shared_contributors desc, neighbor) as r from inc),
pruned as (select least(node, neighbor) as source, greatest(node, neighbor) as target, max(weight) as weight, max(shared_contributors) as shared_contributors, max(collaboration_strength) as collaboration_strength from rk where r <= :edges group by all),"""
)
STATS = """nm as (select repo_id, actor_id, yyyymm, max(openrank) as v, arg_max(repo_name, (openrank, repo_name)) as repo_name from contributions where yyyymm between 199701 and 199712 and actor_id != 0 and repo_id in (select repo_id from top) group by all),
stats as (select repo_id, arg_max(repo_name, (yyyymm, v, repo_name)) as stats_name, count(distinct actor_id) as contributors, sum(v) as normalized_contribution from nm group by repo_id),"""
NODES = (
    PRUNED
    + STATS
    + """
nodes as (select 'TPCH:' || t.repo_id as id, coalesce(nullif(t.repo_name, ''), stats_name, '') as name, 'TPCH' as platform, t.repo_id, round(openrank_sum, 8) as openrank_sum, round(openrank_avg, 8) as openrank_avg, round(openrank_max, 8) as openrank_max,
  months_present, coalesce(contributors, 0) as contributors, round(coalesce(normalized_contribution, 0), 8) as normalized_contribution, coalesce(nullif(primary_language, ''), 'Unknown') as primary_language,
  case when i.id is null then '' else p_brand || '|' || p_type end as topics, coalesce(regexp_replace(substring(description, 1, 300), '[\\r\\n\\t]+', ' ', 'g'), '') as description, case when i.id is null then 'missing' else status end as metadata_status, '' as url
  from top t left join stats s on s.repo_id = t.repo_id left join latest i on i.id = t.repo_id),
ends as (select 'TPCH:' || source as id from pruned union select 'TPCH:' || target from pruned),
kept as (select nodes.*, case when row_number() over (order by openrank_sum desc, repo_id) <= :labels then name else '' end as display_label from nodes where id in (select id from ends)),"""
)
GRAPH = PRUNED + "\ng as (select source as s, target as t, weight, shared_contributors as shared, collaboration_strength as strength from pruned),\nboth_ends as (select s as node, t as other, weight, shared, strength from g union all select t, s, weight, shared, strength from g),"
AFF = "greatest(ln(1 + greatest(weight, 0)) + 0.55 * ln(1 + greatest(strength, 0)), 1e-12)"


class Steps:
    """The pipeline's frames over one input, made when asked for. What several later steps read
    is written once: a year's activity by month, the chosen repositories and the pruned edges."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: Parameters = P):
        self.spark, self.sf_dir, self.p = spark, sf_dir, p

    @cached_property
    def scores(self) -> DataFrame:
        return stand_ins.scores(self.spark, self.sf_dir)

    @cached_property
    def rows(self) -> DataFrame:
        return stand_ins.contributions(self.spark, self.sf_dir)

    @cached_property
    def monthly(self) -> DataFrame:
        return projection.monthly_scores(self.scores, self.p)

    @cached_property
    def yearly(self) -> DataFrame:
        return projection.yearly_scores(self.monthly)

    @cached_property
    def latest(self) -> DataFrame:
        return materialize(projection.latest_info(stand_ins.info(self.spark, self.sf_dir), self.p.platform), "latest")

    @cached_property
    def top(self) -> DataFrame:
        return materialize(projection.top_repos(self.yearly, self.latest, self.p), "top")

    @cached_property
    def activity(self) -> DataFrame:
        return materialize(projection.monthly_contributions(self.rows, self.p), "activity")

    @cached_property
    def degrees(self) -> DataFrame:
        return projection.actor_degrees(self.activity, self.p)

    @cached_property
    def bipartite(self) -> DataFrame:
        return projection.actor_repos(self.activity, self.degrees, self.top)

    @cached_property
    def pairs(self) -> DataFrame:
        return projection.pair_rows(self.bipartite, self.degrees)

    @cached_property
    def edges(self) -> DataFrame:
        return projection.edges(self.pairs, self.p.min_shared, 6)

    @cached_property
    def pruned(self) -> DataFrame:
        return projection.guard_rows(projection.prune(self.edges, self.p.max_edges_per_node), self.p.max_rows)

    @cached_property
    def named(self) -> DataFrame:
        return projection.name_edges(self.pruned, self.p.platform)

    @cached_property
    def nodes(self) -> DataFrame:
        return projection.nodes(self.top, projection.contribution_stats(self.activity, self.top), self.latest, self.p.platform, 8)

    @cached_property
    def kept(self) -> DataFrame:
        return projection.with_labels(self.nodes, self.named, self.p.labels)

    @cached_property
    def g(self) -> DataFrame:
        return self.pruned.select(F.col("source").alias("s"), F.col("target").alias("t"), "weight", F.col("shared_contributors").alias("shared"), F.col("collaboration_strength").alias("strength"))


@query("src4_score_scan", with_views("x as (select repo_id, yyyymm, count(*) as n, round(sum(openrank), 6) as total from scores where yyyymm between 199701 and 199712 and repo_id != 0 group by all) select * from x"))
def score_scan(spark, sf):
    s = stand_ins.scores(spark, sf).filter(months.within(F.col("created_at"), P.start, P.end) & (F.col("repo_id") != 0))
    return s.groupBy("repo_id", months.month_of(F.col("created_at")).alias("yyyymm")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("openrank"), 6).alias("total"))


@query("src5_contribution_scan", with_views("x as (select yyyymm, count(*) as n, count(distinct actor_id) as actors from contributions where yyyymm between 199701 and 199712 and actor_id != 0 group by all) select * from x"))
def contribution_scan(spark, sf):
    return projection.contributions(stand_ins.contributions(spark, sf), P).groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("actor_id").alias("actors"))


@query("src6_ag7_ag8_latest_info", with_views(LATEST + "z as (select 1) select id, status, is_fork, primary_language, p_brand || '|' || p_type as topics, description from latest"))
def latest_info(spark, sf):
    return projection.latest_info(stand_ins.info(spark, sf), P.platform).withColumn("topics", F.array_join("topics", "|"))


@query("src14_distinct_ids", with_views(TOP + "z as (select 1) select distinct repo_id from top"))
def distinct_ids(spark, sf):
    return Steps(spark, sf).top.select("repo_id").distinct().orderBy("repo_id")


@query("ag1_monthly_scores", with_views(MONTHLY + "z as (select 1) select * from monthly"))
def monthly(spark, sf):
    return Steps(spark, sf).monthly


@query("ag3_ag4_yearly_scores", with_views(YEARLY + "z as (select 1) select * replace (round(openrank_sum, 6) as openrank_sum, round(openrank_avg, 8) as openrank_avg) from yearly"))
def yearly(spark, sf):
    return Steps(spark, sf).yearly.withColumns({"openrank_sum": F.round("openrank_sum", 6), "openrank_avg": F.round("openrank_avg", 8)})


@query("tk1_jn1_top_repos", with_views(TOP + "z as (select 1) select repo_id, repo_name, round(openrank_sum, 6) as openrank_sum from top"))
def top_repos(spark, sf):
    return Steps(spark, sf).top.select("repo_id", "repo_name", F.round("openrank_sum", 6).alias("openrank_sum"))


@query("ag5_actor_degrees", with_views(DEGREES + "z as (select 1) select * from degrees"))
def degrees(spark, sf):
    return Steps(spark, sf).degrees


@query("ag2_flt3_actor_repos", with_views(PAIRS + "z as (select 1) select actor_id, repo_id, round(contribution, 6) as contribution from ar"))
def actor_repos(spark, sf):
    return Steps(spark, sf).bipartite.withColumn("contribution", F.round("contribution", 6))


@query("gr1_jn5_pair_rows", with_views(PAIRS + "z as (select 1) select actor_id, source, target, round(source_contribution, 6) as source_contribution, round(target_contribution, 6) as target_contribution, actor_weight from pairs"))
def pair_rows(spark, sf):
    return Steps(spark, sf).pairs.withColumns({c: F.round(c, 6) for c in ("source_contribution", "target_contribution")})


@query("ag10_edges", with_views(EDGES + "z as (select 1) select * from edges"))
def all_edges(spark, sf):
    return Steps(spark, sf).edges


@query("jn6_wn1_incident_ranks", with_views(PRUNED + "z as (select 1) select node, neighbor, r as edge_rank from rk where r <= :edges"))
def ranks(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("node").orderBy(F.desc("weight"), F.desc("shared_contributors"), "neighbor")
    return projection.incident(Steps(spark, sf).edges).withColumn("edge_rank", F.row_number().over(w)).filter(F.col("edge_rank") <= P.max_edges_per_node).select("node", "neighbor", "edge_rank")


@query("gr2_ag11_st1_pruned_edges", with_views(PRUNED + "z as (select 1) select 'TPCH:' || source as source, 'TPCH:' || target as target, weight, shared_contributors, collaboration_strength from pruned"))
def pruned(spark, sf):
    return Steps(spark, sf).named


@query("jn3_node_candidates", with_views(NODES + "z as (select 1) select * from nodes"))
def nodes(spark, sf):
    return Steps(spark, sf).nodes


@query("flt8_wn5_labelled_nodes", with_views(NODES + "z as (select 1) select id, name, display_label, openrank_sum from kept"))
def labelled(spark, sf):
    return Steps(spark, sf).kept.select("id", "name", "display_label", "openrank_sum")


@query("ag12_month_list", with_views("x as (select array_to_string(list_sort(list(distinct cast(yyyymm as varchar))), ',') as months from scores) select * from x"))
def month_list(spark, sf):
    return quality.month_list(stand_ins.scores(spark, sf))


@query("ag15_qa1_freshness", with_views("x as (select (select max(yyyymm) from contributions) as contributions_latest, (select max(yyyymm) from scores) as scores_latest, 199902 as previous_complete) select *, least(contributions_latest, scores_latest, previous_complete) as usable from x"))
def freshness(spark, sf):
    return quality.freshness(stand_ins.scores(spark, sf), stand_ins.contributions(spark, sf), P.platform, TODAY)


@query("st3_qa2_missing_months", with_views("w as (select year(d) * 100 + month(d) as yyyymm from (select unnest(generate_series(date '2000-06-01', date '2002-05-01', interval 1 month)) as d)) select 'scores' as source, yyyymm from w where yyyymm not in (select yyyymm from scores) union all select 'contributions', yyyymm from w where yyyymm not in (select yyyymm from contributions)"))
def missing_months(spark, sf):
    p = Parameters(P.platform, 200006, 200205, 1, 1, 2, 1, 1, 1)
    return quality.missing_months(stand_ins.scores(spark, sf), stand_ins.contributions(spark, sf), p)


@query(
    "ag16_ag6_qa3_uniqueness",
    with_views(
        TOP
        + """a as (select count(*) as n, count(distinct openrank) as v from scores where yyyymm between 199701 and 199712 and repo_id in (select repo_id from top) group by repo_id, yyyymm),
b as (select count(*) as n, count(distinct openrank) as v from contributions where yyyymm between 199701 and 199712 and repo_id in (select repo_id from top) group by repo_id, actor_id, yyyymm)
select 'scores' as source, cast(sum(n) as bigint) as n_rows, count(*) as n_keys, count(*) filter (v > 1) as n_conflicts from a union all select 'contributions', cast(sum(n) as bigint), count(*), count(*) filter (v > 1) from b"""
    ),
)
def uniqueness(spark, sf):
    s = Steps(spark, sf)
    return quality.source_uniqueness(s.scores, s.rows, s.top, P)


@query(
    "ag17_ag29_qa4_edge_counters",
    with_views(
        PRUNED
        + """z as (select 1) select count(*) as n_edges, count(*) filter (source = target) as self_loops, count(*) filter (source > target) as misordered, count(*) filter (weight <= 0) as not_positive, count(*) filter (shared_contributors < 2) as too_few_shared,
  cast(0 as bigint) as duplicates, cast(0 as bigint) as bad_ids, cast(0 as bigint) as not_finite, quantile_disc(weight, 0.5) as weight_p50, quantile_disc(weight, 0.9) as weight_p90, quantile_disc(weight, 0.99) as weight_p99, min(weight) as weight_min, max(weight) as weight_max,
  quantile_disc(shared_contributors, 0.5) as shared_p50, quantile_disc(shared_contributors, 0.9) as shared_p90, quantile_disc(shared_contributors, 0.99) as shared_p99, max(shared_contributors) as shared_max from pruned"""
    ),
)
def edge_counters(spark, sf):
    return quality.edge_counters(Steps(spark, sf).named, P.platform, P.min_shared)


@query(
    "ag30_jn8_st4_qa5_node_counters",
    with_views(
        NODES
        + """z as (select 1) select count(*) as n_nodes, count(*) - count(distinct id) as duplicates, cast(0 as bigint) as bad_identity, cast(0 as bigint) as bad_numbers, cast(0 as bigint) as bad_months, count(*) filter (metadata_status = 'missing') as no_metadata,
  round(count(*) filter (primary_language != 'Unknown') / count(*), 6) as language_share, round(count(*) filter (topics != '') / count(*), 6) as topics_share, round(count(*) filter (description != '') / count(*), 6) as description_share,
  round(max(abs(openrank_sum - openrank_avg * months_present) / greatest(openrank_sum, 1e-9)), 6) as sum_error_max, false as too_many_labels, (select count(*) from ends where id not in (select id from kept)) as ends_without_node, count(*) filter (id not in (select id from ends)) as nodes_without_edge from kept"""
    ),
)
def node_counters(spark, sf):
    s = Steps(spark, sf)
    return quality.node_counters(s.kept, s.named, P.labels)


CURATED_SQL = """l as (select p_partkey as repo_id, case when p_size % 3 = 0 then ':technology/ai/' else ':technology/' end || p_brand as id, unnest([{'type': 'Tech-0', 'name': p_brand}, {'type': 'Domain-0', 'name': p_type}]) as k from part),
c as (select repo_id, list_sort(list(distinct k.name) filter (k.type = 'Tech-0')) as t, list_sort(list(distinct k.name) filter (k.type = 'Domain-0')) as d, list_sort(list(distinct k.name) filter (starts_with(id, ':technology/ai'))) as a,
  coalesce(bool_or(contains(lower(k.name), 'agent') and starts_with(id, ':technology/ai')), false) as is_agentic from l group by repo_id)"""


@query("src7_ag13_ag14_curated_labels", f"with {CURATED_SQL} select repo_id, array_to_string(t, '|') as tech0_labels, array_to_string(d, '|') as domain0_labels, coalesce(array_to_string(a, '|'), '') as ai_labels, is_agentic from c")
def curated(spark, sf):
    c = taxonomy.curated(stand_ins.labels(spark, sf))
    return c.withColumns({n: F.array_join(n, "|") for n in ("tech0_labels", "domain0_labels", "ai_labels")})


# --- Graph ------------------------------------------------------------------------


@query("ag24_degrees", with_views(GRAPH + f"z as (select 1) select node, count(*) as degree, round(sum(weight), 6) as weighted_degree, round(sum(strength), 6) as strength, round(sum({AFF}), 6) as volume from both_ends group by node"))
def graph_degrees(spark, sf):
    d = graph.degrees(Steps(spark, sf).g)
    return d.select("node", "degree", F.round("weighted_degree", 6).alias("weighted_degree"), F.round("strength", 6).alias("strength"), F.round("volume", 6).alias("volume"))


@query("gr6_components")
def components(spark, sf):
    """Of customers and suppliers over all lines. A recursive SQL of it does not end in time; a test compares it with brute force."""
    li, o = stand_ins.table(spark, sf, "lineitem"), stand_ins.table(spark, sf, "orders")
    e = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("s"), (F.col("l_suppkey") + 1_000_000_000).alias("t")).distinct()
    return graph.components(e.select(F.explode(F.array("s", "t")).alias("node")).distinct(), e)


COMPONENTS_SQL = """nb as (select distinct node as x, other as y from both_ends), reach as (select distinct x as node, x as m from nb union select reach.node, nb.y from reach join nb on nb.x = reach.m),
comp as (select node, min(m) as component from reach group by node),"""


@query("gr6_graph_components", with_views(GRAPH + COMPONENTS_SQL + "sz as (select component, count(*) as size from comp group by component), pl as (select *, row_number() over (order by size desc, component) - 1 as place from sz) select node, component, size, place from comp join pl using (component)"))
def graph_components(spark, sf):
    g = Steps(spark, sf).g
    return graph.components(g.select(F.explode(F.array("s", "t")).alias("node")).distinct(), g)


# An edge is in the forest unless better edges alone join its ends.
FOREST_SQL = """ranked as (select s, t, row_number() over (order by weight desc, strength desc, shared desc, s, t) as r from g),
rb as (select s as x, t as y, r from ranked union all select t, s, r from ranked),
reach as (select r, s as x from ranked union select reach.r, rb.y from reach join rb on rb.x = reach.x and rb.r < reach.r),
forest as (select s, t from ranked e where not exists (select 1 from reach where reach.r = e.r and reach.x = e.t)),"""


@query("gr7_spanning_forest", with_views(GRAPH + FOREST_SQL + "z as (select 1) select s, t from forest"))
def forest(spark, sf):
    return graph.spanning_forest(Steps(spark, sf).g)


@query("wn2_strongest_of_node", with_views(GRAPH + "x as (select least(node, other) as s, greatest(node, other) as t, row_number() over (partition by node order by weight desc, strength desc, shared desc, least(node, other), greatest(node, other)) as r from both_ends) select distinct s, t from x where r <= 2"))
def strongest_of_node(spark, sf):
    return graph.strongest_of_node(Steps(spark, sf).g)


BACKBONE_SQL = """own as (select least(node, other) as s, greatest(node, other) as t, row_number() over (partition by node order by weight desc, strength desc, shared desc, least(node, other), greatest(node, other)) as r from both_ends)"""


@query("gr8_st2_tk3_backbone", with_views(GRAPH + FOREST_SQL + BACKBONE_SQL + " select s, t from forest union select s, t from own where r <= 2 union select s, t from ranked where r <= 1500"))
def backbone(spark, sf):
    return graph.backbone(Steps(spark, sf).g)


# Numbers fall to the h-index of the neighbours' until all stand still; far fewer rounds are enough here.
CORES_SQL = """nb as (select distinct node, other from both_ends),
h as (select 0 as i, node, count(*) as core from nb group by node
  union all select i, node, max(least(v, k)) from (select i + 1 as i, nb.node, h.core as v, row_number() over (partition by nb.node order by h.core desc) as k from h join nb on nb.other = h.node where i < 60) group by i, node)"""


@query("gr9_core_numbers", with_views(GRAPH + CORES_SQL + " select node, cast(core as int) as core from h where i = 60"))
def cores(spark, sf):
    return graph.core_numbers(Steps(spark, sf).g)


def _communities(spark, sf):
    steps = Steps(spark, sf)
    g = steps.g
    labels = materialize(graph.communities(g, prefix=f"{P.platform}:"), "communities")
    rank = steps.yearly.select(F.col("repo_id").alias("node"), F.col("openrank_sum").alias("rank"))
    return g, graph.renumber(labels, rank), rank


@query("gr3_gr4_gr5_communities")
def communities(spark, sf):
    return _communities(spark, sf)[1]


@query("gr3_synchronous_communities")
def synchronous(spark, sf):
    return graph.propagate(Steps(spark, sf).g)


NATION = "c as (select s_suppkey as node, s_nationkey as community from supplier)"


@query("jn12_community_affinity", with_views(GRAPH + NATION + f" select least(x.community, y.community) as a, greatest(x.community, y.community) as b, round(sum({AFF}), 6) as affinity from g join c x on x.node = s join c y on y.node = t where x.community != y.community group by all"))
def community_affinity(spark, sf):
    c = stand_ins.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("community"))
    return graph.affinities(Steps(spark, sf).g, c).withColumn("affinity", F.round("affinity", 6))


@query("gr13_split_edges", with_views(GRAPH + NATION + " select s, t, x.community as c_s, y.community as c_t, x.community = y.community as inside from g join c x on x.node = s join c y on y.node = t"))
def split_edges(spark, sf):
    c = stand_ins.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("community"))
    return graph.split_edges(Steps(spark, sf).g, c).select("s", "t", "c_s", "c_t", "inside")


@query("gr10_gr14_island_layout")
def islands(spark, sf):
    g, com, rank = _communities(spark, sf)
    sizes = com.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    near = graph.affinities(g, com)
    # No more communities than nodes, and no more of those than a build has repositories.
    small, pulls = sizes.toPandas(), near.toPandas()
    macro = graph.macros(small, pulls, int(small["size"].sum()))
    named = spark.createDataFrame(sorted(macro.items()), "community int, macro int")
    small["macro"] = small["community"].map(macro)
    between = pulls.assign(a=pulls["a"].map(macro), b=pulls["b"].map(macro))
    between = between[between["a"] != between["b"]].groupby(["a", "b"], as_index=False)["affinity"].sum()
    discs = spark.createDataFrame(layout.place_macros(small.groupby("macro", as_index=False)["size"].sum(), between))
    ends_ = graph.degrees(g).select("node", "degree")
    parts = graph.components(ends_.select("node"), g).select("node", F.col("place").alias("component"))
    nodes = com.join(named, "community").join(rank, "node", "left").join(ends_, "node").join(parts, "node").withColumn("rank", F.coalesce("rank", F.lit(0.0)))
    spine = g.join(graph.backbone(g), ["s", "t"], "left_semi")
    return layout.islands(materialize(nodes, "nodes"), discs, spine)


# --- Hub ---------------------------------------------------------------------------

ITEMS_SQL = """items as (
  select 'model:c' || c_custkey as key, 'c' || c_custkey as id, 'model' as type, n_name as author, c_mktsegment as task, substring(c_mktsegment, 1, 1) as domain, greatest(c_acctbal, 0.1) as rank, c_custkey as k from customer join nation on c_nationkey = n_nationkey
  union all select 'dataset:p' || p_partkey, 'p' || p_partkey, 'dataset', p_brand, p_type, substring(p_type, 1, 1), p_retailprice, p_partkey from part
  union all select 'space:s' || s_suppkey, 's' || s_suppkey, 'space', n_name, 'app', 'a', greatest(s_acctbal, 0.1), s_suppkey from supplier join nation on s_nationkey = n_nationkey),
named as (
  select key as a, 'model:c' || (k // 3) as b, 9.0 + case when k % 2 = 0 then 1.0 else 0.5 end as weight, 'base-model' as kind, 0 as inferred, 0 as ord, 100 as p from items where type = 'model'
  union all select key, 'dataset:p' || (k % 97 + 1), 7.5, 'declared-dataset', 0, 0, 95 from items where type = 'model'
  union all select key, 'model:c' || (k % 101 + 1), 8.0, 'uses-model', 0, 0, 90 from items where type = 'space' union all select key, 'model:c' || (k % 11 + 1), 8.0, 'uses-model', 0, 1, 90 from items where type = 'space'
  union all select key, 'dataset:p' || (k % 89 + 1), 7.7, 'uses-dataset', 0, 0, 89 from items where type = 'space' union all select key, 'dataset:p' || (k % 13 + 1), 7.7, 'uses-dataset', 0, 1, 89 from items where type = 'space'),
seen as (select * from named where b in (select key from items)),
hubs as (select author, arg_min(key, (-rank, id)) as hub from items group by author),
stars as (select hub as a, key as b, 4.2 as weight, 'same-author' as kind, 0 as inferred, 0 as ord, 75 as p from items join hubs using (author) where key != hub),
ch as (select key as a, lead(key) over (partition by task order by cast('0x' || substr(md5('hf-task:' || task || ':' || id), 1, 13) as bigint), id) as b from items),
reps as (select domain, task, arg_min(key, (-rank, id)) as key, arg_min(rank, (-rank, id)) as rank, arg_min(id, (-rank, id)) as id from items group by all),
heads as (select domain, arg_min(key, (-rank, id)) as head from reps group by domain),
dc as (select head as a, lead(head) over (order by domain) as b from heads),
alle as (select * from seen union all select * from stars union all select a, b, 1.35, 'inferred-task', 1, 0, 20 from ch where b is not null union all select head, key, 0.72, 'inferred-task', 1, 1, 20 from reps join heads using (domain) where key != head
  union all select a, b, 0.28, 'inferred-taxonomy', 1, 0, 10 from dc where b is not null),
c as (select least(a, b) as s, greatest(a, b) as t, weight, kind, inferred, a, ord, p from alle where a != b),
w as (select *, row_number() over (partition by s, t order by p desc, weight desc, a, ord) as r from c),
best as (select * from w where r = 1),
res as (select x.s, x.t, x.weight, x.kind, x.inferred, (select 1 + count(*) from c y where y.s = x.s and y.t = x.t and y.p = x.p and y.kind = x.kind and (y.a > x.a or y.a = x.a and y.ord > x.ord)) as shared from best x)"""


@query("gr11_gr12_jn10_wn3_wn4_st5_hub_edges", f"with {ITEMS_SQL} select s, t, cast(weight as double) as weight, kind, inferred, shared from res")
def hub_edges(spark, sf):
    return hub.build(stand_ins.hub_items(spark, sf), formulas.md5_unit)


@query("ag26_hub_kinds", f"with {ITEMS_SQL} select kind, count(*) as n, cast(sum(inferred) as bigint) as inferred from res group by kind")
def hub_kinds(spark, sf):
    return hub.kind_counts(hub.build(stand_ins.hub_items(spark, sf), formulas.md5_unit))


@query("jn11_ag20_space_tasks", f"""with {ITEMS_SQL}, l as (select distinct id, r from (select id, unnest(['c' || (k % 101 + 1), 'c' || (k % 11 + 1), 'p' || (k % 89 + 1), 'p' || (k % 13 + 1)]) as r from items where type = 'space')),
n as (select l.id, i.task, count(*) as n from l join items i on i.id = l.r and i.type != 'space' group by all) select id, arg_min(task, (-n, task)) as task from n group by id""")
def space_tasks(spark, sf):
    items = stand_ins.hub_items(spark, sf)
    return hub.space_tasks(items.filter("type = 'space'"), items)


# --- Taxonomy ------------------------------------------------------------------------


def _lexicon_sql(words: dict[str, list[str]], name: str) -> str:
    rows = ", ".join(f"('{c.replace(chr(39), chr(39) * 2)}', {i}, '{w}')" for i, (c, ws) in enumerate(words.items()) for w in ws)
    return f"""{name}_lex(category, place, keyword) as (values {rows}),
{name}_ev as (select id, category, place, keyword,
    greatest(case when src = keyword or lang = keyword then 4.6 else 0 end, case when contains(' ' || src || ' ', ' ' || keyword || ' ') or contains(' ' || lang || ' ', ' ' || keyword || ' ') then 3.1 else 0 end) as tp,
    case when contains(' ' || d || ' ', ' ' || keyword || ' ') then case when length(keyword) > 2 then 1.15 else 0.9 end else 0 end as pr from t, {name}_lex),
{name}_hit as (select *, tp + pr as score from {name}_ev where tp + pr > 0),
{name}_cat as (select id, category, place, round(sum(score), 6) as score, list(keyword order by score desc, keyword) as tags, array_to_string(list_filter([case when bool_or(pr > 0) then 'description' end, case when bool_or(tp > 0) then 'topics' end], lambda x: x is not null), '+') as sources from {name}_hit group by all),
{name}_best as (select * from {name}_cat qualify row_number() over (partition by id order by score desc, place) = 1)"""


TEXTS_SQL = "t as (select doc_id as id, source as src, lang, trim(regexp_replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[^a-z0-9+#.]+', ' ', 'g')) as d from documents)"
SIGNAL_SQL = f"""{TEXTS_SQL}, {_lexicon_sql(SIGNALS, 'ai')},
ai_tags as (select id, list(keyword order by score desc, keyword)[1:6] as tags, array_to_string(list_filter([case when bool_or(pr > 0) then 'description' end, case when bool_or(tp > 0) then 'topics' end], lambda x: x is not null), '+') as sources from (select id, keyword, max(score) as score, max(pr) as pr, max(tp) as tp from ai_hit group by all) group by id),
sig as (select t.id, lang, coalesce(b.score >= 0.9, false) as is_signal, case when b.score >= 0.9 then category else 'Non-AI' end as p, case when b.score >= 0.9 then a.tags else [] end as tags,
  'tech0-ai-lexicon-v1:' || case when b.score >= 0.9 then a.sources else 'no-signal' end as source, case when b.score >= 0.9 then round(least(0.99, 0.57 + 0.45 * b.score / (b.score + 7)), 2) else 0.58 end as confidence
  from t left join ai_best b on b.id = t.id left join ai_tags a on a.id = t.id)"""


@query("tx1_tx2_evidence", f"with {TEXTS_SQL}, {_lexicon_sql(SIGNALS, 'ai')} select id, category, place, keyword, round(cast(score as double), 6) as score, tp > 0 as in_topics, pr > 0 as in_description from ai_hit")
def evidence(spark, sf):
    return taxonomy.evidence(stand_ins.texts(spark, sf), taxonomy.lexicon(spark, SIGNALS)).withColumn("score", F.round("score", 6))


@query("tx3_ai_class", f"with {SIGNAL_SQL} select id, is_signal, p as primary, array_to_string(tags, '|') as tags, source, cast(confidence as double) as confidence from sig")
def ai_class(spark, sf):
    return taxonomy.classify_signal(stand_ins.texts(spark, sf), taxonomy.lexicon(spark, SIGNALS)).withColumn("tags", F.array_join("tags", "|"))


@query(
    "tx4_domain_class",
    f"""with {SIGNAL_SQL}, {_lexicon_sql(DOMAINS, 'dom')}
select s.id, case when is_signal then case when p = 'Agents & RAG' then 'Agentic AI' else 'AI' end when b.id is not null then category when lang = 'de' then 'Cloud Native' when lang in ('en', 'fr') then 'Application Software' else 'Development Tools' end as primary,
  array_to_string(case when is_signal then s.tags when b.id is not null then b.tags[1:6] else [lang] end, '|') as tags, case when is_signal then replace(source, 'tech0-ai', 'tech0-domain') when b.id is not null then 'tech0-domain-lexicon-v1:' || sources else 'tech0-domain-lexicon-v1:primary_language-fallback' end as source,
  cast(case when is_signal then confidence when b.id is not null then round(least(0.99, 0.52 + 0.45 * score / (score + 7)), 2) else 0.24 end as double) as confidence
from sig s left join dom_best b on b.id = s.id""",
)
def domain_class(spark, sf):
    docs = stand_ins.texts(spark, sf)
    return taxonomy.classify_domain(docs, taxonomy.lexicon(spark, SIGNALS), taxonomy.lexicon(spark, DOMAINS), FAMILIES, "Development Tools").withColumn("tags", F.array_join("tags", "|"))


@query(
    "tx6_curated_override",
    f"""with {CURATED_SQL} select p_partkey as id, case when is_agentic then 'Agentic AI' when len(coalesce(a, [])) > 0 then 'AI' when len(coalesce(d, [])) > 0 then d[1] else 'rule' end as primary,
  case when is_agentic or len(coalesce(a, [])) > 0 or len(coalesce(d, [])) > 0 then 'curated' else 'none' end as source from part left join c on repo_id = p_partkey""",
)
def override(spark, sf):
    empty = F.array().cast("array<string>")
    base = stand_ins.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.lit("rule").alias("primary"), empty.alias("tags"), F.lit("none").alias("source"), F.lit(0.5).alias("confidence"))
    return taxonomy.override(base, taxonomy.curated(stand_ins.labels(spark, sf))).select("id", "primary", "source")


AREAS_SQL = "areas as (select doc_id as id, n_chars as rank, 'language' as facet, lang as value from documents union all select doc_id, n_chars, 'source', source from documents)"


def _areas(spark, sf):
    d = stand_ins.table(spark, sf, "documents")
    facets = F.explode(F.array(F.struct(F.lit("language").alias("facet"), F.col("lang").alias("value")), F.struct(F.lit("source").alias("facet"), F.col("source").alias("value"))))
    return d.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("rank"), facets.alias("f")).select("id", "rank", "f.*")


@query("ag25_facet_counts", f"with {AREAS_SQL} select facet, value, count(*) as n, arg_max(id, (rank, -id)) as representative from areas group by all")
def facet_counts(spark, sf):
    return taxonomy.facet_counts(_areas(spark, sf))


# --- Layout -------------------------------------------------------------------------

POINTS_SQL = "p as (select c_custkey as node, (c_custkey * 7919 % 1009) / 1009.0 - 0.5 as x, (c_custkey * 104729 % 1013) / 1013.0 - 0.5 as y, c_nationkey as community, greatest(c_acctbal, 0.0) as rank from customer)"


@query(
    "gr18_ag22_ellipses",
    f"""with {POINTS_SQL}, m as (select community, avg(x) as cx, avg(y) as cy, var_pop(x) as vx, var_pop(y) as vy, covar_pop(x, y) as c from p group by community),
q as (select community, quantile_cont(sqrt((x - cx) ** 2 + (y - cy) ** 2), 0.92) as q from p join m using (community) group by community),
d as (select *, sqrt(greatest(0, (vx - vy) ** 2 + 4 * c * c)) as disc from m join q using (community)), e as (select *, greatest((vx + vy + disc) / 2, 1e-8) as major from d)
select community, round(cx, 5) as x, round(cy, 5) as y, round(greatest(0.025, q * 1.08), 5) as radius, round(0.5 * atan2(2 * c, vx - vy), 5) as angle, round(greatest(1.05, least(2.35, sqrt(major / greatest((vx + vy - disc) / 2, major * 0.12)))), 4) as aspect from e""",
)
def ellipses(spark, sf):
    return layout.ellipses(stand_ins.points(spark, sf))


@query("ag28_bounds", f"with {POINTS_SQL} select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from p")
def bounds(spark, sf):
    return stand_ins.points(spark, sf).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


@query(
    "gr19_density",
    f"""with {POINTS_SQL}, b as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, greatest(max(x) - min(x), max(y) - min(y), 0.001) * 1.12 as span from p),
g as (select (x - (x0 + x1 - span) / 2) / (span / 143) as px, (y - (y0 + y1 - span) / 2) / (span / 143) as py from p, b),
c as (select px, py, unnest(range(cast(greatest(0, floor(px) - 4) as bigint), cast(least(143, ceil(px) + 4) as bigint) + 1)) as gx from g), d as (select *, unnest(range(cast(greatest(0, floor(py) - 4) as bigint), cast(least(143, ceil(py) + 4) as bigint) + 1)) as gy from c)
select cast(gx as int) as gx, cast(gy as int) as gy, round(sum(exp(-((px - gx) ** 2 + (py - gy) ** 2) / 5)), 6) as value from d group by all""",
)
def density(spark, sf):
    return layout.density(stand_ins.points(spark, sf)).withColumn("value", F.round("value", 6))


# --- Interactive ----------------------------------------------------------------------


@query("ui1_tk7_search", with_views(NODES + "z as (select 1) select id, name from kept where contains(lower(concat_ws(' ', name, primary_language, topics)), 'sta') order by case when starts_with(lower(name), 'sta') then 0 else 1 end, openrank_sum desc, id limit 7"))
def search(spark, sf):
    return explore.search(Steps(spark, sf).kept.withColumn("rank", F.col("openrank_sum")), "STA", ["name", "primary_language", "topics"]).select("id", "name")


@query("ui2_facet_values", f"with {AREAS_SQL} select value, count(*) as n from areas where facet = 'language' and value != 'Non-AI' group by value")
def facet_values(spark, sf):
    return explore.facet_values(_areas(spark, sf), "language")


@query("ui3_tk4_visible_edges", with_views(GRAPH + "z as (select 1) select s, t from g where strength >= 0.5 order by strength desc, weight desc, shared desc, s, t limit 7500"))
def visible(spark, sf):
    return explore.visible(Steps(spark, sf).g.withColumn("b", F.lit(0)), "signal", 0.5).select("s", "t")


@query("ui4_jn13_ego", with_views(GRAPH + "m as (select min(node) as m from both_ends), n as (select other as x from both_ends, m where node = m union select m from m) select s, t from g where s in (select x from n) and t in (select x from n)"))
def ego(spark, sf):
    g = Steps(spark, sf).g
    first = g.agg(F.min(F.least("s", "t"))).first()[0]
    return explore.ego(g, first).select("s", "t")


@query("ui5_strongest_pair", with_views(GRAPH + "z as (select 1) select s, t, strength from g order by strength desc, weight desc, shared desc, s, t limit 1"))
def strongest_pair(spark, sf):
    return explore.strongest_pair(Steps(spark, sf).g).select("s", "t", "strength")


@query("ui6_viewport", f"with {POINTS_SQL} select count(*) filter (x between -0.2 and 0.2 and y between -0.1 and 0.3) as n from p")
def viewport(spark, sf):
    return explore.in_view(stand_ins.points(spark, sf), -0.2, 0.2, -0.1, 0.3)


@query("ui6_nearest_node", f"with {POINTS_SQL}, d as (select node, sqrt((x - 0.1) ** 2 + (y - 0.1) ** 2) as d from p) select node, round(d, 9) as d from d where d <= 0.2 order by d.d, node limit 1")
def nearest(spark, sf):
    return explore.nearest(stand_ins.points(spark, sf), 0.1, 0.1, 0.2)


@query("ui8_dominant_facet", "with n as (select c_nationkey as community, c_mktsegment as value, count(*) as n from customer group by all) select community, arg_min(value, (-n, value)) as value from n group by community")
def dominant(spark, sf):
    return explore.dominant(stand_ins.table(spark, sf, "customer").select(F.col("c_nationkey").alias("community"), F.col("c_mktsegment").alias("value")))


@query("wn7_tiers", f"with {POINTS_SQL}, r as (select node, row_number() over (order by rank desc, node) as k, count(*) over () as n from p) select node, case when k <= greatest(1, ceil(n * 0.01)) then 'landmark' when k <= greatest(1, ceil(n * 0.10)) then 'core' else 'star' end as tier from r")
def tiers(spark, sf):
    return explore.tiers(stand_ins.points(spark, sf), "rank").select("node", "tier")


# --- Scalars and sinks ----------------------------------------------------------------


@query(
    "sc_scalars",
    """select c_custkey, round(ln(1 + greatest(c_acctbal, 0)) + 0.55 * ln(1 + c_nationkey), 8) as affinity, round(greatest(ln(1 + greatest(c_acctbal, 0)) + 1.65 * ln(1 + c_nationkey) + 1.9 * ln(2) + 0.3, 0.1), 8) as importance,
  round(least(0.99, 0.52 + 0.45 * c_nationkey / (c_nationkey + 7.0)), 2) as confidence, greatest(c_acctbal, 0.0) as finite, trim(regexp_replace(lower(c_name || '/' || c_mktsegment), '[^a-z0-9+#.]+', ' ', 'g')) as canonical,
  case when length(c_name || ' ' || c_mktsegment) > 20 then rtrim(substring(c_name || ' ' || c_mktsegment, 1, 19)) || '…' else c_name || ' ' || c_mktsegment end as clipped,
  c_name as owner, replace(replace(c_name || '<&>', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;') as xml,
  cast('0x' || substr(md5(c_name), 1, 13) as bigint) / 4503599627370496.0 as unit, cast((199700 // 100 * 12 + c_nationkey - 1) // 12 * 100 + (c_nationkey - 1 + 12 * 0 + 12) % 12 + 1 as int) as shifted from customer""",
)
def scalars(spark, sf):
    c = stand_ins.table(spark, sf, "customer")
    k = F.col("c_nationkey")
    return c.select(
        "c_custkey", F.round(formulas.affinity(F.col("c_acctbal"), k.cast("double")), 8).alias("affinity"), F.round(formulas.importance(formulas.finite(F.col("c_acctbal")), k, F.lit(1), F.lit(0.3)), 8).alias("importance"),
        formulas.confidence(k.cast("double"), 0.52).alias("confidence"), formulas.finite(F.col("c_acctbal")).alias("finite"), text.canonical(F.concat_ws("/", "c_name", "c_mktsegment")).alias("canonical"),
        text.clip(F.concat_ws(" ", "c_name", "c_mktsegment"), 20).alias("clipped"), text.owner(F.concat_ws("/", "c_name", "c_mktsegment")).alias("owner"), text.xml(F.concat("c_name", F.lit("<&>"))).alias("xml"),
        formulas.md5_unit(F.col("c_name")).alias("unit"), months.shifted(F.lit(199701), k - 1).alias("shifted"),
    )


RULES = [("auto", "Vehicles"), ("mach", "Industry"), ("house", "Home"), ("b", "Building")]


@query("tx8_task_domain", "select c_custkey, case when contains(lower(c_mktsegment), 'auto') then 'Vehicles' when contains(lower(c_mktsegment), 'mach') then 'Industry' when contains(lower(c_mktsegment), 'house') then 'Home' when contains(lower(c_mktsegment), 'b') then 'Building' else 'Other' end as domain from customer")
def task_domain(spark, sf):
    return stand_ins.table(spark, sf, "customer").select("c_custkey", taxonomy.by_rules(F.col("c_mktsegment"), RULES, "Other").alias("domain"))


@query("tx7_tk6_tag_selection", "select p_partkey, case when p_type = 'PROMO' then 'PROMO' when p_brand = 'Brand#7' then 'Brand#7' else 'none' end as task, case when p_type = 'STANDARD' then p_brand else p_brand || '|' || p_type end as topics from part")
def tag_selection(spark, sf):
    tags = F.array(F.concat(F.lit("license:"), "p_type"), F.col("p_brand"), F.col("p_type"), F.col("p_brand"))
    topics = F.array_join(taxonomy.topic_selection(tags, ["STANDARD"]), "|")
    return stand_ins.table(spark, sf, "part").select("p_partkey", taxonomy.first_of(tags, ["PROMO", "Brand#7"], "none").alias("task"), topics.alias("topics"))


@query("sc18_card_fill", "select event_id, cast(json_extract_string(props, '$.k') as varchar) as k, event_type from events")
def card_fill(spark, sf):
    e = stand_ins.table(spark, sf, "events")
    return e.select("event_id", *text.fill_from_json({"k": F.lit(""), "event_type": F.col("event_type")}, F.col("props")))


@query("src8_src9_snk1_csv_round_trip", with_views(NODES + "z as (select 1) select id, name, display_label, openrank_sum, topics from kept"))
def csv_round_trip(spark, sf):
    import uuid

    from ..sources import readers
    from .tables import shared_dir

    s, at = Steps(spark, sf), f"{shared_dir(spark)}/weftgraph-csv-{uuid.uuid4().hex}"
    names = [p.split()[0] for p in readers.NODE_SCHEMA.split(", ")]
    s.kept.select(*names).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{at}/nodes")
    s.named.write.option("header", True).csv(f"{at}/edges")
    nodes = readers.nodes_csv(spark, f"{at}/nodes")
    readers.edges_csv(spark, f"{at}/edges", nodes)
    return nodes.select("id", "name", F.coalesce("display_label", F.lit("")).alias("display_label"), "openrank_sum", F.coalesce("topics", F.lit("")).alias("topics"))


@query("sc9_stable_unit")
def stable_unit(spark, sf):
    return stand_ins.table(spark, sf, "customer").select("c_custkey", formulas.stable_unit(F.concat(F.lit("node:"), F.col("c_custkey").cast("string"))).alias("unit"))


@query("snk2_sc17_graphml_lines")
def graphml(spark, sf):
    s = Steps(spark, sf)
    return sinks.graphml(s.kept, s.named)


@query("src16_identity")
def identity(spark, sf):
    from ..sources import readers

    return readers.identity(spark)


from . import details  # noqa: E402, F401  registers further queries
