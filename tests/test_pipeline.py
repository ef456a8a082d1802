"""Hand-checkable cases of the graph pipeline."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from weftgraph.functions import months, text
from weftgraph.operators import projection as pj
from weftgraph.operators import quality as q
from weftgraph.plans.parameters import Parameters, preset

P = Parameters("GitHub", 202508, 202607, 10, 2, 3, 1, 5, 100)


def test_months():
    assert months.shift(202607, -11) == 202508
    assert months.shift(202601, -1) == 202512
    assert months.sequence(202511, 4) == [202511, 202512, 202601, 202602]
    assert not months.valid(202613) and not months.valid(0)


def test_parameters():
    p = preset("preview", "GitHub", 202607)
    assert (p.start, p.top_repos, p.max_edges_per_node, p.labels) == (202508, 5000, 30, 150)
    with pytest.raises(ValueError):
        preset("preview", "GitHub", 202607, top_repos=0)
    with pytest.raises(ValueError):
        preset("preview", "Git'Hub", 202607)
    with pytest.raises(ValueError):
        preset("preview", "GitHub", 202607, max_actor_degree=1)


def contributions(spark, rows):
    return spark.createDataFrame([("GitHub", m, r, a, v, f"n{r}") for a, r, m, v in rows], "platform string, yyyymm int, repo_id long, actor_id long, openrank double, repo_name string")


def test_projection(spark):
    rows = [(a, r, 202601, 4.0) for a in (1, 2) for r in (1, 2, 3)]
    rows += [(3, 1, 202601, 1.0)]  # one repository: no pair
    rows += [(4, r, 202601, 1.0) for r in (1, 2, 3, 4)]  # beyond the cap
    rows += [(0, r, 202601, 9.0) for r in (1, 2)]  # nobody
    rows += [(1, 1, 202601, 2.0)]  # a duplicate: the larger value stays
    c = contributions(spark, rows)
    top = spark.createDataFrame([(r,) for r in (1, 2, 3, 4)], "repo_id long")
    c = pj.monthly_contributions(c, P)
    degrees = pj.actor_degrees(c, P)
    assert {r.actor_id: r.degree for r in degrees.collect()} == {1: 3, 2: 3}
    pairs = pj.pair_rows(pj.actor_repos(c, degrees, top), degrees)
    assert math.isclose(pairs.agg(F.sum("actor_weight")).first()[0], 2.0)
    edges = {(r.source, r.target): (r.weight, r.shared_contributors, r.collaboration_strength) for r in pj.edges(pairs, 2).collect()}
    assert edges == {k: (0.66666667, 2, 2.66666667) for k in ((1, 2), (1, 3), (2, 3))}


def test_prune_keeps_an_edge_that_either_end_names(spark):
    star = spark.createDataFrame([(1, k, 1.0 + k, 2, 1.0) for k in range(2, 6)], "source long, target long, weight double, shared_contributors long, collaboration_strength double")
    assert pj.prune(star, 1).count() == 4


def test_top_repos_and_forks(spark):
    day = dt.datetime(2026, 1, 1)
    s = spark.createDataFrame([("GitHub", "Repo", day, r, v, f"n{r}", "o") for r, v in ((1, 5.0), (1, 7.0), (2, 6.0), (3, 9.0), (0, 99.0))], "platform string, type string, created_at timestamp, repo_id long, openrank double, repo_name string, org_login string")
    info = spark.createDataFrame(
        [("GitHub", 3, 1, dt.datetime(2026, 2, 1), "x", "Go", ["a"], "d"), ("GitHub", 2, 1, dt.datetime(2025, 1, 1), "x", "Go", ["a"], "d"), ("GitHub", 2, 0, dt.datetime(2026, 1, 1), "y", "C", ["b"], "l1\nl2")],
        "platform string, id long, isFork int, updated_at timestamp, status string, primary_language string, topics array<string>, description string",
    )
    monthly = pj.monthly_scores(s, P)
    latest = pj.latest_info(info, "GitHub")
    top = pj.top_repos(pj.yearly_scores(monthly), latest, P)
    assert [(r.repo_id, r.openrank_sum) for r in top.collect()] == [(1, 7.0), (2, 6.0)]
    stats = pj.contribution_stats(pj.monthly_contributions(contributions(spark, [(1, 2, 202601, 1.0)]), P), top)
    got = {r.repo_id: r for r in pj.nodes(top, stats, latest, "GitHub").collect()}
    assert got[1].metadata_status == "missing" and got[1].contributors == 0 and got[1].primary_language == "Unknown" and got[1].topics == ""
    assert (got[2].metadata_status, got[2].description, got[2].contributors, got[2].url) == ("y", "l1 l2", 1, "https://github.com/n2")


def test_months_reach_the_scan(spark, sf):
    from weftgraph.plans import catalog

    steps = catalog.Steps(spark, sf)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = steps.rows.transform(pj.contributions, catalog.P)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert steps.kept.count() and steps.activity is steps.activity


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_quantiles(spark, n):
    import random

    from weftgraph.plans.ranking import quantiles

    values = [random.Random(n).randrange(20) / 2 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    shares = {"a": 0.5, "b": 0.9, "c": 0.99, "d": 0.0, "e": 1.0}
    row = df.agg(*(F.expr(f"percentile_disc({q}) within group (order by v)").alias(k) for k, q in shares.items())).first()
    assert quantiles(df, "v", shares).first() == row
    row = df.agg(*(F.percentile("v", F.lit(q)).alias(k) for k, q in shares.items())).first()
    assert list(quantiles(df, "v", shares, True).first()) == pytest.approx(list(row))


def test_no_quantiles_of_nothing(spark):
    from weftgraph.plans.ranking import quantiles

    assert quantiles(spark.createDataFrame([], "v double"), "v", {"a": 0.5}).first().a is None


def test_scope_deletes_tables(spark):
    from pathlib import Path

    from weftgraph.plans import tables

    with tables.scope(spark):
        there = tables.materialize(spark.range(3), "gone")
        place = Path(there.inputFiles()[0].removeprefix("file://")).parent
        assert there.count() == 3 and place.exists()
    assert not place.exists()


def test_guard(spark):
    assert pj.guard_rows(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError):
        pj.guard_rows(spark.range(6), 5)


def test_duplicate_verdict():
    assert q.duplicate_verdict(1_000_000, 999_900, 80)["duplicates"] == 100
    with pytest.raises(q.QualityError):
        q.duplicate_verdict(100, 98, 1)
    with pytest.raises(q.QualityError):
        q.duplicate_verdict(100, 101, 0)


def test_uniqueness_counts_null_keys(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 1.0), (None, 1.0)], "k long, v double")
    r = q.uniqueness(df, [F.col("k")], "v").first()
    assert (r.n_rows, r.n_keys, r.n_conflicts) == (4, 2, 1)


def test_edge_counters(spark):
    schema = "source string, target string, weight double, shared_contributors long, collaboration_strength double"
    good = spark.createDataFrame([("GitHub:1", "GitHub:2", 1.0, 2, 0.5)], schema)
    q.edge_verdict(q.edge_counters(good, "GitHub", 2).first())
    bad = spark.createDataFrame([("GitHub:2", "GitHub:1", float("nan"), 1, 0.5), ("GitHub:3", "GitHub:3", 0.0, 2, 1.0), ("x", "GitHub:1", 1.0, 2, 1.0), ("x", "GitHub:1", 1.0, 2, 1.0)], schema)
    r = q.edge_counters(bad, "GitHub", 2).first()
    assert (r.misordered, r.not_finite, r.self_loops, r.not_positive, r.too_few_shared, r.bad_ids, r.duplicates) == (1, 1, 1, 1, 1, 2, 1)
    with pytest.raises(q.QualityError):
        q.edge_verdict(r)
    with pytest.raises(q.QualityError):
        q.edge_verdict(q.edge_counters(good.limit(0), "GitHub", 2).first())


def test_end_month_and_reconcile():
    assert q.end_month(202607, None) == 202607
    with pytest.raises(q.QualityError):
        q.end_month(202607, 202608)
    q.reconcile({"nodes": (3, 3)})
    with pytest.raises(q.QualityError):
        q.reconcile({"nodes": (3, 4)})


def test_text(spark):
    r = spark.range(1).select(
        text.canonical(F.lit(" C++ / Straße_NODE.js ")).alias("c"),
        text.has_phrase(F.lit("big data"), F.lit("data")).alias("yes"), text.has_phrase(F.lit("database"), F.lit("data")).alias("no"),
        text.clip(F.lit("a  b\nccccc"), 5).alias("clip"), text.xml(F.lit('a\x00<b>"&')).alias("xml"),
        text.stripped_tags(F.array(F.lit("dataset:b"), F.lit("x"), F.lit("dataset:a"), F.lit("dataset:b")), "dataset:").alias("tags"),
        text.bare_id(F.lit("github:12")).alias("id"), text.owner(F.lit("o/n")).alias("o"), text.owner(F.lit("n")).alias("none"), text.flag(F.lit("Yes")).alias("flag"),
    ).first()
    assert r.c == "c++ strasse node.js" and r.yes and not r.no and r.clip == "a b…" and r.xml == "a&lt;b&gt;&quot;&amp;" and r.tags == ["a", "b"] and (r.id, r.o, r.none, r.flag) == ("12", "o", None, True)
