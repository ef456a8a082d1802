"""Graph operators against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F
from weftgraph.functions import formulas
from weftgraph.operators import components, explore, graph, hub, layout, taxonomy
from weftgraph.operators.components import connected_components

SCHEMA = "s long, t long, weight double, shared long, strength double"


def some_edges(seed: int, n: int = 40, m: int = 60):
    rnd = random.Random(seed)
    pairs = {tuple(sorted(rnd.sample(range(n), 2))) for _ in range(m)}
    return [(s, t, float(rnd.randint(1, 4)), rnd.randint(2, 4), float(rnd.randint(1, 3))) for s, t in sorted(pairs)]


def roots(edges):
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for s, t, *_ in edges:
        a, b = find(s), find(t)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize(("seed", "small"), [(1, 0), (2, 0), (2, 8000), (3, 20)])
def test_components_and_forest(spark, seed, small, monkeypatch):
    monkeypatch.setattr(components, "SMALL", small)
    monkeypatch.setattr(graph, "SMALL", small)
    rows = some_edges(seed)
    e = spark.createDataFrame(rows, SCHEMA)
    assert {r.id: r.component for r in connected_components(e, "s", "t").collect()} == roots(rows)
    kept, taken = [], []
    for r in sorted(rows, key=lambda r: (-r[2], -r[4], -r[3], r[0], r[1])):
        at = roots(taken)
        if at.get(r[0], r[0]) != at.get(r[1], r[1]):
            taken.append(r)
            kept.append(r[:2])
    assert {(r.s, r.t) for r in graph.spanning_forest(e).collect()} == set(kept)
    best = {r[:2] for r in sorted(rows, key=lambda r: (-r[2], -r[4], -r[3], r[0], r[1]))[:3]}
    assert set(kept) | best <= {(r.s, r.t) for r in graph.backbone(e, 3).collect()}


def test_components_of_all_lines(spark, sf, monkeypatch):
    from weftgraph.plans import catalog

    monkeypatch.setattr(components, "SMALL", 0)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").join(spark.read.parquet(f"{sf}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey"))
    want = roots({(r.o_custkey, r.l_suppkey + 1_000_000_000) for r in lines.select("o_custkey", "l_suppkey").collect()})
    got = catalog.QUERIES["gr6_components"](spark, sf).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    size = {c: list(want.values()).count(c) for c in set(want.values())}
    assert all(r.size == size[r.component] for r in got)


def test_long_path(spark, monkeypatch):
    monkeypatch.setattr(components, "SMALL", 0)
    e = spark.createDataFrame([(k, k + 1) for k in range(200)], "s long, t long")
    assert {r.component for r in connected_components(e, "s", "t").collect()} == {0}


def test_no_edges(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert connected_components(e, "s", "t").count() == 0
    assert graph.spanning_forest(e).count() == 0
    assert graph.core_numbers(e).count() == 0
    alone = graph.components(spark.createDataFrame([(7,)], "node long"), e).first()
    assert (alone.component, alone.size, alone.place) == (7, 1, 0)


def test_cores(spark):
    clique = [(a, b, 1.0, 2, 1.0) for a in range(4) for b in range(a + 1, 4)] + [(3, 9, 1.0, 2, 1.0)]
    got = {r.node: r.core for r in graph.core_numbers(spark.createDataFrame(clique, SCHEMA)).collect()}
    assert got == {0: 3, 1: 3, 2: 3, 3: 3, 9: 1}


@pytest.mark.parametrize(("seed", "small"), [(1, 0), (2, 0), (3, 8000)])
def test_cores_are_those_of_peeling(spark, seed, small, monkeypatch):
    monkeypatch.setattr(graph, "SMALL", small)
    rows = [*some_edges(seed, 30, 110), (100, 101, 1.0, 2, 1.0), (101, 102, 1.0, 2, 1.0), (102, 103, 1.0, 2, 1.0)]
    near = defaultdict(set)
    for s, t, *_ in rows:
        near[s].add(t)
        near[t].add(s)
    want, k = {}, 0
    while near:
        low = [v for v, n in near.items() if len(n) <= k]
        if not low:
            k += 1
        for v in low:
            want[v] = k
            for u in near.pop(v):
                near[u].discard(v)
    e = spark.createDataFrame([*rows, (rows[0][1], rows[0][0], *rows[0][2:]), (5, 5, 1.0, 2, 1.0)], SCHEMA)
    assert {r.node: r.core for r in graph.core_numbers(e).collect()} == want


def several_parts(rnd: random.Random):
    """Edges of a few dense groups, loosely tied, in several components, with small fragments beside."""
    rows, at = {}, 0
    for _ in range(rnd.randint(2, 4)):
        first = at
        for _ in range(rnd.randint(1, 3)):
            n = rnd.randint(2, 16)
            for a in range(n):
                for b in range(a + 1, n):
                    if rnd.random() < 0.45 or b == a + 1:
                        rows[at + a, at + b] = round(rnd.uniform(0.1, 3), 3)
            if at > first:
                rows[rnd.randrange(first, at), at] = round(rnd.uniform(0.01, 0.6), 3)
            at += n
    return [(s, t, w, 2, round(w / 2, 3)) for (s, t), w in rows.items()]


def unit(text: str) -> float:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big") / 2**64


def plain_communities(rows, prefix, resolution=1.15, sweeps=32, least=12):
    """One walk over the whole graph, as the survey describes it."""
    bind = lambda w, c: max(math.log1p(w) + 0.55 * math.log1p(c), 1e-12)
    ties = defaultdict(list)
    for s, t, w, _, c in rows:
        ties[s].append((t, bind(w, c)))
        ties[t].append((s, bind(w, c)))
    heavy = {v: sum(a for _, a in n) for v, n in ties.items()}
    whole = sum(heavy.values())
    label = {v: v for v in ties}
    walk = sorted(ties, key=lambda v: (-heavy[v], unit(f"{prefix}{v}"), f"{prefix}{v}"))
    for _ in range(sweeps):
        before = dict(label)
        for v in walk:
            loads, pulls = Counter(), Counter()
            for u, c in label.items():
                if u != v:
                    loads[c] += heavy[u]
            for u, a in ties[v]:
                pulls[label[u]] += a
            gains = {c: pulls[c] - resolution * heavy[v] * loads[c] / whole for c in pulls}
            top = max([0.0, *gains.values()])
            close = [c for c in sorted(gains) if top - gains[c] <= 1e-10]
            if top > 1e-12:
                label[v] = label[v] if label[v] in close else close[0]
        if label == before:
            break
    for _ in range(5):
        sizes = Counter(label.values())
        before = dict(label)
        for v in sorted(ties, key=lambda v: f"{prefix}{v}"):
            if sizes[label[v]] < least:
                pulls = Counter()
                for u, a in ties[v]:
                    if sizes[label[u]] >= least:
                        pulls[label[u]] += a
                if pulls:
                    label[v] = min(c for c in pulls if max(pulls.values()) - pulls[c] <= 1e-10)
        if label == before:
            break
    return label


def test_communities_on_several_parts(spark):
    """60 graphs, each in an id range of its own, against a walk over each as a whole graph."""
    for seed in range(60):
        rows = several_parts(random.Random(seed))
        bound = pd.DataFrame([(s, t, max(math.log1p(w) + 0.55 * math.log1p(c), 1e-12)) for s, t, w, _, c in rows], columns=["s", "t", "a"])
        own = roots(rows)
        total, got = 2 * bound["a"].sum(), {}
        for part in set(own.values()):
            g = graph._Communities(bound[bound["s"].map(own) == part].sort_values(["s", "t"]), 1.15, total, "P:")
            for _ in range(32):
                if not g.sweep():
                    break
            g.absorb(12, 5)
            got |= g.label
        assert got == plain_communities(rows, "P:"), seed
    for seed in (3, 8):
        rows = several_parts(random.Random(seed))
        at = {r.node: r.label for r in graph.communities(spark.createDataFrame(rows, SCHEMA), prefix="P:").collect()}
        assert at == plain_communities(rows, "P:")


def plain_macros(size, links, n_nodes):
    """The growth of macros with every pair weighed anew in each step."""
    near = defaultdict(dict)
    for (a, b), x in links.items():
        near[a][b] = near[b][a] = x
    own = roots([(a, b) for a, b in links])
    parts = defaultdict(list)
    for c in size:
        parts[own.get(c, c)].append(c)
    main, *others = sorted(parts.values(), key=lambda p: (-sum(size[c] for c in p), min(p)))
    k = min(graph.macro_count(n_nodes), len(size))
    m = min(k, len(main))
    at = {c: i for i, c in enumerate(sorted(main, key=lambda c: (-size[c], c))[:m])}
    ideal = sum(size[c] for c in main) / m
    while len(at) < len(main):
        load = Counter()
        for c, i in at.items():
            load[i] += size[c]
        best = []
        for c in main:
            if c not in at:
                pulls = Counter()
                for d, x in near[c].items():
                    if d in at:
                        pulls[at[d]] += x
                best += [(x / (1 + load[i] / ideal) ** 1.45, -c, -i) for i, x in pulls.items()]
        if best:
            _, c, i = max(best)
            at[-c] = -i
        else:
            at[min((c for c in main if c not in at), key=lambda c: (-size[c], c))] = min(range(m), key=lambda i: (load[i], i))
    slots = list(range(m, k)) or list(range(m))
    for part in others:
        i = slots[min(len(slots) - 1, int(unit(f"satellite-macro:{min(part)}") * len(slots)))]
        at |= {c: i for c in part}
    return at


def test_macros_grow_by_affinity():
    for seed in range(60):
        rnd = random.Random(seed)
        n = rnd.randint(1, 40)
        size = {c: rnd.randint(1, 60) for c in range(n)}
        links = {}
        for _ in range(rnd.randint(0, 70)):
            a, b = rnd.randrange(n), rnd.randrange(n)
            if a < b and (a < n * 0.7) == (b < n * 0.7):
                links[a, b] = rnd.uniform(0.1, 5)
        got = graph.macros(pd.DataFrame({"community": list(size), "size": list(size.values())}), pd.DataFrame([(a, b, x) for (a, b), x in links.items()], columns=["a", "b", "affinity"]), 100)
        assert got == plain_macros(size, links, 100), seed


def two_cliques():
    rows = [(a + o, b + o, 5.0, 3, 5.0) for o in (0, 10) for a in range(5) for b in range(a + 1, 5)]
    return [*rows, (0, 10, 0.1, 2, 0.1)]


def test_communities(spark):
    e = spark.createDataFrame(two_cliques(), SCHEMA)
    for labels in (graph.communities(e, least=2), graph.propagate(e)):
        at = {r.node: r.label for r in labels.collect()}
        assert len({at[k] for k in range(5)}) == 1 and len({at[k + 10] for k in range(5)}) == 1 and at[0] != at[10]
    rank = spark.createDataFrame([(k, 1.0) for k in range(20)], "node long, rank double")
    named = graph.renumber(graph.communities(e, least=2), rank)
    assert {r.node: r.community for r in named.collect()}[0] == 0
    assert {(r.a, r.b) for r in graph.affinities(e, named).collect()} == {(0, 1)}


def test_fragments_join_their_neighbour(spark):
    e = spark.createDataFrame([*two_cliques(), (20, 21, 9.0, 2, 9.0), (4, 20, 0.2, 2, 0.2)], SCHEMA)
    at = {r.node: r.label for r in graph.communities(e, least=4).collect()}
    assert at[20] == at[4] and at[21] == at[20]  # one by one: 20 has a settled neighbour first, then 21 has


def test_discs():
    discs = layout.place_macros(pd.DataFrame({"macro": [0, 1, 2], "size": [9, 5, 1]}), pd.DataFrame({"a": [0], "b": [1], "affinity": [1.0]}))
    assert discs["radius"].is_monotonic_decreasing


def test_layout(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.uniform(-1, 1), rnd.uniform(-1, 1), k % 2, float(k)) for k in range(200)]
    p = spark.createDataFrame(rows, "node long, x double, y double, community int, rank double")
    m = layout.metrics(p, spark.createDataFrame([(k, k + 1) for k in range(50)], "s long, t long")).first()
    assert m.main_nodes == 200 and 0 < m.polar_coverage <= 1 and 0 < m.angular_entropy <= 1 and m.radius_max <= 1.42
    at = layout.thresholds(layout.density(p))
    lines = layout.contours(layout.density(p), at, layout.frame(p))
    assert all(abs(v) < 1.3 for r in lines.collect() for v in (r.x1, r.y1, r.x2, r.y2))
    assert [r.level for r in at.orderBy("level").collect()] == [0, 1, 2] and lines.count() > 10


def test_islands(spark):
    rows = [(k, k % 2, 10 + k % 4, 0, float(k), 3) for k in range(200)] + [(300 + k, 0, 20, 1, 1.0, 1) for k in range(5)] + [(400 + k, 1, 21, 2, 1.0, 1) for k in range(3)]
    nodes = spark.createDataFrame(rows, "node long, macro int, community int, component int, rank double, degree long")
    discs = spark.createDataFrame([(0, -0.4, 0.0, 0.3), (1, 0.4, 0.0, 0.3)], "macro int, x double, y double, radius double")
    none = spark.createDataFrame([], "s long, t long, weight double, strength double")
    spine = spark.createDataFrame([(0, 1, 5.0, 5.0), (2, 4, 5.0, 5.0)], "s long, t long, weight double, strength double")
    at, pulled = ({r.node: (r.x, r.y) for r in layout.islands(nodes, discs, b).collect()} for b in (none, spine))
    assert len(set(at.values())) == len(rows) == len(at)
    assert max(math.hypot(*p) for p in at.values()) == pytest.approx(0.965, abs=1e-4)
    assert abs(sum(at[k][0] for k in range(200))) < 0.01 and abs(sum(at[k][1] for k in range(200))) < 0.01
    # The halves lie apart, lobes around their strongest nodes, satellites close together and far out.
    assert all(at[k][0] < at[k + 1][0] for k in range(0, 200, 2))
    for c in range(4):
        own = [k for k in range(200) if k % 4 == c]
        mid = [sum(at[k][i] for k in own) / len(own) for i in (0, 1)]
        assert min(own, key=lambda k: math.dist(at[k], mid)) in own[-8:]
    for part in (range(300, 305), range(400, 403)):
        assert max(math.dist(at[a], at[b]) for a in part for b in part) < 0.08 and all(math.hypot(*at[k]) > 0.4 for k in part)
    # The ends of an edge between the halves come nearer, those of one inside a half stay.
    assert math.dist(pulled[0], pulled[1]) < math.dist(at[0], at[1]) and math.dist(pulled[2], pulled[4]) == pytest.approx(math.dist(at[2], at[4]), rel=0.05)
    lone = nodes.filter("component = 0 and community = 10")
    assert layout.islands(lone, discs, none).count() == 50


def test_taxonomy_weights(spark):
    docs = spark.createDataFrame([(1, ["Machine Learning"], "about ai"), (2, ["machine learning ops"], None), (3, None, "no machine learning here"), (4, [], "")], "id long, topics array<string>, description string")
    lex = taxonomy.lexicon(spark, {"A": ["machine learning"], "B": ["ai", "machine-learning"]})
    got = {(r.id, r.keyword): round(r.score, 2) for r in taxonomy.evidence(docs, lex).collect()}
    assert got == {(1, "machine learning"): 4.6, (1, "machine-learning"): 4.6, (1, "ai"): 0.9, (2, "machine learning"): 3.1, (2, "machine-learning"): 3.1, (3, "machine learning"): 1.15, (3, "machine-learning"): 1.15}
    c = {r.id: r for r in taxonomy.classify_signal(docs, lex).collect()}
    assert (c[1].primary, c[1].tags, c[1].source) == ("B", ["machine learning", "machine-learning", "ai"], "tech0-ai-lexicon-v1:description+topics")
    assert c[2].primary == "A" and (c[4].is_signal, c[4].primary, c[4].confidence) == (False, "Non-AI", 0.58)


def test_domain_class_reads_both_lexicons(spark):
    docs = spark.createDataFrame([(1, ["rust"], "an ai agent", "Rust"), (2, ["sql store"], "keeps rows", "Go"), (3, None, None, "Go"), (4, ["web"], "web web-page", None)], "id long, topics array<string>, description string, lang string")
    signals, domains = taxonomy.lexicon(spark, {"Agents & RAG": ["ai agent"]}), taxonomy.lexicon(spark, {"Database": ["sql"], "Web": ["web", "web page"]})
    got = {r.id: (r.primary, r.tags, r.source) for r in taxonomy.classify_domain(docs, signals, domains, {"Systems": ["Go"]}, "Tools").collect()}
    name = "tech0-domain-lexicon-v1"
    assert got == {1: ("Agentic AI", ["ai agent"], f"{name}:description"), 2: ("Database", ["sql"], f"{name}:topics"), 3: ("Systems", ["Go"], f"{name}:primary_language-fallback"), 4: ("Web", ["web", "web page"], f"{name}:description+topics")}
    assert taxonomy.classify_signal(docs, taxonomy.lexicon(spark, {})).filter("is_signal").count() == 0


def test_labels(spark):
    r = spark.range(1).select(taxonomy.canonical_label(F.lit("cloud  native"), ["Cloud Native"], {}, []).alias("a"), taxonomy.canonical_label(F.lit("db"), [], {"db": "Database"}, []).alias("b"), taxonomy.canonical_label(F.lit("my web thing"), [], {}, [("web", "Web")]).alias("c"), taxonomy.canonical_label(F.lit(" Odd "), [], {}, []).alias("d")).first()
    assert tuple(r) == ("Cloud Native", "Database", "Web", "Odd")


def test_curated_lookup(spark):
    nodes = spark.createDataFrame([(1, "O/A"), (2, "o/b"), (3, "o/c")], "repo_id long, name string")
    records = spark.createDataFrame([("repo:1", "x"), ("name:o/a", "no"), ("name:O/B", "y")], "key string, record string")
    assert {r.repo_id: r.record for r in taxonomy.lookup_curated(nodes, records).collect()} == {1: "x", 2: "y", 3: None}


def test_hub_precedence(spark):
    e = spark.createDataFrame([("a", "b", 4.2, "same-author", 0, 0), ("a", "b", 7.5, "declared-dataset", 0, 0), ("b", "a", 7.5, "declared-dataset", 0, 1), ("a", "a", 9.0, "base-model", 0, 0)], "a string, b string, weight double, kind string, inferred int, at int")
    assert [tuple(r) for r in hub.resolve(e).collect()] == [("a", "b", 7.5, "declared-dataset", 0, 2)]


def test_formulas(spark):
    r = spark.range(1).select(formulas.finite(F.lit(float("nan"))).alias("a"), formulas.finite(F.lit(-2.0)).alias("b"), formulas.compact(F.lit(-0.0001), 2).alias("c"), formulas.compact(F.lit(2.50), 3).alias("d"), formulas.affinity(F.lit(0.0), F.lit(0.0)).alias("e"), formulas.stable_unit(F.lit("x")).alias("u"), formulas.hue_color(F.lit(0.0), F.lit(0.5), F.lit(1.0)).alias("h"), formulas.compact(F.lit(10.0), 0).alias("f")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.h, r.f) == (0.0, 0.0, "0", "2.5", 1e-12, "#ff0000", "10") and 0 <= r.u < 1


def test_explore(spark):
    e = spark.createDataFrame(two_cliques(), SCHEMA)
    assert explore.ego(e, 1).count() == 10
    assert explore.neighbours(e, 0, 2).count() == 2
    assert explore.skeleton(e).count() == 21
    assert explore.visible(e.withColumn("b", F.lit(1)), "signal").count() == 21 and explore.visible(e.withColumn("b", F.lit(0)), "network", 1.0).count() == 20
    n = spark.createDataFrame([(k, float(k % 50)) for k in range(300)], "node long, score double")
    tiers = defaultdict(int)
    for r in explore.tiers(n).collect():
        tiers[r.tier] += 1
    assert tiers == {"landmark": 3, "core": 27, "star": 270}
    assert explore.annotations([(1, 1.0, 0.0, 9), (2, 1.0, 0.1, 8), (3, 0.0, 1.0, 7)]) == [1, 3]
    # Far ones come before larger ones near the middle; exactly at the limit is too near.
    assert explore.annotations([(1, 0.1, 0.0, 10), (2, 0.0, 2.0, 7)]) == [2, 1]
    assert explore.annotations([(1, 1.0, 0.0, 9), (2, math.cos(0.5), math.sin(0.5), 8)], apart=math.atan2(math.sin(0.5), math.cos(0.5))) == [1]
