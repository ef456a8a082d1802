"""Readers, sinks and snapshots."""

from __future__ import annotations

import io
import json
import threading
import urllib.error
import xml.etree.ElementTree as ET
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from weftgraph.sources import readers, sinks

NODE = ("n", "", "GitHub", 1.0, 1.0, 1.0, 1, 1, 1.0, "Go", "a|b", 'x "y"', "ok", "u")


def tables(spark):
    nodes = spark.createDataFrame([(f"GitHub:{k}", f"owner/{c}", "", "GitHub", k, 1.0, 1.0, 1.0, 1, 1, 0.5, "Go", "", 'says "<hi>"\x01', "ok", "u") for k, c in ((1, "a"), (2, "b"))], readers.NODE_SCHEMA)
    edges = spark.createDataFrame([("GitHub:1", "GitHub:2", 1.0, 2, 0.5)], readers.EDGE_SCHEMA)
    return nodes, edges


def test_csv_round_trip(spark, tmp_path):
    nodes, edges = tables(spark)
    sinks.write_csv(nodes, str(tmp_path / "nodes.csv"))
    sinks.write_csv(edges, str(tmp_path / "edges.csv"))
    n = readers.nodes_csv(spark, str(tmp_path / "nodes.csv"))
    assert [r.id for r in readers.distinct_ids(n).join(n, "repo_id").orderBy("repo_id").collect()] == ["GitHub:1", "GitHub:2"]
    assert readers.edges_csv(spark, str(tmp_path / "edges.csv"), n).collect() == edges.collect()
    with pytest.raises(readers.SchemaError):
        readers.edges_csv(spark, str(tmp_path / "edges.csv"), n.filter("repo_id = 1"))
    sinks.write_csv(nodes.union(nodes), str(tmp_path / "twice.csv"))
    with pytest.raises(readers.SchemaError):
        readers.nodes_csv(spark, str(tmp_path / "twice.csv"))
    with pytest.raises(readers.SchemaError):
        readers.nodes_csv(spark, str(tmp_path / "edges.csv"))


def test_graphml(spark, tmp_path):
    nodes, edges = tables(spark)
    path = str(tmp_path / "g.graphml")
    sinks.write_graphml(nodes, edges, path)
    root = ET.parse(path).getroot()
    ns = "{http://graphml.graphdrawing.org/xmlns}"
    g = root.find(f"{ns}graph")
    assert len(g.findall(f"{ns}node")) == 2 and len(g.findall(f"{ns}edge")) == 1
    shown = {d.get("key"): d.text for d in g.find(f"{ns}node").findall(f"{ns}data")}
    assert shown["n_description"] == 'says "<hi>"' and "n_topics" not in shown
    with pytest.raises(ValueError):
        sinks.graphml(nodes.limit(1), edges)


def test_json(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_json({"x": float("nan")}, str(tmp_path / "x.json"))
    nodes = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, x double")
    edges = spark.createDataFrame([("a", "b", 1.0)], "s string, t string, w double")
    doc = sinks.graph_document({"k": 1}, nodes, edges)
    assert doc["edges"] == [{"s": 0, "t": 1, "w": 1.0}]
    with pytest.raises(ValueError):
        sinks.graph_document({}, spark.createDataFrame([("a", float("inf"))], "id string, x double"), edges.limit(0))


def test_enrichment(spark, tmp_path):
    p = tmp_path / "e.json"
    for doc in ([{"repo_id": 1, "name": "O/A"}], {"1": {"name": "O/A"}}, {"repositories": {"1": {"name": "O/A"}}}, {"rows": [{"repo_id": "repo:1", "name": "O/A"}]}):
        p.write_text(json.dumps(doc))
        assert {r.key for r in readers.enrichment(spark, str(p)).collect()} == {"repo:1", "name:o/a"}
    p.write_text(json.dumps([{"repo_id": 1, "x": 1}, {"repo_id": 1, "x": 2}]))
    with pytest.raises(readers.SchemaError):
        readers.enrichment(spark, str(p))


def test_manifest(spark, tmp_path):
    nodes, edges = tables(spark)
    p = tmp_path / "m.json"
    sinks.write_json({"rows": {"nodes": 2, "edges": 1}, "inputs": {"r": 1}}, str(p))
    assert readers.manifest(spark, str(p), nodes, edges)
    assert sinks.unchanged(str(p), {"r": 1}) and not sinks.unchanged(str(p), {"r": 2}) and not sinks.unchanged(str(tmp_path / "no"), {})
    sinks.write_json({"rows": {"nodes": 3, "edges": 1}}, str(p))
    with pytest.raises(readers.SchemaError):
        readers.manifest(spark, str(p), nodes, edges)


def test_snapshot(tmp_path):
    t = tmp_path / "out"
    with sinks.snapshot(str(t), {"a"}) as stage:
        (stage / "a").write_text("1")
    assert (t / "a").read_text() == "1"
    with pytest.raises(ValueError), sinks.snapshot(str(t), {"a"}):
        pass
    assert (t / "a").read_text() == "1"
    (t / "odd").write_text("")
    with pytest.raises(ValueError), sinks.snapshot(str(t), {"a"}):
        pass


def test_retries():
    turns = []

    def opener(request, timeout):
        turns.append(1)
        if len(turns) < 3:
            raise urllib.error.HTTPError("u", 503, "x", {}, None)
        return io.BytesIO(b'{"ok": 1}')

    assert readers.fetch_json("http://x", pause=0, opener=opener) == {"ok": 1} and len(turns) == 3

    def gone(request, timeout):
        raise urllib.error.HTTPError("u", 404, "x", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        readers.fetch_json("http://x", pause=0, opener=gone)


def test_paged_source(spark):
    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: int(v[0]) for k, v in parse_qs(urlparse(self.path).query).items()}
            rows = [{"row_idx": i, "row": {"id": f"m{i // 2}"}, "truncated_cells": []} for i in range(q["o"], q["o"] + q["n"])]
            body = json.dumps({"rows": rows}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(readers.PagedJson)
        df = spark.read.format("paged_json").option("url", f"http://127.0.0.1:{server.server_port}/?o={{offset}}&n={{length}}").option("rows", 25).option("page", 10).load()
        assert df.count() == 25
        assert [(r.id, r.row_idx) for r in readers.sample(df, 3).collect()] == [("m0", 0), ("m1", 2), ("m2", 4)]
    finally:
        server.shutdown()


def test_stream_gives_what_a_batch_gives(spark, sf, tmp_path):
    from pyspark.sql import functions as F
    from weftgraph.streaming import monthly

    events = spark.read.parquet(f"{sf}/events.parquet").selectExpr("ts", "user_id as actor_id", "user_id % 7 as repo_id", "value")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = monthly.daily_contributions(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    whole = monthly.daily_contributions(events)
    done = whole.agg(F.max("day").alias("d")).first()["d"]
    got = monthly.fold(spark.read.parquet(str(tmp_path / "out")))
    assert got.count() > 0
    out = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("day", "actor_id", "repo_id", "contribution").collect()}
    assert out <= {tuple(r) for r in whole.select("day", "actor_id", "repo_id", "contribution").collect()}
    assert {r[0] for r in out} >= {r.day for r in whole.filter(F.col("day") < F.lit(done) - F.expr("interval 3 days")).collect()}


def test_scans_only_read():
    from weftgraph.sources import readers

    assert readers.read_only(" select 'drop; x' as a -- insert\n from t; ") .startswith("select")
    for bad in ("drop table t", "select 1; select 2", "with x as (select 1) insert into t select * from x", "select * into outfile 'x' from t", ""):
        with pytest.raises(ValueError):
            readers.read_only(bad)
    with pytest.raises(ValueError):
        readers.table_scan(None, "jdbc:x", "select 1", 0, 5)


def test_built_or_cached(tmp_path):
    import json

    from weftgraph.sources import sinks

    path = tmp_path / "manifest.json"

    def build(revision):
        return lambda: path.write_text(json.dumps({"inputs": {"revision": revision, "n": 5}}))

    def down():
        raise OSError("no answer")

    assert sinks.built_or_cached(str(path), {"revision": 1, "n": 5}, build(1)) == "built"
    assert sinks.built_or_cached(str(path), {"revision": 1, "n": 5}, down) == "cached"
    assert sinks.built_or_cached(str(path), {"revision": 2, "n": 5}, down) == "stale"
    with pytest.raises(OSError):
        sinks.built_or_cached(str(path), {"revision": 2, "n": 6}, down)
    assert sinks.built_or_cached(str(path), {"revision": 2, "n": 5}, build(2)) == "built"


def test_documents_are_bounded(spark):
    from weftgraph.sources import sinks

    assert len(sinks.bounded_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        sinks.bounded_rows(spark.range(6), 5)
