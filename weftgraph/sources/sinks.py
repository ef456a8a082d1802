"""Snapshot files: CSV, GraphML, JSON, manifests, and publishing them as one."""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import math
import os
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import xml

#: Rows of a kind that one JSON document may hold: builds are bounded by less.
DOCUMENT_ROWS = 1_000_000
FILES = {"edges.csv", "nodes.csv", "graph.graphml", "qa.json", "manifest.json", "queries"}


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, in the rows' order, through Spark's committer."""
    part = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(part)
    _take_part(part, path)


def _take_part(part: str, path: str) -> None:
    """The one file that a task wrote, under the name asked for. The place must be on a file
    system that driver and executors share."""
    found = list(Path(part).glob("part-*"))
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} files in {part}: snapshots are written to a shared file system")
    (one,) = found
    os.replace(one, path)
    shutil.rmtree(part)


def write_text(text: str, path: str) -> None:
    tmp = f"{path}.part"
    Path(tmp).write_text(text, encoding="utf-8")
    os.replace(tmp, path)


def write_json(value: object, path: str, pretty: bool = True) -> None:
    """JSON that any reader takes: NaN and infinity fail."""
    write_text(json.dumps(value, indent=2 if pretty else None, sort_keys=pretty, ensure_ascii=False, allow_nan=False, separators=None if pretty else (",", ":")) + "\n", path)


def digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


_TYPES = {"bigint": "long", "int": "int", "double": "double", "string": "string"}


def _data(df: DataFrame, skip: tuple[str, ...], prefix: str) -> list[Column]:
    """<data> elements of the columns that are not null or empty."""
    return [F.when(F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) > 0, F.concat(F.lit(f'<data key="{prefix}{c}">'), xml(F.col(c).cast("string")), F.lit("</data>"))).otherwise("") for c in df.columns if c not in skip]


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines (place, line) of a GraphML document; every edge end must be a node."""
    spark = nodes.sparkSession
    lost = edges.select(F.explode(F.array("source", "target")).alias("id")).join(nodes.select("id"), "id", "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"edge end {lost[0]['id']} is no node")
    keys = [f'<key id="{p}{c}" for="{what}" attr.name="{c}" attr.type="{_TYPES[t]}"/>' for df, p, what, skip in ((nodes, "n_", "node", ("id",)), (edges, "e_", "edge", ("source", "target"))) for c, t in df.dtypes if c not in skip]
    head = ['<?xml version="1.0" encoding="UTF-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', *keys, '<graph id="G" edgedefault="undirected">']
    top = spark.createDataFrame([(0, f"{i:06d}", x) for i, x in enumerate(head)], "place int, sub string, line string")
    n = nodes.select(F.lit(1).alias("place"), F.col("id").alias("sub"), F.concat(F.lit('<node id="'), xml(F.col("id")), F.lit('">'), *_data(nodes, ("id",), "n_"), F.lit("</node>")).alias("line"))
    e = edges.select(F.lit(2).alias("place"), F.concat_ws("|", "source", "target").alias("sub"), F.concat(F.lit('<edge source="'), xml(F.col("source")), F.lit('" target="'), xml(F.col("target")), F.lit('">'), *_data(edges, ("source", "target"), "e_"), F.lit("</edge>")).alias("line"))
    end = spark.createDataFrame([(3, "0", "</graph>"), (3, "1", "</graphml>")], "place int, sub string, line string")
    return top.unionByName(n).unionByName(e).unionByName(end)


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    part = f"{path}.parts"
    graphml(nodes, edges).orderBy("place", "sub").select("line").coalesce(1).write.mode("overwrite").text(part)
    _take_part(part, path)


def bounded_rows(df: DataFrame, most: int = DOCUMENT_ROWS) -> list:
    """The rows of a table that a document may hold; an error if they are more."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a document has {most} rows of a kind at most")
    return rows


def graph_document(meta: dict, nodes: DataFrame, edges: DataFrame) -> dict:
    """{meta, nodes, edges}: dense places stand for ids only here, at the sink."""
    rows = sorted(bounded_rows(nodes), key=lambda r: r["id"])
    at = {r["id"]: i for i, r in enumerate(rows)}
    out = {"meta": meta, "nodes": [r.asDict(True) for r in rows], "edges": [{**r.asDict(True), "s": at[r["s"]], "t": at[r["t"]]} for r in sorted(bounded_rows(edges), key=lambda r: (r["s"], r["t"]))]}
    for x in (*out["nodes"], *out["edges"]):
        if any(isinstance(v, float) and not math.isfinite(v) for v in x.values()):
            raise ValueError(f"not finite: {x}")
    return out


def curated_document(labels: DataFrame) -> dict:
    """{repositories: {id: row}}"""
    return {"repositories": {str(r["repo_id"]): r.asDict(True) for r in sorted(bounded_rows(labels), key=lambda r: r["repo_id"])}}


def plan_text(df: DataFrame, sql: str = "") -> str:
    """What ran: the SQL, if any, and Spark's formatted plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return f"{sql}\n\n{plan}"


@contextlib.contextmanager
def snapshot(target: str, required: set[str] = FILES):
    """A staging folder that replaces ``target`` as a whole once it is complete. Other writers
    wait; a target that is a link, a root or holds unknown files is left alone."""
    t = Path(target)
    if t.is_symlink() or t.resolve() == t.resolve().parent:
        raise ValueError(f"{target} is no place for a snapshot")
    if t.exists() and (odd := {p.name for p in t.iterdir()} - required):
        raise ValueError(f"{target} holds other files: {sorted(odd)}")
    t.parent.mkdir(parents=True, exist_ok=True)
    stage, old = t.with_name(f".{t.name}.stage"), t.with_name(f".{t.name}.old")
    with open(t.with_name(f".{t.name}.lock"), "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        shutil.rmtree(stage, ignore_errors=True)
        stage.mkdir()
        try:
            yield stage
            if missing := required - {p.name for p in stage.iterdir()}:
                raise ValueError(f"the snapshot lacks {sorted(missing)}")
            shutil.rmtree(old, ignore_errors=True)
            if t.exists():
                os.replace(t, old)
            try:
                os.replace(stage, t)
            except OSError:
                if old.exists():
                    os.replace(old, t)
                raise
            shutil.rmtree(old, ignore_errors=True)
        finally:
            shutil.rmtree(stage, ignore_errors=True)


def unchanged(manifest_path: str, inputs: dict) -> bool:
    """Whether a snapshot was built from the same revision and parameters."""
    try:
        return json.loads(Path(manifest_path).read_text())["inputs"] == inputs
    except (OSError, ValueError, KeyError):
        return False


def built_or_cached(manifest_path: str, inputs: dict, build) -> str:
    """Builds a snapshot unless it stands already: "cached" if it was built from the same
    inputs, else "built"; "stale" if the source can't be reached and the snapshot differs in the
    source's revision alone. A failure of any other kind, or without such a snapshot, is raised."""
    if unchanged(manifest_path, inputs):
        return "cached"
    try:
        build()
        return "built"
    except OSError:
        try:
            there = json.loads(Path(manifest_path).read_text())["inputs"]
        except (OSError, ValueError, KeyError):
            there = None
        if there is None or {**there, "revision": None} != {**inputs, "revision": None}:
            raise
        return "stale"
