"""Typed scans: CSV snapshots, polymorphic JSON, manifests and paged HTTP."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.projection import guard_rows

EDGE_SCHEMA = "source string, target string, weight double, shared_contributors long, collaboration_strength double"
NODE_SCHEMA = (
    "id string, name string, display_label string, platform string, repo_id long, openrank_sum double, openrank_avg double, openrank_max double, months_present int, "
    "contributors long, normalized_contribution double, primary_language string, topics string, description string, metadata_status string, url string"
)


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, names: list[str], exact: bool = True) -> DataFrame:
    """Fails unless the columns are these, in this order (exact), or hold them all."""
    if df.columns != names if exact else not set(names) <= set(df.columns):
        raise SchemaError(f"columns {df.columns}; wanted {names}")
    return df


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    names = [p.split()[0] for p in schema.split(", ")]
    require_columns(spark.read.option("header", True).csv(path), names, exact=False)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').csv(path)


def nodes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a snapshot; fails on fields that don't parse and on ids that repeat."""
    df = _csv(spark, path, NODE_SCHEMA)
    twice = df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise SchemaError(f"node {twice[0]['id']} is given {twice[0]['n']} times")
    return df


def edges_csv(spark: SparkSession, path: str, nodes: DataFrame | None = None) -> DataFrame:
    """Edges of a snapshot; fails on self-loops, negative weights and endpoints that are no nodes."""
    df = _csv(spark, path, EDGE_SCHEMA)
    bad = df.filter("source = target or not weight > 0 or not collaboration_strength >= 0").limit(1).collect()
    if bad:
        raise SchemaError(f"bad edge: {bad[0]}")
    if nodes is not None:
        lost = df.select(F.explode(F.array("source", "target")).alias("id")).join(nodes.select("id"), "id", "left_anti").limit(1).collect()
        if lost:
            raise SchemaError(f"edge end {lost[0]['id']} is no node")
    return df


def distinct_ids(nodes: DataFrame) -> DataFrame:
    return nodes.select("repo_id").distinct().orderBy("repo_id")


def keyed_records(document: object) -> list[tuple[str, str]]:
    """(key, record as JSON) of an enrichment document: a list of records, an object keyed by
    id, or either inside repositories, items, rows or data. Keys are repo:<id> and name:<name>."""
    if isinstance(document, dict):
        for box in ("repositories", "items", "rows", "data"):
            if isinstance(document.get(box), list | dict):
                return keyed_records(document[box])
        rows = [{"repo_id": k, **v} if not isinstance(v.get("repo_id"), int | str) else v for k, v in document.items() if isinstance(v, dict)]
    else:
        rows = [r for r in document if isinstance(r, dict)]
    out = []
    for r in rows:
        body = json.dumps(r, sort_keys=True)
        if r.get("repo_id") not in (None, ""):
            out.append((f"repo:{str(r['repo_id']).split(':')[-1]}", body))
        if r.get("name"):
            out.append((f"name:{r['name'].lower()}", body))
    return out


def enrichment(spark: SparkSession, path: str) -> DataFrame:
    """(key, record) of an enrichment file; fails if a key has several different records."""
    text = spark.read.text(path, wholetext=True).first()[0]
    df = spark.createDataFrame(keyed_records(json.loads(text)), "key string, record string").distinct()
    twice = df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise SchemaError(f"{twice[0]['key']} has {twice[0]['n']} different records")
    return df


def manifest(spark: SparkSession, path: str, nodes: DataFrame, edges: DataFrame) -> dict:
    """The manifest of a snapshot, whose row counts must be those of its files."""
    out = json.loads(spark.read.text(path, wholetext=True).first()[0])
    there = {"nodes": nodes.count(), "edges": edges.count()}
    for name, n in there.items():
        if out["rows"].get(name) != n:
            raise SchemaError(f"the manifest has {out['rows'].get(name)} {name}, the file {n}")
    return out


def fetch_json(url: str, retries: int = 7, timeout: float = 30.0, pause: float = 1.0, opener=urllib.request.urlopen) -> dict:
    """A JSON document over HTTP; 429 and 5xx are tried again, after Retry-After or longer and longer pauses."""
    for turn in range(retries + 1):
        try:
            with opener(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=timeout) as r:
                return json.loads(r.read())
        except urllib.error.HTTPError as bad:
            if bad.code != 429 and bad.code < 500 or turn == retries:
                raise
            wait = bad.headers.get("Retry-After") if bad.headers else None
            time.sleep(float(wait) if wait and wait.isdigit() else pause * 2**turn)
        except (urllib.error.URLError, TimeoutError):
            if turn == retries:
                raise
            time.sleep(pause * 2**turn)
    raise AssertionError


class PagedJson(DataSource):
    """Rows of a paged HTTP endpoint: options url (with {offset} and {length}), rows, page.
    Each page is a partition; rows come as (row_idx, row as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "row_idx long, row string, truncated int"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(dict(self.options))


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.rows, self.page = options["url"], int(options["rows"]), min(100, int(options.get("page", 100)))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(0, self.rows, self.page)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at = partition.value
        got = fetch_json(self.url.replace("{offset}", str(at)).replace("{length}", str(min(self.page, self.rows - at))))
        for k, r in enumerate(got["rows"]):
            if r["row_idx"] != at + k:
                raise ValueError(f"row {at + k} of the page at {at} is row {r['row_idx']}")
            yield r["row_idx"], json.dumps(r["row"], sort_keys=True), len(r.get("truncated_cells", []))


def sample(pages: DataFrame, target: int) -> DataFrame:
    """The first rows of each id by position, up to the target."""
    rows = pages.withColumn("id", F.get_json_object("row", "$.id")).filter("id is not null")
    return rows.groupBy("id").agg(F.min_by(F.struct("row_idx", "row", "truncated"), "row_idx").alias("x")).select("id", "x.*").orderBy("row_idx").limit(target)


def read_only(sql: str) -> str:
    """The statement, if it is a single SELECT; an error otherwise."""
    plain = re.sub(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).strip().rstrip(";").strip()
    if ";" in plain or not re.match(r"(?i)(select|with)\b", plain):
        raise ValueError("a scan is one SELECT statement")
    if word := re.search(r"(?i)\b(insert|update|delete|drop|alter|create|truncate|grant|attach|system|into\s+outfile)\b", plain):
        raise ValueError(f"a scan does not {word[0]}")
    return sql.strip().rstrip(";").strip()


def table_scan(spark: SparkSession, url: str, sql: str, most: int, seconds: int, **options: str) -> DataFrame:
    """The rows of a SELECT on a database, over JDBC: read-only, with the server's time limit, and
    an error where there are more rows than allowed."""
    if most < 1 or seconds < 1:
        raise ValueError("limits must be positive")
    reader = spark.read.format("jdbc").option("url", url).option("query", f"select * from ({read_only(sql)}) scan limit {most + 1}").option("queryTimeout", seconds)
    return guard_rows(reader.options(**options).load(), most)


def identity(spark: SparkSession) -> DataFrame:
    return spark.sql("select version() as version, current_database() as database")
