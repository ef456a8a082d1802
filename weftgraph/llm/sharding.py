"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only."""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_key, id_text, materialize

Leaf = tuple[str, str, int, float]


def topology(shards: int, base: int = 40, per_rack: int = 5, racks: int = 2) -> list[Leaf]:
    """(region, rack, shard, weight) of each shard. The first ``base`` shards fill
    racks and regions; each later one opens a region of its own, so that the
    weights of the older regions, and with them all older draws, stay as they are."""
    out = []
    for s in range(shards):
        region = f"r{s // (per_rack * racks)}" if s < base else f"x{s}"
        out.append((region, f"{region}k{s // per_rack % racks if s < base else 0}", s, 1.0))
    return out


def tree(leaves: list[Leaf]) -> dict[str, dict[str, list[tuple[int, float]]]]:
    out: dict = defaultdict(lambda: defaultdict(list))
    for region, rack, shard, weight in leaves:
        out[region][rack].append((shard, weight))
    return out


def _winner(key: Column, nodes: Column) -> Column:
    """An exponential race: the least of -ln(u) / w wins with probability w / sum(w),
    and a node's draw depends on nothing but the key, the node and its weight."""

    def draw(x: Column) -> Column:
        u = (hash_key(F.concat(key, F.lit(":"), x["name"])) + F.lit(0.5)) / F.lit(float(2**52))
        return F.struct((-F.ln(u) / x["weight"]).alias("draw"), x["at"].alias("at"))

    return F.array_min(F.transform(nodes, draw))["at"]


def _nodes(rows: list[tuple[str, float, int]]) -> str:
    return "array(" + ", ".join(f"named_struct('name', '{n}', 'weight', {float(w)!r}D, 'at', {i})" for n, w, i in rows) + ")"


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key: draws among regions, then the racks of the region drawn, then its shards."""
    regions, racks, shards = [], [], []
    for region, kids in tree(leaves).items():
        own = []
        for rack, at in kids.items():
            own.append((rack, sum(w for _, w in at), len(shards)))
            shards.append(_nodes([(f"s{s}", w, s) for s, w in at]))
        regions.append((region, sum(w for _, w, _ in own), len(racks)))
        racks.append(_nodes(own))
    region = _winner(key, F.expr(_nodes(regions)))
    rack = _winner(key, F.expr(f"array({', '.join(racks)})")[region])
    return _winner(key, F.expr(f"array({', '.join(shards)})")[rack])


def assign(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: id and tree decide. A node's draw ignores its siblings, so a
    changed weight moves rows only from or to the subtree that holds it; a shard that
    opens a new region takes rows only into itself. Null ids count as the empty key
    (one shard holds them); null and empty texts have size 16 and crc 0; repeated
    rows get the same shard and slots of their own, which they may take either way round, as
    any rows that tie in hash, id, crc and size; very long texts are hashed whole; an empty
    table gives no rows; other columns are ignored.

    Slots are the ranks by (hash of id, id, crc, size) in a shard. Ranks are taken in
    sqrt(n) hash ranges a shard and shifted by the ranges' running counts, so no
    task holds a whole shard.
    """
    key = id_text(id_col)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(key, leaves).cast("int").alias("shard"),
        (descend(key, grown).cast("int") if grown else F.lit(None).cast("int")).alias("grown_shard"),
        hash_key(F.concat(F.lit("slot:"), key), 8).alias("rank_key"),
    )
    rows = materialize(rows, "shards")
    ranges = max(1, math.isqrt(rows.count() // max(1, len(leaves))))
    rows = rows.withColumn("part", F.expr(f"cast(rank_key * {ranges} div {2**32} as int)"))
    before = (
        rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    )
    here = Window.partitionBy("shard", "part").orderBy("rank_key", F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    return (
        rows.withColumn("within", F.row_number().over(here) - 1)
        .join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"), "grown_shard")
    )


def sql(leaves: list[Leaf], grown: list[Leaf], table: str = "documents") -> str:
    """The same rows in DuckDB SQL."""
    key = "coalesce(cast(doc_id as varchar), '')"

    def num(text: str, digits: int) -> str:
        return f"cast('0x' || substr(md5({text}), 1, {digits}) as bigint)"

    def pick(nodes: list[tuple[str, float, str]]) -> str:
        if len(nodes) == 1:
            return nodes[0][2]
        draws = ", ".join(f"{{'draw': -ln(({num(f"{key} || ':{n}'", 13)} + 0.5) / {float(2**52)!r}) / {float(w)!r}, 'at': {i}}}" for i, (n, w, _) in enumerate(nodes))
        return f"(case list_sort([{draws}])[1].at " + " ".join(f"when {i} then {below}" for i, (_, _, below) in enumerate(nodes)) + " end)"

    def whole(leaves: list[Leaf]) -> str:
        return pick([(g, sum(w for k in racks.values() for _, w in k), pick([(k, sum(w for _, w in s), pick([(f"s{i}", w, str(i)) for i, w in s])) for k, s in racks.items()])) for g, racks in tree(leaves).items()])

    # crc32 is not among DuckDB's functions: bitwise remainder by a table made in SQL.
    return f"""
with recursive steps(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
tab as (select list(c order by i) as t from steps where k = 8),
d as (
  select doc_id, coalesce(text, '') as body, strlen(coalesce(text, '')) + 16 as size, {whole(leaves)} as shard, {whole(grown)} as grown_shard,
    {num(f"'slot:' || {key}", 8)} as rank_key from {table}),
c as (
  select d.*, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(1, 2 * strlen(body), 2), lambda p: cast('0x' || substr(hex(encode(body)), p, 2) as bigint))),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) as text_crc32 from d, tab)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'key' as law, cast(shard as int) as shard,
  row_number() over (partition by shard order by rank_key, doc_id nulls first, text_crc32, size) - 1 as slot, cast(grown_shard as int) as grown_shard from c"""
