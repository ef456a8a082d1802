"""Content-addressed store of token ids: chunks by digest, recipes by document, Merkle manifests."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from . import tokens
from .common import arrow_schema, materialize, shared_dir

#: Chunks have 1024 ids on average; none is shorter (but a document's last) or longer.
LEAST, MEAN_BITS, MOST = 256, 10, 8192
WINDOW = 16
#: Documents in a range of recipes, and children of a node of the Merkle tree.
RANGE_ROWS = 50_000
FANOUT = 1024


@lru_cache(1)
def _gear() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 63, 1 << 16, dtype=np.uint64)


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream. A rolling hash of the last 16 ids marks the
    places; equal passages get equal cuts wherever they stand."""
    h = _gear()[ids & 0xFFFF].copy()
    step = 1
    while step < WINDOW:  # sums of g[i-j] << j over windows of doubling length
        add = h[:-step] << np.uint64(step)
        h[step:] += add
        step *= 2
    marks = np.flatnonzero((h >> np.uint64(20)) & np.uint64((1 << MEAN_BITS) - 1) == 0) + 1
    out, last = [], 0
    for m in marks.tolist():
        while m - last > MOST:
            last += MOST
            out.append(last)
        if m - last >= LEAST:
            out.append(m)
            last = m
    while len(ids) - last > MOST:
        last += MOST
        out.append(last)
    if last < len(ids):
        out.append(len(ids))
    return out


def id_width(path: str, end_id: int) -> int:
    """Bytes of a stored id: 2 where the vocabulary and the end id fit, else 4."""
    return 2 if max(tokens.size(path) - 1, end_id) < 1 << 16 else 4


def _encode(schema, path: str, end_id: int, width: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = tokens.word_end(path), np.array([end_id], np.uint32)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([code(text or ""), end])
                parts, a = [], 0
                for b in cuts(ids):
                    parts.append(ids[a:b].astype(f"<u{width}").tobytes())
                    a = b
                rows.append((doc_id, len(ids), [hashlib.sha256(p).digest() for p in parts], parts))
                held += width * len(ids) + 64
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)

    return run


@dataclass
class Store:
    """Folders of Parquet files: ``chunks`` (digest, ids), ``recipes`` (row, doc_id, start,
    n_tokens, digests, in ascending doc_id order), ``manifest`` (level, node, hash) and
    ``format`` (width: bytes of an id)."""

    path: str
    width: int = 2

    def chunks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest binary, ids binary").parquet(f"{self.path}/chunks")

    def recipes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/recipes")

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("level int, node long, hash binary").parquet(f"{self.path}/manifest")


def open_store(spark: SparkSession, path: str) -> Store:
    return Store(path, spark.read.schema("width int").parquet(f"{path}/format").first()["width"])


def _leaves(recipes: DataFrame) -> DataFrame:
    text = F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("start").cast("string"), F.col("n_tokens").cast("string"), F.concat_ws("", F.transform("digests", F.hex)))
    return recipes.select(F.col("row").alias("node"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("hash"))


def _up(nodes: DataFrame) -> DataFrame:
    kids = F.array_sort(F.collect_list(F.struct("node", "hash")))
    joined = F.aggregate(F.transform(kids, lambda x: x["hash"]), F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return nodes.groupBy(F.expr(f"node div {FANOUT}").alias("parent")).agg(joined.alias("all")).select(F.col("parent").alias("node"), F.unhex(F.sha2("all", 256)).alias("hash"))


def write(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1, text: str = "text", id_col: str = "doc_id") -> Store:
    """Encodes the documents and stores them under ``path`` (the shared folder unless given).

    Null and empty texts are the end id alone. Recipes stand in ascending order of
    (doc_id, number of ids, digests), null ids first; repeated rows have recipes of
    their own and share their chunks, and rows that tie in all of that are alike. A very long
    text is encoded in parts and stored whole; a task holds its ids. Other columns are ignored.
    An empty table gives empty folders. Ids take two bytes, or four where the vocabulary asks for it.
    """
    spark = docs.sparkSession
    store = Store(path or f"{shared_dir(spark)}/weftgraph-store-{uuid.uuid4().hex}", id_width(tokenizer, end_id))
    spark.createDataFrame([(store.width,)], "width int").coalesce(1).write.parquet(f"{store.path}/format")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = _parse_datatype_string(f"doc_id {kind}, n_tokens long, digests array<binary>, parts array<binary>")
    coded = materialize(rows.mapInArrow(_encode(schema, tokenizer, end_id, store.width), schema), "coded")
    pairs = coded.select(F.explode(F.arrays_zip("digests", "parts")).alias("x")).select(F.col("x.digests").alias("digest"), F.col("x.parts").alias("ids"))
    pairs.dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{store.path}/chunks")
    # Ranges of doc_id, and in each the running count of ids: starts and rows follow from the ranges' sums.
    ranges = max(1, -(-coded.count() // RANGE_ROWS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.col("digests")]
    ranged = materialize(coded.drop("parts").repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "ranged")
    up = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("ids"))
        .select("part", F.coalesce(F.sum("rows").over(up), F.lit(0)).alias("row0"), F.coalesce(F.sum("ids").over(up), F.lit(0)).alias("start0"))
    )
    here = Window.partitionBy("part").orderBy(*order)
    recipes = (
        ranged.withColumn("n", F.row_number().over(here) - 1)
        .withColumn("s", F.sum("n_tokens").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
        .join(before, "part")
        .select((F.col("row0") + F.col("n")).alias("row"), "doc_id", (F.col("start0") + F.col("s")).alias("start"), "n_tokens", "digests", "part")
    )
    recipes.repartitionByRange(ranges, "row").sortWithinPartitions("row").drop("part").write.option("compression", "zstd").parquet(f"{store.path}/recipes")
    nodes, level = _leaves(store.recipes(spark)), 0
    count = ranges * RANGE_ROWS
    while True:
        nodes, level, count = _up(nodes), level + 1, -(-count // FANOUT)
        nodes.select(F.lit(level).alias("level"), "node", "hash").write.mode("append").parquet(f"{store.path}/manifest")
        nodes = store.manifest(spark).filter(F.col("level") == level).select("node", "hash")
        if count <= 1 or nodes.limit(2).count() <= 1:
            return store


def verify_recipes(spark: SparkSession, store: Store) -> bool:
    """Whether recipes hash to the manifest at every level."""
    manifest, nodes = store.manifest(spark), _leaves(store.recipes(spark))
    for level in range(1, (manifest.agg(F.max("level")).first()[0] or 0) + 1):
        nodes = _up(nodes)
        there = manifest.filter(F.col("level") == level).select("node", F.col("hash").alias("there"))
        if nodes.join(there, "node", "full").filter("hash is null or there is null or hash != there").limit(1).count():
            return False
        nodes = there.withColumnRenamed("there", "hash")
    return True


def same_root(spark: SparkSession, store: Store) -> bool:
    """Whether recipes hash to the manifest's root, which stands for all levels."""
    top = store.manifest(spark).agg(F.max("level").alias("level"), F.max_by("hash", F.struct("level", "node")).alias("root")).first()
    nodes = _leaves(store.recipes(spark))
    for _ in range(top["level"] or 0):
        nodes = _up(nodes)
    return [r["hash"] for r in nodes.select("hash").limit(2).collect()] == ([] if top["root"] is None else [top["root"]])


def verify(spark: SparkSession, store: Store) -> bool:
    """Whether recipes hash to the manifest at every level, chunks to their digests, and every digest has its chunk."""
    chunks, recipes = store.chunks(spark), store.recipes(spark)
    if chunks.filter(F.unhex(F.sha2("ids", 256)) != F.col("digest")).limit(1).count():
        return False
    if recipes.select(F.explode("digests").alias("digest")).join(chunks, "digest", "left_anti").limit(1).count():
        return False
    return verify_recipes(spark, store)


def read(spark: SparkSession, store: Store) -> DataFrame:
    """The documents as their recipes put them together: doc_id, start, ids (array<long>)."""
    long = store.recipes(spark).select("row", "doc_id", "start", F.posexplode("digests").alias("pos", "digest"))
    whole = long.join(store.chunks(spark), "digest").groupBy("row", "doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("parts"))

    kind = f"<u{store.width}"

    @F.pandas_udf("array<long>")
    def join_ids(parts: pd.Series) -> pd.Series:
        return parts.map(lambda p: np.frombuffer(b"".join(x["ids"] for x in p), kind).astype(np.int64))

    return whole.select("doc_id", "start", join_ids("parts").alias("ids"))


# CRC-32 of joined strings: the left remainder times x**(8 n), plus the right one.
POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """a * b modulo the polynomial, bits reflected."""
    out, m = 0, 1 << 31
    while m:
        if a & m:
            out ^= b
        m >>= 1
        b = (b >> 1) ^ POLY if b & 1 else b >> 1
    return out


@lru_cache(1 << 14)
def _shift(n: int) -> int:
    """x**(8 n) modulo the polynomial."""
    out, base, k = 1 << 31, 1 << 23, n  # 1 and x**8
    while k:
        if k & 1:
            out = _times(out, base)
        base, k = _times(base, base), k >> 1
    return out


def crc_join(left: int, right: int, right_bytes: int) -> int:
    return _times(_shift(right_bytes), left) ^ right


def digest(spark: SparkSession, store: Store) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). Each stored chunk is read and checked
    once, where it lies; only its remainder travels to the recipes that name it, and
    the remainders of a recipe combine in order. Recipes must hash to the manifest's root, and
    their chunks must have as many ids as they say; else this raises."""
    if not same_root(spark, store):
        raise ValueError("recipes differ from the manifest")
    shape = _parse_datatype_string("digest binary, crc long, n int")
    names, kind = arrow_schema(shape), f"<u{store.width}"

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
            wrong = [k.hex() for k, p in zip(keys, parts, strict=True) if hashlib.sha256(p).digest() != k]
            if wrong:
                raise ValueError(f"chunks differ from their digests: {wrong[:3]}")
            crcs = [zlib.crc32(np.frombuffer(p, kind).astype("<u4").tobytes()) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, names[0].type), pa.array(crcs, names[1].type), pa.array([len(p) // int(kind[2:]) for p in parts], names[2].type)], schema=names)

    sums = store.chunks(spark).mapInArrow(crc, shape)
    long = store.recipes(spark).select("row", "doc_id", "start", "n_tokens", F.posexplode("digests").alias("pos", "digest"))
    whole = long.join(sums, "digest", "left").groupBy("row", "doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("pos", "crc", "n"))).alias("parts"), F.sum("n").alias("there"))
    wrong = F.raise_error(F.concat(F.lit("chunks are missing or of other lengths in recipe "), F.col("row").cast("string"))).cast("long")
    whole = whole.withColumn("n_tokens", F.when(F.col("there") == F.col("n_tokens"), F.col("n_tokens")).otherwise(wrong))

    @F.pandas_udf("long")
    def join_crc(parts: pd.Series) -> pd.Series:
        out = []
        for p in parts:
            crc = 0
            for x in p:
                crc = crc_join(crc, x["crc"], 4 * x["n"])
            out.append(crc)
        return pd.Series(out, dtype="int64")

    return whole.select("doc_id", "start", "n_tokens", join_crc("parts").alias("ids_crc32"))
