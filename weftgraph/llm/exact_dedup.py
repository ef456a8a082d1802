"""Exact dedup by composable polynomial fingerprints, with a chunkwise comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, materialize, row_key

#: Primes below 2**31, so that the product of two residues fits a long, and their bases.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 1 << 16
#: Documents from here on are hashed as chunk rows dealt over all tasks.
HUGE = 1 << 22
#: Members of one group that one task compares with a copy of the group's representative.
SALT_ROWS = 64


@lru_cache(8)
def _powers(base: int, modulus: int) -> np.ndarray:
    """base**(CHUNK-1) ... base**0."""
    out = np.ones(CHUNK, np.uint64)
    for i in range(CHUNK - 2, -1, -1):
        out[i] = int(out[i + 1]) * base % modulus
    return out


def chunk_hash(data: bytes, moduli=MODULI) -> tuple[int, ...]:
    """sum(byte * base**(n-1-i)) mod p; 65536 terms below 2**40 fit 64 bits exactly."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    return tuple(int((b * _powers(g, p)[CHUNK - len(b) :]).sum()) % p for g, p in zip(BASES, moduli, strict=True))


def combine(left: tuple[int, ...], right: tuple[int, ...], right_len: int, moduli=MODULI) -> tuple[int, ...]:
    """The hash of two joined byte strings: the left one shifted by the right one's length."""
    return tuple((a * pow(g, right_len, p) + b) % p for a, b, g, p in zip(left, right, BASES, moduli, strict=True))


def _lower(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() touches A-Z only


FIRST = "row binary, doc_id {id}, n_bytes long, h1 long, h2 long, text_sha256 string, chunk_no int, chunk binary"


def _first(schema, huge: int, moduli):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = _lower(text.as_py())
                sha = hashlib.sha256(data).hexdigest()
                if len(data) >= huge:
                    for k in range(0, len(data), CHUNK):
                        rows.append((row, doc_id, len(data), None, None, sha, k // CHUNK, data[k : k + CHUNK]))
                    held += len(data)
                else:
                    h = (0,) * len(moduli)
                    for k in range(0, len(data), CHUNK):
                        part = data[k : k + CHUNK]
                        h = combine(h, chunk_hash(part, moduli), len(part), moduli) if k else chunk_hash(part, moduli)
                    rows.append((row, doc_id, len(data), *h, sha, None, None))
                if held > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)

    return run


def _hash_chunks(schema, moduli):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            hs = [chunk_hash(x, moduli) for x in c["chunk"]]
            cols = [c["row"], c["doc_id"], c["n_bytes"], c["text_sha256"], c["chunk_no"], [h[0] for h in hs], [h[1] for h in hs]]
            cols += [[pow(g, len(x), p) for x in c["chunk"]] for g, p in zip(BASES, moduli, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, names, strict=True)], schema=names)

    return run


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", huge: int = HUGE, moduli=MODULI) -> DataFrame:
    """row, doc_id, n_bytes, h1, h2, text_sha256: one row per input row, written to the shared folder."""
    from pyspark.sql.types import _parse_datatype_string

    rows = docs.select(row_key(text, id_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = _parse_datatype_string(FIRST.format(id=kind))
    first = materialize(rows.mapInArrow(_first(schema, huge, moduli), schema), "fingerprints")
    small = first.filter("chunk is null").select("row", "doc_id", "n_bytes", "h1", "h2", "text_sha256")
    # A huge document's chunks are hashed wherever they are dealt to, and folded in order by shifted sums.
    mid = _parse_datatype_string(f"row binary, doc_id {kind}, n_bytes long, text_sha256 string, chunk_no int, h1 long, h2 long, p1 long, p2 long")
    chunks = first.filter("chunk is not null")
    hashed = chunks.repartition("row", "chunk_no").mapInArrow(_hash_chunks(mid, moduli), mid)
    # A repeated row brings its chunks again: each number once, and the copies counted.
    once = hashed.groupBy("row", "doc_id", "n_bytes", "text_sha256", "chunk_no").agg(F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.count(F.lit(1)).alias("copies"))
    parts = F.array_sort(F.collect_list(F.struct("chunk_no", "h1", "h2", "p1", "p2")))

    def fold(k: int):
        h, p, m = f"h{k}", f"p{k}", F.lit(moduli[k - 1])
        return F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: (a * x[p] + x[h]) % m).alias(h)

    large = once.groupBy("row", "doc_id", "n_bytes", "text_sha256").agg(parts.alias("parts"), F.max("copies").alias("copies"))
    large = large.select("row", "doc_id", "n_bytes", fold(1), fold(2), "text_sha256", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    return small.unionByName(large)


def _chunks(schema):
    """Chunk rows of the members' normalised texts."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            held = 0
            for row, rep, salts, text in zip(*(b.column(i) for i in range(4)), strict=True):
                row, rep, salts, data = row.as_py(), rep.as_py(), salts.as_py(), _lower(text.as_py())
                own = int.from_bytes(row[:7], "big") % salts
                for s in range(salts) if row == rep else (own,):
                    for k in range(0, max(1, len(data)), CHUNK):
                        out.append((rep, s, k // CHUNK, row, data[k : k + CHUNK]))
                        held += CHUNK if len(data) > CHUNK else len(data)
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)

    return run


def dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", huge: int = HUGE, moduli=MODULI) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; row (a key of id
    and text) and first (whether it is the group's first row, with null ids too).

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
    equal texts the row with the largest doc_id stays (null ids lose to all others);
    of rows with that id too, exactly one; a group of null ids alone keeps none here. Texts
    of any length are compared whole, in chunks dealt over tasks. Other columns are ignored;
    an empty table gives no rows.

    Length and two residues make a fingerprint. Every row of a group of equal
    fingerprints is then compared with the group's representative, chunk by chunk;
    rows that differ leave it and form groups of their own in another round, until
    all agree. Hot groups are dealt over salts, each with a copy of the representative.
    """
    from pyspark.sql.types import _parse_datatype_string

    numbered = fingerprints(docs, text, id_col, huge, moduli).withColumn("uid", F.monotonically_increasing_id())
    fp = materialize(numbered, "prints")
    key = ["n_bytes", "h1", "h2"]
    bodies = docs.select(row_key(text, id_col).alias("row"), F.col(text).alias("text"))
    moved = None  # (row, turn): rows whose fingerprint lies
    todo, turn = fp.select(*key, "row").distinct(), 0
    shape = _parse_datatype_string("rep binary, salt int, chunk_no int, row binary, chunk binary")
    while True:
        groups = todo.groupBy(*key).agg(F.max("row").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = todo.join(groups, key).select("row", *key, "rep", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts"))
        # Rows that are the same in id and text are compared once each; all agree.
        chunks = bodies.join(members, "row").select("row", "rep", "salts", "text").mapInArrow(_chunks(shape), shape)
        reps = chunks.filter("row = rep").select("rep", "salt", "chunk_no", F.col("chunk").alias("rep_chunk")).dropDuplicates(["rep", "salt", "chunk_no"])
        pairs = chunks.filter("row != rep").join(reps, ["rep", "salt", "chunk_no"])
        bad = pairs.filter("chunk != rep_chunk").select("row").distinct()
        bad = materialize(bad.join(members, "row").select(*key, "row"), "unequal")
        if bad.isEmpty():
            break
        turn += 1
        mark = bad.select("row", F.lit(turn).alias("turn"))
        moved = mark if moved is None else moved.unionByName(mark)
        todo = bad
    if moved is None:
        fp = fp.withColumn("turn", F.lit(0))
    else:
        moved = moved.groupBy("row").agg(F.max("turn").alias("turn"))
        fp = fp.join(moved, "row", "left").withColumn("turn", F.coalesce("turn", F.lit(0)))
    # Nulls are the least of all; of one id, the first row.
    groups = fp.groupBy(*key, "turn").agg(F.max(F.struct("doc_id", (-F.col("uid")).alias("uid"))).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    first = F.col("uid") == -F.col("stays.uid")
    return fp.join(groups, [*key, "turn"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (first & F.col("doc_id").isNotNull()).alias("kept"),
        "text_sha256", "row", first.alias("first"),
    )


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns. Of rows whose ids are all null none is
    the largest; one of them stays. Of repeated rows any one."""
    stays = dedup(docs, text, id_col).filter("first").select(F.col("row").alias("__weft_row"), (F.col("group_size") == 1).alias("__weft_plain"))
    kept = docs.withColumn("__weft_row", row_key(text, id_col)).join(materialize(stays, "stays"), "__weft_row")
    plain = kept.filter("__weft_plain").select(*docs.columns)
    # Copies are folded where they lie: one row of each task travels.
    one = kept.filter("not __weft_plain").groupBy("__weft_row").agg(F.first(F.struct(*(F.col(c) for c in docs.columns))).alias("one")).select("one.*")
    return plain.unionByName(one)


SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from d window w as (partition by t)"""
