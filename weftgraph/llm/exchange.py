"""A counting exchange of packed hashes.

Elements travel as 32 bits in a bucket that the other bits choose, packed per batch of
documents and bucket, and only what the asker needs comes back: a few bytes an element,
with no key that a frequent element could make hot. As buckets grow in number with the
elements, the share of elements that seem to meet another one by chance stays the same;
askers use the answers where nothing but cost depends on that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_schema

#: Elements that one bucket holds; more, up to the second number, once there are MANY buckets.
BUCKET, LARGE_BUCKET, MANY = 1 << 19, 1 << 25, 1 << 16


def buckets_for(elements: int) -> int:
    """Buckets for so many elements: enough that one fits a task, few enough that what a
    batch sends to each stays worth a row."""
    n = max(64, elements // BUCKET)
    return n if n <= MANY else max(MANY, elements // LARGE_BUCKET)

SENT = "batch long, bucket int, codes binary, docs binary, keys binary"
BACK = "batch long, bucket int, docs binary, codes binary, counts binary, keys binary"


def code(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of each hash in one number."""
    return ((h >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def pack(number: int, keys: list[bytes], sets: list[np.ndarray], buckets: int, names: pa.Schema) -> pa.RecordBatch:
    codes = code(np.concatenate(sets), buckets) if sets else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    bucket = (codes >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    codes, doc, bucket = codes[order].astype(np.uint32), doc[order], bucket[order]
    used, begin = np.unique(bucket, return_index=True)
    ends = np.append(begin, len(codes)).astype(np.int32)
    n = len(used)

    def blobs(x: np.ndarray) -> pa.Array:
        off = np.concatenate([ends * x.itemsize, ends[-1:] * x.itemsize]).astype(np.int32) if n else np.zeros(2, np.int32)
        return pa.Array.from_buffers(pa.binary(), n + 1, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(x.tobytes())])

    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n + 1, number, np.int64)), pa.array(np.append(used, number % buckets).astype(np.int32)), blobs(codes), blobs(doc), pa.array([None] * n + [b"".join(keys)], pa.binary())],
        schema=names,
    )


class Packer:
    """Packs documents' sets, under keys of equal length, once they hold enough elements for every bucket to get some."""

    def __init__(self, buckets: int, names: pa.Schema):
        self.buckets, self.names = buckets, names
        self.number = TaskContext.get().partitionId() << 32
        self.enough = max(1 << 18, min(1 << 22, 32 * buckets))
        self.keys: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.held = 0

    def add(self, key: bytes, elements: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(key)
        self.sets.append(elements)
        self.held += len(elements)
        if self.held >= self.enough or len(self.keys) == 1 << 16:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.keys:
            yield pack(self.number, self.keys, self.sets, self.buckets, self.names)
            self.number, self.keys, self.sets, self.held = self.number + 1, [], [], 0


def runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[dict]]:
    """Rows of sorted batches, a list for each value of a column."""
    held: list[dict] = []
    name = None
    for batch in batches:
        name = name or batch.schema.names[key]
        for row in batch.to_pylist():
            if held and held[0][name] != row[name]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _count(schema, full: bool):
    """Per bucket, the elements that occur twice or more: how many each document has, or which and how often."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [(k, None, None, None, v.astype("<u4").tobytes(), None) for k, v in hits.items()]
            hits.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)

        for rows in runs(batches, 1):
            out = [(r["batch"], None, None, None, None, r["keys"]) for r in rows if r["keys"] is not None]
            rows = [r for r in rows if r["codes"]]
            if rows:
                codes = np.concatenate([np.frombuffer(r["codes"], "<u4") for r in rows])
                _, back, counts = np.unique(codes, return_inverse=True, return_counts=True)
                counts, at = counts[back].astype(np.uint32), 0
                for r in rows:
                    docs = np.frombuffer(r["docs"], "<u2")
                    mine = counts[at : at + len(docs)]
                    at += len(docs)
                    twice = mine > 1
                    if not twice.any():
                        continue
                    if full:
                        own = codes[at - len(docs) : at]
                        out.append((r["batch"], r["bucket"], docs[twice].tobytes(), own[twice].tobytes(), mine[twice].tobytes(), None))
                    else:
                        add = np.bincount(docs[twice])
                        old = hits.get(r["batch"], add[:0])
                        total = np.zeros(max(len(add), len(old)), np.int64)
                        total[: len(add)] += add
                        total[: len(old)] += old
                        held += total.nbytes - old.nbytes
                        hits[r["batch"]] = total
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)
            if held > 1 << 25:
                yield flush()
                held = 0
        if hits:
            yield flush()

    return run


def _answer(schema, full: bool, width: int):
    """What came back for the documents of each batch, by document."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 0):
            joined = b"".join(r["keys"] for r in rows if r["keys"] is not None)
            keys = [joined[i : i + width] for i in range(0, len(joined), width)]
            rows = [r for r in rows if r["keys"] is None]
            if not full:
                total = np.zeros(len(keys), np.int64)
                for r in rows:
                    part = np.frombuffer(r["counts"], "<u4")
                    total[: len(part)] += part
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in some.tolist()], pa.binary()), pa.array(total[some])], schema=names)
            elif rows:
                doc = np.concatenate([np.frombuffer(r["docs"], "<u2") for r in rows])
                codes = np.concatenate([np.frombuffer(r["codes"], "<u4").astype(np.uint64) | np.uint64(r["bucket"] << 32) for r in rows])
                count = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows])
                order = np.lexsort((codes, doc))
                doc, codes, count = doc[order], codes[order], count[order]
                used, begin = np.unique(doc, return_index=True)
                cuts = np.append(begin, len(doc)).tolist()
                parts = [(codes[a:b].tobytes(), count[a:b].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in used.tolist()], pa.binary()), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], schema=names)

    return run


def exchange(sent: DataFrame, full: bool, width: int) -> DataFrame:
    """Answers by document, under keys of ``width`` bytes."""
    back = _parse_datatype_string(BACK)
    out = _parse_datatype_string("key binary, codes binary, counts binary" if full else "key binary, hits long")
    counted = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count(back, full), back)
    return counted.repartition("batch").sortWithinPartitions("batch").mapInArrow(_answer(out, full, width), out)
