"""Bounded-space online packing of documents into sequences of fixed length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from . import tokens
from .common import arrow_schema, materialize

#: Bytes of ids in a batch that goes back to Spark.
OUT_BYTES = 1 << 23
#: Tokens of leftovers that one merging task takes.
MERGE_TOKENS = 1 << 24
PIECE = "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, leftover boolean, ids binary"


class Windows:
    """Open windows by free space; bit f of ``mask`` says that one has f places free."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.mask, self.count = length, most, 0, 0
        self.by_free: list[list[list]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> list:
        window = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask ^= 1 << free
        self.count -= 1
        return window

    def _put(self, free: int, window: list) -> None:
        self.by_free[free].append(window)
        self.mask |= 1 << free
        self.count += 1

    def place(self, size: int, piece: tuple) -> list | None:
        """Puts a piece into the window that it fills best; returns a window that is done, if any."""
        done = None
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            window = self._take(free)
        else:
            if self.count >= self.most:
                done = self._take((self.mask & -self.mask).bit_length() - 1)
            free, window = self.length, []
        window.append(piece)
        if free == size:
            if done is None:
                return window
            self._put(0, window)  # goes out next: it is the fullest
        else:
            self._put(free - size, window)
        return done

    def rest(self) -> Iterator[list]:
        for windows in self.by_free:
            yield from windows


class _Out:
    """Rows of pieces, handed on in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, first: int):
        self.schema, self.next, self.rows, self.held = schema, first, [], 0

    def sequence(self, pieces: list[tuple], leftover: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), doc_tokens, self.next, offset, leftover, ids.astype("<u4").tobytes()))
            offset += len(ids)
            self.held += 4 * len(ids) + 64
        self.next += 1

    def batches(self, all_of_it: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_of_it or self.held >= OUT_BYTES):
            cols = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema, strict=True)], schema=self.schema)
            self.rows, self.held = [], 0


def _pack(schema, encode: Callable[[], Callable[[str], np.ndarray]], end_id: int, length: int, windows: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encode(), np.array([end_id], np.uint32)
        out, open_ = _Out(names, TaskContext.get().partitionId() << 33), Windows(length, windows)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([code(text or ""), end])
                n = len(ids)
                full = n - n % length
                for k in range(0, full, length):
                    out.sequence([(doc_id, k, ids[k : k + length], n)])
                if full < n and (done := open_.place(n - full, (doc_id, full, ids[full:], n))):
                    out.sequence(done)
                yield from out.batches()
        for window in open_.rest():
            out.sequence(window, sum(len(p[2]) for p in window) < length)
        yield from out.batches(True)

    return run


def _merge(schema, length: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(names, (1 << 62) + (TaskContext.get().partitionId() << 33))
        window: list[tuple] = []
        filled = 0
        for batch in batches:
            col = {f.name: batch.column(i).to_pylist() for i, f in enumerate(batch.schema)}
            for doc_id, start, doc_tokens, ids in zip(col["doc_id"], col["start"], col["doc_tokens"], col["ids"], strict=True):
                ids = np.frombuffer(ids, "<u4")
                while len(ids):
                    part, ids = ids[: length - filled], ids[length - filled :]
                    window.append((doc_id, start, part, doc_tokens))
                    start, filled = start + len(part), filled + len(part)
                    if filled == length:
                        out.sequence(window)
                        window, filled = [], 0
                yield from out.batches()
        if window:
            out.sequence(window)
        yield from out.batches(True)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = 1024, windows: int = 128, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids: doc_id, start, length,
    doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A document is its ids and ``end_id``; whole lengths become sequences of their own.
    What remains goes, in one pass over each partition, into the open window that it
    fills best; when none fits and ``windows`` are open, the fullest goes out. Windows
    still open at the end of the partitions are merged: their pieces are laid end to
    end and cut at each full length, in tasks of bounded size, so that at most one
    sequence a merging task is short.

    Null and empty texts are the end id alone; every row counts, repeated ones too; null ids
    are kept as they are; an empty table gives no pieces; other columns are ignored. A very long
    text is encoded in parts and packed whole; a task holds its ids. Of windows with equal
    room, which tie, the last one opened takes the piece. Padding is up to the reader: a
    sequence's length is the sum of its pieces' lengths.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    schema = _parse_datatype_string(PIECE.format(id=rows.schema["doc_id"].dataType.simpleString()))
    path = tokenizer
    placed = materialize(rows.mapInArrow(_pack(schema, lambda: tokens.byte_level(path), end_id, length, windows), schema), "packed")
    left = placed.filter("leftover")
    total = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // MERGE_TOKENS))
    merged = left.repartition(tasks, "doc_id", "start").sortWithinPartitions("doc_id", "start").mapInArrow(_merge(schema, length), schema)
    return placed.filter("not leftover").unionByName(merged).drop("leftover")
