"""Substring dedup by level-wise doubling of repeated word windows.

A window of w words can only repeat if each piece of it does. The levels are w/4, w/2
and w words. At the first, one piece of each window is counted over the corpus: the one
with the least hash among the window's pieces, which equal windows choose alike, so that
a few per cent of all pieces are enough. Windows whose piece is alone are done. The rest
choose a piece of twice the length, and so on, until the piece is the window itself,
asked for by a digest of its words: what then repeats is removed, whatever else would be
left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from . import shingles
from .common import arrow_schema, materialize, release, row_key, slices, text_bytes
from .exchange import SENT, Packer, buckets_for, code, exchange, runs

WINDOW = 35
SLICE_BYTES = 2 << 20
#: Text in a block of candidate documents.
BLOCK_BYTES = 1 << 20


def levels(window: int) -> list[int]:
    """Lengths that double up to the window: 9, 18, 35 for 35."""
    return [-(-window // 4), -(-window // 2), window]


def _slide(x: np.ndarray, span: int, f) -> np.ndarray:
    """f over each run of ``span`` elements, by doubling."""
    done, n = 1, len(x) - span + 1
    while 2 * done <= span:
        x = f(x[:-done], x[done:])
        done *= 2
    return x[:n] if done == span else f(x[:n], x[span - done : span - done + n])


class Windows:
    """The windows of a slice of texts, by the index of their first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, strong: bool = False):
        self.data, self.window = data, window
        self.begin, self.end, self.first = shingles.words(data, offsets)
        self.words = shingles.word_hashes(data, self.begin, self.end)
        self.words2 = shingles.word_hashes(data, self.begin, self.end, which=1) if strong else None
        n = np.diff(self.first)
        left = np.repeat(self.first[1:], n) - np.arange(len(self.words))
        self.whole = left[: max(0, len(left) - window + 1)] >= window  # windows that end in their text

    def chosen(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each window's piece of ``length`` words, and the hashes of all pieces."""
        h = shingles.window_hashes(self.words, length)
        if len(self.whole) == 0:
            return h[:0], h
        return _slide(h, self.window - length + 1, np.minimum), h

    def places(self, length: int, windows: np.ndarray, least: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Indexes of the pieces that the marked windows choose: those whose hash is the
        greatest of the choices of the windows around them."""
        span = self.window - length + 1
        if not windows.any():
            return np.zeros(0, np.int64)
        best = np.zeros(len(windows) + 2 * (span - 1), np.uint64)
        best[span - 1 : span - 1 + len(windows)] = np.where(windows, least, 0)
        near = _slide(best, span, np.maximum)  # near[i]: over windows i - span + 1 to i
        held = np.zeros(len(windows) + 2 * (span - 1), np.uint8)
        held[span - 1 : span - 1 + len(windows)] = windows
        some = _slide(held, span, np.maximum)
        return np.flatnonzero((near == h[: len(near)]) & (some > 0))

    def removed(self, windows: np.ndarray) -> np.ndarray:
        """Words that a marked window covers."""
        step = np.zeros(len(self.words) + 1, np.int64)
        at = np.flatnonzero(windows)
        np.add.at(step, at, 1)
        np.add.at(step, at + self.window, -1)
        return np.cumsum(step[:-1]) > 0


def _in(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    if not len(held) or not len(x):
        return np.zeros(len(x), bool)
    held = np.sort(held)
    k = np.searchsorted(held, x)
    return held[np.minimum(k, len(held) - 1)] == x


def _first_requests(schema, window: int, buckets: int):
    """The chosen pieces of the first level, per text; one that a text chooses at several places, twice."""
    names = arrow_schema(schema)
    length = levels(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(buckets, names)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            row = batch.column(0).to_pylist()
            for a, b in slices(off, SLICE_BYTES):
                w = Windows(data, off[a : b + 1], window)
                least, h = w.chosen(length)
                at = w.places(length, w.whole, least, h)
                doc = np.searchsorted(w.first, at, "right") - 1
                order = np.lexsort((h[at], doc))
                doc, hs = doc[order], h[at][order]
                third = np.zeros(len(hs), bool)
                third[2:] = (doc[2:] == doc[:-2]) & (hs[2:] == hs[:-2])
                doc, hs = doc[~third], hs[~third]
                docs, begin = np.unique(doc, return_index=True)
                for key, own in zip([row[a + d] for d in docs.tolist()], np.split(hs, begin[1:]) if len(docs) else [], strict=True):
                    yield from out.add(key, own)
        yield from out.rest()

    return run


def _digest(words: Iterator[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _split(schema, window: int, buckets: int):
    """Rows (doc_id, text, codes alive at the first level): a document without a window
    left gives its result; the others go into blocks of bounded text."""
    names = arrow_schema(schema)
    length = levels(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[dict] = []
        size = 0

        def block() -> tuple:
            nonlocal number, held, size
            number += 1
            out = (number, held, None, None, None, None)
            held, size = [], 0
            return out

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)

        for batch in batches:
            ids, texts, alive = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            data, off = text_bytes(texts)
            for a, b in slices(off, SLICE_BYTES):
                rows: list[tuple] = []
                w = Windows(data, off[a : b + 1], window)
                least, _ = w.chosen(length)
                for i in range(a, b):
                    f0, f1 = int(w.first[i - a]), int(w.first[i - a + 1])
                    left = np.zeros(0, bool)
                    if alive[i] and f1 - f0 >= window:
                        left = _in(code(least[f0 : f1 - window + 1], buckets), np.frombuffer(alive[i], "<u8"))
                    if left.any():
                        held.append({"doc_id": ids[i], "text": texts[i].as_py(), "windows": np.packbits(left).tobytes()})
                        size += int(off[i + 1] - off[i])
                        if size >= BLOCK_BYTES:
                            rows.append(block())
                    else:
                        body = data[off[i] : off[i + 1]].tobytes()
                        rows.append((None, None, ids[i], f1 - f0, 0, _digest(body.split())))
                if rows:
                    yield batch_of(rows)
        if held:
            yield batch_of([block()])

    return run


class Block:
    """A block of candidate documents, and what the levels so far have left of their windows."""

    def __init__(self, row: dict, window: int):
        self.docs = row["docs"]
        data, self.off = text_bytes(pa.array([d["text"] for d in self.docs], pa.string()))
        self.w = w = Windows(data, self.off, window, strong=True)
        self.window = window
        self.left = np.zeros(len(w.whole), bool)
        for i, d in enumerate(self.docs):
            f0, n = int(w.first[i]), int(w.first[i + 1] - w.first[i]) - window + 1
            self.left[f0 : f0 + n] = np.unpackbits(np.frombuffer(d["windows"], np.uint8), count=n)
        self.left &= w.whole

    def ask(self, length: int, buckets: int) -> None:
        """The pieces that windows still left choose, in the order of (bucket, code, rest);
        a code ends in whether the block has the piece at several places. Whole windows are
        asked for by 128 bits of a digest of their words, not by a hash."""
        w = self.w
        self.last = length == self.window
        if self.last:
            at = np.flatnonzero(self.left)
            rest, h2 = self._digests(at)
        else:
            self.least, h = w.chosen(length)
            at = w.places(length, self.left, self.least, h)
            rest, h2 = h[at], shingles.window_hashes(w.words2, length, 1)[at]
        bucket, half = (h2 >> np.uint64(32)) % np.uint64(buckets), h2 & np.uint64(0x7FFFFFFF)
        order = np.lexsort((rest, half, bucket))
        bucket, half, more = bucket[order], half[order], rest[order]
        new = np.ones(len(more), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (half[1:] != half[:-1]) | (more[1:] != more[:-1])
        k = np.flatnonzero(new)
        many = np.diff(np.append(k, len(more))) > 1
        self.bucket, self.more = bucket[k].astype(np.int64), more[k]
        self.codes = (half[k] << np.uint64(1) | many).astype("<u4")
        self.at, self.which = at[order], np.cumsum(new) - 1

    def _digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two halves of a BLAKE2b digest of the words of each of some windows, joined by a space."""
        w = self.w
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        body = b" ".join(x for a, b in zip(self.off[:-1].tolist(), self.off[1:].tolist(), strict=True) for x in w.data[a:b].tobytes().split())
        end = np.cumsum(w.end - w.begin + 1) - 1
        begin = (end - (w.end - w.begin))[at].tolist()
        end = end[at + self.window - 1].tolist()
        view, make = memoryview(body), hashlib.blake2b
        out = np.frombuffer(b"".join(make(view[b:e], digest_size=16).digest() for b, e in zip(begin, end, strict=True)), "<u8").reshape(-1, 2)
        return out[:, 0], out[:, 1]

    def told(self, answers: list[dict] | None) -> None:
        """Drops the windows whose piece occurs nowhere else."""
        alive = np.zeros(len(self.more), bool)
        for x in answers or []:
            a, b = np.searchsorted(self.bucket, [x["bucket"], x["bucket"] + 1])
            alive[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=int(b - a))
        if self.last:
            self.left[self.at] = alive[self.which]
        else:
            self.left &= _in(self.least, self.more[alive])


def _block_after(row: dict, window: int, asked: list[int], buckets: list[int]) -> Block:
    """The block after the answers of the levels asked so far."""
    out = Block(row, window)
    for k, (length, n) in enumerate(zip(asked, buckets, strict=True)):
        out.ask(length, n)
        out.told(row[f"answers{k}"])
    return out


def _requests(schema, window: int, asked: list[int], buckets: list[int], length: int, n: int):
    """(at, bucket, codes, more): what a block asks at a level."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _block_after(row, window, asked, buckets)
                block.ask(length, n)
                used, begin = np.unique(block.bucket, return_index=True)
                cuts = np.append(begin, len(block.bucket)).tolist()
                parts = list(zip(cuts, cuts[1:], strict=False))
                if parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["block"]] * len(parts), pa.int64()), pa.array(used.astype(np.int32)), pa.array([block.codes[a:b].tobytes() for a, b in parts], pa.binary()), pa.array([block.more[a:b].tobytes() for a, b in parts], pa.binary())],
                        schema=names,
                    )

    return run


def _count(schema):
    """Per asker and bucket, a bit for each piece: whether it occurs twice or more in all."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 1):
            codes = np.concatenate([np.frombuffer(r["codes"], "<u4") for r in rows])
            more = np.concatenate([np.frombuffer(r["more"], "<u8") for r in rows])
            half, many = codes >> 1, (codes & 1).astype(bool)
            order = np.lexsort((more, half))
            half, more = half[order], more[order]
            same = (half[1:] == half[:-1]) & (more[1:] == more[:-1])
            twice = np.zeros(len(codes), bool)
            twice[1:] |= same
            twice[:-1] |= same
            out = np.empty(len(codes), bool)
            out[order] = twice
            out |= many
            at, bits = 0, []
            for r in rows:
                n = len(r["codes"]) // 4
                bits.append(np.packbits(out[at : at + n]).tobytes())
                at += n
            yield pa.RecordBatch.from_arrays([pa.array([r["at"] for r in rows], pa.int64()), pa.array([r["bucket"] for r in rows], pa.int32()), pa.array(bits, pa.binary())], schema=names)

    return run


def _results(schema, window: int, asked: list[int], buckets: list[int]):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _block_after(row, window, asked, buckets)
                w, gone = block.w, block.w.removed(block.left)
                out = []
                for i, d in enumerate(block.docs):
                    f0, f1 = int(w.first[i]), int(w.first[i + 1])
                    cut = gone[f0:f1]
                    body = w.data[block.off[i] : block.off[i + 1]].tobytes().split()
                    out.append((d["doc_id"], f1 - f0, int(cut.sum()), _digest(compress(body, (~cut).tolist()))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)

    return run


def dedup(docs: DataFrame, window: int = WINDOW, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    Words are longest runs without space and the controls 9 to 13. A word goes if a
    window of ``window`` words of one text that covers it starts at any other place of
    the corpus too; all windows are judged on the input. Null and empty texts have no words;
    repeated rows repeat each other's windows, and all lose them (no copy is spared, so ties
    need no rule); texts shorter than a window keep all; null ids are kept as they are; other
    columns are ignored; an empty table gives no rows. A text of any length is judged whole;
    a task holds one such text and about 60 bytes for each of its words.

    The first levels only rule windows out, by hashes; what is removed is decided by 128 bits
    of a BLAKE2b digest of the window's words themselves.
    """
    steps = levels(window)
    if window < 4:
        raise ValueError("a window has 4 words at least")
    spark = docs.sparkSession
    rows = docs.select(row_key(text, id_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    n_words = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    few = buckets_for(n_words // (window - steps[0]) * 2)
    sent = _parse_datatype_string(SENT)
    alive = exchange(rows.select("row", "text").mapInArrow(_first_requests(sent, window, few), sent), True, 16)
    # Repeated rows ask alike, and one answer serves them all.
    alive = materialize(alive.select(F.col("key").alias("row"), "codes"), "alive").dropDuplicates(["row"])
    release(spark)
    # What comes back grows with the corpus: the joins merge sorted sides at every size.
    joined = rows.join(alive.hint("merge"), "row", "left").select("doc_id", "text", "codes")
    shape = _parse_datatype_string(f"block long, docs array<struct<doc_id {kind}, text string, windows binary>>, doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
    split = materialize(joined.mapInArrow(_split(shape, window, few), shape), "split")
    release(spark)
    blocks = split.filter("block is not null").select("block", "docs")
    ask, tell = _parse_datatype_string("at long, bucket int, codes binary, more binary"), _parse_datatype_string("at long, bucket int, bits binary")
    asked: list[int] = []
    buckets: list[int] = []
    for k, length in enumerate(steps[1:]):
        n = buckets_for(n_words)
        wanted = blocks.mapInArrow(_requests(ask, window, asked, buckets, length, n), ask)
        told = wanted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count(tell), tell)
        told = materialize(told.groupBy(F.col("at").alias("block")).agg(F.collect_list(F.struct("bucket", "bits")).alias(f"answers{k}")), "answers")
        release(spark)
        blocks = blocks.join(told.hint("merge"), "block", "left")
        asked, buckets = [*asked, length], [*buckets, n]
    out = _parse_datatype_string(f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
    return split.filter("block is null").select(*out.names).unionByName(blocks.mapInArrow(_results(out, window, asked, buckets), out))


SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w),
x as (select doc_id, i, count(*) over (partition by array_to_string(ws[i : i + 34], ' ')) as n from p),
cut as (select distinct doc_id, unnest(range(i, i + 35)) as i from x where n > 1),
k as (select doc_id, list(i) as gone from cut group by doc_id)
select w.doc_id, len(ws) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(array_to_string(list_filter(ws, lambda v, i: gone is null or not list_contains(gone, i)), ' ')) as kept_sha256
from w left join k using (doc_id)"""
