"""Toxicity by nearest labelled examples: exact cosine of TF-IDF, weighted by association, over a block-max inverted index."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_schema, id_text, materialize, slices, text_bytes

#: Labelled rows of each class that examples are learnt from, those of least hash. All their
#: words are terms, so the index holds at most the distinct words of 2 * SAMPLE texts.
SAMPLE = 4096
#: A term's weight is TF-IDF times the root of its likelihood ratio G2 with the label, of this at least.
LEAST_G2 = 1e-6
NEIGHBOURS = 15
BLOCK = 64
#: A term in one of so many examples, and no more than DENSE of them, has a weight for every
#: place of every block, so that a batch of texts meets them in one matrix product.
OFTEN, DENSE, BATCH = 32, 1024, 256
#: What single precision may be off by in a cosine.
SLACK = 2e-5
#: Weight that the share of toxic rows has among the votes.
PRIOR = 0.05
FOLDS = 5
#: Words of a text's own vector that stand beside its score.
SHOWN = 8
#: Words from so many bytes on stand under a digest.
LONG = 64
#: Terms whose counts travel in one row.
SLICE = 4096
#: Bytes of text whose words are looked up at once.
SPAN = 4 << 20

# Letters stay, A-Z folded; other ASCII ends a word.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BYTES = np.frombuffer(_TABLE, np.uint8)


def words(text: str | None) -> list[bytes]:
    out = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if out and max(map(len, out)) >= LONG:
        out = [w if len(w) < LONG else _digest(w) for w in out]
    return out


def _digest(word: bytes) -> bytes:
    return b"#" + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


class Vocabulary:
    """The numbers of words, looked up for whole columns of texts."""

    def __init__(self, numbers: dict[bytes, int]):
        self.numbers, self.column = numbers, pa.array(list(numbers), pa.binary())

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number, times) of the known words of texts data[offsets[i]:offsets[i + 1]], in
        the order of texts, then numbers; words are those of ``words``."""
        a, b = int(offsets[0]), int(offsets[-1])
        body = _BYTES[data[a:b]]
        full = body != 32
        letters = body[full]
        if not len(letters):
            return (np.zeros(0, np.int64),) * 3
        edge = full.copy()  # where a word begins
        np.greater(full[1:], full[:-1], out=edge[1:])
        inner = offsets[1:-1] - a
        inner = inner[inner < len(full)]
        edge[inner] = full[inner]
        begin = np.flatnonzero(edge)
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(np.searchsorted(begin, offsets - a)))
        wide = len(letters) >= 1 << 31
        cuts = np.append(np.flatnonzero(edge[full]), len(letters)).astype(np.int64 if wide else np.int32)
        del body, full, edge, begin  # work arrays are many times the text; lookups need room too
        found = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(text), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
        if len(text) * 8 < len(self.numbers):  # too few to hash the vocabulary for
            number = np.fromiter(map(self.numbers.get, found.to_pylist(), repeat(-1)), np.int32, len(text))
        else:
            number = np.array(pc.index_in(found, value_set=self.column.cast(found.type)).fill_null(-1))
            pa.default_memory_pool().release_unused()  # else the lookup's tables stay with the worker
        for i in np.flatnonzero(np.diff(cuts) >= LONG).tolist():
            number[i] = self.numbers.get(_digest(letters[cuts[i] : cuts[i + 1]].tobytes()), -1)
        known = number >= 0
        key = text[known].astype(np.int64) * len(self.numbers) + number[known]
        del text, number, known, found, letters, cuts
        key, times = np.unique(key, return_counts=True)
        return *np.divmod(key, max(1, len(self.numbers))), times


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (n[i] of them), one after the other."""
    ends = np.cumsum(n)
    out = np.repeat(first - ends + n, n)
    out += np.arange(len(out))
    return out


def _added(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """The sums of x at each of n places; without any x, bincount would give whole numbers."""
    return np.bincount(at, x, n).astype(np.float64, copy=False)


def _first(here: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k examples of greatest cosine, ties by example."""
    top = np.lexsort((here, -np.round(score, 12)))[:k]
    return here[top], score[top]


@dataclass
class Index:
    """Unit vectors of examples, by term: postings in the order of examples, cut into
    blocks, with the greatest weight in each. Only blocks that hold a term have an entry.
    Frequent terms fill their blocks instead. The weights stand by example too, to give exact
    cosines to what a search has found."""

    terms: dict[bytes, int]
    worth: np.ndarray  # of a term: its idf, and how much it tells of the label
    labels: np.ndarray
    ids: list
    cost: np.ndarray  # votes an example stands for: its class's rows over its sampled rows
    own_first: np.ndarray  # where each example begins in the next two, and one more
    own_term: np.ndarray
    own_weight: np.ndarray
    prior: float
    curve: tuple[float, float] = (1.0, 0.0)
    at: dict = field(default_factory=dict)  # the example of an id
    size: int = BLOCK
    times: np.ndarray | None = None  # how often each example has its terms
    shares: dict = field(default_factory=dict)
    known: Vocabulary | None = None  # of the terms; made where a text first needs it
    # Made by ``prepare`` where a search first needs them:
    column: np.ndarray | None = None  # of a frequent term in ``filled``; -1 for others
    filled: np.ndarray | None = None  # (blocks * size, frequent terms), in single precision
    often_first: np.ndarray | None = None  # where each example's frequent terms begin in the next two, and one more
    often_column: np.ndarray | None = None
    often_weight: np.ndarray | None = None  # in double precision
    example: np.ndarray | None = None  # postings of the others, by term, then example
    weight: np.ndarray | None = None
    first: np.ndarray | None = None  # the first entry of each term, and one more
    block: np.ndarray | None = None  # of an entry
    top: np.ndarray | None = None  # its greatest weight
    start: np.ndarray | None = None  # its first posting, and one more

    def __reduce__(self):
        """Travels as its words and the examples' counts, and is built again where it arrives."""
        return _again, (b" ".join(self.terms), self.worth, self.labels, self.ids, self.own_first, self.own_term, self.times, self.shares, self.prior, self.curve, self.size)

    def prepare(self) -> Index:
        """Cuts the examples into blocks; only tasks that search hold what this makes."""
        if self.filled is not None:
            return self
        term, weight = self.own_term, self.own_weight
        example = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.own_first))
        blocks = -(-len(self.ids) // self.size)
        many = np.bincount(term, minlength=len(self.terms))
        often = np.argsort(-many, kind="stable")[: min(DENSE, np.count_nonzero(many * OFTEN >= max(1, len(self.ids))))]
        self.column = np.full(len(self.terms), -1, np.int64)
        self.column[often] = np.arange(len(often))
        filled = np.zeros((blocks * self.size, len(often)), np.float32)
        mine = self.column[term] >= 0
        self.often_column, self.often_weight = self.column[term[mine]].astype(np.int32), weight[mine]
        self.often_first = np.searchsorted(example[mine], np.arange(len(self.ids) + 1))
        filled[example[mine], self.often_column] = self.often_weight
        order = np.flatnonzero(~mine)
        order = order[np.argsort(term[order], kind="stable")]
        term, self.example, self.weight = term[order], example[order], weight[order]
        block = self.example // self.size
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        start = np.flatnonzero(new)
        self.first = np.searchsorted(term[start], np.arange(len(self.terms) + 1))
        self.block = block[start]
        self.top = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0)
        self.start = np.append(start, len(term))
        self.filled = filled
        return self

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a text and their weights, of length 1 in all."""
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        return self.vectors(data, np.array([0, len(data)]))[0]

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same of each of the texts data[offsets[i]:offsets[i + 1]]; terms ascend."""
        if self.known is None:
            self.known = Vocabulary(self.terms)
        n = len(offsets) - 1
        text, rows, times = self.known.counts(data, offsets)
        v = (1 + np.log(times)) * self.worth[rows]
        v /= np.sqrt(np.bincount(text, v * v, n))[text]
        cuts = np.searchsorted(text, np.arange(n + 1)).tolist()
        return [(rows[i:j], v[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]

    def frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What frequent terms add to the cosine of each vector with each example."""
        self.prepare()
        by = np.zeros((len(vectors), self.filled.shape[1]), np.float32)
        for i, (rows, v) in enumerate(vectors):
            column = self.column[rows]
            mine = column >= 0
            by[i, column[mine]] = v[mine]
        return by @ self.filled.T

    def nearest(self, rows: np.ndarray, v: np.ndarray, k: int = NEIGHBOURS, without: int = -1, often: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above 0, exactly, ties by example. What frequent
        terms give is known for every example, so the k-th of that is a floor. A block's bound is
        the most that they give an example there, and the greatest weights of the other terms;
        blocks below the floor are left out. In the rest, what comes near the k-th cosine in
        single precision gets its exact one."""
        often = self.frequent([(rows, v)])[0] if often is None else often
        column = self.column[rows]
        rare = column < 0
        some, each = rows[rare], v[rare]
        first = self.first[some]
        n = self.first[some + 1] - first
        entry, each = _ranges(first, n), np.repeat(each, n)
        block = self.block[entry]
        bounds = often.reshape(-1, self.size).max(1, initial=0) + np.bincount(block, each * self.top[entry], len(often) // self.size)
        # One more than k, for an example that is left out itself.
        floor = np.partition(often, len(often) - k - 1)[len(often) - k - 1] - SLACK if len(often) > k else 0.0
        chosen = (bounds > 0) & (bounds >= floor)
        mine = np.flatnonzero(chosen[block])
        others = self._others(entry[mine], each[mine], len(often))
        blocks = np.flatnonzero(chosen)
        score = (others + often).reshape(-1, self.size)[blocks].ravel()
        if without >= 0 and chosen[without // self.size]:
            score[np.searchsorted(blocks, without // self.size) * self.size + without % self.size] = 0
        floor = np.partition(score, len(score) - k)[len(score) - k] - SLACK if len(score) > k else 0.0
        here = np.flatnonzero((score > 0) & (score >= floor))
        here = blocks[here // self.size] * self.size + here % self.size
        return _first(here, others[here] + self._often(column[~rare], v[~rare], here), k)

    def _others(self, entry: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
        """What some entries add to the cosine of each of n examples."""
        begin = self.start[entry]
        many = self.start[entry + 1] - begin
        post = _ranges(begin, many)
        return _added(self.example[post], np.repeat(v, many) * self.weight[post], n)

    def _often(self, column: np.ndarray, v: np.ndarray, here: np.ndarray) -> np.ndarray:
        """What frequent terms add to the cosines of some examples, in double precision."""
        dense = np.zeros(self.filled.shape[1])
        dense[column] = v
        begin = self.often_first[here]
        n = self.often_first[here + 1] - begin
        at = _ranges(begin, n)
        return _added(np.repeat(np.arange(len(here)), n), dense[self.often_column[at]] * self.often_weight[at], len(here))

    def raw(self, rows: np.ndarray, v: np.ndarray, without: int = -1, often: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """The share of toxic votes, each weighted by its similarity."""
        best, sims = self.nearest(rows, v, without=without, often=often)
        w = sims * self.cost[best]
        return float((w[self.labels[best] == 1].sum() + PRIOR * self.prior) / (w.sum() + PRIOR)), best, sims

    def votes(self, texts: pa.Array, without: list[int]) -> Iterator[tuple[float, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
        """What ``raw`` gives for each text, without an example of it (-1: none), and its vector.
        Words are looked up a column at a time, and frequent terms met a batch of texts at a time."""
        data, off = text_bytes(texts)
        for i, j in slices(off, SPAN):
            vectors = self.vectors(data, off[i : j + 1])
            for k in range(0, j - i, BATCH):
                some = vectors[k : k + BATCH]
                for at, own, often in zip(range(i + k, j), some, self.frequent(some), strict=False):
                    yield *self.raw(*own, without[at], often), own

    def score(self, raw: float) -> float:
        a, b = self.curve
        z = a * math.log(raw / (1 - raw)) + b if 0 < raw < 1 else (40.0 if raw >= 1 else -40.0)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


@lru_cache(1)
def _numbers(terms: bytes) -> dict[bytes, int]:
    return {w: k for k, w in enumerate(terms.split(b" "))} if terms else {}


def _again(terms: bytes, worth, labels, ids, first, own, times, shares, prior, curve, size) -> Index:
    numbers = _numbers(terms)
    cuts = first.tolist()
    examples = [(d, y, own[a:b], times[a:b]) for d, y, a, b in zip(ids, labels.tolist(), cuts, cuts[1:], strict=False)]
    out = build(numbers, worth, examples, shares, prior, size)
    out.curve = curve
    del examples, own, times
    out.prepare()
    # A search needs no more than that, and a task's index travels no further.
    out.own_term = out.own_weight = out.times = None
    return out


def build(terms: dict[bytes, int], worth: np.ndarray, examples: list[tuple], shares: dict[int, float], prior: float, size: int | None = None) -> Index:
    """An index of examples (id, label, terms, times); shares: rows of each class for one of the sample."""
    own = []
    for doc_id, label, rows, times in examples:
        v = (1 + np.log(times)) * worth[rows]
        own.append((rows, v / math.sqrt((v * v).sum()) if len(v) else v, label, doc_id, times))
    # Alike examples in one block make its bounds tight.
    own.sort(key=lambda x: (int(x[0][np.argmax(x[1])]) if len(x[0]) else len(terms), str(x[3])))

    def joined(k: int, kind: type) -> np.ndarray:
        return np.concatenate([x[k] for x in own]).astype(kind) if own else np.zeros(0, kind)

    return Index(
        terms, worth, np.array([x[2] for x in own], np.int64), [x[3] for x in own], np.array([shares[x[2]] for x in own]),
        np.cumsum([0, *(len(x[0]) for x in own)]), joined(0, np.int32), joined(1, np.float64), prior,
        at={x[3]: e for e, x in enumerate(own)}, size=size or BLOCK, times=joined(4, np.int32), shares=shares,
    )


def _platt(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    if not len(raw) or label.min() == label.max():
        return 1.0, 0.0
    x = np.clip(raw, 1e-6, 1 - 1e-6)
    x = np.log(x / (1 - x))
    n1, n0 = weight[label == 1].sum(), weight[label == 0].sum()
    y = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g, h = weight * (p - y), weight * p * (1 - p) + 1e-12
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * x).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - max(-2.0, min(2.0, step[0])), b - max(-2.0, min(2.0, step[1]))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), float(b)


def _g2(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """The likelihood ratio of (word, t toxic, c clean) against independence of word and label."""
    total, every = F.col("t") + F.col("c"), n1 + n0

    def cell(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    inside = cell(F.col("t"), total * n1 / every) + cell(F.col("c"), total * n0 / every)
    outside = cell(n1 - F.col("t"), (every - total) * n1 / every) + cell(n0 - F.col("c"), (every - total) * n0 / every)
    return counts.withColumn("g2", 2 * (inside + outside))


def _distinct_words(schema):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = sorted(set(words(text)))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([label] * len(own), pa.int32())], schema=names)

    return run


#: Min-hashes of an example's words, in bands: examples of one class that agree in a band are
#: copies, and one of them stays, lest words of a much copied text look like signs of its label.
HASHES, BANDS = 32, 4


def _bands(schema):
    names = arrow_schema(schema)
    rng = np.random.Generator(np.random.PCG64(7))
    by, plus = rng.integers(1, 1 << 31, HASHES, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 31, HASHES, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[int]] = [[] for _ in range(BANDS)]
            for text in b.column(2).to_pylist():
                own = np.array([zlib.crc32(w) for w in set(words(text))] or [0], np.uint64)
                least = np.array([((own * m + p) % np.uint64(2147483647)).min() for m, p in zip(by, plus, strict=True)])
                for k, band in enumerate(least.reshape(BANDS, -1)):
                    out[k].append(zlib.crc32(band.tobytes()) << 32 | zlib.adler32(band.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(names[0].type), b.column(1).cast(pa.int32()), *(pa.array([x & (1 << 63) - 1 for x in c], pa.int64()) for c in out)], schema=names)

    return run


def _one_of_copies(chosen: DataFrame) -> DataFrame:
    """Rows (doc_id, label, text) of the sample without near copies, the least id of each staying."""
    shape = _parse_datatype_string(f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, label int, {', '.join(f'b{k} long' for k in range(BANDS))}")
    left = materialize(chosen.select("doc_id", "label", "text").mapInArrow(_bands(shape), shape), "bands")
    for k in range(BANDS):
        left = left.groupBy("label", f"b{k}").agg(F.min_by(F.struct("doc_id", *(f"b{j}" for j in range(BANDS) if j != k)), "doc_id").alias("x")).select("label", f"b{k}", "x.*")
    return chosen.join(F.broadcast(left.select("doc_id")), "doc_id", "left_semi")


def _frequencies(schema, terms):
    """(slice, counts): in how many texts of a task each term is, packed by slices of the terms."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Vocabulary(_numbers(terms.value))
        counts = np.zeros(len(held.numbers), np.int64)
        for b in batches:
            data, off = text_bytes(b.column(0))
            for i, j in slices(off, SPAN):
                counts += np.bincount(held.counts(data, off[i : j + 1])[1], minlength=len(counts))
        parts = [(k // SLICE, counts[k : k + SLICE]) for k in range(0, len(counts), SLICE)]
        parts = [(k, c) for k, c in parts if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([c.astype("<i8").tobytes() for _, c in parts], pa.binary())], schema=names)

    return run


def _sums(schema):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held[k] = np.frombuffer(c, "<i8") + held[k] if k in held else np.frombuffer(c, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int32()), pa.array([c.tobytes() for c in held.values()], pa.binary())], schema=names)

    return run


def _packed(schema, terms):
    """Examples as the numbers of their terms and how often each comes."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _numbers(terms.value)
        for b in batches:
            own = [sorted((held[w], n) for w, n in Counter(words(t)).items()) for t in b.column(2).to_pylist()]
            pack = [[np.array([x[k] for x in o], "<i4").tobytes() for o in own] for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(names[0].type), b.column(1).cast(pa.int32()), *(pa.array(p, pa.binary()) for p in pack)], schema=names)

    return run


def _votes(schema, index):
    """Votes on the examples themselves, each without its own."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = index.value
        for b in batches:
            at = [x.at[d] for d in b.column(0).to_pylist()]
            raw = [r for r, _, _, _ in x.votes(b.column(1), at)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(raw, pa.float64())], schema=names)

    return run


def held_out(id_col: str = "doc_id"):
    return F.crc32(id_text(id_col).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> Index | None:
    """Learns from the labelled rows that are not held out; None without any.

    Examples are ``sample`` rows of each class at most, near copies among them dropped; all
    their words are terms, with document frequencies from all documents. Tasks read the texts
    and vote; the driver gets 8 bytes for each distinct word of an example, and the words. Null
    ids, null labels and labels without a document teach nothing; a label that is given twice
    counts as its greatest, a repeated id has one of its texts; null and empty texts are examples
    without terms; very long texts count whole; of rows that tie in the sample's hash, the
    least id goes first; other columns are ignored."""
    spark: SparkSession = docs.sparkSession
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("label"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    known = known.join(rows.select("doc_id"), "doc_id", "left_semi")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    taken = None
    for c in sizes:
        some = known.filter(F.col("label") == c).orderBy(*order).limit(sample)
        taken = some if taken is None else taken.unionByName(some)
    # At most two samples of ids: small enough for every task.
    chosen = materialize(rows.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text")), "sample")
    chosen = materialize(_one_of_copies(chosen).repartition(spark.sparkContext.defaultParallelism), "examples")
    n = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shape = _parse_datatype_string("word binary, label int")
    seen = chosen.select("label", "text").mapInArrow(_distinct_words(shape), shape)
    counts = seen.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    best = _g2(counts, n.get(1, 0), n.get(0, 0)).select("word", F.round("g2", 9).alias("g2")).toArrow()
    best = best.sort_by([("g2", "descending"), ("word", "ascending")])
    terms = {w: k for k, w in enumerate(best["word"].to_pylist())}
    shared = spark.sparkContext.broadcast(b" ".join(terms))
    shape = _parse_datatype_string("slice int, counts binary")
    parts = rows.select("text").mapInArrow(_frequencies(shape, shared), shape).repartition("slice").mapInArrow(_sums(shape), shape)
    df = np.zeros(len(terms))
    for r in parts.collect():
        c = np.frombuffer(r["counts"], "<i8")
        df[r["slice"] * SLICE : r["slice"] * SLICE + len(c)] = c
    idf = np.log((1 + rows.count()) / (1 + df)) + 1
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = _parse_datatype_string(f"doc_id {kind}, label int, terms binary, times binary")
    packed = chosen.select("doc_id", "label", "text").mapInArrow(_packed(shape, shared), shape).collect()
    examples = [(r["doc_id"], r["label"], np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["times"], "<i4")) for r in packed]
    # Terms that tell little of the label weigh little; they decide where a text has no others.
    tells = np.sqrt(np.maximum(best["g2"].to_numpy(), LEAST_G2))
    del best, packed
    index = build(terms, idf * tells, examples, {c: sizes[c] / n[c] for c in n}, sizes.get(1, 0) / sum(sizes.values()))
    # Platt's curve over leave-one-out votes, the sample weighted back to the rows it stands for.
    shape = _parse_datatype_string("e int, raw double")
    raws = np.zeros(len(examples))
    shared.unpersist()
    shared = spark.sparkContext.broadcast(index)
    for r in chosen.select("doc_id", "text").mapInArrow(_votes(shape, shared), shape).collect():
        raws[r["e"]] = r["raw"]
    shared.unpersist()
    index.curve = _platt(raws, index.labels, index.cost)
    return index


class _Scorer:
    """Votes on texts, with those of copies met before."""

    def __init__(self, index: Index):
        self.index, self.memo = index, {}

    def __call__(self, ids: list, texts: pa.Array) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its score, the neighbours and their cosines, and its terms of greatest
        weight. An example's own label takes no part in its score."""
        if len(self.memo) > 1 << 14:
            self.memo.clear()
        data, off = text_bytes(texts)
        cuts = off.tolist()
        keys = [(self.index.at.get(d, -1), hashlib.blake2b(data[i:j], digest_size=16).digest()) for d, i, j in zip(ids, cuts[:-1], cuts[1:], strict=True)]
        new = {k: i for i, k in enumerate(keys) if k not in self.memo}
        todo = texts.take(pa.array(new.values(), pa.int64())) if len(new) < len(keys) else texts
        for k, (raw, best, sims, (rows, v)) in zip(new, self.index.votes(todo, [e for e, _ in new]), strict=True):
            self.memo[k] = (self.index.score(raw), best, sims, rows[np.argsort(-v, kind="stable")[:SHOWN]])
        return [self.memo[k] for k in keys]


def score(docs: DataFrame, index: Index | None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, evidence (the nearest
    examples: doc_id, similarity, label), terms (the text's words of greatest weight, of equal
    ones those that tell most of the label).

    Null and empty texts, and texts without a term, have no neighbours and the score of
    the prior. Without an index every score is 0. Null ids are held out (their text is
    empty); repeated rows score alike; an example is scored without itself; of neighbours of
    equal cosine the first in the index count; very long texts are scored whole; other columns
    are ignored; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = _parse_datatype_string(f"doc_id {kind}, score double, evidence array<struct<doc_id {kind}, similarity double, label int>>, terms array<string>")
    names = arrow_schema(shape)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        scorer = _Scorer(x) if x else None
        none = (0.0, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        back = list(x.terms) if x else []
        for b in batches:
            ids = b.column(0).to_pylist()
            got = scorer(ids, b.column(1)) if scorer else [none] * len(ids)
            near = np.concatenate([g[1] for g in got]) if got else none[1]
            sims = np.concatenate([g[2] for g in got]) if got else none[2]
            cuts = pa.array(np.cumsum([0, *(len(g[1]) for g in got)]).astype(np.int32))
            item = names[2].type.value_type
            labels = x.labels[near] if x else near
            pairs = pa.StructArray.from_arrays([pa.array([x.ids[e] for e in near.tolist()], item[0].type), pa.array(sims), pa.array(labels.astype(np.int32))], fields=[item[0], item[1], item[2]])
            evidence = pa.ListArray.from_arrays(cuts, pairs).cast(names[2].type)
            terms = [[back[k].decode("utf-8", "replace") for k in g[3].tolist()] for g in got]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(names[0].type), pa.array([g[0] for g in got], pa.float64()), evidence, pa.array(terms, names[3].type)], schema=names)

    out = rows.mapInArrow(run, shape)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "evidence", "terms")


def keep_clean(docs: DataFrame, index: Index | None, least: float = 0.5, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows whose score is below ``least``, with all their columns; scores as ``score``
    gives them, nulls and the like included. Without an index all rows stay."""
    if index is None:
        return docs
    names = arrow_schema(docs.schema)
    at, who = docs.columns.index(text), docs.columns.index(id_col)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for b in batches:
            clean = [x[0] < least for x in scorer(b.column(who).to_pylist(), b.column(at))]
            yield pa.RecordBatch.from_arrays([b.column(i).cast(f.type) for i, f in enumerate(names)], schema=names).filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
