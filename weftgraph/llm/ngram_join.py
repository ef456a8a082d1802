"""Jaccard join of word-shingle sets by adaptive multi-match prefixes.

1. The corpus counts in how many documents each shingle occurs. A document links only
   if at least ``share`` of its shingles occur elsewhere; the others are done.
2. Documents with the same set are one class; one of them, the representative, goes on.
3. Shingles are ordered by their frequency among representatives, rare ones first. Two
   sets that link, of sizes with l-prefixes (all but the last ``least overlap - l``
   elements), share at least l elements of those prefixes; with different l, the
   smaller one. Each set takes the l for which the estimated cost, postings to read
   and candidates to verify, is least.
4. Rounds of pivots link most of each cluster at linear cost: per prefix shingle one
   pivot, per set the pivot it meets most often, each pair verified exactly.
5. Pairs across what is then connected, and only those, are counted in full: every pair
   with as many shared prefix elements as required is verified. An element counts for a
   pair only where their sizes leave room for the overlap behind it, and from the smaller
   set only in its shorter prefix.

Exact sets decide every link; pairs inside one component are not needed for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..operators.components import connected_components
from . import shingles
from .exchange import SENT, Packer, buckets_for, code, exchange
from .common import arrow_schema, materialize, release, row_key, slices, text_bytes

WORDS = 5
#: Similarity of 75 in 100.
NUM, DEN = 75, 100
SLICE_BYTES = 2 << 20
#: Cost of verifying one element of a candidate against reading one posting: most candidates
#: are in one component by the time they would be verified, so lengthening must be nearly free.
VERIFY = 0.0003
#: Postings of one token under one key, beside its pivots; and in a row or column of the grid of pairs.
DEAL, GRID = 256, 4096
#: Bytes of all representatives' sets up to which they are copied to every task.
SETS_BYTES = 16 << 20
ROUNDS = 6
#: Pivots of an element, and pivots that a set is verified with, in the second round; both grow from there.
PIVOTS, TRIES = 4, 6


def least_overlap(n: np.ndarray | int):
    """Elements of a set of n that any set it links with shares."""
    return -(-NUM * n // DEN)


def sets_of(data: np.ndarray, offsets: np.ndarray, words_per: int = WORDS) -> list[np.ndarray]:
    """Per text, its shingles' hashes, distinct and sorted."""
    begin, end, first = shingles.words(data, offsets)
    w = shingles.word_hashes(data, begin, end, fold=True)
    h = shingles.window_hashes(w, words_per)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words_per:
            out.append(np.unique(h[a : b - words_per + 1]))
        elif b > a:
            out.append(shingles.mix(shingles.window_hashes(w[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# --- Senders -----------------------------------------------------------------------


def _send_texts(schema, buckets: int, words_per: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(buckets, names)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for a, b in slices(off, SLICE_BYTES):
                for key, elements in zip(keys[a:b], sets_of(data, off[a : b + 1], words_per), strict=True):
                    yield from out.add(key, elements)
        yield from out.rest()

    return run


def _send_sets(schema, buckets: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(buckets, names)
        for batch in batches:
            for key, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from out.add(key.to_bytes(8, "big"), np.frombuffer(tokens.as_buffer(), "<u8").copy())
        yield from out.rest()

    return run


# --- Sets, prefixes, verification ---------------------------------------------------


def _sets(schema, words_per: int):
    """(row, doc_id, n, f1, f2, tokens) of (row, doc_id, text, hits): the set only of documents with enough shingles that occur elsewhere."""
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            hits = batch.column(3).fill_null(0).to_numpy()
            for a, b in slices(off, SLICE_BYTES):
                sets = sets_of(data, off[a : b + 1], words_per)
                n = np.array([len(s) for s in sets], np.int64)
                stay = (n > 0) & (hits[a:b] >= least_overlap(n))
                f = [(int(s.sum().view(np.int64)), int(shingles.mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum().view(np.int64))) if k else (None, None) for s, k in zip(sets, stay, strict=True)]
                tokens = [s.astype("<u8").tobytes() if k else None for s, k in zip(sets, stay, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(names[0].type), batch.column(1).slice(a, b - a).cast(names[1].type), pa.array(n), pa.array([x[0] for x in f], pa.int64()), pa.array([x[1] for x in f], pa.int64()), pa.array(tokens, pa.binary())], schema=names)

    return run


def prefix(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Indexes of the elements of a set's prefix, and how many of them a partner must share at least."""
    n = len(tokens)
    order = np.lexsort((tokens, counts))
    t = least_overlap(n)
    cost = np.cumsum(counts[order].astype(np.float64) - 1)
    need = np.arange(1, t + 1)
    postings = cost[n - t + need - 1]
    best = int(np.argmin(postings + postings / need * VERIFY * n))
    return order[: n - t + best + 1], best + 1


def _postings(schema, buckets: int):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, tokens, codes, counts in zip(*(batch.column(i) for i in range(4)), strict=True):
                if not codes.is_valid:
                    continue
                s = np.frombuffer(tokens.as_buffer(), "<u8")
                known, often = np.frombuffer(codes.as_buffer(), "<u8"), np.frombuffer(counts.as_buffer(), "<u4")
                mine = code(s, buckets)
                k = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                df = np.where(known[k] == mine, often[k], 1)
                at, need = prefix(s, df)
                pos = np.flatnonzero(df[at] > 1).astype(np.int32)
                at = at[pos]
                m = len(at)
                if m:
                    yield pa.RecordBatch.from_arrays([pa.array(s[at].view(np.int64)), pa.array(np.full(m, rid.as_py(), np.int64)), pa.array(np.full(m, len(s), np.int64)), pa.array(pos), pa.array(np.full(m, need, np.int32)), pa.array(df[at].astype(np.int64))], schema=names)

    return run


def _verify(schema):
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                k = np.minimum(np.searchsorted(x, y), len(x) - 1)
                same = int((x[k] == y).sum())
                if DEN * same >= NUM * (len(x) + len(y) - same):
                    out.append((a, b, same, len(x) + len(y) - same))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=names)

    return run


def verify(pairs: DataFrame, reps: DataFrame, small: bool = False) -> DataFrame:
    """(src, dst, shared, total) of the pairs (src, dst) whose sets link. ``small``: the sets
    were found to fit every task; else they meet the pairs in shuffles."""
    shape = _parse_datatype_string("src long, dst long, shared long, total long")
    x = reps.select(F.col("rid").alias("src"), F.col("tokens").alias("x"))
    y = reps.select(F.col("rid").alias("dst"), F.col("tokens").alias("y"))
    if small:
        both = pairs.join(F.broadcast(x), "src").join(F.broadcast(y), "dst")
    else:
        both = pairs.hint("merge").join(x, "src").join(y.hint("merge"), "dst")
    return both.select("src", "dst", "x", "y").mapInArrow(_verify(shape), shape)


def fits_tasks(reps: DataFrame) -> bool:
    """Whether all sets are small enough to go to every task."""
    return 8 * (reps.agg(F.sum("n")).first()[0] or 0) <= SETS_BYTES


def _may_link(x: str, y: str) -> str:
    """Whether two sets that share an element, at places pos and pos_ of their orders, may
    have it among the first of the shared ones that their sizes ask for: behind the l-th
    of them neither order has room for the overlap otherwise."""
    overlap = f"(({NUM} * ({x}n + {y}n) + {NUM + DEN - 1}) div {NUM + DEN})"
    return (
        f"{DEN} * least({x}n, {y}n) >= {NUM} * greatest({x}n, {y}n)"
        f" and least({x}n - {x}pos, {y}n - {y}pos) >= {overlap} - least({x}need, {y}need) + 1"
    )


#: Whether an element of the smaller of two sets can be one of those (the larger one has a longer prefix).
_OF_SMALLER = f"pos < n - ({2 * NUM} * n + {NUM + DEN - 1}) div {NUM + DEN} + need"


def merged(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """(id, component) after further links (src, dst): the parts so far take part as stars, not by the links that made them."""
    links_ = found.select("src", "dst")
    if parts is not None:
        links_ = links_.unionByName(parts.filter("id != component").select(F.col("id").alias("src"), F.col("component").alias("dst")))
    return materialize(connected_components(links_, written=True), "parts")


def _deals(size: int | None = None) -> Column:
    """Among how many keys the postings of a token are dealt: by how often it occurs."""
    return F.ceil(F.col("often") / (size or DEAL)).cast("int")


def _each(deals: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), deals - 1))


def _dealt(posts: DataFrame) -> DataFrame:
    return posts.withColumn("deal", F.pmod(F.xxhash64("rid"), _deals()).cast("int"))


def candidates(posts: DataFrame) -> DataFrame:
    """(src, dst) of pairs of different parts with as many common prefix elements as required.
    A token's postings meet on a grid, so that no task holds all of a frequent one."""
    sides = ("rid", "n", "pos", "need", "part")
    at, deals = F.pmod(F.xxhash64("rid", F.lit(1)), _deals(GRID)).cast("int"), _deals(GRID)
    small = posts.filter(_OF_SMALLER).select("token", *(F.col(c).alias(f"a_{c}") for c in sides), at.alias("i"), _each(deals).alias("j"))
    large = posts.select("token", *(F.col(c).alias(f"b_{c}") for c in sides), at.alias("j"), _each(deals).alias("i"))
    pairs = small.join(large, ["token", "i", "j"]).filter(f"(a_n < b_n or a_n = b_n and a_rid < b_rid) and a_part != b_part and {_may_link('a_', 'b_')}")
    met = pairs.groupBy(F.col("a_rid").alias("src"), F.col("b_rid").alias("dst")).agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("a_need", "b_need")).alias("required"))
    return met.filter("shared >= required").select("src", "dst")


def links(reps: DataFrame, posts: DataFrame) -> DataFrame | None:
    """(id, component) of the components that links make of the representatives; none without links."""
    parts: DataFrame | None = None
    spark = reps.sparkSession
    here = _dealt(posts).withColumn("part", F.col("rid"))
    small = fits_tasks(reps)

    def add(new: DataFrame) -> int:
        nonlocal parts
        new = materialize(new, "links")
        n = new.count()
        if n:
            parts = merged(parts, new)
        release(spark)
        return n

    def across() -> DataFrame:
        """Postings of the elements that several components have."""
        mixed = here.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.max("often").alias("often")).filter("low != high")
        return here.join(mixed.select("token", _each(_deals()).alias("deal")), ["token", "deal"])

    most = 0
    for turn in range(ROUNDS):
        # One pivot at first, while every set is a component of its own; then several. Each
        # stands beside every deal of its token's postings.
        salt = F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(PIVOTS * turn if turn else 1))
        lead = here.groupBy("token", salt).agg(F.min_by(F.struct("rid", "n", "pos", "need", "part"), F.xxhash64("part", "rid", F.lit(turn))).alias("lead"), F.max("often").alias("often"))
        met = here.join(lead.select("token", "lead", _each(_deals()).alias("deal")), ["token", "deal"]).filter(f"part != lead.part and {_may_link('', 'lead.')}")
        votes = met.groupBy(F.col("rid").alias("src"), F.col("lead.rid").alias("dst")).agg(F.count(F.lit(1)).alias("shared"))
        best = votes.groupBy("src").agg(F.slice(F.sort_array(F.collect_list(F.struct("shared", "dst")), False), 1, TRIES << (turn - 1) if turn else 1).alias("best"))
        best = best.select("src", F.explode("best.dst").alias("dst"))
        n = add(verify(best.select("src", "dst"), reps, small))
        most = max(most, n)
        if n:
            own = parts.withColumnsRenamed({"id": "rid", "component": "own"})
            here = here.join(own, "rid", "left").withColumn("part", F.coalesce("own", "rid")).drop("own")
        here = materialize(across(), "postings")
        release(spark)
        if n * 100 < most:
            break
    add(verify(candidates(here), reps, small))
    return parts


def _classes(docs: DataFrame, text: str, id_col: str, words_per: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets (row, doc_id, n, f1, f2), one representative (rid, n, f1, f2, tokens) of
    each set that may link, and the postings of the representatives' prefixes; all written."""
    rows = docs.select(row_key(text, id_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets_for(size // 6)
    sent = _parse_datatype_string(SENT)
    hits = exchange(rows.select("row", "text").mapInArrow(_send_texts(sent, buckets, words_per), sent), False, 16)
    # Repeated rows are told alike.
    hits = materialize(hits.groupBy(F.col("key").alias("row")).agg(F.max("hits").alias("hits")), "hits")
    release(docs.sparkSession)
    shape = _parse_datatype_string(f"row binary, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, f1 long, f2 long, tokens binary")
    whole = rows.join(hits.hint("merge"), "row", "left").select("row", "doc_id", "text", "hits")
    sets = materialize(whole.mapInArrow(_sets(shape, words_per), shape), "sets")
    release(docs.sparkSession)
    reps = sets.filter("tokens is not null").groupBy("n", "f1", "f2").agg(F.first("tokens").alias("tokens"))
    reps = materialize(reps.withColumn("rid", F.monotonically_increasing_id()), "reps")
    release(docs.sparkSession)
    total = reps.agg(F.sum("n")).first()[0] or 0
    buckets = buckets_for(total)
    known = exchange(reps.select("rid", "tokens").mapInArrow(_send_sets(sent, buckets), sent), True, 8)
    post = _parse_datatype_string("token long, rid long, n long, pos int, need int, often long")
    asked = reps.join(known.withColumn("rid", F.conv(F.hex("key"), 16, 10).cast("long")).hint("merge"), "rid").select("rid", "tokens", "codes", "counts")
    posts = materialize(asked.mapInArrow(_postings(post, buckets), post), "postings")
    release(docs.sparkSession)
    return sets.drop("tokens"), reps, posts


def join(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words_per: int = WORDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id; lead (whether it stays for its
    component), alone (its set can link with none), row (a key of id and text).

    Words are longest runs without space and the controls 9 to 13, A-Z folded; a set has
    the distinct runs of five words, or of all words where there are fewer. Sets without
    elements (null, empty and blank texts) link with nothing, each its own component.
    component_id is the least doc_id of the rows that links reach, null ids aside (a
    component of null ids alone has null). Repeated rows, and rows of equal sets, link, and
    repeated rows of the least doc_id are all its component's lead; of different texts with
    that id, the one of least key. Other columns are ignored; an empty table gives no rows.
    A text of any length gives its whole set, which one task holds (8 bytes a shingle).
    """
    sets, reps, posts = _classes(docs, text, id_col, words_per)
    parts = links(reps, posts)
    key = ["n", "f1", "f2"]
    member = reps.select("rid", *key)
    if parts is None:
        member = member.withColumn("part", F.col("rid"))
    else:
        member = member.join(parts.withColumnsRenamed({"id": "rid", "component": "part"}), "rid", "left").withColumn("part", F.coalesce("part", "rid"))
    # First the least row of each set, then of each component: joins see sets, not their many rows.
    some = sets.filter("f1 is not null")
    own = some.groupBy(*key).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
    held = materialize(member.join(own, key), "members")
    least = held.groupBy("part").agg(F.min("least").alias("first"))
    held = held.join(least, "part").select(*key, "first")
    is_lead = (F.col("row") == F.col("first.row")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    some = some.join(held.hint("merge"), key).select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), is_lead.alias("lead"), F.lit(False).alias("alone"), "row")
    rest = sets.filter("f1 is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("lead"), F.lit(True).alias("alone"), "row")
    return some.unionByName(rest)


def pairs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words_per: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """Every link between different sets, and what each set stands for: (src, dst, shared, total)
    with sizes of intersection and union, and (rid, doc_id), a row per input row with a set that
    may link. No pivots: all pairs that share as many prefix elements as required are verified, so
    a group of k sets that all link costs k * k / 2 verifications. Nulls and the like as in ``join``."""
    sets, reps, posts = _classes(docs, text, id_col, words_per)
    found = verify(candidates(posts.withColumn("part", F.col("rid"))), reps, fits_tasks(reps))
    members = sets.filter("f1 is not null").join(reps.select("rid", "n", "f1", "f2").hint("merge"), ["n", "f1", "f2"]).select("rid", "doc_id")
    return found, members


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns: of each component one row of least doc_id
    (null ids last; of repeated rows any one), and every row whose set links with nothing."""
    made = join(docs, text, id_col).filter("lead").groupBy("row", "alone").agg(F.count(F.lit(1)).alias("copies"))
    made = materialize(made, "stays")
    held = made.select(F.col("row").alias("__weft_row"), (F.col("alone") | (F.col("copies") == 1)).alias("__weft_plain"))
    kept = docs.withColumn("__weft_row", row_key(text, id_col)).join(held.hint("merge"), "__weft_row")
    plain = kept.filter("__weft_plain").select(*docs.columns)
    # Copies are folded where they lie: one row of each task travels.
    one = kept.filter("not __weft_plain").groupBy("__weft_row").agg(F.first(F.struct(*(F.col(c) for c in docs.columns))).alias("one")).select("one.*")
    return plain.unionByName(one)


SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i : least(i + 4, len(ws))], ' ') as sh
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, case when len(ws) > 0 then 2 else 1 end))) as i from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as x, b.doc_id as y, count(*) as o from s a join s b on a.sh = b.sh and a.doc_id != b.doc_id group by all),
e as (select x, y from o join n a on a.doc_id = x join n b on b.doc_id = y where 100 * o >= 75 * (a.n + b.n - o)),
r as (select x, y from e union select r.x, e.y from r join e on r.y = e.x)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(least(w.doc_id, (select min(y) from r where r.x = w.doc_id)), w.doc_id) as component_id
from w left join n using (doc_id)"""
