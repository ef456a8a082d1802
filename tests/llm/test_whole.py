"""Registered queries against SQL and libraries, the pipeline against brute force, long texts and ids of text."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_rows import frame, words
from test_dedup import brute_exact, brute_join, brute_substring, shingle_set
from test_learning import LETTERS, brute_targets, dense, labelled
from test_tokens import BYTE, PIECE, WORD
from tools.oracle import value
from weftgraph.llm import exact_dedup, media, mixing, ngram_join, packing, queries, sharding, store, substring_dedup, token_counts, tokens, toxicity


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    mine = Counter(tuple(value(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(queries.oracle_sql()[name])
    at = {c: i for i, c in enumerate(rel.columns)}
    assert sorted(at) == cols
    assert mine == Counter(tuple(value(r[at[c]]) for c in cols) for r in rel.fetchall())


def texts_of(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def test_op1_query(spark, sf):
    library, texts = tokens._library(BYTE), texts_of(spark, sf)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
    pieces, held = defaultdict(list), defaultdict(list)
    for r in queries.op1_packing(spark, sf).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        held[r.sequence_id].append((r.offset, r.length))
    for spans, ends in ((pieces, {d: len(x) for d, x in ids.items()}), (held, None)):
        for k, parts in spans.items():
            at = 0
            for a, n in sorted(parts):
                assert a == at
                at += n
            assert at == ends[k] if ends else at <= 1024
    assert pieces.keys() == ids.keys() and len(held) <= sum(map(len, ids.values())) / 1024 * 1.05 + 2


def test_op4_op7_queries(spark, sf):
    library, texts = tokens._library(WORD), texts_of(spark, sf)
    at, want = 0, []
    for d in sorted(texts):
        ids = [*library.encode(texts[d] or "", add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_store(spark, sf).collect()) == want
    model = token_counts.Transducer(PIECE).model
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op7_token_counts(spark, sf).collect())
    assert got == sorted((d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in texts.items())


def test_op5_query(spark, sf):
    texts = texts_of(spark, sf)
    files = {r.doc_id: bytes(r.media) for r in media.store_text(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    same = defaultdict(set)
    for r in queries.op5_media(spark, sf).collect():
        body = (texts[r.doc_id] or "").encode()
        payload = body + b"\0" * (-len(body) % 64 or (0 if body else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(body), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:])
        assert (r.media_bytes, r.media_sha256) == (len(files[r.doc_id]), hashlib.sha256(files[r.doc_id]).hexdigest())
        frames = [tuple(map(int, x.split(":"))) for x in r.feature.split(";")]
        assert frames[0][0] == 0 and all(a + n == b for (a, n, _), (b, *_) in zip(frames, frames[1:], strict=False))
        assert sum(n for _, n, _ in frames) == -(-len(payload) // (64 * media.FRAME_BLOCKS))
        same[body].add((r.media_sha256, r.feature))
    assert all(len(x) == 1 for x in same.values())


def test_op6_query(spark, sf):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = texts_of(spark, sf)
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, sf).collect()}
    assert got.keys() == texts.keys()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for d, r in got.items())
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    index = toxicity.fit(docs, known)
    if len(index.ids) == sum(zlib.crc32(str(d).encode()) % 5 > 0 for d in labels):  # no copies among the examples
        want = dense(list(texts.items()), list(labels.items()), list(texts.items()))
        assert max(abs(got[d].score - want[d]) for d in got) < 1e-6


# --- Pipeline ---------------------------------------------------------------------------------


def key_of(doc_id) -> int:
    return int(hashlib.md5(f"mix:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16)


def brute_mix(rows):
    """(doc_id, text) as often as the mix takes them; the row at a source's cut with its first words."""
    sizes, own = defaultdict(int), defaultdict(list)
    for d, t, s in rows:
        sizes[s] += len(t.split())
        own[s].append((d, t))
    out = []
    for s, goal in brute_targets(sizes).items():
        left = int(goal + 1e-9)
        while left > 0:
            for d, t in sorted(own[s], key=lambda x: (key_of(x[0]), x[0], len(x[1].split()))):
                n = len(t.split())
                if left > 0 and n:
                    out.append((d, t if n <= left else " ".join(t.split()[:left])))
                    left -= min(n, left)
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    plain, labels = labelled(spark, 160, 11)
    rnd = random.Random(12)
    rows = [(d, t, rnd.choice("aab")) for d, t in plain]
    rows += [(500 + k, rows[k][1].upper(), "c") for k in range(20)] + [(600 + k, f"{rows[k][1]} more", "b") for k in range(20, 50)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    truth = [(r.doc_id, r.toxic) for r in labels.collect()]

    score = dense([r[:2] for r in rows], truth, [r[:2] for r in rows])
    assert min(abs(x - 0.5) for x in score.values()) > 1e-6
    left = [r for r in rows if score[r[0]] < 0.5]
    kept = {d for d, _, _, k, _ in brute_exact(left) if k}
    left = [r for r in left if r[0] in kept]
    kept = {d for d, _, c in brute_join(left) if d == c}
    left = [r for r in left if r[0] in kept]
    assert len(rows) > len(left) > 60
    library, want = tokens._library(BYTE), Counter()
    for d, t in brute_mix(left):
        want[d, tuple([*library.encode(t, add_special_tokens=False).ids, 0])] += 1

    total, pieces, sequences = Counter(), defaultdict(Counter), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert any(d == r.doc_id and list(x[r.start : r.start + r.length]) == ids and len(x) == r.doc_tokens for d, x in want)
        for k, i in enumerate(ids):
            pieces[r.doc_id][r.start + k, i, r.doc_tokens] += 1
        total[r.doc_id] += len(ids)
        sequences[r.sequence_id].append((r.offset, r.length))
    there = defaultdict(Counter)
    for (d, x), n in want.items():
        for k, i in enumerate(x):
            there[d][k, i, len(x)] += n
    assert pieces == there
    assert all(sum(n for _, n in s) <= 1024 for s in sequences.values())


# --- Long texts, ids of text ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def long_rows():
    """A text of 20 MB, the same in capitals, one that shares its first half, and a short one."""
    rnd = np.random.default_rng(5)
    names = np.array(["".join(w) for w in rnd.choice(list("abcdefghijklmnop"), (50_000, 6))])
    body = " ".join(names[rnd.integers(0, 50_000, 2_860_000)].tolist())
    half = body[: len(body) // 2].rsplit(" ", 1)[0]
    assert len(body) > 20_000_000
    return [(1, body), (2, body.upper()), (3, f"{half} " + " ".join(words(random.Random(6), 1000))), (4, "a short text")]


def long_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_long_text_exact_and_join(spark, long_rows):
    docs = long_docs(spark, long_rows)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(docs).collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (4, 1, True)}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    n = len(shingle_set(long_rows[0][1]))
    assert found[1] == found[2] == (n, 1) and found[3][1] == 3 and found[4] == (1, 4)
    assert {r.doc_id for r in ngram_join.keep_one(docs).collect()} == {1, 3, 4}


def test_long_text_substring(spark, long_rows):
    rows = [long_rows[0], long_rows[2], long_rows[3]]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(long_docs(spark, rows)).collect()}
    first, second = rows[0][1].split(), rows[1][1].split()
    shared = len(second) - 1000
    assert got[1][:2] == (len(first), shared) and got[3][:2] == (len(second), shared)
    assert got[1][2] == hashlib.sha256(" ".join(first[shared:]).encode()).hexdigest()


def test_long_text_tokens(spark, long_rows, tmp_path):
    rows = [long_rows[0], long_rows[3]]
    docs, text = long_docs(spark, rows), rows[0][1]
    pieces = packing.pack(docs, BYTE).filter("doc_id = 1").orderBy("start").select("length", "doc_tokens", "ids").collect()
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4")
    assert ids[-1] == 0 and len(ids) == pieces[0].doc_tokens and tokens._library(BYTE).decode(ids[:3000].tolist()) == text[: len(tokens._library(BYTE).decode(ids[:3000].tolist()))]
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PIECE).collect()}
    assert got[1] == (len(text), len(token_counts.Transducer(PIECE).model.encode(text)))
    made = store.write(docs, WORD, path=str(tmp_path / "s"))
    whole = {r.doc_id: r for r in store.digest(spark, made).collect()}
    want = np.append(tokens.word_end(WORD)(text), 1)
    assert whole[1].n_tokens == len(want) and whole[1].ids_crc32 == zlib.crc32(want.astype("<u4").tobytes())


def test_long_text_media_scores_mix_shards(spark, long_rows):
    rows = [(*long_rows[0], "s"), (*long_rows[3], "t")]
    docs, body = frame(spark, rows), rows[0][1].encode()
    read = media.read_media(media.store_text(docs)).selectExpr("doc_id", "octet_length(payload) n", "sha2(payload, 256) h").filter("doc_id = 1").first()
    payload = body + b"\0" * (-len(body) % 64)
    assert (read.n, read.h) == (len(payload), hashlib.sha256(payload).hexdigest())
    known = [(10 + k, " ".join(x.translate(LETTERS) for x in words(random.Random(k), 30)) + " vile" * (k % 2)) for k in range(30)]
    index = toxicity.fit(frame(spark, [*known, *rows]), spark.createDataFrame([(d, d % 2) for d, _ in known], "doc_id long, toxic int"))
    assert {r.doc_id: r.predicted for r in toxicity.score(docs, index).collect()}.keys() == {1, 4}
    assert toxicity.keep_clean(docs, index).count() == 2
    sizes = {r.doc_id: r.size for r in mixing.mix(docs).collect()}
    assert sizes == {1: 2_860_000, 4: 3}
    assert {r.doc_id: (r.size, r.text_crc32) for r in sharding.assign(docs, sharding.topology(40)).collect()}[1] == (len(body) + 16, zlib.crc32(body))


def test_ids_of_text(spark, tmp_path):
    """Every operator takes ids of text, nulls among them."""
    rnd = random.Random(3)
    rows = [(f"d{k:02d}" if k % 9 else None, " ".join(x.translate(LETTERS) for x in words(rnd, rnd.randrange(0, 60), 80)) if k % 7 else None) for k in range(40)]
    rows += [rows[5], rows[9], ("d05", "another text of this id")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").selectExpr("doc_id", "text", "'s' as source")
    ids = Counter(d for d, _ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, bool(r.kept), r.text_sha256) for r in exact_dedup.dedup(docs).collect()) == brute_exact(rows)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(docs).collect()) == brute_substring(rows, 35)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()) == brute_join(rows)
    labels = spark.createDataFrame([(d, k % 2) for k, d in enumerate(sorted(x for x in ids if x))], "doc_id string, toxic int")
    for out in (token_counts.count_tokens(docs, PIECE), toxicity.score(docs, toxicity.fit(docs, labels)), mixing.mix(docs), sharding.assign(docs, sharding.topology(40)), media.read_media(media.store_text(docs)), store.digest(spark, store.write(docs, WORD, path=str(tmp_path / "s")))):
        assert Counter(r.doc_id for r in out.select("doc_id").collect()) == ids
    assert {r.doc_id for r in packing.pack(docs, BYTE).collect()} == set(ids)
