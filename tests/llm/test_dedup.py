"""Exact dedup, substring dedup and the n-gram join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import ODD, words
from weftgraph.llm import exact_dedup, ngram_join, shingles, substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall((text or "").encode())


# --- exact ---------------------------------------------------------------------------


def brute_exact(rows):
    groups = defaultdict(list)
    for k, (d, t, *_) in enumerate(rows):
        groups[(t or "").encode().lower()].append((d, k))
    out = []
    for body, members in groups.items():
        ids = [d for d, _ in members if d is not None]
        keep, seen = max(ids, default=None), False
        for d, _ in members:
            kept = d is not None and d == keep and not seen
            seen |= kept
            out.append((d, keep, len(members), kept, hashlib.sha256(body).hexdigest()))
    return Counter(out)


def exact(df, **k):
    return Counter((r.doc_id, r.keep_id, r.group_size, bool(r.kept), r.text_sha256) for r in exact_dedup.dedup(df, **k).collect())


def test_exact_odd_rows(docs):
    assert exact(docs(ODD)) == brute_exact(ODD)


def test_exact_empty(docs):
    assert exact(docs([])) == Counter() and exact_dedup.keep_one(docs([])).count() == 0


def test_exact_huge_documents(docs):
    rnd = random.Random(1)
    big = "".join(rnd.choice("abcD ") for _ in range(200_000))
    rows = [(1, big), (2, big.upper()), (3, big[:-1] + "z"), (4, "small"), (4, "small")]
    assert exact(docs(rows), huge=100_000) == exact(docs(rows)) == brute_exact(rows)


def test_exact_with_lying_fingerprints(docs):
    rnd = random.Random(2)
    rows = [(k, "".join(rnd.choice("ab") for _ in range(5))) for k in range(80)]
    assert exact(docs(rows), moduli=(3, 2)) == brute_exact(rows)
    # Null ids, and several texts of one id, under equal fingerprints.
    rows = [(None, "ab"), (None, "cd"), (1, "ef"), (1, "kl"), (1, "AB"), (2, "cd"), (None, "kl"), (None, "kl"), (3, "ba"), (3, "ba"), (None, None), (4, "")]
    assert exact(docs(rows), moduli=(3, 2)) == brute_exact(rows)


def test_chunk_hashes_combine():
    rnd = np.random.default_rng(3)
    data = rnd.integers(0, 256, 5000, dtype=np.uint8).tobytes()
    whole = exact_dedup.chunk_hash(data)
    for cut in (0, 1, 2500, 5000):
        assert exact_dedup.combine(exact_dedup.chunk_hash(data[:cut]), exact_dedup.chunk_hash(data[cut:]), 5000 - cut) == whole


def test_exact_keep_one(docs):
    df = docs(ODD)
    got = exact_dedup.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got.collect() if r.doc_id is not None and r.text) == sorted((False, d, t) for d, t in {(4, "one"), (6, "zwei  wörter"), (3, " \t\n"), (7, "a\x00b \x1fc"), (8, ODD[7][1]), (9, "x" * 5000), (10, ODD[10][1]), (13, ODD[15][1])})
    assert got.filter("doc_id is null").count() == 1


# --- substring -------------------------------------------------------------------------


def brute_substring(rows, window):
    texts = [split(t) for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, *_), w in zip(rows, texts, strict=True):
        cut = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                cut.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in cut)
        out.append((d, len(w), len(cut), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def substring(df, window=35):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(df, window).collect())


@pytest.mark.parametrize("window", [8, 35])
def test_substring(docs, window):
    rnd = random.Random(window)
    passage = words(rnd, 60)
    rows = []
    for k in range(40):
        w = words(rnd, rnd.randrange(0, 120))
        if k % 3 == 0:
            at, n = rnd.randrange(len(w) + 1), rnd.randrange(window - 2, 61)
            w[at:at] = passage[:n] if k % 2 else passage[-n:]
        rows.append((k, "  ".join(w)))
    rows += [rows[5], (99, " ".join(["same"] * 80)), (98, " ".join(["a", "b"] * 30)), (97, rows[3][1] + " tail")]
    rows += ODD
    assert substring(docs(rows), window) == brute_substring(rows, window)


def test_substring_empty(docs):
    assert substring(docs([])) == Counter()


def test_levels():
    assert substring_dedup.levels(35) == [9, 18, 35]


# --- n-gram join -------------------------------------------------------------------------


def shingle_set(text):
    w = [x.lower() for x in split(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_join(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                up[find(i)] = find(j)
    least = defaultdict(list)
    for k, (d, *_) in enumerate(rows):
        least[find(k)].append(d)
    return Counter((d, len(sets[k]), d if not sets[k] else min((x for x in least[find(k)] if x is not None), default=None)) for k, (d, *_) in enumerate(rows))


def join(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect())


def near_copies(rnd, n=60):
    rows, passage = [], words(rnd, 50)
    for k in range(n):
        if rows and rnd.random() < 0.6:
            w = (rnd.choice(rows)[1]).split(" ")
            for _ in range(rnd.randrange(0, 1 + len(w) // 20)):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(1000)}"
        else:
            w = words(rnd, rnd.randrange(1, 150))
            if rnd.random() < 0.4:
                w += passage
        rows.append((k, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join(docs, seed):
    rows = near_copies(random.Random(seed)) + [(500 + (d or 400), t) for d, t in ODD] + [(None, "no id at all in this row"), (None, "no id at all in this row")]
    assert join(docs(rows)) == brute_join(rows)


@pytest.mark.parametrize("deal", [(2, 3), (10**6, 10**6)])
def test_join_deals_frequent_tokens(docs, monkeypatch, deal):
    monkeypatch.setattr(ngram_join, "DEAL", deal[0])
    monkeypatch.setattr(ngram_join, "GRID", deal[1])
    if deal[0] == 2:
        monkeypatch.setattr(ngram_join, "SETS_BYTES", 0)  # sets meet their pairs in shuffles
    rows = near_copies(random.Random(6), 80) + [(900 + k, " ".join(["common passage of quite a few words here"] * 2 + words(random.Random(k), 8))) for k in range(30)]
    assert join(docs(rows)) == brute_join(rows)


def test_pairs(docs):
    rows = near_copies(random.Random(8), 90) + [(300, near_copies(random.Random(8), 90)[5][1])]
    sets = {d: shingle_set(t) for d, t in rows}
    found, members = ngram_join.pairs(docs(rows))
    of = defaultdict(set)
    for r in members.collect():
        of[r.rid].add(r.doc_id)
    assert all(len({frozenset(sets[d]) for d in ds}) == 1 for ds in of.values())
    got = set()
    for r in found.collect():
        a, b = min(of[r.src]), min(of[r.dst])
        assert (r.shared, r.total) == (len(sets[a] & sets[b]), len(sets[a] | sets[b]))
        got.add(frozenset((a, b)))
    first = {}
    for d in sorted(sets):
        first.setdefault(frozenset(sets[d]), d)
    reps = sorted(d for s, d in first.items() if s)
    assert got == {frozenset((a, b)) for a in reps for b in reps if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}


def test_join_one_large_cluster(docs):
    rnd = random.Random(9)
    base = words(rnd, 120)
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rnd.randrange(0, 5)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10_000)}"
        rows.append((k, " ".join(w)))
    assert join(docs(rows)) == brute_join(rows)


def test_join_empty_and_keep_one(docs):
    assert join(docs([])) == Counter()
    assert ngram_join.keep_one(docs([])).count() == 0
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, "other words stand here"), (4, None), (5, ""), (4, None)]
    got = ngram_join.keep_one(docs(rows))
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text) == [(1, "a b c d e f g"), (3, "other words stand here")]
    assert got.filter("text is null or text = ''").count() == 3


def test_prefix_always_meets():
    """Sets that link share as many prefix elements as the smaller requirement, whatever the counts say."""
    rnd = np.random.default_rng(5)
    for _ in range(300):
        n = int(rnd.integers(4, 60))
        common = rnd.choice(10_000, n, replace=False).astype(np.uint64)
        x = np.unique(np.concatenate([common, rnd.integers(10_000, 20_000, int(rnd.integers(0, n // 4 + 1))).astype(np.uint64)]))
        y = np.unique(np.concatenate([common, rnd.integers(20_000, 30_000, int(rnd.integers(0, n // 4 + 1))).astype(np.uint64)]))
        if 100 * n < 75 * (len(x) + len(y) - n):
            continue
        df = {int(t): int(c) for t, c in zip(np.unique(np.concatenate([x, y])), rnd.integers(1, 9, len(x) + len(y)), strict=False)}
        (px, lx), (py, ly) = (ngram_join.prefix(s, np.array([df[int(t)] for t in s])) for s in (x, y))
        assert len({*x[px].tolist()} & {*y[py].tolist()}) >= min(lx, ly)


# --- kernels ---------------------------------------------------------------------------


def test_words_and_windows():
    import pyarrow as pa
    from weftgraph.llm.common import text_bytes

    rows = [t for _, t, *_ in ODD] + ["a  b\tc", "é\x0bz\x1fq", "end ", " begin"]
    data, off = text_bytes(pa.array(rows, pa.string()))
    b, e, f = shingles.words(data, off)
    assert [[bytes(data[b[k] : e[k]]) for k in range(f[i], f[i + 1])] for i in range(len(rows))] == [split(t) for t in rows]
    w = np.random.default_rng(0).integers(0, 40, 2000).astype(np.uint64)
    for n in (1, 2, 3, 5, 18, 35, 2000, 2001):
        for which in (0, 1):
            got = shingles.window_hashes(shingles.mix(w), n, which).tolist()
            assert len(got) == max(0, 2000 - n + 1)
            runs = [tuple(w[i : i + n].tolist()) for i in range(len(got))]
            assert len(set(runs)) == len(set(got)) == len(set(zip(runs, got, strict=True)))


def test_word_hashes_tell_words_apart():
    rnd = random.Random(4)
    held = {bytes(rnd.choices(b"abAB\x00\xff", k=rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200]))) for _ in range(3000)} | set(PATTERNS)
    body = b" ".join(held)
    data = np.frombuffer(body, np.uint8)
    begin, end, _ = shingles.words(data, np.array([0, len(body)]))
    for which in (0, 1):
        assert len(set(shingles.word_hashes(data, begin, end, which=which).tolist())) == len(held)
        folded = shingles.word_hashes(data, begin, end, True, which).tolist()
        assert len(set(folded)) == len({x.lower() for x in held}) == len(set(zip(folded, (x.lower() for x in held), strict=True)))


def pattern(n, flip):
    """Words over a and b that sums modulo a power of two, whatever their base, take for equal."""
    return bytes(97 + (k.bit_count() + flip) % 2 for k in range(n))


PATTERNS = [pattern(n, flip) for n in (16, 32, 64, 128, 1024, 2048, 65536) for flip in (0, 1)]


def test_patterned_words_differ(docs):
    x, y = pattern(1024, 0).decode(), pattern(1024, 1).decode()
    rest = " ".join(f"w{k}" for k in range(34))
    assert {r.n_removed for r in substring_dedup.dedup(docs([(1, f"{x} {rest}"), (2, f"{y} {rest}")])).collect()} == {0}
    assert {(r.doc_id, r.component_id) for r in ngram_join.join(docs([(1, x), (2, y), (3, x), (4, "x".join([y] * 3))])).collect()} == {(1, 1), (2, 2), (3, 1), (4, 4)}
    # Windows of two words in that order.
    xs, ys = (" ".join("ab"[c - 97] for c in pattern(64, flip)) for flip in (0, 1))
    rows = [(1, xs), (2, ys)]
    assert substring(docs(rows), 64) == brute_substring(rows, 64) and join(docs(rows)) == brute_join(rows)


def test_null_ids_of_text(spark):
    rows = [("a", None), (None, "a"), ("a", "a"), (None, None), ("", "a"), ("a", ""), ("b", "one two three four five six"), (None, "one two three four five six"), ("b", "other words")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert join(df) == brute_join(rows) and substring(df, 4) == brute_substring(rows, 4)
    got = ngram_join.keep_one(df).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([("a", None), ("", "a"), (None, None), ("a", ""), ("b", "one two three four five six"), ("b", "other words")])
