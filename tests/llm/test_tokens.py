"""Tokenizers, packing, the token store and token counts against the libraries themselves."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import ODD, words
from weftgraph.llm import packing, store, token_counts, tokens

BYTE, WORD, PIECE = (tokens.vocabulary(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ALPHABET = " \n\t'sdtrevml.,!?0123456789abcABCéßüñÑÆøΣσſ½²<>|_-ªº̀’中文字日本語 \u0085\x1c\x00İı▁͸🙂"
SPECIAL = ["<|endoftext|>x y", "a<|startoftext|>b", "x" * 30_000, "it's 'sabc don't\"'s we'll'LL", " " * 5000 + "a", "", "abc" * 4000 + " d", "中文字日本語" * 500, "<s>a</s> <unk> <0x0A>"]


@pytest.mark.parametrize(("make", "path"), [(tokens.byte_level, BYTE), (tokens.word_end, WORD)])
def test_same_ids(make, path):
    fast, library = make(path), tokens._library(path)

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=60), st.text(ALPHABET, max_size=80)))
    def same(text):
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids

    same()
    for text in SPECIAL:
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_are_the_models():
    t = token_counts.Transducer(PIECE)
    rnd = random.Random(1)
    texts = SPECIAL + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(80))) for _ in range(1500)]
    want = [len(x) for x in t.model.encode(texts)]
    assert t.counts(texts).tolist() == want
    small = token_counts.Transducer(PIECE, table_bytes=1 << 20)
    assert small.counts(texts).tolist() == want

    @settings(max_examples=200, deadline=None)
    @given(st.text(max_size=60))
    def same(text):
        assert t.counts([text])[0] == len(t.model.encode(text))

    same()


@pytest.mark.parametrize(("chunk", "warm", "turns"), [(64, 8, 64), (16, 4, 64), (32, 0, 64), (32, 1, 0), (1024, 48, 64)])
def test_heads_compose(monkeypatch, chunk, warm, turns):
    """Texts without resets, whose chunks' maps must meet, however bad the guesses are."""
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "WARM", warm)
    monkeypatch.setattr(token_counts, "TURNS", turns)
    t, rnd = token_counts.Transducer(PIECE), random.Random(chunk)
    texts = ["".join(rnd.choice("ab 中文ée▁xyz") for _ in range(rnd.randrange(400))) for _ in range(100)]
    texts += ["x" * 3900, "ab" * 1700, "".join(rnd.choice("中文字日本語的一是") for _ in range(5000)), "", "a", "a b " + "c" * 2500 + " d"]
    assert t.counts(texts).tolist() == [len(t.model.encode(x)) for x in texts]


def test_text_without_blanks_is_no_slower():
    import time

    t, rnd = token_counts.Transducer(PIECE), random.Random(2)
    plain = "".join(rnd.choice("中文字日本語的一是不了人我在有他") for _ in range(700_000))
    spaced = "".join(c + " " * (rnd.random() < 0.2) for c in plain)
    took = []
    for x in (plain, spaced):
        t.counts([x])
        began = time.perf_counter()
        assert t.counts([x])[0] == len(t.model.encode(x))
        took.append(time.perf_counter() - began)
    assert took[0] < 5 * took[1] + 1


def test_count_tokens(docs):
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs(ODD), PIECE, limit=20).collect()}
    m = token_counts.Transducer(PIECE).model
    assert got == {(d, len((t or "").encode())): (n := len(m.encode(t or "")), n > 20) for d, t in ODD}
    assert token_counts.count_tokens(docs([]), PIECE).count() == 0


def rows_of(seed):
    rnd = random.Random(seed)
    return ODD + [(1000 + k, " ".join(words(rnd, rnd.randrange(0, 900)))) for k in range(40)]


def check_pieces(rows, pieces, length, slack):
    library = tokens._library(BYTE)
    want = defaultdict(list)
    for d, t, *_ in rows:
        want[d].append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    sequences, got = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id].append((r.start, ids, r.doc_tokens))
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert 0 < at <= length
    for d, texts in want.items():
        if len(texts) == 1:
            assert sum((ids for _, ids, _ in sorted(got[d])), []) == texts[0]
        assert sum(len(ids) for _, ids, _ in got[d]) == sum(map(len, texts))
    total = sum(len(x) for texts in want.values() for x in texts)
    assert len(sequences) <= total / length * slack + 2


@pytest.mark.parametrize("windows", [1, 128])
def test_packing(docs, windows):
    rows = rows_of(3)
    check_pieces(rows, packing.pack(docs(rows), BYTE, length=64, windows=windows).collect(), 64, 1.1 if windows > 1 else 2)
    check_pieces(rows, packing.pack(docs(rows), BYTE, windows=windows).collect(), 1024, 1.1 if windows > 1 else 2)


def test_packing_empty(docs):
    assert packing.pack(docs([]), BYTE).count() == 0


def test_best_fit():
    w = packing.Windows(10, 2)
    assert w.place(6, ("a",)) is None and w.place(7, ("b",)) is None
    assert w.place(3, ("c",)) == [("b",), ("c",)]  # fills the fullest that it fits
    assert w.place(9, ("d",)) is None
    assert w.place(5, ("e",)) == [("d",)]  # none fits: the fullest goes


def test_store(spark, docs, tmp_path):
    rows = rows_of(5)
    made = store.write(docs(rows), WORD, path=str(tmp_path / "s"))
    library = tokens._library(WORD)
    ids = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    want, at = [], 0
    for d, x in ids:
        want.append((d, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in store.digest(spark, made).collect()), key=lambda r: r[1])
    assert got == want
    back = sorted(store.read(spark, made).collect(), key=lambda r: r.start)
    assert [(r.doc_id, list(r.ids)) for r in back] == ids
    assert store.verify(spark, made)
    assert made.chunks(spark).count() < sum(len(store.cuts(np.array(x, np.uint32))) for _, x in ids)
    # A recipe that is changed no longer hashes to its manifest.
    bad = store.Store(str(tmp_path / "t"))
    made.chunks(spark).write.parquet(f"{bad.path}/chunks")
    made.manifest(spark).write.parquet(f"{bad.path}/manifest")
    made.recipes(spark).selectExpr("row", "doc_id", "start + 1 as start", "n_tokens", "digests").write.parquet(f"{bad.path}/recipes")
    assert not store.verify(spark, bad)


def wide_tokenizer(path, n=70_000):
    """A word-level vocabulary beyond 16 bits, in the file format of word_bpe_49k.json."""
    import json

    spec = json.load(open(WORD, encoding="utf-8"))
    top = max(spec["model"]["vocab"].values())
    spec["model"]["vocab"] |= {f"wide{k}</w>": k for k in range(top + 1, n)}
    path.write_text(json.dumps(spec), encoding="utf-8")
    return str(path)


def test_store_takes_wide_ids(spark, docs, tmp_path):
    path = wide_tokenizer(tmp_path / "wide.json")
    assert store.id_width(WORD, 1) == 2 and store.id_width(path, 1) == 4 and store.id_width(WORD, 1 << 16) == 4
    rows = [(1, "some words"), (2, None)]
    made = store.write(docs(rows), path, path=str(tmp_path / "s"), end_id=69_999)
    assert store.open_store(spark, made.path).width == 4 and store.verify(spark, made)
    assert [r.ids[-1] for r in store.read(spark, made).collect()] == [69_999, 69_999]
    want = {d: zlib.crc32(np.array([*tokens.word_end(path)(t or "").tolist(), 69_999], "<u4").tobytes()) for d, t in rows}
    assert {r.doc_id: r.ids_crc32 for r in store.digest(spark, made).collect()} == want


def test_digest_refuses_other_recipes(spark, docs, tmp_path):
    made = store.write(docs(rows_of(6)), WORD, path=str(tmp_path / "s"))
    bad = store.Store(str(tmp_path / "t"))
    made.chunks(spark).write.parquet(f"{bad.path}/chunks")
    made.manifest(spark).write.parquet(f"{bad.path}/manifest")
    made.recipes(spark).selectExpr("row", "doc_id", "start", "n_tokens", "reverse(digests) as digests").write.parquet(f"{bad.path}/recipes")
    with pytest.raises(ValueError, match="manifest"):
        store.digest(spark, bad)
    short = store.Store(str(tmp_path / "u"))
    made.chunks(spark).limit(1).write.parquet(f"{short.path}/chunks")
    for part in ("manifest", "recipes"):
        getattr(made, part)(spark).write.parquet(f"{short.path}/{part}")
    with pytest.raises(Exception, match="chunks are missing"):
        store.digest(spark, short).collect()


def test_store_empty(spark, docs, tmp_path):
    made = store.write(docs([]), WORD, path=str(tmp_path / "s"))
    assert store.digest(spark, made).count() == 0 and store.verify(spark, made)


def test_cuts_follow_content():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 49_000, 40_000).astype(np.uint32)
    a, b = store.cuts(x), store.cuts(np.concatenate([x[:100], x]))
    assert a[-1] == len(x) and all(store.LEAST <= q - p <= store.MOST for p, q in zip([0, *a], a[:-1], strict=False))
    assert len({q + 100 for q in a} & {*b}) > len(a) // 2


def test_crc_join():
    for n in (0, 1, 7, 5000):
        left, right = b"abc" * 11, bytes(range(256)) * 20
        right = right[:n]
        assert store.crc_join(zlib.crc32(left), zlib.crc32(right), n) == zlib.crc32(left + right)


def test_long_texts_in_parts(monkeypatch):
    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choice("abcdé1.'中") for _ in range(rnd.randrange(1, 9))) for _ in range(800)), "x" * 3000, "a " * 1500, "中 文" * 700]
    t = token_counts.Transducer(PIECE)
    want = [len(x) for x in t.model.encode(texts)]
    for n in (50, 1000):
        monkeypatch.setattr(tokens, "PART", n)
        monkeypatch.setattr(token_counts, "AT_ONCE", n)
        assert t.counts(texts).tolist() == want
        for make, path in ((tokens.byte_level, BYTE), (tokens.word_end, WORD)):
            library = tokens._library(path)
            assert all(make(path)(x).tolist() == library.encode(x, add_special_tokens=False).ids for x in texts)


def test_long_texts_hash_in_stretches(monkeypatch):
    from weftgraph.llm import shingles

    data = np.frombuffer(" ".join(words(random.Random(1), 500)).encode(), np.uint8)
    b, e, _ = shingles.words(data, np.array([0, len(data)]))
    whole = shingles.word_hashes(data, b, e)
    monkeypatch.setattr(shingles, "SPAN", 64)
    assert (shingles.word_hashes(data, b, e) == whole).all()
