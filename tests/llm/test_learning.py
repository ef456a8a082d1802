"""Toxicity, mixing, sharding and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import ODD, frame, words
from weftgraph.llm import mixing, sharding, toxicity

BAD = ["vile", "rotten", "foul"]


#: Digits end words for the scorer, so words of these texts have letters alone.
LETTERS = str.maketrans("0123456789", "ghijklmnop")


def labelled(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w = [x.translate(LETTERS) for x in words(rnd, 40, 900)]
        toxic = int(rnd.random() < 0.25)
        if toxic:
            for b in rnd.sample(BAD, 2):
                w.insert(rnd.randrange(len(w)), b + rnd.choice(["", ",", "ness"]))
        rows.append((k, " ".join(w)))
        labels.append((k, toxic))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, docs):
    rows, labels = labelled(spark)
    index = toxicity.fit(docs(rows), labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score(docs(rows + [(9000 + (d or 0), t) for d, t in ODD]), index).collect()
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert len(held) > 40 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.predicted == 0 and not r.evidence for r in got if r.doc_id not in truth and not r.terms)
    # The rows that are held out teach nothing.
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    again = {r.doc_id: r.score for r in toxicity.score(docs(rows), toxicity.fit(docs(rows), flipped)).collect()}
    assert again == {r.doc_id: r.score for r in got if r.doc_id in truth}
    kept = toxicity.keep_clean(docs(rows), index)
    assert kept.columns == docs(rows).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.doc_id in truth and not r.predicted}


def dense(rows, labels, texts):
    """Scores by plain loops over dense vectors: every cosine, sorted; the curve fitted anew."""
    import math

    known = {d: y for d, y in labels if zlib.crc32(str(d).encode()) % 5}
    text = dict(rows)
    ids = sorted(known)
    held = [Counter(toxicity.words(text[d])) for d in ids]
    terms = sorted({w for h in held for w in h})
    n = [sum(1 - known[d] for d in ids), sum(known[d] for d in ids)]

    def g2(w):
        total = 0.0
        for has in (True, False):
            seen = [sum((w in h) == has and known[d] == y for d, h in zip(ids, held, strict=True)) for y in (0, 1)]
            total += sum(s * math.log(s * sum(n) / (sum(seen) * n[y])) for y, s in enumerate(seen) if s)
        return round(2 * total, 9)

    df = Counter(w for t in text.values() for w in set(toxicity.words(t)))
    worth = {w: (math.log((1 + len(text)) / (1 + df[w])) + 1) * math.sqrt(max(g2(w), toxicity.LEAST_G2)) for w in terms}

    def vector(h):
        v = np.array([(1 + math.log(h[w])) * worth[w] if h.get(w) else 0.0 for w in terms])
        return v / (np.linalg.norm(v) or 1.0)

    whole = np.array([vector(h) for h in held])
    y = np.array([known[d] for d in ids])

    def raw(h, own):
        cos = whole @ vector(h)
        if own in known:
            cos[ids.index(own)] = 0
        near = np.sort(np.round(cos, 12))[::-1][: toxicity.NEIGHBOURS]
        assert len(cos) <= len(near) or near[-1] == 0 or np.round(np.sort(cos)[::-1][toxicity.NEIGHBOURS], 12) < near[-1], "a tie at the last place"
        best = np.argsort(-cos)[: toxicity.NEIGHBOURS]
        best = best[cos[best] > 0]
        return (cos[best][y[best] == 1].sum() + toxicity.PRIOR * n[1] / len(ids)) / (cos[best].sum() + toxicity.PRIOR)

    a, b = toxicity._platt(np.array([raw(h, d) for d, h in zip(ids, held, strict=True)]), y, np.ones(len(y)))
    out = {}
    for d, t in texts:
        r = raw(Counter(toxicity.words(t)), d)
        out[d] = 1 / (1 + math.exp(-max(-40, min(40, a * math.log(r / (1 - r)) + b)))) if 0 < r < 1 else float(r >= 1)
    return out


def test_scores_are_those_of_dense_vectors(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "OFTEN", 6)
    rnd = random.Random(12)
    rows = [(k, " ".join([f"own{k}x" + "abc"[k % 3]] + [f"v{rnd.randrange(300)}q" for _ in range(rnd.randrange(25, 80))] + ["vile"] * (k % 5 == 0) + ["z" * 200] * (k % 7 == 0))) for k in range(150)]
    labels = [(k, int(k % 5 == 0)) for k in range(150)]
    rows = [(d, t.translate(LETTERS)) for d, t in rows]
    want = dense(rows, labels, rows)
    index = toxicity.fit(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(index.ids) == sum(zlib.crc32(str(d).encode()) % 5 > 0 for d, _ in rows)  # none taken for a copy
    got = {r.doc_id: r.score for r in toxicity.score(docs(rows), index).collect()}
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in got) < 1e-6
    kept = {r.doc_id for r in toxicity.keep_clean(docs(rows), index).collect()}
    assert kept == {d for d, x in got.items() if x < 0.5}


def test_search_is_exact(spark, docs):
    rows, labels = labelled(spark, 300, 2)
    index = toxicity.fit(docs(rows), labels)
    whole = np.zeros((len(index.ids), len(index.terms)))
    whole[np.repeat(np.arange(len(index.ids)), np.diff(index.own_first)), index.own_term] = index.own_weight
    assert index.filled is None and len(index.prepare().ids) > 150 and (index.column >= 0).any() and (index.column < 0).any()
    assert np.allclose((whole * whole).sum(1), 1)
    for e in range(0, len(index.ids), 3):
        at = np.flatnonzero(whole[e])
        best, sims = index.nearest(at, whole[e][at])
        cos = np.round(whole @ whole[e], 12)
        want = np.lexsort((np.arange(len(cos)), -cos))[: toxicity.NEIGHBOURS]
        want = want[cos[want] > 0]
        assert (best == want).all() and np.allclose(sims, cos[want])


def test_words_of_columns(spark):
    """Words are looked up a column at a time, also where texts touch, and as ``words`` has them."""
    import pyarrow as pa
    from weftgraph.llm.common import text_bytes

    texts = ["Ab cd", "ef", "ab", None, "", " \t", "ab" * 40 + " ab", "x1ab-AB", "Éa éa", "日本 ab", "a" * 64, "a" * 63, "ab"]
    for more in (0, 1000):  # beside so many other terms that a few words are looked up one by one
        numbers = {w: k for k, w in enumerate(dict.fromkeys([w for t in texts[2:] for w in toxicity.words(t)] + [b"no%d" % k for k in range(more)]))}
        column = pa.array(["left out", *texts])[1:]
        got = [Counter() for _ in texts]
        for text, number, times in zip(*toxicity.Vocabulary(numbers).counts(*text_bytes(column)), strict=True):
            got[text][int(number)] = int(times)
        assert got == [Counter(numbers[w] for w in toxicity.words(t) if w in numbers) for t in texts]
        assert len(toxicity.Vocabulary({}).counts(*text_bytes(column))[0]) == 0


def test_frequent_terms_are_met_in_batches(spark, docs, monkeypatch):
    """A product with all examples costs as much for one text as for many: votes on the examples
    and scores make one for a batch, and words are looked up once for it."""
    import pyarrow as pa

    rows, labels = labelled(spark, 300, 6)
    index = toxicity.fit(docs(rows), labels).prepare()
    sizes = []
    frequent = toxicity.Index.frequent
    monkeypatch.setattr(toxicity.Index, "frequent", lambda self, vectors: sizes.append(len(vectors)) or frequent(self, vectors))
    text = dict(rows)
    column = pa.array([text[d] for d in index.ids])
    batch = pa.RecordBatch.from_arrays([pa.array(index.ids), column], names=["doc_id", "text"])

    class Shared:
        value = index

    from pyspark.sql.types import _parse_datatype_string

    out = [r for b in toxicity._votes(_parse_datatype_string("e int, raw double"), Shared)(iter([batch])) for r in b.column(1).to_pylist()]
    assert len(out) == len(index.ids) > 150 and len(sizes) <= -(-len(out) // toxicity.BATCH) and sum(sizes) == len(out)
    alone = [index.raw(*index.vector(text[d]), without=e)[0] for e, d in enumerate(index.ids)]
    assert np.allclose(out, alone, rtol=0, atol=1e-9)
    monkeypatch.setattr(toxicity, "BATCH", 7)
    monkeypatch.setattr(toxicity, "SPAN", 3000)
    scorer = toxicity._Scorer(index)
    got = scorer([*index.ids, None, index.ids[0]], pa.array([*column.to_pylist(), None, text[index.ids[0]]]))
    assert [g[0] for g in got[:-2]] == pytest.approx([index.score(r) for r in alone], abs=1e-9)
    assert len(got[-2][1]) == 0 and got[-1][0] == got[0][0]


def test_index_of_a_task(spark, docs):
    """An index that has travelled finds the same without the weights by example that it was built from."""
    import pickle

    rows, labels = labelled(spark, 200, 8)
    index = toxicity.fit(docs(rows), labels)
    there = pickle.loads(pickle.dumps(index))
    assert there.own_term is there.own_weight is there.times is None and there.curve == index.curve
    for d, t in [*rows[:40], (None, ""), (None, "foul")]:
        (a, x), (b, y) = (i.nearest(*i.vector(t), without=i.at.get(d, -1)) for i in (index, there))
        assert (a == b).all() and (x == y).all()


def test_own_label_is_no_input(spark, docs):
    rows, labels = labelled(spark, 200, 5)
    index = toxicity.fit(docs(rows), labels)
    got = toxicity.score(docs(rows), index).collect()
    assert all(r.doc_id not in [e.doc_id for e in r.evidence] for r in got)
    assert any(r.doc_id in index.at for r in got)


def test_rare_forms_are_terms(spark, docs):
    """Forms too rare to pass a test of chance one by one still tell a toxic text."""
    rnd = random.Random(3)
    forms = ["".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(4)) for _ in range(900)]
    plain, bad = forms[:700], forms[700:780]
    rows, labels = [], []
    for k in range(600):
        w = rnd.sample(plain, 30)
        toxic = int(k % 4 == 0)
        if toxic:
            w[:6] = rnd.sample(bad, 6)
        rows.append((k, " ".join(w)))
        labels.append((k, toxic))
    index = toxicity.fit(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [r for r in toxicity.score(docs(rows), index).collect() if r.held_out]
    truth = dict(labels)
    assert all(r.terms for r in got)
    assert sum(r.predicted for r in got if truth[r.doc_id]) >= 0.9 * sum(truth[r.doc_id] for r in got)
    assert sum(r.predicted for r in got if not truth[r.doc_id]) <= 0.02 * len(got)


def test_nothing_to_learn(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    index = toxicity.fit(docs(ODD), none)
    assert index is None and {(r.score, r.predicted) for r in toxicity.score(docs(ODD), index).collect()} == {(0.0, 0)}
    assert toxicity.keep_clean(docs(ODD), None).count() == len(ODD)
    one = spark.createDataFrame([(4, 1), (7, None)], "doc_id long, toxic int")
    assert toxicity.score(docs(ODD), toxicity.fit(docs(ODD), one)).count() == len(ODD)
    assert toxicity.score(docs([]), toxicity.fit(docs([]), none)).count() == 0


# --- mixing ---------------------------------------------------------------------------


def brute_targets(sizes: dict):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        level = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= over


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing(docs, seed):
    rnd = random.Random(seed)
    rows = [(d, t, "odd") for d, t in ODD] + [(100 + k, " ".join(words(rnd, rnd.randrange(0, 60))), rnd.choice(["a", "a", "a", "b", "é", "Z", None, "tiny"][: 3 + 2 * seed])) for k in range(200)]
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and taken[s] == int(target[s] + 1e-9) or abs(taken[s] - target[s]) < 1
    assert Counter(mixing.mix(docs(rows)).collect()) == Counter(got)


def test_mixing_empty_and_apply(docs):
    assert mixing.mix(docs([])).count() == 0 and mixing.apply(docs([])).count() == 0
    assert all(r.taken == 0 for r in mixing.mix(docs([(1, None), (2, " ")])).collect())
    rnd = random.Random(4)
    rows = [(k, " ".join(words(rnd, rnd.randrange(0, 30))), f"s{k % 4}") for k in range(80)]
    df = docs(rows)
    out = mixing.apply(df)
    assert out.columns == df.columns
    taken, there = defaultdict(int), defaultdict(int)
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += r.taken
    for r in out.collect():
        there[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in taken.items() if v} == dict(there)


# --- sharding ---------------------------------------------------------------------------


def test_sharding(docs):
    rnd = random.Random(5)
    rows = ODD + [(1000 + k, " ".join(words(rnd, 5))) for k in range(3000)]
    got = sharding.assign(docs(rows), sharding.topology(40), sharding.topology(41)).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == 40
    assert 30 < sum(r.grown_shard == 40 for r in got) < 130
    by_id = {}
    for (d, t, *_), r in zip(sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")), sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), strict=True):
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    crc = Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert crc == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)


def test_weights_move_rows_only_through_their_subtree(docs):
    rows = [(k, "x") for k in range(4000)]
    before = sharding.topology(40)
    after = [(g, r, s, 3.0 if s == 7 else w) for g, r, s, w in before]
    moved = [(a.shard, b.shard) for a, b in zip(*(sorted(sharding.assign(docs(rows), t).collect(), key=lambda r: r.doc_id) for t in (before, after)), strict=True) if a.shard != b.shard]
    region = {s: g for g, _, s, _ in before}
    assert moved and all(region[b] == region[7] for _, b in moved)
    assert all(b == 7 for a, b in moved if a // 5 == 1)
    assert sharding.assign(docs([]), before).count() == 0


# --- pipeline ---------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from weftgraph.llm import exact_dedup, ngram_join

    rows, labels = labelled(spark, 200, 7)
    rows += [(500 + k, rows[k][1].upper()) for k in range(30)] + [(700 + k, rows[k][1] + " more") for k in range(30, 60)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        seen.append(docs)
        assert k == 4 or docs.columns == columns
    ids = [{r.doc_id for r in d.collect()} for d in seen]
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(not truth.get(d, 0) for d in ids[0]) and len({d for d, t in truth.items() if not t} - ids[0]) <= 3
    assert ids[1] == {r.keep_id for r in exact_dedup.dedup(spark.read.parquet(str(tmp_path / "stage0"))).collect()}
    assert ids[2] == {r.component_id for r in ngram_join.join(spark.read.parquet(str(tmp_path / "stage1"))).collect()}
    took = {r.doc_id for r in mixing.mix(spark.read.parquet(str(tmp_path / "stage2"))).collect() if r.taken}
    assert ids[3] == took == ids[4]
    total = sum(len(r.text.split()) for r in seen[3].collect())
    assert total == sum(r.taken for r in mixing.mix(seen[2]).collect())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id, r.doc_tokens) for r in whole.select("doc_id", "doc_tokens").collect()) == sorted((r.doc_id, r.doc_tokens) for r in seen[4].collect())


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_take_odd_rows(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame([(4, 0), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= 3 * len(rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).select("doc_id").distinct().count() == len({d for d, *_ in rows})
    clean = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert clean.count() == len(rows)
    near = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    empty = [d for d, t in rows if not (t or "").strip(" \t\n\x0b\x0c\r")]
    assert near.filter("doc_id in (1, 2, 3)").count() == len(empty)
