"""Whitening, decontamination and source divergence against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cutweave.llm import decontaminate, divergence, fmindex, whitening
from oracle import compare

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n. "), (4, "one"), (4, "one"), (None, "One two THREE four"), (6, "zwei été 3 été zwei"), (7, "w " * 30_000), (8, "a b c d e f g h i j k l m n o p"), (9, "x. A, b c d-e f g h i j k. y")]


# whitening


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, x int, v string, n int")


def slow_whitening(vecs, k=16):
    x = np.floor(np.array(vecs, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    away = (fit * n - s) / n
    e, axes = np.linalg.eigh(away.T @ away / n)
    e, axes = e[::-1], axes[:, ::-1]
    return n, ((x * n - s) ** 2).sum(1), ((x * n - s) / n) @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_whitened_vectors_are_those_of_the_eigenvectors(spark):
    got = whitening.op11_whitening(spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    n, far, white, share = slow_whitening(np.stack(rows.embedding))
    assert (got.n == n).all() and len(got) == 16 * len(rows) and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    turn = np.sign((wide * white).sum(0))
    assert np.abs(wide * turn - white).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-9)
    assert (got.groupby("vec_id").deviation.first().loc[rows.vec_id].to_numpy() == far).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    good = [(i, [float(a), float(b), float(a)]) for i, (a, b) in enumerate(rng.normal(size=(20, 2)))]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [nan, 0.0, 0.0]), (53, [inf, 0.0, 0.0]), (54, [1.0, 2.0]), (55, []), (None, good[0][1]), (0, good[0][1])]
    got = whitening.whiten(vectors(spark, good + odd)).toPandas()
    assert len(got) == 3 * 22 and set(got.n) == {20} and set(got.component) == {1, 2, 3}
    assert got[got.component == 3].whitened.isna().all() and (got[got.component == 3].explained == 0).all()  # the third repeats the first
    n, _, white, _ = slow_whitening([v for _, v in good], 2)
    first = got[(got.component == 1) & got.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id").whitened.loc[range(20)].to_numpy()
    assert np.abs(np.abs(first) - np.abs(white[:, 0])).max() < 1e-9
    same = whitening.whiten(vectors(spark, [(1, [0.5, 0.5])] * 3)).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error == 0 for r in same)
    assert whitening.whiten(vectors(spark, [])).count() == 0 and whitening.whiten(vectors(spark, [(1, []), (2, None)])).count() == 0
    huge = whitening.whiten(vectors(spark, [(1, [3e38]), (2, [-3e38]), (3, [0.0])])).collect()
    assert len(huge) == 3 and all(r.identity_error < 1e-4 for r in huge)


def test_large_deviations_are_exact():
    x = np.array([[1_000_000, 3], [-(1 << 52), 7]])
    n, total = 10**12, [10**18 + 1, 5]
    assert whitening.deviations(x, n, total).tolist() == [[a * n - t for a, t in zip(row, total, strict=True)] for row in x.tolist()]


def test_factors_are_stacked_in_a_tree(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 100, (200, 5))
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(9)
    n, total = whitening.sums(fit, 5)
    assert (n, total) == (200, x.sum(0).tolist())
    r = whitening.triangular(fit, 5, n, total, fan=2)
    away = x - x.mean(0)
    assert np.allclose(r.T @ r, away.T @ away)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.integers(0, 9), st.integers(0, 1000))
def test_rotations_give_the_singular_values(dims, rows, rank, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(rows, min(rank, dims))) @ rng.normal(size=(min(rank, dims), dims)) * 10.0 ** rng.integers(-3, 4, dims)
    lengths, axes = whitening.jacobi(a)
    want = np.linalg.svd(a, compute_uv=False)
    want = np.append(want, np.zeros(max(0, dims - len(want))))[:dims]
    assert np.allclose(lengths, want, atol=1e-12 * max(1e-30, want[0])) and np.allclose(axes.T @ axes, np.eye(dims))
    assert np.allclose(np.linalg.norm(a @ axes, axis=0), lengths, atol=1e-11 * max(1e-30, want[0]))


# decontamination


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=6), min_size=1, max_size=8))
def test_backward_search_finds_all_places(text, phrases):
    order = fmindex.suffixes(np.array([*text, 0]))
    assert order.tolist() == sorted(range(len(text) + 1), key=lambda i: [*text, 0][i:])
    rows = np.zeros((len(phrases), 6), np.int64)
    for row, p in zip(rows, phrases, strict=True):
        row[6 - len(p) :] = p
    found = sorted((int(a), int(b)) for some in fmindex.FMIndex(np.array(text), 5).occurrences(rows, np.array([len(p) for p in phrases])) for a, b in zip(*some, strict=True))
    assert found == sorted((i, j) for i, p in enumerate(phrases) for j in range(len(text) - len(p) + 1) if text[j : j + len(p)] == p)


def slow_hits(text, items, window=10):
    def words(t):
        return [(m.group().translate({i: i + 32 for i in range(65, 91)}), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]

    own, hit, named = words(text), set(), set()
    for name, t in items:
        w = [x for x, _ in words(t)]
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            cut = w[i : i + window]
            for j in range(len(own) - len(cut) + 1):
                if [x for x, _ in own[j : j + len(cut)]] == cut:
                    hit |= set(range(j, j + len(cut)))
                    named |= {str(name)} - {"None"}
    spans = []
    for j in sorted(hit):
        if spans and j - 1 in hit:
            spans[-1] = (spans[-1][0], own[j][1][1])
        else:
            spans.append(own[j][1])
    return len(own), len(hit), spans, sorted(named)


ITEMS = [(3, "A b c d e f g h i j k"), (3, "été 3"), (10, "one"), (2, None), (4, ""), (5, " .. "), (None, "three FOUR"), (7, "w " * 12), (8, "nowhere at all in these texts, however one looks at it all")]


@pytest.mark.parametrize("small", [False, True])
def test_odd_documents_and_items(spark, monkeypatch, small):
    if small:  # parts of an index overlap, blocks of items add up
        monkeypatch.setattr(decontaminate, "PART", 7)
        monkeypatch.setattr(fmindex, "TOGETHER", 5)
    texts = [t for _, t in ODD if not (small and t and len(t) > 1000)]
    held = [decontaminate.block_of([(None if n is None else str(n), t) for n, t in some if t is not None], 10) for some in ([ITEMS[:3], ITEMS[3:]] if small else [ITEMS])]
    for i, row in enumerate(decontaminate.search(pa.array(texts), held)):
        n, n_hit, spans, named = slow_hits(texts[i], ITEMS) if len(texts[i] or "") < 1000 else (30_000, 30_000, [(0, 59_999)], ["7"])
        assert row == (n, n_hit, spans, named)
    if small:
        return
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in ODD], "doc_id long, text string, items int, spans string")
    items = spark.createDataFrame([(d, t, 1) for d, t in ITEMS], "item_id long, text string, name int")
    got = decontaminate.decontaminate(docs, items, texts=True, block_words=4).collect()
    assert [r.doc_id for r in got] == [d for d, _ in ODD] and got[9].cleaned == "x. . y" and got[0].cleaned is None and got[5].cleaned == "One two THREE four"[3:8]
    assert got[5].items == ["10"] and got[6].items == ["3"]
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}


def test_decontamination_query_is_the_sql(spark):
    assert compare(spark, "op12_decontaminate", SF) is None
    got = decontaminate.op12_decontaminate(spark, SF).collect()
    assert any(r.contaminated for r in got) and {r.items_sha256 for r in got if not r.n_items} == {hashlib.sha256(b"").hexdigest()}


# divergence


def slow_divergence(rows, least=3, top=200):
    docs = [(lang or "", source or "", [m.translate({i: i + 32 for i in range(65, 91)}) for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for t, lang, source in rows]
    df, n, groups = Counter(), defaultdict(Counter), {(lang, source) for lang, source, _ in docs}
    for lang, source, words in docs:
        df.update((lang, w) for w in set(words))
        n[lang, source].update(words)
    out = []
    for lang, source in groups:
        kept = [w for (x, w), k in df.items() if x == lang and k >= least]
        of = {s: {w: n[lang, s][w] for w in kept} for x, s in groups if x == lang}
        whole = {w: sum(c[w] for c in of.values()) for w in kept}
        p = {s: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept} for s, c in of.items()}
        q = {w: 1 + 10**9 * (k + 1) // (sum(whole.values()) + len(kept)) for w, k in whole.items()}
        far = lambda a, b: (a - b) ** 2 // b
        pair = [(-sum(far(p[source][w], p[s][w]) for w in kept), s.encode()) for s in of if s != source]
        term = [(-far(p[source][w], q[w]), w.encode()) for w in kept if of[source][w] and p[source][w] > q[w]]
        for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def test_odd_sources(spark):
    rows = [("a b c A", "en", "x"), ("a b é", "en", "y"), ("a é c c", "en", None), (None, "en", "z"), ("é-b 7 a", "en", "x"), ("a", None, "x"), ("a", None, "x"), ("", "de", "x"), ("a", "de", "y"), ("q " * 20_000 + "a", "en", "y"), ("a b c A", "en", "x"), ("solo solo", "fr", "x"), ("solo", "fr", "x"), ("solo " + "ß" * 5000, "fr", "x")]
    docs = spark.createDataFrame([(*r, 1, "t", 5) for r in rows], "text string, lang string, source string, n int, term string, total int")
    for top in (200, 1):
        got = divergence.divergence(docs.repartition(3), top=top, cells=1 << 17)
        assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got.collect()) == slow_divergence(rows, top=top)
    assert divergence.divergence(docs.limit(0)).count() == 0
    assert sorted(tuple(r) for r in divergence.divergence(docs, least=1).select("lang", "source", "part", "item", "value", "rank").collect()) == slow_divergence(rows, 1)


def test_sketches_never_underestimate(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(2000)) for _ in range(60)]
    read = divergence.terms_read(spark.createDataFrame([(t, "en", "s") for t in texts], "text string, lang string, source string").repartition(5), "text", "lang", "source")
    df = Counter(w for t in texts for w in set(t.split()))
    sketch = divergence.sketched(read, 3, 1 << 16)
    part = divergence.Slice(pa.RecordBatch.from_arrays([pa.array([" ".join(df)]), pa.array(["en"]), pa.array(["s"])], ["text", "lang", "source"]))
    at, _ = part.documents()
    least = sketch[divergence.cells_of(part.keys(at), 1 << 16)].min(axis=0)
    true = np.array([min(3, df[t]) for t in part.terms.take(pa.array(at % part.n)).to_pylist()])
    assert (least >= true).all() and (least < 3).any()
    left = {r.term for r in divergence.counted(read, sketch, 3).select("term").distinct().collect()}
    assert {t for t, k in df.items() if k >= 3} <= left < set(df)


def test_divergence_query_is_the_sql(spark):
    assert compare(spark, "op13_divergence", SF) is None
