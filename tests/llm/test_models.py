"""Trained scores on held-out rows, language ID against plain recursions, exact search, mixing, and the pipeline on odd rows."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cutweave.llm import langid, linededup, mixing, mtree, ordermin, packing, quality, simhash, tokenfiles, toxicity, words
from cutweave.llm.common import shared_dir
from cutweave.llm.queries import ORACLE, QUERIES
from oracle import compare
from test_duplicates import slow_kept

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, score double, lines int, block int"
ODD = [(1, None, None, None, 3), (2, "", "en", "a", 0), (3, "Plain words here.\nIdiot of a clown, stupid trash.", "en", "a", 5), (3, "Plain words here.\nIdiot of a clown, stupid trash.", "en", "a", 5), (None, "no id at all", None, "b", 1), (4, "x " * 30_000, "fr", None, 2), (5, "…!? 12 34", "de", "b", 9), (6, "\n\n \t", "en", "c", 1), (7, "déjà vu là-bas", "fr", "é", 4)]


def odd(spark):
    return spark.createDataFrame([(*r, 1, "k", 0.5, 2, 3) for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def labelled():
    return duckdb.sql(f"SELECT doc_id, text, lang, quality, toxic FROM '{SF}/documents.parquet' LEFT JOIN '{SF}/labels.parquet' USING (doc_id)").df()


def held(df, folds, which):
    import zlib

    return np.array([zlib.crc32(str(d).encode()) % folds == which for d in df.doc_id])


def area(y, s):
    order = np.argsort(np.argsort(s)) + 1
    n1, n0 = y.sum(), len(y) - y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("name,column,least", [("op2_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.8)])
def test_scores_rank_held_out_documents(spark, labelled, name, column, least):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) == len(labelled) and got.score.between(0, 1).all() and (got.predicted == (got.score >= (0.3 if column == "quality" else 0.5))).all()
    met = got.merge(labelled[labelled[column].notna()], on="doc_id")
    assert (met.held_out == held(met, 5, 0)).all()
    out = met[met.held_out]
    assert area(out[column].to_numpy(), out.score.to_numpy()) >= least


def test_labels_of_held_out_rows_change_nothing(spark, labelled):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = spark.createDataFrame([(int(d), int(t)) for d, t, h in zip(labelled.doc_id, labelled.toxic.fillna(-1), held(labelled, 5, 0), strict=True) if t >= 0 and not h], "doc_id long, y int")
    again = base.unionByName(spark.createDataFrame([(None, 1), (10**9, 1)], "doc_id long, y int"))
    assert toxicity.train(docs, base) == toxicity.train(docs, again)


def test_offending_sentences_are_found(spark, labelled):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    model = toxicity.train(docs, labels)
    text = "The thering and of this. You worthless pathetic idiot. And then on the onthe."
    r = toxicity.score(spark.createDataFrame([(1, text), (2, "The thering and of this.")], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert r[0].predicted == 1 and "worthless" in r[0].worst and [s.sentence for s in r[0].offending] == ["You worthless pathetic idiot."] and r[1].predicted == 0 and r[1].offending == []


def test_noisy_or():
    p, doc = np.array([0.5, 0.5, 0.2]), np.array([0, 0, 2])
    assert np.allclose(toxicity.noisy_or(p, doc, 3), [0.75, 0.0, 0.2])


def test_words_of_a_batch():
    texts = pa.array(["Ab  cd", None, "", "é-x\nab", " tail "])
    w = words.words_of(texts.slice(0))
    got = [(int(d), w.text[s:e].tobytes().decode()) for d, s, e in zip(w.doc, w.start, w.end, strict=True)]
    assert got == [(0, "Ab"), (0, "cd"), (3, "é-x"), (3, "ab"), (4, "tail")]
    h = w.hashes()
    assert h[0] == h[3] and len(set(h.tolist())) == 4
    again = words.words_of(texts.slice(3, 2))
    assert (again.hashes() == h[2:]).all()


def test_language_by_forward_backward():
    rng = np.random.default_rng(0)
    psi, A, first = rng.random((300, 4)) + 0.01, rng.random((4, 4)) + 0.01, np.array([0, 0, 1, 130, 130, 300])
    got = langid.posteriors(psi, first, A)
    for s, e in zip(first, first[1:], strict=False):
        a, seen, b = np.full(4, 0.25), [], np.ones(4)
        for t in range(s, e):
            a = (a @ A) * psi[t]
            a /= a.sum()
            seen.append(a)
        for t in range(e - 1, s - 1, -1):
            assert np.allclose(seen[t - s] * b / (seen[t - s] * b).sum(), got[t])
            b = A @ (psi[t] * b)
            b /= b.sum()


def test_language_of_held_out_documents(spark, labelled):
    got = QUERIES["op4_langid"](spark, SF).toPandas().merge(labelled, on="doc_id")
    assert (got.held_out == held(got, 3, 1)).all() and (got.lang_pred == got.lang)[got.held_out].mean() > 0.98 and got.score.between(0, 1).all()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    mixed = [lang for _, lang, _ in langid.labelled_words("the thering and of edation queaux réelle éaumen treaux", model)]
    assert mixed == ["en"] * 5 + ["fr"] * 4
    r = {x.doc_id: x for x in langid.predict(odd(spark), model).collect() if x.doc_id not in (3, None)}
    assert [r[d].lang_pred for d in (1, 2, 5, 6)] == ["und"] * 4 and r[7].lang_pred == "fr" and r[1].score == 0.0
    nothing = langid.train(docs.limit(0))
    assert {x.lang_pred for x in langid.predict(docs.limit(5), nothing).collect()} == {"und"}


@pytest.mark.parametrize("rows", [1, 40, 900])
def test_trees_find_the_exact_best(rows):
    rng = np.random.default_rng(rows)
    m = np.floor(rng.normal(size=(rows, 6)) * 20)
    m[rows // 2 :] = m[: rows - rows // 2]  # ties
    ids = rng.permutation(rows) * 3
    stats: dict = {}
    tree = mtree.Tree(ids, m, float((m**2).sum(axis=1).max()), 6)
    for q in (0, rows // 3, rows - 1):
        dots = m @ m[q]
        want = sorted(((-int(d), int(i)) for d, i in zip(dots, ids, strict=True) if i != ids[q]))[:10]
        assert tree.search(m[q], int(ids[q]), 10, stats) == [(-d, i) for d, i in want]


def test_bounds_save_computations():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8)) * 400
    m = np.floor(centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 8)) * 5)
    m = np.floor(m / np.linalg.norm(m, axis=1)[:, None] * 1000)
    stats: dict = {}
    tree = mtree.Tree(np.arange(6000), m, float((m**2).sum(axis=1).max()), 8)
    for q in range(0, 6000, 600):
        tree.search(m[q], q, 10, stats)
    assert stats["computed"] < 0.5 * 10 * 6000


def test_search_over_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (6, [3.0]), (100, [1.0, 1.0]), (None, [9.0, 9.0]), (7, [float("inf"), 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.rank, r.vec_id, r.score) for r in mtree.top_k(v, v.filter("vec_id % 100 = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 3 * 1024**2), (2, 6, 3 * 1024**2), (3, 5, 0)]
    assert mtree.top_k(v.limit(0), v.limit(0)).count() == 0 and mtree.top_k(v, v.filter("vec_id = 2")).count() == 0
    many = spark.range(0, 300).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * k).cast("float") for k in range(1, 5)]).alias("embedding"))
    whole = {(r.query_id, r.rank): (r.vec_id, r.score) for r in mtree.top_k(many, many.filter("vec_id % 100 = 0")).collect()}
    small = {(r.query_id, r.rank): (r.vec_id, r.score) for r in mtree.top_k(many, many.filter("vec_id % 100 = 0"), tree_rows=32).collect()}
    assert whole == small and len(whole) == 30
    far = spark.createDataFrame([(0, [2.0**60]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        mtree.top_k(far, far)
    clash = v.withColumns({"block": F.lit("x"), "v": F.lit(1), "least": F.lit(0)})
    assert [(r.rank, r.vec_id, r.score) for r in mtree.top_k(clash, clash.filter("vec_id % 100 = 0")).orderBy("rank").collect()] == got


@pytest.mark.parametrize("chunk", [4096, 3])
def test_queries_go_where_bounds_allow(spark, monkeypatch, chunk):
    """Tight clusters in many trees, and routers and queries in several groups, against all products."""
    monkeypatch.setattr(mtree, "QUERY_GROUP", chunk)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 5))
    rows = [(i, (centres[i % 12] + 0.02 * rng.normal(size=5)).tolist()) for i in range(600)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    m = np.floor(np.array([r[1] for r in rows]) * 1024)
    got = {(r.query_id, r.rank): (r.score, r.vec_id) for r in mtree.top_k(v, v.filter("vec_id % 50 = 0"), tree_rows=40).collect()}
    for q in range(0, 600, 50):
        want = sorted((-int(d), i) for i, d in enumerate(m @ m[q]) if i != q)[:10]
        assert [got[q, k] for k in range(1, 11)] == [(-d, i) for d, i in want]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_are_those_of_the_sql(spark, name):
    assert compare(spark, name, "/root/testdata/sf0.001") is None


def test_mixing_meets_targets_and_caps(spark):
    docs = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 40 + 1).cast("int")), " ").alias("text"), F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    rows = mixing.mix(docs).collect()
    total, by = sum(r["size"] for r in rows), {}
    for r in rows:
        assert r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size
        key = (r.source_size, r.target)
        by[key] = by.get(key, 0) + r.taken
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total
    assert all(abs(taken - target) <= 20 for (_, target), taken in by.items())
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect())) == sorted(map(tuple, rows))
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.times for r in rows)


def test_mixing_of_odd_rows(spark):
    got = mixing.mix(odd(spark)).collect()
    assert len(got) == len(ODD) and mixing.mix(odd(spark).limit(0)).count() == 0
    assert all(r.taken <= 2 * r["size"] for r in got)


def test_all_operators_take_odd_and_empty_tables(spark):
    docs = odd(spark)
    model, tox = quality.train(docs, docs.select("doc_id", F.lit(1).alias("y")).limit(0)), toxicity.train(docs, docs.select("doc_id", F.lit(1).alias("y")))
    assert {r.score for r in quality.score(docs, model, 0.3).collect()} == {0.5}
    for d, n in ((docs, len(ODD)), (docs.limit(0), 0)):
        assert quality.score(d, model, 0.3).count() == toxicity.score(d, tox).count() == simhash.near_duplicates(d).count() == n
        assert linededup.drop_recurring(d).count() == ordermin.fingerprint_pairs(d).count() == n
        assert linededup.drop_recurring(d).columns == [*[c for c in d.columns if c != "lines"], "lines", "dropped_lines", "dropped_pieces"]
        assert packing.pack(d).select("doc_id").distinct().count() == len({r[0] for r in ODD}) * (n > 0)
        assert tokenfiles.write_shards(d, shared_dir(spark, "odd")).agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0] == n


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    for name, docs in (("odd", odd(spark)), ("none", odd(spark).limit(0))):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(2, 1, 0), (3, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        at = spark.read.parquet(f"{sf}/documents.parquet")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, at, sf)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            out.write.parquet(f"{sf}/out{k}")
            at = spark.read.parquet(f"{sf}/out{k}")
        assert corpus_pipeline.run(spark, sf).count() == at.count()


def test_pipeline_stages_decide_as_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.toxic_out(spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", F.col("toxic").alias("y"))
    bad = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, labels)).filter("predicted = 1").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad and bad
    lines = corpus_pipeline.recurring_lines_out(spark, clean, SF)
    assert lines.count() == clean.count() and lines.filter("n_chars <> length(text)").count() == 0
    one = corpus_pipeline.near_duplicates_out(spark, lines, SF)
    assert sorted(r.doc_id for r in one.collect()) == slow_kept([(r.doc_id, r.text) for r in lines.collect()])
