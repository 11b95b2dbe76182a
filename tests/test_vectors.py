import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookbase.operators import embed as E
from bookbase.operators import knn as K
from bookbase.session import scratch_path


def vectors(spark, matrix, name):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>").repartition(3)


def brute(q, c, k, metric):
    out = []
    for i, a in enumerate(q):
        scored = []
        for j, b in enumerate(c):
            a64, b64 = np.float32(a).astype(float), np.float32(b).astype(float)
            if metric == "l2":
                d = ((a64 - b64) ** 2).sum()
            else:
                n = np.linalg.norm(a64) * np.linalg.norm(b64)
                d = 1 - (a64 @ b64 if metric == "dot" else (a64 @ b64 / n if n else 0.0))
            scored.append((round(float(d), 6) + 0.0, j))
        out += [(i, r + 1, j, d) for r, (d, j) in enumerate(sorted(scored)[:k])]
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-6)


@pytest.fixture(scope="module")
def data():
    """A third of the corpus is one copied vector, which most queries ask for; zeros and ties too."""
    rng = np.random.default_rng(5)
    clusters = rng.normal(0, 4, (6, 8))
    c = np.round(clusters[rng.integers(0, 6, 300)] + rng.normal(0, 0.5, (300, 8)), 2)
    c[::3] = c[0]
    c[7] = 0
    q = np.round(clusters[rng.integers(0, 6, 60)] + rng.normal(0, 0.5, (60, 8)), 2)
    q[:30] = c[0]
    q[31] = 0
    return q, c


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_exact_both_ways(spark, data, metric, monkeypatch):
    q, c = data
    queries, corpus = vectors(spark, q, "qid"), vectors(spark, c, "ebook_no")
    want = brute(q, c, 4, metric)
    same(rows(K.knn(queries, corpus, 4, metric)), want)
    monkeypatch.setattr(K, "MAX_QUERIES", 10)
    monkeypatch.setattr(K, "BLOCK", 16)
    got = K.knn(queries, corpus, 4, metric)
    assert got.columns == ["qid", "rank", "ebook_no", "distance"]
    same(rows(got), want)


def test_cells_leave_far_cells_out(spark, data):
    q, c = data
    path = K.build_cells(vectors(spark, c, "ebook_no"), scratch_path(spark, "cells"), cells=6)
    facts = K._Cells(spark, path)
    assert facts.sizes.sum() == 300 and len(facts.ids) <= 6
    same(rows(K.knn_cells(vectors(spark, q, "qid"), path, 4)), brute(q, c, 4, "l2"))
    with pytest.raises(FileNotFoundError):
        K._Cells(spark, path + "-none")


def test_approx_is_exact_when_all_cells_are_asked(spark, data):
    q, c = data
    path = K.build_cells(vectors(spark, c, "ebook_no"), scratch_path(spark, "cells"), cells=5)
    same(rows(K.knn_approx(vectors(spark, q, "qid"), path, 3, probe=5)), brute(q, c, 3, "l2"))


def test_approx_recall_and_work_on_the_test_vectors(spark):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    c = v.select(F.col("vec_id").alias("ebook_no"), "embedding")
    q = v.select(F.col("vec_id").alias("qid"), "embedding")
    path = K.build_cells(c, scratch_path(spark, "cells"), cells=16)
    exact = {r[:2] for r in ((x["qid"], x["ebook_no"]) for x in K.knn(q, c, 5).collect())}
    near = {(x["qid"], x["cid"]) for x in K.knn_approx(q, path, 5, probe=8).collect()}
    assert len(exact & near) / len(exact) >= 0.9
    facts = K._Cells(spark, path)
    asked = K._ask(q.withColumnRenamed("embedding", "qv"), spark.sparkContext.broadcast(facts), K._probe(8), ["qid", "qv"])
    size = dict(zip(facts.ids.tolist(), facts.sizes.tolist()))
    pairs = sum(size[r["cell"]] for r in asked.select("cell").collect())
    assert pairs < 0.75 * 500 * 500


def test_edges(spark):
    q = vectors(spark, [[0, 0], None], "qid")
    c = vectors(spark, [[1, 0], [0, 1], None, [0, 1]], "ebook_no")
    assert rows(K.knn(q, c, 9)) == [(0, 1, 0, 1.0), (0, 2, 1, 1.0), (0, 3, 3, 1.0)]
    assert rows(K.knn(q, c, 2)) == rows(K.knn(q, c, 9))[:2]
    assert rows(K.knn(q, c.limit(0), 2)) == [] and rows(K.knn(q.limit(0), c, 2)) == []
    assert rows(K.knn(q, c, 1, "cosine")) == [(0, 1, 0, 1.0)]
    assert rows(K.knn(q, c, 1, where=F.col("ebook_no") > 1)) == [(0, 1, 3, 1.0)]


def test_rank_all(spark):
    q = vectors(spark, [[1, 1]], "qid")
    c = vectors(spark, [[1, 0], [3, 1], [1, 1], None], "ebook_no")
    assert [tuple(r) for r in K.rank_all(q, c).collect()] == [(2, 0.0), (0, 1.0), (1, 4.0)]
    assert [r[1] for r in K.rank_all(q, c, "dot").collect()] == [-3.0, -1.0, 0.0]
    with pytest.raises(ValueError):
        K.rank_all(q.limit(0), c)


def test_embed(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "b")], "id int, t string")
    got = {r["id"]: r["embedding"] for r in E.embed(df, "t", 16).collect()}
    assert got[2] is None and got[3] is None
    assert sorted(x for x in got[1] if x) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])
    assert max(got[4]) == 1.0 and len(got[4]) == 16
    weights = E.idf_weights(df, "t", 16)
    assert min(weights) == pytest.approx(1.0) and max(weights) == pytest.approx(math.log(3) + 1)


def test_sparse_and_back(spark):
    df = E.embed(spark.createDataFrame([(1, "a b a c"), (2, "x y")], "id bigint, t string"), "t").select("id", "embedding")
    assert rows(E.densify(E.sparse(df), "id")) == rows(df)


def test_hot_words_do_not_slow_embedding(spark):
    """A text of a million words stays one row; the work grows with the words."""
    df = spark.createDataFrame([(1, "the sea " * 500_000)], "id int, t string")
    got = E.embed(df, "t").first()["embedding"]
    assert [round(x, 6) for x in got if x] == [round(math.sqrt(0.5), 6)] * 2


def test_own_model_loads_once_per_task(spark):
    def load():
        state = {"calls": 0}

        def model(texts):
            state["calls"] += 1
            assert len(texts) <= 2
            return [[len(t), state["calls"]] for t in texts]

        return model

    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(5)], "id int, t string").coalesce(1)
    got = [r["embedding"] for r in E.embed_with(df, "t", load, batch=2).orderBy("id").collect()]
    assert got == [None, [1.0, 1.0], [2.0, 1.0], [3.0, 2.0], [4.0, 2.0]]


def test_no_plan_crosses(spark, data):
    q, c = data
    plan = K.knn(vectors(spark, q, "qid"), vectors(spark, c, "ebook_no"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
@pytest.mark.parametrize("corpus", [
    [], [[1.0, 2.0]], [None, None], [[1.0, 2.0], None, [3.0, 1.0]], [[0.5, 0.5]] * 60 + [[1.0, 0.0]] * 5,
    [[8e6 + i % 7, 8e6 - i] for i in range(80)],
])
def test_both_ways_agree_on_odd_corpora(spark, metric, corpus, monkeypatch):
    q, c = vectors(spark, [[1.0, 1.0], [8e6, 8e6], None], "qid"), vectors(spark, corpus, "ebook_no")
    want = rows(K.knn(q, c, 4, metric))
    assert len({r[0] for r in want}) == (2 if any(v is not None for v in corpus) else 0)
    monkeypatch.setattr(K, "MAX_QUERIES", 0)
    assert rows(K.knn(q, c, 4, metric)) == want
    index = K.build_cells(c, scratch_path(spark, "cells"), metric=metric)
    assert rows(K.knn(q, c.limit(0), 4, metric, index=index)) == want
    with pytest.raises(ValueError):
        K.knn(q, c, 4, "dot" if metric == "l2" else "l2", index=index)


def test_a_task_gives_k_rows_for_each_query(spark):
    c = vectors(spark, [[1.0, 0.0]] * 5000, "ebook_no").coalesce(1)
    q = vectors(spark, [[1.0, 0.5]] * 3, "qid")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        qq, cc = K._inputs(q, c, "qid", "ebook_no", "embedding", None)
        assert K._broadcast_knn(qq, cc, 4, "l2").count() == 12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cells_are_never_fewer_than_asked_for(spark):
    with pytest.raises(ValueError):
        K.build_cells(vectors(spark, [[1.0]], "ebook_no"), scratch_path(spark, "cells"), cells=K.MAX_CELLS + 1)


def test_far_cells_are_not_written_out_query_by_cell(spark, monkeypatch):
    """Vectors without structure ask nearly every cell; no written table has a row per query and cell."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(200, 12)).round(3).tolist()
    c = vectors(spark, points, "ebook_no")
    path = K.build_cells(c, scratch_path(spark, "cells"), cells=14)
    seen, write = [], K.materialise

    def counted(df, name="step"):
        made = write(df, name)
        seen.append(made.count())
        return made

    monkeypatch.setattr(K, "materialise", counted)
    monkeypatch.setattr(K, "TILE", 64)
    monkeypatch.setattr(K, "ASK", 100)
    monkeypatch.setattr(K, "OUT", 7)
    got = rows(K.knn_cells(vectors(spark, points, "qid"), path, 3))
    same(got, brute(points, points, 3, "l2"))
    assert max(seen) <= 3 * 200


def test_norms_work_out_each_vector_once(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(1, "Two words"), (2, " ;"), (3, None), (4, "one one one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = entry.queries()["embed_norm"](spark, str(tmp_path))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    assert sorted(map(tuple, made.collect())) == [(1, 1.0), (4, 1.0)]


def test_tiles_of_long_vectors_have_fewer_rows():
    assert K._tile_rows(10**7, 64) == 65_536 and K._tile_rows(1000, 64) == 4096
    assert K._tile_rows(10**7, 3072) * 3072 <= 1 << 22


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_far_pairs_are_not_worked_out_in_full(metric, monkeypatch):
    from bookbase.operators import distance as D

    rng = np.random.default_rng(2)
    q, c = rng.gamma(0.5, size=(50, 16)), rng.gamma(0.5, size=(400, 16))
    c[5] = c[9] = q[0]
    d = D.distances(q, c, metric)
    limit = np.sort(d, axis=1)[:, 3]
    i, j = np.nonzero(d <= limit[:, None])
    made = []
    monkeypatch.setattr(D, "_pair_distances", lambda a, b, m, f=D._pair_distances: made.append(len(a)) or f(a, b, m))
    got = D.nearest_within(q, c, 4, metric, limit)
    assert sorted(zip(*(x.tolist() for x in got[:2]))) == sorted(zip(i.tolist(), j.tolist()))
    assert np.allclose(got[2], d[got[0], got[1]], atol=2e-6) and 200 <= sum(made) < 400


def test_lookup_vectors_hash_a_word_once_a_batch(spark):
    from bookbase.functions import text as X
    from bookbase.operators import lookup as L

    texts = ["Two words, two", "a''b '''c", " ;", "", None, "é　É x\x1cy\x85z", "ΑΣ:Β ΑΣ", "İ “q” (r)\r\nS", "one " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "qid int, text string")
    made = L.default_embedder()(df)
    assert "md5(" not in made._jdf.queryExecution().optimizedPlan().toString()
    want = E.embed(df.withColumn("clean", X.clean_text("text")), "clean")
    assert sorted(map(tuple, made.select("qid", "embedding").collect())) == sorted(map(tuple, want.select("qid", "embedding").collect()))
