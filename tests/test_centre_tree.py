"""The two-level centre tree: exact search equals brute force, beam search reaches its recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookbase import fixtures as B
from bookbase.operators import centre_tree as T
from bookbase.operators import knn
from bookbase.session import scratch_path


def brute(points, ids, queries, qids, k):
    out = []
    for qid, v in zip(qids, queries):
        d = np.round(((points - v) ** 2).sum(1), 6) + 0.0
        order = np.lexsort((ids, d))[:k]
        out += [(int(qid), r + 1, int(ids[j]), float(d[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.fixture(scope="module")
def big(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(300, 8)) * 4
    points = centres[rng.integers(0, 300, 100_000)] + rng.normal(size=(100_000, 8))
    points[:30_000] = points[0] + rng.normal(size=(30_000, 8)) * 0.1  # a third of the rows in one place
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "ebook_no long, embedding array<double>").repartition(16)
    path = T.build_tree(df, scratch_path(spark, "tree"), cells=10_000)
    return points, df, path


def test_ten_thousand_cells_exact(spark, big):
    points, df, path = big
    cells = spark.read.parquet(f"{path}/cells")
    assert cells.count() >= 9_000 and spark.read.parquet(f"{path}/groups").count() >= 90
    assert cells.agg(F.sum("size")).first()[0] == len(points)
    asked = df.filter("ebook_no % 331 = 0").select(F.col("ebook_no").alias("qid"), "embedding")
    got = sorted(tuple(r) for r in T.knn_tree(asked, path, 5).collect())
    qids = np.arange(0, len(points), 331)
    assert got == brute(points, np.arange(len(points)), points[qids], qids, 5)


def test_beam_search_recall(spark, big):
    points, df, path = big
    asked = df.filter("ebook_no % 997 = 0").select(F.col("ebook_no").alias("qid"), "embedding")
    qids = np.arange(0, len(points), 997)
    want = {(q, c) for q, _, c, _ in brute(points, np.arange(len(points)), points[qids], qids, 5)}
    got = {(r["qid"], r["cid"]) for r in T.knn_tree_approx(asked, path, 5, beam=3, probe=8).collect()}
    recall = len(want & got) / len(want)
    sizes = {r["cell"]: r["size"] for r in spark.read.parquet(f"{path}/cells").collect()}
    print(f"recall {recall:.3f}")
    assert recall >= 0.9


def test_tree_on_given_vectors_equals_knn(spark):
    v = B.vectors(spark, "/root/testdata/sf0.001")
    q, c = v.select(F.col("ebook_no").alias("qid"), "embedding"), v.select("ebook_no", "embedding")
    for metric in ("l2", "cosine"):
        path = T.build_tree(c, scratch_path(spark, "tree"), metric=metric)
        got = sorted(tuple(r) for r in T.knn_tree(q, path, 5).collect())
        assert got == sorted(tuple(r) for r in knn.knn(q, c, k=5, metric=metric).collect())


def test_empty_corpus_and_null_queries(spark):
    empty = spark.createDataFrame([], "ebook_no long, embedding array<double>")
    path = T.build_tree(empty, scratch_path(spark, "tree"))
    q = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "qid long, embedding array<double>")
    assert T.knn_tree(q, path, 3).count() == 0


def test_small_tree_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(60, 3))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "ebook_no long, embedding array<double>")
    path = T.build_tree(df, scratch_path(spark, "tree"))
    got = sorted(tuple(r) for r in T.knn_tree(df.withColumnRenamed("ebook_no", "qid"), path, 4).collect())
    assert got == brute(points, np.arange(60), points, np.arange(60), 4)
