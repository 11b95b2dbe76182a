"""Index generations: appending keeps exact search exact, splits overfull cells, follows the store."""

import pytest
from pyspark.sql import functions as F

from bookbase import fixtures as B
from bookbase.operators import generations as G
from bookbase.operators import knn
from bookbase.plans.catalogue import build_store
from bookbase.session import scratch_path

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r["qid"], r["rank"], r["ebook_no"], r["distance"]) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    return B.vectors(spark, SF).cache()


def exact(spark, store):
    q = store.select(F.col("ebook_no").alias("qid"), "embedding")
    return rows(knn.knn(q, store.select("ebook_no", "embedding"), k=5))


def searched(store, generation):
    q = store.select(F.col("ebook_no").alias("qid"), "embedding")
    return rows(knn.knn_cells(q, generation, 5).withColumnRenamed("cid", "ebook_no"))


def test_appended_generation_equals_exact_search_and_finds_new_rows(spark, vectors):
    path, root = scratch_path(spark, "store"), scratch_path(spark, "gens")
    first = vectors.filter("ebook_no % 3 = 0")
    store, gen0 = G.append_indexed(first, path, root)
    assert gen0.endswith("gen-000000") and store.count() == first.count()
    store, gen1 = G.append_indexed(vectors, path, root)
    assert gen1.endswith("gen-000001") and G.current(spark, root) == gen1
    assert store.count() == vectors.count()
    assert G.vectors(spark, gen1).count() == vectors.count()
    assert searched(store, gen1) == exact(spark, store)
    # A book of the second append is its own nearest neighbour through the index.
    new = vectors.filter("ebook_no % 3 = 1").orderBy("ebook_no").first()
    hit = knn.knn_cells(spark.createDataFrame([(0, new["embedding"])], "qid int, embedding array<float>"), root, 1).first()
    assert hit["cid"] == new["ebook_no"]
    # Nothing new: the same generation.
    assert G.append_indexed(vectors, path, root)[1] == gen1


def test_overfull_cells_split(spark, vectors, monkeypatch):
    monkeypatch.setattr(G, "SPLIT", 0.5)
    path, root = scratch_path(spark, "store"), scratch_path(spark, "gens")
    G.append_indexed(vectors.filter("ebook_no < 40"), path, root)
    before = {r["cell"] for r in spark.read.parquet(f"{G.current(spark, root)}/cells").collect()}
    store, gen = G.append_indexed(vectors, path, root)
    after = spark.read.parquet(f"{gen}/cells").collect()
    assert {r["cell"] for r in after} - before, "a cell was split"
    limit = G.SPLIT * store.count() ** 0.5
    assert sum(r["size"] for r in after) == store.count()
    assert G.vectors(spark, gen).count() == store.count()
    assert searched(store, gen) == exact(spark, store)
    split = {r["cell"] for r in after} - before
    assert all(r["size"] <= limit * 2 for r in after if r["cell"] in split) or len(split) >= 2


def test_sync_rebuilds_for_a_new_store(spark, vectors):
    root = scratch_path(spark, "gens")
    G.sync(vectors.filter("ebook_no < 100"), root)
    smaller = vectors.filter("ebook_no < 50")
    gen = G.sync(smaller, root)
    assert G.vectors(spark, gen).count() == smaller.count()
    assert searched(smaller, gen) == exact(spark, smaller)


def test_build_store_brings_the_index_to_the_store(spark):
    books = B.books(spark, SF)
    path, index = scratch_path(spark, "store"), scratch_path(spark, "index")
    store, where = build_store(books.filter("ebook_no < 60"), path, index)
    assert where == index
    assert knn.index_vectors(spark, index).count() == store.count()


def test_empty_store_gets_an_empty_generation(spark, vectors):
    root = scratch_path(spark, "gens")
    gen = G.sync(vectors.limit(0), root)
    assert G.vectors(spark, gen).count() == 0


@pytest.mark.parametrize("keep", ["ebook_no % 2 = 0", "ebook_no % 97 = 0"])
def test_filtered_search_through_an_index_equals_filtered_exact_search(spark, vectors, keep):
    q = vectors.select(F.col("ebook_no").alias("qid"), "embedding")
    c = vectors.select("ebook_no", "embedding")
    index = knn.build_cells(c, scratch_path(spark, "cells"))
    got = rows(knn.knn(q, c, k=5, where=F.expr(keep), index=index))
    assert got == rows(knn.knn(q, c, k=5, where=F.expr(keep)))
