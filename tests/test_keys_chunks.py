import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookbase.operators import chunk as C
from bookbase.operators import keys as K


def table(spark, rows):
    return spark.createDataFrame(rows, "title string, author string, ebook_no bigint, pos bigint")


def check_names(bases, names):
    """Keys are unique; each is its base, or the base with the least number free when its turn came."""
    assert len(set(names)) == len(bases)
    turn = {name: i for i, name in enumerate(names)}
    for i, (base, name) in enumerate(zip(bases, names)):
        if name != base:
            number = int(name.removeprefix(f"{base}_"))
            assert number >= 1 and name == f"{base}_{number}"
            passed_over = [base, *(f"{base}_{n}" for n in range(1, number))]
            assert all(turn.get(p, i) < i for p in passed_over)


def test_running_number_with_a_hot_key(spark):
    df = spark.range(3000).select(
        (F.col("id") * 7).alias("pos"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    got = K.running_number(df, "pos", ["k"], slices=16)
    hot = [r["n"] for r in got.filter("k = 'hot'").orderBy("pos").collect()]
    assert hot == list(range(1, 2001)) and got.filter("k <> 'hot' AND n <> 1").count() == 0
    every = [r["n"] for r in K.running_number(df.repartition(5), "pos", slices=9).orderBy("pos").collect()]
    assert every == list(range(1, 3001))


def test_running_number_null_key_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "pos bigint, k string")
    assert [r["n"] for r in K.running_number(df, "pos", ["k"]).orderBy("pos").collect()] == [1, 2, 1]
    assert K.running_number(df.limit(0), "pos").count() == 0


def test_seq_key_skips_used(spark):
    df = table(spark, [("t", "a", i, i * 10) for i in range(40)])
    used = random.Random(1).sample(range(-3, 90), 35)
    got = K.with_seq_key(df, spark.createDataFrame([(u,) for u in used + used], "book_key bigint"))
    free = [i for i in range(1, 200) if i not in used][:40]
    assert [r["book_key"] for r in got.orderBy("pos").collect()] == free


@pytest.mark.parametrize("bases", [
    ["x", "x", "x"], ["x", "x_1", "x"], ["x", "x", "x_1"], ["x_1", "x", "x", "x"], ["x", "x", "x_1", "x_1", "x"],
    ["x", "x", "x_1", "x_1_1", "x_1"], ["x_2", "x", "x", "x", "x_1", "x"], ["x_01", "x", "x"], ["_1", "", ""],
])
def test_name_key_collisions(spark, bases):
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bases)], "title string, pos bigint")
    got = K.with_name_key(df, ["title"]).orderBy("pos").collect()
    check_names(bases, [r["book_key"] for r in got])


def test_name_key_many(spark):
    rng = random.Random(3)
    bases = [rng.choice(["a", "a", "b", "a_1", "a_2", "a_1_1", "b_3", "c_1", "a_4_2"]) for _ in range(300)]
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bases)], "title string, pos bigint")
    got = K.with_name_key(df, ["title"]).orderBy("pos").collect()
    check_names(bases, [r["book_key"] for r in got])


def test_keys_and_batches(spark):
    df = table(spark, [("t", "a", i, i) for i in range(70)])
    assert K.with_hash_key(df).select("book_key").distinct().count() == 70
    assert K.with_uuid(df).select("book_key").distinct().count() == 70
    sizes = K.with_batch(df).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [32, 32, 6]


@pytest.mark.parametrize("n", [0, 1, 150, 1350, 1500, 1501, 2700, 2850, 2851, 9000])
def test_fixed_chunks(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    got = [r["chunk"] for r in C.chunk(spark.createDataFrame([(1, text)], "id int, t string"), "t").orderBy("chunk_no").collect()]
    if n <= 1500:
        assert got == ([text] if n else [])
    else:
        assert all(len(c) == 1500 for c in got[:-1]) and 150 < len(got[-1]) <= 1500
        assert got[0] + "".join(c[150:] for c in got[1:]) == text
        assert all(a[-150:] == b[:150] for a, b in zip(got, got[1:]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n.é", max_size=400), st.integers(2, 40), st.integers(0, 20))
def test_recursive_chunks(text, size, overlap):
    overlap = min(overlap, size // 2)
    chunks = C.recursive_chunks(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    for c in chunks:  # chunks lie in the text in order
        at = text.find(c, at)
        assert at >= 0
    assert set(text) - set(" \n") <= set("".join(chunks))
    for word in text.split():
        if len(word) <= size - 1:
            assert any(word in c for c in chunks)


def test_recursive_prefers_paragraphs():
    assert C.recursive_chunks("aaaa bbbb\n\ncccc dddd", 10, 0) == ["aaaa bbbb", "cccc dddd"]
    assert C.recursive_chunks("one two three four", 10, 4) == ["one two", "two three", "four"]
    assert C.recursive_chunks("x" * 25, 10, 3) == ["x" * 10, "x" * 10, "x" * 10, "x" * 4]


def test_recursive_edges(spark):
    rows = [(1, ""), (2, None), (3, "\n\n\n"), (4, "y" * 1500), (5, "y" * 1501)]
    got = C.chunk(spark.createDataFrame(rows, "id int, t string"), "t", mode="recursive").collect()
    assert sorted((r["id"], len(r["chunk"])) for r in got) == [(4, 1500), (5, 151), (5, 1500)]


def test_chunk_arguments(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    with pytest.raises(ValueError):
        C.chunk(df, "t", 10, 6)
    with pytest.raises(ValueError):
        C.chunk(df, "t", mode="other")
