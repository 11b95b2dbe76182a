import hashlib
from collections import Counter

from pyspark.sql import functions as F

import edge
from bookbase.llm import sampling


def test_edits_and_likeness(spark):
    rows = [r for r in edge.rows() if r[0] != 5] + [(100 + i, " ".join(f"w{j}" for j in range(i, i + 40)), "en", "a") for i in range(80)]
    got = sampling.edited_fingerprints(edge.documents(spark, rows)).select(
        "*", sampling.fingerprint("samples").alias("f"), sampling.likeness("samples", "next_samples").alias("near")
    ).collect()
    assert len(got) == len(rows)
    texts = {d: t or "" for d, t, *_ in rows if d is not None}
    order = sorted(texts, reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    for d, after in zip(order, order[1:]):
        t, n = texts[d], texts[after]
        half = len(t) // 2
        assert by_id[d]["n_chars"] == len(t)
        assert by_id[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
    gap = [by_id[d]["near"] - 39 / 41 for d in range(101, 180)]
    assert abs(sum(gap) / len(gap)) < 0.03
    prints = {}
    for d in texts:
        prints.setdefault(texts[d], set()).add(by_id[d]["f"])
    assert all(len(v) == 1 for v in prints.values())


def test_collision_rate_is_generalised_jaccard(spark):
    a, b = Counter(x=5, y=2, z=1, u=9), Counter(x=3, y=6, z=1, v=4)
    want = sum((a & b).values()) / sum((a | b).values())
    rows = [(i, w, f"{w}{t}") for i in range(150) for w, bag in (("a", a), ("b", b)) for t, n in bag.items() for _ in range(n)]
    terms = spark.createDataFrame(rows, "i int, w string, t string").select("i", "w", F.concat("i", F.substring("t", 2, 9)).alias("term"))
    made = sampling.signatures(terms, ["i", "w"])
    pairs = made.filter("w = 'a'").alias("a").join(made.filter("w = 'b'").alias("b"), "i")
    rate = pairs.select(F.avg(sampling.likeness("a.samples", "b.samples"))).first()[0]
    assert abs(rate - want) < 0.03


def test_few_and_no_rows(spark):
    one = sampling.edited_fingerprints(edge.documents(spark, [(3, "abcd", "en", "a")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert sampling.edited_fingerprints(edge.documents(spark, [])).count() == 0


def test_main_path_has_no_python(spark):
    plan = sampling.edited_fingerprints(edge.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_terms_are_counted_in_their_row(spark):
    texts = ["b a b\tc", "", None, " x ", "ü u ü Ü"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("t", F.coalesce("t", F.lit("")))
    counted = df.select("i", F.inline(sampling.counted_terms(F.col("t"))))
    grouped = df.select("i", F.explode(sampling.terms(F.col("t"))).alias("term"))
    want = grouped.groupBy("i", "term").agg(F.count(F.lit(1)).alias("n")).select("i", F.xxhash64("term").alias("h"), "n")
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, want.collect()))
    made = [sorted(map(tuple, sampling.signatures(x, ["i"]).collect())) for x in (counted, grouped)]
    assert made[0] == made[1] and len(made[0]) == 5
    plan = sampling.signatures(counted, ["i"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
