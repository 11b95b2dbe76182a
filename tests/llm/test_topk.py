import math
import random

import pytest

from bookbase.llm import topk


def brute(rows, k):
    fine = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for q, a in fine:
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b)]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return {q: v for q, v in out.items() if v}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score int, cell string")


def found(df, k):
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 20 = 0"), k).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


@pytest.mark.parametrize("clustered", [True, False])
def test_equals_brute_force(spark, clustered, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "PAGE", 3)
    rng = random.Random(1)
    rows = []
    for i in range(600):
        centre = i % 7 if clustered else rng.random()
        rows.append((i, [0.3 * math.sin(centre * j + j) + rng.gauss(0, 0.02 if clustered else 0.3) for j in range(16)]))
    rows += [(700 + i, rows[0][1]) for i in range(60)]  # ties and a hot vector
    rows += [(800, None), (801, [None] * 16), (802, [float("nan")] * 16), (803, [float("inf")] + [0.0] * 15), (None, rows[1][1])]
    rows += [(820, [0.5] * 4), (821, [0.25] * 4), (840, [0.0] * 16)]
    df = vectors(spark, rows)
    assert found(df, 20) == brute(rows, 20)


def test_few_and_no_rows(spark):
    assert found(vectors(spark, []), 5) == {}
    assert found(vectors(spark, [(0, [1.0, 2.0])]), 5) == {}
    assert found(vectors(spark, [(0, [1.0, -2.0]), (7, [0.5, 0.5])]), 5) == {0: [(1, 7, -2048)]}
