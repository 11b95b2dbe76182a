from collections import Counter

import pytest

import edge
from bookbase.llm import mixing


def shares(sizes, weights=(1, 2, 3), cap=3):
    """Targets by giving what is above the cap to the others until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        unit = (total - sum(full.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * unit > cap * sizes[s] + 1e-9]
        if not over:
            return full | {s: weight[s] * unit for s in free}
        full |= {s: cap * sizes[s] for s in over}


def many(n=3000):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else ("a", "b", "ab", "é", None, "tiny")[i // 3 % 6 if i % 90 else 5]
        rows.append((i, "w " * (1 + i * 7919 % 60), "en", source))
    return rows + [(n, None, "en", "empty"), (n + 1, "", "en", "empty")]


@pytest.mark.parametrize("rows", [many(), edge.rows()[:6] + edge.rows()[7:]])
def test_targets_and_what_is_taken(spark, rows):
    got = mixing.mix_sizes(edge.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(edge.words(t))
    aims = shares(sizes)
    taken = Counter()
    largest = max(len(edge.words(t)) for _, t, *_ in rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(aims[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3 and len(r["shards"]) == r["copies"]
        taken[r["source"]] += r["taken"]
    for s, aim in aims.items():
        assert abs(taken[s] - aim) <= largest


def test_reruns_agree_and_rows_repeat_as_decided(spark):
    docs = edge.documents(spark, many(600))
    decided = {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(docs).collect()}
    assert decided == {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(docs.repartition(7)).collect()}
    made = mixing.mix_documents(docs)
    assert made.columns == docs.columns
    assert Counter(r["doc_id"] for r in made.collect()) == +Counter(decided)


def test_shards_split_every_node_in_halves(spark):
    units = spark.range(1600).selectExpr("concat('s', id % 5) source", "cast(id as int) block", "0 copy")
    got = mixing.split(units, 8).collect()
    assert Counter(r["shard"] for r in got) == {s: 200 for s in range(8)}
    for s in range(5):  # a hypergeometric draw: 40 expected, standard deviation under 6
        assert all(15 < sum(r["shard"] == k and r["source"] == f"s{s}" for r in got) < 65 for k in range(8))


def test_empty_table(spark):
    none = edge.documents(spark, [])
    assert mixing.mix_sizes(none).count() == 0 and mixing.mix_documents(none).count() == 0
