import zlib
from collections import Counter

import edge
from bookbase.llm import sharding


def test_contract_columns(spark):
    got = sharding.shard_documents(edge.documents(spark), 40).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in edge.rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= r["shard"] < 40 and 0 <= r["grown_shard"] <= 40 for r in got)


def test_growing_moves_rows_into_the_new_shard_only(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    for n in (40, 41, 47):
        both = sharding.shard_rows(sharding.shard_rows(rows, sharding.layout(n)), sharding.layout(n + 1), out="next")
        moved = both.filter("shard <> next").groupBy("next").count().collect()
        assert [r["next"] for r in moved] == [n]
        assert abs(moved[0]["count"] - 40_000 / (n + 1)) < 150


def test_shares_follow_weights_and_movement_stays_in_the_subtree(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    tree = {"r1": {"a": {0: 1.0, 1: 3.0}, "b": {2: 2.0}}, "r2": {"c": {3: 2.0, 4: 0.0}}}
    later = {"r1": {"a": {0: 3.0, 1: 1.0}, "b": {2: 2.0}}, "r2": {"c": {3: 2.0, 4: 0.0}}}
    both = sharding.shard_rows(sharding.shard_rows(rows, tree), later, out="later").collect()
    share = Counter(r["shard"] for r in both)
    for shard, weight in ((0, 1), (1, 3), (2, 2), (3, 2)):
        assert abs(share[shard] / 40_000 - weight / 8) < 0.01
    assert 4 not in share
    assert {(r["shard"], r["later"]) for r in both if r["shard"] != r["later"]} == {(1, 0)}


def test_empty_table(spark):
    assert sharding.shard_documents(edge.documents(spark, []), 40).count() == 0
