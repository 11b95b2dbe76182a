import random

import numpy as np
import pytest
import xxhash

import edge
from bookbase.llm import simhash
from bookbase.llm.common import components, number_rows


def plain_print(text, size=3, seed=42):
    w = edge.words(text)
    shingles = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_rule(spark):
    docs = edge.documents(spark)
    got = {(r["doc_id"], r["fp"]) for r in simhash.fingerprints(docs).collect()}
    want = {(d, plain_print(t)) for d, t, *_ in edge.rows()}
    assert {(d, f & (2**64 - 1)) for d, f in got} == want


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = edge.rows()
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy), "en", "a"))
    got = simhash.near_groups(edge.documents(spark, rows)).collect()
    prints = [(r["doc_id"], r["fp"] & (2**64 - 1)) for r in got]
    assert len(got) == len(rows)
    distinct = sorted({f for _, f in prints})
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1:] if (a ^ b).bit_count() <= 2]
    root = edge.groups(pairs, distinct)
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    assert pairs
    for r in got:
        assert r["component_id"] == least.get(root[r["fp"] & (2**64 - 1)])


@pytest.mark.parametrize("levels", [4, 8, 16])
def test_trees_find_every_pair_at_any_depth(spark, levels):
    rng = random.Random(levels)
    start = [rng.getrandbits(64) for _ in range(60)]
    prints = set(start)
    for p in start:
        prints.update(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(3))
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    points = spark.createDataFrame([(s, s) for s in signed], "id bigint, fp bigint")
    found = simhash.links(points, ["fp"], [(0, 0, 32), (0, 32, 32)], levels, 1, 2).collect()
    got = edge.groups([(r["a"], r["b"]) for r in found], signed)
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert got == edge.groups(pairs, signed)


def test_components_of_chains_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 2), (2, 3), (3, 1), (9, 9)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = edge.groups(pairs, {x for p in pairs for x in p})
    assert got == {k: v for k, v in want.items() if k != 9}


def test_near_duplicates_of_five_word_shingles(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        base = [f"w{rng.randrange(50_000)}" for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(rng.randrange(1, 5)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy), "en", "a"))
    rows += [(900, rows[0][1], "en", "a"), (900, rows[0][1], "en", "a"), (901, None, "en", "a"), (902, "", "en", "a"), (None, rows[3][1], "en", "a")]
    kept = simhash.drop_near_duplicates(edge.documents(spark, rows))
    assert kept.columns == edge.documents(spark, rows).columns

    def shingles(t):
        w = edge.words(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}

    sets = {d: shingles(t) for d, t, *_ in rows if d is not None}
    names = sorted(sets)
    pairs = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1:]
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(edge.groups(pairs, names).values()))


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "same text here for all", "en", "a")] * 2 + [(5, "other words stand in this one", "en", "a")] * 3
    kept = simhash.drop_near_duplicates(edge.documents(spark, rows)).select("doc_id", "text").collect()
    assert sorted(kept, key=str) == sorted([(None, rows[0][1]), (5, rows[2][1])], key=str)


def test_empty_table(spark):
    none = edge.documents(spark, [])
    assert simhash.near_groups(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_numbers_are_gapless_in_hot_groups(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 2 END AS k")
    got = number_rows(df, ["k"], ["id"], "n").collect()
    for k in (None, 0, 1):
        part = sorted(r["n"] for r in got if r["k"] == k)
        assert part == list(range(len(part)))


def shingled(text):
    w = edge.words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def kept_by_brute_force(rows):
    sets = {d: shingled(t) for d, t, *_ in rows}
    names = sorted(sets)
    pairs = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1:]
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    assert pairs
    return sorted(set(edge.groups(pairs, names).values()))


def test_near_duplicates_with_parts_added_cut_off_or_swapped(spark):
    rng = random.Random(8)
    texts = []
    for i in range(60):
        base = [f"w{rng.randrange(50_000)}" for _ in range(200)]
        more = [f"v{rng.randrange(50_000)}" for _ in range(rng.randrange(40, 52))]
        cut = rng.randrange(38, 44)
        texts += [base, [base + more, base[cut:], base[:-cut], base[120:] + base[:120]][i % 4]]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]
    kept = simhash.drop_near_duplicates(edge.documents(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_brute_force(rows)


def test_near_duplicates_over_a_small_vocabulary(spark):
    rng = random.Random(9)
    names, texts = [f"w{i}" for i in range(20)], []
    for i in range(60):  # all of the same distinct words
        base = [rng.choice(names) for _ in range(300)] + names
        texts += [base, base[:150] + base[160:]] if i % 3 == 0 else [base]
    line = [f"line{i}" for i in range(60)]  # in most of them, and most of some
    texts += [line + [f"x{rng.randrange(10**6)}" for _ in range(rng.choice([9, 14, 19]))] for _ in range(60)]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]
    kept = simhash.drop_near_duplicates(edge.documents(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_brute_force(rows)


def test_large_leaves_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    rng = random.Random(12)
    start = rng.getrandbits(64)
    prints = {start}
    while len(prints) < 300:  # near one another, so that they crowd in few leaves
        p = rng.choice(sorted(prints))
        prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    points = spark.createDataFrame([(s, s) for s in signed], "id bigint, fp bigint")
    parts = [(0, 0, 32), (0, 32, 32)]
    sizes = simhash._dealt(simhash.leaves(points, ["fp"], parts, 4, 1), ["fp"]).groupBy("leaf", "i", "j").count().collect()
    assert max(r["j"] for r in sizes) > 0 and max(r["count"] for r in sizes) < 160
    found = {(r["a"], r["b"]) for r in simhash.links(points, ["fp"], parts, 4, 1, 2).collect()}
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert found <= {(min(p), max(p)) for p in pairs}
    assert edge.groups(found, signed) == edge.groups(pairs, signed)


def test_near_duplicates_come_from_the_forest_and_few_pairs_from_a_shared_line(spark, monkeypatch):
    """Unlike texts that share a line make few pairs, near copies meet in the forest, and the groups are exact."""
    rng = random.Random(8)
    line = " ".join(f"common{i}" for i in range(9))
    body = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    rows = [(i, f"{line} {body()}", "en", "s") for i in range(300)]
    rows += [(1000 + i, rows[i][1].upper(), "en", "s") for i in range(0, 30, 3)]
    made, write = {}, simhash.materialise

    def counted(df, name="step"):
        out = write(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    pairs, forest = [], simhash.forest_pairs
    monkeypatch.setattr(simhash, "forest_pairs", lambda *a: (pairs.append(forest(*a).count()), forest(*a))[1])
    monkeypatch.setattr(simhash, "materialise", counted)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(edge.documents(spark, rows)).select("doc_id").collect()}
    assert kept == set(range(300)) and pairs[0] >= 10
    assert made["candidates"] < 3 * len(rows)


def test_long_unlike_texts_of_one_bucket_are_not_paired(spark, monkeypatch):
    """Classes grow with the text, so long texts that share a passage alone are told apart; those of which one
    has twice as many classes are still found."""
    rng = random.Random(9)
    body = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = body(80)
    unlike = [passage + body(1500) for _ in range(3)]
    long = body(2100)  # 2,096 shingles, and 1,946 without the last words: 4,096 classes and 2,048
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate([*unlike, long, long[:-150]])]
    asked, alike = [], simhash._alike

    def counted(rows, points, near, *a):
        asked.append(near.count())
        return alike(rows, points, near, *a)

    monkeypatch.setattr(simhash, "_alike", counted)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(edge.documents(spark, rows)).select("doc_id").collect()}
    assert kept == {0, 1, 2, 3}
    assert len(asked) > 1 and sum(asked[1:]) == 0


def test_groups_whose_texts_have_different_numbers_of_classes(spark):
    """Groups of three texts of 1,900 to 2,200 shingles, with 2,048 or 4,096 classes, equal brute force."""
    rng = random.Random(10)
    body = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(4):
        base = body(1900)
        rows += [(10 * i, base), (10 * i + 1, base + body(300)), (10 * i + 2, base[100:] + body(250))]
    rows = [(i, " ".join(w), "en", "s") for i, w in rows]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(edge.documents(spark, rows)).select("doc_id").collect()}
    assert kept == set(kept_by_brute_force(rows))
