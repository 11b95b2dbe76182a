import random

import corpus_pipeline
import edge
from bookbase import session
from bookbase.llm import simhash
from bookbase.session import scratch_path


def test_stages_in_order_keep_columns_and_clean_rows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared = [word() for _ in range(60)]
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.randrange(20, 90))]
        if i % 5 == 0:
            words[3:3] = ["idiot", "scumbag"]
        if i in (31, 37):
            words[4:4] = shared
        rows.append((i, " ".join(words), "en", f"s{i % 3}"))
    rows += [(400, rows[1][1], "en", "s0"), (401, rows[2][1] + " more", "en", "s0"), (402, None, "en", None), (403, "", "en", "s1")]
    d = scratch_path(spark, "tables")
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = simhash.materialise(stage(spark, docs, d), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    clean = {i for i in range(300) if i % 5} | {400, 401, 402, 403}
    assert set(ids[0]) == clean
    assert set(ids[1]) == clean - {400, 401, 403}
    assert sorted(ids[2]) == sorted(ids[1])
    assert set(ids[3]) <= set(ids[2])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert {r["doc_id"] for r in packed.collect()} == set(ids[3])
    assert corpus_pipeline.run(spark, d).count() == packed.count()


def test_scratch_of_a_stage_goes_before_the_next(spark, monkeypatch):
    made, path = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: made.append((name, path(spark, name))) or made[-1][1])
    left = lambda: sorted(name for name, at in made if session.path_exists(spark, at))
    rng = random.Random(9)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = new(60)
    rows = [(i, " ".join(new(40) + (shared if i in (3, 8) else [])), "en", "a") for i in range(30)]
    rows.append((30, rows[5][1], "en", "a"))
    kept = corpus_pipeline.drop_copies(spark, edge.documents(spark, rows), None)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    assert left() == ["kept"]
    cut = corpus_pipeline.cut_passages(spark, kept, None)
    assert {r["doc_id"]: len(r["text"].split()) for r in cut.collect() if r["doc_id"] in (3, 8)} == {3: 100, 8: 40}
    assert left() == ["cuts", "kept"] and len(made) > 10
