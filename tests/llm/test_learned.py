"""Operators with a trained model: held-out quality, exact counts, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest

import edge
from bookbase.llm import language, scoring, toxicity

SYLLABLES = {"en": ["the", "ing", "er", "th", "on", "an"], "de": ["sch", "ung", "keit", "ich", "der", "ü"], "fr": ["eau", "oux", "é", "que", "ment", "è"]}
INSULTS = ["idiot", "clown", "scumbag", "worthless"]


def text(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows, toxic = [], []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        words = text(rng, lang).split()
        bad = i % 4 == 0
        if bad:
            for w in rng.sample(INSULTS, 2):
                if i % 3 == 0:  # with a character put in
                    at = rng.randrange(2, len(w) - 1)
                    w = w[:at] + rng.choice(".-*x") + w[at:]
                words[rng.randrange(len(words))] = w
        rows.append((100 + i, " ".join(words), lang, "a"))
        toxic.append((100 + i, 1, int(bad)))
    return rows, toxic


def test_language_on_held_out_rows(spark, corpus):
    rows = corpus[0] + edge.rows()
    got = language.identify(edge.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    kept = [r for r in corpus[0] if edge.bucket(r[0], 5) == 0]
    assert all(by_id[d]["held_out"] for d, *_ in kept)
    assert sum(by_id[d]["lang_pred"] == lang for d, _, lang, _ in kept) / len(kept) > 0.97
    for d in (0, 1, 2):
        assert (by_id[d]["lang_pred"], by_id[d]["score"], by_id[d]["rejected"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_on_held_out_rows(spark, corpus):
    labels = spark.createDataFrame(corpus[1], "doc_id bigint, quality int, toxic int")
    rows = corpus[0] + edge.rows()
    got = toxicity.score_documents(edge.documents(spark, rows), labels).collect()
    assert len(got) == len(rows)
    truth = {d: y for d, _, y in corpus[1]}
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if edge.bucket(d, 3) == 1}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    docs = edge.documents(spark, rows)
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if not r["predicted"])


def test_kernel_counts_gapped_subsequences():
    rows, code, weight = toxicity.subsequences([b"\x01\x02\x03\x04\x05"])
    found = {(c >> 15, c >> 10 & 31, c >> 5 & 31, c & 31): w for c, w in zip(code.tolist(), weight.tolist())}
    assert len(found) == math.comb(5, 4)
    assert found[(1, 2, 3, 5)] / found[(1, 2, 3, 4)] == pytest.approx(toxicity.DECAY)


def test_scores_are_log_probabilities(spark, corpus, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 150)  # some words go by the join
    rows = corpus[0][:400] + [r for r in edge.rows() if r[0] != 6]
    got = scoring.score_documents(edge.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    train = [edge.words(t) for d, t, *_ in rows if d is None or edge.bucket(d, 10) != 0]
    count = Counter(w for ws in train for w in ws)
    n, v = sum(count.values()) + len(train), len(count) + 1
    known = {}
    for d, t, *_ in rows:
        ws = edge.words(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws) + math.log10((len(train) + 0.1) / (n + 0.1 * (v + 1)))
        known.setdefault(d, []).append((len(ws) + 1, sum(w in count for w in ws) + 1, n, round(base, 6)))
    mine = {}
    for r in got:
        mine.setdefault(r["doc_id"], []).append((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)))
    assert {d: sorted(x) for d, x in mine.items()} == {d: sorted(x) for d, x in known.items()}
    held = [r for r in got if r["held_out"] and r["doc_id"] >= 100]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    triples = np.unique(rng.integers(0, scoring.CLASSES**3, 500))
    table = scoring.train(triples, np.ones(len(triples)), steps=20)
    sums = np.exp(table.astype(float)).sum(1)
    assert np.allclose(sums, 1, atol=1e-4) and np.all(table[:, scoring.START] == -np.inf)


def test_empty_tables(spark):
    none = edge.documents(spark, [])
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert language.identify(none).count() == 0
    assert toxicity.score_documents(none, no_labels).count() == 0
    assert scoring.score_documents(none).count() == 0
    some = edge.documents(spark, edge.rows()[:5])
    assert toxicity.score_documents(some, no_labels).count() == 5


def test_training_sees_every_triple():
    at = lambda a, b, y: (a * scoring.CLASSES + b) * scoring.CLASSES + y
    triples = np.array([at(2, 3, 4), at(50, 51, 60)])
    table = scoring.train(triples, np.array([10**8, 5]))
    assert table[50 * scoring.CLASSES + 51, 60] > np.log(0.05)  # of all tokens it is 5 in 10**8
