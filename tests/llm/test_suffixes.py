import random

import edge
from bookbase.llm import suffixes


def brute(rows, length):
    """Word positions in passages shared with another document, and those another one holds first."""
    held, texts = {}, {}
    for d, t, *_ in rows:
        w = (t or "").split()
        texts[d] = w
        for i in range(len(w) - length + 1):
            held.setdefault(tuple(w[i:i + length]), set()).add(d)
    shared, cut = {}, {}
    for d, w in texts.items():
        for i in range(len(w) - length + 1):
            who = held[tuple(w[i:i + length])]
            if len(who) > 1:
                shared.setdefault(d, set()).update(range(i, i + length))
                if min(who) != d:
                    cut.setdefault(d, set()).update(range(i, i + length))
    return shared, cut


def table(n=60, seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    shared = [[word() for _ in range(rng.randrange(45, 90))] for _ in range(6)]
    rows = []
    for d in range(n):
        text = [word() for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            part = rng.choice(shared)
            a = rng.randrange(20)
            text[at:at] = part[a:] if rng.random() < 0.3 else part
        rows.append((d, " ".join(text), "en", "a"))
    return rows + [(n, rows[3][1], "en", "a"), (n + 1, "a b " * 200, "en", "a"), (n + 2, "a b " * 30, "en", "a")]


def test_spans_equal_brute_force(spark):
    rows = table()
    shared, cut = brute(rows, 50)
    got_shared, got_cut = {}, {}
    for r in suffixes.repeats(edge.documents(spark, rows)).collect():
        got_shared[r["id"]] = {i for s in r["spans"] for i in range(s["start"], s["end"])}
        if r["cuts"]:
            got_cut[r["id"]] = {i for s in r["cuts"] for i in range(s["start"], s["end"])}
    assert got_shared == shared
    assert got_cut == cut
    assert len(cut) > 5


def test_texts_lose_what_others_hold(spark):
    rows = table(30, 2)
    _, cut = brute(rows, 50)
    docs = edge.documents(spark, rows)
    made = suffixes.cut_repeats(docs)
    assert made.columns == docs.columns
    for r in made.collect():
        words = rows[r["doc_id"]][1].split()
        assert r["text"].split() == [w for i, w in enumerate(words) if i not in cut.get(r["doc_id"], ())]


def test_other_text_stays_as_it_is():
    assert suffixes.without("a  b\nc\td  ", [(1, 3)]) == "a  d  "
    assert suffixes.without(" a b", [(0, 2)]) == " "


def test_odd_rows(spark):
    docs = edge.documents(spark)
    assert sorted(map(str, (r["text"] for r in suffixes.cut_repeats(docs).collect()))) == sorted(str(r[1]) for r in edge.rows())
    assert suffixes.repeats(docs).count() == 0
    none = edge.documents(spark, [])
    assert suffixes.passage_rows(none).count() == 0 and suffixes.cut_repeats(none).count() == 0


def test_texts_of_one_document_keep_apart(spark):
    rng = random.Random(4)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, clean = new(60), new(200)
    first, second = new(30) + passage + new(90), new(55)
    rows = [
        (1, " ".join(new(10) + passage + new(10)), "en", "a"), (2, " ".join(first), "en", "a"),
        (2, " ".join(clean), "en", "a"), (2, " ".join(second), "en", "a"), (2, "", "en", "a"),
    ]
    docs = edge.documents(spark, rows)
    made = sorted((r["doc_id"], r["text"]) for r in suffixes.cut_repeats(docs).select("doc_id", "text").collect())
    left = " ".join(first[:30] + first[90:])
    assert made == sorted((d, left if i == 1 else t) for i, (d, t, *_) in enumerate(rows))
    spans = sorted((r["doc_id"], r["start_word"], r["end_word"], r["cut_words"]) for r in suffixes.passage_rows(docs).collect())
    assert spans == [(1, 10, 70, 0), (2, 30, 90, 60)]


def test_a_copy_counts_as_another_document(spark):
    rng = random.Random(6)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = new(60)
    copied, other = new(5) + passage + new(5), new(20) + passage
    rows = [(1, " ".join(copied), "en", "a"), (1, " ".join(other), "en", "a"), (5, " ".join(copied), "en", "a")]
    spans = suffixes.passage_rows(edge.documents(spark, rows)).collect()
    got = sorted((r["doc_id"], r["start_word"], r["end_word"], r["cut_words"]) for r in spans)
    assert got == [(1, 0, 70, 0), (1, 20, 80, 0), (5, 0, 70, 70)]
