"""Periodic runs (op11), the BPE transducer (op12) and the filter audit (op13) against plain versions."""

import hashlib
import random
import zlib
from itertools import permutations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bookbase.llm import audit, bpe, periodic
from bookbase.llm import queries as Q
from tests.llm import edge

WORD = r"[^\x20\x09-\x0D]+"


def brute_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q):
                smallest = min(p for p in range(1, q + 1) if all(words[t] == words[t + p] for t in range(s, e - p)))
                if smallest == q:
                    out.add((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    import re

    words = re.findall(WORD, text or "")
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_equal_brute_force():
    random.seed(7)
    for _ in range(1500):
        n = random.randint(0, 150)
        alphabet = random.choice([1, 2, 3, 6, 40])
        words = [str(random.randrange(alphabet)) for _ in range(n)]
        for _ in range(random.randint(0, 3)):
            if n < 2:
                break
            a, p = random.randrange(n), random.randint(1, 40)
            for i in range(a, n):
                if random.random() < 0.97:
                    words[i] = words[a + (i - a) % p]
        assert periodic.find_runs(words) == brute_runs(words)


def test_run_digest_edges():
    none = periodic.summarise([])
    assert none["n_runs"] == 0 and none["start"] is None and none["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    words = ["x", "y"] * 10 + ["z"]
    out = periodic.summarise(words)
    assert (out["n_runs"], out["start"], out["length"], out["period"], out["exponent_milli"]) == (1, 0, 20, 2, 10000)
    assert out["collapsed_sha256"] == hashlib.sha256(b"x y z").hexdigest()
    assert out["runs_sha256"] == hashlib.sha256(b"0,20,2\n").hexdigest()
    long = periodic.find_runs(["w%d" % (i % 300) for i in range(3000)])
    assert long == [(0, 3000, 300)]


def test_op11_query_on_edge_rows(spark, tmp_path):
    rows = edge.rows() + [(1000, " ".join(["a", "b", "c"] * 40), "en", "a")]
    rows += [(i, " ".join(f"w{j % 17}" for j in range(i)), "en", "a") for i in range(2000, 2300)]
    docs = edge.documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(
        (tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in Q.op11_periodic(spark, str(tmp_path)).collect()),
        key=repr,
    )
    want = sorted(
        (tuple(sorted({"doc_id": d, **periodic.summarise(planted(d, t))}.items(), key=lambda kv: kv[0])) for d, t, *_ in rows),
        key=repr,
    )
    assert got == want
    assert sum(1 for d, t, *_ in rows if d is not None and zlib.crc32(str(d).encode()) % 10 == 0 and t) > 10


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t


def test_bpe_equals_library(library):
    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(5)
    texts = [t for _, t, *_ in edge.rows()]
    texts += ["".join(random.choice("abcdefghijklmnopé") for _ in range(3000)), "x" * 2000, "ab1 " * 300, "\n\n\t  ", "é" * 400]
    for text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        got = list(bpe.Transducer(vocab).encode(text))
        assert got == want
        decoded = "".join(bpe.decode_stream(vocab, got))
        assert decoded == library.decode(want, skip_special_tokens=False)
        n, ids_sha, text_sha = bpe.digest(vocab, text)
        assert n == len(want)
        assert ids_sha == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert text_sha == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_gives_ids_by_the_piece_read(library, monkeypatch):
    """Ids come as one list per piece read or special token, not one per pre-token, at any size of piece."""
    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    text = "ab 12 cd's, " * 50 + "  \n " + "é" * 300
    want = library.encode(text, add_special_tokens=False).ids
    blocks = list(bpe.Transducer(vocab).encode_blocks(text))
    assert len(blocks) == 1 and blocks[0] == want
    for size in (1, 7, 64):
        monkeypatch.setattr(bpe, "CHUNK", size)
        assert list(bpe.Transducer(vocab).encode(text)) == want
        assert bpe.digest(vocab, text)[0] == len(want)


def test_utf8_state_machine_waits_for_whole_characters():
    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    ids = list(bpe.Transducer(vocab).encode("😀é"))
    pieces = list(bpe.decode_stream(vocab, ids, block=1))
    assert "".join(pieces) == "😀é" and all("�" not in p for p in pieces)


def test_op12_query_rows(spark, tmp_path, library):
    rows = edge.rows()
    edge.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.op12_bpe(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] == 6:
            want = library.encode(edge.LONG, add_special_tokens=False).ids
            assert r["n_tokens"] == len(want)


def brute_audit(rows, labels):
    import re

    firsts = {}
    for doc_id, text, *_ in rows:
        t = text or ""
        if doc_id is not None:
            firsts[t] = min(firsts.get(t, doc_id), doc_id)
    marks = {}
    for doc_id, quality, toxic in labels:
        g, x = marks.get(doc_id, (0, 0))
        marks[doc_id] = (max(g, int(quality == 1)), max(x, int(toxic == 1)))
    docs = []
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(WORD, t)
        upper = len(re.findall("[A-Z]", t))
        first = firsts.get(t)
        fails = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * upper > 10 * len(t),
            re.search("[#$%&*|]", t) is not None,
            (first is not None) if doc_id is None else (first is not None and doc_id > first),
        ]
        good, toxic = marks.get(doc_id, (0, 0)) if doc_id is not None else (0, 0)
        docs.append((lang or "", fails, good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shap = {}
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                before = ["ABCDE".index(x) for x in order[: step - 1]]
                removed = [d for d in mine if d[1][k] and not any(d[1][b] for b in before)]
                shap[letter] = shap.get(letter, 0) + len(removed)
                out[(part, "".join(order), step)] = {
                    "kept": sum(1 for d in mine if not d[1][k] and not any(d[1][b] for b in before)),
                    "removed": len(removed),
                    "redundant": sum(1 for d in mine if d[1][k] and any(d[1][b] for b in before)),
                    "unique_fails": sum(1 for d in mine if d[1][k] and sum(d[1]) == 1),
                    "good_lost": sum(d[2] for d in removed),
                    "toxic_lost": sum(d[3] for d in removed),
                    "letter": letter,
                }
        for key, v in out.items():
            if key[0] == part and "letter" in v:
                v["shapley"] = shap[v.pop("letter")]
    return out


def test_audit_equals_brute_force(spark):
    words = " ".join(f"w{i}" for i in range(120))
    extra = [
        (100, words, "en", "a"), (101, words, "en", "a"), (102, words.upper(), "fr", "b"), (103, words + " #", None, "c"),
        (104, " ".join(["same"] * 150), "en", "a"), (None, words, "en", "a"),
    ]
    rows = edge.rows() + extra
    labels = [(100, 1, 0), (101, 1, 1), (101, 0, 0), (5, 0, 1), (None, 1, 1)]
    docs = edge.documents(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.interaction_audit(docs, lab).collect()
    want = brute_audit(rows, labels)
    assert len(got) == len(want) == len({r[2] or "" for r in rows}) * 600
    for r in got:
        assert {k: r[k] for k in want[(r["part"], r["filter_order"], r["step"])]} == want[(r["part"], r["filter_order"], r["step"])]


def test_audit_of_empty_table(spark):
    docs = edge.documents(spark, [])
    assert audit.interaction_audit(docs, None).count() == 0


def test_shards_of_a_task_share_a_vocabulary(spark):
    texts = ["a b a", " \x0bb\tc ", "", "d\x1ca a", "b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "__row long, __text string").coalesce(1)
    made = audit.local_shards(rows, most=6).collect()
    shards, vocabs = [r for r in made if r.words is None], [r for r in made if r.words is not None]
    assert len(shards) > 1 and len(vocabs) == 1
    assert sorted(map(bytes, vocabs[0].words)) == [b"a", b"b", b"c", b"d\x1ca"]
    counts = sorted(map(tuple, audit.word_counts(rows).collect()))
    assert counts == [(0, 3, 2), (1, 2, 2), (2, 0, 0), (3, 2, 2), (4, 1, 1)]


def test_dictionary_gives_a_word_one_id(spark):
    rows = [(1, [b"a", b"b", b"c"]), (2, [b"c", b"\xff", b"a"]), (3, [])]
    made = audit.dictionary(spark.createDataFrame(rows, "vocab long, words array<binary>"), 3).collect()
    ids = {bytes(w): r["first"] + i for r in made if r["vocab"] is None for i, w in enumerate(r["words"])}
    assert len(set(ids.values())) == len(ids) == 4
    got = {(r["vocab"], local): term for r in made if r["vocab"] for local, term in zip(r["locals"], r["terms"])}
    assert got == {(v, i): ids[w] for v, words in rows for i, w in enumerate(words)}


def test_shards_are_few_to_a_file(spark, monkeypatch):
    from pyspark.sql import functions as F

    from bookbase.llm import audit as A

    made, real, local = {}, A.materialise, A.local_shards
    monkeypatch.setattr(A, "materialise", lambda df, name="step", *more: made.setdefault(name, real(df, name, *more)))
    monkeypatch.setattr(A, "local_shards", lambda rows: local(rows, 40))
    rows = spark.createDataFrame([(i, f"a b{i} c c") for i in range(60)], "__row long, __text string").coalesce(1)
    counts = A.word_counts(rows)
    assert counts.count() == 60 and counts.filter("n_words <> 4 OR n_distinct <> 3").count() == 0
    held = [r["count"] for r in made["csr_local"].groupBy(F.input_file_name()).count().collect()]
    assert sum(held) >= 15 and max(held) <= A.FILE_ROWS
