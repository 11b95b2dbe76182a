import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookbase.functions import text as X


def test_strip_dates(one):
    texts = ["Dickens, Charles, 1812-1870", "Éa – b?", "x²y 12", "1999"]
    assert one(X.strip_dates, *texts) == ["Dickens, Charles,", "Éa b", "xy", ""]


def test_digits_are_pythons(spark):
    chars = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    # A block per row keeps the table small; what is left holds no digit and nothing else is lost.
    rows = [("".join(chars[i : i + 4096]),) for i in range(0, len(chars), 4096)]
    left = spark.createDataFrame(rows, "t string").select("t", F.regexp_replace("t", f"[{X.DIGIT}]", "").alias("k"))
    odd = {c for r in left.collect() for c in set(r["t"]) if (c in r["k"]) == c.isdigit()}
    # Digits of scripts newer than the Unicode tables of one of the two sides may differ.
    assert all(ord(c) > 0xFFFF for c in odd) and len(odd) <= 40


def test_blanks_are_pythons(spark):
    chars = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    rows = [("".join(chars[i : i + 4096]),) for i in range(0, len(chars), 4096)]
    left = spark.createDataFrame(rows, "t string").select("t", F.regexp_replace("t", X.BLANKS, "").alias("k"))
    odd = {c for r in left.collect() for c in set(r["t"]) if (c in r["k"]) == c.isspace()}
    assert not odd


def test_clean_text(one):
    texts = ["A ``quoted'' \r\n\t ÉTÉ; (x)", "'''", "it's", "  ", "“a”: b, c"]
    want = ["a quoted été x", "'", "it's", "", "a b c"]
    assert one(X.clean_text, *texts) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aÉ `“”():;,'\n\r\t\xa0 .?-–1²", max_size=30), min_size=2, max_size=20))
def test_clean_text_any(one, texts):
    made = one(X.clean_text, *texts)
    for text, clean in zip(texts, made):
        assert not set(clean) & set("`“”():;,\n\r\t\xa0") and "''" not in clean
        assert clean == clean.lower() and clean == " ".join(clean.split(" ")).strip() and "  " not in clean
        letters = lambda t: [c for c in t.lower() if c.isalnum()]
        assert letters(clean) == letters(text)
    assert one(X.clean_text, *made) == made or any("''" in t for t in texts)
    assert one(X.has_words, *texts) == [c != "" for c in made]
    assert one(X.words, *texts) == [t.split() for t in texts]
    assert one(X.title_case_tokens, *texts) == [list(dict.fromkeys(w for w in t.split() if w.istitle())) for t in texts]


def test_stopwords_compare_in_lower_case(one):
    assert one(lambda c: X.drop_stopwords(c, X.STOP_WORDS), "The whale AND the sea", "the and") == ["whale sea", ""]


def test_keyword_tokens(one):
    got = one(lambda c: X.keyword_tokens(c, X.STOP_WORDS), "The Whale, a moby-dick x2 été_1 été.")
    assert got == ["whale", "moby", "dick", "été"]


def test_title_case_tokens(one):
    words = "O'Brien McDonald A AB 2Nd Hello, 123 Éà Ahab, Ahab Ahab"
    assert one(X.title_case_tokens, words) == [w for w in dict.fromkeys(words.split()) if w.istitle()]


def test_name_spans(one):
    text = (
        "Captain Ahab met Mary Ann Evans, Queen Victoria and O'Brien McDonald. John Smith left. "
        "We saw The Great Gatsby by John Smith's \"Jane Eyre\" today"
    )
    assert one(lambda c: X.name_spans(c, X.STOP_WORDS), text) == [
        "Mary Ann Evans", "Queen Victoria", "O'Brien McDonald", "Great Gatsby", "John Smith", "Jane Eyre",
    ]
    assert one(lambda c: X.name_spans(c, X.STOP_WORDS), "", "no names here") == [[], []]


@pytest.mark.parametrize("n,want", [(2, "a\nb"), (3, "a\nb\nc"), (50, "a\nb\nc"), (None, "a\r\nb\rc\n")])
def test_first_lines(one, n, want):
    assert one(lambda c: X.first_lines(c, n), "a\r\nb\rc\n") == want


@given(st.text(alphabet="ab\n\r\v\f\x1c\x1d\x1e\x85\u2028\u2029 ", max_size=12))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_first_lines_are_pythons(one, text):
    for n in (1, 2, 50):
        assert one(lambda c: X.first_lines(c, n), text) == "\n".join(text.splitlines()[:n])
