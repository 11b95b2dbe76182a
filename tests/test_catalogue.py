import pytest
from pyspark.sql import functions as F

from bookbase.operators import clean as C
from bookbase.operators import lemma as M
from bookbase.session import scratch_path
from bookbase.sources import catalogue as S
from bookbase.sources import pages as P
from bookbase.sources import vectors as V


def raw(spark, rows):
    schema = ", ".join(f"`{f}` string" for f in S.CLEAN_FIELDS)
    return spark.createDataFrame(rows, schema)


def test_raw_file_as_others_write_it(spark, tmp_path):
    header = "Author,Title,Note,Summary,Language,LoC Class,LoC Class,Subject,Category,EBook-No.,Release Date,Most Recently Updated,Copyright Status,Downloads"
    body = 'A,"T ""q"", x",,"line 1\nline 2",en,PS,PS,S,Text,7,d,,free,1\r\nB,U,,s,en,PS,PS,,Text,8,d,,free,1\r\n'
    (tmp_path / "raw.csv").write_bytes(b"\xef\xbb\xbf" + (header + "\r\n" + body).encode())
    got = S.read_raw_catalogue(spark, str(tmp_path / "raw.csv")).orderBy("pos").collect()
    assert [r["Title"] for r in got] == ['T "q", x', "U"] and got[0]["Summary"] == "line 1\nline 2"
    assert got[1]["Subject"] is None and [r["pos"] for r in got] == [0, 1]
    assert S.read_raw_catalogue(spark, str(tmp_path / "raw.csv"), 1).count() == 1


def test_position_over_many_files(spark):
    path = scratch_path(spark, "raw")
    df = spark.range(1000).select(F.col("id").alias("page_id"), *[F.col("id").cast("string").alias(f) for f in S.RAW_FIELDS])
    S.write_raw_catalogue(df.repartition(7), path)
    got = S.read_raw_catalogue(spark, path, None)
    assert got.filter(F.col("pos") != F.col("`EBook-No.`").cast("long")).count() == 0 and got.count() == 1000


def test_clean_round_trip(spark):
    path = scratch_path(spark, "clean")
    rows = [("a;b", 'q "x"', "l1\nl2", None, "1", ""), ("", "t", "s", "u", "2", "d")]
    S.write_clean_catalogue(raw(spark, rows).coalesce(1), path)
    got = S.read_clean_catalogue(spark, path).orderBy("pos").collect()
    assert got[0]["Author"] == "a;b" and got[0]["Summary"] == "l1\nl2" and got[0]["Subject"] is None
    assert got[1]["Author"] is None and got[1]["Title"] == "t"


def test_clean_source_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_clean_catalogue(spark, str(tmp_path / "none.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        S.read_clean_catalogue(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "bad.csv").write_text(";".join(S.CLEAN_FIELDS) + "\na;b;c\n")
    with pytest.raises(Exception):
        S.read_clean_catalogue(spark, str(tmp_path / "bad.csv")).collect()


def test_text_to_map(spark):
    df = spark.createDataFrame([("k: a: b\nno field\nx:y\n z : 1 \nk: last",), ("",)], "t string")
    got = [r["fields"] for r in S.text_to_map(df, "t").collect()]
    assert got == [{"k": "last", "z": "1"}, {}]


def test_fill_missing(spark):
    marks = ["", "NA", "None", "null", "nan", None, " "]
    got = C.fill_missing(raw(spark, [(m, "t", "s", "u", "1", "d") for m in marks])).collect()
    assert [r["Author"] for r in got] == ["undefined author"] * 6 + [" "]


def test_require_columns(spark):
    df = raw(spark, [("a", "b", "c", "d", "e", "f")])
    assert C.require_columns(df) is df
    with pytest.raises(ValueError):
        C.require_columns(df.drop("Title"))
    with pytest.raises(ValueError):
        C.require_columns(df.limit(0))


CASES = {
    "whales": "whale", "glasses": "glass", "boxes": "box", "buzzes": "buzz", "churches": "church", "dishes": "dish",
    "women": "woman", "cities": "city", "wolves": "wolf", "unknowns": "unknowns", "as": "a", "mice": "mouse", "s": "s",
}


def word_lists(spark):
    known = ["whale", "glass", "box", "buzz", "church", "dish", "woman", "city", "wolf", "a", "mouse"]
    vocab = spark.createDataFrame([(w,) for w in known], "word string")
    return vocab, spark.createDataFrame([("mice", "mouse")], "word string, lemma string")


def test_lemma(spark):
    vocab, irregular = word_lists(spark)
    rows = [(i, f"{w}  {w} z") for i, w in enumerate(CASES)] + [(98, ""), (99, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    want = [f"{x} {x} z" for x in CASES.values()] + ["", None]
    got = M.lemmatise(df, ["t"], vocab, irregular)
    assert [r["t"] for r in got.orderBy("id").collect()] == want


def test_lemma_with_a_large_word_list_and_odd_names(spark):
    vocab, _ = word_lists(spark)
    many = vocab.union(spark.range(600_000).selectExpr("concat('w', id) AS word"))
    df = spark.createDataFrame([("whales w17s", "boxes")] * 3, "`EBook-No.` string, `b c` string")
    for words in (vocab, many):
        got = M.lemmatise(df, ["EBook-No.", "b c"], words).collect()
        assert [tuple(r) for r in got] == [("whale w17" if words is many else "whale w17s", "box")] * 3


def test_clean_catalogue(spark):
    vocab = spark.createDataFrame([(w,) for w in ["whale", "sea", "ship", "dickens"]], "word string")
    summary = "The Whales, of the seas! " + "ships " * 30
    df = raw(spark, [("Dickens, Charles, 1812-1870", "The Whales", summary, "Seas; ships", "7", "None")])
    got = C.clean_catalogue(df, vocab).first()
    assert got["Author"] == "dickens charles" and got["Title"] == "whale" and got["Subject"] == "sea ship"
    assert got["Summary"] == " ".join(["whale", "sea"] + ["ship"] * 18)
    assert got["EBook-No."] == "7" and got["Release Date"] == "undefined release date"
    assert got.asDict().keys() == dict.fromkeys(S.CLEAN_FIELDS).keys()


def test_all_stop_word_summary_is_empty(spark):
    vocab = spark.createDataFrame([("x",)], "word string")
    got = C.clean_catalogue(raw(spark, [("a b", "t", "the and of", "s", "1", "d")]), vocab).first()
    assert got["Summary"] == ""


def test_failed_pages_are_left_out(spark):
    path = scratch_path(spark, "pages")
    rows = [(0, "u", "x", 200), (1, "v", "y", 404)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, status int").write.parquet(path)
    assert [r["page_id"] for r in P.read_pages(spark, path).collect()] == [0]
    assert P.page_ids(spark, 3, "/b/%d").collect()[0]["url"] == "/b/0"


def store(spark, keys):
    rows = [(k, i, "t", [1.0]) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "book_key string, ebook_no bigint, text string, embedding array<float>")


def test_load_or_create_changes_nothing(spark):
    path = scratch_path(spark, "store")
    assert V.load_or_create(spark, path, lambda: store(spark, "ab")).count() == 2
    assert V.load_or_create(spark, path, lambda: store(spark, "abcdef")).count() == 2


def test_append_skips_known_and_repeated(spark):
    path = scratch_path(spark, "store")
    V.append_vectors(store(spark, "ab"), path)
    V.append_vectors(store(spark, "bccd"), path)
    assert V.append_vectors(store(spark, ""), path).count() == 4
    assert V.describe_vectors(store(spark, "")).first()["note"] != ""


def test_store_is_told_by_its_data(spark):
    from bookbase.session import path_exists, scratch_path
    from bookbase.sources import vectors as V

    made = spark.createDataFrame([("k1", [1.0]), ("k2", [2.0])], "book_key string, embedding array<double>")
    path = scratch_path(spark, "store")
    V.load_or_create(spark, path, lambda: made)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(hadoop(f"{path}/_SUCCESS"), False)
    assert not path_exists(spark, f"{path}/_SUCCESS")
    assert V.load_or_create(spark, path, lambda: made.limit(0)).count() == 2
    assert V.append_vectors(made, path).count() == 2
    system.mkdirs(hadoop(f"{path}/_temporary"))
    with pytest.raises(RuntimeError):
        V.append_vectors(made, path)


def test_scopes_in_two_threads_keep_apart(spark):
    import threading

    from bookbase.session import materialise, scratch_scope

    first_in, second_out, seen = threading.Event(), threading.Event(), []

    def first():
        with scratch_scope(spark):
            table = materialise(spark.range(5))
            first_in.set()
            second_out.wait(60)
            seen.append(table.count())

    thread = threading.Thread(target=first)
    thread.start()
    first_in.wait(60)
    with scratch_scope(spark):
        materialise(spark.range(3)).count()
    second_out.set()
    thread.join()
    assert seen == [5]


def test_catalogue_to_books_and_store(spark):
    from bookbase.plans import catalogue as P
    from bookbase.session import scratch_path

    rows = [(1, "A", "T", "whales swim", "S", "10", "Whales Swim In Town"), (2, "B", "U", "", "S", "x", ""), (3, "C", "V", "", "S", "12", None)]
    clean = spark.createDataFrame(rows, "page_id bigint, Author string, Title string, Summary string, Subject string, `EBook-No.` string, `Raw Summary` string")
    books = P.books_from_catalogue(clean)
    assert [tuple(r) for r in books.orderBy("pos").select("ebook_no", "summary", "pos").collect()] == [
        (10, "Whales Swim In Town", 1), (None, "", 2), (12, "", 3)
    ]
    assert P.dropped_books(books).first().asDict() == {"books": 3, "dropped": 2}
    path, index = scratch_path(spark, "store"), scratch_path(spark, "index")
    store, where = P.build_store(books, path, index)
    assert store.count() == 1 and where == index
    assert P.build_store(books.limit(0), path, index)[0].count() == 1
    with pytest.raises(ValueError):
        P.books_from_catalogue(clean.drop("Title"))


def test_lemmas_by_table_and_by_join_agree(spark, monkeypatch):
    """A small table of changed words goes to the tasks: no text is taken apart into rows of words and put together again."""
    from bookbase.operators import lemma

    df = spark.createDataFrame(
        [(1, "two  Cats cats boxes men", "boys"), (2, "", None), (3, None, "cats boxes"), (1, "two  Cats cats boxes men", "boys"), (4, " ", "x")],
        "id int, `a.b` string, t string",
    )
    vocab = spark.createDataFrame([(w,) for w in ("cat", "box", "boxe", "man", "boy", "cat")], "word string")
    told = lemma.lemmatise(df, ["a.b", "t"], vocab)
    assert "collect_list" not in told._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(repr, told.collect()))
    monkeypatch.setattr(lemma, "MAX_LEMMAS", 0)
    assert got == sorted(map(repr, lemma.lemmatise(df, ["a.b", "t"], vocab).collect()))
    assert any("two Cats cat box man" in g for g in got)
