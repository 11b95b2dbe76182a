"""Lookups for whole tables of requests(qid, text).

Every request keeps its row; a miss gives the default. `store` is a vector table with
`ebook_no`, `text`, `meta` and `embedding`; `books` has `ebook_no`, `title`, `author`,
`subject`, `summary` and `pos`.
"""

import re
from re import _parser as sre

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookbase.functions import text as X
from bookbase.operators.embed import embed_cleaned
from bookbase.operators.joins import fits, lookup_join
from bookbase.operators.knn import knn
from bookbase.session import materialise

NO_AUTHOR = "author not found"
NO_SUBJECT = "subject not found"
NO_TITLE = "title not found"
NO_TEXT = "text not found"
NO_CHARACTERS = "no character found"

GRAM = 3
PARTS = 16
MAX_PATTERNS = 5_000
MAX_PATTERN_BYTES = 4 << 20
TITLE_BLOCK = 50_000


def default_embedder(column="text"):
    """The engine's own vectors of the cleaned text."""

    def run(df):
        return embed_cleaned(df, column)

    return run


def nearest(requests: DataFrame, store: DataFrame, k=1, metric="l2", where=None, embedder=None, index=None) -> DataFrame:
    """(qid, rank, ebook_no, distance) of the k nearest books of each request.

    A request table that has an `embedding` already is taken as it is. `index`, written by
    `build_cells` for the store, is searched in its place; all lookups hand theirs on.
    """
    if "embedding" not in requests.columns:
        requests = (embedder or default_embedder())(requests.withColumn("text", X.norm_query("text")))
    return knn(requests, store, k, metric, where, index=index)


def _looked_up(requests, store, value, embedder, index=None):
    """(qid, found value) of the nearest book; the value is worked out for the hit books only."""
    hits = materialise(nearest(requests, store, 1, embedder=embedder, index=index), "hits")
    wanted = store.join(hits.select("ebook_no").distinct(), "ebook_no", "left_semi")
    values = wanted.select("ebook_no", value.alias("value"))
    return lookup_join(hits, values, "ebook_no", "qid").select("qid", "value")


def _answered(requests, found, default):
    answers = requests.select("qid").join(found, "qid", "left")
    return answers.select(
        "qid",
        F.coalesce("value", default).alias("answer"),
        F.col("value").isNotNull().alias("found"),
    )


def _scalar(df, column):
    """The column, or its first element when it is a list."""
    field = df.select(column).schema[0]
    c = F.col(column)
    return F.try_element_at(c, F.lit(1)) if isinstance(field.dataType, T.ArrayType) else c


def author_by_title(requests, store, default=NO_AUTHOR, embedder=None, index=None) -> DataFrame:
    """Author of the nearest book."""
    found = _looked_up(requests, store, F.col("meta.author"), embedder, index)
    return _answered(requests, found, F.lit(default))


def subject_by_title(requests, store, default=NO_SUBJECT, embedder=None, index=None) -> DataFrame:
    """Subject of the nearest book; the first one when there are several."""
    found = _looked_up(requests, store, _scalar(store, "meta.subject"), embedder, index)
    return _answered(requests, found, F.lit(default))


def characters_by_title(requests, store, summary="text", stop=None, rule="spans", default=NO_CHARACTERS, embedder=None, index=None) -> DataFrame:
    """Names in the summary of the nearest book, as a list; `rule` is `spans` or `title_case`.

    `summary` should be text in its own case: the rules look for capitals.
    """
    names = X.name_spans(summary, stop or X.STOP_WORDS) if rule == "spans" else X.title_case_tokens(summary)
    found = _looked_up(requests, store, F.when(F.size(names) > 0, names), embedder, index)
    return _answered(requests, found, F.array(F.lit(default)))


def text_by_title(requests, store, texts: DataFrame, lines=50, default=NO_TEXT, embedder=None, index=None) -> DataFrame:
    """The first `lines` lines of the nearest book's text, or all of it when None.

    texts(ebook_no, text). A request without a near book gets the default; a book without a
    text gives null, as a failed fetch would.
    """
    hits = materialise(nearest(requests, store, 1, embedder=embedder, index=index), "hits")
    wanted = texts.join(hits.select("ebook_no").distinct(), "ebook_no", "left_semi")
    heads = wanted.select("ebook_no", X.first_lines("text", lines).alias("value"))
    found = lookup_join(hits, heads, "ebook_no", "qid").select("qid", "value", F.lit(True).alias("hit"))
    answers = requests.select("qid").join(found, "qid", "left")
    return answers.select(
        "qid",
        F.when(F.col("hit"), F.col("value")).otherwise(F.lit(default)).alias("answer"),
        F.coalesce(F.col("value").isNotNull(), F.lit(False)).alias("found"),
    )


def books_by_author(requests, store, k=5, mode="nearest", default=NO_TITLE, embedder=None, index=None) -> DataFrame:
    """Titles for an author request, as a list; empty when there are none.

    `nearest`: titles of the k nearest summaries in rank order, as a list in one row. `exact`: all
    titles of the author that equals the request but for case, a row for each; a request
    without any has one row, not found.
    """
    none = F.array().cast("array<string>")
    titles_of = F.coalesce(F.transform("t", lambda x: F.coalesce(x["title"], F.lit(default))), none)
    answer = ["qid", titles_of.alias("answer"), F.col("t").isNotNull().alias("found")]
    if mode == "exact":
        return _books_of_author(requests, store, default)
    hits = materialise(nearest(requests, store, k, embedder=embedder, index=index), "hits")
    titles = store.join(hits.select("ebook_no").distinct(), "ebook_no", "left_semi").select(
        "ebook_no", "meta.title"
    )
    found = lookup_join(hits, titles, "ebook_no", "qid")
    # At most k rows per request.
    lists = found.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "title"))).alias("t"))
    return requests.select("qid").join(lists, "qid", "left").select(*answer)


def _books_of_author(requests, store, default):
    """A row for each request and book of its author."""
    books = store.select(
        F.lower("meta.author").alias("author"), "ebook_no", F.coalesce("meta.title", F.lit(default)).alias("title")
    )
    asked = requests.select("qid", X.norm_query("text").alias("author"))
    met = asked.join(books, "author", "left")
    return met.select(
        "qid", "ebook_no", F.coalesce("title", F.lit(default)).alias("answer"), F.col("ebook_no").isNotNull().alias("found")
    )


# --- pattern lookup --------------------------------------------------------------------------


def _pieces(c, lengths):
    """Distinct substrings of the given lengths, as an array."""
    def of_length(n):
        spots = F.sequence(F.lit(1), F.length(c) - (n - 1))
        cut = F.transform(spots, lambda i: F.substring(c, i, F.lit(n)))
        return F.when(F.length(c) >= n, cut).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of_length(n) for n in lengths]))


def first_match(requests: DataFrame, books: DataFrame, columns=("author",), literal=True) -> DataFrame:
    """(qid, *columns) of the first book in file order whose title holds the request.

    Case does not count. `literal=False` reads each request as a regular expression; one that
    does not compile matches nothing. Requests without a match have no row.

    Copies of a title and of a request are collapsed first, and only titles and positions are
    moved; the other columns are fetched for the matched books at the end.
    """
    key = F.lower("title") if literal else F.col("title")
    titles = books.groupBy(key.alias("key")).agg(F.min("pos").alias("pos"))
    titles = materialise(titles, "titles").filter("key IS NOT NULL")
    want = F.lower("text") if literal else F.col("text")
    r = requests.filter(F.col("text").isNotNull()).select("qid", want.alias("want"))
    wants = r.select("want").distinct()
    best = _literal_match(wants, titles) if literal else _regex_match(wants, titles)
    matched = lookup_join(r, best, "want", "qid", how="inner").select("qid", "pos")
    matched = materialise(matched, "matched")
    return lookup_join(matched, books.select("pos", *columns), "pos", "qid", how="inner").select("qid", *columns)


def _literal_match(wants, titles):
    """(want, pos) by n-grams: a title that holds the request holds all grams of the request.

    A request of at most GRAM characters is a gram itself and takes the first position of that
    gram. A longer one asks for its rarest gram alone, and the titles of that gram are tested.
    The titles of a gram and the requests for it are dealt over PARTS parts.
    """
    lengths = range(1, GRAM + 1)
    stats = (
        titles.select("pos", F.explode(_pieces(F.col("key"), lengths)).alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("df"), F.min("pos").alias("pos"))
    )
    # Texts of requests can be long: their grams carry a number in their place. A request longer than
    # every title is in none.
    longest = titles.agg(F.max(F.length("key"))).first()[0] or 0
    wants = wants.filter(F.length("want") <= longest).withColumn("no", F.monotonically_increasing_id())
    wants = materialise(wants, "wants")
    whole = F.length("want") <= GRAM
    grams = F.when(whole, F.array("want")).otherwise(_pieces(F.col("want"), [GRAM]))
    asked = wants.filter("want <> ''").select("no", F.explode(grams).alias("gram"))
    # A gram no title has rules the request out: the left join keeps it with a count of zero.
    rated = lookup_join(asked, stats, "gram", "no").select("no", "gram", "pos", F.coalesce("df", F.lit(0)).alias("df"))
    rarest = rated.groupBy("no").agg(F.min(F.struct("df", "gram", "pos")).alias("pick")).filter("pick.df > 0")
    rarest = materialise(rarest.join(wants, "no").select("want", "pick"), "grams")

    short = rarest.filter(whole).select("want", "pick.pos")
    # An empty request is found in every title.
    empty = wants.filter("want = ''").join(
        titles.agg(F.min("pos").alias("pos")).filter("pos IS NOT NULL").withColumn("want", F.lit("")), "want"
    )
    parts = F.array(*[F.lit(i).cast("bigint") for i in range(PARTS)])
    left = rarest.filter(~whole).select("want", F.col("pick.gram").alias("gram"), F.explode(parts).alias("part"))
    right = titles.select("key", "pos", F.explode(_pieces(F.col("key"), [GRAM])).alias("gram")).withColumn(
        "part", F.pmod(F.xxhash64("key"), F.lit(PARTS))
    )
    tested = left.join(right, ["gram", "part"]).filter(F.col("key").contains(F.col("want")))
    long = tested.groupBy("want").agg(F.min("pos").alias("pos"))
    return short.unionByName(empty.select("want", "pos")).unionByName(long)


def required_literal(pattern):
    """A run of ASCII characters, in lower case, that every match of `pattern` holds; '' without one of GRAM."""
    try:
        parsed = sre.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return ""
    return _longest_run(parsed)


def _longest_run(items):
    """The longest run of ASCII literals (lower case) that every match of the parsed `items` holds; '' if under GRAM."""
    runs = [""]

    def walk(items):
        for op, value in items:
            if op is sre.LITERAL and value < 128:
                runs[-1] += chr(value).lower()
                continue
            runs.append("")
            if op is sre.SUBPATTERN:
                walk(value[-1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
                walk(value[-1])
            runs.append("")

    walk(items)
    best = max(runs, key=len)
    return best if len(best) >= GRAM else ""


def required_choices(pattern):
    """Literal pieces (lower case, GRAM characters or more) of which every match holds at least one.

    One piece when the pattern requires one outright; else, for an alternation that every match
    passes through (not inside an optional part), the longest required run of each alternative,
    if every alternative has one. [] when neither holds: such a pattern is tried on every title.
    """
    try:
        parsed = sre.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return []
    return _choices(parsed)


def _choices(items):
    single = _longest_run(items)
    if single:
        return [single]
    for op, value in items:
        if op is sre.BRANCH:
            alternatives = [_choices(alternative) for alternative in value[1]]
            if all(alternatives):
                return sorted({piece for pieces in alternatives for piece in pieces})
        elif op is sre.SUBPATTERN or (op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0):
            found = _choices(value[-1])
            if found:
                return found
    return []


def _regex_match(wants, titles):
    """(want, pos) of the first title that each pattern is found in.

    A pattern is tried only on the titles that hold one of its required pieces (`required_choices`:
    one piece, or one per alternative), each piece found by its rarest gram; a pattern without any
    is tried on every title.
    """

    @F.pandas_udf("array<string>")
    def choices(patterns: pd.Series) -> pd.Series:
        return patterns.map(required_choices)

    @F.pandas_udf("boolean")
    def matches(patterns: pd.Series, texts: pd.Series) -> pd.Series:
        tests = dict(_compiled(patterns.unique()))
        return pd.Series([p in tests and tests[p].search(t) is not None for p, t in zip(patterns, texts)], dtype=bool)

    known = materialise(wants.select("want", choices("want").alias("choices")), "patterns")
    # What Python takes for an s or an i when case does not count.
    folded = titles.select("key", "pos", F.translate(F.lower("key"), "ſı", "si").alias("low"))
    grams = folded.select("key", "pos", "low", F.explode(_pieces(F.col("low"), [GRAM])).alias("gram"))
    stats = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    pieces = known.select("want", F.explode("choices").alias("literal"))
    asked = pieces.select("want", "literal", F.explode(_pieces(F.col("literal"), [GRAM])).alias("gram"))
    rated = lookup_join(asked, stats, "gram", "want").select("want", "literal", "gram", F.coalesce("df", F.lit(0)).alias("df"))
    rarest = rated.groupBy("want", "literal").agg(F.min(F.struct("df", "gram")).alias("pick")).filter("pick.df > 0")
    parts = F.array(*[F.lit(i).cast("bigint") for i in range(PARTS)])
    left = rarest.select("want", "literal", F.col("pick.gram").alias("gram"), F.explode(parts).alias("part"))
    right = grams.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    near = left.join(right, ["gram", "part"]).filter(F.col("low").contains(F.col("literal")))
    # A title that holds two alternatives of one pattern is tried once.
    near = near.select("want", "key", "pos").dropDuplicates(["want", "key"])
    found = near.filter(matches("want", "key")).groupBy("want").agg(F.min("pos").alias("pos"))
    return found.unionByName(_regex_everywhere(known.filter(F.size("choices") == 0).select("want"), titles))


def _regex_everywhere(wants, titles):
    """(want, pos) with every request tried on every distinct title, and one row kept per request.

    Up to MAX_PATTERNS go to every task and the titles stay where
    they are; more are dealt into blocks that meet blocks of titles, both of bounded size.
    """
    spark = wants.sparkSession
    if fits(wants, MAX_PATTERNS, MAX_PATTERN_BYTES, F.octet_length("want")):
        shared = spark.sparkContext.broadcast([r["want"] for r in wants.collect()])

        def search(batches):
            tests, best = _compiled(shared.value), {}
            for batch in batches:
                _try_all(tests, batch, best)
            yield from _best_table(best).to_batches()

        hits = titles.mapInArrow(search, "want string, pos bigint")
    else:
        nw, nt = -(-wants.count() // MAX_PATTERNS), max(1, -(-titles.count() // TITLE_BLOCK))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
        left = wants.select("want", F.pmod(F.xxhash64("want"), F.lit(nw)).alias("wb"), each(nt).alias("tb"))
        right = titles.select("key", "pos", F.pmod(F.xxhash64("key"), F.lit(nt)).alias("tb"), each(nw).alias("wb"))

        def compare(w, t):
            best = {}
            _try_all(_compiled(w.column("want").to_pylist()), t, best)
            return _best_table(best)

        pair = ["wb", "tb"]
        hits = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(compare, "want string, pos bigint")
    return hits.groupBy("want").agg(F.min("pos").alias("pos"))


def _compiled(patterns):
    """The patterns that compile, with their test."""
    tests = []
    for pattern in patterns:
        try:
            tests.append((pattern, re.compile(pattern, re.IGNORECASE)))
        except re.error:
            continue
    return tests


def _try_all(tests, block, best):
    """Update best[pattern] = position with the titles of one block."""
    for pos, title in sorted(zip(block.column("pos").to_pylist(), block.column("key").to_pylist())):
        for pattern, test in tests:
            if pos < best.get(pattern, pos + 1) and test.search(title):
                best[pattern] = pos


def _best_table(best):
    return pa.table([pa.array(list(best), pa.string()), pa.array(list(best.values()), pa.int64())], ["want", "pos"])


def match_value(requests, books, column, default, literal=True) -> DataFrame:
    """Answer each request with `column` of the first matching book."""
    found = first_match(requests, books, [column], literal).select("qid", F.col(column).alias("value"))
    return _answered(requests, found, F.lit(default))


def lookup_with_fallback(requests, store, books, column, default, max_distance=None, where=None, embedder=None, index=None) -> DataFrame:
    """`column` of the nearest book; of the first title match when the search gives nothing; else the default.

    The search gives nothing for a request without words, when `where` leaves no book, or when
    the nearest one is farther than `max_distance`.
    """
    hits = nearest(requests, store, 1, where=where, embedder=embedder, index=index)
    if max_distance is not None:
        hits = hits.filter(F.col("distance") <= max_distance)
    hits = materialise(hits, "hits")
    wanted = store.join(hits.select("ebook_no").distinct(), "ebook_no", "left_semi")
    values = wanted.select("ebook_no", _scalar(store, f"meta.{column}").alias("value"))
    near = lookup_join(hits, values, "ebook_no", "qid").select("qid", "value")
    rest = requests.join(hits.select("qid"), "qid", "left_anti")
    matched = first_match(rest, books, [column]).select("qid", F.col(column).alias("value"))
    return _answered(requests, near.unionByName(matched), F.lit(default))
