"""The test tables seen as pages, books, questions and replies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import text as X
from bookbase.operators.keys import with_hash_key, with_meta
from bookbase.session import spread_few_files


# The key of each table whose rows hold long texts.
TEXTS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark, sf_dir, name) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_few_files(df, TEXTS[name]) if name in TEXTS else df


def first_words(c, n):
    """The first n words; the split stops after them, so a long text costs no more than a short one."""
    return F.array_join(F.slice(F.array_remove(F.split(c, X.BLANKS, n + 2), ""), 1, n), " ")


def books(spark, sf_dir) -> DataFrame:
    """documents as books; the title is the first six words."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ebook_no"),
        first_words("text", 6).alias("title"),
        F.col("source").alias("author"),
        F.col("lang").alias("subject"),
        F.col("text").alias("summary"),
        F.lit(None).cast("string").alias("release_date"),
        F.col("doc_id").alias("pos"),
    )


def vectors(spark, sf_dir) -> DataFrame:
    """The books that have a given vector, as a vector table."""
    given = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ebook_no"), "embedding")
    keyed = with_meta(with_hash_key(books(spark, sf_dir))).withColumnRenamed("summary", "text")
    return keyed.join(given, "ebook_no").select("book_key", "ebook_no", "text", "meta", "embedding")


def catalogue(spark, sf_dir) -> DataFrame:
    """part as a catalogue with many repeated titles."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ebook_no"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        F.col("p_type").alias("subject"), F.concat_ws(" ", F.initcap("p_name"), "p_brand").alias("summary"),
        F.col("p_partkey").alias("pos"),
    )


def questions(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .filter("role = 'user'")
        .select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"), "text", "conv_id", "turn")
    )


def raw_catalogue(spark, sf_dir) -> DataFrame:
    """documents in the raw catalogue form, with years in the author and some fields missing."""
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.col("lang"),
        F.format_string("%s, %s–?, 18%02d-1%d", "source", F.upper("lang"), n % 100, 900 + n % 50).alias("Author"),
        F.when(n % 11 == 0, "None").otherwise(first_words("text", 6)).alias("Title"),
        F.lit("").alias("Note"),
        F.col("text").alias("Summary"),
        F.col("lang").alias("Language"),
        F.lit("PS").alias("LoC Class"),
        F.when(n % 13 == 0, F.lit(None)).otherwise(F.format_string("%s (%s); fictions", "lang", "source")).alias("Subject"),
        F.lit("Text").alias("Category"),
        F.col("doc_id").cast("string").alias("EBook-No."),
        F.when(n % 7 == 0, "NaN").otherwise(F.format_string("day %d", n)).alias("Release Date"),
        F.lit("").alias("Most Recently Updated"),
        F.lit("free").alias("Copyright Status"),
        n.cast("string").alias("Downloads"),
    )


def vocabulary(spark, sf_dir) -> DataFrame:
    """The distinct cleaned words of the English documents."""
    english = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return english.select(F.explode(X.words(X.clean_text("text"))).alias("word")).distinct()


PAGE = (
    '<html lang="en"><body><!-- <table class="bibrec"><tr><th>Title</th><td>no</td></tr></table> -->'
    '<table class="bibrec-x"><tr><th>Title</th><td>not this</td></tr></table>'
    '<TABLE id=t class="wide bibrec"><tr><th> Author </th><td><a href="/a">%s</a>&nbsp;</td></tr>\n'
    "<tr><th>Title</th>\n<td><b>%s</b> &amp; more</td></tr>"
    "<tr><th>Subject</th><td>first %s</td></tr><tr><td colspan=2>no heading</td></tr>"
    "<tr><th>Shelf</th><td>unknown</td></tr><tr><th>Subject</th><td>%s</td></tr>"
    "<tr><th>EBook-No.</th><td>%d</td></tr></TABLE>"
    '<table class="bibrec"><tr><th>Title</th><td>second table</td></tr></table></body></html>'
)


def pages_gen(spark, sf_dir) -> DataFrame:
    """part rendered as catalogue pages."""
    return spread_few_files(table(spark, sf_dir, "part"), "p_partkey").select(
        F.col("p_partkey").alias("page_id"),
        F.format_string("/ebooks/%d", "p_partkey").alias("url"),
        F.format_string(PAGE, "p_brand", "p_name", "p_type", "p_type", "p_partkey").alias("html"),
    )


def replies(spark, sf_dir) -> DataFrame:
    """part as model replies: actions in rotation, some without a title or an action."""
    key = F.col("p_partkey")
    names = F.array(*[F.lit(a) for a in
                      ["find_author", "get_subject", "extract_characters", "fetch_full_text", "sing_a_song"]])
    action = F.when(key % 11 == 0, "").otherwise(
        F.concat(F.lit("Action : "), F.get(names, (key % 5).cast("int")), F.lit("\n"))
    )
    title = F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("Titre :  "), F.upper("p_name"), F.lit(" \nthat is all")))
    return table(spark, sf_dir, "part").select(key.alias("qid"), F.concat(action, title).alias("reply"))


def title_requests(spark, sf_dir) -> DataFrame:
    """part as title requests: whole names, parts of names, short ones and misses."""
    key, name = F.col("p_partkey"), F.col("p_name")
    text = (
        F.when(key % 4 == 0, F.upper(name))
        .when(key % 4 == 1, F.substring(name, 3, 7))
        .when(key % 4 == 2, F.substring_index(name, " ", -1).substr(1, 3))
        .otherwise(F.concat_ws(" ", name, "p_type"))
    )
    return table(spark, sf_dir, "part").select(key.alias("qid"), text.alias("text"))


def pattern_requests(spark, sf_dir) -> DataFrame:
    """part as regular expressions over titles."""
    key, name = F.col("p_partkey"), F.col("p_name")
    first, last = F.substring_index(name, " ", 1), F.substring_index(name, " ", -1)
    text = (
        F.when(key % 3 == 0, F.concat(F.lit("^"), first, F.lit(".*"), last, F.lit("$")))
        .when(key % 3 == 1, F.concat(F.lit("("), F.upper(last), F.lit("|"), first, F.lit(")")))
        .otherwise(F.concat(last, F.lit("[0-9]")))
    )
    return table(spark, sf_dir, "part").select(key.alias("qid"), text.alias("text"))


def author_requests(spark, sf_dir) -> DataFrame:
    """Every author is asked for once, by the first document; some in words that no author has."""
    first = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("qid"))
    text = F.when(F.col("qid") % 5 == 0, F.concat(F.lit("no "), "source")).otherwise(F.upper("source"))
    return first.select("qid", text.alias("text"))


def counting_model():
    """A stand-in for a caller's own model: length and blank count of each text."""
    return lambda texts: [[float(len(t)), float(t.count(" "))] for t in texts]
