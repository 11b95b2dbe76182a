"""Pages to catalogue to vector table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import text as X
from bookbase.operators.clean import clean_catalogue, require_columns
from bookbase.operators.embed import embed_cleaned
from bookbase.operators.extract import page_fields
from bookbase.operators.keys import with_hash_key, with_meta
from bookbase.operators.generations import sync
from bookbase.session import path_exists
from bookbase.sources.vectors import load_or_create

RAW_SUMMARY = "Raw Summary"


def book_vectors(books: DataFrame, embedder=None, on="summary") -> DataFrame:
    """The vector table of a book table; a book whose `on` column has no word gets no row.

    `text` is the summary in its own case, so names can still be found in it; the vector is
    made of the cleaned `on` column, the summary or the title.
    """
    keyed = with_meta(with_hash_key(books.filter(X.has_words(on)))).withColumn("text", F.col("summary"))
    if embedder is None:
        made = embed_cleaned(keyed, on)
    else:
        made = embedder(keyed)
    return made.select("book_key", "ebook_no", "text", "meta", "embedding")


def catalogue_from_pages(pages: DataFrame, vocab: DataFrame, exceptions=None, stop=None, n=20) -> DataFrame:
    """Saved pages to the clean catalogue, `page_id` kept for order and `Raw Summary` for its names."""
    raw = page_fields(pages).withColumn(RAW_SUMMARY, F.col("Summary"))
    return clean_catalogue(raw, vocab, exceptions, stop, n)


def books_from_catalogue(catalogue: DataFrame, order="page_id") -> DataFrame:
    """A book table out of a clean catalogue: ebook_no, title, author, subject, summary, pos.

    The catalogue has to have the required columns and a row. `summary` is the raw one where the
    catalogue kept it. A number that isn't one gives a null ebook_no.
    """
    require_columns(catalogue)
    text = F.coalesce(RAW_SUMMARY, "Summary") if RAW_SUMMARY in catalogue.columns else F.col("Summary")
    return catalogue.select(
        F.expr("try_cast(`EBook-No.` AS BIGINT)").alias("ebook_no"), F.col("Title").alias("title"),
        F.col("Author").alias("author"), F.col("Subject").alias("subject"), text.alias("summary"),
        F.col(order).cast("bigint").alias("pos"),
    )


def dropped_books(books: DataFrame) -> DataFrame:
    """One row: how many books there are, and how many get no vector because their text has no word."""
    has_text = F.coalesce(X.has_words("summary"), F.lit(False))
    return books.agg(
        F.count(F.lit(1)).alias("books"), F.coalesce(F.sum((~has_text).cast("bigint")), F.lit(0)).alias("dropped")
    )


def build_store(books: DataFrame, path, index, metric="l2", embedder=None):
    """(store, index): the vector table of `books` at `path` and the cells of its vectors at `index`.

    The store is built once and read again afterwards. `index` is a root of index generations
    (`operators.generations`): its newest generation is brought to the rows of the store, by
    appending what it lacks or, if it holds rows the store no longer has, by a new build. An index
    of the older single-folder layout at `index` is used as it is. Lookups take the pair.
    """
    spark = books.sparkSession
    store = load_or_create(spark, path, lambda: book_vectors(books, embedder))
    if not path_exists(spark, f"{index}/cells/_SUCCESS"):
        sync(store, index, metric)
    return store, index
