"""Catalogue cleaning."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import text as X
from bookbase.operators.lemma import lemmatise

# What stands in for a missing field.
FILL = {
    "Author": "undefined author",
    "Title": "undefined title",
    "Summary": "undefined summary",
    "Subject": "undefined subject",
    "EBook-No.": "undefined ebook number",
    "Release Date": "undefined release date",
}
REQUIRED = [field for field in FILL if field != "Release Date"]
TEXT_FIELDS = [field for field in REQUIRED if field != "EBook-No."]


def fill_missing(df: DataFrame, defaults=FILL, markers=X.MISSING) -> DataFrame:
    """Missing markers and nulls become the default of their column; other columns stay."""

    def filled(name):
        c = F.col(f"`{name}`").cast("string")
        return F.when(c.isNull() | c.isin(list(markers)), F.lit(defaults[name])).otherwise(c)

    return df.select([filled(c).alias(c) if c in defaults else F.col(f"`{c}`") for c in df.columns])


def require_columns(df: DataFrame, columns=REQUIRED) -> DataFrame:
    """`df` itself; ValueError when a column is absent or there is no row."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    if df.isEmpty():
        raise ValueError("the catalogue is empty")
    return df


def clean_catalogue(df: DataFrame, vocab: DataFrame, exceptions: DataFrame = None, stop=None, n=20) -> DataFrame:
    """The whole pass over a raw catalogue; number, date and any other column stay untouched.

    Author loses its years; Summary becomes its first `n` keywords; then all four text columns
    are cleaned, lose their stop words and are put in lemma form.
    """
    stop = X.STOP_WORDS if stop is None else list(stop)
    df = fill_missing(df).withColumn("Author", X.strip_dates("Author"))
    df = keyword_summary(df, "Summary", vocab, exceptions, stop, n)
    df = df.withColumns({c: X.drop_stopwords(X.clean_text(c), stop) for c in TEXT_FIELDS})
    return lemmatise(df, TEXT_FIELDS, vocab, exceptions)


def keyword_summary(df: DataFrame, column, vocab: DataFrame, exceptions=None, stop=None, n=20) -> DataFrame:
    """`column` becomes its first `n` keywords in lemma form."""
    stop = X.STOP_WORDS if stop is None else list(stop)
    keywords = F.slice(X.keyword_tokens(column, stop), 1, n)
    df = df.withColumn(column, F.array_join(keywords, " "))
    return lemmatise(df, [column], vocab, exceptions)
