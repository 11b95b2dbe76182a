"""Catalogue files: the raw comma form, the clean semicolon form, and row documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from bookbase.functions.bind import let
from bookbase.functions.text import strip
from bookbase.session import path_exists

# Field names of a catalogue page, in file order.
RAW_FIELDS = [
    "Author", "Title", "Note", "Summary", "Language", "LoC Class", "Subject", "Category",
    "EBook-No.", "Release Date", "Most Recently Updated", "Copyright Status", "Downloads",
]
# Fields of a clean catalogue, in file order.
CLEAN_FIELDS = ["Author", "Title", "Summary", "Subject", "EBook-No.", "Release Date"]

CLEAN_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in CLEAN_FIELDS])
_QUOTED = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "encoding": "UTF-8"}


def write_raw_catalogue(df: DataFrame, path, order="page_id"):
    """Comma file(s) in page order with the raw fields; the page id is not written.

    The sort is a range partitioning, so part files follow each other in page order.
    """
    (
        df.orderBy(order)
        .select([f"`{f}`" for f in RAW_FIELDS])
        .write.mode("overwrite")
        .csv(path, header=True, escape='"', emptyValue="", encoding="UTF-8")
    )


def with_file_position(df: DataFrame, out="pos") -> DataFrame:
    """Number the rows of a file scan 0, 1, 2, … in file-name and then in-file order.

    `df` has to come straight from a reader that gives each file to one task (as multi-line
    CSV does). Only one row per file reaches the driver, which lists the files anyway.
    """
    numbered = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.monotonically_increasing_id().alias("__row"),
    )
    files = sorted(
        numbered.groupBy("__file").agg(F.count("*").alias("n"), F.min("__row").alias("first")).collect()
    )
    starts, total = [], 0
    for name, count, first in files:
        starts.append((name, total - first))
        total += count
    shift = df.sparkSession.createDataFrame(starts, "__file STRING, __shift BIGINT")
    return (
        numbered.join(F.broadcast(shift), "__file")
        .withColumn(out, F.col("__row") + F.col("__shift"))
        .drop("__file", "__row", "__shift")
    )


def read_raw_catalogue(spark, path, n_rows=None, fields=CLEAN_FIELDS) -> DataFrame:
    """The named fields of the first `n_rows` rows (all by default) with their file order `pos`.

    Quoted line breaks and delimiters are kept, a byte-order mark is tolerated. The cap is a
    filter on `pos`: no sort and no single-task limit.
    """
    df = with_file_position(spark.read.csv(path, **_QUOTED)).select(*[f"`{f}`" for f in fields], "pos")
    return df if n_rows is None else df.filter(F.col("pos") < n_rows)


def write_clean_catalogue(df: DataFrame, path, order=None):
    """Semicolon file(s) in the fixed column order."""
    df = df.orderBy(order) if order else df
    df.select([f"`{f}`" for f in CLEAN_FIELDS]).write.mode("overwrite").csv(
        path, sep=";", header=True, escape='"', emptyValue="", encoding="UTF-8"
    )


def read_clean_catalogue(spark, path) -> DataFrame:
    """A clean catalogue with its file order `pos`.

    Raises FileNotFoundError for a missing path and ValueError for an empty file or a header
    without the expected fields; a row that cannot be parsed fails the job that reads it.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    try:
        header = spark.read.csv(path, sep=";", **_QUOTED).columns
    except AnalysisException as error:
        raise ValueError(f"cannot read a catalogue from {path}") from error
    missing = [f for f in CLEAN_FIELDS if f not in header]
    if missing:
        raise ValueError(f"no data or missing fields in {path}: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = spark.read.csv(path, sep=";", schema=schema, mode="FAILFAST", **_QUOTED)
    return with_file_position(rows).select(*[f"`{f}`" for f in CLEAN_FIELDS], "pos")


def rows_to_text(df: DataFrame, columns, out="document") -> DataFrame:
    """Add one text per row with a `column: value` line for each of `columns`."""
    lines = [
        F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in columns
    ]
    return df.withColumn(out, F.concat_ws("\n", *lines))


def text_to_map(df: DataFrame, column, out="fields") -> DataFrame:
    """Add the fields of a `column: value` text as a map.

    A line counts when it holds `": "`; its value ends at a second `": "`; a later line wins
    over an earlier one with the same key.
    """
    lines = F.filter(F.split(F.col(column), "\n"), lambda line: line.contains(": "))
    parts = F.transform(lines, lambda line: F.split(line, ": "))
    pairs = F.transform(
        parts, lambda p: F.struct(strip(F.get(p, F.lit(0))).alias("k"), strip(F.get(p, F.lit(1))).alias("v"))
    )

    def last_wins(p):
        keys = F.array_distinct(F.transform(p, lambda x: x["k"]))
        last = lambda k: F.element_at(F.filter(p, lambda x: x["k"] == k), -1)["v"]
        return F.map_from_arrays(keys, F.transform(keys, last))

    return df.withColumn(out, let(pairs, last_wins))
