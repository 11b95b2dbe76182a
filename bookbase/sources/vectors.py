"""The vector table: build once, append, inspect."""

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.session import half_written, has_data, publish

log = logging.getLogger(__name__)


def load_or_create(spark, path, build) -> DataFrame:
    """The table at `path`, built by `build()` when absent; an existing one is left unchanged.

    A table exists when there are data at `path`, marked as done or not. A new one is built beside
    it and moved there whole, so a build that was cut short leaves no table.
    """
    if not has_data(spark, path):
        log.info("building the vector table at %s", path)
        publish(build(), path)
    return spark.read.parquet(path)


def append_vectors(df: DataFrame, path, key="book_key") -> DataFrame:
    """Append the rows whose key the table at `path` does not hold; give back the table.

    Rows repeated inside `df` are written once; rows without a vector are not written. A table that
    another writer has left half written is refused.
    """
    spark = df.sparkSession
    if half_written(spark, path):
        raise RuntimeError(f"{path} holds unfinished files")
    fresh = df.filter(F.col("embedding").isNotNull()).dropDuplicates([key])
    if has_data(spark, path):
        known = spark.read.parquet(path).select(key)
        fresh = fresh.join(known, key, "left_anti")
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def describe_vectors(df: DataFrame) -> DataFrame:
    """One row: number of documents, and a note when there are none."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("documents"),
        F.when(n == 0, F.lit("the store holds no document")).otherwise(F.lit("")).alias("note"),
    )


def dump_vectors(df: DataFrame) -> DataFrame:
    """Text and metadata of every document."""
    return df.select("book_key", "text", "meta.*")


def peek(df: DataFrame, n=10, order="book_key") -> DataFrame:
    """The first `n` documents in key order."""
    return dump_vectors(df).orderBy(order).limit(n)
