"""Fetched catalogue pages as a table; fetching itself is outside this library."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: address form of a catalogue page.
PAGE_URL = "https://www.gutenberg.org/ebooks/%d"


def page_ids(spark, n, template=PAGE_URL) -> DataFrame:
    """Ids 0 .. n-1 with the address of each page."""
    return spark.range(n).select(
        F.col("id").alias("page_id"), F.format_string(template, F.col("id")).alias("url")
    )


def read_pages(spark, path) -> DataFrame:
    """Fetched pages; the failed ones are left out.

    A `status` column decides when there is one, else a page without markup counts as failed.
    """
    pages = spark.read.parquet(path)
    fetched = F.col("status") == 200 if "status" in pages.columns else F.col("html") != ""
    return pages.filter(fetched).select("page_id", "url", "html")
