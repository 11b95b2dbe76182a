"""Catalogue fields out of saved pages; every step works inside its own row, so nothing is shuffled."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions import html as H
from bookbase.sources.catalogue import RAW_FIELDS


def pick_table(pages: DataFrame, css_class="bibrec") -> DataFrame:
    """Add `table`, the first table of that class; pages without one are dropped."""
    return pages.withColumn("table", H.first_table(F.col("html"), css_class)).filter(
        F.col("table").isNotNull()
    )


def rows_to_pairs(tables: DataFrame) -> DataFrame:
    """One row per table row that has a heading and a data cell, numbered in page order."""
    return tables.select("page_id", F.posexplode(H.table_pairs(F.col("table")))).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "col.field", "col.value"
    )


def tables_to_record(tables: DataFrame, headers=RAW_FIELDS, multi=False) -> DataFrame:
    """One record per page with the listed fields; absent ones are empty strings.

    Of a repeated field the last value is kept, or all of them in page order with `multi`.
    """
    pairs = tables.select("page_id", H.table_pairs(F.col("table")).alias("pairs"))
    pick = H.all_values if multi else H.last_value
    return pairs.select("page_id", *[pick(F.col("pairs"), h).alias(h) for h in headers])


def pairs_to_record(pairs: DataFrame, headers=RAW_FIELDS) -> DataFrame:
    """The record form when the pairs come as rows (page_id, pos, field, value)."""
    fields = [
        F.coalesce(F.max_by("value", F.when(F.col("field") == h, F.col("pos"))), F.lit("")).alias(h)
        for h in headers
    ]
    return pairs.groupBy("page_id").agg(*fields)


def page_fields(pages: DataFrame, css_class="bibrec", headers=RAW_FIELDS, multi=False) -> DataFrame:
    """Pages to catalogue records."""
    return tables_to_record(pick_table(pages, css_class), headers, multi)


def page_head(pages: DataFrame) -> DataFrame:
    """Title, first heading and language of any page."""
    doc = F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    return pages.select(
        "page_id",
        H.first_element_text(doc, "title").alias("title"),
        H.first_element_text(doc, "h1").alias("h1"),
        H.root_language(doc).alias("lang"),
    )
