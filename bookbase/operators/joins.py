"""A lookup join that stays balanced under hot keys, and a size check for broadcasts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits(df: DataFrame, max_rows, max_bytes, width) -> bool:
    """True when `df` has at most `max_rows` rows that add up to at most `max_bytes`.

    `width` is a Column with the size of one row. The count stops at `max_rows` + 1 rows.
    """
    n, size = (
        df.select(width.cast("bigint").alias("w")).limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    )
    return n <= max_rows and size <= max_bytes


def lookup_join(left: DataFrame, right: DataFrame, key, spread, salts=32, how="left") -> DataFrame:
    """Join `left` to `right`, whose `key` is unique, without one task per hot key.

    Rows of `left` that share a key are dealt over `salts` parts by the hash of `spread`; a row
    of `right` is copied once per part that really asks for it. So a key asked for once is
    moved once, and a key asked for by a third of all rows is served by `salts` tasks.
    """
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    wanted = salted.filter(F.col(key).isNotNull()).select(key, "__salt").distinct()
    copies = wanted.join(right, key)
    return salted.join(copies, [key, "__salt"], how).drop("__salt")
