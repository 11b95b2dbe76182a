"""Small helpers that several operators of this folder share."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.session import materialise, shuffle_partitions

#: Words of a text: runs of anything but blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    """Lower-cased (A-Z only) words of a text as bytes; `bytes.split` cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def small_batches(spark, rows=500):
    """Let Python workers of this session get at most `rows` rows at a time: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def number_rows(df: DataFrame, keys, order, out, start=0) -> DataFrame:
    """Number the rows of each group of `keys` without gaps from `start`, in no promised order.

    Rows are dealt over slices by the hash of `order`; each slice is counted, and numbered on top
    of the slices before it, so a group with a third of all rows is spread over all slices.
    `df` is read twice: give it a written table.
    """
    keys = list(keys)
    slices = max(8, shuffle_partitions(df.sparkSession))
    cut = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    part = [*keys, "__slice"]
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    if not keys:
        before = Window.partitionBy(F.lit(0)).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*part).agg(F.count(F.lit(1)).alias("__size"))
    starts = sizes.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(part)],
        (F.coalesce(F.sum("__size").over(before), F.lit(0)) + start).alias("__start"),
    )
    inside = F.row_number().over(Window.partitionBy(*part).orderBy(*order)) - 1
    numbered = cut.withColumn("__inside", inside)
    same = F.lit(True)
    for i, k in enumerate(part):
        same = same & numbered[k].eqNullSafe(F.col(f"__k{i}"))
    joined = numbered.join(starts, same)
    return joined.select(*df.columns, (F.col("__inside") + F.col("__start")).cast("bigint").alias(out))


def some_by_hash(df: DataFrame, keys, by, most) -> DataFrame:
    """Up to `most` rows of each group of `keys`, those of the smallest hashes of `by`.

    Groups are thinned by a share of the hash that leaves about four times as many before they are
    sorted, so no task gets more than that of a group.
    """
    mixed = F.pmod(F.xxhash64(by, F.lit(17)), F.lit(1 << 30))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    thin = df.join(sizes, list(keys)).filter(mixed < F.least(F.lit(1.0), F.lit(4.0 * most) / F.col("__size")) * (1 << 30))
    first = Window.partitionBy(*keys).orderBy(mixed, by)
    return thin.withColumn("__nth", F.row_number().over(first)).filter(F.col("__nth") <= most).select(*df.columns)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); root is the smallest node it can reach.

    Rounds of hanging each node's larger neighbours, then its smaller ones, under the smallest
    (large and small stars) until nothing moves; every round is a written table. Minima are
    combined before they are shuffled and written before they are joined back, so that adaptive
    execution can split a hub.
    """
    now = _forward(edges.select("a", "b"))
    state = None
    while True:
        now = materialise(now, "stars")
        count, total = now.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if (count, total) == state:
            break
        state = (count, total)
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        least = materialise(least, "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _forward(large)
        large = materialise(large, "large")
        small = materialise(large.groupBy("b").agg(F.min("a").alias("m")), "small")
        hung = large.join(small, "b")
        now = _forward(hung.select("a", F.col("m").alias("b")).union(hung.select("b", "m")))
    # Every node but a root has one edge now, to its root.
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)


def _forward(edges):
    """Distinct edges from the smaller to the larger node."""
    a, b = edges.columns
    turned = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return turned.filter("a < b").distinct()
