"""Row numbers and document keys; none of them gathers a table or a group in one task."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.operators.joins import lookup_join
from bookbase.session import materialise, shuffle_partitions


def _slices(df, order, n):
    """Add `__slice`, the number of the slice of `order` a row lies in; slices follow the order."""
    cuts = df.approxQuantile(order, [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    cuts = sorted(set(cuts))
    if not cuts:
        return df.withColumn("__slice", F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    value = df.withColumn("__value", F.col(order).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="__value", outputCol="__slice").transform(value)
    return cut.drop("__value")


def running_number(df: DataFrame, order, keys=(), out="n", slices=None) -> DataFrame:
    """Number the rows 1, 2, … in `order` (a unique number), inside each group of `keys` if given.

    The table is cut into slices of `order` of about equal size, counted, and numbered slice by
    slice on top of the counts before it. A group that holds a third of all rows is spread over
    a third of the slices.
    """
    keys = list(keys)
    slices = slices or shuffle_partitions(df.sparkSession)
    cut = _slices(df, order, slices)
    part = [*keys, "__slice"]
    sizes = cut.groupBy(*part).agg(F.count(F.lit(1)).alias("__size"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select(*part, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
        # Null-safe, so that rows without a key are numbered too.
        cut, starts = cut.alias("c"), starts.alias("s")
        same = F.lit(True)
        for name in part:
            same = same & F.col(f"c.{name}").eqNullSafe(F.col(f"s.{name}"))
        joined = cut.join(starts, same).select("c.*", "s.__start")
    else:
        total, rows = 0, []
        for name, size in sorted(sizes.collect()):
            rows.append((name, total))
            total += size
        starts = df.sparkSession.createDataFrame(rows, "__slice DOUBLE, __start BIGINT")
        joined = cut.join(F.broadcast(starts), "__slice")
    inside = F.row_number().over(Window.partitionBy(*part).orderBy(order))
    return joined.withColumn(out, inside.cast("bigint") + F.col("__start")).drop("__slice", "__start")


def with_hash_key(df: DataFrame, columns=("author", "title", "ebook_no"), out="book_key") -> DataFrame:
    """A repeatable key out of the identifying columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.withColumn(out, F.sha2(F.concat_ws("\u0001", *parts), 256))


def with_uuid(df: DataFrame, out="book_key") -> DataFrame:
    """A random key per row. Write the result before using it twice: it changes on every run."""
    return df.withColumn(out, F.expr("uuid()"))


def with_seq_key(df: DataFrame, used: DataFrame = None, order="pos", out="book_key") -> DataFrame:
    """Keys 1, 2, … in file order that skip the keys in `used`, a table with a column `out`.

    A used key u pushes up every key that would reach it: the n-th row takes the n-th free
    number, which is n plus the used keys below it.
    """
    numbered = running_number(df, order, out="__n")
    if used is None:
        return numbered.withColumnRenamed("__n", out)
    taken = used.select(F.col(out).cast("bigint").alias("u")).filter("u >= 1").distinct()
    # The i-th used key u leaves u - i free numbers below it, so it shifts rows n > u - i.
    ranked = running_number(taken, "u", out="i")
    gaps = ranked.groupBy((F.col("u") - F.col("i")).alias("free")).agg(F.max("i").alias("shift"))
    marks = gaps.select(
        F.col("free").alias("at"), F.lit(0).alias("kind"), F.col("shift"), F.lit(None).cast("bigint").alias("n")
    )
    rows = numbered.select(
        (F.col("__n") - 1).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("shift"),
        F.col("__n").alias("n"),
    )
    shifts = _last_before(marks.unionByName(rows), "at", "kind", "shift").filter("kind = 1")
    keyed = numbered.join(shifts.select(F.col("n").alias("__n"), "shift"), "__n")
    return keyed.withColumn(out, F.col("__n") + F.coalesce("shift", F.lit(0))).drop("__n", "shift")


def _last_before(df, order, kind, value):
    """Fill `value` with the last one met in (`order`, `kind`); values grow along the order."""
    cut = _slices(df, order, shuffle_partitions(df.sparkSession))
    tops = sorted(cut.groupBy("__slice").agg(F.max(value)).collect())
    rows, top = [], None
    for name, best in tops:
        rows.append((name, top))
        top = best if best is not None else top
    carried = df.sparkSession.createDataFrame(rows, "__slice DOUBLE, __carry BIGINT")
    window = Window.partitionBy("__slice").orderBy(order, kind).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(F.broadcast(carried), "__slice")
        .withColumn(value, F.coalesce(F.max(value).over(window), F.col("__carry")))
        .drop("__slice", "__carry")
    )


def with_batch(df: DataFrame, n=32, order="pos", out="batch") -> DataFrame:
    """Number of the batch of `n` rows a row falls in, from 0, in file order."""
    return (
        running_number(df, order, out="__n")
        .withColumn(out, F.floor((F.col("__n") - 1) / n).cast("bigint"))
        .drop("__n")
    )


def with_meta(df: DataFrame, columns=("title", "author", "ebook_no", "subject"), out="meta") -> DataFrame:
    """The metadata of a document as one struct."""
    return df.withColumn(out, F.struct(*columns))


def with_name_key(df: DataFrame, columns=("title", "author"), order="pos", out="book_key") -> DataFrame:
    """Readable keys `title_author`; the repeats of one get `_1`, `_2`, … in file order.

    Names are given as if row by row: a suffix taken by a row before is passed over, also when
    that row's own title ends like one.
    """
    base = F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    numbered = running_number(df.withColumn("__base", base), order, ["__base"], "__n")
    shifts = _name_shifts(numbered.select("__base", "__n", order), order)
    lost, blocked = F.lit(0), F.array().cast("array<bigint>")
    if shifts is not None:
        numbered = lookup_join(numbered, shifts, "__base", order)
        lost, blocked = F.coalesce("__lost", lost), F.coalesce("__blocked", blocked)
    # The suffix is the n-th number that is free, counting the name without one as number 0.
    suffix = F.aggregate(blocked, F.col("__n") - 1 + lost, lambda at, b: F.when(b <= at, at + 1).otherwise(at))
    name = F.when(suffix == 0, F.col("__base")).otherwise(F.concat_ws("_", "__base", suffix))
    return numbered.withColumn(out, name).drop("__base", "__n", "__lost", "__blocked")


def _name_shifts(rows, order):
    """(__base, __lost, __blocked) of the names that meet a suffixed form of another; None if none do.

    A name `x_c` that occurs by itself and the c-th repeat of `x` want the same key; the earlier
    row has it. `__lost` is 1 when a base lost its own name, `__blocked` has the suffixes it
    must pass over. Only such families are looked at, and they are few.
    """
    firsts = rows.filter("__n = 1").select("__base", order)
    pattern = r"(?s)^(.*)_([1-9][0-9]{0,17})$"
    suffixed = firsts.filter(F.col("__base").rlike(pattern)).select(
        F.col("__base").alias("child"), order, F.regexp_extract("__base", pattern, 1).alias("__base"),
        F.regexp_extract("__base", pattern, 2).cast("bigint").alias("c"),
    )
    children = materialise(suffixed.join(firsts.select("__base"), "__base"), "names")
    if children.isEmpty():
        return None
    # How many rows of the parent come before the first row of the child.
    parents = children.select("__base").distinct().withColumn("__parent", F.lit(True))
    family = lookup_join(rows, parents, "__base", order, how="inner").select("__base", order)
    both = family.withColumn("child", F.lit(None).cast("string")).unionByName(children.select("__base", order, "child"))
    at = running_number(both, order, ["__base"], "__at").filter("child IS NOT NULL").select("child", "__at")
    among = running_number(children, order, ["__base"], "__among")
    wants = among.join(at, "child").select("__base", "child", "c", (F.col("__at") - F.col("__among")).alias("before"))
    listed = materialise(
        wants.groupBy("__base").agg(F.sort_array(F.collect_list(F.struct("c", "before", "child"))).alias("wants")),
        "families",
    )
    depth = children.agg(F.max(F.size(F.regexp_extract_all("child", F.lit(r"_[1-9][0-9]*(?=_|$)"), F.lit(0))))).first()[0]
    lost = children.select(F.col("child").alias("__base"), F.lit(0).alias("__lost")).limit(0)
    start = F.struct(F.array().cast("array<bigint>").alias("blocked"), F.array().cast("array<string>").alias("lost"))

    def meet(held, want):
        # The row of the parent that would take suffix c, by its number.
        row = want["c"] - F.size(held["blocked"]) + 1 - F.coalesce("__lost", F.lit(0))
        taken = row <= want["before"]
        return F.struct(
            F.when(taken, held["blocked"]).otherwise(F.concat(held["blocked"], F.array(want["c"]))).alias("blocked"),
            F.when(taken, F.concat(held["lost"], F.array(want["child"]))).otherwise(held["lost"]).alias("lost"),
        )

    # A name hangs on its parent's fate, so there are as many turns as suffixes can be stacked.
    for _ in range(depth):
        met = listed.join(lost, "__base", "left").select("__base", F.aggregate("wants", start, meet).alias("met"))
        lost = met.select(F.explode("met.lost").alias("__base"), F.lit(1).alias("__lost"))
    met = listed.join(lost, "__base", "left").select("__base", F.aggregate("wants", start, meet).alias("met"))
    blocked = met.select("__base", F.col("met.blocked").alias("__blocked"))
    return materialise(blocked.join(lost, "__base", "full"), "shifts")
