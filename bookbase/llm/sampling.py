"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

The terms of a text are its words, weighted by how often they occur. For every sample and term,
hashes give r and c of a Gamma(2, 1) and b of a uniform distribution; with
t = floor(ln(weight) / r + b) the term's number is c * exp(-r * (t - b + 1)), and the sample is
the smallest number of all terms. It names its term and t, so two texts agree in a sample with
the probability of their generalised Jaccard similarity, the sum of the smaller weights over
that of the larger ones.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.functions.bind import let
from bookbase.session import materialise, shuffle_partitions

SAMPLES = 32

#: Blanks between words.
BLANKS = r"[\x20\x09-\x0D]+"

#: Slices are cut at so many quantiles of doc_id, and evenly between them.
CUTS = 64


def terms(text):
    """The words of a text column; a text without words has the one term ''."""
    words = F.array_remove(F.split(text, BLANKS), "")
    return F.when(F.size(words) > 0, words).otherwise(F.array(F.lit("")))


def counted_terms(text):
    """The distinct terms of a text column, as an array of (h: hash, n: how often), without leaving the row."""

    def ends(ordered):
        last = F.size(ordered) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.get(ordered, i) != F.get(ordered, i + 1)))

    def counts(ordered, at):
        return F.transform(at, lambda e, i: F.struct(
            F.xxhash64(F.get(ordered, e)).alias("h"), (e - F.coalesce(F.get(at, i - 1), F.lit(-1))).alias("n")
        ))

    return let(F.sort_array(terms(text)), lambda s: let(ends(s), lambda at: counts(s, at)))


def draws(hashed, log_weight, samples=SAMPLES):
    """The number of a term in each sample, from its hash and the logarithm of its weight."""

    def uniform(bits, shift, width):
        return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("double") + 0.5) / float(1 << width)

    out = []
    for k in range(samples):
        x, y = F.xxhash64(hashed, F.lit(2 * k)), F.xxhash64(hashed, F.lit(2 * k + 1))
        r = -F.log(uniform(x, 0, 32) * uniform(x, 32, 32))
        c = -F.log(uniform(y, 0, 21) * uniform(y, 21, 21))
        b = uniform(y, 42, 22)
        out.append(c * F.exp(-r * (F.floor(log_weight / r + b) - b + 1)))
    return out


def signatures(terms_of: DataFrame, keys, samples=SAMPLES) -> DataFrame:
    """`keys` and samples (array of double) of rows with `keys` and a `term`, one per occurrence, or `h` and `n` of `counted_terms`.

    Without a shuffle of its own if `terms_of` is clustered by some of `keys` already.
    """
    if "term" in terms_of.columns:
        counted = terms_of.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
        terms_of = counted.select(*keys, F.xxhash64("term").alias("h"), "n")
    hashed = terms_of.select(*keys, F.col("h").alias("__h"), F.log(F.col("n").cast("double")).alias("__w"))
    drawn = draws(F.col("__h"), F.col("__w"), samples)
    least = hashed.groupBy(*keys).agg(*[F.min(a).alias(f"__s{k}") for k, a in enumerate(drawn)])
    return least.select(*keys, F.array(*[f"__s{k}" for k in range(samples)]).alias("samples"))


def fingerprint(samples):
    """Four hexadecimal digits of each sample."""
    digits = F.transform(samples, lambda s: F.lower(F.lpad(F.hex(F.pmod(F.xxhash64(s), F.lit(65536))), 4, "0")))
    return F.array_join(digits, "")


def likeness(a, b):
    """Share of samples that two fingerprints' samples agree in."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


def slice_of(docs: DataFrame, order="doc_id", slices=None):
    """Column with the slice of a row in falling order of `order`, nulls last; about equal slices."""
    slices = slices or 4 * shuffle_partitions(docs.sparkSession)
    each = -(-slices // CUTS)
    cuts = docs.approxQuantile(order, [i / CUTS for i in range(CUTS + 1)], 0.25 / CUTS) if slices > 1 else []
    cuts = sorted(set(cuts))
    if len(cuts) < 2:
        return F.when(F.col(order).isNull(), 1).otherwise(0)
    value = F.col(order).cast("double")
    at = sum((value >= c).cast("int") for c in cuts[1:-1]) if len(cuts) > 2 else F.lit(0)
    edges = F.array(*map(F.lit, cuts))
    low, high = F.get(edges, at), F.get(edges, at + 1)
    inner = F.least(F.greatest(F.floor((value - low) / (high - low) * each), F.lit(0)), F.lit(each - 1))
    return F.coalesce((F.lit(len(cuts) * each) - (at * each + inner)).cast("int"), F.lit(len(cuts) * each + 1))


def with_next(rows: DataFrame, order, value, out) -> DataFrame:
    """Adds `value` of the next row in (slice, *order), after the last row that of the first.

    One shuffle by slice; the first value of each slice travels to the slice before it.
    """
    in_slice = Window.partitionBy("slice").orderBy(*order)
    first = rows.withColumn("__nth", F.row_number().over(in_slice)).filter("__nth = 1").select("slice", F.col(value).alias("__first"))
    along = Window.orderBy("slice")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrapped = first.select(
        F.col("slice").alias("__slice"),
        F.coalesce(F.lead("__first").over(along), F.first("__first").over(whole)).alias("__after"),
    )  # a row for each slice
    led = rows.withColumn("__nth", F.row_number().over(in_slice)).withColumn(
        out, F.lead(F.struct(F.col(value).alias("v"))).over(in_slice)
    )
    joined = led.join(wrapped, F.col("slice") == F.col("__slice"))
    return joined.withColumn(out, F.when(F.col(out).isNull(), F.col("__after")).otherwise(F.col(f"{out}.v"))).drop("__slice", "__after")


def edited_fingerprints(docs: DataFrame, samples=SAMPLES) -> DataFrame:
    """Fingerprints of each text and of its edit, whose second half is the start of the next text.

    Next is by descending doc_id, nulls last and ties by a hash of the text; after the last row
    comes the first. Takes doc_id and text (null: empty) and gives doc_id, n_chars,
    edited_sha256, samples, edited_samples, next_samples. Texts without words have equal
    fingerprints. A table of one row is its own next one; an empty table gives no rows. Other
    columns aren't read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("slice", slice_of(docs)).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), "tie"]
    met = with_next(rows, order, "text", "next")
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.expr("substring(text, 1, length(text) - int(floor(length(text) / 2)))")
    met = met.withColumn("edited", F.concat(kept, F.substring(F.col("next"), F.lit(1), half)))
    facts = met.select(
        "slice", F.col("__nth").alias("nth"), "doc_id", "tie", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    both = met.select("slice", F.col("__nth").alias("nth"), F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))
    )).alias("one"))
    # Terms are counted in the row of their text: grouped, all terms of a partition would meet in one table.
    worded = both.select("slice", "nth", "one.which", F.inline(counted_terms(F.col("one.t"))))
    made = signatures(worded, ["slice", "nth", "which"], samples)
    pair = made.groupBy("slice", "nth").agg(
        F.max(F.when(F.col("which") == 0, F.col("samples"))).alias("samples"),
        F.max(F.when(F.col("which") == 1, F.col("samples"))).alias("edited_samples"),
    )
    known = materialise(facts.join(pair, ["slice", "nth"]), "signatures")
    return with_next(known, order, "samples", "next_samples").drop("slice", "nth", "__nth", "tie")
