"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source are dealt to blocks by a hash. A source takes whole passes over its blocks
and, for the rest of its target, a permuted run of blocks of which the last is cut between
two documents. The drawn blocks of all sources then descend a binary tree of output shards: at
each node a random half goes left, so what each side gets of every source is a multivariate
hypergeometric draw of the node's exact block quotas, and the blocks of the shards are disjoint.
Decisions are thresholds on a document's hash, kept per source and block, so documents never
move to be chosen. Built of DataFrame functions alone.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.llm.common import WORD, number_rows
from bookbase.session import materialise

#: A block holds about so many words of the largest source at most.
BLOCK_WORDS = 1 << 20


def targets(sizes: DataFrame, weights=(1, 2, 3), cap=3) -> DataFrame:
    """`sizes` (source, source_size) with a target for each source.

    Sources by code point, null last, weigh `weights` in turn and share the sum of all sizes;
    no target is above `cap` times its source, and what is cut off goes to the others by weight.
    The share of a unit of weight is found in one pass over the sources by their cap per weight.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("__w", F.get(F.array(*map(F.lit, weights)), F.pmod(nth, F.lit(len(weights)))).cast("double"))
    most = cap * F.col("source_size")
    by_cap = Window.orderBy(most / F.col("__w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    left = F.sum("source_size").over(everything) - seen(most)
    share = weighed.withColumn("__share", left / (F.sum("__w").over(everything) - seen("__w")))
    full = share.withColumn("__full", most / F.col("__w") <= F.col("__share"))
    # The first source that isn't full has the final share; if all are full, it doesn't matter.
    final = F.min(F.when(~F.col("__full"), F.struct(most / F.col("__w"), F.col("__share")))).over(everything)["__share"]
    target = F.when(F.col("__full"), most.cast("double")).otherwise(final * F.col("__w"))
    return full.select("source", "source_size", target.alias("target"))


def _same(left, right, *names):
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[f"__{n}"])
    return out


def _renamed(df, *names):
    for n in names:
        df = df.withColumnRenamed(n, f"__{n}")
    return df


def sized(docs: DataFrame, seed=0) -> DataFrame:
    """Adds __size (words; 0 for null) and __hash (of doc_id and text, the order of drawing)."""
    return docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")).withColumn(
        "__hash", F.xxhash64("doc_id", "text", F.lit(seed))
    )


def quotas(rows: DataFrame, weights=(1, 2, 3), cap=3, shards=8, seed=0):
    """(blocks, decisions): their number, and a row per source and block.

    `rows` (source, __size, __hash) is read several times: give it a written table. A decision
    has source_size, target, passes (whole copies of the block's documents), cut (documents
    whose hash is at most this get one copy more; null: none) and shards (of each copy).
    """
    sizes = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    aims = materialise(targets(sizes, weights, cap), "targets")
    largest = aims.agg(F.coalesce(F.max("source_size"), F.lit(0))).first()[0]
    blocks = 64
    while largest / blocks > BLOCK_WORDS:
        blocks *= 2
    dealt = rows.withColumn("block", block_of(blocks))
    units = dealt.groupBy("source", "block").agg(F.sum("__size").alias("words"))
    aimed = _renamed(aims, "source")
    units = units.join(aimed, _same(units, aimed, "source")).drop("__source")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    units = units.withColumn("passes", passes.cast("int"))
    units = units.withColumn("__rest", F.col("target") - F.col("passes") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy(F.xxhash64("source", "block", F.lit(seed + 1)), "block")
    units = units.withColumn("__upto", F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    units = units.withColumn("__need", F.col("__rest") - (F.col("__upto") - F.col("words")))
    units = materialise(
        units.withColumn("extra", F.when(F.col("__need") <= 0, 0).when(F.col("__need") >= F.col("words"), 2).otherwise(1)), "units"
    )

    # The last block of a source's run is cut at the document that comes nearest to its target.
    edge = _renamed(units.filter("extra = 1").select("source", "block", "__need"), "source", "block")
    inside = dealt.join(edge, _same(dealt, edge, "source", "block"))
    in_order = Window.partitionBy("source", "block").orderBy("__hash").rangeBetween(Window.unboundedPreceding, 0)
    met = inside.withColumn("__upto", F.sum("__size").over(in_order))
    same_hash = F.sum("__size").over(Window.partitionBy("source", "block", "__hash"))
    chosen = met.withColumn("__half", F.col("__upto") - same_hash / 2).filter("__half <= __need")
    cuts = _renamed(chosen.groupBy("source", "block").agg(F.max("__hash").alias("__cut")), "source", "block")
    units = units.join(cuts, _same(units, cuts, "source", "block"), "left").drop("__source", "__block")
    cut = F.when(F.col("extra") == 2, F.lit((1 << 63) - 1)).when(F.col("extra") == 1, F.col("__cut"))
    units = units.withColumn("cut", cut).select("source", "block", "source_size", "target", "passes", "cut")

    copies = F.col("passes") + F.col("cut").isNotNull().cast("int")
    drawn = units.filter(copies > 0).select("source", "block", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    placed = split(drawn, shards, seed)
    where = placed.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard")))["shard"].alias("shards"))
    where = _renamed(where, "source", "block")
    out = units.join(where, _same(units, where, "source", "block"), "left").drop("__source", "__block")
    return blocks, materialise(out, "quotas")


def split(units: DataFrame, shards=8, seed=0) -> DataFrame:
    """Adds the shard (0 to `shards` - 1, a power of two) of each drawn block by halving node after node."""
    at = units.withColumn("shard", F.lit(0))
    for level in range(shards.bit_length() - 1):
        mixed = F.xxhash64("source", "block", "copy", F.lit(seed + 2 + level))
        at = materialise(at.withColumn("__mix", mixed), "split")
        ranked = number_rows(at, ["shard"], ["__mix", "source", "block", "copy"], "__rank")
        # Every other rank of a random order is a random half.
        at = ranked.withColumn("shard", (F.col("shard") * 2 + F.pmod("__rank", F.lit(2))).cast("int")).drop("__rank", "__mix")
    return at


def block_of(blocks):
    return F.pmod(F.xxhash64("__hash"), F.lit(blocks)).cast("int")


def decided(rows: DataFrame, decisions: DataFrame, blocks) -> DataFrame:
    """Adds source_size, target, copies and shards (one per copy) to rows with __size and __hash."""
    dealt = rows.withColumn("block", block_of(blocks))
    told = _renamed(decisions, "source", "block")
    joined = dealt.join(told, _same(dealt, told, "source", "block")).drop("__source", "__block", "block")
    extra = F.coalesce(F.col("__hash") <= F.col("cut"), F.lit(False)).cast("int")
    copies = F.col("passes") + extra
    return joined.withColumn("copies", copies).withColumn(
        "shards", F.slice(F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), copies)
    ).drop("passes", "cut")


def mix_sizes(docs: DataFrame, weights=(1, 2, 3), cap=3, shards=8, seed=0) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, copies, taken, shards.

    Takes doc_id, text and source; other columns aren't read. A document's copies are whole, `cap`
    at most. A null text has no words; a null source is a source, the last. Rows that agree in
    doc_id and text are taken together. An empty table gives no rows.
    """
    rows = materialise(sized(docs.select("doc_id", "text", "source"), seed).drop("text"), "sizes")
    blocks, decisions = quotas(rows, weights, cap, shards, seed)
    out = decided(rows, decisions, blocks).withColumnRenamed("__size", "size")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), "shards",
    )


def mix_documents(docs: DataFrame, weights=(1, 2, 3), cap=3, shards=8, seed=0) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, shuffled inside each task.

    Keeps the columns of `docs`, which may have any names that don't start with two underscores;
    see `mix_sizes` for null and empty rows. Texts move at most once, to meet their quotas, and not
    at all while the quotas are small enough for Spark to send them to the tasks.
    """
    names = docs.columns
    key = docs.select("doc_id", "text", "source")
    rows = materialise(sized(key, seed).drop("text"), "sizes")
    blocks, decisions = quotas(rows, weights, cap, shards, seed)
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("__doc"), "doc_id", "text", "source")
    marked = decided(sized(packed, seed).drop("doc_id", "text"), decisions, blocks)
    taken = marked.select("__doc", F.posexplode("shards").alias("__copy", "__shard"), "__hash")
    order = ["__shard", F.xxhash64("__hash", "__copy", F.lit(seed))]
    return taken.sortWithinPartitions(*order).select(*[F.col("__doc")[n].alias(n) for n in names])
