"""Dealing documents to shards by a hierarchical weighted hash tree.

A row descends from region to rack to shard. At each node it draws -ln(u) / weight for every
child, u being a hash of the row's key and the child's name, and follows the smallest draw:
children are chosen in proportion to their weights, and changing one child's weight moves rows
only into or out of that child, so movement stays inside the subtrees whose weights change.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import number_rows
from bookbase.session import materialise


def layout(shards, base=40, racks=4, regions=2):
    """The tree of `shards` shards: {region: {rack: {shard: weight}}}.

    The first `base` shards fill `regions` regions of `racks` racks evenly. Every later one comes
    in a rack and region of its own, so growing by a shard adds one child to the root and leaves
    every other weight as it was.
    """
    tree = {}
    for shard in range(shards):
        if shard < base:
            rack = shard * racks * regions // base
            region, rack = f"region{rack // racks}", f"rack{rack}"
        else:
            region, rack = f"region+{shard}", f"rack+{shard}"
        tree.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _weight(node):
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def _draw(key, name, weight):
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(str(name))), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0**53)) / F.lit(float(weight))


def _smallest(key, children):
    """Column with the name of the child that draws the smallest number."""
    draws = [F.struct(_draw(key, name, _weight(node)), F.lit(name)) for name, node in children.items() if _weight(node) > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["col2"]


def shard_rows(rows: DataFrame, tree, key="doc_id", out="shard") -> DataFrame:
    """Adds the shard of every row by `tree`, as `layout` makes it; branches of weight 0 get nothing.

    Equal keys share a shard; null is a key like any other.
    """
    key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    racks = {rack: shards for region in tree.values() for rack, shards in region.items()}
    rows = rows.withColumn("__region", _smallest(key, tree))
    for level, nodes, name in (("__region", tree, "__rack"), ("__rack", racks, out)):
        choice = None
        for parent, children in nodes.items():
            if _weight(children) > 0:
                here, pick = F.col(level) == parent, _smallest(key, children)
                choice = F.when(here, pick) if choice is None else choice.when(here, pick)
        rows = rows.withColumn(name, choice)
    return rows.withColumn(out, F.col(out).cast("int")).drop("__region", "__rack")


def shard_documents(docs: DataFrame, shards=40) -> DataFrame:
    """Shard of each document now and with one shard more, and its place in the shard.

    Takes doc_id and text; gives doc_id, size (UTF-8 bytes of the text, 0 for null, plus 16),
    text_crc32 (0 for a null or empty text), shard, slot (gapless from 0 in its shard) and
    grown_shard. doc_id and the number of shards alone decide, so repeated doc_ids share a shard
    and one with a third of all rows makes it large; slots are still numbered in slices. Other
    columns aren't read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    rows = shard_rows(rows, layout(shards))
    rows = shard_rows(rows, layout(shards + 1), out="grown_shard")
    return number_rows(materialise(rows, "sharded"), ["shard"], ["doc_id", "text_crc32", "size"], "slot")
