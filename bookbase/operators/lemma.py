"""Noun lemmas by suffix rules checked against a word list.

The result depends on the word list given: a form the list does not hold is left alone.
"""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.functions.text import words
from bookbase.operators.joins import fits, lookup_join
from bookbase.session import materialise

# Noun endings and what replaces them, in order of trial.
NOUN_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]

#: Changed words, and their bytes, that are sent to every task.
MAX_LEMMAS, MAX_LEMMA_BYTES = 200_000, 8 << 20


def lemmatise(df: DataFrame, columns, vocab: DataFrame, exceptions: DataFrame = None) -> DataFrame:
    """Put every word of the text `columns` in lemma form, order kept, joined by one space.

    vocab(word) is the word list, exceptions(word, lemma) the irregular forms, both of any size.
    The lemma of each distinct word is found once by a join with the word list. The words that it
    changes go to every task if they are of checked size, and the texts stay where they are; more
    are given back to the words of the texts by a join that deals out frequent words. Nulls stay null.
    """
    # Row numbers are only told apart within this call; written down, they stay what they are.
    rows = materialise(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    texts = F.array(*[F.struct(F.lit(i).alias("column"), words(f"`{c}`").alias("words")) for i, c in enumerate(columns)])
    each = rows.select("__row", F.explode(texts).alias("t"))
    tokens = each.select("__row", "t.column", F.posexplode("t.words").alias("pos", "word"))
    changed = materialise(lemma_table(tokens, vocab, exceptions), "lemmas")
    if fits(changed, MAX_LEMMAS, MAX_LEMMA_BYTES, F.octet_length("word") + F.octet_length("lemma")):
        return _replaced(rows.select(*[F.col(f"`{c}`") for c in df.columns]), columns, changed)
    used = lookup_join(tokens, changed, "word", "__row")
    joined = used.groupBy("__row", "column").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("pos", F.coalesce("lemma", "word").alias("w")))), lambda t: t["w"]
            ),
            " ",
        ).alias("text")
    )
    wide = joined.groupBy("__row").agg(
        *[F.max(F.when(F.col("column") == i, F.col("text"))).alias(f"__text{i}") for i in range(len(columns))]
    )
    new = {c: F.when(F.col(f"`{c}`").isNotNull(), F.coalesce(f"__text{i}", F.lit(""))) for i, c in enumerate(columns)}
    return rows.join(wide, "__row", "left").select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def _replaced(rows, columns, changed):
    """`rows` with the lemmas of the small table `changed` put into the text `columns`, row by row."""
    table = changed.select("word", "lemma").toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(
        (table.column("word").combine_chunks(), table.column("lemma").combine_chunks())
    )

    @F.arrow_udf("string")
    def joined(texts: pa.Array) -> pa.Array:
        flat = texts.flatten()
        word, lemma = (x.cast(flat.type) for x in shared.value)
        flat = pc.coalesce(lemma.take(pc.index_in(flat, value_set=word)), flat)
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(texts), 0))
        offsets = pa.concat_arrays([pa.array([0], ends.type), ends])
        kind = pa.LargeListArray if pa.types.is_int64(ends.type) else pa.ListArray
        return pc.binary_join(kind.from_arrays(offsets, flat), " ").cast(pa.string())

    new = {c: F.when(F.col(f"`{c}`").isNotNull(), joined(words(f"`{c}`"))) for c in columns}
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in rows.columns])


def lemma_table(words_df: DataFrame, vocab: DataFrame, exceptions: DataFrame = None) -> DataFrame:
    """(word, lemma) for the distinct words whose lemma differs from the word."""
    base = words_df.select("word").distinct()
    endings = F.array(
        *[
            F.when(
                F.col("word").endswith(end),
                F.concat(F.substring("word", F.lit(1), F.length("word") - len(end)), F.lit(new)),
            )
            for end, new in NOUN_RULES
        ]
    )
    if exceptions is not None:
        irregular = exceptions.groupBy("word").agg(F.sort_array(F.collect_set("lemma")).alias("forms"))
        base = base.join(irregular, "word", "left")
        endings = F.coalesce(F.col("forms"), endings)
    tried = base.select("word", F.posexplode(F.concat(F.array("word"), endings)).alias("turn", "form"))
    tried = tried.filter("form IS NOT NULL AND form <> ''")
    known = tried.join(vocab.select(F.col("word").alias("form")).distinct(), "form")
    best = known.groupBy("word").agg(F.min_by("form", F.struct(F.length("form"), "turn")).alias("lemma"))
    return best.filter("lemma <> word")
