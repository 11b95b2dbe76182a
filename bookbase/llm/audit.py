"""How five quality filters interact: a sparse document-term matrix and failure masks.

Words (maximal runs of anything but blanks, tabs and line ends, case kept) are dictionary-encoded
over the whole table: every distinct word gets one integer id, written once. CSR shards (indptr /
indices / data arrays for a batch of rows) are built where the rows are read, with shard-local
term ids; only the vocabularies that shards of a task share go to the dictionary, and its ids replace the local ones.
Row sums give the number of words and row lengths the number of distinct words. Those decide the filters A and B; C, D and E
are Spark expressions and a grouping by text, and the five flags form a 5-bit mask per document.
Masks are counted per part, and every order of the five filters is applied to the counts: 32
masks a part, never a document at a time.

Filters (fail when): A under 100 words; B 100 * distinct words < 80 * words; C 100 * [A-Z]
characters > 10 * code points; D any of # $ % & * |; E the same text as a smaller doc_id anywhere in
the table (removed or not). A null text is the empty text; a null doc_id counts as larger than
every other, so it fails E when a row with a non-null doc_id holds its text; rows of one doc_id
and one text do not fail E by each other. Labels are taken per doc_id: good (toxic) when any of
its label rows says quality = 1 (toxic = 1). An empty table gives no rows; every part present
gets all 120 orders times 5 steps, zeros included. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.session import materialise, shuffle_partitions

FILTERS = "ABCDE"
#: Fixed values of the contract: thresholds of the five filters.
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = "[#$%&*|]"
SPLIT = r"[\x20\x09-\x0D]+"


LOCAL = "vocab long, shard long, rows array<long>, indptr array<int>, indices array<int>, data array<int>, words array<binary>"
GLOBAL = "shard long, rows array<long>, indptr array<int>, indices array<long>, data array<int>"


#: Text that a shard holds (or one longer row), and words and shards after which a vocabulary is
#: closed; they bound a task's memory.
SHARD_BYTES, VOCAB_WORDS, VOCAB_SHARDS = 3 << 20, 1 << 18, 16
#: Shards and vocabularies in a file: its writer and its reader hold them all, whatever the task's input.
FILE_ROWS = 4
#: Words, repeats in other vocabularies included, that meet in a bucket of the dictionary.
BUCKET_WORDS = 1 << 18
DICTIONARY = ["first", "vocab", "locals", "terms", "words"]


def _pieces(batch, most):
    """`batch` in slices of at most `most` bytes of text, or one row."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _local_shards(batches, most):
    """CSR shards of about `most` bytes of text, built where the rows are; shards of a task share a vocabulary.

    A shard is a row without `words`; a vocabulary follows its shards as a row with `words` alone.
    Words are the runs that `ascii_split_whitespace` gives, which cuts at exactly \\x20 and \\x09-\\x0D.
    The ids are the task's partition and the place in it, the same when a task is rerun.
    A row is never cut.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() << 24
    shards, vocabs, held, vocab = 0, 0, 0, {}
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3, pa.list_(pa.binary())]

    def row(*values):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types)], ["vocab", "shard", "rows", "indptr", "indices", "data", "words"]
        )

    for piece in (p for batch in batches for p in _pieces(batch, most)):
        split = pc.ascii_split_whitespace(piece.column(1))
        coded = split.flatten().dictionary_encode()
        found = coded.dictionary.cast(pa.binary()).to_pylist()
        full = np.array([len(w) > 0 for w in found], bool)  # blanks at the ends of a text give an empty piece
        code, at = coded.indices.to_numpy(), pc.list_parent_indices(split).to_numpy()
        keep = full[code] if len(code) else np.zeros(0, bool)
        entries, data = np.unique(at[keep] * max(1, len(found)) + code[keep], return_counts=True)
        place, code = np.divmod(entries, max(1, len(found)))
        ids = np.array([vocab.setdefault(w, len(vocab)) if w else 0 for w in found], np.int32)
        indptr = np.r_[0, np.cumsum(np.bincount(place, minlength=piece.num_rows))]
        numbers = piece.column(0).to_numpy()
        yield row(part | vocabs, part | shards, numbers, indptr.astype(np.int32), ids[code], data.astype(np.int32), None)
        shards, held = shards + 1, held + 1
        if len(vocab) >= VOCAB_WORDS or held >= VOCAB_SHARDS:
            yield row(part | vocabs, None, None, None, None, None, list(vocab))
            vocabs, held, vocab = vocabs + 1, 0, {}
    if held:
        yield row(part | vocabs, None, None, None, None, None, list(vocab))


def local_shards(rows: DataFrame, most=SHARD_BYTES) -> DataFrame:
    """The shards and vocabularies of `rows` (__row, __text), as `_local_shards` gives them."""
    return rows.select("__row", "__text").mapInArrow(lambda batches: _local_shards(batches, most), LOCAL)


def _globalise(shards, entries):
    """The shards of one vocabulary with the dictionary's ids in place of local ones (`entries`: locals, terms)."""
    import numpy as np
    import pyarrow as pa

    at = entries.column("locals").combine_chunks().flatten().to_numpy()
    table = np.zeros(len(at), np.int64)
    table[at] = entries.column("terms").combine_chunks().flatten().to_numpy()
    indices = shards.column("indices").combine_chunks()
    ends = np.r_[0, np.cumsum(indices.value_lengths().to_numpy())].astype(np.int32)
    terms = pa.ListArray.from_arrays(pa.array(ends), pa.array(table[indices.flatten().to_numpy()]))
    names = ["shard", "rows", "indptr", "indices", "data"]
    return pa.table([terms if n == "indices" else shards.column(n) for n in names], names)


def _dealt(batches, buckets):
    """A row for each vocabulary and bucket: the words whose hash falls there and their local ids."""
    from zlib import crc32

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for vocab, words in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words.values
            hashes = np.fromiter(map(crc32, words.to_pylist()), np.int64, len(words))
            bucket = (hashes * 2654435761 & 0xFFFFFFFF) * buckets >> 32
            order = np.argsort(bucket, kind="stable")
            met, n = np.unique(bucket, return_counts=True)
            ends = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(met), pa.array([vocab] * len(met), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(order.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, words.take(pa.array(order))),
                ],
                ["bucket", "vocab", "locals", "words"],
            )


def _numbered(table):
    """The words of one bucket numbered: its distinct words in a row of their own, and the terms of each vocabulary."""
    import numpy as np
    import pyarrow as pa

    words, local = table.column("words").combine_chunks(), table.column("locals").combine_chunks()
    coded = words.flatten().dictionary_encode()
    first = table.column("bucket")[0].as_py() << 32
    ends = pa.array(np.r_[0, np.cumsum(words.value_lengths().to_numpy())].astype(np.int32))
    terms = pa.ListArray.from_arrays(ends, pa.array(first + coded.indices.to_numpy().astype(np.int64)))
    n, found = table.num_rows, coded.dictionary
    one = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
    own = pa.table([
        pa.array([first], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64())), one,
    ], DICTIONARY)
    rest = pa.table([
        pa.array([first] * n, pa.int64()), table.column("vocab"), local, terms, pa.nulls(n, pa.list_(pa.binary())),
    ], DICTIONARY)
    return pa.concat_tables([own, rest])


def dictionary(vocab: DataFrame, buckets) -> DataFrame:
    """One id for each distinct word of all vocabularies (vocab, words).

    A row without `vocab` holds the words whose ids are `first`, `first` + 1 and so on; a row with one
    holds local ids of that vocabulary and their terms. A word is in a vocabulary once at most, so a
    word in every text is not more in its bucket than there are vocabularies.
    """
    dealt = vocab.mapInArrow(
        lambda batches: _dealt(batches, buckets), "bucket long, vocab long, locals array<int>, words array<binary>"
    )
    return dealt.groupBy("bucket").applyInArrow(
        _numbered, "first long, vocab long, locals array<int>, terms array<long>, words array<binary>"
    )


def _row_counts(batches):
    """Per row of every shard: row sum (words) and row length (distinct words)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            rows, indptr, data = (
                batch.column(batch.schema.get_field_index(n))[i].values.to_numpy() for n in ("rows", "indptr", "data")
            )
            total = np.r_[0, np.cumsum(data, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.diff(total[indptr])), pa.array(np.diff(indptr).astype(np.int64))],
                ["__row", "n_words", "n_distinct"],
            )


def csr_shards(rows: DataFrame) -> DataFrame:
    """The document-term matrix of `rows` (__row, __text) as CSR shards with global term ids.

    Shards are made where the rows are (about SHARD_BYTES of text each) with local ids; those of a task
    share a vocabulary up to VOCAB_WORDS words. The words of all vocabularies meet by their hash (`dictionary`)
    and get their ids there, written once; the ids go back to the shards as integers only, met
    with the shards of one vocabulary at a time.
    """
    local = materialise(local_shards(rows), "csr_local", FILE_ROWS)
    vocab = local.filter("words IS NOT NULL").select("vocab", "words")
    total = vocab.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    entries = materialise(dictionary(vocab, total // BUCKET_WORDS + 1), "dictionary").filter("vocab IS NOT NULL")
    shards = local.filter("shard IS NOT NULL").drop("words").groupBy("vocab").cogroup(entries.groupBy("vocab"))
    return shards.applyInArrow(_globalise, GLOBAL)


def word_counts(rows: DataFrame) -> DataFrame:
    """(__row, n_words, n_distinct) for every row of `rows` (__row, __text), from the CSR shards."""
    return csr_shards(rows).select("rows", "indptr", "data").mapInArrow(_row_counts, "__row long, n_words long, n_distinct long")


def failure_masks(docs: DataFrame, labels: DataFrame | None = None, id_col="doc_id", text_col="text", part_col="lang") -> DataFrame:
    """Per document: doc_id, part, mask (bit k set: filter FILTERS[k] fails), good, toxic.

    Rows are numbered as they are scanned (`monotonically_increasing_id`: a file scan gives every
    row the same number each time it is read, also when a lost task is run again); the texts are
    read twice, once for the word counts and once for the other filters, and never written.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("__id"), text.alias("__text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    ).withColumn("__row", F.monotonically_increasing_id())
    counts = word_counts(rows)
    upper = F.length("__text") - F.length(F.regexp_replace("__text", "[A-Z]", ""))
    meta = rows.select(
        "__row", "__id", "part",
        F.concat(F.sha2("__text", 256), F.lit(":"), F.length("__text").cast("string")).alias("__key"),
        (100 * upper > UPPER_PERCENT * F.length("__text")).alias("__c"),
        F.col("__text").rlike(SYMBOLS).alias("__d"),
    )
    first = meta.groupBy("__key").agg(F.min("__id").alias("__first"))
    flagged = meta.join(counts, "__row", "left").join(first, "__key")
    n_words, n_distinct = F.coalesce("n_words", F.lit(0)), F.coalesce("n_distinct", F.lit(0))
    fails = [
        n_words < MIN_WORDS,
        100 * n_distinct < DISTINCT_PERCENT * n_words,
        F.col("__c"),
        F.col("__d"),
        F.when(F.col("__id").isNull(), F.col("__first").isNotNull()).otherwise(F.col("__id") > F.col("__first")),
    ]
    mask = sum(F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails))
    flagged = flagged.select(F.col("__id").alias(id_col), "part", mask.alias("mask"))
    if labels is None:
        labels = spark.createDataFrame([], f"{id_col} long, quality int, toxic int")
    marks = labels.groupBy(F.col(id_col).cast("long").alias(id_col)).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    flagged = flagged.join(marks, id_col, "left")
    return flagged.select(id_col, "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def _steps():
    """(filter_order, step, bit, before) for every order of the filters and every step of it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def interaction_audit(docs: DataFrame, labels: DataFrame | None = None, **names) -> DataFrame:
    """One row per part, filter order (all 120) and step (1-5) with the counts of the module notes.

    kept: passing every filter up to this step; removed: failing this step's filter and none before;
    redundant: failing it and one before; unique_fails: failing it and no other of the five;
    good_lost / toxic_lost: removed here and marked good / toxic; shapley: documents that this
    step's filter removes, summed over all 120 orders.
    """
    masks = failure_masks(docs, labels, **names)
    cells = masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    steps = F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("before"))
        for o, s, b, e in _steps()
    ])
    grid = cells.select("part", "mask", "n", "good", "toxic", F.explode(steps).alias("s")).select(
        "part", "mask", "n", "good", "toxic", "s.*"
    )
    here = (F.col("mask").bitwiseAND(F.col("bit")) != 0)
    earlier = (F.col("mask").bitwiseAND(F.col("before")) != 0)

    def count(cond, weight="n"):
        return F.sum(F.when(cond, F.col(weight)).otherwise(F.lit(0))).cast("long")

    removed = here & ~earlier
    table = grid.groupBy("part", "filter_order", "step", "bit").agg(
        count(~here & ~earlier).alias("kept"),
        count(removed).alias("removed"),
        count(here & earlier).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(removed, "good").alias("good_lost"),
        count(removed, "toxic").alias("toxic_lost"),
    )
    shapley = table.groupBy("part", "bit").agg(F.sum("removed").cast("long").alias("shapley"))
    return table.join(shapley, ["part", "bit"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant",
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )
