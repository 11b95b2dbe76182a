"""Best-fit decreasing packing of token pieces, with a segment tree over remaining capacities.

Only lengths decide where best-fit decreasing puts a piece, so the packing is worked out for
the counts of each length (at most `capacity` of them) and is that of all pieces one by one:
items of one length fill the tightest open bin, then the next tightest. The resulting plan
names, for a run of item numbers of one length, the bins they go to. Its size depends on
`capacity`, not on the number of documents; the pieces themselves are numbered and placed by
Spark.
"""

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import number_rows, small_batches
from bookbase.session import materialise

CAPACITY = 2048

#: A text that holds this goes through the slower of the two equal tokenizers, which knows it.
SPECIAL = "<|endoftext|>"


class Tokens:
    """Token ids of texts; made once per Python worker.

    `tokenizer` is a tokenizers file; `ranks` the same vocabulary for tiktoken, which is several
    times faster and gives the same ids for texts without special tokens.
    """

    def __init__(self, tokenizer, ranks, pattern):
        self.tokenizer, self.ranks, self.pattern = tokenizer, ranks, pattern
        self.slow = self.fast = None

    def __call__(self, text):
        if not text:
            return np.zeros(0, np.uint32)
        if SPECIAL in text or not self.ranks:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.tokenizer)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if self.fast is None:
            import tiktoken

            with open(self.ranks, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return self.fast.encode_to_numpy(text, disallowed_special=())


def default_tokens():
    """The tokens of the public byte-level vocabulary installed beside the tokenizers."""
    import public_tokenizers as public

    return Tokens(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


_made = {}


def pieces(docs: DataFrame, tokens=None, capacity=CAPACITY, end=0) -> DataFrame:
    """Tokens of each text and the id `end` after them, cut into pieces of `capacity`.

    Gives doc_id, piece, start, length and ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers). Only documents longer than `capacity` are cut; the first piece takes what the
    full ones leave. A null or empty text is the one id `end`.
    """
    tokens = tokens or default_tokens()

    def run(batches):
        encode = _made.setdefault((tokens.tokenizer, tokens.ranks), tokens)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"]):
                ids = np.append(encode(text), end).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [
                    (doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": "Int64", "piece": "int32"}
            )

    small_batches(docs.sparkSession)
    out = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(run, out)


class Tightest:
    """Segment tree over capacities 0..n that finds the least capacity of at least x with an open bin."""

    def __init__(self, n):
        self.size = 1 << n.bit_length()
        self.open = np.zeros(2 * self.size, bool)

    def mark(self, capacity, is_open):
        at = capacity + self.size
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def least(self, capacity):
        at = capacity + self.size
        if self.open[at]:
            return capacity
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(histogram, capacity=CAPACITY):
    """Best-fit decreasing of `histogram` {length: count} as rows for runs of items of one length.

    A row (length, first, last, bin, each, used): items first..last-1 of that length go to bins
    from `bin` on, `each` to a bin, behind `used` tokens that the bin holds already.
    """
    tree, bins, rows, made = Tightest(capacity), {}, [], 0

    def put(room, start, count):
        if count and room:
            bins.setdefault(room, []).append((start, count))
            tree.mark(room, True)

    for length in sorted(histogram, reverse=True):
        done, count = 0, histogram[length]
        while done < count:
            room = tree.least(length)
            if room is None:  # open as many bins as these items fill
                room = capacity
                start, free = made, -(-(count - done) // (capacity // length))
                made += free
            else:
                start, free = bins[room].pop()
                if not bins[room]:
                    tree.mark(room, False)
            each = room // length
            full = min(free, (count - done) // each)
            if full:
                rows.append((length, done, done + full * each, start, each, capacity - room))
                put(room - each * length, start, full)
                done += full * each
            if full < free and done < count:  # one bin takes the rest, fewer than `each`
                rows.append((length, done, count, start + full, each, capacity - room))
                put(room - (count - done) * length, start + full, 1)
                done, full = count, full + 1
            if full < free:
                put(room, start + full, free - full)
    return rows


def pack(cut: DataFrame, capacity=CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` of 1 to `capacity`.

    `cut` is read several times: give it a written table. Pieces of equal length are
    interchangeable, so ties and repeated rows are placed in any order; every sequence is
    filled without gaps from 0. An empty table gives no rows.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    rows = plan(counts, capacity)
    table = spark.createDataFrame(
        pd.DataFrame(rows, columns=["p_length", "p_first", "p_last", "p_bin", "p_each", "p_used"]).astype("int64"),
        "p_length bigint, p_first bigint, p_last bigint, p_bin bigint, p_each bigint, p_used bigint",
    )
    numbered = number_rows(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "__item")
    inside = (F.col("length") == F.col("p_length")) & (F.col("__item") >= F.col("p_first")) & (F.col("__item") < F.col("p_last"))
    placed = numbered.join(F.broadcast(table), inside)  # bounded by the capacity, not by the input
    at = F.col("__item") - F.col("p_first")
    return placed.select(
        *cut.columns,
        (F.col("p_bin") + F.floor(at / F.col("p_each"))).cast("bigint").alias("sequence_id"),
        (F.col("p_used") + F.pmod(at, F.col("p_each")) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokens=None, capacity=CAPACITY, end=0) -> DataFrame:
    """Pieces of all documents with their place in sequences of `capacity` tokens; see `pieces`, `pack`.

    Only doc_id and text are read, so other columns may have any name; rows with a null doc_id
    or a repeated one are packed like others.
    """
    return pack(materialise(pieces(docs, tokens, capacity, end), "pieces"), capacity)
