"""Repeated passages by sparse suffix arrays.

Of all suffixes of a text only those are retained that start at a minimiser: the word run of `gram`
words with the smallest hash among all runs inside some passage of `length` words. Equal passages
choose equal minimisers, so a passage that repeats anywhere meets its copies at a retained suffix.
Suffixes are sorted by their first `gram` words and neighbours compared; where texts differ but
suffixes agree, they are extended to the left and right, a passage of `length` words at a time,
and the extended passages are sorted and compared again. Hashes stand for word runs (64 bits).
"""

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import WORD, small_batches
from bookbase.session import materialise, settle

LENGTH, GRAM = 50, 25

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(text):
    words = text.encode("utf-8", "surrogatepass").split() if text else ()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


def passages(hashes, length=LENGTH, gram=GRAM):
    """For each run of `length` words: the hash of its minimiser and its own."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    up, down = np.full(n + 1, _BASE), np.full(n + 1, _BACK)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n])])
    grams = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    whole = _mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])
    least = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1).min(1)
    return least, whole


def _identity():
    """Rows that share a doc_id are one document; a row without one goes by its text."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(F.lit("text"), "text"))


def _retained(docs, length, gram):
    """id, same (hash of the whole text), n (words), key (a retained suffix's first words, null if none)."""

    def run(batches):
        for pdf in batches:
            out = []
            for who, same, text in zip(pdf["id"], pdf["same"], pdf["text"]):
                hashes = word_hashes(text)
                keys = np.unique(passages(hashes, length, gram)[0]).view(np.int64)
                out.append((np.full(max(1, len(keys)), who), same, len(hashes), keys))
            sizes = [len(o[0]) for o in out]
            keys = np.concatenate([o[3] if len(o[3]) else np.zeros(1, np.int64) for o in out])
            known = np.repeat([len(o[3]) > 0 for o in out], sizes)
            yield pd.DataFrame({
                "id": np.concatenate([o[0] for o in out]), "same": np.repeat([o[1] for o in out], sizes),
                "n": np.repeat([o[2] for o in out], sizes).astype(np.int32),
                "key": pd.arrays.IntegerArray(keys, ~known),
            })

    return docs.mapInPandas(run, "id bigint, same bigint, n int, key bigint")


def _extended(met, length, gram):
    """id, same, last, start and hash of the passages around the retained suffixes in `keys`."""

    def run(batches):
        for pdf in batches:
            for who, same, last, text, keys in zip(pdf["id"], pdf["same"], pdf["last"], pdf["text"], pdf["keys"]):
                least, whole = passages(word_hashes(text), length, gram)
                at = np.flatnonzero(np.isin(least.view(np.int64), keys))
                if len(at):
                    yield pd.DataFrame({"id": who, "same": same, "last": last, "start": at.astype(np.int32), "run": whole[at].view(np.int64)})

    return met.mapInPandas(run, "id bigint, same bigint, last bigint, start int, run bigint")


def _spans(starts, length):
    """Starts of passages as the disjoint spans they cover, [(first word, word after the last)]."""
    starts = np.unique(np.asarray(starts, np.int64))
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts) > length) + 1
    return list(zip(starts[np.r_[0, new]].tolist(), (starts[np.r_[new - 1, -1]] + length).tolist()))


def repeats(docs: DataFrame, length=LENGTH, gram=GRAM) -> DataFrame:
    """id, same (hash of a text), n (words), spans and cuts of each text that shares a passage of `length` words with another document.

    Takes doc_id and text. Words are runs of anything but blanks. spans: array of (start, end) in
    words that lie in such passages; cuts: the part of them that a document with a smaller id
    holds already. Copies of a whole text follow from its first one. Rows that share a doc_id are one
    document, of which each text has its own spans and cuts; rows without one go by their text. Texts shorter than `length`, empty or null never
    appear; an empty table gives no rows. Other columns aren't read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(_identity().alias("id"), F.xxhash64("text").alias("same"), "text")
    kept = materialise(_retained(rows, length, gram), "suffixes")
    texts = kept.groupBy("id", "same").agg(F.first("n").alias("n"))
    groups = kept.filter("key IS NOT NULL").groupBy("same").agg(
        F.min("id").alias("first"), F.max("id").alias("last")
    )
    groups = materialise(groups, "groups")
    shared = kept.filter("key IS NOT NULL").groupBy("key").agg(F.min("same").alias("low"), F.max("same").alias("high"))
    # Written tables on both sides of a join let Spark split a hot key of it.
    shared = materialise(shared.filter("low <> high").select("key"), "shared")
    firsts = groups.select(F.col("same").alias("first_same"), "first", "last")
    own = kept.join(shared, "key").groupBy("id", "same").agg(F.collect_set("key").alias("keys"))
    own = own.join(firsts, (F.col("same") == F.col("first_same")) & (F.col("id") == F.col("first")))
    met = rows.join(own.select(F.col("id").alias("own"), F.col("same").alias("own_same"), "last", "keys"),
                    (F.col("id") == F.col("own")) & (F.col("same") == F.col("own_same")))
    found = materialise(_extended(met.select("id", "same", "last", "text", "keys"), length, gram), "passages")
    holders = found.groupBy("run").agg(F.min("id").alias("low"), F.max("last").alias("high")).filter("low <> high")
    holders = materialise(holders, "holders")
    marked = found.join(holders, "run").select("id", "same", "start", (F.col("id") != F.col("low")).alias("cut"))
    starts = marked.groupBy("id", "same").agg(
        F.collect_list("start").alias("starts"), F.collect_list(F.when(F.col("cut"), F.col("start"))).alias("cut_starts")
    )  # of one text of a document

    many = groups.filter("first <> last").withColumnRenamed("same", "many_same").drop("last")
    long_enough = texts.filter(F.col("n") >= length)
    whole = long_enough.join(many, F.col("same") == F.col("many_same"), "left").drop("many_same")
    every = whole.join(starts, ["id", "same"], "left").filter("first IS NOT NULL OR starts IS NOT NULL")

    def run(batches):
        for pdf in batches:
            out = []
            for who, same, n, first, starts, cuts in zip(pdf["id"], pdf["same"], pdf["n"], pdf["first"], pdf["starts"], pdf["cut_starts"]):
                spans, cut = _spans([] if starts is None else starts, length), _spans([] if cuts is None else cuts, length)
                if not pd.isna(first):
                    spans = [(0, n)]
                    cut = [(0, n)] if who != first else cut
                out.append((who, same, n, spans, cut))
            yield pd.DataFrame(out, columns=["id", "same", "n", "spans", "cuts"])

    pair = "array<struct<start: int, end: int>>"
    picked = every.select("id", "same", "n", "first", "starts", "cut_starts")
    return picked.mapInPandas(run, f"id bigint, same bigint, n int, spans {pair}, cuts {pair}")


def passage_rows(docs: DataFrame, length=LENGTH, gram=GRAM) -> DataFrame:
    """A row for each span of repeated passages: doc_id, start_word, end_word, cut_words."""
    found = repeats(docs, length, gram)
    span = found.select("id", "cuts", F.explode("spans").alias("s"))
    inside = F.aggregate(
        "cuts", F.lit(0),
        lambda n, c: n + F.greatest(F.lit(0), F.least(c["end"], F.col("s.end")) - F.greatest(c["start"], F.col("s.start"))),
    )
    return span.select(
        F.col("id").alias("doc_id"), F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"),
        inside.alias("cut_words"),
    )


def without(text, cuts):
    """The text without the words of `cuts`; the blanks behind a cut word go with it."""
    at = [m.start() for m in regex.finditer(WORD, text)] + [len(text)]
    out, done = [], 0
    for start, end in cuts:
        out.append(text[done:at[start]])
        done = at[min(end, len(at) - 1)]
    return "".join(out) + text[done:]


def cut_repeats(docs: DataFrame, length=LENGTH, gram=GRAM) -> DataFrame:
    """`docs` with every repeated passage cut out but in the document of the smallest id that holds it.

    Keeps all columns and rows; n_chars, if there, is that of the new text. See `repeats`.
    """
    cuts = lambda: repeats(docs, length, gram).filter(F.size("cuts") > 0).select(F.col("id").alias("__id"), F.col("same").alias("__same"), "cuts")
    found = settle(docs.sparkSession, cuts, "cuts")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), _identity().alias("__own"),
        F.xxhash64("text").alias("__hash"),
    )
    met = rows.join(found, (F.col("__own") == F.col("__id")) & (F.col("__hash") == F.col("__same")), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([
            t if t is None or c is None else without(t, [(s["start"], s["end"]) for s in c]) for t, c in zip(texts, cuts)
        ], dtype=object)

    text = F.when(F.col("cuts").isNotNull(), cut("__doc.text", "cuts")).otherwise(F.col("__doc.text"))
    new = met.select("__doc", text.alias("__text"))
    made = {"text": F.col("__text"), "n_chars": F.length("__text").cast("bigint")}
    return new.select(*[made.get(c, F.col("__doc")[c]).alias(c) for c in docs.columns])
