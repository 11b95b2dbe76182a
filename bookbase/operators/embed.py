"""Text to vectors: hashed bags of words, or a model the caller brings."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookbase.functions.bind import let
from bookbase.functions.text import words

DIM = 64


def bucket(word, dim=DIM) -> Column:
    """Bucket of a word: the first 32 bits of its MD5, modulo `dim`."""
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def _ends(ordered):
    """Last position of each run of equal values in a sorted array that is not empty."""
    last = F.size(ordered) - 1
    return F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == last) | (F.get(ordered, i) != F.get(ordered, i + 1))
    )


def hashed_counts(c, dim=DIM) -> Column:
    """ARRAY<INT> of how often each of the `dim` buckets is hit by a word of the text `c`.

    A document's words never leave its row: they are hashed, sorted together with one marker
    per bucket, and the run lengths less the marker are the counts. No explode, no shuffle.
    """
    marks = F.sequence(F.lit(0), F.lit(dim - 1))
    hashed = F.transform(words(c), lambda w: bucket(w, dim))
    lengths = lambda ends: F.transform(ends, lambda e, i: e - F.coalesce(F.get(ends, i - 1), F.lit(-1)) - 1)
    return let(F.sort_array(F.concat(hashed, marks)), lambda s: let(_ends(s), lengths))


def document_frequency(df: DataFrame, counts="counts") -> DataFrame:
    """(bucket, df): number of rows that hit each bucket; as many rows as there are buckets."""
    hit = df.select(F.posexplode(counts).alias("bucket", "n")).filter("n > 0")
    return hit.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))


def idf_weights(df: DataFrame, column, dim=DIM):
    """Inverse document frequency per bucket, a list of `dim` numbers: ln((1+N)/(1+df)) + 1."""
    # One pass: a text with words hits the mark after the last bucket as well, which counts such texts.
    counts = hashed_counts(column, dim)
    some = F.exists("counts", lambda n: n > 0)
    counted = df.select(counts.alias("counts")).select(F.concat("counts", F.array(some.cast("int"))).alias("counts"))
    seen = dict(document_frequency(counted).collect())
    total = seen.pop(dim, 0)
    return [math.log((1 + total) / (1 + seen.get(b, 0))) + 1 for b in range(dim)]


def embed(df: DataFrame, column, dim=DIM, idf=None, out="embedding") -> DataFrame:
    """Add the unit-length hashed word vector of `column`; null for a text without words.

    `idf` is the list made by `idf_weights`; queries must use the list of their corpus.
    """
    weighted = F.transform(hashed_counts(column, dim), lambda n: n.cast("double"))
    if idf is not None:
        factors = F.array(*[F.lit(float(x)) for x in idf])
        weighted = F.zip_with(weighted, factors, lambda n, x: n * x)

    def unit(w):
        norm = F.sqrt(F.aggregate(w, F.lit(0.0), lambda acc, x: acc + x * x))
        scaled = lambda n: F.when(n > 0, F.transform(w, lambda x: (x / n).cast("float")))
        return let(norm, scaled)

    return df.withColumn(out, let(weighted, unit))


def _decoded(texts):
    """The strings of an Arrow column; what is not UTF-8 is replaced, as Spark does."""
    return (None if t is None else t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist())


def _quiet(text):
    """`clean_text` but for the lower case: `str.split` takes the blanks of `words` for blanks, line ends among them."""
    for sign in "`“”():;,":
        text = text.replace(sign, " ")
    return " ".join(text.replace("''", " ").split())


def _unit_counts(texts, dim):
    """Unit vectors of how often each bucket is hit by a word of the cleaned texts (an Arrow column), null without words."""
    split = pc.split_pattern(texts, " ")
    coded = split.flatten().dictionary_encode()
    found = coded.dictionary.cast(pa.binary()).to_pylist()
    digest = lambda w: hashlib.md5(w, usedforsecurity=False).digest()
    buckets = np.array([int.from_bytes(digest(w)[:4], "big") % dim for w in found], np.int64)
    code, row = coded.indices.to_numpy(), pc.list_parent_indices(split).to_numpy()
    full = np.array([len(w) > 0 for w in found], bool)  # an empty text gives an empty piece
    keep = full[code] if len(code) else np.zeros(0, bool)
    counts = np.bincount(row[keep] * dim + buckets[code[keep]], minlength=len(texts) * dim).reshape(len(texts), dim)
    norms = np.sqrt((counts * counts).sum(1).astype(np.float64))
    unit = (counts / np.where(norms > 0, norms, 1.0)[:, None]).astype(np.float32)
    ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(ends, pa.array(unit.ravel()), mask=pa.array(norms == 0))


def embed_cleaned(df: DataFrame, column, dim=DIM, out="embedding") -> DataFrame:
    """As `embed` of `clean_text` of `column`, for whole tables of long texts.

    Texts are cleaned and their words counted in Arrow batches, so a word that occurs often in a batch is
    hashed once; between the two, Spark makes the lower case. The vectors are those of `embed`.
    """

    @F.arrow_udf("string")
    def quiet(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _quiet(t) for t in _decoded(texts)], pa.string())

    @F.arrow_udf("array<float>")
    def vectors(texts: pa.Array) -> pa.Array:
        return _unit_counts(texts, dim)

    return df.withColumn(out, vectors(F.lower(quiet(column))))


def sparse(df: DataFrame, column="embedding") -> DataFrame:
    """One row per non-zero bucket: `bucket` and `weight` in place of the vector."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    # The outer form keeps the optimizer from testing the vector before it is exploded.
    rows = df.select(*rest, F.posexplode_outer(column).alias("bucket", "weight"))
    return rows.filter("weight <> 0").withColumn("bucket", F.col("bucket").cast("bigint"))


def embed_with(df: DataFrame, column, load, batch=32, out="embedding") -> DataFrame:
    """Add vectors from the caller's own model; null for an empty text.

    `load()` runs once per task and gives a function from a list of texts to a list of vectors;
    that function gets up to `batch` texts at a time.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches):
        model = load()
        for table in batches:
            texts = table.column(table.schema.get_field_index(column)).to_pylist()
            vectors = [None] * len(texts)
            filled = [i for i, t in enumerate(texts) if t]
            for start in range(0, len(filled), batch):
                picked = filled[start : start + batch]
                made = model([texts[i] for i in picked])
                if len(made) != len(picked):
                    raise ValueError(f"the model gave {len(made)} vectors for {len(picked)} texts")
                for i, vector in zip(picked, made):
                    vectors[i] = [float(x) for x in vector]
            column_out = pa.array(vectors, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*table.columns, column_out], [*table.schema.names, out])

    return df.mapInArrow(run, schema)


def densify(df: DataFrame, key, dim=DIM, out="embedding") -> DataFrame:
    """(key, vector) out of sparse rows (key, bucket, weight); at most `dim` rows per key meet."""
    entries = F.map_from_entries(F.collect_list(F.struct("bucket", "weight")))
    packed = df.groupBy(key).agg(entries.alias("__m"))
    at = F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint"))
    vector = F.transform(at, lambda b: F.coalesce(F.try_element_at("__m", b), F.lit(0.0)).cast("float"))
    return packed.select(key, vector.alias(out))
