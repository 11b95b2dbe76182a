"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of two and three bytes inside lower-cased words, blanks and punctuation
standing for word ends; each is hashed to a bucket with an embedding, a text is the average of
its subwords' embeddings, and a linear layer with softmax names the language. Both layers are
trained together by stochastic gradient descent in numpy. The temperature of the softmax and the
probability below which an answer is marked as rejected are fitted on texts kept out of training.
Since both layers are linear, scoring adds one row of class scores per subword.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import small_batches, some_by_hash

BUCKETS, WIDTH = 1 << 14, 16

#: Labelled texts of each language that are used at most.
SAMPLE = 800

UNKNOWN = "und"

_LETTERS = bytes(c if chr(c).islower() or c >= 128 else 32 for c in range(256))


def subwords(texts):
    """(text number, bucket) of every subword of the texts, in order."""
    parts = [b" " + t.lower().encode("utf-8", "replace").translate(_LETTERS) + b"  " if t else b"   " for t in texts]
    flat = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(p) for p in parts])
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), np.diff(np.r_[0, ends]))
    a, b, c = flat[:-2], flat[1:-1], flat[2:]
    inner = (owner[:-2] == owner[2:]) & (b != 32)
    at = np.flatnonzero(inner)
    two = (a[at] * np.uint32(0x9E3779B1) + b[at] * np.uint32(0x85EBCA77)) >> np.uint32(18)
    three = (a[at] * np.uint32(0xC2B2AE3D) + b[at] * np.uint32(0x27D4EB2F) + c[at] * np.uint32(0x165667B1)) >> np.uint32(18)
    return owner[:-2][at], two.astype(np.int32), three.astype(np.int32)


def bags(texts):
    """For each text the buckets of its subwords and their shares."""
    owner, two, three = subwords(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        part = slice(cuts[i], cuts[i + 1])
        used, n = np.unique(np.concatenate([two[part], three[part]]), return_counts=True)
        yield used, (n / max(n.sum(), 1)).astype(np.float32)


class Model:
    """Class scores of each bucket, the languages, the temperature and the rejection threshold."""

    def __init__(self, table, base, languages, temperature=1.0, threshold=0.0):
        self.table, self.base, self.languages = table, base, languages
        self.temperature, self.threshold = temperature, threshold

    def logits(self, texts):
        owner, two, three = subwords(texts)
        out = np.tile(self.base.astype(np.float64), (len(texts), 1))
        if len(owner):
            mine, first, n = np.unique(owner, return_index=True, return_counts=True)
            for c in range(out.shape[1]):
                column = self.table[:, c]
                out[mine, c] += np.add.reduceat(column[two] + column[three], first, dtype=np.float64) / (2 * n)
        return out / self.temperature

    def probabilities(self, texts):
        x = self.logits(texts)
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)


def train(rows, languages, epochs=12, rate=0.3, seed=0):
    """A Model from rows (language number, buckets, shares).

    Stochastic gradient descent on the cross entropy, languages weighing the same; the step of each
    weight shrinks with the gradients it has seen.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept_out = [rows[i] for i in order[: len(rows) // 5]]
    used = [rows[i] for i in order[len(rows) // 5:]] or rows
    deep = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    wide = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    base = np.zeros(len(languages), np.float32)
    seen = [np.full_like(x, 1e-8) for x in (deep, wide, base)]
    count = np.bincount([r[0] for r in used], minlength=len(languages))
    weight = len(used) / len(languages) / np.maximum(count, 1)
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(len(used)), -(-len(used) // 16)):
            batch = [used[i] for i in chunk]
            y = np.array([r[0] for r in batch])
            at, where = np.unique(np.concatenate([r[1] for r in batch]), return_inverse=True)
            bag = np.zeros((len(batch), len(at)), np.float32)
            bag[np.repeat(np.arange(len(batch)), [len(r[1]) for r in batch]), where] = np.concatenate([r[2] for r in batch])
            mean = bag @ deep[at]
            x = mean @ wide + base
            p = np.exp(x - x.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= (weight[y] / len(batch))[:, None]
            steps = (bag.T @ (p @ wide.T), mean.T @ p, p.sum(0))
            for values, square, step, part in zip((deep, wide, base), seen, steps, (at, slice(None), slice(None))):
                square[part] += step * step
                values[part] -= rate * step / np.sqrt(square[part])
    model = Model((deep @ wide).astype(np.float32), base, languages)
    _calibrate(model, kept_out or rows)
    return model


def _calibrate(model, rows, wanted=0.99):
    """Temperature of least loss, and the least probability at which `wanted` of the answers are right."""
    x = np.stack([model.base + (model.table[at] * share[:, None]).sum(0) for _, at, share in rows]).astype(np.float64)
    y = np.array([r[0] for r in rows])

    def chances(t):
        p = np.exp((x - x.max(1, keepdims=True)) / t)
        return p / p.sum(1, keepdims=True)

    loss = lambda t: -np.log(np.maximum(chances(t)[np.arange(len(y)), y], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    p = chances(model.temperature)
    best, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-best)
    good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= wanted
    model.threshold = float(best[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0


def _learned(doc_part=5):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(doc_part)) != 0


def fit(docs: DataFrame, sample=SAMPLE) -> Model:
    """A Model from up to `sample` texts of each `lang`, picked by a hash of doc_id.

    Subword shares of those texts are all that comes to the driver. Rows without a lang, a text or a
    letter teach nothing; without any row left the model knows no language.
    """
    small_batches(docs.sparkSession)
    fine = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    chosen = some_by_hash(fine.select("doc_id", "lang"), ["lang"], "doc_id", sample)

    def run(batches):
        for pdf in batches:
            made = list(bags(pdf["text"].tolist()))
            yield pd.DataFrame({
                "lang": pdf["lang"], "at": [b[0].astype(np.int32).tobytes() for b in made], "share": [b[1].tobytes() for b in made],
            })

    texts = fine.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])  # sample rows a language
    rows = texts.mapInPandas(run, "lang string, at binary, share binary").toArrow().to_pandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return Model(np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), [UNKNOWN])
    number = {name: i for i, name in enumerate(languages)}
    data = [
        (number[r.lang], np.frombuffer(r.at, np.int32), np.frombuffer(r.share, np.float32))
        for r in rows.sort_values(["lang", "at"]).itertuples() if len(r.at)
    ]
    return train(data, languages)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score (its probability) and rejected (below the fitted threshold).

    A text that is null or has no letter is `und` with score 0 and rejected.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang: string, score: double>")
    def of(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        p = m.probabilities(texts.tolist())
        return pd.DataFrame({"lang": np.array(m.languages, object)[p.argmax(1)], "score": p.max(1)})

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    told = docs.withColumn("__p", of("text")).withColumn("__l", lettered)
    score = F.when(F.col("__l"), F.col("__p.score")).otherwise(F.lit(0.0))
    return told.withColumns({
        "lang_pred": F.when(F.col("__l"), F.col("__p.lang")).otherwise(F.lit(UNKNOWN)), "score": score,
        "rejected": ~F.col("__l") | (score < F.lit(model.threshold)),
    }).drop("__p", "__l")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of each text, learned from the rows not held out.

    Held out are rows whose crc32(doc_id as text) mod 5 is 0 (never for a null doc_id). Takes
    doc_id, text and lang; other columns aren't read. An empty table gives no rows.
    """
    model = fit(docs.select("doc_id", "text", "lang").filter(_learned()))
    rows = docs.select("doc_id", "text", F.coalesce(~_learned(), F.lit(False)).alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
