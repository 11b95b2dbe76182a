"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

Words belong to classes: each of the most frequent words is one, the others are grouped by their
last letters. The model predicts the class of a token from those of the two before it: context
classes' embeddings pass through a matrix each and are summed, and the inner product with the
next class's embedding plus its bias is the score. It is trained in numpy on the counts of all
class triples of the training texts, telling them from noise by class frequency: every step takes
all triples by their counts and the expected noise of each context, so nothing is drawn. One
batched matrix product over all contexts, normalised by its row sums, gives every class's log
probability. Inside its class a word has its smoothed share of the training tokens, so the
probabilities of all words and one unseen word of each class add up to 1.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import small_batches, words_of
from bookbase.session import materialise

#: Class 0 stands for the place before a text, class 1 for its end.
START, END = 0, 1
SINGLE, GROUPS = 94, 32
CLASSES = 2 + SINGLE + GROUPS

#: Words whose counts go to every task (some MB); others meet theirs in a join.
FREQUENT = 1 << 17

SMOOTH = 0.1


def group_of(word):
    """Class of a word that has none of its own, by its last two bytes."""
    return 2 + SINGLE + xxhash.xxh32_intdigest(word[-2:], 7) % GROUPS


def _hash(word):
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _learned():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0, F.lit(True))


def _counts(docs):
    """word hash, group, count in training tokens, and the word itself where a task met it often."""

    def run(batches):
        count = {}

        def told(rows):
            words, n = list(rows), list(rows.values())
            return pd.DataFrame({
                "h": np.fromiter(map(_hash, words), np.int64, len(words)),
                "g": np.fromiter(map(group_of, words), np.int16, len(words)), "n": np.array(n, np.int64),
                "word": [w if k >= 3 else None for w, k in rows.items()],
            })

        for pdf in batches:
            for text in pdf["text"]:
                for w in words_of(text):
                    count[w] = count.get(w, 0) + 1
            if len(count) > 400_000:
                yield told(count)
                count = {}
        if count:
            yield told(count)

    made = docs.filter(_learned()).select("text").mapInPandas(run, "h bigint, g smallint, n bigint, word binary")
    # Words met often travel on their own, so that the bulk of rows is numbers that combine cheaply.
    return materialise(made, "words")


class Frequent:
    """Counts and classes of the most frequent words, for the tasks."""

    def __init__(self, words, counts, groups):
        self.words, self.counts = words, counts
        self.classes = np.where(np.arange(len(words)) < SINGLE, 2 + np.arange(len(words)), groups)
        self._place = None

    def place(self):
        if self._place is None:
            self._place = {w: i for i, w in enumerate(self.words)}
        return self._place

    def __getstate__(self):
        return {**self.__dict__, "_place": None}

    def of(self, words):
        """Number of each word among the frequent ones, -1 for others."""
        get = self.place().get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


def _classes(frequent, words, numbers):
    """Class of each token."""
    out = np.empty(len(words), np.int64)
    known = numbers >= 0
    out[known] = frequent.classes[numbers[known]]
    out[~known] = [group_of(words[i]) for i in np.flatnonzero(~known)]
    return out


def _triples(docs, sent):
    """Counts of class triples in training texts, ends included."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                words = words_of(text)
                c = np.r_[START, START, _classes(sent.value, words, sent.value.of(words)), END]
                np.add.at(total, (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], 1)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"t": at, "n": total[at]})

    made = docs.filter(_learned()).select("text").mapInPandas(run, "t bigint, n bigint")
    return made.groupBy("t").agg(F.sum("n").alias("n"))


def train(triples, counts, width=24, noise=8, steps=400, seed=0):
    """Log probabilities (natural) of each class after each pair of classes, as CLASSES² × CLASSES."""
    rng = np.random.default_rng(seed)
    n = np.bincount(triples % CLASSES, counts, CLASSES) + 1e-3
    share = n / n.sum()
    context = rng.normal(0, 0.1, (2, CLASSES, width))
    mix = np.stack([np.eye(width)] * 2)
    target = rng.normal(0, 0.1, (CLASSES, width))
    bias = np.log(share)
    if len(triples):
        pairs, row = np.unique(triples // CLASSES, return_inverse=True)
        a, b = pairs // CLASSES, pairs % CLASSES
        real = np.zeros((len(pairs), CLASSES), np.float32)
        np.add.at(real, (row, triples % CLASSES), counts / counts.sum())
        both = real + noise * real.sum(1, keepdims=True) * share.astype(np.float32)
        log_noise = np.log(noise * share)
        speed = [np.zeros_like(x) for x in (context, mix, target, bias)]
        for step in range(steps):
            q = ((context[0] @ mix[0])[a] + (context[1] @ mix[1])[b]).astype(np.float32)
            p = q @ target.T.astype(np.float32)
            p += (bias - log_noise).astype(np.float32)
            np.clip(p, -30, 30, out=p)
            np.negative(p, out=p)
            np.exp(p, out=p)
            p += 1
            np.divide(both, p, out=p)
            p -= real
            dq = p @ target.astype(np.float32)
            grads = [np.zeros_like(x) for x in (context, mix, target, bias)]
            for side, at in enumerate((a, b)):
                part = np.column_stack([np.bincount(at, dq[:, d], CLASSES) for d in range(width)])
                grads[0][side], grads[1][side] = part @ mix[side].T, context[side].T @ part
            grads[2], grads[3] = p.T @ q, p.sum(0)
            rate = 0.05 * (1 - step / steps)
            for value, grad, s in zip((context, mix, target, bias), grads, speed):
                s *= 0.99
                s += 0.01 * grad * grad
                value -= rate * grad / (np.sqrt(s / (1 - 0.99 ** (step + 1))) + 1e-15)
    left = (context[0] @ mix[0])[:, None, :] + (context[1] @ mix[1])[None, :, :]
    logits = left.reshape(-1, width) @ target.T + bias
    logits[:, START] = -np.inf
    top = logits.max(1, keepdims=True)
    return (logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True))).astype(np.float32)


def _octave():
    """Eighths of an octave of a word's count."""
    return F.floor(F.log2("n") * 8).cast("int")


def _least_octave(counted):
    """The least step of counts from which on there are at most FREQUENT words."""
    steps = counted.groupBy(_octave().alias("o")).count().collect()  # a few hundred rows
    least, total = 1 << 20, 0
    for o, n in sorted(steps, reverse=True):
        total += n
        if total > FREQUENT:
            break
        least = o
    return least


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of each text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from rows whose crc32(doc_id as text) mod 10 is not 0, and those without a doc_id.
    A null text counts as empty, one end token. Scores are log10 probabilities. Only doc_id and
    text are read. Counts are of all training tokens; words are told apart by 64-bit hashes.
    With no training row every word is unseen; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = _counts(docs)
    counted = materialise(made.groupBy("h").agg(F.sum("n").alias("n"), F.first("g").alias("g")), "counts")
    totals = counted.groupBy("g").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # GROUPS rows
    ends = docs.filter(_learned()).count()
    top = counted.filter(_octave() >= _least_octave(counted))
    spelled = made.filter("word IS NOT NULL").groupBy("h").agg(F.first("word").alias("word"))
    named = top.join(spelled, "h").toArrow().to_pandas().sort_values(["n", "h"], ascending=[False, True])  # FREQUENT rows at most
    frequent = Frequent([bytes(w) for w in named["word"]], named["n"].to_numpy(np.int64), named["g"].to_numpy(np.int64))
    sent = spark.sparkContext.broadcast(frequent)

    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in totals:
        size[r["g"]], kinds[r["g"]] = r["n"], r["v"]
    singles = min(SINGLE, len(frequent.words))
    for i in range(singles):
        g = int(named["g"].iat[i])
        size[g] -= frequent.counts[i]
        kinds[g] -= 1
    all_tokens = int(sum(r["n"] for r in totals)) + ends
    all_kinds = int(sum(r["v"] for r in totals)) + (1 if ends else 0)

    triples = _triples(docs, sent).toArrow().to_pandas().sort_values("t")  # CLASSES³ rows at most
    table = train(triples["t"].to_numpy(np.int64), triples["n"].to_numpy(np.int64))
    inside = np.log10(size + SMOOTH * (kinds + 1))  # of a group; a class of its own has one word
    model = spark.sparkContext.broadcast((table, inside))
    unit = 1 / np.log(10)
    base_of_all = float(np.log10(all_tokens + SMOOTH * (all_kinds + 1)))

    def run(batches):
        words_known, (log_table, log_inside) = sent.value, model.value
        logs = np.log10(words_known.counts + SMOOTH)
        row = TaskContext.get().partitionId() << 40
        for pdf in batches:
            texts, rare = [], []
            for doc_id, held, text in zip(pdf["doc_id"], pdf["held_out"], pdf["text"]):
                row += 1
                words = words_of(text)
                numbers = words_known.of(words)
                c = np.r_[START, START, _classes(words_known, words, numbers), END]
                value = float(log_table[c[:-2] * CLASSES + c[1:-1], c[2:]].sum(dtype=np.float64)) * unit
                own = numbers[numbers >= 0]
                value += float(logs[own[own >= SINGLE]].sum()) - float(log_inside[c[2:-1][c[2:-1] >= 2 + SINGLE]].sum())
                texts.append((row, doc_id, held, len(words), len(own), float(logs[own].sum()), value))
                others = {}
                for i in np.flatnonzero(numbers < 0):
                    others[words[i]] = others.get(words[i], 0) + 1
                rare += [(row, _hash(w), k) for w, k in others.items()]
            for columns, part in ((names[:7], texts), (["row", "h", "k"], rare)):
                yield pd.DataFrame(part, columns=columns).reindex(columns=names).astype(kinds)

    schema = "row bigint, doc_id bigint, held_out boolean, words bigint, known bigint, base double, value double, h bigint, k bigint"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"doc_id": "Int64", "held_out": "boolean", "words": "Int64", "known": "Int64", "h": "Int64", "k": "Int64"}
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", (~_learned()).alias("held_out"))
    facts = materialise(rows.mapInPandas(run, schema), "facts")
    rare = facts.filter("h IS NOT NULL").select("row", "h", "k").join(counted.select("h", "n"), "h", "left")
    seen = rare.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("rare"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known"),
    )
    every = facts.filter("h IS NULL").drop("h", "k").join(seen, "row", "left")
    more, end = F.coalesce("rare", F.lit(0.0)), F.lit(float(np.log10(ends + SMOOTH)))
    tokens = F.col("words") + 1
    return every.select(
        "doc_id", "held_out", tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(all_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more + end - tokens * base_of_all).alias("base_score"), (F.col("value") + more).alias("score"),
    )
