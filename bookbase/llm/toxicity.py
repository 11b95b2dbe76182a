"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks.

The kernel of two words sums, over all subsequences of four letters that both hold, decay to the
power of the letters spanned in each; gaps lower it but don't end it, so an insult with inserted
or missing characters stays close to the insult. Landmark words map a word to its kernels with
them, whitened; a linear SVM is trained there. Since the kernel is an inner product over
subsequences, the trained function folds into one weight per subsequence, and a word is scored by
adding the weights of its own. A text is as toxic as its worst words: a logistic curve over the
highest value and the mean of the next two.

Labels are of texts. The words that the labelled texts tell apart (more often in toxic ones than
chance allows) are the positive examples, with copies in which a letter is inserted, doubled or
left out; words of the other texts, and of them in later rounds the highest scored, the
negative ones.
"""

import heapq
import math
import pickle
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import small_batches, some_by_hash

ORDER, SPAN, DECAY = 4, 7, 0.6

#: Rows of each label that are used at most.
SAMPLE = 2000

THRESHOLD = 0.7

#: Word scores that a worker keeps at most.
CACHE = 150_000

#: Words whose subsequences are held at once.
BLOCK = 4000

#: Letters written apart.
APART = re.compile(rb"(?<![^\s])(?:[a-z][\s.*_-]{1,2}){3,}[a-z](?![^\s.,;:!?])")


def words_in(text):
    """Distinct lower-cased words of a text as bytes, with letters written apart joined."""
    if not text:
        return set()
    low = text.encode("utf-8", "surrogatepass").lower()
    words = set(low.split())
    words.update(b"".join(re.findall(rb"[a-z]", m)) for m in APART.findall(low))
    return words


def letters(word):
    """Codes 1 to 31 of a word's start and letters: a to z, and four classes of other letters."""
    text = word.decode("utf-8", "replace").lower()
    return bytes([31] + [ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 4 for c in text if c.isalpha()])


def _steps():
    """Offsets of the letters of a subsequence within its span."""
    out = [(0,)]
    for _ in range(ORDER - 1):
        out = [o + (x,) for o in out for x in range(o[-1] + 1, SPAN)]
    return out


STEPS = _steps()


def subsequences(codes):
    """(row, subsequence, weight) of words given as bytes of letter codes, words scaled to alike norms."""
    sizes = np.array([len(c) for c in codes])
    flat = np.frombuffer(b"".join(c + bytes(SPAN) for c in codes) or b"", np.uint8).astype(np.int32)
    if not len(flat):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    row = np.repeat(np.arange(len(codes)), sizes + SPAN)
    row_out, code_out, weight_out = [], [], []
    m = len(flat) - SPAN + 1
    for step in STEPS:
        parts = [flat[o:o + m] for o in step]
        ok = parts[0] > 0
        for p in parts[1:]:
            ok = ok & (p > 0)
        at = np.flatnonzero(ok)
        code = np.zeros(len(at), np.int32)
        for p in parts:
            code = code * 32 + p[at]
        row_out.append(row[at]); code_out.append(code)
        weight_out.append(np.full(len(at), DECAY ** (step[-1] + 1), np.float32))
    rows, found, weights = map(np.concatenate, (row_out, code_out, weight_out))
    norms = np.sqrt(np.bincount(rows, weights.astype(float) ** 2, len(codes)))
    return rows, found, weights / np.maximum(norms, 1e-9)[rows]


class Machine:
    """A trained word function: a weight per subsequence, an offset, and the text's calibration."""

    def __init__(self, table, offset, slope, base):
        self.table, self.offset, self.slope, self.base = table, offset, slope, base
        self.known = {}

    def words(self, words):
        """Decision values of words (bytes); words of fewer than ORDER letters get the offset."""
        out = np.full(len(words), self.offset, float)
        for i in range(0, len(words), BLOCK):
            part = words[i:i + BLOCK]
            rows, code, weight = subsequences([letters(w) for w in part])
            out[i:i + BLOCK] += np.bincount(rows, self.table[code] * weight, len(part))
        return out

    def texts(self, texts):
        """Highest decision value of each text's words, and the mean of the next two; -2 for missing words."""
        sets = [words_in(t) for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        new = list(set().union(*sets).difference(self.known)) if sets else []
        self.known.update(zip(new, self.words(new).tolist()))
        top = [heapq.nlargest(3, map(self.known.__getitem__, s)) + [-2.0] * 3 for s in sets]
        return np.array([(t[0], (t[1] + t[2]) / 2) for t in top]).reshape(-1, 2)

    def scores(self, texts):
        return 1 / (1 + np.exp(-np.clip(self.texts(texts) @ self.slope + self.base, -30, 30)))

    def __getstate__(self):
        return {**self.__dict__, "known": {}}


def _columns(words):
    """Landmarks as a dense matrix over the subsequences they hold, and each one's row in it (0: none)."""
    rows, code, weight = subsequences([letters(w) for w in words])
    used, at = np.unique(code, return_inverse=True)
    dense = np.zeros((len(used) + 1, len(words)))
    np.add.at(dense, (at + 1, rows), weight)
    place = np.zeros(32**ORDER, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    return dense, place, used


def _kernels(words, dense, place):
    """Kernels of words with the landmarks."""
    out = np.zeros((len(words), dense.shape[1]))
    for i in range(0, len(words), 100):
        rows, code, weight = subsequences([letters(w) for w in words[i:i + 100]])
        at = place[code]
        keep = np.flatnonzero(at)
        keep = keep[np.argsort(rows[keep], kind="stable")]
        if len(keep):
            mine, first = np.unique(rows[keep], return_index=True)
            out[i + mine] = np.add.reduceat(dense[at[keep]] * weight[keep, None], first)
    return out


def _spread(words, counts, most):
    """Words picked one after the other for being frequent and unlike those picked before."""
    dense, place, _ = _columns(words)
    gram = _kernels(words, dense, place)
    near, picked = np.zeros(len(words)), []
    size = np.sqrt(np.maximum(gram.diagonal(), 1e-9))
    while len(picked) < min(most, len(words)):
        best = int(np.argmax(np.where(near < 2, (1.0001 - np.minimum(near, 1)) * np.log1p(counts), -1)))
        picked.append(best)
        near = np.maximum(near, gram[:, best] / size / size[best])
        near[best] = 2
    return [words[i] for i in picked]


def _machine(x, y, cost, ridge=1e-3):
    """Weights and offset of the linear SVM with squared hinge loss, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    cost = np.where(y > 0, cost / cost[y > 0].sum(), cost / cost[y < 0].sum())
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        part = x[active] * cost[active, None]
        new = np.linalg.solve(part.T @ x[active] + ridge * np.eye(len(w)), part.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], w[-1]


def _varied(word, rng):
    """Copies of a word with a letter inserted, doubled or left out."""
    text, out = word.decode("utf-8", "replace"), []
    for _ in range(4):
        at = int(rng.integers(1, len(text)))
        out.append(text[:at] + chr(97 + int(rng.integers(26))) + text[at:])
    at = int(rng.integers(len(text)))
    out.append(text[:at] + text[at] + text[at:])
    if len(text) > 5:
        out.append(text[:at] + text[at + 1:])
    return [t.encode() for t in out]


def _unlike(sets):
    """Positions of sets that aren't near copies of an earlier one, by eight minima of word hashes."""
    odd = np.random.default_rng(1).integers(0, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seen, out = {}, []
    for i, words in enumerate(sets):
        if not words:
            continue
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        least = enumerate((hashes[:, None] * odd).min(0).tolist())
        marks = list(least)
        shared = {}
        for m in marks:
            for j in seen.get(m, ()):
                shared[j] = shared.get(j, 0) + 1
        if max(shared.values(), default=0) < 4:
            out.append(i)
            for m in marks:
                seen.setdefault(m, []).append(i)
    return out


def train(sets, labels, landmarks=256, rounds=4, seed=0):
    """A Machine from the word sets of labelled texts; near copies count once, as their words aren't independent."""
    rng = np.random.default_rng(seed)
    kept = _unlike(sets)
    sets, labels = [sets[i] for i in kept], [labels[i] for i in kept]
    toxic = [s for s, y in zip(sets, labels) if y]
    clean = [s for s, y in zip(sets, labels) if not y]
    seen, other = {}, {}
    for group, count in ((toxic, seen), (clean, other)):
        for words in group:
            for w in words:
                count[w] = count.get(w, 0) + 1
    share = max(len(toxic), 1) / max(len(sets), 1)
    strange = {w: n for w, n in seen.items() if len(letters(w)) > ORDER and other.get(w, 0) * 20 <= n}
    chance = -math.log(max(len(seen), 2)) / math.log(min(share, 0.9))
    found = sorted((w for w, n in strange.items() if n > chance), key=lambda w: (-strange[w], w))
    if not found:  # too few texts to be sure: the words most telling so far
        found = sorted(strange, key=lambda w: (-strange[w], w))[:10]
    if not found or not clean:
        return Machine(np.zeros(32**ORDER, np.float32), -1.0, np.zeros(2), math.log(share / (1 - share)) if 0 < share < 1 else -2.0)
    positive = found[:600]
    varied = [(v, strange[w] / 6) for w in positive for v in _varied(w, rng)]
    negative = sorted(w for w in other if len(letters(w)) > ORDER)
    hard = [negative[i] for i in rng.permutation(len(negative))[:3000]]
    marks = _spread(positive, np.array([strange[w] for w in positive]), landmarks // 2)
    marks += hard[: landmarks - len(marks)]
    dense, place, used = _columns(marks)
    values, vectors = np.linalg.eigh(_kernels(marks, dense, place))
    good = values > 1e-6 * values.max()
    white = vectors[:, good] / np.sqrt(values[good])
    right = _kernels(positive + [v for v, _ in varied], dense, place) @ white
    right_cost = np.array([strange[w] for w in positive] + [c for _, c in varied], float)
    for _ in range(rounds):
        x = np.vstack([right, _kernels(hard, dense, place) @ white])
        y = np.r_[np.ones(len(right)), -np.ones(len(hard))]
        w, offset = _machine(x, y, np.r_[right_cost, np.ones(len(hard))])
        table = np.zeros(32**ORDER, np.float32)
        table[used] = dense[1:] @ (white @ w)
        machine = Machine(table, offset, np.zeros(2), 0.0)
        score = machine.words(negative)
        hard = sorted(set(hard).union(negative[i] for i in np.argsort(-score)[:500]))
    shown = [b"\n".join(t).decode("utf-8", "replace") for t in toxic[:1500] + clean[:1500]]
    y = np.r_[np.ones(len(toxic[:1500])), np.zeros(len(clean[:1500]))]
    machine.slope, machine.base = _calibrated(machine.texts(shown), y)
    return machine


def _calibrated(x, y):
    """Slopes and base of the logistic curve through scores x of labels y, both labels weighing the same."""
    cost = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (cost * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(curve, x.T @ (cost * (p - target)) + 1e-2 * w), -2, 2)
    return np.maximum(w[:-1], 0), float(w[-1])


def held_out(parts, part):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part


def fit(docs: DataFrame, labels: DataFrame, sample=SAMPLE) -> Machine:
    """A Machine trained on up to `sample` texts of each label (`toxic` 0 or 1).

    Which rows is decided by a hash of doc_id. One task gets them as sets of words and trains; the
    driver gets the machine, a few MB. Without toxic or without clean rows the machine scores every
    text by their share.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = some_by_hash(known, ["toxic"], "doc_id", sample)

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"].astype("int32"), "words": [b"\n".join(sorted(words_in(t))) for t in pdf["text"]]})

    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * sample rows
    rows = texts.mapInPandas(run, "toxic int, words binary")

    def learn(batches):
        parts = list(batches)
        if not parts:
            return
        part = pd.concat(parts).sort_values(["toxic", "words"])
        one = {}  # the texts share most of their words
        sets = [{one.setdefault(w, w) for w in bytes(words).split(b"\n") if w} for words in part["words"]]
        yield pd.DataFrame({"machine": [pickle.dumps(train(sets, part["toxic"].tolist()))]})

    made = rows.repartition(1).mapInPandas(learn, "machine binary").collect()
    return pickle.loads(made[0]["machine"]) if made else train([], [])


def score(docs: DataFrame, machine: Machine, out="score") -> DataFrame:
    """`docs` with the score of each text, 0 to 1; a null or empty text scores as harmless as can be.

    The machine goes to the workers as a file broadcast of a few MB whatever the input.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(texts), dtype=float)

    return docs.withColumn(out, of("text"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each text, learned from labels of the rows not held out.

    Held out are rows whose crc32(doc_id as text) mod 3 is 1 (never for a null doc_id). Other
    columns aren't read. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"))
    machine = fit(docs.filter(~held_out(3, 1)), labels)
    scored = score(rows, machine)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """`docs` without the rows whose text scores `threshold` or more; all columns stay."""
    machine = fit(docs.filter(~held_out(3, 1)), labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), "text")
    kept = score(packed, machine, "__score").filter(F.col("__score") < threshold)
    return kept.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
