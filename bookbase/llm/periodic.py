"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart equal), of length at
least max(6, 4q), that no neighbouring word extends with period q. Runs are found per text:

* periods up to `SHORT` by direct lag scans: for each lag, the maximal stretches where word i equals
  word i + lag;
* longer periods by minimizers at scales w = 2^s (s with 2^s > SHORT): inside a run of period
  q in [w, 2w), a window of w words and the same window q words later have equal content, so
  their minima sit exactly q apart with equal keys. Every pair of equal minimizer keys at a distance
  in [w, 2w) seeds an extension with that lag; seeds inside a stretch already extended with the
  same lag are skipped, so a long run is extended once per lag.

The key of word i hashes the word with its offset inside its stretch of equal words, so a stretch of
one repeated word does not make every position a minimizer. A stretch found for lag q is a run when
it is long enough and no divisor p < q of q gives the same stretch (then its smallest period is p).
Every run is found: no caps, every scale up to n / 4 is searched.

Edge cases: a null or empty text has no words and no runs; texts of fewer than 6 words have none;
repeated rows give repeated results; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Periods up to this are found by direct lag scans.
SHORT = 7


def _keys(ids: np.ndarray) -> np.ndarray:
    """Per word, a 64-bit key of (word, offset inside its stretch of equal words)."""
    n = len(ids)
    new = np.ones(n, dtype=bool)
    new[1:] = ids[1:] != ids[:-1]
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    offset = np.arange(n) - starts
    x = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (offset.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _stretches(equal: np.ndarray):
    """(start, end) of the maximal stretches of True, end exclusive."""
    if not len(equal):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    padded = np.concatenate(([False], equal, [False])).astype(np.int8)
    change = np.diff(padded)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _extend(ids, seed, lag):
    """The maximal stretch [start, end) of words around `seed` where word i equals word i + lag."""
    n = len(ids)
    left = seed
    step = 64
    while left > 0:
        lo = max(0, left - step)
        same = ids[lo:left] == ids[lo + lag:left + lag]
        if same.all():
            left = lo
            step *= 2
        else:
            left = lo + int(np.flatnonzero(~same)[-1]) + 1
            break
    right = seed
    step = 64
    while right + lag < n:
        hi = min(n - lag, right + step)
        same = ids[right:hi] == ids[right + lag:hi + lag]
        if same.all():
            right = hi
            step *= 2
        else:
            right = right + int(np.flatnonzero(~same)[0])
            break
    return left, right + lag


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """Every run of `words` as (start, length, period), ordered by start, then period."""
    n = len(words)
    if n < 6:
        return []
    codes = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=n)
    found = set()
    for lag in range(1, min(SHORT, n // 4) + 1):
        starts, ends = _stretches(ids[:-lag] == ids[lag:])
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s + lag >= max(6, 4 * lag):
                found.add((s, e + lag, lag))
    keys = _keys(ids)
    best = np.arange(n)  # best[i]: position of the smallest key in [i, i + w)
    w = 1
    while 2 * w <= n // 4:
        # Double the window: smallest key of [i, i + 2w) from those of [i, i + w) and [i + w, i + 2w).
        left, right = best[: n - 2 * w + 1], best[w: n - w + 1]
        best = np.where(keys[right] < keys[left], right, left)
        w *= 2
        if 2 * w <= SHORT + 1:
            continue
        low = max(w, SHORT + 1)
        spots = np.unique(best)
        by = np.lexsort((spots, keys[spots]))
        spots, values = spots[by], keys[spots][by]
        seeds = []
        for k in range(1, len(spots)):
            gap = spots[k:] - spots[:-k]
            near = (values[k:] == values[:-k]) & (gap < 2 * w)
            if not near.any():
                break
            take = near & (gap >= low)
            seeds.append(np.stack((gap[take], spots[:-k][take]), axis=1))
        if not seeds:
            continue
        seeds = np.concatenate(seeds)
        seeds = seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]
        covered_lag, covered_to = -1, -1
        for lag, at in seeds.tolist():
            if lag == covered_lag and at < covered_to:
                continue  # inside a stretch already extended with this lag
            start, end = _extend(ids, at, lag)
            covered_lag, covered_to = lag, end - lag
            if end - start >= max(6, 4 * lag):
                found.add((start, end, lag))
    spans = {}
    for s, e, q in found:
        spans.setdefault((s, e), []).append(q)
    runs = []
    for (s, e), periods in spans.items():
        for q in periods:
            if not any(p < q and q % p == 0 for p in periods):
                runs.append((s, e - s, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def summarise(words: list) -> dict:
    """The digest of one text's runs, as the registered query gives it."""
    runs = find_runs(words)
    drop = np.zeros(len(words), dtype=bool)
    for s, length, q in runs:
        drop[s + q: s + length] = True
    top = None
    for run in runs:
        s, length, q = run
        if top is None or length * top[2] > top[1] * q:
            top = run
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for w, gone in zip(words, drop.tolist()) if not gone)
    return {
        "n_runs": len(runs),
        "start": None if top is None else top[0],
        "length": None if top is None else top[1],
        "period": None if top is None else top[2],
        "exponent_milli": None if top is None else (1000 * top[1]) // top[2],
        "runs_sha256": hashlib.sha256(listing.encode("utf-8", "surrogatepass")).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(),
    }


SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(df, words_col="words", id_col="doc_id"):
    """Per row of `df`: its id and the digest of the runs of its array of words `words_col`.

    Rows are not moved (no shuffle); Python workers get a few hundred rows at a time. A null array
    counts as no words.
    """
    import pandas as pd

    from bookbase.llm.common import small_batches

    small_batches(df.sparkSession)
    schema = f"{id_col} long, {SCHEMA}"

    def run(frames):
        for frame in frames:
            rows = [summarise(list(w) if w is not None else []) for w in frame[words_col]]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            out.insert(0, id_col, frame[id_col].astype("Int64").to_numpy())
            for c in ("n_runs", "start", "length", "period", "exponent_milli"):
                out[c] = out[c].astype("Int64")
            yield out

    return df.select(id_col, words_col).mapInPandas(run, schema)
