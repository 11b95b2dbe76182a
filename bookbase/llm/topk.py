"""Exact top-k inner products by pivot-table elimination.

The pivot table holds each vector's distances to some pivots. |d(q,p) - d(x,p)| bounds d(q,x) from
below for every pivot p; the greatest of them bounds the inner product, (|q|² + |x|² - d²) / 2,
from above. Vectors are kept in blocks by their nearest pivot, with the range of each distance, so
that whole blocks can be ruled out; queries first see a block of their own pivot, which gives
them a score to beat, and then the blocks that may hold a better one. Inside a block candidates
are scored in the order of their bounds until the next bound is below the k-th score.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.llm.common import number_rows
from bookbase.session import materialise

#: Vectors of a block, queries of a query block, block outlines of a page.
BLOCK, QUERIES, PAGE = 4096, 1024, 1024

#: Share by which a bound is widened for the rounding of distances.
SLACK = 1e-9


def whole_vectors(vectors: DataFrame, scale=64) -> DataFrame:
    """vec_id and v, floor(scale * x) of each component; rows with a null or non-finite part are left out."""
    e = F.col("embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = vectors.filter(F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, fine))
    return ok.select("vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))


def choose_pivots(rows: DataFrame, pivots=32, sample=512):
    """{dimension: pivots} picked far from each other out of `sample` rows."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by_size, out = {}, {}
    for r in some:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    for size, vectors in by_size.items():
        x = np.array(vectors, np.float64).reshape(len(vectors), size)
        picked, least = [0], ((x - x[0]) ** 2).sum(1)
        while len(picked) < min(pivots, len(x)) and least.max(initial=0) > 0:
            picked.append(int(least.argmax()))
            least = np.minimum(least, ((x - x[picked[-1]]) ** 2).sum(1))
        out[size] = x[picked]
    return out


def _distances(v, pivots):
    p = pivots.get(v.shape[1], np.zeros((1, v.shape[1])))
    x = v.astype(np.float64)
    return np.stack([np.sqrt(((x - one) ** 2).sum(1)) for one in p], 1)


def _table(rows, pivots):
    """Adds each vector's number of components, nearest pivot and the bytes of its distances."""

    def run(batches):
        for pdf in batches:
            sizes = pdf["v"].map(len)
            for size in sizes.unique():
                part = pdf[sizes == size]
                v = np.array(part["v"].tolist(), np.int64).reshape(len(part), size)
                d = _distances(v, pivots)
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].to_numpy(), "dim": size, "cell": d.argmin(1),
                    "v": [r.tobytes() for r in v], "d": [r.tobytes() for r in d],
                })

    return rows.mapInPandas(run, "vec_id bigint, dim int, cell int, v binary, d binary")


def _packed(rows, size, name):
    """Blocks of up to `size` rows of one cell, each a row of bytes: name, dim, cell, n, ids, v, d."""
    numbered = number_rows(rows, ["dim", "cell"], ["vec_id", "v"], "__at")
    keyed = numbered.withColumn(name, F.concat_ws("/", "dim", "cell", F.floor(F.col("__at") / size)))
    pack = lambda pdf: pd.DataFrame({
        name: [pdf[name].iat[0]], "dim": [pdf["dim"].iat[0]], "cell": [pdf["cell"].iat[0]], "n": [len(pdf)],
        "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "v": [b"".join(pdf["v"])], "d": [b"".join(pdf["d"])],
    })
    return keyed.groupBy(name).applyInPandas(pack, f"{name} string, dim int, cell int, n int, ids binary, v binary, d binary")


def _open(row, prefix=""):
    n, dim = row[prefix + "n"], row[prefix + "dim"]
    ids = np.frombuffer(row[prefix + "ids"], np.int64)
    v = np.frombuffer(row[prefix + "v"], np.int64).reshape(n, dim)
    return ids, v, np.frombuffer(row[prefix + "d"], np.float64).reshape(n, -1)


def _bound(norms_q, norms_x, apart):
    """Upper bound of inner products from a lower bound of distances."""
    return (norms_q + norms_x - apart * apart) / 2 + SLACK * (norms_q + norms_x) + SLACK


def _norms(v):
    return (v.astype(np.float64) ** 2).sum(1)


def _scored(x, q):
    """Inner products of the rows of x with q, exact while they fit in 64 bits."""
    if len(q) * np.abs(x).max(initial=0).astype(float) * np.abs(q).max(initial=0).astype(float) < 2.0**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def _best(pairs, k):
    """Top k of each query inside each (query block, block) pair, as query_id, vec_id, score."""

    def run(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                qids, q, dq = _open(row, "q_")
                ids, x, dx = _open(row)
                beat = np.frombuffer(row["q_beat"], np.float64) if row["q_beat"] else np.full(len(qids), -np.inf)
                apart = np.zeros((len(q), len(x)))
                for p in range(dq.shape[1]):
                    np.maximum(apart, np.abs(dq[:, p, None] - dx[None, :, p]), out=apart)
                bounds = _bound(_norms(q)[:, None], _norms(x)[None, :], apart)
                bounds[qids[:, None] == ids[None, :]] = -np.inf
                out = []
                for i in range(len(q)):
                    at = np.flatnonzero((bounds[i] >= beat[i]) & (bounds[i] > -np.inf))
                    at = at[np.argsort(-bounds[i, at], kind="stable")]
                    done, step, scores = 0, 4 * k, np.empty(0, np.int64)
                    while done < len(at):
                        scores = np.concatenate([scores, _scored(x[at[done:done + step]], q[i])])
                        done, step = done + step, 2 * step
                        if len(scores) >= k and done < len(at):
                            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                            if bounds[i, at[done]] < kth:
                                break
                    top = np.lexsort((ids[at[:len(scores)]], -scores))[:k]
                    out.append((np.full(len(top), qids[i]), ids[at[top]], scores[top]))
                parts = [np.concatenate(c) for c in zip(*out)]
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), parts)))

    return pairs.mapInPandas(run, "query_id bigint, vec_id bigint, score bigint")


def _ranked(found, k):
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _outlines(blocks):
    """Range of the distances and largest norm of each block."""

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                _, v, d = _open(row)
                out.append((row["block"], row["dim"], row["cell"], d.min(0).tobytes(), d.max(0).tobytes(), float(_norms(v).max())))
            yield pd.DataFrame(out, columns=["block", "dim", "cell", "low", "high", "norm"])

    return blocks.mapInPandas(run, "block string, dim int, cell int, low binary, high binary, norm double")


def _reachable(pairs):
    """(q_block, block) of query blocks and pages of outlines that may hold a better vector."""

    def run(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                _, q, dq = _open(row, "q_")
                beat, norms = np.frombuffer(row["q_beat"], np.float64), _norms(q)
                near = []
                for one in row["page"]:
                    if one["dim"] != row["q_dim"] or one["block"] == row["q_seen"]:
                        continue
                    low, high = np.frombuffer(one["low"], np.float64), np.frombuffer(one["high"], np.float64)
                    apart = np.maximum(np.maximum(low - dq, dq - high), 0).max(1)
                    if (_bound(norms, one["norm"], apart) >= beat).any():
                        near.append(one["block"])
                yield pd.DataFrame({"q_block": [row["q_block"]] * len(near), "block": near}, dtype=object)

    return pairs.mapInPandas(run, "q_block string, block string")


def _with_score_to_beat(queries, first, k):
    """Adds q_beat, the k-th score of each query of a block so far."""
    kth = _ranked(first, k).groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    kth = kth.filter(F.col("n") >= k)

    def ids(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                yield pd.DataFrame({"q_block": row["q_block"], "at": np.arange(row["q_n"]), "query_id": _open(row, "q_")[0]})

    members = queries.mapInPandas(ids, "q_block string, at int, query_id bigint").join(kth, "query_id", "left")
    beats = members.groupBy("q_block").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("kth"))))["kth"].alias("beats")
    )  # a block has QUERIES members at most

    def run(batches):
        for pdf in batches:
            pdf["q_beat"] = [np.array(b, np.float64).tobytes() for b in pdf["beats"]]
            yield pdf.drop(columns="beats")

    schema = ", ".join(f"{n} {t}" for n, t in queries.dtypes) + ", q_beat binary"
    return queries.join(beats, "q_block").select(*queries.columns, "beats").mapInPandas(run, schema)


def top_k(vectors: DataFrame, queries: DataFrame, k=20, scale=64, pivots=32) -> DataFrame:
    """The k rows of `vectors` of highest integer inner product with each query, ties to smaller ids.

    Both tables have vec_id and embedding; gives query_id, rank (from 1), vec_id, score. Rows
    with the query's own id are no candidates. Vectors that are null or have a null or
    non-finite component, and rows without an id, take no part; vectors meet those of their own
    length only. Of query rows that share an id one is used. With fewer candidates than k all are
    given; empty tables give no rows. Other columns aren't read.
    """
    spark = vectors.sparkSession
    rows = materialise(whole_vectors(vectors, scale), "vectors")
    table = choose_pivots(rows, pivots)
    blocks = materialise(_packed(materialise(_table(rows, table), "pivots"), BLOCK, "block"), "blocks")
    asked = whole_vectors(queries, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialise(_table(asked, table), "asked")
    outlines = materialise(_outlines(blocks), "outlines")
    own = outlines.groupBy("dim", "cell").agg(F.min("block").alias("q_seen"))
    packed = _packed(asked, QUERIES, "block").join(own, ["dim", "cell"], "left")
    packed = materialise(packed.select("q_seen", *[F.col(c).alias(f"q_{c}") for c in ("block", "dim", "n", "ids", "v", "d")]), "queries")

    first = materialise(_best(packed.join(blocks, F.col("q_seen") == F.col("block")).withColumn("q_beat", F.lit(None).cast("binary")), k), "first")
    beaten = materialise(_with_score_to_beat(packed, first, k), "beat")
    n = outlines.count()
    pages = outlines.groupBy(F.pmod(F.xxhash64("block"), F.lit(max(1, n // PAGE))).alias("p")).agg(
        F.collect_list(F.struct("block", "dim", "low", "high", "norm")).alias("page")
    )
    each = beaten.withColumn("p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(1, n // PAGE) - 1).cast("bigint"))))
    pairs = materialise(_reachable(each.join(pages, "p").drop("p")), "pairs")
    rest = _best(pairs.join(beaten, "q_block").drop("q_block").join(blocks, "block"), k)
    return _ranked(first.union(rest), k).select("query_id", "rank", "vec_id", "score")
