"""A two-level centre tree over cells, for indexes of any number of cells.

Cells (about the root of the number of vectors, no upper limit) sit under groups (about the root of
the number of cells). Group centres come from k-means over a drawn sample; each group then finds
its own cell centres by Lloyd's rounds over the sample rows nearest to it, in one task per group,
as many cells as its share of the sample. Every task holds the group centres only; the centres of
one group's cells travel as one row, joined to the rows or queries that go to that group.

Layout under `path`: `groups` (group, centre, radius: the farthest a member vector can lie from the
group centre), `cells` (cell, group, centre, size, radius, as `knn` cells are, plus their group),
`vectors` (cid, cv, cell, reach) partitioned by cell.

`knn_tree` is exact: each query is answered in the nearest cell of its nearest group; its k-th
distance there bounds the true one, and a group or cell is asked only when its distance less its
radius is within that bound (triangle inequality). `knn_tree_approx` searches by beam: the `beam`
nearest groups, then the `probe` nearest cells among their cells.

Edge cases: rows without a vector are not indexed; an empty corpus has one empty group and cell;
queries without a vector have no rows; ranks follow (rounded distance, id), as in `knn`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.operators import distance as D
from bookbase.operators import knn
from bookbase.session import materialise, path_exists

#: Sample rows drawn per cell for fitting centres.
PER_CELL = 20
#: Lloyd's rounds per group.
ROUNDS = 10
#: Points compared with centres at once inside a group (bounds the memory of one task).
CHUNK = 4096


def _nearest(points, centres):
    """Index of and distance to the nearest centre, in chunks of CHUNK points."""
    at = np.zeros(len(points), np.int64)
    away = np.zeros(len(points))
    for s in range(0, len(points), CHUNK):
        d = D.euclid(points[s:s + CHUNK], centres)
        at[s:s + CHUNK] = d.argmin(1)
        away[s:s + CHUNK] = d[np.arange(len(d)), at[s:s + CHUNK]]
    return at, away


def _lloyd(points, k, seed):
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(points)))
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        at, _ = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, points)
        counts = np.bincount(at, minlength=k)[:, None]
        moved = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


class _Groups:
    """Group centres and radii, the only centres every task holds."""

    def __init__(self, rows, metric, top):
        rows = sorted(rows, key=lambda r: r["group"])
        self.ids = np.array([r["group"] for r in rows], np.int32)
        self.centres = np.array([r["centre"] for r in rows], np.float64)
        self.radii = np.array([r["radius"] for r in rows], np.float64)
        self.metric, self.top = metric, top


def build_tree(corpus: DataFrame, path, cells=None, metric="l2", cid="ebook_no", vector="embedding", seed=7) -> str:
    """Write the tree index of `corpus` at `path` (module notes); give back `path`."""
    spark = corpus.sparkSession
    c = materialise(corpus.select(F.col(cid).alias("cid"), F.col(vector).alias("cv")), "corpus").filter("cv IS NOT NULL")
    n = c.count()
    top = 0.0
    if metric == "dot" and n:
        square = F.aggregate("cv", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
        top = float(c.agg(F.sqrt(F.max(square))).first()[0])
    cells = max(1, min(n, cells or int(round(max(1, n) ** 0.5))))
    groups = max(1, int(round(cells**0.5)))
    types = {f.name: f.dataType.simpleString() for f in c.schema}
    if n == 0:
        return _write_empty(spark, path, metric, top, types)

    def moved(batches):
        for batch in batches:
            batch = D.with_vector(batch, "cv")
            if batch.num_rows:
                points = D.metric_space(D.matrix(batch.column(batch.schema.get_field_index("cv"))), metric, "corpus", top)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(list(points), pa.list_(pa.float64()))], ["cid", "cv", "p"]
                )

    space = c.select("cid", "cv").mapInArrow(moved, f"cid {types['cid']}, cv {types['cv']}, p array<double>")
    want = PER_CELL * cells
    drawn = F.pmod(F.xxhash64("cid", F.lit(seed)), F.lit(1 << 30))
    sample = materialise(space.filter(drawn < min(1.0, want / max(n, 1)) * (1 << 30)).select("cid", "p"), "sample")
    if sample.limit(1).count() == 0:
        sample = materialise(space.select("cid", "p").limit(max(cells, 1)), "sample")
    fit = sample.select(array_to_vector("p").alias("features"))
    found = sample.count()
    if groups == 1 or found <= groups:
        tops = np.array([np.array(sample.first()["p"])])
        groups = 1
    else:
        tops = np.array(KMeans(k=groups, seed=seed, maxIter=10).fit(fit).clusterCenters())
    shared = spark.sparkContext.broadcast(tops)

    def to_group(batches):
        for batch in batches:
            if batch.num_rows:
                points = D.matrix(batch.column(batch.schema.get_field_index("p")))
                at, _ = _nearest(points, shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], [*batch.schema.names, "group"])

    grouped = sample.mapInArrow(to_group, f"cid {types['cid']}, p array<double>, group int")
    grouped = materialise(grouped, "grouped")
    shares = grouped.groupBy("group").count().collect()  # one row per group: about the root of the cells
    total = sum(r["count"] for r in shares)
    quota = {r["group"]: max(1, int(round(cells * r["count"] / total))) for r in shares}
    first, offset = {}, 0
    for g in sorted(quota):
        first[g] = offset
        offset += quota[g]
    plan = spark.createDataFrame([(g, quota[g], first[g]) for g in sorted(quota)], "group int, quota int, first int")
    limit = F.col("quota") * PER_CELL
    ranked = grouped.join(F.broadcast(plan), "group").withColumn(
        "r", F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("cid", F.lit(seed + 1))))
    ).filter(F.col("r") <= limit)

    def fit_group(frame):
        import pandas as pd

        points = np.array(frame["p"].tolist(), np.float64)
        k, base = int(frame["quota"].iloc[0]), int(frame["first"].iloc[0])
        centres = _lloyd(points, k, seed + int(frame["group"].iloc[0]))
        return pd.DataFrame({
            "cell": np.arange(base, base + len(centres), dtype=np.int32), "group": int(frame["group"].iloc[0]),
            "centre": [list(map(float, x)) for x in centres],
        })

    centres = ranked.select("group", "quota", "first", "p").groupBy("group").applyInPandas(
        fit_group, "cell int, group int, centre array<double>"
    )
    centres = materialise(centres, "centres")
    packs = centres.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("cell", "centre"))).alias("pack"))

    def to_cell(rows, pack):
        cells_, centres_, _ = _unpacked(pack)
        points = D.matrix(rows.column("p"))
        cell, reach = np.zeros(len(points), np.int32), np.zeros(len(points))
        for s, d in _accurate(points, centres_):
            j = d.argmin(1)
            cell[s:s + len(d)], reach[s:s + len(d)] = cells_[j], d[np.arange(len(d)), j]
        return pa.table([rows.column("cid"), rows.column("cv"), pa.array(cell), pa.array(reach)], ["cid", "cv", "cell", "reach"])

    rows = space.mapInArrow(to_group, f"cid {types['cid']}, cv {types['cv']}, p array<double>, group int")
    placed = _with_pack(rows, packs, "cid", n, to_cell, f"cid {types['cid']}, cv {types['cv']}, cell int, reach double")
    placed.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    sizes = spark.read.parquet(f"{path}/vectors").groupBy("cell").agg(
        F.count(F.lit(1)).alias("size"), F.max("reach").alias("radius")
    )
    facts = centres.join(sizes, "cell").withColumn("metric", F.lit(metric)).withColumn("top", F.lit(top))
    facts = materialise(facts, "cells")
    facts.write.mode("overwrite").parquet(f"{path}/cells")
    gshared = spark.sparkContext.broadcast(tops)

    def group_reach(frame):
        import pandas as pd

        g = int(frame["group"].iloc[0])
        centres_ = np.array(frame["centre"].tolist(), np.float64)
        far = np.sqrt(((centres_ - gshared.value[g]) ** 2).sum(1)) + frame["radius"].to_numpy()
        return pd.DataFrame({"group": [g], "centre": [list(map(float, gshared.value[g]))], "radius": [float(far.max())]})

    reach = facts.select("group", "centre", "radius").groupBy("group").applyInPandas(
        group_reach, "group int, centre array<double>, radius double"
    )
    reach.withColumn("metric", F.lit(metric)).withColumn("top", F.lit(top)).coalesce(1).write.mode("overwrite").parquet(f"{path}/groups")
    return path


def _unpacked(pack):
    """Cell ids, centres and radii (if it has them) of the one pack in the table `pack`."""
    cells = pack.column("pack")[0].as_py()
    return (
        np.array([x["cell"] for x in cells], np.int32), np.array([x["centre"] for x in cells]),
        np.array([x.get("radius", 0.0) for x in cells]),
    )


def _accurate(points, centres):
    """(first row, distances of some rows of `points` to all centres), without the loss of differences of large squares."""
    step = max(1, (1 << 20) // max(1, centres.size))
    for s in range(0, len(points), step):
        yield s, np.sqrt(((points[s:s + step, None, :] - centres[None, :, :]) ** 2).sum(2))


def _with_pack(rows, packs, key, n, work, schema):
    """`work(rows, pack)` for the rows of each group with the pack of its cells, which travels once
    per part of a group: parts are of about CHUNK rows if all `n` rows go to one group."""
    parts = max(1, -(-n // CHUNK))
    left = rows.withColumn("__part", F.pmod(F.xxhash64(key), F.lit(parts)))
    asked = left.select("group", "__part").distinct()
    right = asked.join(packs, "group").select(F.col("group").alias("of"), F.col("__part").alias("part"), "pack")

    # Every group of rows has its pack and every pack some rows.
    return left.groupBy("group", "__part").cogroup(right.groupBy("of", "part")).applyInArrow(work, schema)


def _write_empty(spark, path, metric, top, types):
    spark.createDataFrame([], f"cid {types['cid']}, cv {types['cv']}, reach double, cell int").write.mode(
        "overwrite"
    ).parquet(f"{path}/vectors")
    spark.createDataFrame([], "cell int, group int, centre array<double>, size bigint, radius double, metric string, top double").write.mode(
        "overwrite"
    ).parquet(f"{path}/cells")
    spark.createDataFrame([(0, [], 0.0, metric, top)], "group int, centre array<double>, radius double, metric string, top double").write.mode(
        "overwrite"
    ).parquet(f"{path}/groups")
    return path


class _Sizes:
    """What `knn._meet` reads of an index: cell ids, sizes and the metric (no centres)."""

    def __init__(self, spark, path, metric):
        rows = spark.read.parquet(f"{path}/cells").select("cell", "size").collect()  # one row per cell: two numbers
        self.ids = np.array([r["cell"] for r in rows], np.int32)
        self.sizes = np.array([r["size"] for r in rows], np.int64)
        self.metric = metric


def _groups(spark, path):
    rows = spark.read.parquet(f"{path}/groups").collect()
    return _Groups([r for r in rows if len(r["centre"])], rows[0]["metric"], rows[0]["top"])


def _choose_cells(q, path, groups, pick_groups, pick_cells):
    """(qid, qv, cell) for the cells each query asks: groups by `pick_groups(distances)`,
    then, of those groups' cells, cells by `pick_cells(distances)`; few of each a query."""
    spark = q.sparkSession
    shared = spark.sparkContext.broadcast(groups)
    types = {f.name: f.dataType.simpleString() for f in q.schema}
    keep = ["qid", "qv"]

    def ask(batches):
        g = shared.value
        for batch in batches:
            batch = D.with_vector(batch, "qv")
            if batch.num_rows == 0 or len(g.ids) == 0:
                continue
            points = D.metric_space(D.matrix(batch.column(batch.schema.get_field_index("qv"))), g.metric, "query", g.top)
            i, j = np.nonzero(pick_groups(D.euclid(points, g.centres)))
            picked = batch.select(keep).take(pa.array(i))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(g.ids[j])], [*keep, "group"])

    asked = q.select(keep).mapInArrow(ask, ", ".join(f"{k} {types[k]}" for k in keep) + ", group int")
    cells = spark.read.parquet(f"{path}/cells")
    packs = cells.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("cell", "centre", "radius"))).alias("pack"))
    metric, top = groups.metric, groups.top

    def within(batch, pack):
        cells_, centres_, radii = _unpacked(pack)
        points = D.metric_space(D.matrix(batch.column("qv")), metric, "query", top)
        rows, picked = [np.zeros(0, int)], [np.zeros(0, np.int32)]
        for s, d in _accurate(points, centres_):
            i, j = np.nonzero(pick_cells(d))
            rows.append(i + s)
            picked.append(cells_[j])
        taken = batch.select(["qid", "qv"]).take(pa.array(np.concatenate(rows)))
        return pa.table([*taken.columns, pa.array(np.concatenate(picked))], ["qid", "qv", "cell"])

    return _with_pack(asked, packs, "qid", q.count(), within, f"qid {types['qid']}, qv {types['qv']}, cell int")


def _nothing(queries, path, qid, names):
    spark = queries.sparkSession
    cid = spark.read.parquet(f"{path}/vectors").schema["cid"].dataType.simpleString()
    q = queries.schema[qid].dataType.simpleString()
    a, b = names or (qid, "cid")
    return spark.createDataFrame([], f"{a} {q}, rank bigint, {b} {cid}, distance double")


def knn_tree_approx(queries: DataFrame, path, k=5, beam=2, probe=4, qid="qid", vector="embedding", names=None) -> DataFrame:
    """The k nearest rows among the `probe` nearest cells of the `beam` nearest groups of each query."""
    spark = queries.sparkSession
    groups = _groups(spark, path)
    if len(groups.ids) == 0:
        return _nothing(queries, path, qid, names)
    q = materialise(queries.select(F.col(qid).alias("qid"), F.col(vector).alias("qv")), "queries")

    def pick_groups(away):
        mask = np.zeros(away.shape, bool)
        np.put_along_axis(mask, np.argsort(away, axis=1, kind="stable")[:, :beam], True, axis=1)
        return mask

    def pick_cells(d):
        mask = np.zeros(d.shape, bool)
        np.put_along_axis(mask, np.argsort(d, axis=1, kind="stable")[:, :probe], True, axis=1)
        return mask

    # A query meets `beam` groups: the `probe` nearest cells of each; the nearest `probe` overall win.
    chosen = materialise(_choose_cells(q, path, groups, pick_groups, pick_cells), "chosen")
    facts = _Sizes(spark, path, groups.metric)
    vectors = spark.read.parquet(f"{path}/vectors").select("cid", "cv", "cell")
    return knn._rank(knn._meet(chosen, vectors, facts, k), k, *(names or (qid, "cid")))


def knn_tree(queries: DataFrame, path, k=5, qid="qid", vector="embedding", names=None) -> DataFrame:
    """The exact k nearest rows by way of the tree (module notes)."""
    spark = queries.sparkSession
    groups = _groups(spark, path)
    if len(groups.ids) == 0:
        return _nothing(queries, path, qid, names)
    facts = _Sizes(spark, path, groups.metric)
    vectors = spark.read.parquet(f"{path}/vectors").select("cid", "cv", "cell")
    q = materialise(queries.select(F.col(qid).alias("qid"), F.col(vector).alias("qv")), "queries")

    def nearest(away):
        mask = np.zeros(away.shape, bool)
        mask[np.arange(len(away)), away.argmin(1)] = True
        return mask

    home_cells = materialise(_choose_cells(q, path, groups, nearest, nearest), "home")
    home = materialise(knn._rank(knn._meet(home_cells, vectors, facts, k), k, "qid", "cid"), "home")
    bound = home.filter(F.col("rank") == k).select("qid", F.col("distance").alias("bound"))
    asked = materialise(home_cells.withColumnRenamed("cell", "home").join(bound, "qid", "left"), "bounds")
    # Largest squared length of an indexed point, for the rounding room: from the group radii.
    reach_all = max(((np.linalg.norm(c) + r) ** 2 for c, r in zip(groups.centres, groups.radii)), default=0.0)
    shared = spark.sparkContext.broadcast(groups)

    def ask(batches):
        g = shared.value
        for whole in batches:
            for batch in knn._slices(whole, len(g.ids)):
                vectors_ = D.matrix(batch.column(batch.schema.get_field_index("qv")))
                away = D.euclid(D.metric_space(vectors_, g.metric, "query", g.top), g.centres)
                reach = knn._reach(vectors_, knn._bounds(batch), g.metric, g.top, reach_all)
                i, j = np.nonzero(away - g.radii[None, :] <= reach[:, None])
                for s in range(0, len(i), knn.OUT):
                    picked = batch.take(pa.array(i[s:s + knn.OUT]))
                    yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(g.ids[j[s:s + knn.OUT]])], [*picked.schema.names, "bundle"])

    # A group is a bundle of cells: a query goes to a group once, and its cells are pruned there.
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    far = asked.mapInArrow(ask, f"{types}, bundle int")
    asks = dict(far.groupBy("bundle").count().collect())  # one row per group
    cells = spark.read.parquet(f"{path}/cells").select("cell", F.col("group").alias("bundle"), "size")
    sizes = dict(cells.groupBy("bundle").agg(F.sum("size")).collect())
    found = home.select("qid", "cid", "distance")
    if asks:
        bundled = vectors.join(cells.select("cell", "bundle"), "cell")
        rows = knn._tile_rows(sum(sizes.values()), groups.centres.shape[-1])
        found = found.unionByName(knn._tiles(far, asks, bundled, sizes, k, groups.metric, groups.top, rows))
    return knn._rank(found, k, *(names or (qid, "cid")))


def has_tree(spark, path) -> bool:
    return path_exists(spark, f"{path}/groups/_SUCCESS")
