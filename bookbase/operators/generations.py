"""Index generations: a cell index that grows with its vector table.

Under a root folder, each generation is a folder `gen-NNNNNN` with
  cells   one row per live cell: cell, centre, size, radius, metric, top (as `knn.build_cells` writes);
  parts   one row per folder of indexed vectors (path); each folder is partitioned by cell;
  covers  one row: the number of store rows the generation indexes and a checksum of their ids.
A generation is written beside its place and renamed into it whole, so a reader sees the newest
complete one or an older one, never a part. Appending writes only the new rows, assigned to the
nearest existing centre, into a new folder; sizes and radii are updated, so the triangle bounds
of `knn.knn_cells` stay exact. A cell that has grown past `SPLIT` times the size a cell of the
whole index should have (the root of the number of rows) is split in two by k-means over its
rows: its rows are written again under two new cell ids and the old id leaves the cell table, so
its rows in older folders are never read again.

A generation path can be given wherever `knn` takes an index.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.operators import distance as D
from bookbase.operators import knn
from bookbase.session import has_data, materialise, path_exists

#: A cell is split when it holds more than this many times the root of the number of rows.
SPLIT = 4.0
#: Rows of a cell that the two new centres of a split are fitted on (drawn by a hash of the id).
SPLIT_SAMPLE = 20_000


def _fs(spark, path):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def generations(spark, root) -> list[str]:
    """Complete generation folders under `root`, oldest first."""
    jpath, fs = _fs(spark, root)
    if not fs.exists(jpath):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.getPath().getName().startswith("gen-"))
    return [f"{root.rstrip('/')}/{n}" for n in names if path_exists(spark, f"{root.rstrip('/')}/{n}/covers/_SUCCESS")]


def current(spark, root) -> str | None:
    """The newest complete generation, or None."""
    made = generations(spark, root)
    return made[-1] if made else None


def _publish(spark, side, number, root):
    target = f"{root.rstrip('/')}/gen-{number:06d}"
    (jside, fs), (jtarget, _) = _fs(spark, side), _fs(spark, target)
    if fs.exists(jtarget) or not fs.rename(jside, jtarget):
        raise FileExistsError(f"{target} was made meanwhile; this generation is at {side}")
    return target


def _covers(ids: DataFrame) -> DataFrame:
    return ids.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64("cid").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"),
    )


def vectors(spark, generation) -> DataFrame:
    """(cid, cv, cell) of every live row of a generation."""
    return knn.index_vectors(spark, generation)


def create(corpus: DataFrame, root, metric="l2", cells=None, cid="ebook_no", vector="embedding") -> str:
    """Build generation 0 (or the next number, if older ones are there) from the whole `corpus`."""
    spark = corpus.sparkSession
    part = f"{root.rstrip('/')}/part-{uuid.uuid4().hex}"
    knn.build_cells(corpus, part, cells=cells, metric=metric, cid=cid, vector=vector)
    side = f"{root.rstrip('/')}/building-{uuid.uuid4().hex}"
    spark.read.parquet(f"{part}/cells").write.parquet(f"{side}/cells")
    spark.createDataFrame([(f"{part}/vectors",)], "path string").coalesce(1).write.parquet(f"{side}/parts")
    _covers(spark.read.parquet(f"{part}/vectors").select("cid")).coalesce(1).write.parquet(f"{side}/covers")
    return _publish(spark, side, _next(spark, root), root)


def _next(spark, root):
    made = generations(spark, root)
    return int(made[-1].rsplit("-", 1)[1]) + 1 if made else 0


def _assign(rows: DataFrame, facts) -> DataFrame:
    """(cid, cv, cell, reach): each row at its nearest live centre."""
    shared = rows.sparkSession.sparkContext.broadcast(facts)

    def run(batches):
        f = shared.value
        for batch in batches:
            batch = D.with_vector(batch, "cv")
            if batch.num_rows == 0:
                continue
            points = D.metric_space(D.matrix(batch.column(1)), f.metric, "corpus", f.top)
            away = D.euclid(points, f.centres)
            at = away.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(f.ids[at].astype(np.int32)), pa.array(away[np.arange(len(at)), at])],
                ["cid", "cv", "cell", "reach"],
            )

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("cid", "cv").mapInArrow(run, f"cid {types['cid']}, cv {types['cv']}, cell int, reach double")


def append(rows: DataFrame, root, cid="ebook_no", vector="embedding") -> str:
    """Index `rows` (not yet indexed) in a new generation; give back its path.

    Rows without a vector are left out. The new generation covers the old rows and these; a cell
    that grows past SPLIT times the root of all rows is split (module notes).
    """
    spark = rows.sparkSession
    base = current(spark, root)
    if base is None:
        return create(rows, root, cid=cid, vector=vector)
    facts = knn._Cells(spark, base)
    if facts.metric == "dot":
        raise ValueError("a `dot` index keeps the largest length of its vectors; build it anew")
    fresh = rows.select(F.col(cid).alias("cid"), F.col(vector).alias("cv")).filter("cv IS NOT NULL")
    part = f"{root.rstrip('/')}/part-{uuid.uuid4().hex}"
    assigned = materialise(_assign(fresh, facts), "assigned")
    assigned.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(part)
    cells = spark.read.parquet(f"{base}/cells")
    grown = spark.read.parquet(part).groupBy("cell").agg(F.count(F.lit(1)).alias("more"), F.max("reach").alias("far"))
    cells = cells.join(grown, "cell", "left").select(
        "cell", "centre", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
        F.greatest("radius", F.coalesce("far", F.lit(0.0))).alias("radius"), "metric", "top",
    )
    cells = materialise(cells, "cells")
    parts = [r["path"] for r in spark.read.parquet(f"{base}/parts").collect()] + [part]
    cells, parts = _split_overfull(spark, cells, parts, facts.metric, facts.top, root)
    side = f"{root.rstrip('/')}/building-{uuid.uuid4().hex}"
    cells.coalesce(1).write.parquet(f"{side}/cells")
    spark.createDataFrame([(p,) for p in parts], "path string").coalesce(1).write.parquet(f"{side}/parts")
    live = knn.index_vectors(spark, side)
    _covers(live.select("cid")).coalesce(1).write.parquet(f"{side}/covers")
    return _publish(spark, side, _next(spark, root), root)


def _split_overfull(spark, cells, parts, metric, top, root):
    """Split every cell above SPLIT times the root of the number of rows in two, all in one pass.

    The new centres of a cell come from at most SPLIT_SAMPLE of its rows, drawn by a hash of the
    id after thinning by the cell's size, so no task sorts more than a few times that; every row
    of the cell is then written again at the nearer of the two.
    """
    total = cells.agg(F.sum("size")).first()[0] or 0
    limit = SPLIT * max(1.0, total**0.5)
    over = cells.filter(F.col("size") > limit).select("cell", "size")
    if not over.limit(1).count():
        return cells, parts
    # Fewer than total / limit cells are over the limit; they are numbered in one small task.
    first = cells.agg(F.max("cell")).first()[0] + 1
    over = materialise(over.withColumn("nth", F.row_number().over(Window.orderBy("cell")) - 1), "over")
    every = knn.read_parts(spark, parts)
    members = every.join(over, "cell")
    share = F.pmod(F.xxhash64("cid", F.lit(11)), F.lit(1 << 30))
    thin = members.filter(share < F.least(F.lit(1.0), 4.0 * SPLIT_SAMPLE / F.col("size")) * (1 << 30))
    drawn = thin.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy(share, "cid")))
    sample = drawn.filter(F.col("r") <= SPLIT_SAMPLE).select("cell", "nth", "cv")

    def halves(frame):
        import pandas as pd

        points = D.metric_space(np.array(frame["cv"].tolist(), np.float64), metric, "corpus", top)
        centres = _two_means(points)
        base = first + 2 * int(frame["nth"].iloc[0])
        return pd.DataFrame({
            "cell": [int(frame["cell"].iloc[0])] * 2, "new": [base, base + 1],
            "centre": [list(map(float, c)) for c in centres],
        })

    centres = sample.groupBy("cell").applyInPandas(halves, "cell int, new int, centre array<double>")
    centres = materialise(centres, "halves")
    pairs = centres.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("new", "centre"))).alias("two"))

    def nearer(batches):
        for batch in batches:
            batch = D.with_vector(batch, "cv")
            if batch.num_rows == 0:
                continue
            two = batch.column(3).to_pylist()
            points = D.metric_space(D.matrix(batch.column(1)), metric, "corpus", top)
            a = np.array([t[0]["centre"] for t in two], np.float64)
            b = np.array([t[1]["centre"] for t in two], np.float64)
            da, db = np.sqrt(((points - a) ** 2).sum(1)), np.sqrt(((points - b) ** 2).sum(1))
            pick = db < da
            cell = np.where(pick, [t[1]["new"] for t in two], [t[0]["new"] for t in two]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell), pa.array(np.where(pick, db, da))], ["cid", "cv", "cell", "reach"]
            )

    types = {f.name: f.dataType.simpleString() for f in every.schema}
    moved = every.join(pairs, "cell").select("cid", "cv", "cell", "two").mapInArrow(
        nearer, f"cid {types['cid']}, cv {types['cv']}, cell int, reach double"
    )
    part = f"{root.rstrip('/')}/part-{uuid.uuid4().hex}"
    moved.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(part)
    made = spark.read.parquet(part).groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("reach").alias("radius"))
    new = centres.select(F.col("new").alias("cell"), "centre").join(made, "cell").select(
        "cell", "centre", "size", "radius", F.lit(metric).alias("metric"), F.lit(float(top)).alias("top")
    )
    kept = cells.join(over.select("cell"), "cell", "left_anti")
    return materialise(kept.unionByName(new), "cells"), parts + [part]


def _two_means(points, rounds=20):
    """Two centres of `points` by Lloyd's rounds from the two points farthest apart along the spread."""
    if len(points) < 2:
        return np.vstack([points, points])[:2]
    spread = points - points.mean(0)
    axis = np.linalg.svd(spread, full_matrices=False)[2][0]
    along = spread @ axis
    centres = np.vstack([points[along.argmin()], points[along.argmax()]])
    for _ in range(rounds):
        side = D.euclid(points, centres).argmin(1)
        moved = np.vstack([points[side == s].mean(0) if (side == s).any() else centres[s] for s in (0, 1)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def sync(store: DataFrame, root, metric="l2", cid="ebook_no", vector="embedding") -> str:
    """The generation that indexes exactly the rows of `store` with a vector.

    Rows of the store that the newest generation lacks are appended; if it holds ids the store
    no longer has (a store built anew), a new generation is built from the whole store.
    """
    spark = store.sparkSession
    rows = store.select(F.col(cid).alias("cid"), F.col(vector).alias("cv")).filter("cv IS NOT NULL")
    base = current(spark, root)
    if base is None:
        return create(rows, root, metric, cid="cid", vector="cv")
    indexed = knn.index_vectors(spark, base).select("cid")
    gone = indexed.join(rows.select("cid"), "cid", "left_anti")
    if gone.limit(1).count():
        return create(rows, root, metric, cid="cid", vector="cv")
    fresh = rows.join(indexed, "cid", "left_anti")
    if not fresh.limit(1).count():
        return base
    return append(fresh, root, cid="cid", vector="cv")


def append_indexed(df: DataFrame, store_path, root, key="book_key", cid="ebook_no", vector="embedding"):
    """Append new rows to the vector table at `store_path` and to its index; give back (store, generation)."""
    from bookbase.sources.vectors import append_vectors

    store = append_vectors(df, store_path, key)
    return store, sync(store, root, cid=cid, vector=vector)


def has_index(spark, root) -> bool:
    return current(spark, root) is not None and has_data(spark, root)
