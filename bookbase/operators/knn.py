"""Nearest neighbours for tables of query vectors.

`knn` is exact. A query side of checked size is sent to every task and the corpus is read
once, unshuffled; a larger one goes through cells (`knn_cells`), which compare a query only
with cells that can still hold one of its neighbours. Both give the same rows. `knn_approx` looks
into the nearest cells alone. Every task gives at most k rows per query, never all pairs.

Ranks follow (distance rounded to six places, corpus id).
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookbase.operators import distance as D
from bookbase.operators.embed import DIM, densify
from bookbase.operators.joins import fits
from bookbase.session import materialise, path_exists, scratch_path

MAX_QUERIES = 20_000
MAX_BYTES = 64 << 20
BLOCK = 4096
MAX_CELLS = 4096
#: Least and most rows on each side of a tile of `_tiles`; about WANTED of them hold the whole corpus.
TILE, MAX_TILE, WANTED = 4096, 65_536, 16
#: Most numbers in the vectors of one side of a tile: what a task holds doesn't grow with their length.
MAX_NUMBERS = 1 << 22
#: Distances to centres that are worked out at once, and rows of asked vectors given out at once.
ASK, OUT = 1 << 20, 8192
#: Half of the last place that a rounded distance is given to, and the rounding of doubles as a
#: share of the squared lengths that a distance is made of.
HALF_PLACE, ROUNDING = 0.5 * 10.0**-D.PLACES, 1e-13


def _inputs(queries, corpus, qid, cid, vector, where):
    # Rows without a vector are dropped where vectors are read: a filter here would make Spark
    # work out a lazily made vector once to test it and once more to use it.
    if where is not None:
        corpus = corpus.filter(where)
    q = queries.select(F.col(qid).alias("qid"), F.col(vector).alias("qv"))
    return q, corpus.select(F.col(cid).alias("cid"), F.col(vector).alias("cv"))


def _schema(q, c):
    return f"qid {q.schema['qid'].dataType.simpleString()}, cid {c.schema['cid'].dataType.simpleString()}, distance double"


def _rank(found, k, qid, cid):
    window = Window.partitionBy("qid").orderBy("distance", "cid")
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("qid").alias(qid), F.col("rank").cast("bigint").alias("rank"), F.col("cid").alias(cid), "distance"
    )


def knn(
    queries: DataFrame, corpus: DataFrame, k=1, metric="l2", where=None,
    qid="qid", cid="ebook_no", vector="embedding", index=None,
) -> DataFrame:
    """The k nearest corpus rows of each query: (qid, rank, cid, distance), rank from 1.

    metric: `l2` (squared Euclidean), `cosine` (1 - cosine) or `dot` (1 - inner product).
    `where` filters the corpus before the search. Queries without a vector have no rows.
    `index`, a folder that `build_cells` (or a root of generations) wrote for this corpus and
    metric, is searched instead of the corpus whatever the number of queries. With `where`, only
    the index rows whose ids pass the filter take part; a cell's radius still bounds its remaining
    rows, so the search stays exact and widens to further cells until k rows that pass are found.
    Without an index, queries that fit go to every task, and for more cells are made for this call.
    """
    q, c = _inputs(queries, corpus, qid, cid, vector, where)
    if index is not None:
        made_for = _Cells(q.sparkSession, index).metric
        if made_for != metric:
            raise ValueError(f"the index is for {made_for}, not {metric}")
        allowed = c.select("cid") if where is not None else None
        return knn_cells(q, index, k, qid="qid", vector="qv", names=(qid, cid), allowed=allowed)
    if fits(q, MAX_QUERIES, MAX_BYTES, 8 * F.size("qv")):
        return _rank(_broadcast_knn(q, c, k, metric), k, qid, cid)
    index = build_cells(c, scratch_path(c.sparkSession, "cells"), metric=metric, cid="cid", vector="cv")
    return knn_cells(q, index, k, qid="qid", vector="qv", names=(qid, cid))


def _broadcast_knn(q, c, k, metric):
    """Exact search with the query vectors in every task; the corpus is never moved."""
    table = D.with_vector(q.toArrow(), "qv")
    shared = q.sparkSession.sparkContext.broadcast((D.matrix(table.column("qv")), table.column("qid").combine_chunks()))

    def search(batches):
        vectors, ids = shared.value
        numbers, best, held = pa.array(np.arange(len(ids))), D.Best(len(ids), k), None
        for batch in batches:
            batch = D.with_vector(batch, "cv")
            if batch.num_rows == 0 or len(ids) == 0:
                continue
            block = D.by_id(pa.Table.from_batches([batch]), "cid").combine_chunks()
            found = D.nearest_rows(
                vectors, numbers, D.matrix(block.column("cv")), block.column("cid").combine_chunks(), k, metric, best
            )
            held = D.first_of_each(found if held is None else pa.concat_tables([held, found]), k)
        if held is not None:
            named = held.set_column(0, "qid", ids.take(held.column("qid").combine_chunks()))
            yield from named.to_batches()

    return c.mapInArrow(search, _schema(q, c))


# --- cells -----------------------------------------------------------------------------------


def _centres(c, n, cells, metric, top, seed):
    """Cell centres from a bounded sample of the corpus, by k-means.

    The sample is drawn by a hash of the id, so a lazily made vector is made for it alone.
    """
    size = max(20 * cells, 1000)
    drawn = F.xxhash64(F.col("cid"), F.lit(seed))
    sample = c.filter(F.pmod(drawn, F.lit(max(1, n // (2 * size)))) == 0).orderBy(drawn).limit(size)

    def moved(batches):
        for batch in batches:
            batch = D.with_vector(batch, "cv")
            if batch.num_rows:
                points = D.metric_space(D.matrix(batch.column(0)), metric, "corpus", top)
                yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.float64()))], ["p"])

    points = sample.select("cv").mapInArrow(moved, "p array<double>").select(array_to_vector("p").alias("features"))
    if cells == 1:
        return np.array([points.first()["features"].toArray()])
    # The limit leaves the sample in one partition, where a single task would do every step of k-means.
    points = points.repartition(c.sparkSession.sparkContext.defaultParallelism)
    return np.array(KMeans(k=cells, seed=seed).fit(points).clusterCenters())


def build_cells(
    corpus: DataFrame, path, cells=None, metric="l2", cid="ebook_no", vector="embedding", seed=7, centres=None
) -> str:
    """Write the corpus split into cells around centres, and the cells themselves; give back `path`.

    `path/vectors` is partitioned by cell, so a search reads the cells it asks for.
    `path/cells` has one row per cell: centre, size and radius. A search cuts a cell of any size
    into blocks of about BLOCK rows, so a cell with a third of all rows is a third of all blocks.
    Without `cells` there are as many as the root of the number of vectors, up to MAX_CELLS, whose
    centres every task holds; asking for more is an error. A corpus without vectors has no cell.
    `centres`, a list of vectors, takes the place of those that k-means finds.
    """
    cells = len(centres) if centres is not None else cells
    if cells is not None and not 1 <= cells <= MAX_CELLS:
        raise ValueError(f"cells goes from 1 to {MAX_CELLS}")
    spark = corpus.sparkSession
    # Counted, sampled and assigned from a written table: a lazily made vector is made once.
    c = materialise(corpus.select(F.col(cid).alias("cid"), F.col(vector).alias("cv")), "corpus").filter("cv IS NOT NULL")
    n = c.count()
    if n == 0:
        c.select("cid", "cv", F.lit(0).alias("cell")).write.mode("overwrite").parquet(f"{path}/vectors")
        none = "cell int, centre array<double>, size bigint, radius double, metric string, top double"
        spark.createDataFrame([(0, [], 0, 0.0, metric, 0.0)], none).write.mode("overwrite").parquet(f"{path}/cells")
        return path
    cells = min(n, cells or int(max(1, min(MAX_CELLS, n**0.5))))
    top = 0.0
    if metric == "dot":
        square = F.aggregate("cv", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
        top = float(c.agg(F.sqrt(F.max(square))).first()[0])
    if centres is None:
        centres = _centres(c, n, cells, metric, top, seed)
    else:
        centres = D.metric_space(np.array(centres, np.float64), metric, "corpus", top)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for batch in (part for whole in batches for part in _slices(whole, len(shared.value))):
            batch = D.with_vector(batch, "cv")
            if batch.num_rows == 0:
                continue
            points = D.metric_space(D.matrix(batch.column(1)), metric, "corpus", top)
            away = D.euclid(points, shared.value)
            cell = away.argmin(1)
            reach = away[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(reach)], ["cid", "cv", "cell", "reach"]
            )

    types = {f.name: f.dataType.simpleString() for f in c.schema}
    assigned = c.mapInArrow(assign, f"cid {types['cid']}, cv {types['cv']}, cell int, reach double")
    # Rebalancing gathers the rows of small cells and splits a cell that is too large for a task.
    assigned.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(centres)]
    centre_rows = spark.createDataFrame(rows, "cell int, centre array<double>")
    sizes = spark.read.parquet(f"{path}/vectors").groupBy("cell").agg(
        F.count(F.lit(1)).alias("size"), F.max("reach").alias("radius")
    )
    facts = centre_rows.join(sizes, "cell").withColumn("metric", F.lit(metric)).withColumn("top", F.lit(top))
    facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return path


def resolve_index(spark, index):
    """`index` itself when it holds a cell table, else the newest complete generation under it."""
    if path_exists(spark, f"{index}/cells"):
        return index
    from bookbase.operators.generations import current

    newest = current(spark, index)
    if newest is None:
        raise FileNotFoundError(index)
    return newest


def index_vectors(spark, index) -> DataFrame:
    """(cid, cv, cell) of the live rows of an index: one folder of vectors, or the folders that its
    `parts` table lists (an index generation), read only for cells its cell table still has."""
    index = resolve_index(spark, index)
    if not path_exists(spark, f"{index}/parts"):
        return spark.read.parquet(f"{index}/vectors").select("cid", "cv", "cell")
    paths = [r["path"] for r in spark.read.parquet(f"{index}/parts").orderBy("path").collect()]
    live = spark.read.parquet(f"{index}/cells").filter("size > 0").select("cell")
    return read_parts(spark, paths).join(live, "cell", "left_semi")


def read_parts(spark, paths) -> DataFrame:
    """(cid, cv, cell) of folders partitioned by cell, one read each: Spark reads one partitioned root at a time."""
    reads = [spark.read.parquet(p).select("cid", "cv", "cell") for p in paths]
    out = reads[0]
    for more in reads[1:]:
        out = out.unionByName(more)
    return out


class _Cells:
    """The cell facts of an index; at most MAX_CELLS rows by construction."""

    def __init__(self, spark, path):
        path = resolve_index(spark, path)
        if not path_exists(spark, f"{path}/cells/_SUCCESS"):
            raise FileNotFoundError(path)
        rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
        self.metric, self.top = rows[0]["metric"], rows[0]["top"]
        rows = [r for r in rows if r["size"]]
        self.ids = np.array([r["cell"] for r in rows], np.int32)
        self.centres = np.array([r["centre"] for r in rows])
        self.sizes = np.array([r["size"] for r in rows], np.int64)
        self.radii = np.array([r["radius"] for r in rows])
        #: Greatest squared length of an indexed vector.
        self.reach = max(((np.linalg.norm(c) + r) ** 2 for c, r in zip(self.centres, self.radii)), default=0.0)


def _ask(q, shared, choose, columns):
    """One row per query and cell that `choose(distances to centres, batch, facts)` marks.

    A batch is taken in slices, so a task holds ASK distances and gives out OUT rows at a time,
    however many cells there are and however many of them are marked.
    """

    def run(batches):
        facts = shared.value
        for whole in batches:
            whole = D.with_vector(whole, "qv")
            if whole.num_rows == 0 or len(facts.ids) == 0:
                continue
            for batch in _slices(whole, len(facts.ids)):
                points = D.metric_space(D.matrix(batch.column(batch.schema.get_field_index("qv"))), facts.metric, "query", facts.top)
                away = D.euclid(points, facts.centres)
                i, j = np.nonzero(choose(away, batch, facts))
                for s in range(0, len(i), OUT):
                    picked = batch.select(["qid", "qv"]).take(pa.array(i[s : s + OUT]))
                    yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(facts.ids[j[s : s + OUT]])], ["qid", "qv", "cell"])

    types = {f.name: f.dataType.simpleString() for f in q.schema}
    return q.select(columns).mapInArrow(run, f"qid {types['qid']}, qv {types['qv']}, cell int")


def _slices(batch, centres):
    """`batch` in slices whose distances to so many centres are ASK at most."""
    step = max(1, ASK // max(1, centres))
    return (batch.slice(start, step) for start in range(0, batch.num_rows, step))


def _meet(asked, vectors, facts, k):
    """Compare asked cells with their vectors, block by block: at most k rows per query and block.

    A tile is (cell, block of vectors, block of queries). Vectors are copied once per block of
    queries of their cell and queries once per block of vectors, both of bounded size.
    """
    blocks = {int(i): int(-(-n // BLOCK)) for i, n in zip(facts.ids, facts.sizes)}
    # One row per cell, of which there are at most MAX_CELLS.
    load = asked.groupBy("cell").count().collect()
    rows = [(cell, blocks[cell], -(-n // BLOCK)) for cell, n in load]
    plan = F.broadcast(asked.sparkSession.createDataFrame(rows, "cell int, nblocks int, nasks int"))
    q_side = (
        asked.join(plan, "cell")
        .withColumn("ask", F.pmod(F.xxhash64("qid"), F.col("nasks")))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("nblocks") - 1)))
        .select("cell", F.col("block").cast("bigint").alias("block"), "ask", "qid", "qv")
    )
    c_side = (
        vectors.join(plan, "cell")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nblocks")))
        .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("nasks") - 1)))
        .select("cell", "block", F.col("ask").cast("bigint").alias("ask"), "cid", "cv")
    )
    metric = facts.metric

    def compare(q_table, c_table):
        if q_table.num_rows == 0 or c_table.num_rows == 0:
            empty = pa.table([q_table.column("qid").slice(0, 0), c_table.column("cid").slice(0, 0), pa.array([], pa.float64())], ["qid", "cid", "distance"])
            return empty
        c_table = D.by_id(c_table, "cid")
        return D.nearest_rows(
            D.matrix(q_table.column("qv")), q_table.column("qid").combine_chunks(),
            D.matrix(c_table.column("cv")), c_table.column("cid").combine_chunks(), k, metric,
        )

    tile = ["cell", "block", "ask"]
    return q_side.groupBy(*tile).cogroup(c_side.groupBy(*tile)).applyInArrow(compare, _schema(asked, vectors))


def _bounds(batch):
    """The `bound` of each row, infinite where there is none."""
    bounds = batch.column(batch.schema.get_field_index("bound")).to_numpy(zero_copy_only=False).astype(float)
    return np.where(np.isnan(bounds), np.inf, bounds)


def _reach(vectors, bounds, metric, top, square_length):
    """Euclidean reach in the metric space that a distance bound allows, with room for rounding.

    `square_length` is the greatest squared length of a point there.
    """
    if metric == "cosine":
        square = 2.0 * bounds
    elif metric == "dot":
        square = (vectors * vectors).sum(1) + top**2 - 2.0 * (1.0 - bounds)
    else:
        square = bounds
    points = D.metric_space(vectors, metric, "query", top)
    slack = ROUNDING * ((points * points).sum(1) + square_length)
    return np.sqrt(np.maximum(square, 0.0) + 4 * HALF_PLACE + slack) + 2 * np.sqrt(slack)


def _bundles(sizes, order, rows):
    """A number for each cell: cells that follow one another in `order` share it up to `rows` vectors."""
    bundle, at, held = np.zeros(len(sizes), np.int32), 0, 0
    for i in order:
        if held and held + sizes[i] > rows:
            at, held = at + 1, 0
        bundle[i], held = at, held + sizes[i]
    return bundle


def _tile_rows(n, dim):
    return int(max(1, min(MAX_TILE, max(TILE, n // WANTED), MAX_NUMBERS // max(1, dim))))


def _tiles(asked, asks, vectors, sizes, k, metric, top, rows):
    """At most k rows per query and tile, out of all cells but the query's `home`.

    `asked` has (qid, qv, home, bound, bundle), `asks` the number of its rows by bundle; `vectors`
    has (cid, cv, cell, bundle), `sizes` their number by bundle. A tile is (bundle, block of
    vectors, block of queries) of about `rows` rows on each side, so a vector is copied
    once per block of queries and a query once per bundle that it asks: never once per cell.
    Inside a tile a cell is compared with the queries whose bound it is within (triangle
    inequality with the mean and radius of its rows there), and the bound of a query falls with
    the rows found.
    """
    plan = [(int(b), -(-int(sizes[b]) // rows), -(-int(n) // rows)) for b, n in asks.items() if n and sizes.get(b)]
    plan = F.broadcast(asked.sparkSession.createDataFrame(plan, "bundle int, nblocks int, nasks int"))
    q_side = (
        asked.join(plan, "bundle")
        .withColumn("ask", F.pmod(F.xxhash64("qid"), F.col("nasks")))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("nblocks") - 1)))
        .select("bundle", F.col("block").cast("bigint").alias("block"), "ask", "qid", "qv", "home", "bound")
    )
    c_side = (
        vectors.join(plan, "bundle")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nblocks")))
        .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("nasks") - 1)))
        .select("bundle", "block", F.col("ask").cast("bigint").alias("ask"), "cid", "cv", "cell")
    )

    def compare(q_table, c_table):
        if q_table.num_rows and c_table.num_rows:
            c_table = D.by_id(c_table, "cid")
        qids, cids = q_table.column("qid").combine_chunks(), c_table.column("cid").combine_chunks()
        i, j, value = _within(q_table, c_table, k, metric, top) if len(qids) and len(cids) else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        return pa.table([qids.take(pa.array(i)), cids.take(pa.array(j)), pa.array(value)], ["qid", "cid", "distance"])

    tile = ["bundle", "block", "ask"]
    return q_side.groupBy(*tile).cogroup(c_side.groupBy(*tile)).applyInArrow(compare, _schema(asked, vectors))


def _within(q_table, c_table, k, metric, top):
    """Row numbers and distances of the k nearest rows of `c_table` for each row of `q_table`."""
    corpus, cell = D.matrix(c_table.column("cv")), c_table.column("cell").to_numpy()
    order = np.argsort(cell, kind="stable")  # id order inside a cell
    cells = []
    for at in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        points = D.metric_space(corpus[at], metric, "corpus", top)
        mean = points.mean(0)
        square = (points * points).sum(1).max()
        away = np.sqrt(((points - mean) ** 2).sum(1).max())
        cells.append((cell[at[0]], at, mean, away, square))
    out = []
    for start in range(0, q_table.num_rows, BLOCK):
        part = q_table.slice(start, BLOCK)
        q, home, limit = D.matrix(part.column("qv")), part.column("home").to_numpy(), _bounds(part)
        points = D.metric_space(q, metric, "query", top)
        away = D.euclid(points, np.array([c[2] for c in cells]))
        found, waiting = (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), []
        for n, (number, at, _, radius, square) in enumerate(cells):
            near = _reach(q, limit, metric, top, square)
            ask = np.flatnonzero((away[:, n] - radius <= near) & (home != number))
            if not len(ask):
                continue
            i, j, value = D.nearest_within(q[ask], corpus[at], k, metric, limit[ask])
            waiting.append((ask[i], at[j], value))
            if sum(len(w[0]) for w in waiting) > k * len(q) // 8:  # the sooner bounds fall, the fewer pairs are near
                found, waiting = D.k_of_each([found, *waiting], k, limit), []
        i, j, value = D.k_of_each([found, *waiting], k, limit)
        out.append((i + start, j, value))
    return tuple(np.concatenate(x) for x in zip(*out))


def _probe(width):
    def choose(away, batch, facts):
        near = np.argsort(away, axis=1, kind="stable")[:, :width]
        mask = np.zeros(away.shape, bool)
        np.put_along_axis(mask, near, True, axis=1)
        return mask

    return choose


def knn_approx(
    queries: DataFrame, index, k=5, probe=2, qid="qid", vector="embedding", names=None
) -> DataFrame:
    """The k nearest rows among the `probe` nearest cells of each query; more cells, higher recall."""
    spark = queries.sparkSession
    index = resolve_index(spark, index)
    facts = _Cells(spark, index)
    q = queries.select(F.col(qid).alias("qid"), F.col(vector).alias("qv"))
    asked = materialise(_ask(q, spark.sparkContext.broadcast(facts), _probe(probe), ["qid", "qv"]), "asked")
    found = _meet(asked, index_vectors(spark, index), facts, k)
    return _rank(found, k, *(names or (qid, "cid")))


def knn_cells(
    queries: DataFrame, index, k=5, qid="qid", vector="embedding", names=None, allowed=None
) -> DataFrame:
    """The exact k nearest rows by way of cells.

    First each query is answered inside its nearest cell; its k-th distance there bounds the
    true one from above. By the triangle inequality a cell can only help when the distance to
    its centre, less its radius, is within the bound: just those cells are asked next. With
    `allowed` (a table of `cid`), only those rows of the index count; a query whose nearest cell
    holds fewer than k of them has no bound and asks every cell.
    """
    spark = queries.sparkSession
    index = resolve_index(spark, index)
    facts = _Cells(spark, index)
    shared = spark.sparkContext.broadcast(facts)
    vectors = index_vectors(spark, index)
    if allowed is not None:
        vectors = vectors.join(allowed.select("cid").distinct(), "cid", "left_semi")
    q = queries.select(F.col(qid).alias("qid"), F.col(vector).alias("qv"))
    q = materialise(q, "queries")
    asked = materialise(_ask(q, shared, _probe(1), ["qid", "qv"]), "asked")
    home = _rank(_meet(asked, vectors, facts, k), k, "qid", "cid")
    home = materialise(home, "home")
    bound = home.filter(F.col("rank") == k).select("qid", F.col("distance").alias("bound"))
    asked = materialise(asked.withColumnRenamed("cell", "home").join(bound, "qid", "left"), "bounds")

    # Cells that lie beside one another along the direction in which centres differ most share a bundle.
    rows = _tile_rows(int(facts.sizes.sum()), facts.centres.shape[-1])
    spread = facts.centres - facts.centres.mean(0) if len(facts.ids) else np.zeros((0, 1))
    order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable") if len(spread) else []
    bundles = spark.sparkContext.broadcast(_bundles(facts.sizes, order, rows))

    def reached(batches):
        facts, bundle = shared.value, bundles.value
        for whole in batches:
            for batch in _slices(whole, len(facts.ids)):
                vectors = D.matrix(batch.column(batch.schema.get_field_index("qv")))
                away = D.euclid(D.metric_space(vectors, facts.metric, "query", facts.top), facts.centres)
                near = _reach(vectors, _bounds(batch), facts.metric, facts.top, facts.reach)
                mask = away - facts.radii[None, :] <= near[:, None]
                mask &= facts.ids[None, :] != batch.column(batch.schema.get_field_index("home")).to_numpy()[:, None]
                hit = np.zeros((len(mask), int(bundle.max()) + 1), bool)
                i, j = np.nonzero(mask)
                hit[i, bundle[j]] = True
                yield batch, hit

    def count(batches):
        for _, hit in reached(batches):
            n = hit.sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n).astype(np.int32)), pa.array(n[n > 0])], ["bundle", "n"])

    def ask(batches):
        for batch, hit in reached(batches):
            i, j = np.nonzero(hit)
            for s in range(0, len(i), OUT):
                picked = batch.take(pa.array(i[s : s + OUT]))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(j[s : s + OUT].astype(np.int32))], [*picked.schema.names, "bundle"])

    found = home.select("qid", "cid", "distance")
    if len(facts.ids):
        # One row per bundle.
        asks = dict(asked.mapInArrow(count, "bundle int, n bigint").groupBy("bundle").agg(F.sum("n")).collect())
        sizes = dict(enumerate(np.bincount(bundles.value, facts.sizes).astype(int).tolist()))
        if asks:
            types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
            table = spark.createDataFrame(list(zip(facts.ids.tolist(), bundles.value.tolist())), "cell int, bundle int")
            bundled = vectors.join(F.broadcast(table), "cell").select("cid", "cv", "cell", "bundle")
            far = asked.mapInArrow(ask, f"{types}, bundle int")
            found = found.unionByName(_tiles(far, asks, bundled, sizes, k, facts.metric, facts.top, rows))
    return _rank(found, k, *(names or (qid, "cid")))


def rank_all(query: DataFrame, corpus: DataFrame, metric="l2", cid="ebook_no", vector="embedding") -> DataFrame:
    """Every corpus row by its distance to one query vector: (cid, distance), nearest first.

    `query` has exactly one row. The vector becomes a constant of the plan; the order is a
    range partitioning, so no task holds the whole store.
    """
    rows = query.select(vector).limit(2).collect()
    if len(rows) != 1 or rows[0][0] is None:
        raise ValueError("rank_all takes exactly one query vector")
    q = F.array(*[F.lit(float(x)) for x in rows[0][0]])
    return (
        corpus.filter(F.col(vector).isNotNull())
        .select(cid, F.round(vector_distance(F.col(vector), q, metric), D.PLACES).alias("distance"))
        .orderBy("distance", cid)
    )


def vector_distance(a, b, metric="l2"):
    """Distance of two array columns as a Column."""
    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    if metric == "l2":
        return total(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))))
    if metric == "dot":
        return 1.0 - dot
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    norms = norm(a) * norm(b)
    return 1.0 - F.when(norms > 0, dot / norms).otherwise(0.0)


def knn_sparse(queries, corpus, k=1, dim=None, qid="qid", cid="ebook_no", where=None) -> DataFrame:
    """The k nearest by cosine for sparse rows (id, bucket, weight) on both sides.

    A join on the bucket would emit every pair that shares one; the rows of each vector are
    packed into a vector of `dim` numbers instead, and these are compared in blocks.
    """
    dim = dim or DIM
    return knn(densify(queries, qid, dim), densify(corpus, cid, dim), k, "cosine", where, qid, cid)
