"""SimHash fingerprints and near-duplicate groups by a forest of vantage-point trees.

A tree looks at one part of the bits. Each of its levels measures the Hamming distance between
a block of that part and the vantage point, and branches by that distance, so a leaf is a ring
of distances. Distances of blocks add up to that of the part, so by the triangle bound two
fingerprints within r bits lie in leaves whose distances differ by r at most in sum: every
branch outside is pruned. A fingerprint is at home in one leaf and visits only the leaves ahead
of it within that bound; one of any two neighbours visits the other. Of two fingerprints within
`radius` bits, one of `trees` parts differs by radius // trees bits at most, so few leaves are
visited. The result is exact at any depth; depth only sets how many rows meet in a leaf.
"""

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookbase.llm.common import components, small_batches, words_of
from bookbase.session import materialise, settle

#: Pairs compared at once inside a leaf, and rows of whole leaves taken at once.
CHUNK, ROWS = 250_000, 50_000

#: Rows of a leaf that are compared in one task; a larger leaf is cut into blocks of about so many.
BLOCK = 20_000

#: Vantage point of every tree, one 64-bit word for each word of the fingerprint (any value does).
VANTAGE = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def simhash(hashes):
    """Fingerprint words of the features' hashes (n rows of 8-byte words): bits set in over half of them."""
    n = len(hashes)
    if not n:
        return np.zeros(hashes.shape[1], np.uint64)
    octets = np.ascontiguousarray(hashes).view(np.uint8)
    counts = np.stack([np.bincount(octets[:, i], minlength=256) for i in range(octets.shape[1])]) @ _BITS
    return np.packbits(counts.ravel() * 2 > n, bitorder="little").view(np.uint64)


def shingle_fingerprint(text, size=3, seed=42):
    """64-bit SimHash of the word shingles of a text, repeats included; 0 for a text without words."""
    words = words_of(text)
    if len(words) < size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    return simhash(hashes[:, None])[0]


def fingerprints(docs: DataFrame, size=3, seed=42) -> DataFrame:
    """`docs` (doc_id, text) as doc_id, fp (bigint); a null text counts as empty."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_fingerprint(t, size, seed) for t in texts], dtype=np.uint64).astype(np.int64)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", of("text").alias("fp"))


def _offsets(levels, radius):
    """Steps between the rings of two leaves that the bound lets meet, one of each opposite pair."""
    for step in itertools.product(range(-radius, radius + 1), repeat=levels):
        if 0 < sum(map(abs, step)) <= radius and next(x for x in step if x) > 0:
            yield step


def leaves(points: DataFrame, words, parts, levels, radius) -> DataFrame:
    """Home and visits of each point: leaf, home, id, and its fingerprint words.

    `parts`: (word, first bit, bits) of each tree; `levels` blocks to a tree.
    """
    rows = []
    for tree, (word, first, bits) in enumerate(parts):
        width = bits // levels
        base = width + 1 + 2 * radius
        away = F.col(words[word]).bitwiseXOR(F.lit(np.int64(np.uint64(VANTAGE[word])).item()))
        rings = [
            F.bit_count(F.shiftrightunsigned(away, first + i * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")))
            for i in range(levels)
        ]
        home = F.lit(tree).cast("bigint")
        for ring in rings:
            home = home * base + ring + radius
        rows.append(F.struct(home.alias("leaf"), F.lit(True).alias("home")))
        for step in _offsets(levels, radius):
            shift = sum(s * base ** (levels - 1 - i) for i, s in enumerate(step))
            inside = F.lit(True)
            for ring, s in zip(rings, step):
                if s:
                    inside = inside & (ring + s).between(0, width)
            rows.append(F.when(inside, F.struct((home + shift).alias("leaf"), F.lit(False).alias("home"))))
    met = points.select("id", *words, F.explode(F.array_compact(F.array(*rows))).alias("at"))
    return met.select("at.leaf", "at.home", "id", *words)


def _dealt(met, words):
    """Rows of `leaves` with the pair of blocks (i, j) they are compared in and `home` for the block i.

    A leaf of BLOCK rows or fewer is one block. Homes of block i meet the homes and visits of block
    j there; if i is not j, pairs inside i are left to (i, i), and homes of two blocks meet once.
    """
    sizes = met.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).filter("blocks > 1")
    large = materialise(sizes.withColumnRenamed("leaf", "large"), "large")
    cut = met.join(F.broadcast(large), F.col("leaf") == F.col("large"), "left").withColumn("n", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("n"))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)

    def place(i, j, home):
        return F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"), F.lit(home).alias("home"))

    asks = F.transform(every, lambda j: place(own, j, True))
    asked = F.transform(F.filter(every, lambda i: ~F.col("home") | (i < own)), lambda i: place(i, own, False))
    at = F.explode(F.when(F.col("home"), F.concat(asks, asked)).otherwise(asked)).alias("at")
    placed = cut.select("leaf", "id", *words, at)
    return placed.select("leaf", "at.i", "at.j", "at.home", "id", *words)


def _spanning(a, b, distance):
    """Positions of the edges of a shortest spanning forest of the links."""
    parent, keep = {}, []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    order = np.argsort(distance, kind="stable")
    for i, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            keep.append(i)
    return np.array(keep, np.int64)


def links(points: DataFrame, words, parts, levels, radius, limit) -> DataFrame:
    """(a, b) ids of linked points, enough of them to join every group of points linked in a leaf.

    Links are pairs within `limit` bits over all words. A leaf gives the edges of its shortest
    spanning forest rather than all its pairs. A pair that meets in several trees counts in the first
    whose part differs by `radius` bits at most. Rows arrive sorted by leaf, homes first, and
    pairs are compared in chunks; a task holds two blocks of a leaf at a time.
    """

    span = (parts[0][2] // levels + 1 + 2 * radius) ** levels  # leaves of a tree

    def first_met(tree, i, j, prints):
        """Which pairs have this tree for the first whose part they differ in by `radius` at most."""
        met = np.full(len(i), len(parts))
        for t in reversed(range(len(parts))):
            word, start, width = parts[t]
            apart = (prints[word][i] ^ prints[word][j]) >> np.uint64(start) & np.uint64((1 << width) - 1)
            met[np.bitwise_count(apart) <= radius] = t
        return met == tree

    def search(keys, leaf, same_block, home, ids, prints):
        ends = np.searchsorted(keys, keys, side="right")
        first = np.arange(len(keys))
        visits = np.searchsorted(keys, keys) + np.bincount(keys, home).astype(np.int64)[keys]
        begin = np.where(same_block, first + 1, visits)
        counts = np.where(home, ends - begin, 0)
        total, at, found = np.cumsum(counts), 0, []
        while at < len(keys):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + CHUNK, side="right")))
            c = counts[at:to]
            i = np.repeat(first[at:to], c)
            if len(i):
                j = begin[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
                bits = sum(np.bitwise_count(p[i] ^ p[j]).astype(np.int64) for p in prints)
                near = np.flatnonzero(bits <= limit)
                near = near[first_met(leaf[i[near]] // span, i[near], j[near], prints)]
                found.append((ids[i[near]], ids[j[near]], bits[near]))
                if sum(len(f[0]) for f in found) > CHUNK:
                    found = [shrunk(found)]
            at = to
        return shrunk(found)

    def shrunk(found):
        a, b, d = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else ((), (), ())))
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not len(low):
            return low, high, d
        order = np.lexsort((high, low))
        low, high, d = low[order], high[order], d[order]
        new = np.r_[True, (np.diff(low) != 0) | (np.diff(high) != 0)]
        low, high, d = low[new], high[new], d[new]
        keep = _spanning(low, high, d)
        return low[keep], high[keep], d[keep]

    def run(batches):
        parts, rows, enough = [], 0, ROWS
        for pdf in itertools.chain(batches, [None]):
            if pdf is not None:
                parts.append(pdf)
                rows += len(pdf)
                if rows < enough:
                    continue
            if not rows:
                return
            ready, parts, rows = pd.concat(parts, ignore_index=True), [], 0
            place = ready[["leaf", "i", "j"]].to_numpy()
            keys = np.r_[0, np.cumsum((np.diff(place, axis=0) != 0).any(1))]
            if pdf is not None:  # the last pair of blocks may go on
                last = int(np.searchsorted(keys, keys[-1]))
                ready, rest = ready.iloc[:last], ready.iloc[last:]
                parts, rows, enough = [rest], len(rest), max(ROWS, 2 * len(rest))
                if not last:
                    continue
                keys, place = keys[:last], place[:last]
            a, b, _ = search(
                keys, place[:, 0], place[:, 1] == place[:, 2], ready["home"].to_numpy().astype(bool), ready["id"].to_numpy(),
                [ready[w].to_numpy().view(np.uint64) for w in words],
            )
            yield pd.DataFrame({"a": a, "b": b})

    met = _dealt(leaves(points, words, parts, levels, radius), words)
    dealt = met.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j", F.desc("home"))
    return dealt.mapInPandas(run, "a bigint, b bigint").distinct()


def depth(n):
    """Levels of a tree over 16 or 32 bits: enough that few strangers meet in a leaf of n points."""
    return 4 if n < 500_000 else 8 if n < 50_000_000 else 16


def near_groups(docs: DataFrame, size=3, seed=42, radius=2) -> DataFrame:
    """Groups of documents whose fingerprints chain together within `radius` bits.

    Takes doc_id (bigint) and text; gives doc_id, fp (bigint) and component_id, the smallest
    doc_id that can be reached. One row per row of `docs`. A null or empty text has fingerprint
    0 and is linked like any other; equal texts have one fingerprint and are one point. A null
    doc_id keeps its row and never names a group unless all its members' are null. Only doc_id
    and text are read, so other columns may have any name. An empty table gives no rows.
    """
    marked = materialise(fingerprints(docs.select("doc_id", "text"), size, seed), "fingerprints")
    points = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    trees = 2
    parts = [(0, 0, 32), (0, 32, 32)]
    found = links(
        points.select(F.col("fp").alias("id"), "fp"), ["fp"], parts, depth(points.count()), radius // trees, radius
    )
    roots = components(found)
    grouped = points.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = grouped.join(named, "root").select("fp", "component_id")
    all_points = points.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    # Written, so that Spark can split the rows of a fingerprint that very many texts share.
    return marked.join(materialise(all_points, "named"), "fp").select("doc_id", "fp", "component_id")


#: The commonest shingles of a sample go to every task, to be put last in the order of shingles, and
#: pivots that the members of a bucket meet in the first round; PIVOTS times as many in each later one.
COMMON, PIVOTS = 1 << 18, 16

#: Least number of classes of shingles of which a text tells whether it has an odd number; a text of
#: more shingles has the next power of two, as unlike texts would fill too few classes alike.
PARITY = 512


def shingle_set(text, size):
    """Sorted distinct 32-bit hashes of the word shingles of a text; of all its words if they are fewer."""
    words = words_of(text)
    if len(words) < size:
        shingles = {b" ".join(words)}
    else:
        shingles = set(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    return np.unique(np.fromiter(map(xxhash.xxh32_intdigest, shingles), np.uint32, len(shingles)))


def _same_shingles(pairs, similarity):
    def run(batches):
        for pdf in batches:
            keep = []
            for one, two in zip(pdf["one"], pdf["two"]):
                x, y = np.frombuffer(one, np.uint32), np.frombuffer(two, np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]

    return pairs.mapInPandas(run, "a bigint, b bigint")


def _tokens(text, size):
    """Sorted distinct 64-bit hashes of the shingles of a text, as in `shingle_set`."""
    words = words_of(text)
    if len(words) < size:
        shingles = {b" ".join(words)}
    else:
        shingles = set(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, len(shingles))).view(np.int64)


def _common(rows, size):
    """Shingles met often in a sixteenth of the texts or more, ascending, and how often.

    They only set the order of shingles, in which any choice gives the same groups.
    """
    share = max(64, min(1024, int(1024 * 20_000 / max(1, rows.count()))))

    def run(batches):
        for pdf in batches:
            token, n = np.unique(np.concatenate([_tokens(t, size) for t in pdf["text"]]), return_counts=True)
            yield pd.DataFrame({"token": token, "n": n})

    some = rows.filter(F.pmod("same", F.lit(1024)) < share).select("text")
    counted = some.mapInPandas(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).filter("n >= 4")
    counted = materialise(counted, "common")
    octave = F.floor(F.log2("n") * 8).cast("int")
    least, total = 1 << 20, 0
    for o, n in sorted(counted.groupBy(octave.alias("o")).count().collect(), reverse=True):  # a few hundred rows
        total += n
        if total > COMMON:
            break
        least = o
    found = counted.filter(octave >= least).toArrow().to_pandas().sort_values("token")  # COMMON rows at most
    return found["token"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _prefixes(rows, size, similarity):
    """doc_id, same, n (shingles), the first shingles of each row, rare ones before common ones, and `odd`:
    for each class of shingles whether their number is odd.

    Two sets of which one must hold `similarity` of the other share one of these: of n shingles
    only the last ceil(similarity * n) - 1 are left out.
    """
    sent = rows.sparkSession.sparkContext.broadcast(_common(rows, size))

    def run(batches):
        common, count = sent.value
        for pdf in batches:
            sizes, first, odd = [], [], []
            for text in pdf["text"]:
                tokens = _tokens(text, size)
                n = len(tokens)
                classes = max(PARITY, 1 << (n - 1).bit_length())
                odd.append(np.packbits(np.bincount(tokens & (classes - 1), minlength=classes) & 1).view(np.int64))
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    tokens = tokens[np.argsort(np.where(common[at] == tokens, count[at], 0), kind="stable")]
                sizes.append(n)
                first.append(tokens[: n - int(np.ceil(similarity * n - 1e-6)) + 1])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "same": pdf["same"], "n": np.array(sizes, np.int32), "tokens": first, "odd": odd})

    return rows.mapInPandas(run, "doc_id bigint, same bigint, n int, tokens array<bigint>, odd array<bigint>")


def _alike(rows, points, near, size, similarity):
    """The pairs (a, b) of `near` whose shingles agree in `similarity` or more."""
    least = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    ends = near.select("a").union(near.select("b")).distinct().withColumnRenamed("a", "same")
    wanted = ends.join(points, "same").select(F.col("same").alias("w_same"), "least")
    asked = rows.join(wanted, (F.col("same") == F.col("w_same")) & (least == F.col("least")))

    def sets(batches):
        for pdf in batches:
            yield pd.DataFrame({"same": pdf["same"], "shingles": [shingle_set(t, size).tobytes() for t in pdf["text"]]})

    known = materialise(asked.select("same", "text").mapInPandas(sets, "same bigint, shingles binary"), "shingles")
    known = known.dropDuplicates(["same"])
    left = near.join(known.select(F.col("same").alias("a"), F.col("shingles").alias("one")), "a")
    pairs = left.join(known.select(F.col("same").alias("b"), F.col("shingles").alias("two")), "b")
    return materialise(_same_shingles(pairs.select("a", "b", "one", "two"), similarity), "alike")


def forest_pairs(rows, size, seed=42, radius=2) -> DataFrame:
    """(a, b) of texts (`same`) enough to join all whose SimHash fingerprints chain together within `radius` bits.

    Texts of one fingerprint hang on the smallest of them; fingerprints meet in the leaves of the
    forest, as in `near_groups`.
    """
    texts = fingerprints(rows.select(F.col("same").alias("doc_id"), "text"), size, seed)
    texts = materialise(texts.select(F.col("doc_id").alias("same"), "fp").distinct(), "fingerprints")
    points = materialise(texts.groupBy("fp").agg(F.min("same").alias("first")), "points")
    found = links(
        points.select(F.col("fp").alias("id"), "fp"), ["fp"], [(0, 0, 32), (0, 32, 32)], depth(points.count()), radius // 2, radius
    )
    named = found.join(points.select(F.col("fp").alias("a"), F.col("first").alias("one")), "a")
    named = named.join(points.select(F.col("fp").alias("b"), F.col("first").alias("two")), "b").select("one", "two")
    hung = texts.join(points, "fp").filter("same <> first").select("first", "same")
    both = hung.union(named).toDF("one", "two")
    return both.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct()


def duplicate_texts(docs: DataFrame, size=5, similarity=0.8) -> DataFrame:
    """same (hash of a text), least (smallest doc_id of its rows), copies (rows with that doc_id), root.

    Texts with one root form a group: those that chain together by pairs whose shingles of `size`
    words have a Jaccard similarity of `similarity` or more. Pairs come from the forest of
    vantage-point trees over SimHash fingerprints (`forest_pairs`) first and are checked. An exact
    pass follows for what fingerprints miss: two such texts share one of their first shingles in an order that
    puts common ones last, and meet in its bucket. All members of a bucket are checked with
    its smallest one; then, round by round, members that are still in different groups are checked
    with ever more of the others, until none is left unchecked. Of these only pairs are made whose
    counts of shingles by class allow the similarity: each shingle that one of the two lacks
    changes one class from odd to even or back, at most. Classes grow with the text; texts within
    the similarity have equally many or twice as many, which are then added in pairs.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("same", F.xxhash64("text"))
    marked = materialise(_prefixes(rows, size, similarity), "prefixes")
    by_id = marked.groupBy("same", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    least = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    points = materialise(by_id.groupBy("same").agg(F.min(least).alias("least")), "points")
    odd = materialise(marked.groupBy("same").agg(F.first("odd").alias("odd")), "odd")

    posted = marked.select("same", "n", F.posexplode("tokens").alias("pos", "token"))
    shared = posted.groupBy("token").agg(F.min(F.struct("same", "n", "pos")).alias("low"), F.max("same").alias("high"))
    # Written tables on both sides of a join let Spark split a hot key of it.
    shared = materialise(shared.filter("low.same <> high").select("token", "low"), "shared")
    met = materialise(posted.join(shared.select("token"), "token").distinct(), "buckets")

    def may(n, pos, other_n, other_pos):
        """Whether enough shingles can agree if this is the first that both have."""
        return F.least(n - pos, other_n - other_pos) >= similarity / (1 + similarity) * (n + other_n) - 1e-6

    def paired(same, other):
        return F.least(same, other).alias("a"), F.greatest(same, other).alias("b")

    low = F.col("low")
    star = met.join(shared, "token").filter((F.col("same") != low["same"]) & may(F.col("n"), F.col("pos"), low["n"], low["pos"]))

    def folded(one, other):
        """`one`, or its two halves taken together where it has more classes than `other`."""
        n = F.size(other)
        halves = F.zip_with(F.slice(one, F.lit(1), n), F.slice(one, n + 1, n), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(one) > n, halves).otherwise(one)

    def apart(one, other):
        """The classes of shingles that are odd in one of the two texts alone."""
        one, other = F.col(one), F.col(other)
        bits = F.zip_with(folded(one, other), folded(other, one), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.aggregate(bits, F.lit(0), lambda acc, x: acc + x)

    seen = materialise(forest_pairs(rows, size), "candidates")
    near = star.select(*paired("same", low["same"])).distinct().join(seen, ["a", "b"], "left_anti")
    near = materialise(near, "candidates")
    asked, done = seen.union(near), 0
    linked = _alike(rows, points, asked, size, similarity)
    turn = F.pmod(F.xxhash64("token", "same"), F.lit(1 << 30)) / F.lit(1 << 30) * F.col("k")
    while True:
        roots = materialise(components(linked), "roots")
        held = met.select("token", "same", "n", "pos").join(roots, F.col("same") == F.col("node"), "left")
        held = materialise(held.select("token", "same", "n", "pos", F.coalesce("root", "same").alias("root")), "held")
        mixed = held.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("k"))
        mixed = materialise(mixed.filter((F.col("r0") != F.col("r1")) & (F.col("k") > done)).select("token", "k"), "mixed")
        if mixed.isEmpty():
            break
        met = materialise(held.join(mixed, "token").join(odd, "same"), "buckets")
        upto = PIVOTS * max(1, done)
        pivots = met.filter((turn >= done) & ((turn < upto) | (F.col("k") <= upto)))
        pivots = materialise(pivots.select("token", *[F.col(c).alias(f"p_{c}") for c in ("same", "n", "pos", "root", "odd")]), "pivots")
        few = apart("odd", "p_odd") <= (1 - similarity) / (1 + similarity) * (F.col("n") + F.col("p_n")) + 1e-6
        pairs = met.join(pivots, "token").filter(
            (F.col("root") != F.col("p_root")) & may(F.col("n"), F.col("pos"), F.col("p_n"), F.col("p_pos")) & few
        )
        near = materialise(pairs.select(*paired("same", "p_same")).distinct().join(asked, ["a", "b"], "left_anti"), "candidates")
        linked = linked.union(_alike(rows, points, near, size, similarity))
        asked, done = asked.union(near), upto

    grouped = points.join(roots.withColumnRenamed("node", "same"), "same", "left")
    copies = by_id.select(F.col("same").alias("c_same"), least.alias("c_least"), F.col("n").alias("copies"))
    return grouped.join(copies, (F.col("same") == F.col("c_same")) & (F.col("least") == F.col("c_least"))).select(
        "same", "least", "copies", F.coalesce("root", "same").alias("root")
    )


def drop_near_duplicates(docs: DataFrame, size=5, similarity=0.8) -> DataFrame:
    """`docs` with one row of each group of near duplicates: that of the smallest doc_id.

    Keeps all columns. A null text counts as empty; empty texts are copies of each other. Of rows that
    agree in doc_id and text one stays; a row without a doc_id stays only if its whole group
    has none. Ties between different texts of one doc_id go by a hash of the text.
    """
    first = F.min(F.struct("least", "same", "copies")).alias("first")
    # The tables of shingles and pairs are many times the size of what is kept of them.
    groups = lambda: duplicate_texts(docs, size, similarity).groupBy("root").agg(first).select("first.*")
    kept = settle(docs.sparkSession, groups, "kept")
    kept = kept.select(F.col("least").alias("__least"), F.col("same").alias("__same"), F.col("copies").alias("__copies"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("__id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"),
    )
    met = packed.join(kept, (F.col("__hash") == F.col("__same")) & (F.col("__id") == F.col("__least")))
    out = met.filter("__copies = 1")
    if not kept.filter("__copies > 1").isEmpty():
        out = out.union(met.filter("__copies > 1").dropDuplicates(["__hash", "__id"]))
    return out.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
