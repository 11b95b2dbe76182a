"""Blocks of vectors compared inside one task; Spark decides which blocks meet."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PLACES = 6
_CELLS_AT_ONCE = 1_000_000


def matrix(column) -> np.ndarray:
    """A list column without nulls as a two-dimensional array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def with_vector(rows, name):
    """The rows of a batch or table whose list column `name` is not null."""
    column = rows.column(rows.schema.get_field_index(name))
    return rows.filter(pc.is_valid(column)) if column.null_count else rows


def distances(q, c, metric):
    """Distances of every row of `q` to every row of `c`, rounded to PLACES."""
    return rounded(plain_distances(q, c, metric))


def rounded(d):
    return np.round(d, PLACES) + 0.0


def plain_distances(q, c, metric):
    """Distances of every row of `q` to every row of `c`."""
    dots = q @ c.T
    if metric == "l2":
        a, b = (q * q).sum(1), (c * c).sum(1)
        if a.max(initial=0.0) + b.max(initial=0.0) < 1e6:
            d = np.maximum(a[:, None] + b[None, :] - 2.0 * dots, 0.0)
        else:  # the difference of large numbers would lose the places that are given
            d = np.zeros(dots.shape)
            for x, y in zip(q.T, c.T):
                d += (x[:, None] - y[None, :]) ** 2
    elif metric == "dot":
        d = 1.0 - dots
    else:
        norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)[None, :]
        d = 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
    return d


def smallest(d, k, limit=None):
    """Rows and columns of the k smallest entries of each row; earlier columns win ties.

    Entries above `limit` (one number per row) are left out.
    """
    if d.shape[1] > k:
        kth = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
        keep = d < kth
        ties = d == kth
        room = k - keep.sum(1, keepdims=True)
        keep |= ties & (np.cumsum(ties, axis=1) <= room)
    else:
        keep = np.ones(d.shape, bool)
    if limit is not None:
        keep &= d <= limit[:, None]
    return np.nonzero(keep)


def by_id(table, name):
    """`table` sorted by the column `name`, so that column order is id order."""
    return table.take(pc.sort_indices(table.column(name)))


class Best:
    """The k smallest distances met so far for each query of a task."""

    def __init__(self, n, k):
        self.values = np.full((n, k), np.inf)

    @property
    def limit(self):
        return self.values[:, -1]

    def add(self, rows, d):
        """Take in the new block `d` for the queries in the slice `rows`."""
        k = self.values.shape[1]
        both = np.concatenate([self.values[rows], d], axis=1)
        self.values[rows] = np.sort(np.partition(both, k - 1, axis=1)[:, :k], axis=1)


def first_of_each(found, k):
    """The k first rows of each `qid` by distance, then id."""
    ordered = found.sort_by([("qid", "ascending"), ("distance", "ascending"), ("cid", "ascending")])
    numbers = ordered.column("qid").to_numpy()
    place = np.arange(len(numbers)) - np.searchsorted(numbers, numbers)
    return ordered.filter(pa.array(place < k)).combine_chunks()


def nearest_rows(q, qids, c, cids, k, metric, best=None):
    """Candidate rows (query, corpus id, distance): at most k per query, id order inside ties."""
    step = max(1, _CELLS_AT_ONCE // max(1, len(c)))
    picked = []
    for start in range(0, len(q), step):
        rows = slice(start, min(start + step, len(q)))
        d = distances(q[rows], c, metric)
        i, j = smallest(d, k, None if best is None else best.limit[rows])
        if best is not None:
            best.add(rows, d)
        picked.append((i + start, j, d[i, j]))
    i, j, value = (np.concatenate(x) for x in zip(*picked))
    return pa.table([qids.take(pa.array(i)), cids.take(pa.array(j)), pa.array(value)], ["qid", "cid", "distance"])


def nearest_within(q, c, k, metric, limit):
    """Rows, columns and distances of pairs within `limit` (one number per row), the k nearest of a row among them.

    Single precision tells which rows can have a pair near the limit, with room for its rounding;
    only such pairs are worked out in full. A block with many of them is cut to k a row.
    """
    step = max(1, _CELLS_AT_ONCE // max(1, len(c)))
    screen = _screen(q, c, metric, limit + 10.0**-PLACES)
    picked = []
    for start in range(0, len(q), step):
        at = slice(start, start + step)
        near = limit[at]
        found = _near_pairs(*(x[at] for x in screen[:3]), screen[3], k) if screen else None
        if found is not None:
            i, j = found
            value = rounded(_pair_distances(q[at][i], c[j], metric))
            keep = value <= near[i]
            i, j, value = i[keep], j[keep], value[keep]
        else:
            d = plain_distances(q[at], c, metric)
            i, j = np.nonzero(d <= (near + 10.0**-PLACES)[:, None])
            if len(i) > 4 * k * len(d):
                d = rounded(d)
                i, j = smallest(d, k, near)
                value = d[i, j]
            else:
                value = rounded(d[i, j])
                keep = value <= near[i]
                i, j, value = i[keep], j[keep], value[keep]
        picked.append((i + start, j, value))
    return tuple(np.concatenate(x) for x in zip(*picked))


def _unit(vectors):
    norms = np.linalg.norm(vectors, axis=1)[:, None]
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _screen(q, c, metric, limit):
    """(queries, least scores, room, corpus) in single precision, or None where that would not do.

    The score of a pair is the product of its rows. Every pair within `limit` reaches the least score
    of its query, and one as near as another, up to the last place given, its score less `room`,
    whatever the rounding.
    """
    if len(q) == 0 or len(c) == 0:
        return None
    if metric == "cosine":
        q, c = _unit(q), _unit(c)
    a, b = (q * q).sum(1), (c * c).sum(1)
    if not a.max() + b.max() < 1e6:  # large or not finite
        return None
    if metric == "l2":
        least = (a - limit) / 2
        q, c = np.column_stack([q, np.ones(len(q))]), np.column_stack([c, -b / 2])
    else:
        least = 1.0 - limit
    top = np.sqrt(b.max())
    error = (q.shape[1] + 8) * 2.0**-22 * (np.sqrt(a) * top + top * top + np.where(np.isfinite(least), np.abs(least), 0.0))
    single = lambda x, to: np.nextafter(x.astype(np.float32), np.float32(to))
    return q.astype(np.float32), single(least - error, -np.inf), single(2 * error + 10.0**-PLACES, np.inf), c.astype(np.float32)


def _near_pairs(q, least, room, c, k):
    """Rows and columns of the pairs that reach the least score of their row; None if they are very many.

    Where a row has many, those go that k others of the block are nearer than.
    """
    score = q @ c.T
    best = score.max(1)
    rows = np.flatnonzero(best >= least)
    score, least = score[rows], least[rows]
    if k == 1:
        least = np.maximum(least, best[rows] - room[rows])
    reached = score >= least[:, None]
    if k < len(c) and np.count_nonzero(reached) > 2 * k * len(rows):
        kth = np.partition(score, -k, axis=1)[:, -k]
        reached = score >= np.maximum(least, kth - room[rows])[:, None]
    if np.count_nonzero(reached) > 4 * k * len(rows):
        return None
    i, j = np.divmod(np.flatnonzero(reached), len(c))
    return rows[i], j


def _pair_distances(q, c, metric):
    """Distances of the rows of `q` to the rows of `c` beside them."""
    dots = np.einsum("ij,ij->i", q, c)
    if metric == "l2":
        return np.maximum((q * q).sum(1) + (c * c).sum(1) - 2.0 * dots, 0.0)
    if metric == "dot":
        return 1.0 - dots
    norms = np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1)
    return 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)


def k_of_each(found, k, limit):
    """The k first (row, column, distance) of each row by distance, then column; `limit` falls to the k-th."""
    i, j, value = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((j, value, i))
    i, j, value = i[order], j[order], value[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    last = place == k - 1
    limit[i[last]] = np.minimum(limit[i[last]], value[last])
    keep = place < k
    return i[keep], j[keep], value[keep]


def metric_space(vectors, metric, side, top):
    """Vectors moved to a space where squared Euclidean distance ranks like `metric`.

    Cosine: unit vectors, zero vectors on axes of their own. Dot product: corpus vectors are
    lengthened to the greatest corpus length `top` along an extra axis.
    """
    if metric == "l2":
        return vectors
    if metric == "dot":
        extra = np.zeros(len(vectors))
        if side == "corpus":
            extra = np.sqrt(np.maximum(top * top - (vectors * vectors).sum(1), 0.0))
        return np.column_stack([vectors, extra])
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    axes = np.zeros((len(vectors), 2))
    axes[norms == 0, 0 if side == "corpus" else 1] = 1.0
    return np.column_stack([unit, axes])


def euclid(a, b):
    """Plain Euclidean distances of all rows of `a` to all rows of `b`."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))
