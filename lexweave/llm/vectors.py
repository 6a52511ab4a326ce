"""Most similar vectors for every vector: an inverted multi-index, built and searched in one shuffle of the vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Fixed point of the stored vectors: cosine values from them are within 3e-5 of the exact ones.
SCALE = 32_767
#: Most rows the codebooks are fitted on; every row is indexed and searched.
FIT_ROWS = 32_768
#: Rows per block of one first-half centroid; centroids that hold more are spread over several tasks.
BLOCK_ROWS = 40_000
#: Elements of one similarity matrix.
CHUNK = 4_000_000


def usable(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and unit-length rows of the vectors that have ``dim`` finite numbers, not all zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False).to_numpy(zero_copy_only=False))
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)
    peak = np.abs(flat).max(axis=1, initial=0.0)
    good = np.isfinite(peak) & (peak > 0)
    unit = flat[good] / peak[good, None]
    return rows[good], unit / np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive stretches of the data's bytes as a binary array."""
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _bytes(column: pa.Array | pa.ChunkedArray, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column end to end, and the number of items of each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _units(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return _bytes(column, np.int16)[0].reshape(-1, dim).astype(np.float32) / SCALE


def _counter(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each stretch."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Lloyd's centroids of the rows of x; centroids that lose all rows are put on rows drawn anew."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        full = count > 0
        c[full] = total[full] / count[full, None]
        if not full.all():
            c[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return c


def _spread(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of each id, by a mixed hash: ids that share a divisor spread like all others."""
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int64)


class MultiIndex:
    """Two codebooks, one per vector half; a cell is a pair of centroids."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], lists: int, cells: int):
        """lists: first-half centroids a query may visit; cells: centroid pairs it visits."""
        self.books, self.k = books, len(books[0])
        self.lists, self.cells = min(lists, self.k), min(cells, min(lists, self.k) * self.k)

    def nearest(self, x: np.ndarray, half: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` nearest centroids of each row, nearest first, with squared distances (up to a constant per row)."""
        c = self.books[half]
        d = (c * c).sum(1) - 2 * (x @ c.T)
        if most < self.k:
            some = np.argpartition(d, most - 1, axis=1)[:, :most]
            order = np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable")
            some = np.take_along_axis(some, order, 1)
        else:
            some = np.argsort(d, axis=1, kind="stable")
        return some, np.take_along_axis(d, some, 1)

    def traverse(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Visits centroid pairs in order of summed distance: first-half centroids (rows x lists), how many second-half
        centroids are visited with each, and the second-half centroids in order.

        Each query's heap is its frontier: the next unvisited pair of every first-half centroid, kept as one column of an array, so
        that the smallest is popped, and its successor pushed, for all queries of a batch at once.
        """
        half = self.books[0].shape[1]
        most = min(self.k, self.cells)
        first, d1 = self.nearest(x[:, :half], 0, self.lists)
        second, d2 = self.nearest(x[:, half:], 1, most)
        d2 = np.hstack([d2, np.full((len(x), 1), np.inf, d2.dtype)])
        heap = np.ascontiguousarray((d1 + d2[:, :1]).T)
        taken = np.zeros((self.lists, len(x)), np.int32)
        each = np.arange(len(x))
        for _ in range(self.cells):
            top = heap.argmin(axis=0)
            taken[top, each] += 1
            heap[top, each] = d1[each, top] + d2[each, taken[top, each]]
        return first, np.minimum(taken.T, most), second


def _blocks(index: MultiIndex, x: np.ndarray, n: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """For each first-half centroid, over how many blocks its members and its queries are spread, from the rows in the fit."""
    first, taken, _ = index.traverse(x)
    members = np.bincount(first[:, 0], minlength=index.k) / len(x) * n
    asking = np.bincount(first[taken > 0], minlength=index.k) / len(x) * n * share
    return np.maximum(1, np.ceil(members / BLOCK_ROWS)).astype(int), np.maximum(1, np.ceil(asking / (4 * BLOCK_ROWS))).astype(int)


def _search(table: pa.Table, k: int, least: float, both: bool, dim: int) -> pa.Table:
    """Compares, within one block, the queries that visit a cell with the members of the cell."""
    ids = table["id"].to_numpy()
    cell, unit = table["cell"].to_numpy(), _units(table["code"], dim)
    wanted, many = _bytes(table["visits"], np.uint16)
    members = np.flatnonzero(cell >= 0)
    members = members[np.argsort(cell[members], kind="stable")]
    asks = np.repeat(np.arange(len(ids)), many)
    order = np.argsort(wanted, kind="stable")
    asks, wanted = asks[order], wanted[order]
    cells, start = np.unique(cell[members], return_index=True)
    stop = np.append(start, len(members))[1:]  # a block may hold questions and no member
    lo, hi = np.searchsorted(wanted, cells, "left"), np.searchsorted(wanted, cells, "right")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    floor = np.full(len(ids), least, np.float32)  # what a neighbour must reach; rises with the k-th best seen, where one side asks
    for a, b, p, q in zip(start, stop, lo, hi, strict=True):
        inside = members[a:b]
        right, by_id = unit[inside].T, np.argsort(ids[inside], kind="stable")
        sorted_ids = ids[inside][by_id]
        step = max(1, CHUNK // len(inside))
        for at in range(p, q, step):
            asking = asks[at : min(q, at + step)]
            s = unit[asking] @ right
            for side in ("left", "right"):  # a vector is no neighbour of its own; an id may stand twice
                own = np.searchsorted(sorted_ids, ids[asking], side) - (side == "right")
                own = np.clip(own, 0, len(inside) - 1)
                same = np.flatnonzero(sorted_ids[own] == ids[asking])
                s[same, by_id[own[same]]] = -2.0
            hit = s >= floor[asking][:, None]
            if np.count_nonzero(hit) > 4 * k * sum(s.shape):  # all that can be among the k best of either side, ties included
                best = np.zeros_like(hit)
                if s.shape[1] > k:
                    kth = np.partition(s, -k, axis=1)[:, -k]
                    best |= s >= kth[:, None]
                    if not both:
                        floor[asking] = np.maximum(floor[asking], kth)
                else:
                    best[:] = True
                if both and not best.all():
                    best |= s >= np.partition(s, -k, axis=0)[-k][None, :] if s.shape[0] > k else True
                hit &= best
            x, y = np.nonzero(hit)
            if len(x):
                found.append((asking[x], inside[y], s[x, y]))
    if not found:
        return pa.table({"query": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "similarity": pa.array([], pa.float32())})
    x, y, s = (np.concatenate(c) for c in zip(*found, strict=True))
    if both:
        x, y, s = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([s, s])
    order = np.lexsort((ids[y], -s, x))
    x, y, s = x[order], y[order], s[order]
    fresh = np.append(True, (x[1:] != x[:-1]) | (ids[y[1:]] != ids[y[:-1]]))
    x, y, s = x[fresh], y[fresh], s[fresh]
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    rank = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    keep = rank < k
    return pa.table({"query": ids[x[keep]], "other": ids[y[keep]], "similarity": s[keep].astype(np.float32)})


def nearest_vectors(
    vectors: DataFrame, id_col: str, vec_col: str, k: int = 10, min_similarity: float = -1.0, dim: int = 128,
    centroids: int | None = None, lists: int = 4, cells: int = 32, query_every: int = 1, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The ``k`` most similar other vectors of every vector, by cosine: ``query, other, similarity`` (query and other are ids).

    An inverted multi-index: codebooks for the two vector halves are fitted on at most ``fit_rows`` rows drawn by a hash of the id;
    every row is then assigned to its pair of centroids. Each query visits up to ``cells`` centroid pairs in order of summed
    distance (of its ``lists`` nearest first-half centroids), and the entries of these cells are reranked with the full vectors in
    fixed point (cosine error below 3e-5). A comparison counts for both sides, so a pair is found from either end.

    ``centroids`` per half grows with the square root of the rows if not given, which keeps the entries per cell, and the work per
    query, about constant. A row is sent to at most ``lists`` centroids, once for each, with only the numbers of the cells it visits there.
    Centroids holding many rows (seen in the fit) are cut into a grid of blocks of members x queries, so no task gets a group that
    grows with the data. ``query_every=m`` takes as queries only ids divisible by m, against all rows.

    Equal vectors (same direction, to fixed point) are searched once, by the smallest id among them, and expanded at the end: a
    vector's own copies come first, by id. Ties at the k-th place go to the smaller ids. Null, incomplete, non-finite and all-zero
    vectors, and null ids, take no part; repeated ids count once. An empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    src = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))
    n = src.count()
    # a few more than needed are drawn, then the first by hash are taken: the same rows whatever their order
    drawn = src.withColumn("hash", F.xxhash64(F.col("id"), F.lit(11))).where(F.pmod("hash", F.lit(1_000_000)) < int(1.2e6 * fit_rows / max(n, 1)) + 100)
    sample = drawn.orderBy("hash", "id", "vec").limit(fit_rows).select("vec").toArrow()
    _, x = usable(sample["vec"].combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.float32())), dim)
    schema = "query long, other long, similarity float"
    if not len(x):
        return spark.createDataFrame([], schema)
    x = x.astype(np.float32)
    size = min(centroids or max(4, int(0.35 * n**0.5)), 2048, max(1, len(np.unique(x, axis=0)) // 2))
    half = dim // 2
    index = MultiIndex((kmeans(x[:, :half], size), kmeans(x[:, half:], size)), lists, cells)
    for_members, for_queries = _blocks(index, x[:8192], n, 1 / query_every)
    shared = spark.sparkContext.broadcast((index, for_members, for_queries))  # two codebooks of at most 2048 rows

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, unit = usable(batch.column("vec"), dim)
            codes = np.rint(unit * SCALE).astype(np.int16)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), _binary(codes, np.full(len(rows), 2 * dim))], ["id", "code"])

    marks = [F.xxhash64("code").alias("h1"), F.hash("code").alias("h2")]
    # encoded and written once: what follows reads the codes once, and then only ids and hashes
    encoded = cut_lineage(src.mapInArrow(encode, "id long, code binary").select("id", "code", *marks))
    # equal codes collapse before they are shuffled; a query group's smallest query id speaks for it
    asking = F.col("id") % query_every == 0
    groups = encoded.groupBy("code").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.max(asking).alias("asks"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, for_members, for_queries = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                ids, asks = batch.column("id").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
                first, taken, second = index.traverse(_units(batch.column("code"), dim))
                second, home = second.astype(np.uint16), first[:, 0]
                merged = asks & (taken[:, 0] > 0) & (for_members[home] == 1) & (for_queries[home] == 1)
                # members that are not sent with their own question: to one row of blocks, and every block in it
                alone = np.flatnonzero(~merged)
                cols = for_queries[home[alone]]
                m_row = np.repeat(alone, cols)
                m_part = _spread(ids[m_row], for_members[home[m_row]]) * for_queries[home[m_row]] + _counter(cols)
                # questions: to one column of blocks of every centroid they visit
                q_row, q_rank = np.nonzero((taken > 0) & asks[:, None])
                rows = for_members[first[q_row, q_rank]]
                q_row, q_rank = np.repeat(q_row, rows), np.repeat(q_rank, rows)
                goal = first[q_row, q_rank]
                q_part = _counter(rows) * for_queries[goal] + _spread(ids[q_row], for_queries[goal])
                q_cell = np.where(merged[q_row] & (q_rank == 0), second[q_row, 0].astype(np.int32), -1)
                visits = taken[q_row, q_rank]
                flat = second[q_row][np.arange(second.shape[1])[None, :] < visits[:, None]]
                row = np.concatenate([m_row, q_row])
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([home[m_row], goal]).astype(np.int32)), pa.array(np.concatenate([m_part, q_part]).astype(np.int32)), batch.column("id").take(pick),
                        pa.array(np.concatenate([second[m_row, 0].astype(np.int32), q_cell]).astype(np.int32)), _binary(flat, np.concatenate([np.zeros(len(m_row), np.int64), 2 * visits])), batch.column("code").take(pick),
                    ],
                    ["list", "part", "id", "cell", "visits", "code"],
                )

    sent = groups.select("id", "code", "asks").mapInArrow(send, "list int, part int, id long, cell int, visits binary, code binary")
    both = query_every == 1
    near = sent.groupBy("list", "part").applyInArrow(lambda t: _search(t, k, min_similarity, both, dim), schema)
    near = near.repartition("query").groupBy("query", "other").agg(F.max("similarity").alias("similarity"))
    best = W.partitionBy("query").orderBy(F.desc("similarity"), "other")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")

    # copies: only groups of two or more, found again by two hashes of their code
    several = encoded.select("id", "h1", "h2").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    member = encoded.select("id", "h1", "h2").join(several, ["h1", "h2"]).select("rep", "id").distinct()
    early = member.withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy("id"))).where(F.col("r") <= k + 1)
    heads = early.groupBy("rep").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    to = heads.select(F.col("rep").alias("other"), F.col("ids").alias("others"))
    mine = heads.select(F.col("rep").alias("query"), F.col("ids").alias("queries"))
    spread = near.join(to, "other", "left").select("query", "similarity", F.explode(F.coalesce(F.slice("others", 1, k), F.array("other"))).alias("other"))
    spread = spread.join(mine, "query", "left").withColumn("queries", F.coalesce("queries", F.array("query")))
    room = F.col("rank") <= k + 1 - F.size("queries")
    spread = spread.withColumn("rank", F.row_number().over(best)).where(room).select(F.explode("queries").alias("query"), "other", "similarity")
    inside = member.join(heads, "rep").select(F.col("id").alias("query"), F.explode(F.slice(F.filter("ids", lambda i: i != F.col("id")), 1, k)).alias("other"), F.lit(1.0).cast("float").alias("similarity"))
    return spread.unionByName(inside).where(F.col("query") % query_every == 0)


def similar_pairs(near: DataFrame) -> DataFrame:
    """Each pair of a nearest-vector result once: ``vec_id_a < vec_id_b``."""
    return near.select(F.least("query", "other").alias("vec_id_a"), F.greatest("query", "other").alias("vec_id_b")).distinct()
