"""Approximate nearest neighbours: inverted lists whose vectors are scanned in blocks of rotated dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import extended, groups, session_of
from playstar.session import new_folder, store

#: Vectors (on average) on which the lists' centres are fitted, and the most lists there are.
SAMPLE_VECTORS = 20_000
MOST_LISTS = 4096
#: Vectors and queries of a list that are compared in one cell.
CELL_VECTORS, CELL_QUERIES = 4096, 512
#: Dimensions of a column block.
BLOCK = 16
#: Of the test that abandons a candidate: larger is safer.
EPSILON = 2.1


def usable(vectors: DataFrame, vec_id: str, embedding: str, *others: str) -> DataFrame:
    """``vec_id``, ``vector`` and the other columns of the rows that take part: an id, and a vector that is not
    null, empty or zero and has no null or non-finite component. Single precision is kept as it is."""
    value, kind = F.col(embedding), dict(vectors.dtypes)[embedding]
    value = value if kind in ("array<float>", "array<double>") else value.cast("array<double>")
    return vectors.where(F.col(vec_id).isNotNull() & F.coalesce(takes_part(F.col(embedding)), F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), value.alias("vector"), *others
    )


def takes_part(embedding: Column) -> Column:
    """Whether a vector is not empty or zero and all its components are finite; null for a null one."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return finite & F.exists(embedding, lambda x: x != 0)


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dims)


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix: after it, any leading dimensions hold their share of a distance."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means on the sample; an empty cluster keeps its centre."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:count]].copy()
    for _ in range(rounds):
        nearest = assign(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def assign(rows: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` nearest centres of each row, nearest first."""
    out = []
    for part in np.array_split(rows, max(1, len(rows) // 4096)):
        far = (centres**2).sum(1) - 2 * part @ centres.T
        if count == 1:
            out.append(far.argmin(1)[:, None])
        else:
            some = np.argpartition(far, count - 1, axis=1)[:, :count] if count < far.shape[1] else np.argsort(far, axis=1)
            out.append(np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def scan(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, turned_q: np.ndarray, turned_v: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query, the ids and distances of its k nearest of the cell's vectors.

    Partial squared distances grow block by block. After d of D dimensions a candidate goes on only if
    partial * D / d is not beyond the k-th best distance so far by a factor of (1 + EPSILON / sqrt(d))**2: a
    test of the hypothesis that it is among the nearest. The first k candidates are measured in full, to have a bound.
    """
    dims = vectors.shape[1]
    for q, query_id in enumerate(query_ids):
        others = np.flatnonzero(ids != query_id)
        if not len(others):
            continue
        # The first block orders the candidates, so the bound is tight from the start.
        partial = ((turned_v[others, :BLOCK] - turned_q[q, :BLOCK]) ** 2).sum(1)
        if len(others) > k:
            first = np.argpartition(partial, k - 1)[:k]
            bound = (((vectors[others[first]] - queries[q]) ** 2).sum(1)).max()
        else:
            bound = np.inf
        done = min(BLOCK, dims)
        while len(others) > k and done < dims:
            keep = partial * (dims / done) <= bound * (1 + EPSILON / np.sqrt(done)) ** 2
            others, partial = others[keep], partial[keep]
            stop = min(done + BLOCK, dims)
            partial = partial + ((turned_v[others, done:stop] - turned_q[q, done:stop]) ** 2).sum(1)
            done = stop
        exact = np.sqrt(((vectors[others] - queries[q]) ** 2).sum(1))
        best = np.lexsort((ids[others], exact))[:k]
        yield int(query_id), ids[others[best]], exact[best]


FOUND = "query_id long, rank int, vec_id long, score double"


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    probes: float = 0.7,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the k nearest of ``vectors`` found for each query.

    The score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id. A query is
    not its own neighbour (by id). Fewer candidates than k: all that were found.

    Every vector is in the list of its nearest centre. There are about as many lists as the square root of the
    number of vectors (MOST_LISTS at most); centres are fitted on SAMPLE_VECTORS vectors at most, drawn by share. A query visits the share
    ``probes`` of the lists, nearest first, and scans them by rotated dimension blocks, leaving candidates early (`scan`). A list is
    cut into cells of bounded size, so a crowded one is the work of many tasks; each cell gives the k best of each query.

    Rows without an id, or whose vector is null, empty, zero or holds null or non-finite components, take no
    part on either side. Vectors of different lengths are no neighbours: each length is searched by itself. Repeated rows are candidates
    each for itself; a repeated query id is searched once, with the smallest of its vectors. Other columns are ignored. No vectors or no queries: no rows.
    """
    spark = session_of(vectors)
    rows = usable(vectors, vec_id, embedding)
    asked = usable(queries, vec_id, embedding).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    found = spark.createDataFrame([], FOUND)
    # One row for each length that both sides have.
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    for dims, n in sorted(lengths.join(asked.select(F.size("vector").alias("dims")).distinct(), "dims").collect()):
        of_length = (side.where(F.size("vector") == dims) for side in (rows, asked))
        found = found.union(_search(*of_length, dims, n, k, probes))
    return found


def _search(rows: DataFrame, asked: DataFrame, dims: int, n: int, k: int, probes: float) -> DataFrame:
    """The search among ``n`` vectors (``vec_id``, ``vector``) of one length."""
    spark = rows.sparkSession
    sample = np.array([r["vector"] for r in rows.select("vector").sample(min(1.0, SAMPLE_VECTORS / n), seed=5).collect()])
    if not len(sample):
        sample = np.array([rows.first()["vector"]])
    lists = int(min(MOST_LISTS, max(1, round(n**0.5))))
    centres = fit_centres(sample, lists)
    visits = max(1, min(len(centres), int(np.ceil(len(centres) * probes))))
    turn = rotation(dims)

    def placed(count: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    near = assign(matrix(batch.column(1), dims), centres, count).astype(np.int32)
                    flat = pa.array(near.ravel())
                    offsets = pa.array(np.arange(0, near.size + 1, count, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "vector", "lists"])

        return run

    index = store(rows.mapInArrow(placed(1), extended(rows, "lists array<int>")).select("vec_id", "vector", F.col("lists")[0].alias("list")), new_folder(spark, "lists"))
    visiting = store(asked.mapInArrow(placed(visits), extended(asked, "lists array<int>")), new_folder(spark, "visits"))
    # At most MOST_LISTS rows each.
    sizes = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL_VECTORS).cast("int").alias("parts"))
    visitors = visiting.select(F.explode("lists").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("turns"))
    grid = F.broadcast(sizes.join(visitors, "list"))
    part = F.pmod(F.xxhash64("vec_id"), "parts").cast("int")
    turn_of = F.pmod(F.xxhash64("vec_id"), "turns").cast("int")
    candidates = index.join(grid, "list").select(
        "list", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("asks"), "vec_id", "vector"
    )
    asking = visiting.withColumn("list", F.explode("lists")).join(grid, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), turn_of.alias("turn"), F.lit(True).alias("asks"), "vec_id", "vector"
    )
    cell = ["list", "part", "turn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, cell):
            asks = group.column("asks").to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, values = group.column("vec_id").to_numpy(), matrix(group.column("vector"), dims)
            turned = values @ turn
            found = list(scan(values[asks], ids[asks], values[~asks], ids[~asks], turned[asks], turned[~asks], k))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(near), query_id) for query_id, near, _ in found])),
                        pa.array(np.concatenate([near for _, near, _ in found])),
                        pa.array(np.concatenate([far for _, _, far in found])),
                        pa.array(np.full(sum(len(near) for _, near, _ in found), group.column("list")[0].as_py()), pa.int32()),
                    ],
                    ["query_id", "vec_id", "score", "list"],
                )

    dealt = candidates.union(asking).repartition(*cell).sortWithinPartitions(*cell)
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double, list int")
    # k rows at most from each cell; the k best of each list, then of the query.
    best_of = lambda hits: F.slice(F.array_sort(hits), 1, k).alias("near")
    by_list = found.groupBy("query_id", "list").agg(best_of(F.collect_list(F.struct("score", "vec_id"))))
    best = by_list.groupBy("query_id").agg(best_of(F.flatten(F.collect_list("near"))))
    return best.select("query_id", F.posexplode("near").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
