"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.llm.ann import matrix, takes_part, usable
from playstar.llm.common import bounded_cells, by_group, session_of, slices, spanning_edges, whole_groups
from playstar.llm.components import connected_components
from playstar.session import new_folder, store

TABLES = 6
#: Cross-polytope codes that make up a bucket's name.
CODES = 2
#: Buckets a vector is put into in each table: its own and the nearest others.
PROBES = 3
#: Random hyperplanes of a sketch, and the chance that a linked pair is lost because its sketches differ too much.
SKETCH_BITS = 64
LOST = 1e-6
#: Vectors of a bucket that are compared in one block.
CELL_ROWS = 1024
#: Linked pairs whose buckets are compared at a time.
PAIRS_AT_ONCE = 1 << 16


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two. Scaled to keep lengths."""
    n, dims = rows.shape
    out, half = rows.copy(), 1
    while half < dims:
        pairs = out.reshape(n, dims // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, dims)
        half *= 2
    return out / np.sqrt(dims)


def buckets(vectors: np.ndarray, tables: int, codes: int, probes: int, seed: int = 11) -> np.ndarray:
    """Buckets (rows x tables x probes) of unit vectors, the own one first.

    Each code rotates the vector by three rounds of random signs and a Hadamard transform and takes the nearest
    corner of the cross-polytope: the largest coordinate and its sign. Further probes exchange the code, or the two
    codes, whose next corner falls least behind.
    """
    n, dims = vectors.shape
    width = 1 << max(1, (dims - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dims] = vectors
    rng = np.random.default_rng(seed)
    depth = min(probes, width)
    probes = min(probes, depth**codes)
    out = np.empty((n, tables, probes), np.int32)
    for table in range(tables):
        corner = np.empty((n, codes, depth), np.int64)
        behind = np.empty((n, codes, depth))
        for code in range(codes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * rng.choice((-1.0, 1.0), width))
            size = np.abs(turned)
            near = np.argsort(-size, axis=1, kind="stable")[:, :depth]
            far = np.take_along_axis(size, near, 1)
            corner[:, code] = 2 * near + (np.take_along_axis(turned, near, 1) < 0)
            behind[:, code] = far[:, :1] - far
        # All ways to take one of the nearest corners for each code, best sum first.
        choice = np.stack(np.meshgrid(*[np.arange(depth)] * codes, indexing="ij"), -1).reshape(-1, codes)
        cost = sum(behind[:, code][:, choice[:, code]] for code in range(codes))
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        name = np.zeros((n, probes), np.int64)
        for code in range(codes):
            name = name * (2 * width) + np.take_along_axis(corner[:, code], choice[best, code], 1)
        out[:, table] = name % 2147483647
    return out


def most_bits_apart(threshold: float) -> int:
    """Bits of the sketches of two linked vectors that differ, but for a chance of LOST.

    A random hyperplane parts two vectors with a probability of their angle over pi, each one independently.
    """
    p = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    beyond, bits = 1.0, -1
    while beyond > LOST and bits < SKETCH_BITS:
        bits += 1
        beyond -= math.comb(SKETCH_BITS, bits) * p**bits * (1 - p) ** (SKETCH_BITS - bits)
    return bits


def sketches(vectors: np.ndarray, seed: int = 13) -> np.ndarray:
    """For each vector the sides of SKETCH_BITS random hyperplanes, as the bits of a long."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], SKETCH_BITS))
    return np.packbits(vectors @ planes > 0, axis=1).view(np.int64)[:, 0]


def _hashed(classes: DataFrame, tables: int, codes: int, probes: int) -> DataFrame:
    """Each class with the names of its buckets (table by table, its own first) and its sketch, without the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1024):
                sizes = pc.list_value_length(batch.column("vector")).to_numpy()
                for dims in np.unique(sizes):  # vectors of different lengths never link
                    part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                    n = part.num_rows
                    values = matrix(part.column("vector"), dims)
                    unit = values / np.linalg.norm(values, axis=1)[:, None]
                    names = buckets(unit, tables, codes, probes).reshape(n, -1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, names.size + 1, names.shape[1], dtype=np.int32)), pa.array(names.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("class_id"), part.column("label"), pa.array(np.full(n, dims, np.int32)), lists, pa.array(sketches(unit))],
                        ["class_id", "label", "dims", "names", "sketch"],
                    )

    rows = classes.select("class_id", "label", "vector")
    return rows.mapInArrow(run, "class_id long, label string, dims int, names array<int>, sketch long")


def _slots(tables: int) -> dict[str, Column]:
    """What a place (``slot``) in the list of names stands for: table, bucket, and whether it is the own one."""
    probes = F.call_function("div", F.size("names"), F.lit(tables)).cast("int")
    return {
        "table": F.call_function("div", F.col("slot"), probes).cast("int"),
        "bucket": F.col("names")[F.col("slot")],
        "own": F.col("slot") % probes == 0,
    }


def _candidates(hashed: DataFrame, tables: int, apart: int) -> DataFrame:
    """``class_id`` and ``slots``: the buckets in which a class meets another whose sketch is near; others have no row.

    Only ids, names of buckets and sketches are shuffled. Buckets are known by a 64-bit hash here: should two of them
    share one, there are some candidates too many.
    """
    parts = _slots(tables)
    rows = (
        hashed.select("class_id", "sketch", "label", "dims", "names", F.posexplode("names").alias("slot", "_"))
        .withColumn("bucket_id", F.xxhash64("label", "dims", parts["table"], parts["bucket"]))
        .select("bucket_id", "class_id", "sketch", "slot", parts["own"].alias("own"))
    )
    key = ["bucket_id", "lo", "hi"]
    cells = bounded_cells(rows, ["bucket_id"], "class_id", CELL_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, key):
            bucket, lo, hi, ids, sketch, slot, own, block = (
                some.column(c).to_numpy() for c in (*key, "class_id", "sketch", "slot", "own", "block")
            )
            met, n = np.zeros(len(ids), bool), len(ids)
            # Every row with the next one of its cell, the next but one, and so on, all cells together.
            left, step = np.arange(n), 0
            while len(left):
                step += 1
                left = left[left + step < n]
                right = left + step
                same = (bucket[left] == bucket[right]) & (lo[left] == lo[right]) & (hi[left] == hi[right])
                left, right = left[same], right[same]
                near = (own[left] | own[right]) & (np.bitwise_count((sketch[left] ^ sketch[right]).view(np.uint64)) <= apart)
                near &= (lo[left] == hi[left]) | (block[left] != block[right])
                met[left[near]] = met[right[near]] = True
            if met.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(slot[met])], ["class_id", "slot"])

    found = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "class_id long, slot int")
    return found.groupBy("class_id").agg(F.collect_set("slot").alias("slots"))


def _compare(threshold: float, tables: int):
    def handle(group: pa.Table) -> pa.RecordBatch | None:
        own = group.column("own").to_numpy()
        if not own.any():
            return None
        dims, table, bucket, lo, hi = (group.column(c)[0].as_py() for c in ("dims", "table", "bucket", "lo", "hi"))
        number, member, copies, block = (group.column(c).to_numpy() for c in ("class_id", "member", "copies", "block"))
        vectors = matrix(group.column("vector"), dims)
        norms = np.sqrt((vectors**2).sum(1))
        unit = vectors / norms[:, None]
        left, right = np.nonzero(unit @ unit.T >= threshold - 1e-9)
        new = (left < right) & (own[left] | own[right])
        if lo != hi:
            new &= block[left] != block[right]
        left, right = left[new], right[new]
        if not len(left):
            return None
        names = group.column("names").combine_chunks().flatten().to_numpy().reshape(len(member), tables, -1)
        keep = np.empty(len(left), bool)
        for s in range(0, len(left), PAIRS_AT_ONCE):
            a, b = left[s : s + PAIRS_AT_ONCE], right[s : s + PAIRS_AT_ONCE]
            near = (vectors[a] * vectors[b]).sum(1) / (norms[a] * norms[b]) >= threshold
            near[near] = first_meeting(names[a[near]], names[b[near]], table, bucket)
            keep[s : s + PAIRS_AT_ONCE] = near
        left, right = left[keep], right[keep]
        links = np.bincount(left, copies[right], len(member)) + np.bincount(right, copies[left], len(member))
        low, root = spanning_edges(member, left, right)
        linked = np.flatnonzero(links)
        roots = dict(zip(low.tolist(), root.tolist(), strict=True))
        ids = member[linked]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(number[linked]),
                pa.array(ids),
                pa.array([roots.get(i, i) for i in ids.tolist()], pa.int64()),
                pa.array(links[linked].astype(np.int64)),
            ],
            ["class_id", "member", "root", "links"],
        )

    return handle


def first_meeting(a: np.ndarray, b: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Whether this bucket is the first in which the two meet, so that a pair counts in one bucket only.

    They meet in a bucket that both are put into and that is the own (first) one of either.
    """
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        same = a[:, t, :, None] == b[:, t, None, :]
        same[:, 1:, 1:] = False
        if t < table:
            first &= ~same.any((1, 2))
        else:
            first &= np.where(same.any(2), a[:, t], np.iinfo(np.int32).max).min(1, initial=np.iinfo(np.int32).max) == bucket
    return first


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    tables: int = TABLES,
    codes: int = CODES,
    probes: int = PROBES,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id reachable) and ``kept`` (is it that one?).

    Two vectors are linked where their labels are equal and not null and their cosine in double precision is at
    least ``threshold``. Pairs are sought in shared buckets and each is verified, so no link is false; the chance to
    miss one falls with more ``tables`` and ``probes``.

    Equal vectors of a label are one class with a number of copies, so copies are never compared. Buckets are first
    looked through without vectors: a class goes on with those in which it meets one whose sketch (sides of SKETCH_BITS random
    hyperplanes) is near enough; a linked pair fails this with a chance of LOST. Only for these the vectors are fetched. A crowded
    bucket is cut into cells (`bounded_cells`). A pair counts in the first bucket where it meets, so links are
    summed per vector and no list of pairs is made: a cell gives each of its rows once, with the root of its links.

    Rows whose vector is null, empty, zero or has null or non-finite components, or whose label is null, link with
    nothing and are a component of their own, kept; so are rows without an id, with a null component. Vectors of different
    lengths never link. Repeated rows count as vectors of their own; rows of one id with
    different vectors have their own links and are in one component. Other columns are ignored; an empty table gives an empty one.
    """
    spark = session_of(vectors)
    given = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("string").alias("label"))
    # 128 bits stand for the vector where rows are grouped and joined.
    digest = F.md5(F.array_join(F.col("vector").cast("array<string>"), " ").cast("binary"))
    taking_part = usable(given.where("label is not null"), "vec_id", "embedding", "label").withColumn("digest", digest)
    classes = store(
        taking_part.groupBy("label", "digest")
        .agg(F.min("vec_id").alias("member"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
        .withColumn("class_id", F.monotonically_increasing_id()),
        new_folder(spark, "classes"),
    )
    hashed = store(_hashed(classes, tables, codes, probes), new_folder(spark, "hashed"))
    candidates = store(_candidates(hashed, tables, most_bits_apart(threshold)), new_folder(spark, "candidates"))
    meeting = hashed.drop("sketch").join(candidates, "class_id").withColumn("slot", F.explode("slots"))
    placed = meeting.select("class_id", "label", "dims", "names", *[c.alias(name) for name, c in _slots(tables).items()])
    key = ["label", "dims", "table", "bucket"]
    rows = placed.join(classes.select("class_id", "member", "copies", "vector"), "class_id")
    cells = bounded_cells(rows, key, "class_id", CELL_ROWS)
    found = store(
        by_group(cells, [*key, "lo", "hi"], _compare(threshold, tables), "class_id long, member long, root long, links long"),
        new_folder(spark, "found"),
    )
    # An id that is given with several vectors links their classes.
    name = F.struct("label", "digest")
    several = taking_part.groupBy("vec_id").agg(F.min(name).alias("low"), F.max(name).alias("high")).where("low <> high")
    own = (
        taking_part.select("vec_id", "label", "digest")
        .join(several.select("vec_id"), "vec_id", "left_semi")
        .join(classes, ["label", "digest"])
        .select(F.col("vec_id").alias("member"), F.col("member").alias("root"))
    )
    components = connected_components(found.select("member", "root").union(own), "member", "root")
    of_class = (
        classes.drop("vector")
        .join(found.groupBy("class_id").agg(F.sum("links").alias("links")), "class_id", "left")
        .join(components, F.col("member") == F.col("node"), "left")
        .select(
            "label", "digest",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "member").alias("component_id"),
        )
    )
    linked = taking_part.select("vec_id", "label", "digest").join(of_class, ["label", "digest"], "left")
    ids = given.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    alone = ids.where(~_takes_part(F.col("vec_id"), F.col("embedding"), F.col("label"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.select("vec_id", "n_links", "component_id").union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def _takes_part(vec_id: Column, embedding: Column, label: Column) -> Column:
    return vec_id.isNotNull() & label.isNotNull() & F.coalesce(takes_part(embedding), F.lit(False))
