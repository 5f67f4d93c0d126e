"""Near duplicates by SimHash: fingerprints that differ in few bits, found through anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import bounded_cells, by_group, session_of, slices, spanning_edges
from playstar.llm.components import connected_components
from playstar.session import in_few_files, new_folder, store

SEED = 42
#: Shingles of a text that are hashed at a time.
SHINGLES_AT_ONCE = 1 << 18
#: Fingerprints of an anchor that are compared in one block.
CELL_ROWS = 1024


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64 majority bits over the XXH64 of all shingles, repeats included; 0 where there is no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts, total = iter([b" ".join(words)]), 1
    else:
        parts, total = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    while len(hashes := np.fromiter(map(digest, islice(parts, SHINGLES_AT_ONCE)), "<u8")):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (ones * 2 > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed long with the 64 bits) of every row, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = [fingerprint(t.as_py(), shingle) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.int64())], ["doc_id", "fingerprint"])

    session_of(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def _segments(max_distance: int) -> int:
    """Pieces of the fingerprint such that linked ones differ in at most one bit of some piece."""
    if not 0 <= max_distance <= 15:
        raise ValueError("max_distance must lie between 0 and 15")
    return next(n for n in (1, 2, 4, 8) if max_distance < 2 * n)


def anchors(prints: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, segment, anchor and whether it is the nearest one, for all anchors in reach.

    A segment of 2**m bits is covered by the perfect Hamming code on 2**m - 1 bits
    and one free bit: radius 1. By the pigeonhole principle two linked fingerprints
    differ in at most t = 1 bits of one segment at least (t = 0 if ``max_distance`` is 0), so one lies
    within radius + t of the anchor nearest to the other. All anchors in that distance are given.
    """
    count = _segments(max_distance)
    width = 64 // count
    reach = 1 if max_distance else 0
    n = width - 1
    index, segment, anchor, nearest = [], [], [], []
    values = prints.view(np.uint64)
    every = np.arange(len(values))
    for s in range(count):
        piece = (values >> np.uint64(s * width)) & np.uint64((1 << width) - 1)
        syndrome = np.zeros(len(piece), np.uint64)
        for i in range(1, n + 1):
            syndrome ^= ((piece >> np.uint64(i - 1)) & np.uint64(1)) * np.uint64(i)

        def flip(where: np.ndarray, base: np.ndarray) -> np.ndarray:
            """Bit ``where`` (from 1) changed; 0 changes none."""
            return np.where(where == 0, base, base ^ (np.uint64(1) << np.maximum(where, 1).astype(np.uint64) - np.uint64(1)))

        def add(rows: np.ndarray, values_: np.ndarray, home: bool) -> None:
            index.append(rows)
            segment.append(np.full(len(rows), s, np.int32))
            anchor.append(values_.view(np.int64))
            nearest.append(np.full(len(rows), home))

        home = flip(syndrome, piece)
        add(every, home, True)
        if reach:
            add(every, home ^ (np.uint64(1) << np.uint64(width - 1)), False)
            for i in range(1, n + 1):  # code words two bits away: the bits' numbers give the syndrome
                other = syndrome ^ np.uint64(i)
                rows = np.flatnonzero((syndrome != 0) & (np.uint64(i) < other))
                add(rows, flip(other[rows], piece[rows] ^ (np.uint64(1) << np.uint64(i - 1))), False)
    return tuple(map(np.concatenate, (index, segment, anchor, nearest)))


def _replicated(classes: DataFrame, max_distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4096):
                prints = part.column(1).to_numpy()
                index, segment, anchor, nearest = anchors(prints, max_distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment), pa.array(anchor), pa.array(nearest), pa.array(part.column(0).to_numpy()[index]), pa.array(prints[index])],
                    ["segment", "anchor", "nearest", "member", "fingerprint"],
                )

    return classes.select("member", "fingerprint").mapInArrow(
        run, "segment int, anchor long, nearest boolean, member long, fingerprint long"
    )


def _compare(max_distance: int):
    def handle(group: pa.Table) -> pa.RecordBatch | None:
        nearest = group.column("nearest").to_numpy()
        if not nearest.any():
            return None
        member, prints = group.column("member").to_numpy(), group.column("fingerprint").to_numpy().view(np.uint64)
        block = group.column("block").to_numpy()
        home = np.flatnonzero(nearest)
        close = np.bitwise_count(prints[home][:, None] ^ prints[None, :]) <= max_distance
        if group.column("lo")[0].as_py() != group.column("hi")[0].as_py():
            close &= block[home][:, None] != block[None, :]
        left, right = np.nonzero(close)
        left = home[left]
        other = member[left] != member[right]
        if not other.any():
            return None
        u, v = spanning_edges(member, left[other], right[other])
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return handle


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Documents are linked where their fingerprints differ in at most ``max_distance`` bits
    (0 to 15); ``component_id`` is the smallest ``doc_id`` reachable, its own included.

    Equal fingerprints are one class, so copies are never compared. Classes are
    replicated to the anchors in reach and compared per anchor, each with those whose nearest
    anchor it is; crowded anchors are split into cells (`bounded_cells`). A cell gives spanning
    edges only, at most one for each of its rows.

    Null or empty texts, and texts of white space, have fingerprint 0 and are linked like
    others. Rows with a repeated ``doc_id`` each give a row; all fingerprints of one
    id are in one component. Rows whose ``doc_id`` is null have a fingerprint and a null component and link nothing. Other
    columns are ignored; an empty table gives an empty one.
    """
    spark = session_of(docs)
    prints = store(fingerprints(docs, shingle, doc_id, text), new_folder(spark, "prints"))
    rows_given = prints.count()
    classes = store(
        in_few_files(prints.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("member")), rows_given),
        new_folder(spark, "classes"),
    )
    # An id may be the smallest of several fingerprints; then it joins them by itself.
    rows = _replicated(classes, max_distance)
    cells = bounded_cells(rows, ["segment", "anchor"], "fingerprint", CELL_ROWS)
    links = by_group(cells, ["segment", "anchor", "lo", "hi"], _compare(max_distance), "u long, v long")
    # A repeated id whose rows differ links the classes of its rows.
    repeated = (
        prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).where("low <> high")
    )
    own = (
        prints.join(repeated.select("doc_id"), "doc_id", "left_semi")
        .join(classes, "fingerprint")
        .select(F.col("doc_id").alias("u"), F.col("member").alias("v"))
    )
    components = connected_components(links.union(own), "u", "v", about=rows_given)
    found = classes.join(components, F.col("member") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "member").alias("class_component")
    )
    return prints.join(found, "fingerprint", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("class_component")).alias("component_id"),
    )
