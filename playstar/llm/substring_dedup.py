"""Repeated passages: documents are parsed into factors that copy earlier text (relative Lempel-Ziv), and long factors go.

The reference is the corpus itself, earlier documents before later ones. It is indexed in blocks: by anchors (short word
sequences that equal windows choose equally), each with the stretch of windows that chose it. A document's stretches
visit the blocks of their anchors only; one that an earlier document has as a whole is copied from there, and where
stretches differ, as at the borders of a factor, their windows are looked up one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of
from playstar.session import new_folder, store

#: Words of an anchor. Shorter ones are fewer; longer ones meet by chance less often.
ANCHOR_WORDS = 6
#: Bytes of texts that are parsed at a time (one text at least), and the block in which copies are settled without a shuffle.
BLOCK_BYTES = 3_000_000
#: Different words a Python worker remembers, and the most bytes of one of them.
WORDS_KEPT, WORD_BYTES = 200_000, 64
#: Stands for a null id: such rows come after all others.
NO_ID = (1 << 63) - 1

# Odd multipliers of the rolling hashes, fixed once; an odd number has an inverse modulo 2**64.
_BASES = tuple(int.from_bytes(xxhash.xxh64_digest(b"base", seed=i), "big") | 1 for i in range(2))


class WordHashes(dict):
    """128 bits for each word, as places in two arrays."""

    def __init__(self) -> None:
        super().__init__()
        self.halves: list[list[int]] = [[], []]

    def __missing__(self, word: bytes) -> int:
        place = len(self.halves[0])
        both = xxhash.xxh3_128_intdigest(word)
        self.halves[0].append(both & (1 << 64) - 1)
        self.halves[1].append(both >> 64)
        if len(word) <= WORD_BYTES:
            self[word] = place
        return place

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The two halves for the words of all texts, one after the other."""
        if len(self.halves[0]) > WORDS_KEPT:
            self.clear()
            self.halves = [[], []]
        places = np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int64)
        return tuple(np.array(half, np.uint64)[places] for half in self.halves)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


class Rolling:
    """Polynomial hashes modulo 2**64 of any stretches of a word sequence."""

    def __init__(self, hashes: np.ndarray, base: int):
        self.up = _powers(base, len(hashes) + 1)
        self.down = _powers(pow(base, -1, 1 << 64), len(hashes) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * self.up[:-1], dtype=np.uint64)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


def _texts(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Runs of rows of bounded size with the words of their texts."""
    for batch in batches:
        sizes = np.cumsum([len(value.as_buffer()) for value in batch.column("text")])
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + block_bytes, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [value.as_py().split() for value in part.column("text")]
            start = stop


_FOUND = pa.schema(
    [("kind", pa.int8()), ("deal", pa.int64()), ("other", pa.int64()), ("known", pa.bool_()), ("doc", pa.int64()), ("mark", pa.int64()),
     ("start", pa.int32()), ("count", pa.int32()), ("source", pa.int64()), ("place", pa.int32())]
)
_FOUND_DDL = "kind byte, deal long, other long, known boolean, doc long, mark long, start int, count int, source long, place int"
#: Kinds of rows: first of its block so far; to be looked up window by window; copied from ``source`` at ``place``.
FIRST, OPEN, COPIED = range(3)


_STRETCH = np.dtype([("doc", np.int64), ("mark", np.int64), ("start", np.int64), ("count", np.int64)])


def _found(
    kind: int, stretch: np.ndarray, source: np.ndarray | None = None, place: np.ndarray | None = None, *,
    deal: np.ndarray | None = None, other: np.ndarray | None = None, known: np.ndarray | None = None,
) -> pa.RecordBatch:
    none = np.zeros(len(stretch), np.int64)
    if deal is None:  # these meet no others any more and are spread evenly
        deal = mixed((stretch["doc"] * 31 + stretch["mark"] + stretch["start"]).view(np.uint64))
    hashes = (none if h is None else h.view(np.int64) for h in (deal, other))
    given = (none if v is None else v for v in (source, place))
    flags = np.zeros(len(stretch), bool) if known is None else known
    columns = [np.full(len(stretch), kind), *hashes, flags, *(stretch[name] for name in _STRETCH.names), *given]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def settle(deal: np.ndarray, other: np.ndarray, known: np.ndarray, stretch: np.ndarray, last: bool, open_differing: bool) -> Iterator[pa.RecordBatch]:
    """Within one block of stretches: which copy an earlier one, which have to be looked up, and which are first.

    Stretches are equal where ``deal`` and ``other`` are; the smallest (doc, start) is the first, and those at the same place of the
    same document are first as well. ``open_differing``: equal ``deal`` with different ``other`` means that the stretches share an
    anchor and may share windows, so their firsts are OPEN. ``last``: nothing else is going to be compared with
    them, so what is first and not open is dropped; otherwise one FIRST row stands for all of a ``deal``.
    """
    if not len(deal):
        return
    order = np.lexsort((stretch["start"], stretch["doc"], other, deal))
    deal, other, known, stretch = deal[order], other[order], known[order], stretch[order]
    new_deal = np.concatenate(([True], deal[1:] != deal[:-1]))
    new_pair = new_deal | np.concatenate(([True], other[1:] != other[:-1]))
    group = np.cumsum(new_deal) - 1
    head = np.flatnonzero(new_pair)[np.cumsum(new_pair) - 1]
    copied = (stretch["doc"] != stretch["doc"][head]) | (stretch["start"] != stretch["start"][head])
    if copied.any():
        yield _found(COPIED, *joined(stretch[copied], stretch["doc"][head[copied]], stretch["start"][head[copied]]))
    first = ~copied
    shared = np.zeros(len(deal), bool)
    if open_differing:
        several = np.bincount(group, new_pair) > 1
        several |= np.bincount(group, known) > 0
        shared = several[group]
        # Before the last round one row of the anchor still has to tell other blocks that it is shared.
        witness = np.zeros(len(deal), bool)
        if not last:
            witness[np.flatnonzero(new_deal)] = True
        rows = first & shared & ~witness
        if rows.any():
            yield _found(OPEN, stretch[rows])
    if not last:
        rows = first & (~shared | witness) if open_differing else first
        yield _found(FIRST, stretch[rows], deal=deal[rows], other=other[rows], known=shared[rows])


def joined(stretch: np.ndarray, source: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copied stretches that go on where the one before ends, in the document and at its source, as one."""
    order = np.lexsort((stretch["start"], stretch["mark"], stretch["doc"]))
    stretch, source, place = stretch[order], source[order], place[order]
    a, b = stretch[:-1], stretch[1:]
    goes_on = (a["doc"] == b["doc"]) & (a["mark"] == b["mark"]) & (a["start"] + a["count"] == b["start"])
    goes_on &= (source[:-1] == source[1:]) & (place[:-1] + a["count"] == place[1:])
    begins = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    out = stretch[begins]
    out["count"] = np.add.reduceat(stretch["count"], begins)
    return out, source[begins], place[begins]


def parse(batches: Iterator[pa.RecordBatch], window: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts' windows and the stretches of windows that chose them, settled block by block."""
    memory, gram = WordHashes(), min(ANCHOR_WORDS, window)
    reach = window - gram + 1
    for part, texts in _texts(batches, block_bytes):
        texts = [words if len(words) >= window else [] for words in texts]
        sizes = np.array([len(words) for words in texts], np.int64)
        if not sizes.sum():
            continue
        low, high = memory.of(texts)
        rolling, other = Rolling(low, _BASES[0]), Rolling(high, _BASES[1])
        ends = np.cumsum(sizes)
        at = np.arange(len(low) - window + 1)
        row = np.searchsorted(ends, at, side="right")
        at, row = at[at + window <= ends[row]], row[at + window <= ends[row]]
        grams = rolling.of(np.arange(len(low) - gram + 1), np.arange(gram, len(low) + 1))
        chosen = at + sliding_window_view(grams, reach).argmin(1)[at]
        fresh = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1]))))
        count = np.diff(np.append(fresh, len(at)))
        start, row = at[fresh], row[fresh]
        # The whole stretch with the anchor's place in it: equal numbers mean equal windows at equal distances.
        whole = mixed(other.of(start, start + count + window - 1) + (chosen[fresh] - start).astype(np.uint64))
        yield from settle(grams[chosen[fresh]], whole, np.zeros(len(start), bool), _stretches(part, row, start - (ends - sizes)[row], count), False, True)


def _stretches(part: pa.RecordBatch, row: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    out = np.empty(len(row), _STRETCH)
    out["doc"], out["mark"] = part.column("doc").to_numpy()[row], part.column("mark").to_numpy()[row]
    out["start"], out["count"] = start, count
    return out


def look_up(batches: Iterator[pa.RecordBatch], window: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """The single windows of open stretches, settled block by block."""
    memory = WordHashes()
    for part, texts in _texts(batches, block_bytes):
        low, high = memory.of(texts)
        if len(low) < window:
            continue
        rolling, other = Rolling(low, _BASES[0]), Rolling(high, _BASES[1])
        sizes = np.array([len(words) for words in texts], np.int64)
        row, start, count = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in _open(part))
        each = np.repeat(np.arange(len(start)), count)
        begin = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        row = row[each]
        at = begin + (np.cumsum(sizes) - sizes)[row]
        stretch = _stretches(part, row, begin, np.ones(len(row), np.int64))
        yield from settle(rolling.of(at, at + window), other.of(at, at + window), np.zeros(len(row), bool), stretch, False, False)


def _open(part: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    rows, starts, counts = [], [], []
    for i, listed in enumerate(part.column("open")):
        fields = listed.values
        starts.append(fields.field(0).to_numpy().astype(np.int64))
        counts.append(fields.field(1).to_numpy().astype(np.int64))
        rows.append(np.full(len(starts[-1]), i))
    return rows, starts, counts


def _whole_deals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by ``deal``, cut where it changes."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        deal = table.column("deal").to_numpy()
        changes = np.flatnonzero(deal[1:] != deal[:-1])
        if len(changes):
            yield table.slice(0, changes[-1] + 1)
            held = table.slice(changes[-1] + 1)
        else:
            held = table
    if held is not None and held.num_rows:
        yield held


def _settled(found: DataFrame, open_differing: bool, label: str) -> DataFrame:
    """FIRST rows brought together by ``deal`` and settled for good; the others as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_deals(batches):
            kind = table.column("kind").to_numpy()
            if (kind != FIRST).any():
                yield from table.filter(pa.array(kind != FIRST)).to_batches()
            rows = table.filter(pa.array(kind == FIRST))
            stretch = np.empty(rows.num_rows, _STRETCH)
            for name in _STRETCH.names:
                stretch[name] = rows.column(name).to_numpy()
            deal, other = (rows.column(name).to_numpy().view(np.uint64) for name in ("deal", "other"))
            yield from settle(deal, other, rows.column("known").to_numpy(), stretch, True, open_differing)

    dealt = found.repartition("deal").sortWithinPartitions("deal")
    return store(dealt.mapInArrow(run, _FOUND_DDL).drop("deal", "other", "known"), new_folder(found.sparkSession, label))


_KEY = ["doc", "mark"]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc``, ``mark`` and ``text`` of every row. The mark tells rows apart that share an id but not the text; it is 0 for all others."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(value).alias("mark"), value.cast("binary").alias("text"),
    )
    ids = rows.groupBy("doc").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    repeated = store(ids.where("low <> high").select("doc", F.lit(True).alias("repeated")), new_folder(docs.sparkSession, "repeated"))
    return rows.join(repeated, "doc", "left").select("doc_id", "doc", F.when(F.col("repeated"), F.col("mark")).otherwise(F.lit(0)).alias("mark"), "text")


def copied_stretches(texts: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """Stretches of windows that an earlier place of the corpus has: ``doc``, ``mark``, ``start``, ``count`` (of windows), and the
    first place that has them, ``source`` (its doc) and ``place`` (its start)."""
    texts = texts.select(*_KEY, "text")
    found = _settled(texts.mapInArrow(lambda batches: parse(batches, window, block_bytes), _FOUND_DDL), True, "stretches")
    open_ones = found.where(F.col("kind") == OPEN).select(*_KEY, "start", "count").distinct()
    listed = open_ones.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "count")).alias("open"))
    again = texts.join(listed, _KEY).mapInArrow(lambda batches: look_up(batches, window, block_bytes), _FOUND_DDL)
    windows = _settled(again, False, "windows")
    columns = [*_KEY, "start", "count", "source", "place"]
    return found.where(F.col("kind") == COPIED).select(columns).union(windows.where(F.col("kind") == COPIED).select(columns))


def factors(stretches: list[dict], window: int) -> list[tuple[int, int, int, int]]:
    """Greedy parse: start and stop (words), source and place of each factor, which is as long as one source goes on.

    Stretches come by start. Neighbouring factors may overlap: a border is covered by windows of both sides.
    """
    out: list[tuple[int, int, int, int]] = []
    for start, count, source, place in sorted((s["start"], s["count"], s["source"], s["place"]) for s in stretches):
        stop = start + count + window - 1
        if out and out[-1][2] == source and out[-1][3] - out[-1][0] == place - start and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop), *out[-1][2:])
        elif not out or stop > out[-1][1]:
            out.append((start, stop, source, place))
    return out


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
     ("factors", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("source", pa.int64()), ("place", pa.int32())])))]
)


def deduplicate(
    docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (text) and ``factors`` of every row of ``docs``.

    Words are runs of anything but ASCII white space, as they are written. A window is ``window`` consecutive words of one text. Every word
    in a window whose words also start at an earlier place of the input (smaller id, or same id and earlier start) goes; ``kept``
    has the others, joined by one space. ``factors`` tells where: ``start`` and ``stop`` in words, and the first place that has the
    words, as the id ``source`` and the start ``place``.

    Every window chooses an anchor by its words alone, the smallest hash of ANCHOR_WORDS words in it, so equal windows choose alike; consecutive
    windows of one anchor are a stretch, about one for every eight words. Stretches are settled within blocks of ``block_bytes`` of text, where copies
    are found without a shuffle, and what is first there is dealt out by anchor. So a passage of very many documents is one row for each block.
    A stretch that an earlier place has as a whole is copied from there. Anchors with different stretches, at the borders of passages,
    are looked up window by window, first within blocks, too. Windows are compared by 128 bits of two hashes.

    Null and empty texts have no words and give an empty ``kept``. Rows with one id count as one document: the same start in two of them
    is the same place, and neither is earlier. Null ids are one document behind all others. Repeated rows each give their row. Other
    columns are ignored; an empty table gives an empty one.
    """
    session_of(docs)
    texts = _keyed(docs, doc_id, text)
    copied = copied_stretches(texts, window, block_bytes).distinct()
    listed = copied.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "count", "source", "place")).alias("copied"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, all_words in _texts(batches, block_bytes):
            rows = []
            for doc, words, stretches in zip(part.column("doc_id").to_pylist(), all_words, part.column("copied").to_pylist(), strict=True):
                found = factors(stretches or [], window)
                kept, at = [], 0
                for start, stop, _, _ in found:
                    kept += words[at:start]
                    at = max(at, stop)
                kept += words[at:]
                spans = [{"start": a, "stop": b, "source": None if source == NO_ID else source, "place": place} for a, b, source, place in found]
                rows.append((doc, len(words), len(words) - len(kept), b" ".join(kept), spans))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT)

    result = "doc_id long, n_words long, n_removed long, kept binary, factors array<struct<start: int, stop: int, source: long, place: int>>"
    joined_texts = texts.join(listed, _KEY, "left").select("doc_id", "text", "copied")
    return joined_texts.mapInArrow(run, result).withColumn("kept", F.col("kept").cast("string"))
