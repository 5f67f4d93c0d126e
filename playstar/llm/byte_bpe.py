"""Byte-level BPE by a rank file: encoding to ids and decoding back to bytes."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of, slices, vocabulary

#: Runs without spaces a Python worker remembers, and the most characters of one of them.
RUNS_KEPT, RUN_CHARS = 600_000, 64
#: Below it, a letter to Python is a letter to any pattern, whatever their Unicode versions.
LATIN_END = "\u0250"
#: Words of more bytes are merged with a heap, whose cost does not grow with the square.
LONG_WORD = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Fold the ranked merges over the bytes of a word: the pair with the lowest rank first, the leftmost of equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    none, rank = len(ranks) + 1, ranks.get
    starts = list(range(len(word) + 1))
    pairs = [rank(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        del starts[i + 1], pairs[i]
        if i:
            pairs[i - 1] = rank(word[starts[i - 1] : starts[i + 1]], none)
        if i < len(pairs):
            pairs[i] = rank(word[starts[i] : starts[i + 2]], none)
    return [ranks[word[a:b]] for a, b in zip(starts, starts[1:], strict=False)]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with the pairs in a heap by rank and place, and the parts in a linked list."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0 where none starts
    before = list(range(-1, n))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if i and (rank := ranks.get(word[before[i] : stop])) is not None:
            heapq.heappush(heap, (rank, before[i], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


class Encoder(dict):
    """Ids (little-endian 32-bit, as bytes) of the text between two single spaces, its leading space included.

    A space that follows anything but white space always begins a match of the
    pattern, so such runs are encoded by themselves and remembered. A run that
    begins or ends with white space belongs to a longer stretch of it: None.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.matches = regex.compile(pattern).findall
        self.points = {point: self.word(point) for point in ".,"}

    def word(self, word: str) -> bytes:
        return np.array(merge_word(word.encode(), self.ranks), "<u4").tobytes()

    def stretch(self, text: str) -> bytes:
        return b"".join(map(self.word, self.matches(text)))

    def __missing__(self, run: str) -> bytes | None:
        # Letters alone are one match, a point behind them is another.
        if run.isalpha() and max(run) < LATIN_END:
            ids = self.word(" " + run)
        elif run[:-1].isalpha() and run[-1] in self.points and max(run) < LATIN_END:
            ids = self[run[:-1]] + self.points[run[-1]]
        elif run and not run[0].isspace() and not run[-1].isspace():
            ids = self.stretch(" " + run)
        else:
            ids = None
        if len(run) <= RUN_CHARS:
            self[run] = ids
        return ids

    def of(self, text: str) -> bytes:
        if len(self) > RUNS_KEPT:
            self.clear()
        first, *rest = text.split(" ")
        if rest and (not first or first[-1].isspace()):
            return self.stretch(text)
        try:
            return self.stretch(first) + b"".join(map(self.__getitem__, rest))
        except TypeError:  # a run without ids of its own
            return self.stretch(text)


_encoders: dict[tuple[str, str], Encoder] = {}
_pieces: dict[str, list[bytes]] = {}


def worker_encoder(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def worker_pieces(path: str) -> list[bytes]:
    if path not in _pieces:
        ranks = read_ranks(path)
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        _pieces[path] = pieces
    return _pieces[path]


def encode(
    docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every row.

    The text is split into words by ``pattern`` and the bytes of each distinct word are merged by rank, whole
    texts, without special tokens. What has been seen before is looked up, so the fold runs about once
    for each distinct word of a Python worker; what it remembers is bounded.
    No shuffle: the cost of a row does not depend on other rows.

    Null and empty texts have no ids. Repeated rows and ids, and null ids, each give
    their row. Other columns are ignored; an empty table gives an empty one.
    """
    path = ranks_path or vocabulary("byte_bpe_50k.tiktoken")
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch):
                encoded = [encoder.of(text or "") for text in part.column(1).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(ids) // 4 for ids in encoded]))).astype(np.int32)
                ids = np.frombuffer(b"".join(encoded), "<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    session_of(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds ``to``: the bytes (binary) that the ids stand for, the pieces put one after the other. Null ids give null; an id outside the vocabulary
    fails the job."""
    path = ranks_path or vocabulary("byte_bpe_50k.tiktoken")
    session_of(encoded)

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        piece = worker_pieces(path).__getitem__
        ends, given = lists.offsets.to_pylist(), lists.is_valid().to_pylist()
        values = lists.values.to_numpy()
        spans = zip(ends, ends[1:], given, strict=False)
        return pa.array([b"".join(map(piece, values[a:b].tolist())) if there else None for a, b, there in spans], pa.binary())

    return encoded.withColumn(to, joined(F.col(ids)))
