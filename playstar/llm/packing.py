"""Sequence packing: documents' tokens into windows of fixed size, by the sum-of-squares rule."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of, slices, vocabulary

#: Words a Python worker remembers, and the most characters of one of them.
WORDS_KEPT, WORD_CHARS = 500_000, 64
#: Open windows of a partition above which their content is drawn together.
OPEN_WINDOWS = 2048
#: Below it, a letter to Python is a letter to the library's pattern whatever their Unicode versions.
LATIN_END = "\u0250"

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordIds(dict):
    """Ids of words, as bytes of little-endian 32-bit integers.

    Works for a BPE file of the tokenizers library that splits text at white space and
    drops it: words are then independent. The library normalizes and merges, save that Latin words are lower-cased here;
    what is kept are the ids of words seen before; words in other cases or with signs after them share the ids of their letters. Added
    tokens of the file are found in the raw text first, the longest of those at the leftmost place, and what is between them is encoded
    by itself, as the library does.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The library's spelling of bytes: printable ones as they are, the others from 256 on in their order.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in printable]
        self.spelled = {b: b if b in printable else 256 + others.index(b) for b in range(256)}
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.pre_tokenize = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.model = self.tokenizer.model
        self.as_bytes = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        #: Ids of the signs that end words.
        self.simple: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {token.content: np.array([i], "<u4").tobytes() for i, token in added.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        # Tokens that take the space beside them, stand as words or are sought in normalized text are left to the library.
        self.by_library = any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())

    def tokens(self, spelled: str) -> bytes:
        as_bytes = self.as_bytes
        return b"".join([as_bytes[t.id] for t in self.model.tokenize(spelled)])

    def signs(self, part: str) -> bytes:
        found = self.simple.get(part)
        if found is None:
            found = self.tokens(part)
            if len(part) <= WORD_CHARS:
                self.simple[part] = found
        return found

    def __missing__(self, word: str) -> bytes:
        # What lies below LATIN_END is in normal form C, and lower-cased by Python as by the library.
        near = word.isascii() or max(word) < LATIN_END
        plain = word.lower() if near else self.normalize(word)
        letters = plain if plain.isalpha() else plain.rstrip(string.punctuation)
        if not letters.isalpha() or not (letters.isascii() or max(letters) < LATIN_END):
            ids = b"".join([self.tokens(part) for part, _ in self.pre_tokenize(plain)])
        elif letters != word:
            ids = self[letters] + self.signs(plain[len(letters) :]) if len(letters) < len(plain) else self[letters]
        else:
            ids = self.tokens(word if word.isascii() else word.encode().decode("latin-1").translate(self.spelled))
        if len(word) <= WORD_CHARS:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if len(self) > WORDS_KEPT:
            self.clear()
            self.simple.clear()
        if self.by_library:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(token in text for token in self.added):
            parts, at = [], 0
            for match in self.cut.finditer(text):
                parts += self.words(text[at : match.start()]), self.added[match.group()]
                at = match.end()
            return b"".join([*parts, self.words(text[at:])])
        return self.words(text)

    def words(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


class Packer:
    """Windows of one partition. ``level[h]`` counts the open windows filled up to h."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.level = np.zeros(size + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(size)]
        self.open = 0

    def place(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Put a document away; gives the pieces of windows that are full now."""
        size, total = self.size, len(ids)
        whole = total - total % size
        for start in range(0, whole, size):
            yield from self.close([(doc_id, start, ids[start : start + size], total)])
        rest = total - whole
        if not rest:
            return
        # Change of the sum of squares of level[1:size] for a window at h = 0 .. size - rest;
        # a full window leaves the sum, a new one (h = 0) adds nothing but its new level.
        change = 2 * self.level[rest:] + 1
        change[-1] = 0
        have = self.level[: size - rest + 1]
        change[1:] += np.where(have[1:] > 0, 1 - 2 * have[1:], 4 * size + 4 * self.open)
        h = len(change) - 1 - int(change[::-1].argmin())
        piece = (doc_id, whole, ids[whole:], total)
        if h:
            window = self.windows[h].pop()
            self.level[h] -= 1
            self.open -= 1
            window.append(piece)
        else:
            window = [piece]
        if h + rest == size:
            yield from self.close(window)
        else:
            self.windows[h + rest].append(window)
            self.level[h + rest] += 1
            self.open += 1
            if self.open > OPEN_WINDOWS:
                yield from self.draw_together()

    def close(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in window:
            yield doc_id, start, len(ids), ids.tobytes(), total, self.next_id, offset
            offset += len(ids)
        self.next_id += 1

    def draw_together(self) -> Iterator[tuple]:
        """Empty the emptiest open windows into the fullest ones, cutting pieces; at most one stays partly filled."""
        waiting = [window for at_level in reversed(self.windows) for window in at_level]
        self.windows = [[] for _ in range(self.size)]
        self.level[:] = 0
        self.open = 0
        donor: list[tuple] = []
        first, last = 0, len(waiting)
        while first < last:
            window = waiting[first]
            first += 1
            room = self.size - sum(len(ids) for _, _, ids, _ in window)
            while room and (donor or first < last):
                if not donor:
                    last -= 1
                    donor = waiting[last][::-1]
                doc_id, start, ids, total = donor.pop()
                window.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    donor.append((doc_id, start + room, ids[room:], total))
                room -= len(window[-1][2])
            yield from self.close(window)
        if donor:
            yield from self.close(donor[::-1])


def pack(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    size: int = 4096,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens.

    A document is the ids of its text by the tokenizer file (whole text; no special tokens are
    put around it, those spelled out in it are found) and ``end_id``. Columns: ``doc_id``, ``start`` (ids of the document before the piece),
    ``length``, ``ids`` (binary, little-endian 32-bit), ``doc_tokens`` (of the document, with ``end_id``),
    ``sequence_id`` and ``offset`` (in the sequence, gapless from 0). Every id lies in one piece.

    Each partition packs its documents in the order of the scan and needs no shuffle: whole windows are cut
    off a long document, the rest goes to the open window (or a new one) that keeps the sum of the
    squared level counts smallest, on ties to the fullest. Windows that are open at the end, or when there
    are more than OPEN_WINDOWS of them, are drawn together by cutting, so a partition has one padded sequence at most
    each time. ``sequence_id`` is unique; its upper bits are the partition.

    Null and empty texts are documents of ``end_id`` alone. Repeated rows and ids, and null ids, are packed like others, row by
    row. Other columns are ignored; an empty table gives an empty one.
    """
    path = vocabulary_path or vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(path)
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                pieces: list[tuple] = []
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    pieces.extend(packer.place(key, np.frombuffer(words.of(value or "") + end, "<u4")))
                yield _batch(pieces)
        yield _batch(list(packer.draw_together()))

    session_of(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = list(zip(*pieces, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_words: dict[str, WordIds] = {}


def worker_words(path: str) -> WordIds:
    """One table of words for all tasks of a Python worker."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]
