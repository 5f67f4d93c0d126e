"""Token counts by a compiled transducer: BPE of a piece model as a deterministic machine over characters."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of, slices, vocabulary

SPACE = "▁"
#: Characters of a chunk whose map is computed at a time.
CHUNK = 1 << 16
#: States of the machine, and whole words, that a Python worker remembers.
STATES_KEPT = 300_000
WORDS_KEPT = 400_000
#: Longer words are not remembered.
WORD_CHARS = 64


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any state, as its words: the first, the count of the inner ones, and the last.

    Only ``head`` may continue a word of the chunk before, and only ``tail`` may go on in the
    next chunk; the inner words begin in the reset state and end, so their count is the same
    from any state. A chunk of one word is all head.
    """

    head: str
    count: int = 0
    tail: str | None = None


class Machine:
    """Deterministic transducer of a BPE model with scores, made state by state as texts need it.

    The last token of the BPE of a text is the one suffix in the vocabulary that is stable beside the
    last token of what is before it, so the BPE of all prefixes follows from left to right. Future
    tokens can only begin inside the longest suffix that begins a token. A state is
    this suffix with, for each place in it, the last token and the count relative to the
    current one; a transition is annotated with the change of the count. Both are finite.
    """

    def __init__(self, pieces: dict[str, float]):
        self.scores = pieces
        self.starts = {piece[:i] for piece in pieces for i in range(1, len(piece))}
        self.longest = max(map(len, pieces), default=1)
        self.stable_pairs: dict[tuple[str, str], bool] = {}
        self.whole = {piece for piece in pieces if self.merge(piece) == [piece]}
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, tuple[int, int]]] = []
        # (suffix, last token at each place from its start to its end, counts relative to the end)
        self.reset = self._number(("", (None,), (0,)))

    def _number(self, state: tuple) -> int:
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return found

    def merge(self, text: str) -> list[str]:
        """Plain BPE: join the adjacent pair whose piece has the highest score, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(
                ((self.scores[joined], -i) for i in range(len(parts) - 1) if (joined := parts[i] + parts[i + 1]) in self.scores),
                default=None,
            )
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stable(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self.stable_pairs.get(pair)
        if found is None:
            if len(self.stable_pairs) > STATES_KEPT:
                self.stable_pairs.clear()
            found = self.stable_pairs[pair] = self.merge(left + right) == [left, right]
        return found

    def step(self, state: int, char: str) -> tuple[int, int]:
        """Next state and change of the count."""
        suffix, last, counts = self.states[state]
        if char not in self.scores:  # bytes, one token each; nothing merges across
            found = (self._number(("", (None,), (0,))), len(char.encode("utf-8", "surrogatepass")))
        else:
            read = suffix + char
            for at in range(len(read)):
                token = read[at:]
                if token in self.whole and (last[at] is None or self.stable(last[at], token)):
                    break
            change = counts[at] + 1
            keep = next((i for i in range(len(read)) if read[i:] in self.starts), len(read))
            found = (
                self._number((read[keep:], (*last, token)[keep:], tuple(c - change for c in counts[keep:]) + (0,))),
                change,
            )
        self.steps[state][char] = found
        return found

    def run(self, text: str, state: int) -> tuple[int, int]:
        """State after ``text`` and the change of the count."""
        total, steps = 0, self.steps
        for char in text:
            found = steps[state].get(char)
            if found is None:
                if len(self.states) > STATES_KEPT:
                    kept = self.states[state]
                    self.clear()
                    state, steps = self._number(kept), self.steps
                found = self.step(state, char)
            state, change = found
            total += change
        return total, state


class TokenCounter(dict):
    """Counts of texts; in the dictionary, transitions over whole words that follow one space.

    No piece has a space after another character, so a space after anything else
    resets the machine. A word here is a run of spaces and what follows up to the next space.
    """

    words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def __init__(self, pieces: dict[str, float]):
        super().__init__()
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("the pieces of this model go beyond words")
        self.machine = Machine(pieces)

    def __missing__(self, word: str) -> int:
        count = self.machine.run(SPACE + word, self.machine.reset)[0]
        if len(word) <= WORD_CHARS:
            self[word] = count
        return count

    def word(self, word: str) -> int:
        return self.machine.run(word, self.machine.reset)[0]

    def chunk_map(self, chunk: str) -> ChunkMap:
        first, *rest = chunk.split(SPACE)
        if "" in rest:  # several spaces in a row, or one at the end
            first, *rest = self.words(chunk)
            inner = sum(map(self.word, rest[:-1]))
            return ChunkMap(first, inner, rest[-1] if rest else None)
        if not first:
            first, *rest = [SPACE + rest[0], *rest[1:]]
        if not rest:
            return ChunkMap(first)
        return ChunkMap(first, sum(map(self.__getitem__, rest[:-1])), SPACE + rest[-1])

    def compose(self, left: ChunkMap, right: ChunkMap) -> ChunkMap:
        """The map of two neighbours; associative. Their touching words make one word or two."""
        touching = self.words((left.head if left.tail is None else left.tail) + right.head)
        if left.tail is not None and right.tail is not None:
            return ChunkMap(left.head, left.count + sum(map(self.word, touching)) + right.count, right.tail)
        if left.tail is not None:
            return ChunkMap(left.head, left.count + sum(map(self.word, touching[:-1])), touching[-1])
        if right.tail is not None:
            return ChunkMap(touching[0], sum(map(self.word, touching[1:])) + right.count, right.tail)
        return ChunkMap(touching[0], 0, touching[1] if len(touching) > 1 else None)

    def of(self, text: str) -> int:
        """Tokens of a text: the maps of its chunks composed level by level, applied to the reset state."""
        if not text:
            return 0
        if len(self) > WORDS_KEPT:
            self.clear()
        text = SPACE + text.replace(" ", SPACE)
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        (whole,) = maps
        return self.word(whole.head) + whole.count + (self.word(whole.tail) if whole.tail is not None else 0)


def read_pieces(path: str) -> dict[str, float]:
    """The pieces that merges can make, with their scores, of a BPE model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    left_out = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not any(f(i) for f in left_out)}


_counters: dict[str, TokenCounter] = {}


def worker_counter(path: str) -> TokenCounter:
    """One machine for all tasks of a Python worker."""
    if path not in _counters:
        _counters[path] = TokenCounter(read_pieces(path))
    return _counters[path]


def count_tokens(
    docs: DataFrame, model_path: str | None = None, limit: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    Whole texts, without begin or end tokens; strings like special tokens are text. The machine and the words
    it has seen are made as needed by each Python worker, within fixed bounds. A text is cut into chunks of
    CHUNK characters whose maps are composed, so the cost is linear in its length. No shuffle.

    Null and empty texts have no bytes and no tokens. Repeated rows and ids, and null
    ids, each give their row. Other columns are ignored; an empty table gives an empty one.
    """
    path = model_path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        for batch in batches:
            for part in slices(batch):
                counts = [counter.of(text or "") for text in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    session_of(docs)
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(value).cast("long").alias("n_bytes"), value.alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
