"""Repair of conversation structure: the cheapest edits that make roles alternate, by dynamic programming over runs.

A conversation has to read ``(s?(ua)+)?`` in the initials of its roles (system, user, assistant). Conversations are
sorted in ranges and cut into pieces of at most PIECE_ROWS rows, so one of any length is the work of many tasks. What a piece does
to the rest of its conversation is a 4 x 4 matrix (min, +) for the costs and a map of four states for the choices; both
are associative and are carried over the pieces level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstar.llm.common import groups, session_of, slices
from playstar.session import new_folder, store

#: Bounds of a piece: rows, and characters of their texts (but for its last row).
PIECE_ROWS, PIECE_CHARS = 1024, 4_000_000
#: Pieces that are combined in one go share all but so many bits of their number.
LEVEL_BITS = 10

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
FAR = 1 << 40

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
#: The only role that may be given or put in at a state.
_WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_SPELLED = {"u": "user", "a": "assistant"}

OK, TRUNCATED, DUPLICATE, BLANK = "", "truncated", "duplicate", "blank"
Costs = tuple[int, ...]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), FAR)


def _unit() -> np.ndarray:
    unit = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(unit, 0)
    return unit


def _inserts() -> np.ndarray:
    """Cheapest insertions from each state to each other one."""
    step = _unit()
    for state, role in _WANTED.items():
        step[state, _NEXT[state][role]] = INSERT
    return times(times(step, step), times(step, step))


INSERTS = _inserts()
#: Costs of what is put in behind the last row, by state.
AT_END = tuple(times(INSERTS, np.array([[0], [FAR], [FAR], [0]], np.int64))[:, 0].tolist())


@lru_cache(64)
def transition(initial: str, fault: str) -> np.ndarray:
    """Costs of one row from each state to each other one, insertions before it included."""
    edit = _unit() + DELETE
    if fault not in (BLANK, DUPLICATE):
        more = CUT_OFF if fault == TRUNCATED else 0
        for state, after in _NEXT.items():
            for role, to in after.items():
                if role == initial:
                    edit[state, to] = min(edit[state, to], KEEP + more)
            to = after[_WANTED[state]]
            edit[state, to] = min(edit[state, to], REROLE + more)
    return times(INSERTS, np.minimum(edit, FAR))


@lru_cache(4096)
def power(initial: str, fault: str, exponent: int) -> np.ndarray:
    """The transition of 2 ** exponent equal rows."""
    if exponent == 0:
        return transition(initial, fault)
    half = power(initial, fault, exponent - 1)
    return times(half, half)


def run_matrix(initial: str, fault: str, rows: int) -> np.ndarray:
    out = _unit()
    for exponent in range(rows.bit_length()):
        if rows >> exponent & 1:
            out = times(out, power(initial, fault, exponent))
    return out


def runs(symbols: list[tuple[str, str]]) -> list[tuple[tuple[str, str], int]]:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def piece_matrix(symbols: list[tuple[str, str]]) -> np.ndarray:
    out = _unit()
    for symbol, rows in runs(symbols):
        out = times(out, run_matrix(*symbol, rows))
    return out


@lru_cache(1 << 16)
def _back(symbol: tuple[str, str], rows: int, after: Costs) -> Costs:
    return tuple((run_matrix(*symbol, rows) + np.array(after)).min(1).tolist())


def back(symbol: tuple[str, str], rows: int, after: Costs) -> Costs:
    """Costs by state before equal rows, given those behind them. Only differences matter, so few cases ever occur."""
    low = min(after)
    return tuple(low + cost for cost in _back(symbol, rows, tuple(cost - low for cost in after)))


def costs_before(symbols: list[tuple[str, str]], after: Costs) -> list[Costs]:
    """Cheapest cost of the rest for each state before every row, and behind the last one (``after``).

    Borders of runs come from the runs' matrices, rows inside a run from its one-row transition.
    """
    out = [after]
    for symbol, rows in reversed(runs(symbols)):
        border = back(symbol, rows, out[-1])
        for _ in range(rows - 1):
            out.append(back(symbol, 1, out[-1]))
        out.append(border)
    return out[::-1]


def choose(symbols: list[tuple[str, str]], rest: list[Costs], state: int) -> tuple[str, list[str], int]:
    """The ASCII-least cheapest edits from a state on: their initials, the roles given (empty: as it was, or deleted), and the state reached.

    Letters differ in what they lead to, so taking the least letter that is on a cheapest way is enough.
    """
    audit, given = [], []
    for i, (initial, fault) in enumerate(symbols):
        while True:
            cost, wanted = rest[i][state], _WANTED[state]
            onward = _NEXT[state][wanted]
            more = CUT_OFF if fault == TRUNCATED else 0
            must_go = fault in (BLANK, DUPLICATE)
            if DELETE + rest[i + 1][state] == cost:
                audit.append("D")
                given.append("")
            elif INSERT + rest[i][onward] == cost:
                audit.append("I")
                given.append(_SPELLED[wanted])
                state = onward
                continue
            elif not must_go and initial in _NEXT[state] and KEEP + more + rest[i + 1][_NEXT[state][initial]] == cost:
                audit.append("K")
                given.append("")
                state = _NEXT[state][initial]
            else:
                audit.append("R")
                given.append(_SPELLED[wanted])
                state = onward
            break
    return "".join(audit), given, state


def tail(state: int) -> list[str]:
    """Roles put in behind the last row."""
    out = []
    while state in (SYSTEM, USER):
        out.append(_SPELLED[_WANTED[state]])
        state = _NEXT[state][_WANTED[state]]
    return out


# Pieces ------------------------------------------------------------------------------

_PIECE = pa.schema(
    [("conv", pa.string()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
     ("faults", pa.list_(pa.string())), ("digests", pa.list_(pa.binary()))]
)
_PIECE_DDL = "conv string, turns array<long>, roles array<string>, texts array<string>, faults array<string>, digests array<binary>"


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 128) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a schema, in its order of fields."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def own_fault(text: str) -> str:
    """What a row shows without the others."""
    end = text.rstrip("\t\n\x0b\x0c\r ")
    return BLANK if not end else OK if end[-1] in ".!?" else TRUNCATED


def with_duplicates(faults: list[str], digests: list[bytes], earlier: list[bytes] | None) -> list[str]:
    """The faults of a piece once it is known which of its rows earlier pieces have had."""
    met, out = set(earlier or ()), []
    for fault, digest in zip(faults, digests, strict=True):
        out.append(DUPLICATE if digest in met and fault != BLANK else fault)
        met.add(digest)
    return out


def pieces(rows: DataFrame) -> DataFrame:
    """Sorted conversations (``conv``, ``turn``, ``role``, ``text``) in pieces of bounded size, written to the shared folder.

    ``piece`` grows in the order of a conversation's rows. Ranges may cut a conversation; rows that are alike are spread by chance.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        chars = 0

        def out() -> tuple:
            _, turns, roles, texts, digests = map(list, zip(*held, strict=True))
            return held[0][0], turns, roles, texts, list(map(own_fault, texts)), digests

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and (held[0][0] != row[0] or len(held) == PIECE_ROWS or chars > PIECE_CHARS):
                    yield out()
                    held, chars = [], 0
                held.append(row)
                chars += len(row[3])
        if held:
            yield out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(cut(batches), _PIECE)

    # The length tells where the role ends, so different rows never have the same bytes.
    content = F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")
    keyed = rows.withColumn("digest", F.unhex(F.sha2(content, 256))).withColumn("salt", F.rand(7))
    order = ["conv", "turn", "role", "digest", "salt"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = dealt.select("conv", "turn", "role", "text", "digest").mapInArrow(run, _PIECE_DDL)
    # The write settles chance and numbers.
    return store(numbered.withColumn("piece", F.monotonically_increasing_id()), new_folder(rows.sparkSession, "pieces"))


_CARRIED = pa.schema(
    [("conv", pa.string()), ("upper", pa.int64()), ("piece", pa.int64()), ("before", pa.list_(pa.int64())), ("total", pa.list_(pa.int64()))]
)
Value = list[int]


def carried(rows: DataFrame, unit: Value, combine: Callable[[Value, Value], Value], backward: bool = False) -> DataFrame:
    """``conv``, ``piece``, ``before``: what the pieces before it in its conversation combine to (``backward``: those behind it).

    ``rows`` has ``conv``, ``piece`` and ``value``; ``combine`` takes two neighbours in order and is associative. Pieces whose numbers agree
    but for LEVEL_BITS bits are combined in one task, and their results in the same way, until every conversation is one row.
    """
    spark = rows.sparkSession

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in groups(batches, ["conv", "upper"], least=1):
            conv, upper = group.column("conv")[0].as_py(), group.column("upper")[0].as_py()
            listed = sorted(zip(group.column("piece").to_pylist(), group.column("value").to_pylist(), strict=True), reverse=backward)
            total, before = unit, []
            for _, value in listed:
                before.append(total)
                total = combine(value, total) if backward else combine(total, value)
            for i, (piece, _) in enumerate(listed):
                yield conv, upper, piece, before[i], None if i else total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(members(batches), _CARRIED)

    keyed = rows.select("conv", F.shiftright("piece", LEVEL_BITS).alias("upper"), "piece", "value")
    dealt = keyed.repartition("conv", "upper").sortWithinPartitions("conv", "upper")
    here = dealt.mapInArrow(run, "conv string, upper long, piece long, before array<long>, total array<long>")
    here = store(here, new_folder(spark, "carried"))
    heads = here.where("total is not null").select("conv", F.col("upper").alias("piece"), F.col("total").alias("value"))
    if heads.groupBy("conv").count().where("count > 1").isEmpty():
        return here.select("conv", "piece", "before")
    above = carried(heads, unit, combine, backward).select("conv", F.col("piece").alias("upper"), F.col("before").alias("above"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("above").to_pylist(), batch.column("before").to_pylist(), strict=True)
            both = [combine(near, far) if backward else combine(far, near) for far, near in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("piece"), pa.array(both, pa.list_(pa.int64()))], ["conv", "piece", "before"])

    joined = here.join(above, ["conv", "upper"]).select("conv", "piece", "before", "above")
    return store(joined.mapInArrow(join, "conv string, piece long, before array<long>"), new_folder(spark, "carried"))


def _product(a: Value, b: Value) -> Value:
    return times(np.array(a).reshape(4, 4), np.array(b).reshape(4, 4)).ravel().tolist()


def _then(first: Value, second: Value) -> Value:
    """One map of states after the other."""
    return [second[state] for state in first]


def _end_costs(behind: Value | None) -> Costs:
    """Costs by state at the end of a piece, from the matrix of what is behind it."""
    return AT_END if behind is None else tuple((np.array(behind).reshape(4, 4) + np.array(AT_END)).min(1).tolist())


def _symbols(roles: list[str], faults: list[str]) -> list[tuple[str, str]]:
    return [(role[:1], fault) for role, fault in zip(roles, faults, strict=True)]


def _mapped(rows: DataFrame, value: Callable[..., Value], *inputs: str) -> DataFrame:
    """``conv``, ``piece`` and ``value`` of the inputs of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [value(*row) for row in zip(*(batch.column(name).to_pylist() for name in inputs), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("piece"), pa.array(values, pa.list_(pa.int64()))], ["conv", "piece", "value"])

    mapped = rows.select("conv", "piece", *inputs).mapInArrow(run, "conv string, piece long, value array<long>")
    return store(mapped, new_folder(rows.sparkSession, "values"))


def _matrix(roles: list[str], faults: list[str], digests: list[bytes], earlier: list[bytes] | None) -> Value:
    return piece_matrix(_symbols(roles, with_duplicates(faults, digests, earlier))).ravel().tolist()


def _state_map(roles: list[str], faults: list[str], digests: list[bytes], earlier: list[bytes] | None, behind: Value) -> Value:
    symbols = _symbols(roles, with_duplicates(faults, digests, earlier))
    rest = costs_before(symbols, _end_costs(behind))
    return [choose(symbols, rest, state)[2] for state in range(4)]


def surroundings(cut: DataFrame) -> DataFrame:
    """What the pieces of conversations with several ones need to know of the others, by ``piece``.

    ``earlier`` (digests of its rows that an earlier piece has), ``behind`` (matrix of the later pieces), ``enters`` (state
    that the earlier pieces lead to) and ``ends`` (whether it is the last one).
    """
    spark = cut.sparkSession
    several = cut.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.max("piece").alias("final")).where("n > 1")
    several = store(several.select("conv", "final"), new_folder(spark, "several"))
    wide = cut.select("conv", "piece", "roles", "faults", "digests").join(several, "conv")
    # A row that is repeated in a piece is one entry of it, so a hot one is counted once for each piece.
    seen = wide.select("conv", "piece", F.explode(F.array_distinct("digests")).alias("digest"))
    homes = seen.groupBy("conv", "digest").agg(F.min("piece").alias("home"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = seen.join(homes, ["conv", "digest"]).where("piece > home").groupBy("piece").agg(F.collect_list("digest").alias("earlier"))
    wide = store(wide.join(again, "piece", "left"), new_folder(spark, "wide"))
    inputs = ("roles", "faults", "digests", "earlier")
    matrices = _mapped(wide, _matrix, *inputs)
    behind = carried(matrices, _unit().ravel().tolist(), _product, backward=True).select("piece", F.col("before").alias("behind"))
    maps = _mapped(wide.join(behind, "piece"), _state_map, *inputs, "behind")
    enters = carried(maps, list(range(4)), _then).select("piece", F.col("before")[START].alias("enters"))
    found = wide.select("piece", "earlier", (F.col("piece") == F.col("final")).alias("ends")).join(behind, "piece").join(enters, "piece")
    return store(found, new_folder(spark, "surroundings"))


_LINES = "lines array<struct<role: string, text: string>>"
_LONGS = ("rows", "low", "high", "turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost")
_DONE = pa.schema(
    [("conv", pa.string()), ("piece", pa.int64()), ("alone", pa.bool_()), *((name, pa.int64()) for name in _LONGS), ("audit", pa.string()),
     ("lines", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("first_initial", pa.string()), ("last_initial", pa.string())]
)
_DONE_DDL = f"conv string, piece long, alone boolean, {' long, '.join(_LONGS)} long, audit string, {_LINES}, first_initial string, last_initial string"


def illegal(before: str, after: str) -> bool:
    return not before or before + after not in ("su", "ua", "au")


def _finished(conv, piece, turns, roles, texts, faults, digests, earlier, behind, enters, ends) -> tuple:
    alone = ends is None
    faults = with_duplicates(faults, digests, earlier)
    symbols = _symbols(roles, faults)
    rest = costs_before(symbols, _end_costs(behind))
    start = enters or START
    audit, given, state = choose(symbols, rest, start)
    cost, lines, at = rest[0][start] - rest[-1][state], [], 0
    for letter, role in zip(audit, given, strict=True):
        if letter == "I":
            lines.append((role, ""))
            continue
        if letter != "D":
            lines.append((role or roles[at], texts[at]))
        at += 1
    if alone or ends:
        added = tail(state)
        audit += "I" * len(added)
        lines += [(role, "") for role in added]
        cost += INSERT * len(added)
    known = {turn for turn in turns if turn is not None}
    initials = [initial for initial, _ in symbols]
    counts = (faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), sum(map(illegal, initials, initials[1:])), cost)
    return (
        conv, piece, alone, len(roles), min(known, default=None), max(known, default=None), len(known), turns[0], turns[-1], *counts,
        audit, [{"role": role, "text": text} for role, text in lines], initials[0], initials[-1],
    )


@dataclass(frozen=True)
class Repaired:
    """``done`` has a row for each piece; ``kind`` is the type of the conversations' ids."""

    done: DataFrame
    kind: str

    def _id(self) -> Column:
        return F.nullif(F.col("conv"), F.lit("")).cast(self.kind).alias("conv_id")

    def lines(self) -> DataFrame:
        """The repaired conversations: ``conv_id``, ``piece``, ``line`` (order within the piece), ``role``, ``text``."""
        return self.done.select(self._id(), "piece", F.posexplode("lines").alias("line", "said")).select("conv_id", "piece", "line", "said.*")

    def report(self) -> DataFrame:
        """One row for each conversation that has rows; see `repair`."""
        said = F.transform("lines", lambda line: F.concat(line["role"], F.lit(":"), line["text"]))
        body = F.when(F.size("lines") > 0, F.array_join(said, "\n")).alias("body")
        parts = self.done.select("*", body).drop("lines")
        sums = ("blank", "duplicate", "truncated", "illegal", "cost")

        def gaps(low: Column, high: Column, turns: Column) -> Column:
            return F.coalesce(high - low + 1 - turns, F.lit(0)).alias("gaps")

        alone = parts.where("alone").select(
            "conv", gaps(F.col("low"), F.col("high"), F.col("turns")), *sums, "audit",
            F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
        )
        several = parts.where("not alone")
        # At the border of two pieces a turn may be counted twice, and a pair of roles not at all. Rows of this window are pieces.
        previous = Window.partitionBy("conv").orderBy("piece")
        border = several.select(
            "*", F.lag("last_turn").over(previous).alias("turn_before"), F.lag("last_initial").over(previous).alias("initial_before")
        )
        twice = F.when(F.col("turn_before") == F.col("first_turn"), 1).otherwise(0)
        legal = F.concat("initial_before", "first_initial").isin("su", "ua", "au") & (F.col("initial_before") != "")
        crossing = F.when(F.col("initial_before").isNotNull() & ~legal, 1).otherwise(0)
        summed = (
            border.withColumn("illegal", F.col("illegal") + crossing)
            .groupBy("conv")
            .agg(
                gaps(F.min("low"), F.max("high"), F.sum(F.col("turns") - twice)),
                *(F.sum(name).alias(name) for name in sums),
                F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"),
            )
        )
        joined = alone.unionByName(summed.join(digests(several), "conv"))
        return joined.select(self._id(), *(name for name in joined.columns if name != "conv"))


def digests(parts: DataFrame) -> DataFrame:
    """``conv`` and the SHA-256 of its pieces' ``body``, joined by line breaks; nulls are passed over.

    A hash has to see its bytes in order: they pass through one task for each conversation, as a stream of pieces.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
        at, state, empty = None, hashlib.sha256(), True
        for batch in batches:
            for conv, body in zip(batch.column(0), batch.column(1), strict=True):
                if at != (conv := conv.as_py()):
                    if at is not None:
                        yield at, state.hexdigest()
                    at, state, empty = conv, hashlib.sha256(), True
                if (body := body.as_py()) is not None:
                    state.update(body if empty else b"\n" + body)
                    empty = False
        if at is not None:
            yield at, state.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(hashed(batches), pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())]))

    dealt = parts.select("conv", F.col("body").cast("binary").alias("body"), "piece").repartition("conv").sortWithinPartitions("conv", "piece")
    return dealt.select("conv", "body").mapInArrow(run, "conv string, repaired_sha256 string")


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest repair of every conversation, as lines and as a report.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text seen earlier), truncated (its last
    character but white space is not one of ``.!?``). Edits: keep a row (0), give it the role user or assistant (3), delete it (4; blank and
    duplicate rows have to go), put in an empty row of user or assistant (3); a truncated row that stays costs 3 more.

    The report has ``conv_id``; ``gaps`` (turns missing between the smallest and the largest one); the number of ``blank``, ``duplicate`` and
    ``truncated`` rows and of ``illegal`` neighbours (initials of roles other than su, ua, au); ``cost``; ``audit``, the edits in order by their
    initials (K, R, D, I), the ASCII-least of the cheapest; and ``repaired_sha256`` of the lines ``role:text``.

    Rows are ordered by turn, nulls first; equal turns by role and then by the SHA-256 of role and text, so that repeated rows are neighbours. Null
    roles and texts count as one space: such a text is blank, and such a role cannot be kept, no more than an empty one. Rows whose id is null are one
    conversation. Null turns are left out of ``gaps`` (0 if there are no others). Other columns are ignored; an empty table gives empty results.

    Conversations are sorted in ranges and cut into pieces (`pieces`), whatever their length. A conversation's audit is one value of its report and
    its hash reads all its lines in order; nothing else of it comes together in one place.
    """
    session_of(rows)
    spaced = (F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(to) for name, to in ((role, "role"), (text, "text")))
    conv = F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("conv")
    cut = pieces(rows.select(conv, F.col(turn).cast("long").alias("turn"), *spaced))
    known = surroundings(cut)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 32):
                yield _batch([_finished(*row) for row in zip(*(column.to_pylist() for column in part.columns), strict=True)], _DONE)

    joined = cut.join(known, "piece", "left")
    given = ("conv", "piece", "turns", "roles", "texts", "faults", "digests", "earlier", "behind", "enters", "ends")
    done = store(joined.select(*given).mapInArrow(finish, _DONE_DDL), new_folder(rows.sparkSession, "repaired"))
    return Repaired(done, dict(rows.dtypes)[conv_id])
