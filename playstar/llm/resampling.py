"""Importance resampling: documents are drawn towards the word distribution of a target."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of, slices
from playstar.operators.keys import ranked_keys
from playstar.session import new_folder, store

#: Most buckets of features: the gains travel with every task as one array.
MOST_BUCKETS = 1_000_000
#: Rows of which one median is taken; so many are also ordered directly at the end of a selection.
RUN_ROWS = 10_000

# Letters in lower case, digits and all bytes beyond ASCII make words; the rest separates them.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


def feature_buckets(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` words, repeats included."""
    found, ends = [], list(map(crc32, words))
    for more in range(1, longest + 1):
        found.append(np.array(ends, np.uint32))
        if more < longest:  # a run's checksum goes on from that of the run one word shorter
            ends = list(map(crc32, words[more:], map(crc32, repeat(b" "), ends)))
    return np.concatenate(found) % np.uint32(buckets)


def _texts(rows: DataFrame, text: str, *others: Column) -> DataFrame:
    return rows.select(*others, F.col(text).cast("string").cast("binary").alias("text"))


def bucket_counts(rows: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """``bucket``, ``n`` over all texts; each task sends one row for each bucket it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                seen += np.bincount(feature_buckets(words_of(value.as_py()), longest, buckets), minlength=buckets)
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(seen[met])], ["bucket", "n"])

    return _texts(rows, text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """For each bucket floor(1000 ln) of its share in ``target`` over its share in ``docs``, one added to every bucket."""
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {MOST_BUCKETS}")
    own = bucket_counts(docs, text, longest, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    wanted = bucket_counts(target, text, longest, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    both = own.union(wanted).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in both:  # one row for each bucket at most
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    share = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` (floored mean of the gains) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = np.zeros((3, part.num_rows), np.int64)
                for i, value in enumerate(part.column(1)):
                    words = words_of(value.as_py())
                    if words:
                        found = feature_buckets(words, longest, len(gain))
                        rows[:, i] = len(words), len(found), gain[found].sum() // len(found)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, rows)], ["doc_id", "n_words", "n_features", "weight"])

    given = _texts(docs, text, F.col(doc_id).cast("long").alias("doc_id"))
    return given.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, floored, that depends on the seed and the id only; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296))).cast("long")


def _medians(rows: DataFrame, key: list[str]) -> DataFrame:
    """For every RUN_ROWS rows of a task their weighted median key, with the weight of all of them."""
    names = [*key, "rows"]

    def median(table: pa.Table) -> pa.RecordBatch:
        columns = [table.column(name).to_numpy() for name in names]
        order = np.lexsort(columns[-2::-1])
        reached = np.cumsum(columns[-1][order])
        middle = order[np.searchsorted(reached, (reached[-1] + 1) // 2)]
        values = [*(c[middle] for c in columns[:-1]), reached[-1]]
        return pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in values], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in slices(batch, RUN_ROWS):
                if part.num_rows + sum(b.num_rows for b in held) > RUN_ROWS:
                    yield median(pa.Table.from_batches(held))
                    held = []
                if part.num_rows:
                    held.append(part)
        if held:
            yield median(pa.Table.from_batches(held))

    return rows.select(*names).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def key_at(rows: DataFrame, key: list[str], place: int) -> tuple[int, ...]:
    """The key of the row at ``place`` (from 1) in the order of the long columns ``key``, which are never null.

    Selection by medians of medians: each run of rows gives its median, the runs' medians weighted by their sizes
    give a pivot, and the side of the pivot that cannot hold the place is discarded, a quarter of the rows at least
    (an eighth where medians are so many that they are reduced twice).
    The driver sees a pivot and two counts a round. What is left is written, so a lost task costs a round's part only.
    """
    spark = rows.sparkSession
    left = rows.select(*(F.col(k).cast("long").alias(k) for k in key))
    size = left.count()
    if not 1 <= place <= size:
        raise ValueError(f"place {place} of {size} rows")
    here = F.struct(*key)
    while size > RUN_ROWS:
        middle = store(_medians(left.withColumn("rows", F.lit(1).cast("long")), key), new_folder(spark, "medians"))
        while (runs := middle.count()) > 1:
            middle = store(_medians(middle.repartition(-(-runs // RUN_ROWS)), key), new_folder(spark, "medians"))
        pivot = tuple(middle.first()[k] for k in key)
        at = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip(key, pivot, strict=True)))
        below, same = left.agg(F.count_if(here < at), F.count_if(here == at)).first()
        if below < place <= below + same:
            return pivot
        if place <= below:
            left, size = left.where(here < at), below
        else:
            left, size, place = left.where(here > at), size - below - same, place - below - same
        left = store(left, new_folder(spark, "remaining"))
    return tuple(left.orderBy(*key).offset(place - 1).first())


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    seed: int = 7,
    longest: int = 2,
    buckets: int = 10_000,
    least_words: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    Words are runs of letters (A-Z in lower case), digits and characters beyond ASCII. Features are all runs
    of 1 to ``longest`` words, hashed to ``buckets`` (CRC-32). A bucket's gain is the logarithm of its share in ``target`` over that
    in ``docs``; a row's weight is the floored mean over its features and its score adds a Gumbel draw of its id, so
    that the highest scores are a sample without replacement in proportion to exp(weight / 1000). Of the N rows with
    ``least_words`` or more, floor(``percent`` * N / 100) have a ``rank``, from 1 for the highest score.

    Texts are read twice: for the counts, and for the weights, which are looked up in one array. The score of the last
    rank is found by `key_at`; only winners are sorted, in ranges. Nothing is drawn by task or by group, so a hot
    source or id changes nothing.

    Null and empty texts, and texts without words, have no features and weight 0. Ties go to the smaller id, nulls last,
    then to fewer features; rows alike in all of that are alike in the result but for their ranks. Repeated
    ids and rows each count. Other columns are ignored. Without a target text all gains follow from ``docs`` alone; an empty ``docs``
    gives an empty result.
    """
    spark = session_of(docs)
    gain = gains(docs, target, text, longest, buckets)
    scored = weights(docs, gain, longest, doc_id, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = store(scored, new_folder(spark, "scored"))
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    none = F.lit(None).cast("long").alias("rank")
    if drawn <= 0:
        return scored.select("*", none)
    key = {
        "_down": -F.col("score"),
        "_no_id": F.col("doc_id").isNull().cast("long"),
        "_id": F.coalesce("doc_id", F.lit(0)),
        "_more": F.col("n_features"),
    }
    keyed = eligible.withColumns(key)
    last = key_at(keyed, list(key), drawn)
    until = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip(key, last, strict=True)))
    place = F.struct(*(column.cast("long").alias(k) for k, column in key.items()))
    wins = (F.col("n_words") >= least_words) & (place <= until)
    winners = ranked_keys(scored.where(wins).withColumns(key), "rank", list(key)).drop(*key)
    # Rows alike in all that the order sees may stand on both sides of the last rank.
    winners = winners.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return winners.select(*scored.columns, "rank").union(scored.where(~wins).select("*", none))
