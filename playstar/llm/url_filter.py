"""Allow and block rules for urls, by a sort-merge range join of urls with rules."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstar.llm.common import session_of

#: Urls, on average, from which the borders of the ranges are taken. Borders balance the work; they change no result.
SAMPLE_URLS = 8_000
RANGES_PER_PARTITION = 8
#: After every key that begins with the same text.
LAST = "\U0010ffff"

CELLS = "range int, key string, kind int, path string, page_id long, host string, rule string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    after = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(after) + 4, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.contains(url, F.lit("://")), lower).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    after = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(after) + 4, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), path).otherwise(F.lit(""))


def canonical_key(host: Column) -> Column:
    """The host's labels from the last to the first, each with a dot behind: a domain's key begins the keys of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


@dataclass
class Frame:
    """The rules of one host, while urls of it and its subdomains pass."""

    key: str
    rules: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)

    def add(self, path: str, rule: str, verdict: str) -> None:
        # A rule given twice with both verdicts blocks.
        if path not in self.rules or verdict == "block":
            self.rules[path] = (rule, verdict)
        self.lengths.clear()

    def longest(self, path: str) -> tuple[str, str] | None:
        if not self.lengths:  # all rules of a host come before its urls, so this is done once
            self.lengths = sorted({len(path) for path in self.rules}, reverse=True)
        return next((self.rules[path[:n]] for n in self.lengths if path[:n] in self.rules), None)


def judge(
    urls: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of every url.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all subdomains if the
    url's path starts with its path; of several the longest text (host and path) wins, then the longer host. Other
    urls get ``default``.

    Keys are reversed hosts, so a rule's host is an interval of keys. Urls are dealt out to ranges of
    (key, path, hash of the id), which splits a crowded host or url; a rule goes to each range that its
    interval meets. Each range is sorted and swept once with a stack of the nested rules' hosts that are active at
    a key. Neither side is broadcast or collected.

    Null urls, and urls without ``://``, have an empty host and path and get ``default``. Repeated rows
    and ids, and null ids, each give their row. Rules with a null part are ignored. Other columns are ignored; empty
    tables are fine on both sides.
    """
    spark = session_of(urls)
    link = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pages = urls.select(F.col(page_id).cast("long").alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"))
    pages = pages.withColumn("key", canonical_key(F.col("host")))
    salt = F.coalesce(F.xxhash64("page_id"), F.lit(0))
    # Drawn by share, so that each task sends its part only; the draw decides how even the ranges are, and no result.
    share = min(1.0, SAMPLE_URLS / max(1, urls.count()))
    sample = pages.select("key", "path", salt.alias("salt")).sample(share, seed=1).collect()
    places = sorted(tuple(row) for row in sample)
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = sorted({places[len(places) * i // ranges] for i in range(1, ranges)}) if places else []

    def deal_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = zip(*(batch.column(c).to_pylist() for c in ("key", "path", "salt")), strict=True)
            chosen = pa.array([bisect_right(borders, p) for p in place], pa.int32())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [chosen, batch.column("key"), pa.array([1] * n, pa.int32()), batch.column("path"), batch.column("page_id"),
                 batch.column("host"), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
                [f.split()[0] for f in CELLS.split(", ")],
            )

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                first, last = bisect_left(borders, (r["key"],)), bisect_left(borders, (r["key"] + LAST,))
                rows += [{**r, "range": k, "kind": 0} for k in range(first, last + 1)]
            names = [f.split()[0] for f in CELLS.split(", ")]
            kinds = {"range": pa.int32(), "kind": pa.int32(), "page_id": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names
            )

    given = rules.select(*(F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict"))).dropna()
    given = given.select("host", "path", "verdict", canonical_key(F.col("host")).alias("key"), F.concat("host", "path").alias("rule"))
    cells = pages.withColumn("salt", salt).mapInArrow(deal_pages, CELLS).union(given.mapInArrow(deal_rules, CELLS))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Frame] = []
        at = None
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for where, key, kind, path, page, host, rule, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if where != at:
                    at, stack = where, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(Frame(key))
                    stack[-1].add(path, rule, verdict)
                    continue
                # Deeper frames have longer hosts: they win ties.
                fitting = [found for frame in reversed(stack) if (found := frame.longest(path))]
                best = max(fitting, key=lambda found: len(found[0]), default=(None, default))
                for column, value in zip(out, (page, host, path, *best), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), *(pa.array(column, pa.string()) for column in out[1:])],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    dealt = cells.repartition("range").sortWithinPartitions("range", "key", "kind", "path")
    return dealt.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table, from (host, path, verdict)."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")
