"""JSON files as staging rows, with a path mapping and an error budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from playstar.functions.text import is_blank, lenient_cast
from playstar.schemas import PathMapping
from playstar.session import store

CORRUPT = "_corrupt_record"
REJECTED = "_rejected"
ERRORS = "_errors"
#: What a parsed record has beside its mapped columns.
VERDICT = (REJECTED, CORRUPT, ERRORS)
ERRORS_TYPE = "array<struct<column: string, value: string, reason: string>>"
BROKEN = "not JSON"


class TooManyErrors(RuntimeError):
    """More bad records than the load allows."""


@dataclass(frozen=True)
class Loaded:
    """Outcome of a load: the good rows, and the bad ones with their errors and raw text."""

    rows: DataFrame
    rejected: DataFrame


def read_mapping(spark: SparkSession, table: str, path: str) -> PathMapping:
    """A mapping from a ``{"jsonpaths": [...]}`` file."""
    listed = spark.read.option("multiLine", True).schema("jsonpaths array<string>").json(path).first()
    return PathMapping(table, tuple(listed["jsonpaths"]))


def _typed(raw: dict[str, Column], mapping: PathMapping, corrupt: Column, text: Column) -> list[Column]:
    """Typed columns, the flag of records that have to be rejected (broken JSON, or text in a typed
    column that is no such value), and for those records what was wrong, with the text as it came."""
    columns, bad, wrong = [], corrupt, []
    for path, field in mapping.columns():
        value = lenient_cast(raw[path], field.dataType)
        if not isinstance(field.dataType, StringType):
            misfit = ~is_blank(raw[path]) & value.isNull()
            reason = F.lit(f"not {field.dataType.simpleString()}").alias("reason")
            wrong.append(F.when(misfit, F.struct(F.lit(field.name).alias("column"), raw[path].alias("value"), reason)))
            bad = bad | misfit
        columns.append(value.alias(field.name))
    broken = F.struct(F.lit(None).cast("string").alias("column"), text.alias("value"), F.lit(BROKEN).alias("reason"))
    found = F.when(corrupt, F.array(broken)).otherwise(F.filter(F.array(*wrong), lambda error: error.isNotNull()))
    return [*columns, bad.alias(REJECTED), F.when(bad, found).cast(ERRORS_TYPE).alias(ERRORS)]


def parse_json(
    reader: DataFrameReader | DataStreamReader | None,
    paths: str | list[str],
    mapping: PathMapping,
    by_name: bool = False,
    spark: SparkSession | None = None,
) -> DataFrame:
    """All records of the files: mapped columns, rejection flag, errors, raw bad text.

    ``reader`` is ``spark.read`` or ``spark.readStream``; without one the result is empty. Scalars are read as
    text and converted afterwards, because the reader's own INT turns a quoted
    number into NULL and calls the whole record corrupt. ``by_name`` takes the keys
    that are named like the columns, instead of the mapping's paths.
    """
    if by_name:
        mapping = named_like_columns(mapping)
    keys = mapping.top_level_keys()
    if reader is None:
        schema = "".join(f"`{path}` string, " for path in mapping.paths) + f"{CORRUPT} string"
        none = spark.createDataFrame([], schema)
        raw = {path: F.col(f"`{path}`") for path in mapping.paths}
        return none.select(*_typed(raw, mapping, F.col(CORRUPT).isNotNull(), F.col(CORRUPT)), CORRUPT)
    reader = reader.option("recursiveFileLookup", True)
    if keys is None:
        lines = reader.text(paths).where(F.trim("value") != "")
        raw = {path: F.get_json_object("value", path) for path in mapping.paths}
        broken = F.expr("try_parse_json(value)").isNull()
        return lines.select(*_typed(raw, mapping, broken, F.col("value")), F.when(broken, F.col("value")).alias(CORRUPT))
    fields = [StructField(key, StringType()) for key in dict.fromkeys(keys)]
    records = reader.schema(StructType([*fields, StructField(CORRUPT, StringType())])).json(
        paths, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    raw = {path: records[key] for path, key in zip(mapping.paths, keys)}
    return records.select(*_typed(raw, mapping, F.col(CORRUPT).isNotNull(), F.col(CORRUPT)), CORRUPT)


# The file a record came from, as it was when it was read, and the time of reading.
SOURCE = ("_file", "_length", "_modified", "_read_at")
SOURCE_TYPES = "_file string, _length bigint, _modified timestamp, _read_at timestamp"


def with_source(parsed: DataFrame) -> DataFrame:
    """Parsed records with the columns `SOURCE`.

    The path is spelled as a file listing spells it. ``_read_at`` is taken in the task, record by
    record, so the largest one of a file tells when the file was done.
    """
    # Decoding would take a plus for a space.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    clock = F.java_method(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint")
    return parsed.select(
        "*",
        path.alias("_file"),
        F.col("_metadata.file_size").alias("_length"),
        F.col("_metadata.file_modification_time").alias("_modified"),
        F.timestamp_millis(clock).alias("_read_at"),
    )


def load_errors(staged: DataFrame) -> DataFrame:
    """What was wrong with the rejected records: ``filename``, ``column`` (null for broken JSON), ``value`` (the raw text of the
    column, or of the record), ``length`` (its bytes) and ``reason``; a record has a row for each column in error.

    ``staged`` are written records with their source; nothing is parsed again.
    """
    wrong = staged.where(REJECTED).select(F.col("_file").alias("filename"), F.explode(ERRORS).alias("error"))
    return wrong.select(
        "filename", "error.column", "error.value", F.octet_length("error.value").cast("bigint").alias("length"), "error.reason"
    )


def named_like_columns(mapping: PathMapping) -> PathMapping:
    """The mapping of records whose keys are the column names."""
    return PathMapping(mapping.table, tuple(f"$['{field.name}']" for _, field in mapping.columns()))


def match_by_name(text: Column, mapping: PathMapping) -> Column:
    """JSON text as a struct whose fields are found by column name."""
    fields = [StructField(field.name, StringType()) for _, field in mapping.columns()]
    return F.from_json(text, StructType(fields))


def accept(staged: DataFrame, table: str, max_errors: int) -> Loaded:
    """Split written records into good and bad; ``max_errors`` bad ones are too many.

    JSON has been parsed once by the write; the count reads the flag column of
    that Parquet and nothing else.
    """
    bad = staged.where(REJECTED)
    n_bad = bad.count()
    if n_bad >= max_errors:
        raise TooManyErrors(f"{n_bad} bad records in {table}, limit is {max_errors}")
    return Loaded(staged.where(~F.col(REJECTED)).drop(*VERDICT, *SOURCE), bad.drop(REJECTED))


def load_json(
    spark: SparkSession,
    paths: str | list[str],
    mapping: PathMapping,
    target: str,
    max_errors: int = 1,
    by_name: bool = False,
) -> Loaded:
    """Stage JSON files as Parquet in the folder ``target``; the default tolerates no bad record."""
    return accept(store(parse_json(spark.read, paths, mapping, by_name), target), mapping.table, max_errors)


class ErrorBudget:
    """The same limit for records that go straight into a table.

    Bad records are dropped and counted by the write itself, so nothing is
    stored twice; ``check`` tells afterwards whether the table may be used.
    """

    def __init__(self, table: str, max_errors: int = 1):
        self.table = table
        self.max_errors = max_errors
        self._seen = Observation()

    def watch(self, parsed: DataFrame) -> DataFrame:
        watched = parsed.observe(self._seen, F.count_if(F.col(REJECTED)).alias("bad"))
        return watched.where(~F.col(REJECTED)).drop(*VERDICT)

    def check(self) -> None:
        n_bad = self._seen.get["bad"]
        if n_bad >= self.max_errors:
            raise TooManyErrors(f"{n_bad} bad records in {self.table}, limit is {self.max_errors}")
