"""Ledger text files, prepared split tables, fingerprints and traffic rows."""

from __future__ import annotations

import csv
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from finsieve.constants import (
    LEDGER_HEADER, LEDGER_TS_FORMAT, TRAFFIC_AMOUNTS, TRAFFIC_COUNTS, TRAFFIC_FORMATS, TX_COLUMNS,
)

_TYPES = {
    "from_bank": T.LongType(), "to_bank": T.LongType(),
    "amount_received": T.DoubleType(), "amount_paid": T.DoubleType(), "is_laundering": T.IntegerType(),
}
CORRUPT = "_corrupt_record"
#: Bytes per read of a header.
HEADER_READ = 1 << 16


class HeaderError(ValueError):
    """A ledger file's header lacks columns of the contract, or files disagree; the message names them."""


def _first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over file paths: the first line of each file, read no further than that."""
    for batch in batches:
        lines = []
        for path in batch.column(0).to_pylist():
            system, at = pa_fs.FileSystem.from_uri(path)
            head = b""
            with system.open_input_stream(at, compression="detect", buffer_size=None) as stream:
                while b"\n" not in head and b"\r" not in head and (more := stream.read(HEADER_READ)):
                    head += more
            lines.append((head.splitlines() or [b""])[0].decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["h"])


def text_header(spark: SparkSession, path: str) -> list[str]:
    """The column names of the ledger text under ``path``, a repeated one with ``.1`` behind it.

    All files that are not empty must have the same header. Files are listed and tasks read the
    first bytes of each, so the text itself is scanned only once, for its rows.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path")
    firsts = files.mapInArrow(_first_lines, "h string").filter("h <> ''").distinct().limit(2).collect()
    if len(firsts) != 1:
        raise HeaderError("the files have different headers" if firsts else "there is no header")
    names = next(csv.reader([firsts[0].h.lstrip("\ufeff")]))
    return [f"{n}.1" if n in names[:i] else n for i, n in enumerate(names)]


def text_schema(names: list[str]) -> tuple[T.StructType, dict[str, str]]:
    """The schema of a file with these column names, and its name for every contract column.

    Columns off the contract are read as text. All missing names are reported at once.
    """
    wanted = dict(zip(LEDGER_HEADER, TX_COLUMNS))
    missing = [n for n in wanted if n not in names]
    if missing:
        raise HeaderError(f"missing columns: {', '.join(missing)}")
    fields = [T.StructField(f"_{i}", _TYPES.get(wanted.get(n, ""), T.StringType())) for i, n in enumerate(names)]
    return T.StructType(fields), {c: f"_{names.index(n)}" for n, c in wanted.items()}


def scan_ledger_text(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Read ledger CSV: a file, a folder or a glob. A path that is not there fails and is named.

    Columns are found by name in the header, in any order and among others; of a name that
    the contract has twice the second is the counterparty's. In PERMISSIVE mode rows that do
    not fit keep their text in ``_corrupt_record``. Timestamps stay text here;
    ``parse_timestamps`` turns them into values.
    """
    schema, at = text_schema(text_header(spark, path))
    kept = [F.col(at[c]).alias(c) for c in TX_COLUMNS]
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        kept.append(F.col(CORRUPT))
    rows = spark.read.schema(schema).options(header=True, enforceSchema=True, mode=mode, columnNameOfCorruptRecord=CORRUPT)
    return rows.csv(path).select(*kept)


def headed(line: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over one text column: put ``line`` in front of each task's rows."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array([line], batch.schema.field(0).type)], names=["value"])
            first = False
            yield batch
    return add


def parse_timestamps(df: DataFrame, strict: bool = True) -> DataFrame:
    """Parse ``ts``; strict fails the job on bad text, otherwise it becomes null."""
    if strict:
        return df.withColumn("ts", F.to_timestamp("ts", LEDGER_TS_FORMAT))
    return df.withColumn("ts", F.try_to_timestamp(F.col("ts"), F.lit(LEDGER_TS_FORMAT)))


def write_ledger_text(df: DataFrame, path: str, extra: tuple[str, ...] = ()) -> None:
    """Write ledger CSV under the contract's header; ``extra`` columns go first."""
    cells = [F.date_format(c, LEDGER_TS_FORMAT) if c == "ts" else F.col(c) for c in TX_COLUMNS]
    df.select(*extra, *[c.alias(n) for c, n in zip(cells, LEDGER_HEADER)]).write.mode("overwrite").option("header", True).csv(path)


def write_prepared(df: DataFrame, path: str) -> None:
    """Write the split table partitioned by ``split``, so a fold is read by partition pruning.

    Every task writes its rows of each fold; a table that is there is replaced.
    """
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_prepared(spark: SparkSession, path: str, fold: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("split") == fold) if fold else df


def fingerprint(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Order-free digest of a table: the row count and a sum and xor over row digests."""
    digest = F.xxhash64(*columns)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(digest.cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor(digest).alias("digest_xor"),
    )


def synthetic_traffic(spark: SparkSession) -> DataFrame:
    """Deterministic monitoring requests: each format with each (amount, count) pair."""
    formats = F.array(*[F.lit(x) for x in TRAFFIC_FORMATS])
    pairs = F.array(*[
        F.struct(F.lit(a).alias("amount_paid"), F.lit(c).cast("long").alias("sender_previous_tx_count"))
        for a, c in zip(TRAFFIC_AMOUNTS, TRAFFIC_COUNTS)
    ])
    rows = (
        spark.range(1).select(F.posexplode(formats).alias("f", "payment_format"))
        .select("*", F.posexplode(pairs).alias("i", "pair"))
    )
    return rows.select(
        "payment_format", "pair.amount_paid", "pair.sender_previous_tx_count",
        ((F.col("i") + F.col("f")) % 2).alias("is_business_hours"),
        ((F.col("i") + F.col("f")) % 3 == 0).cast("int").alias("same_account"),
    )


class AggregateOnlyError(ValueError):
    """A report would carry row-level values."""


ROW_LEVEL_COLUMNS = frozenset({"row_id", "correlationid", "account", "counterparty", "input", "output"})


def write_report(df: DataFrame, path: str) -> None:
    """Write an aggregate frame as JSON in place of an older one; frames with row-level columns are refused."""
    found = sorted(set(_names(df.schema)) & ROW_LEVEL_COLUMNS)
    if found:
        raise AggregateOnlyError(f"reports hold aggregates only, found {found}")
    df.write.mode("overwrite").json(path)


def _names(schema: T.DataType) -> list[str]:
    node = json.loads(schema.json())
    found: list[str] = []

    def walk(x: object) -> None:
        if isinstance(x, dict):
            if "name" in x:
                found.append(x["name"])
            for v in x.values():
                walk(v)
        elif isinstance(x, list):
            for v in x:
                walk(v)

    walk(node)
    return found
