"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, value: int) -> Column:
    """True for the fold that nothing is learned from; a null id belongs to the learning fold."""
    return F.coalesce(remainder(doc_id, modulus) == value, F.lit(False))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Number rows of a written table; rows that repeat in every column stay apart."""
    return df.withColumn(name, F.monotonically_increasing_id())


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by ``keys`` to all shuffle partitions, where little data is much work and merging partitions by size would idle cores."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pieces(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``max_bytes``, or one row."""
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
