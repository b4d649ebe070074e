"""Table scans and optional JDBC access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES, conform


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan one of the known tables; a missing or uncastable column fails at analysis."""
    return conform(spark.read.format(fmt).load(path), TABLES[name])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel scan of a database table, one range of ``partition_column`` per task."""
    return (
        spark.read.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .option("fetchsize", fetch_size)
        .load()
    )


def key_ranges(bounds: Sequence[str], column: str = "pmid") -> list[str]:
    """SQL conditions that cut a text key at sorted bounds: each key, null too, meets exactly one.

    The bounds are any texts, such as the deciles of an earlier load (``key_bounds``). The database must compare
    the column as the bounds are sorted, by code point (collation ``C``); a null key goes to the last range.
    """
    if list(bounds) != sorted(set(bounds)):
        raise ValueError("bounds must be distinct and sorted by code point")
    texts = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not texts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]}", *middle, f"({column} >= {texts[-1]} OR {column} IS NULL)"]


def key_bounds(keys: DataFrame, ranges: int, column: str = "pmid", sample: int = 100_000) -> list[str]:
    """Bounds that cut the keys of a table into ranges of about equal size.

    From a sample of about ``sample`` keys, those with the smallest hashes, so that equal tables
    give equal bounds; the ranges' sizes are approximate, what they cover is exact.
    """
    distinct = keys.select(column).where(F.col(column).isNotNull())
    held = sorted({r[0] for r in distinct.orderBy(F.xxhash64(column), column).limit(sample).collect()})
    cuts = {held[len(held) * i // ranges] for i in range(1, ranges)} if held else set()
    return sorted(cuts - {held[0]} if held else cuts)


def read_jdbc_by_key(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    bounds: Sequence[str],
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel scan of a database table with a text key, one range of keys per task."""
    options = {**(properties or {}), "fetchsize": str(fetch_size)}
    return spark.read.jdbc(url, table, predicates=key_ranges(bounds, key), properties=options)


def jdbc_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, the form a database's JSON columns take."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    connections: int = 16,
    batch_size: int = 5_000,
    properties: dict[str, str] | None = None,
) -> None:
    """Append to a database table over at most ``connections`` connections.

    ``stringtype=unspecified`` lets the server read JSON text into JSON columns.
    """
    sep = "&" if "?" in url else "?"
    (
        jdbc_ready(df)
        .write.format("jdbc")
        .options(**(properties or {}))
        .option("url", f"{url}{sep}stringtype=unspecified")
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
