"""Database tables through Spark's JDBC source.

The builders return plain option maps, so that they can be checked without a database.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, table: str, column: str = "timestamp", lower: str | None = None,
    upper: str | None = None, partitions: int = 1, properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for a scan split over ranges of `column`, one query per partition (SRC3)."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if partitions > 1:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs lower and upper bounds")
        options |= {
            "partitionColumn": column, "lowerBound": lower, "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return options


def write_options(
    url: str, table: str, batch_rows: int = 1000, column_types: str | None = None,
    truncate: bool = False, properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for replacing a table with batched inserts (SNK2, SNK3, SNK4)."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **(properties or {})}
    if truncate:
        options["truncate"] = "true"
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


# times without a zone, temperatures with their two decimals
WEATHER_COLUMN_TYPES = "timestamp TIMESTAMP_NTZ, outdoor_temp_c DECIMAL(6, 2), day_type STRING"


def bounds_query(table: str, column: str, partitions: int) -> str:
    """A query for the least value of each of `partitions` equally filled ranges of a column, in order (SRC3)."""
    quoted = f'"{column}"'
    return (
        f"SELECT min({quoted}) AS bound FROM (SELECT {quoted}, ntile({partitions}) OVER (ORDER BY {quoted}) AS part "
        f"FROM {table} WHERE {quoted} IS NOT NULL) AS parts GROUP BY part"
    )


def _literal(value: object) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """One condition per range between bounds: every row fulfils exactly one; rows without a value are in the first."""
    quoted = f'"{column}"'
    inner = [_literal(b) for b in sorted(set(bounds))[1:]]
    if not inner:
        return ["1 = 1"]
    middle = [f"{quoted} >= {lo} AND {quoted} < {hi}" for lo, hi in zip(inner[:-1], inner[1:], strict=True)]
    return [f"{quoted} < {inner[0]} OR {quoted} IS NULL", *middle, f"{quoted} >= {inner[-1]}"]


def read_in_ranges(
    spark: SparkSession, url: str, table: str, column: str = "timestamp", partitions: int = 1, properties: dict[str, str] | None = None
) -> DataFrame:
    """A table read by one query per equally filled range of a column, whose bounds the database finds first."""
    bounds = read_table(spark, {"url": url, "query": bounds_query(table, column, partitions), **(properties or {})})
    found = [r[0] for r in bounds.collect()]  # one row a range
    return spark.read.jdbc(url, table, predicates=range_predicates(column, found), properties=properties or {})


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def replace_table(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").mode("overwrite").options(**options).save()
