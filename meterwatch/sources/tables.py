"""File sources and sinks, schema resolution and ingest cleaning."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch import schemas
from meterwatch.functions.text import sql

# Accepted header names per telemetry column, best first.
TELEMETRY_ALIASES: Mapping[str, Sequence[str]] = {
    "asset_id": ("asset_id", "mac_address"),
    "total_power_kw": ("total_power_kw", "total_power"),
    "indoor_co2_ppm": ("indoor_co2_ppm", "co2_ppm", "co2"),
    "indoor_temp_c": ("indoor_temp_c", "in_temp", "indoor_temp"),
}


#: Text that stands for a missing value in the input files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


MONTH = "trunc(to_date(timestamp), 'MM')"


def read_csv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Strictly typed CSV scan: a malformed value fails the job (SRC1, PRE1)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # header names must match, not only positions
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss]")
        .option("escape", '"')
        .csv(path)
    )


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text, header names stripped (PRE3)."""
    return strip_headers(spark.read.option("header", True).option("escape", '"').csv(path))


def read_optional(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """A CSV or Parquet table, or an empty one of the same schema when the path is absent (SRC2)."""
    try:
        return read_csv(spark, path, schema) if fmt == "csv" else conform(strip_headers(spark.read.parquet(path)), schema, ("label",))
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def resolve_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first matching alias of each column to its canonical name (PRE4)."""
    present = {name.lower(): name for name in df.columns}
    renames = {}
    for wanted, names in aliases.items():
        found = next((present[n.lower()] for n in names if n.lower() in present), None)
        if found is None:
            raise ValueError(f"no column for {wanted}: expected one of {', '.join(names)}")
        renames[found] = wanted
    return df.withColumnsRenamed(renames)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN readings become null: Spark sorts NaN above every number."""
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.selectExpr(*[f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" if c in floats else c for c in df.columns])


def present(df: DataFrame, column: str) -> bool:
    return column in df.columns


def cast_values(df: DataFrame, schema: str, optional: Sequence[str] = (), cast: str = "CAST") -> list[tuple[str, str | None, str, str]]:
    """Name, given value (None if the column is absent), cast value and type of every column of a schema.

    Text that stands for a missing value is null, also in numbers; whole numbers may be written with a decimal point.
    """
    missing = ", ".join(f"'{m}'" for m in MISSING)
    kinds = dict(df.dtypes)
    made = []
    for f in T.StructType.fromDDL(schema):
        kind = f.dataType.simpleString()
        if not present(df, f.name) and f.name in optional:
            made.append((f.name, None, f"CAST(NULL AS {kind})", kind))
            continue
        given = f"CASE WHEN {f.name} NOT IN ({missing}) THEN {f.name} END" if kinds.get(f.name) == "string" else f.name
        value = given
        if kind in ("bigint", "int") and kinds.get(f.name) not in ("bigint", "int"):
            # long ids are not squeezed through a floating-point number
            value = f"coalesce(try_cast({given} AS BIGINT), {cast}(nanvl({cast}({given} AS DOUBLE), NULL) AS BIGINT))"
            if kinds.get(f.name) != "string":
                value = f"nanvl({cast}({given} AS DOUBLE), NULL)"
        made.append((f.name, given, f"{cast}({value} AS {kind})", kind))
    return made


def conform(df: DataFrame, schema: str, optional: Sequence[str] = ()) -> DataFrame:
    """Cast columns by name to a fixed schema: strict on values, free in column order.

    Missing optional columns become null, and so does text that stands for a missing value, also in numbers; whole
    numbers may be written with a decimal point.
    """
    return nan_to_null(df.selectExpr(*[f"{value} AS {name}" for name, _, value, _ in cast_values(df, schema, optional)]))


UNUSED = ("emissions_co2_kg", "crypto_signature")
LEDGER_OPTIONAL = ("hvac_power_kw", "lighting_power_kw", "it_load_power_kw", "audit_trait", *UNUSED)


def ledger(df: DataFrame, fit: Callable[[DataFrame, str, Sequence[str]], DataFrame] = conform) -> DataFrame:
    """Canonical names and types, NaN as null, and the calendar month by which the ledger is stored.

    Sub-meters and the trait may be absent; the rules that need them then find nothing. Readings
    without a time have no month.
    """
    named = resolve_columns(strip_headers(df), TELEMETRY_ALIASES)
    return fit(named, schemas.TELEMETRY, LEDGER_OPTIONAL).drop(*UNUSED).selectExpr("*", f"{MONTH} AS month")


def readings(ledger: DataFrame, period: tuple[str, str] | None = None) -> DataFrame:
    """Readings with a time, those of the period if one is given; other months are not read."""
    kept = ledger.where("month IS NOT NULL AND timestamp IS NOT NULL")
    if period:
        start, end = (f"TIMESTAMP_NTZ'{t}'" for t in period)
        kept = kept.where(f"month BETWEEN trunc({start}, 'MM') AND to_date({end})")
        kept = kept.where(f"timestamp >= {start} AND timestamp < {end}")
    return kept.drop("month")


def rejected(ledger: DataFrame) -> DataFrame:
    """Number of readings without a time per asset: no rule can place them, so they are counted here."""
    return ledger.where("month IS NULL").groupBy("asset_id").agg(F.count("*").alias("n_rows"))


def clean_telemetry(df: DataFrame) -> DataFrame:
    """The readings of a raw ledger."""
    return readings(ledger(df))


def one_per_time(weather: DataFrame) -> DataFrame:
    """Weather without repeated rows; fails where one time has two different ones, which would double its readings."""
    only = lambda c: (
        f"CASE WHEN count(*) = 1 THEN any_value({c}) ELSE raise_error(concat('several weather rows for ', timestamp)) END AS {c}"
    )
    return sql(
        f"SELECT timestamp, {only('outdoor_temp_c')}, {only('day_type')} FROM (SELECT DISTINCT * FROM {{weather}}) GROUP BY timestamp",
        weather=weather,
    )


def with_row_ord(df: DataFrame, order: str) -> DataFrame:
    """Add the number by which events of the rows are ordered; it comes from their values, not from files or tasks."""
    return df.selectExpr("*", f"CAST({order} AS BIGINT) AS row_ord")


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a table as CSV, also when it is empty (SNK1)."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
