"""Landing of hourly weather: payload to rows, 15-minute grid, day class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterwatch import schemas
from meterwatch.functions.text import half_even, sql


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(path)


def explode_payload(payload: DataFrame) -> DataFrame:
    """Two parallel arrays to one row per hour (SRC4)."""
    return sql(
        """
        SELECT to_timestamp_ntz(time, "yyyy-MM-dd'T'HH:mm") AS timestamp, temperature_2m AS outdoor_temp_c
        FROM (SELECT inline(arrays_zip(hourly.time, hourly.temperature_2m)) FROM {payload})
        """,
        payload=payload,
    )


def resample_linear(hourly: DataFrame, minutes: int = 15) -> DataFrame:
    """Linear interpolation between neighbouring readings (PRE9).

    The grid spans all rows: slots after the last known temperature hold it, slots before the first one
    are null. The look-ahead runs within a month. Its last reading finds its neighbour in the month
    heads, of which there is one per month, so that no task orders the whole history.
    """
    seconds = lambda a, b: f"CAST(CAST({b} - {a} AS INTERVAL SECOND) AS DECIMAL(18, 6))"
    known = """
        SELECT timestamp AS t0, outdoor_temp_c AS v0, trunc(to_date(timestamp), 'MM') AS month
        FROM {hourly} WHERE outdoor_temp_c IS NOT NULL"""
    later = "OVER (ORDER BY month ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    heads = f"""
        SELECT month, first_value(head, true) {later} AS next_head, max(hi) OVER () AS last_time,
               CASE WHEN head.t0 = min(head.t0) OVER () THEN head.t0 END AS first_known, min(lo) OVER () AS first_time
        FROM (SELECT trunc(to_date(timestamp), 'MM') AS month, min(timestamp) AS lo, max(timestamp) AS hi,
                     min(CASE WHEN outdoor_temp_c IS NOT NULL THEN struct(timestamp AS t0, outdoor_temp_c AS v0) END) AS head
              FROM {{hourly}} WHERE timestamp IS NOT NULL GROUP BY 1)"""
    paired = f"""
        SELECT /*+ BROADCAST(h) */ t0, v0, coalesce(ahead, next_head).t0 AS t1, coalesce(ahead, next_head).v0 AS v1,
               CASE WHEN t0 = first_known THEN first_time ELSE t0 END AS from_time, last_time
        FROM (SELECT *, lead(struct(t0, v0)) OVER (PARTITION BY month ORDER BY t0) AS ahead FROM ({known})) k
        JOIN ({heads}) h ON k.month = h.month"""
    grid = f"""
        SELECT *, explode(sequence(from_time, coalesce(t1, last_time), INTERVAL '{minutes}' MINUTE)) AS timestamp
        FROM ({paired})"""
    return sql(
        f"""
        SELECT timestamp, CASE WHEN timestamp < t0 THEN NULL WHEN t1 IS NULL THEN v0
                 ELSE v0 + (v1 - v0) * (CAST({seconds('t0', 'timestamp')} AS DOUBLE) / {seconds('t0', 't1')}) END AS outdoor_temp_c
        FROM ({grid}) WHERE t1 IS NULL OR timestamp < t1
        """,
        hourly=hourly,
    )


def with_day_type(df: DataFrame) -> DataFrame:
    """WEEKEND from Saturday on, else WEEKDAY (PRE10)."""
    return df.selectExpr("*", "CASE WHEN weekday(timestamp) >= 5 THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type")


def overlay(df: DataFrame, column: str, start: str, end: str, value: float) -> DataFrame:
    """Overwrite a column within a closed time interval (PRE11)."""
    inside = f"timestamp BETWEEN TIMESTAMP_NTZ'{start}' AND TIMESTAMP_NTZ'{end}'"
    return df.selectExpr(*[
        f"CASE WHEN {inside} THEN {value}D ELSE {c} END AS {c}" if c == column else c for c in df.columns
    ])


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.selectExpr(*[
        f"{half_even(c, digits)} AS {c}" if c == "outdoor_temp_c" else c for c in df.columns
    ])


def as_text(df: DataFrame) -> DataFrame:
    """Interchange form: time as text, temperature with two decimals (PRE12)."""
    return rounded(df, 2).selectExpr(
        *["date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') AS timestamp" if c == "timestamp" else c for c in df.columns]
    )


def landed(hourly: DataFrame) -> DataFrame:
    """The weather table: 15-minute grid with day class, two decimals."""
    return rounded(with_day_type(resample_linear(hourly)), 2)
