"""Enrichment of telemetry with weather and registry attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.config import AuditParams
from meterwatch.functions.text import cooling_degrees


def weather_enrich(telemetry: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join of outdoor temperature and day class on the timestamp (PRE5).

    Weather holds one row per 15-minute slot of the calendar, whatever the number of assets. Spark
    broadcasts it below its own bound of bytes; beyond it the join shuffles by timestamp.
    """
    columns = weather.select("timestamp", "outdoor_temp_c", "day_type")
    return telemetry.join(columns, "timestamp", "left")


def time_features(df: DataFrame) -> DataFrame:
    """Hour of day and weekday flag; an unknown day class counts as no weekday (PRE6)."""
    return df.selectExpr(
        "*", "hour(timestamp) AS hour", "coalesce(CAST(day_type = 'WEEKDAY' AS INT), 0) AS is_weekday"
    )


def enrich(telemetry: DataFrame, weather: DataFrame, p: AuditParams) -> DataFrame:
    """Telemetry with weather, hour, weekday flag and cooling degrees."""
    featured = time_features(weather_enrich(telemetry, weather))
    return featured.selectExpr("*", f"{cooling_degrees('outdoor_temp_c', p.cooling_base_c)} AS cdd")


def site_label(telemetry: DataFrame, registry: DataFrame) -> DataFrame:
    """Site name per reading, null for unknown devices (PRE8)."""
    return telemetry.join(registry.selectExpr("asset_id", "display_name AS location"), "asset_id", "left")


def metered(registry: DataFrame) -> DataFrame:
    """Registered assets that send telemetry (PRE14)."""
    return registry.where("has_iot")
