"""Small literal frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from meterwatch import schemas
from meterwatch.config import CLEAN

START = datetime(2025, 11, 1)
FIELDS = (
    "timestamp timestamp_ntz, asset_id string, indoor_co2_ppm bigint, indoor_temp_c double, total_power_kw double, "
    "hvac_power_kw double, lighting_power_kw double, it_load_power_kw double, audit_trait string"
)
SITE = "Asset_02_NZ_Boundary"
ZONE = "Asset_09_NZ_Boundary"


def slot(n: int, start: datetime = START) -> datetime:
    return start + timedelta(minutes=15 * n)


def reading(ts, asset=SITE, co2=500, temp=22.0, total=10.0, hvac=5.0, light=3.0, it=2.0, trait=CLEAN):
    return (ts, asset, co2, temp, total, hvac, light, it, trait)


def telemetry(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


def weather(spark, n=2880, temp=15.0, start=START):
    rows = [
        (slot(i, start), temp, "WEEKEND" if slot(i, start).weekday() >= 5 else "WEEKDAY") for i in range(n)
    ]
    return spark.createDataFrame(rows, schemas.WEATHER)


def exemptions(spark, rows=()):
    full = [(f"E{i}", a, s, t0, t1, "test") for i, (a, s, t0, t1) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.EXEMPTIONS)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
