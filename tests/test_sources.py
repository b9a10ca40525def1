"""Files, landing of weather, and database options."""

from __future__ import annotations

import json
import re
from datetime import datetime

import pytest

from helpers import START, rows
from meterwatch import schemas
from meterwatch.functions import dates
from meterwatch.sources import jdbc, quarantine, tables, weather


def test_csv_round_trip_also_when_empty(spark, tmp_path):
    data = spark.createDataFrame([(datetime(2025, 11, 1, 0, 15), 10.25, "WEEKEND")], schemas.WEATHER)
    for frame, n in ((data, 1), (data.where("false"), 0)):
        path = str(tmp_path / "w")
        tables.write_csv(frame, path)
        back = tables.read_csv(spark, path, schemas.WEATHER)
        assert back.dtypes == data.dtypes and back.count() == n
    tables.write_parquet(data, str(tmp_path / "p"), ["day_type"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1


def test_strict_scan_fails_on_a_bad_value(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("timestamp,outdoor_temp_c,day_type\nyesterday,1.0,WEEKDAY\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), schemas.WEATHER).collect()


def test_optional_table(spark, tmp_path):
    empty = tables.read_optional(spark, str(tmp_path / "none.csv"), schemas.PRIOR)
    assert empty.columns == ["metric", "prior_value", "label"] and empty.count() == 0


def test_header_names_and_aliases(spark, tmp_path):
    (tmp_path / "t.csv").write_text("timestamp, MAC_Address ,total_power,CO2,in_temp\n2025-11-01 00:00:00,a,1,2,3\n")
    frame = tables.read_csv_text(spark, str(tmp_path / "t.csv"))
    got = tables.clean_telemetry(frame).first()
    assert (got.asset_id, got.total_power_kw, got.indoor_co2_ppm, got.indoor_temp_c, got.hvac_power_kw) == ("a", 1.0, 2, 3.0, None)
    with pytest.raises(ValueError, match="total_power_kw"):
        tables.resolve_columns(frame.drop("total_power"), tables.TELEMETRY_ALIASES)


def test_nan_readings_become_null_and_rows_without_time_go(spark):
    frame = spark.createDataFrame(
        [(START, "a", 1, float("nan"), 2.0), (None, "a", 1, 1.0, 1.0)],
        "timestamp timestamp_ntz, asset_id string, indoor_co2_ppm bigint, indoor_temp_c double, total_power_kw double")
    got = tables.clean_telemetry(frame).collect()
    assert len(got) == 1 and got[0].indoor_temp_c is None and got[0].total_power_kw == 2.0


def test_readings_without_time_are_counted(spark):
    rows_in = [("NA", "a", 1), ("", "a", 2), ("2025-11-01 00:00:00", "b", 3), (None, None, 4)]
    frame = spark.createDataFrame(rows_in, "timestamp string, asset_id string, indoor_co2_ppm bigint").selectExpr(
        "*", "1D AS indoor_temp_c", "1D AS total_power_kw")
    ledger = tables.ledger(frame)
    assert {(r.asset_id, r.n_rows) for r in tables.rejected(ledger).collect()} == {("a", 2), (None, 1)}
    assert [r.asset_id for r in tables.readings(ledger).collect()] == ["b"]


def test_one_weather_row_per_time(spark):
    row = (START, 10.0, "WEEKDAY")
    frame = spark.createDataFrame([row, row], schemas.WEATHER)
    assert [tuple(r) for r in tables.one_per_time(frame).collect()] == [row]
    with pytest.raises(Exception, match="several weather rows"):
        tables.one_per_time(frame.union(spark.createDataFrame([(START, 11.0, "WEEKDAY")], schemas.WEATHER))).collect()


def test_long_ids_stay_exact(spark):
    frame = spark.createDataFrame([("9007199254740993",), ("12.0",), ("NaN",)], "n string")
    assert [r.n for r in tables.conform(frame, "n bigint").collect()] == [9007199254740993, 12, None]


def test_missing_temperatures_at_both_ends(spark):
    at = lambda h: START.replace(hour=h)
    hourly = spark.createDataFrame(
        [(at(0), None), (at(1), 4.0), (at(2), None), (at(3), 8.0), (at(4), None)], "timestamp timestamp_ntz, outdoor_temp_c double")
    got = {r.timestamp: r.outdoor_temp_c for r in weather.resample_linear(hourly).collect()}
    assert len(got) == 17 and max(got) == at(4)
    assert [got[at(h)] for h in range(5)] == [None, 4.0, 6.0, 8.0, 8.0]
    assert got[at(3).replace(minute=45)] == 8.0 and got[at(0).replace(minute=45)] is None


def test_missing_temperatures_over_whole_months(spark):
    month = lambda m: START.replace(month=m, hour=0)
    hourly = spark.createDataFrame(
        [(month(8), None), (month(9), 1.0), (month(10), None), (month(11), 3.0), (month(12), None)],
        "timestamp timestamp_ntz, outdoor_temp_c double")
    got = {r.timestamp: r.outdoor_temp_c for r in weather.resample_linear(hourly).collect()}
    assert len(got) == 122 * 96 + 1
    assert [got[month(m)] for m in (8, 9, 11, 12)] == [None, 1.0, 3.0, 3.0]
    assert got[month(10)] == pytest.approx(1 + 2 * 30 / 61)


def test_payload_to_grid(spark, tmp_path):
    times = ["2025-11-30T22:00", "2025-11-30T23:00", "2025-12-01T01:00"]
    (tmp_path / "w.json").write_text(json.dumps({"hourly": {"time": times, "temperature_2m": [10.0, 11.0, 12.0]}}, indent=1))
    hourly = weather.explode_payload(weather.read_payload(spark, str(tmp_path / "w.json")))
    got = weather.landed(hourly).orderBy("timestamp").collect()
    assert len(got) == 13 and got[-1].timestamp == datetime(2025, 12, 1, 1)  # ends at the last reading
    assert [r.outdoor_temp_c for r in got[:6]] == [10.0, 10.25, 10.5, 10.75, 11.0, 11.12]
    assert got[7].outdoor_temp_c == 11.38 and got[8].timestamp == datetime(2025, 12, 1)  # across the month
    assert [r.day_type for r in (got[7], got[8])] == ["WEEKEND", "WEEKDAY"]
    hot = weather.overlay(weather.landed(hourly), "outdoor_temp_c", times[0].replace("T", " "), "2025-11-30 22:30:00", 26.5)
    assert rows(hot.where("timestamp < TIMESTAMP_NTZ'2025-11-30 23:00:00'"), "outdoor_temp_c") == [(10.75,)] + [(26.5,)] * 3
    assert weather.as_text(weather.landed(hourly)).orderBy("timestamp").first().timestamp == "2025-11-30 22:00:00"


def test_lenient_dates(spark):
    frame = spark.createDataFrame([("11/20/2025",), ("2025-11-05",), ("2025-11-05 06:30:00",), ("soon",), (None,)], "d string")
    got = [r.t for r in dates.with_time(frame, "d", "t", "2025-11-01 00:00:00").collect()]
    assert got == [datetime(2025, 11, 20), datetime(2025, 11, 5), datetime(2025, 11, 5, 6, 30), START, START]


FORMS = {
    "2025-11-02T10:00:00": datetime(2025, 11, 2, 10), "2025-11-02 10:30": datetime(2025, 11, 2, 10, 30),
    "2025-11-02 10:30:00.5": datetime(2025, 11, 2, 10, 30, 0, 500000), "11/2/2025 10:30": datetime(2025, 11, 2, 10, 30),
    "2025/11/02": datetime(2025, 11, 2), " 2025-11-02\t": datetime(2025, 11, 2), "2025-11-02T10:00:00Z": datetime(2025, 11, 2, 10),
    "11.2.2025": datetime(2025, 11, 2), "2025-13-02": None, "2025-11-02 25:00": None, "2025-11/02": None, "": None, "2025-11-02 10:30:60": None,
}


def test_date_forms_are_read_and_counted(spark):
    frame = spark.createDataFrame([(k,) for k in FORMS] + [(None,)], "d string")
    assert {r.d: r.t for r in dates.with_time(frame, "d", "t").collect()} == FORMS | {None: None}
    found = {(r.form, r.is_read): r.n for r in dates.report(frame, "d").collect()}
    assert found["Y-9-9 9:9:9.f", True] == 1 and found["Y-9/9", False] == 1 and found["Y-9-9", True] == found["Y-9-9", False] == 1
    assert sum(found.values()) == len(FORMS) and sum(n for (_, is_read), n in found.items() if is_read) == 8


def test_the_column_decides_between_day_and_month_first(spark):
    read = lambda *texts: [r.t for r in dates.with_time(spark.createDataFrame([(t,) for t in texts], "d string"), "d", "t").collect()]
    assert read("3/4/2025", "20/11/2025") == [datetime(2025, 4, 3), datetime(2025, 11, 20)]
    assert read("3/4/2025", "11/20/2025") == [datetime(2025, 3, 4), datetime(2025, 11, 20)]
    assert read("3/4/2025") == [datetime(2025, 3, 4)] and read() == []
    strict = spark.createDataFrame([("2025-11-02",), ("2025-11-03",), ("11/4/2025",), ("x",)], "d string")
    got = [r.t for r in dates.with_time(strict, "d", "t", "2025-01-01 00:00:00", strict=True).collect()]
    assert got == [datetime(2025, 11, 2), datetime(2025, 11, 3), datetime(2025, 1, 1), datetime(2025, 1, 1)]


def test_database_options():
    url = "jdbc:postgresql://host/db"
    assert jdbc.read_options(url, "t") == {"url": url, "dbtable": "t"}
    split = jdbc.read_options(url, "t", lower="2025-11-01", upper="2025-12-01", partitions=30)
    assert (split["partitionColumn"], split["numPartitions"], split["upperBound"]) == ("timestamp", "30", "2025-12-01")
    with pytest.raises(ValueError):
        jdbc.read_options(url, "t", partitions=2)
    assert jdbc.write_options(url, "t")["batchsize"] == "1000"
    made = jdbc.write_options(url, "w", column_types=jdbc.WEATHER_COLUMN_TYPES, truncate=True)
    assert made["createTableColumnTypes"].startswith("timestamp TIMESTAMP") and made["truncate"] == "true"


def test_missing_value_text_and_nan_become_null(spark):
    rows = [("2025-11-02 10:00:00", "NA", "NaN"), ("2025-11-02 10:15:00", "A", "400.0"), ("2025-11-02 10:30:00", "null", "n/a")]
    frame = spark.createDataFrame(rows, "timestamp string, asset_id string, indoor_co2_ppm string")
    out = tables.conform(frame, "timestamp timestamp_ntz, asset_id string, indoor_co2_ppm bigint").collect()
    assert [(r.asset_id, r.indoor_co2_ppm) for r in out] == [(None, None), ("A", 400), (None, None)]
    numbers = spark.createDataFrame([(float("nan"),), (2.0,)], "n double")
    assert [r.n for r in tables.conform(numbers, "n bigint").collect()] == [None, 2]


def test_csv_quotes_and_times_round_trip(spark, tmp_path):
    path = str(tmp_path / "quoted")
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2025-11-02 10:00:00' AS t, 'say \"hi\", all' AS s")
    tables.write_csv(frame, path)
    text = "".join(p.read_text() for p in (tmp_path / "quoted").glob("part-*"))
    assert '2025-11-02 10:00:00,"say ""hi"", all"' in text
    assert tables.read_csv_text(spark, path).first().s == 'say "hi", all'


def test_created_column_types_are_spark_types():
    from pyspark.sql.types import StructType

    from meterwatch.sources import jdbc

    assert StructType.fromDDL(jdbc.WEATHER_COLUMN_TYPES).names == ["timestamp", "outdoor_temp_c", "day_type"]


def test_generated_column_types(spark):
    """What Spark puts into CREATE TABLE for the weather."""
    jvm = spark._jvm.org.apache.spark.sql
    frame = spark.createDataFrame([], "timestamp timestamp_ntz, outdoor_temp_c double, day_type string")
    utils, some = jvm.execution.datasources.jdbc.JdbcUtils, spark._jvm.scala.Some(jdbc.WEATHER_COLUMN_TYPES)
    made = utils.schemaString(jvm.jdbc.JdbcDialects.get("jdbc:postgresql://h/d"), frame._jdf.schema(), False, some)
    assert [c.strip().split(" ", 1)[1] for c in re.split(r",(?!\d)", made)] == ["TIMESTAMP", "NUMERIC(6,2)", "TEXT"]


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_ranges_are_equally_filled_and_hold_each_row_once(partitions):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE readings AS SELECT TIMESTAMP '2025-11-01' + to_minutes(CAST(i * i % 4001 AS INTEGER)) AS \"timestamp\", i AS \"n\" FROM range(5000) t(i)")
    con.execute("INSERT INTO readings VALUES (NULL, -1), (NULL, -2)")
    con.execute("INSERT INTO readings SELECT TIMESTAMP '2025-11-01', i FROM range(5000, 6000) t(i)")
    for column in ("timestamp", "n"):
        bounds = [r[0] for r in con.execute(jdbc.bounds_query("readings", column, partitions)).fetchall()]
        parts = [con.execute(f"SELECT n FROM readings WHERE {p}").fetchall() for p in jdbc.range_predicates(column, bounds)]
        assert sorted(n for part in parts for (n,) in part) == [-2, -1, *range(6000)]
        assert len(parts) <= partitions and max(map(len, parts)) < 2.2 * 6002 / partitions
    assert jdbc.range_predicates("t", ["it's", "b"])[0] == "\"t\" < 'it''s' OR \"t\" IS NULL"
    assert jdbc.range_predicates("t", [5, 5]) == jdbc.range_predicates("t", []) == ["1 = 1"]


def test_rows_that_do_not_fit_are_set_aside(spark):
    data = [("2025-11-02 10:00:00", "A", "400.0", "1e2"), ("yesterday", "A", "NA", "x1"), ("2025-11-02 10:30:00", "B", "12a", "NaN"), (None, "C", "7", None)]
    frame = spark.createDataFrame(data, "timestamp string, asset_id string, co2 string, kw string")
    schema = "timestamp timestamp_ntz, asset_id string, co2 bigint, kw double, extra double"
    sifted = quarantine.sift(frame, schema, ("extra",))
    assert sorted((r.asset_id, r.co2, r.kw) for r in quarantine.accepted(sifted).collect()) == [("A", 400, 100.0), ("C", 7, None)]
    found = quarantine.rejects(sifted, "ledger").collect()
    assert sorted((r.source, r.column, r.text, r.reason) for r in found) == [
        ("ledger", "co2", "12a", "not a bigint"), ("ledger", "kw", "x1", "not a double"), ("ledger", "timestamp", "yesterday", "not a timestamp_ntz")]
    assert json.loads(next(r.row for r in found if r.column == "co2"))["asset_id"] == "B"
    quarantine.check_budget(sifted, "ledger", 0.5)
    with pytest.raises(ValueError, match="2 of 4 rows of ledger"):
        quarantine.check_budget(sifted, "ledger", 0.4)
    assert not quarantine.needs_sifting(frame.select("asset_id"), "asset_id string") and quarantine.needs_sifting(frame, schema)
