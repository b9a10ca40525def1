"""A run from CSV files to published tables."""

from __future__ import annotations

import csv
import json
from dataclasses import replace
from datetime import datetime

import pytest

from helpers import SITE, START, exemptions, reading, slot, telemetry, weather
from meterwatch import config, schemas
from meterwatch.config import AuditParams
from meterwatch.functions.sizing import ensure_checkpoint_dir, stored_table
from meterwatch.plans import logs, pipeline
from meterwatch.plans.audit import Audit
from meterwatch.plans.logs import AuditInputs
from meterwatch.sources import tables


def put(folder, name, header, rows):
    with open(folder / f"{name}.csv", "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def test_csv_in_csv_out(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    readings = []
    for i in range(2880):
        co2 = 1250 if 40 <= i < 45 else 600
        readings.append([slot(i), SITE, f"{co2}.0", 22, 50.0, 5, 30, 15 if i < 96 else 1, "L0_CLEAN_COMPLIANT"])
    readings.append([slot(7), "Asset_99", 500, 22, 5, 5, 0, 0, "X"])
    put(src, "fact_telemetry_ledger", ["timestamp", " asset_id", "co2_ppm", "indoor_temp_c", "total_power_kw", "hvac_power_kw",
                                       "lighting_power_kw", "it_load_power_kw", "audit_trait"], readings)
    put(src, "external_auckland_weather", ["timestamp", "outdoor_temp_c", "day_type"],
        [[slot(i), 15.0, "WEEKDAY"] for i in range(2880)])
    put(src, "fact_exemption_registry",
        ["exemption_id", "asset_id", "scenario_id", "start_time", "end_time", "application_type"], [])
    put(src, "dim_invoices_proxy",
        ["asset_id", "billing_month", "actual_billed_kwh", "inferred_kwh", "uploaded_pdf_hash", "original_crypto_signature"],
        [["Asset_01_NZ_Boundary", "2025-11-01", 5000.0, 4950.0, "h", "h"], ["Asset_11_AU_Sydney", "2025-11-01", 7500.0, 6100.0, "x", "y"]])
    put(src, "fact_travel_expense", ["ticket_id", "employee_id ", "route", "booked_class", "ticket_price_aud", "flight_hours"],
        [[2, "EMP_002", "SYD-LHR", "Business", 8500, 24], [3, "EMP_002", "SYD-AKL", "Business", 2800, 3]])
    put(src, "fact_waste_manifest", ["manifest_id", "asset_id", "waste_type", "disposal_date", "quantity_kg", "disposal_cert_url"],
        [["WM_2025_001", "Asset_01_NZ_Boundary", "E-Waste", "11/20/2025", 45, ""]])

    pipeline.run(spark, str(src), str(out))

    table = lambda name: spark.read.option("header", True).csv(str(out / name))
    fact = [(r.event_id, r.scenario) for r in table("fact_audit_events").orderBy("event_id").collect()]
    assert fact == [(f"EVT_{i:04d}", s) for i, s in enumerate(
        ["S01", "S06", "S04", "S10", "S02", "S09", "S11", "S12"], 1)]
    assert {r.metric: r.value_nzd for r in table("dim_kpi_summary").collect()}["total_violations"] == "4.0"
    assert [r.scenario for r in table("dim_priority_actions").orderBy("priority").collect()] == ["S02", "S10", "S06"]
    # 14 kW stay unmetered for 29 days; the benchmark overrun is smaller, so nothing is left of it
    leak = table("energy_audit_log").where("scenario = 'S04'").first()
    assert float(leak.waste_kwh) == 14.0 * 29 * 24
    kpi = {r.metric: r for r in table("dim_kpi_summary").collect()}
    over = float(table("energy_audit_log").where("scenario = 'S10'").first().waste_kwh)
    assert over < float(leak.waste_kwh)
    assert float(kpi["avoidable_cost_nz"].value_nzd) == float(leak.financial_cost)
    assert table("nabers_au_summary").first().suspension_reason == "S02_HASH_BREACH"
    assert table("dim_scenarios").count() == 12 and table("dim_assets").count() == 11
    assert table("nabersnz_summary").count() == 1
    assert table("rejected_readings").count() == 0 and table("report_kpi_delta").count() == 6
    totals = {r.scenario: float(r.waste_kwh) for r in table("report_scenario_totals").collect()}
    assert totals["S04"] == 14.0 * 29 * 24
    outcomes = {(r.scenario, r.outcome): int(r.n) for r in table("report_outcome_counts").collect()}
    assert outcomes["S05", "baseline_row"] == 2880 and outcomes["S05", "excluded_row"] == 1
    assert table("report_evidence_log").count() == 4 and table("report_benchmark_rank").count() == 1
    assert table("facility_audit_log").count() == 2 and table("esg_compliance_audit_log").count() == 4


def month_of(spark, *assets, start=START, days=30, hole=()):
    return [reading(slot(i, start), asset=a, co2=1250 if i % 96 in (40, 41) else 600) for a in assets
            for i in range(96 * days) if i // 96 not in hole]


def inputs(spark, readings, params=None):
    empty = lambda schema: spark.createDataFrame([], "row_ord bigint, " + schema)
    return AuditInputs(
        telemetry=telemetry(spark, readings), weather=weather(spark, 2976), registry=config.registry(spark),
        exemptions=exemptions(spark), invoices=empty(schemas.INVOICES), travel=empty(schemas.TRAVEL),
        waste=empty(schemas.WASTE), params=params or AuditParams())


def test_two_runs_in_one_application(spark):
    first, second = Audit(inputs(spark, month_of(spark, SITE, days=2))), Audit(inputs(spark, month_of(spark, SITE, days=1)))
    before = first.fact.count()
    assert second.fact.count() < before
    assert first.fact.count() == before and first.profile.first().n_rows == 192


def test_the_ledger_is_read_five_times(spark, tmp_path):
    telemetry(spark, month_of(spark, SITE, days=2)).write.parquet(str(tmp_path / "ledger"))
    base = inputs(spark, month_of(spark, SITE, days=1))
    a = replace(base, telemetry=spark.read.parquet(str(tmp_path / "ledger")))
    audit = Audit(a)
    plans = [logs.asset_profile(a), logs.daily(a), logs.facility_events(a, audit.profile),
             logs.energy_events(a, audit.profile, audit.days, audit.verdicts),
             audit.fact, audit.outcome_counts(), logs.scenario_totals(audit.energy, audit.compliance)]
    scans = [p._jdf.queryExecution().optimizedPlan().toString().count("indoor_co2_ppm#") for p in plans]
    reads = [p._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}") for p in plans]
    assert reads == [1, 1, 1, 2, 0, 0, 0], scans


def test_period(spark, tmp_path):
    src = tmp_path / "in"
    october = datetime(2025, 10, 1)
    data = month_of(spark, SITE, start=october, days=31, hole=range(5)) + month_of(spark, SITE)
    telemetry(spark, [*data, reading(None, asset="a")]).write.parquet(str(src / "fact_telemetry_ledger"))
    weather(spark, 96 * 61, start=october).write.parquet(str(src / "external_auckland_weather"))
    exemptions(spark).write.parquet(str(src / "fact_exemption_registry"))
    for name, schema in (("dim_invoices_proxy", schemas.INVOICES), ("fact_travel_expense", schemas.TRAVEL),
                         ("fact_waste_manifest", schemas.WASTE)):
        spark.createDataFrame([], schema).write.parquet(str(src / name))
    p = AuditParams().for_period("2025-10-01", "2025-11-01")
    assert (p.expected_rows, p.working_hours) == (2976, 23 * 13.0)
    months = {}
    for start, end in (("2025-10-01", "2025-11-01"), ("2025-11-01", "2025-12-01")):
        a = pipeline.load(spark, str(src), "parquet", AuditParams().for_period(start, end))
        months[start] = {r.scenario for r in logs.facility_events(a, logs.asset_profile(a)).collect()}
        assert "GreaterThanOrEqual(timestamp" in a.telemetry._jdf.queryExecution().executedPlan().toString()
        assert a.weather.count() == a.params.expected_rows
        assert [(r.asset_id, r.n_rows) for r in a.rejects.collect()] == [("a", 1)]
    assert months == {"2025-10-01": {"S03", "S06"}, "2025-11-01": {"S06"}}


def test_landed_ledger_is_pruned_by_month(spark):
    frame = telemetry(spark, month_of(spark, SITE, start=datetime(2025, 10, 1), days=61))
    landed = stored_table(tables.ledger(frame), "ledger", ("month",))
    october = tables.readings(landed, ("2025-10-01 00:00:00", "2025-11-01 00:00:00"))
    plan = october._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert october.count() == 31 * 96


def write_csv_inputs(folder, readings, weather_rows=()):
    folder.mkdir()
    put(folder, "fact_telemetry_ledger", ["timestamp", "asset_id", "indoor_co2_ppm", "indoor_temp_c", "total_power_kw"], readings)
    put(folder, "external_auckland_weather", ["timestamp", "outdoor_temp_c", "day_type"], weather_rows)
    put(folder, "fact_exemption_registry", ["exemption_id", "asset_id", "scenario_id", "start_time", "end_time", "application_type"], [])
    put(folder, "dim_invoices_proxy", ["asset_id", "billing_month", "actual_billed_kwh", "uploaded_pdf_hash", "original_crypto_signature"], [])
    put(folder, "fact_travel_expense", ["ticket_id", "employee_id", "route", "booked_class", "ticket_price_aud", "flight_hours"], [])
    put(folder, "fact_waste_manifest", ["manifest_id", "asset_id", "waste_type", "disposal_date", "quantity_kg", "disposal_cert_url"],
        [["W1", SITE, "E-Waste", "2025-11-02T10:00", 4, ""], ["W2", SITE, "E-Waste", "soon", 4, ""]])


def test_bad_rows_go_to_the_quarantine(spark, tmp_path):
    readings = [[slot(i), SITE, 1250, 22, 5.0] for i in range(40)]
    readings[7][2], readings[20][0] = "12a", "yesterday"
    write_csv_inputs(tmp_path / "in", readings)
    with pytest.raises(ValueError, match="2 of 40 rows of fact_telemetry_ledger"):
        pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), params=AuditParams(reject_share=0.05))
    table = lambda name: spark.read.option("header", True).csv(str(tmp_path / "out" / name))
    assert sorted((r.source, r.column, r.text) for r in table("quarantine").collect()) == [
        ("fact_telemetry_ledger", "indoor_co2_ppm", "12a"), ("fact_telemetry_ledger", "timestamp", "yesterday")]
    assert table("facility_audit_log").where("scenario = 'S06'").first().anomaly_duration_mins == str(38 * 15)
    # the stored tables of both runs, of the broken one as well, are gone
    kept = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}")
    files = kept.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not files.exists(kept) or not [f for f in files.listStatus(kept) if f.getPath().getName().startswith("run-")]
    assert {(r.form, r.is_read) for r in table("report_date_forms").collect()} == {("Y-9-9T9:9", "true"), ("soon", "false")}


def test_landed_weather_and_database_tables_as_choices(spark, tmp_path):
    write_csv_inputs(tmp_path / "in", [])
    hours = [f"2025-11-01T{h:02d}:00" for h in range(24)]
    (tmp_path / "w.json").write_text(json.dumps({"hourly": {"time": hours, "temperature_2m": [float(h) for h in range(24)]}}))
    ledger = telemetry(spark, month_of(spark, SITE, days=1))
    a = pipeline.load(spark, str(tmp_path / "in"), given={"telemetry": ledger}, payload=str(tmp_path / "w.json"))
    assert a.weather.count() == 93 and a.weather.where("day_type = 'WEEKEND'").count() == 93 and a.telemetry.count() == 96
    assert a.quarantine.count() == 0


def test_staged_runs_in_parquet_with_a_prior_month(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    data = month_of(spark, SITE, start=datetime(2025, 10, 1), days=31) + month_of(spark, SITE, hole=range(3))
    telemetry(spark, data).write.parquet(str(src / "fact_telemetry_ledger"))
    weather(spark, 96 * 61, start=datetime(2025, 10, 1)).write.parquet(str(src / "external_auckland_weather"))
    exemptions(spark).write.parquet(str(src / "fact_exemption_registry"))
    for name, schema in (("dim_invoices_proxy", schemas.INVOICES), ("fact_travel_expense", schemas.TRAVEL), ("fact_waste_manifest", schemas.WASTE)):
        spark.createDataFrame([], schema).write.parquet(str(src / name))
    for start, end in (("2025-10-01", "2025-11-01"), ("2025-11-01", "2025-12-01")):
        kept = pipeline.run_staged(spark, str(src), store, "parquet", AuditParams().for_period(start, end))
    october, november = ({r.event_id: r.scenario for r in spark.read.parquet(r.path).collect()} for r in kept.entries() if r.name == "fact_audit_events")
    assert sorted(int(e[4:]) for e in [*october, *november]) == list(range(1, len(october) + len(november) + 1))
    delta = {r.metric: r for r in kept.as_of("report_kpi_delta").collect()}
    assert (delta["total_violations"].prior_value, delta["total_violations"].value) == (0.0, 1.0)
    # a table of prior KPIs goes before the store
    spark.createDataFrame([("total_violations", 4.0, "")], schemas.PRIOR).write.parquet(str(src / "dim_baseline_prior_month"))
    again = pipeline.run_staged(spark, str(src), store, "parquet", AuditParams().for_period("2025-11-01", "2025-12-01"))
    assert {r.metric: r.prior_value for r in again.as_of("report_kpi_delta").collect()}["total_violations"] == 4.0
    assert {r.event_id for r in again.as_of("fact_audit_events").collect()} == set(november)
