"""Star schema against the published month."""

from __future__ import annotations

from datetime import datetime

import pytest

from meterwatch import config
from meterwatch.plans import reporting, star
from meterwatch.schemas import EMIT, FACT

START = datetime(2025, 11, 1)
# Durations and figures of the published outputs.
ZONE_MINUTES = [
    30, 75, 30, 30, 30, 45, 45, 60, 45, 30, 75, 30, 45, 60, 30, 45, 135, 60, 30, 45, 90, 45, 30, 60, 45, 45, 45, 45,
    30, 45, 30, 30, 60, 45, 75, 30, 60, 30, 30, 60, 30, 30, 75, 45, 30, 105, 30, 60, 30, 30, 45, 45, 105, 45, 45, 45,
]
CO2_MINUTES = [210, 270, 75, 75, 300, 300]
# asset number, scenario, energy, cost, carbon
ENERGY = [
    (1, "S10", 5662.8425, 1415.71, 622.913), (2, "S05", 0.9036, 0.23, 0.099), (2, "S05", 0.9036, 0.23, 0.099),
    (3, "S05", 1.0883, 0.27, 0.12), (3, "S05", 1.0883, 0.27, 0.12), (4, "S05", 0.9036, 0.23, 0.099),
    (4, "S05", 0.9036, 0.23, 0.099), (5, "S05", 4.0282, 1.01, 0.443), (5, "S05", 218.7852, 54.7, 24.066),
    (5, "S07", 4560.4734, 1140.12, 501.652), (6, "S04", 62.0925, 15.52, 6.83), (6, "S04", 158.5675, 39.64, 17.442),
    (6, "S04", 64.1425, 16.04, 7.056), (6, "S04", 180.9825, 45.25, 19.908), (6, "S04", 1287.5075, 321.88, 141.626),
    (6, "S05", 4.1997, 1.05, 0.462), (6, "S05", 4.1997, 1.05, 0.462), (6, "S07", 867.5104, 216.88, 95.426),
    (7, "S05", 0.9036, 0.23, 0.099), (7, "S05", 0.9036, 0.23, 0.099), (8, "S05", 0.9036, 0.23, 0.099),
    (8, "S05", 0.9036, 0.23, 0.099), (10, "S05", 0.9036, 0.23, 0.099), (10, "S05", 0.9036, 0.23, 0.099),
]


def site(n):
    return f"Asset_{n:02d}_NZ_Boundary"


def facility_log(spark):
    rows = [(START, "Asset_99_UNKNOWN_Boundary", "S01", "L0_UNAUTHORIZED_ASSET", 15, None, None, None, 0, 0)]
    rows += [(START.replace(day=i + 1), site(2), "S06", "L1_IEQ_GREENWASHING", m, "air", None, None, 1, 2)
             for i, m in enumerate(CO2_MINUTES)]
    rows += [(START, site(3), "S03", "L1_TIMESERIES_GAP", 2880, None, None, None, 1, 3)]
    rows += [(START.replace(day=1 + i // 24, hour=i % 24), site(9), "S08", "L2_HIGH_DEMAND_IEQ_GAP", m, "air",
              round(40 * 300000 * 0.15 * (m / 124800), 2), 850, 1, 9) for i, m in enumerate(ZONE_MINUTES)]
    return spark.createDataFrame(
        rows, "start_time timestamp_ntz, asset_id string, scenario string, status string, anomaly_duration_mins bigint, "
              "recommendation string, cognitive_loss_nzd double, peak_co2_ppm bigint, emit_group int, emit_entity bigint"
    ).selectExpr("*", "0D AS waste_kwh", "0D AS financial_cost", "0D AS carbon_kg")


def energy_log(spark):
    rows = [(START.replace(hour=i % 24), site(n), s, "L1_NABERSNZ_BREACH" if s == "S10" else "L2", 60, kwh, cost, carbon,
             1.175 if s == "S10" else None, 1, n) for i, (n, s, kwh, cost, carbon) in enumerate(ENERGY)]
    return spark.createDataFrame(
        rows, "timestamp timestamp_ntz, asset_id string, scenario string, status string, anomaly_duration_mins bigint, "
              "waste_kwh double, financial_cost double, carbon_kg double, nabersnz_ratio double, emit_group int, emit_entity bigint")


def compliance_log(spark):
    au = "Asset_11_AU_Sydney"
    rows = [
        (au, "S02", "L1_HASH_MISMATCH", "PDF hash", 0.0, None, 2, 1),
        (au, "S09", "SUSPENDED_PENDING_S02",
         "S09 analysis suspended — upstream S02 hash breach unresolved. More.", 0.0, None, 9, 1),
        ("EMP_002", "S11", "L3_TRAVEL_CLASS_AUDIT", "Business class", 2800.0, None, 11, 2),
        (site(1), "S12", "L3_WASTE_CERT_MISSING", "E-Waste", 0.0, "11/20/2025", 12, 0),
    ]
    return spark.createDataFrame(
        rows, "asset_id string, scenario string, status string, detail string, financial_exposure double, "
              "disposal_date string, emit_group int, emit_entity bigint").selectExpr("*", "0D AS carbon_kg")


@pytest.fixture(scope="module")
def fact(spark):
    facts = (
        star.facility_facts(facility_log(spark))
        .unionByName(star.energy_facts(energy_log(spark)))
        .unionByName(star.compliance_facts(compliance_log(spark), "2025-11-01 00:00:00"))
    )
    return star.with_event_ids(facts).select(*FACT, "event_seq").cache()


def test_fact_rows_and_ids(fact):
    got = {r.event_id: r for r in fact.collect()}
    assert sorted(got) == [f"EVT_{n:04d}" for n in range(1, 93)]
    assert (got["EVT_0001"].scenario, got["EVT_0008"].scenario, got["EVT_0009"].scenario) == ("S01", "S03", "S08")
    assert [got[f"EVT_{n:04d}"].scenario for n in (65, 89, 90, 91, 92)] == ["S10", "S02", "S09", "S11", "S12"]
    assert got["EVT_0092"].event_time == datetime(2025, 11, 20) and got["EVT_0089"].event_time == START
    assert (got["EVT_0089"].region, got["EVT_0091"].region) == ("AU", "NZ")
    # a measure of the log's own schema keeps its null, a foreign one is zero
    assert (got["EVT_0001"].peak_co2_ppm, got["EVT_0001"].nabersnz_ratio) == (None, 0.0)
    assert (got["EVT_0066"].peak_co2_ppm, got["EVT_0066"].nabersnz_ratio, got["EVT_0066"].detail) == (0.0, None, "")
    assert got["EVT_0009"].department == "Facilities" and got["EVT_0065"].department == "Energy Compliance"


def test_kpis_match_the_published_month(fact):
    got = {r.metric: (r.value_nzd, r.value_aud, r.note) for r in star.kpi_summary(fact).collect()}
    assert got["total_violations"][0] == 5.0
    assert got["avoidable_cost_nz"][0] == 3271.69
    assert got["avoidable_carbon_nz"][0] == 1439.5
    assert got["s08_productivity_loss"][0] == 38942.25
    assert got["avoidable_cost_au"] == (0.0, 0.0, "Under Review — pending invoice verification")


def test_overrun_is_net_of_what_the_same_asset_explains(spark):
    rows = [("a", "S10", 100.0, 25.0, 11.0), ("a", "S04", 40.0, 10.0, 4.4), ("b", "S10", 10.0, 2.5, 1.1),
            ("b", "S07", 30.0, 7.5, 3.3), ("c", "S10", 8.0, 2.0, 0.88), ("d", "S05", 4.0, 1.0, 0.44), ("e", "S10", 0.0, 0.0, 0.0)]
    fact = spark.createDataFrame(
        [(a, s, "NZ", *m) for a, s, *m in rows], "asset_id string, scenario string, region string, waste_kwh double, "
        "financial_cost double, carbon_kg double")
    got = star.net_avoidable(fact).collect()[0]
    assert got.attributable_cost == pytest.approx(18.5)
    assert got.net_overrun_cost == pytest.approx(25 * 0.6 + 0 + 2)


def test_priorities_match_the_published_month(spark, fact):
    got = {r.priority: r for r in star.priority_actions(fact, config.scenarios(spark)).collect()}
    assert {n: (r.scenario, r.asset_id) for n, r in got.items()} == {
        1: ("S02", "Asset_11_AU_Sydney"), 2: ("S10", site(1)), 3: ("S06", site(2))}
    assert got[1].finding == "Invoice Hash Integrity — L1_HASH_MISMATCH" and got[1].detail == "PDF hash"
    assert got[2].detail.startswith(
        "Asset_01_NZ_Boundary YTD energy intensity is 17.5% above its climate-adjusted NABERSNZ budget (ratio 1.175). ")
    assert got[3].detail == (
        "Asset_02_NZ_Boundary recorded 6 sustained CO2 exceedance events above 1,000 ppm during November workdays "
        "(total 1230 minutes), breaching NZS 4303:1990 ventilation requirements.")
    assert got[1].editable_recommendation == ""


def test_an_empty_group_has_no_priority(spark, fact):
    only_air = fact.where("scenario = 'S08'")
    got = star.priority_actions(only_air, config.scenarios(spark)).collect()
    assert [(r.priority, r.scenario) for r in got] == [(2, "S08")]
    assert "56 IEQ gap events" in got[0].detail and "NZD 38,942." in got[0].detail


def test_priority_falls_back_to_a_generated_text(spark, fact):
    bare = fact.where("scenario = 'S12'").drop("detail").selectExpr("*", "'nan' AS detail")
    got = star.priority_actions(bare, config.scenarios(spark)).collect()
    assert got[0].detail == "L3_WASTE_CERT_MISSING detected at Asset_01_NZ_Boundary"


def test_ids_stay_dense_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 5000
        facts = spark.range(n).selectExpr(
            "CAST(id % 3 AS INT) AS category_ord", "1 AS emit_group", "hash(id) AS emit_entity", "'S01' AS scenario",
            "TIMESTAMP_NTZ'2025-11-01' AS event_time", "CAST(id AS STRING) AS asset_id", "'' AS detail",
            "0D AS financial_exposure")
        got = star.with_event_ids(facts)
        assert got.rdd.getNumPartitions() > 1
        found = sorted(got.collect(), key=lambda r: r.event_seq)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.event_seq for r in found] == list(range(1, n + 1))
    keys = [(r.category_ord, r.emit_entity, r.asset_id) for r in found]
    assert keys == sorted(keys)
    assert found[-1].event_id == "EVT_5000"


def test_dimensions(spark):
    assets = {r.asset_id: r for r in star.dim_assets(config.registry(spark)).collect()}
    assert len(assets) == 11 and assets[site(9)].space_designation == "HIGH_DEMAND"
    assert (assets["Asset_11_AU_Sydney"].has_iot, assets["Asset_11_AU_Sydney"].region) == (False, "AU")
    sparse = spark.createDataFrame(
        [("x", None, None, None, None, None, None, None)],
        "asset_id string, region string, location string, area_sqm double, occupant_count bigint, "
        "space_designation string, display_name string, has_iot boolean")
    assert tuple(star.dim_assets(sparse).collect()[0]) == ("x", "NZ", "", 0.0, 0, "STANDARD", "x", False)
    hidden = [r.scenario for r in config.scenarios(spark).where("NOT ceo_visible").collect()]
    assert hidden == ["S01", "S03", "S04", "S05"]


def test_kpi_delta(spark, fact):
    prior = spark.createDataFrame(
        [("total_violations", 7.0, ""), ("avoidable_cost_nz", 3271.69, ""), ("avoidable_carbon_nz", 0.0, ""),
         ("s08_productivity_loss", 31200.0, "")], "metric string, prior_value double, label string")
    got = {r.metric: r for r in reporting.kpi_delta(star.kpi_summary(fact), prior).collect()}
    assert (got["total_violations"].delta_pct, got["total_violations"].direction) == (-28.6, "better")
    assert got["avoidable_cost_nz"].direction == "unchanged"
    assert got["avoidable_carbon_nz"].direction == "No prior-month comparison"
    assert (got["s08_productivity_loss"].delta_pct, got["s08_productivity_loss"].direction) == (24.8, "worse")
    assert (got["avoidable_cost_au"].direction, got["avoidable_cost_au"].value) == ("Under Review", None)


def test_matrix_and_drill_down(spark, fact):
    assets = star.dim_assets(config.registry(spark))
    matrix = reporting.compliance_matrix(fact, assets)
    state = {(r.asset_id, r.department): r.state for r in matrix.collect()}
    assert len(state) == 10 * 5 + 3
    assert state["Asset_11_AU_Sydney", "Energy Compliance"] == "To Verify"
    assert state["Asset_11_AU_Sydney", "Finance / Legal"] == "Finding"
    assert state[site(1), "Energy Compliance"] == "Finding" and state[site(2), "Energy Compliance"] == "Clear"
    wide = {r.asset_id: r for r in reporting.compliance_matrix_wide(matrix).collect()}
    assert wide["Asset_11_AU_Sydney"]["Facilities"] is None and wide[site(6)]["Facilities"] == "Finding"
    picked = reporting.drill_down(fact, config.scenarios(spark), "Facilities", site(6)).collect()
    assert len(picked) == 8 and picked == sorted(picked, key=lambda r: (r.event_time, r.event_id))
    assert picked[0].audit_check == "Sub-Meter Calibration Drift"


def test_report_tables(spark, fact):
    assets, scen, p = star.dim_assets(config.registry(spark)), config.scenarios(spark), config.AuditParams()
    hours = reporting.ieq_exceedance(fact, assets, p).collect()
    assert [(r.site, r.exceedance_hours, r.compliant_hours, r.breach_pct, r.events) for r in hours] == [
        ("Auckland HQ / L6", 20.5, 265.5, 7.2, 6)]
    daily = reporting.ieq_daily(fact)
    assert daily.count() == 3
    total = reporting.ieq_daily_total(daily, p).collect()[0]
    assert (total.exceedance_hours, total.peak_co2) == (round(sum(ZONE_MINUTES) / 60, 1), 850)
    assert reporting.ieq_log(fact, assets, scen).count() == 62
    assert reporting.energy_event_log(fact, assets, scen).count() == 24
    marks = {r.label: (r.mark, r.end_time - r.event_time) for r in reporting.energy_timeline(fact, assets).collect()}
    assert {m for m, _ in marks.values()} == {"point", "span"} and marks["Sub-Meter Drift"][1].seconds == 3600
    found = {r.scenario: r for r in reporting.evidence_findings(fact, assets).collect()}
    assert (found["S11"].site, found["S11"].amount) == ("EMP_002", "AUD 2,800")
    assert (found["S09"].state, found["S09"].amount) == ("Under Review", None)
    assert found["S02"].site == "Sydney Office / 88 Phillip St"
    log = {r.audit_check: r for r in reporting.evidence_log(fact, assets, scen).collect()}
    assert log["Invoice vs. NABERS Benchmark"].finding == (
        "Analysis suspended — invoice authenticity under review. More.")
    assert log["Scope 3 Travel Class Audit"].site == "EMP_002"
    assert log["Scope 3 Travel Class Audit"].standard_breached == "GHG Protocol Scope 3 Cat.6 · ISO 14083:2023"


def test_benchmark_reports(spark):
    assets, p = star.dim_assets(config.registry(spark)), config.AuditParams()
    nz = spark.createDataFrame(
        [(site(1), 1.175, 113.8, 96.8, True), (site(9), 0.796, 77.0, 96.8, False)],
        "asset_id string, nabersnz_ratio double, ytd_actual_mj_sqm double, budget_mj_sqm double, breach boolean")
    got = reporting.benchmark_rank(nz, assets, p).collect()
    assert [(r.asset_id, r.benchmark_status, r.authorised_budget_mj_sqm) for r in got] == [
        (site(9), "Within Budget", 116.2), (site(1), "Above Budget", None)]
    au = spark.createDataFrame(
        [("Asset_11_AU_Sydney", 265.0, 165.0, True, True), ("b", 200.0, 165.0, True, False), ("c", 1.0, 165.0, False, False)],
        "asset_id string, ytd_actual_mj_sqm double, budget_mj_sqm double, breach boolean, suspended boolean")
    assert {r.site: r.benchmark_status for r in reporting.benchmark_au_status(au, assets).collect()} == {
        "Sydney Office / 88 Phillip St": "Under Review", "b": "Above Budget", "c": "Within Budget"}


def test_emit_position_is_internal(fact):
    assert not set(EMIT) & set(fact.columns)
