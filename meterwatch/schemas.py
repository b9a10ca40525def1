"""Fixed schemas of every input and output table."""

from __future__ import annotations

TELEMETRY = (
    "timestamp timestamp_ntz, asset_id string, indoor_co2_ppm bigint, indoor_temp_c double, "
    "total_power_kw double, hvac_power_kw double, lighting_power_kw double, it_load_power_kw double, "
    "emissions_co2_kg double, audit_trait string, crypto_signature string"
)
WEATHER = "timestamp timestamp_ntz, outdoor_temp_c double, day_type string"
WEATHER_PAYLOAD = "hourly struct<time: array<string>, temperature_2m: array<double>>"
EXEMPTIONS = (
    "exemption_id string, asset_id string, scenario_id string, start_time timestamp_ntz, "
    "end_time timestamp_ntz, application_type string"
)
INVOICES = (
    "asset_id string, billing_month date, actual_billed_kwh double, inferred_kwh double, "
    "uploaded_pdf_hash string, original_crypto_signature string"
)
TRAVEL = (
    "ticket_id bigint, employee_id string, route string, booked_class string, "
    "ticket_price_aud double, flight_hours double"
)
WASTE = (
    "manifest_id string, asset_id string, waste_type string, disposal_date string, "
    "quantity_kg double, disposal_cert_url string"
)
PRIOR = "metric string, prior_value double, label string"
REGISTRY = (
    "asset_ord bigint, asset_id string, area_sqm double, occupant_count bigint, region string, "
    "location string, has_iot boolean, space_designation string, display_name string"
)
SCENARIO = (
    "scenario string, scenario_name string, department string, audit_group string, "
    "severity_level string, engine string, standard string"
)

# Position of an event in the emit order; carried by the logs, dropped from published tables.
EMIT = ["emit_group", "emit_entity"]

FACILITY_LOG = [
    "start_time", "end_time", "asset_id", "scenario", "status", "area_sqm",
    "anomaly_duration_mins", "total_assessed_mins", "waste_kwh", "financial_cost", "carbon_kg",
    "recommendation", "cognitive_loss_nzd", "avg_co2_ppm", "peak_co2_ppm", "occupants",
]
ENERGY_LOG = [
    "timestamp", "end_time", "asset_id", "scenario", "status", "area_sqm",
    "anomaly_duration_mins", "total_assessed_mins", "waste_kwh", "financial_cost", "carbon_kg",
    "nabersnz_ratio", "ytd_actual_mj_sqm", "nabersnz_budget_mj", "days_elapsed", "peak_hvac_kw",
    "cusum_trigger_date", "baseline_daily_kwh", "cusum_threshold", "avg_diff_ratio",
]
COMPLIANCE_LOG = [
    "ref_id", "asset_id", "scenario", "status", "detail", "financial_exposure", "carbon_kg",
    "billing_month", "route", "booked_class", "flight_hours", "ticket_price_aud", "employee_id",
    "waste_type", "disposal_date", "quantity_kg", "actual_billed_kwh", "inferred_kwh", "variance_pct",
]
FACT = [
    "asset_id", "scenario", "status", "category", "department", "event_time",
    "anomaly_duration_mins", "waste_kwh", "financial_cost", "financial_exposure", "carbon_kg",
    "cognitive_loss_nzd", "peak_co2_ppm", "nabersnz_ratio", "detail", "event_id", "region",
]
DIM_ASSETS = [
    "asset_id", "region", "location", "area_sqm", "occupant_count", "space_designation",
    "display_name", "has_iot",
]
