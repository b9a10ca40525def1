"""Facility rules: unknown devices (S01), data gaps (S03), ventilation (S06), high-demand zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meterwatch.config import AuditParams
from meterwatch.functions.text import columns, half_even, holds, sql
from meterwatch.operators.exemptions import drop_exempt
from meterwatch.operators.prep import metered
from meterwatch.operators.profile import asset_profile
from meterwatch.operators.runs import RunRule, sustained_events
from meterwatch.schemas import EMIT, FACILITY_LOG

ADVICE = "'Monitor and increase fresh air supply'"
STATUS = {
    "S01": "'L0_UNAUTHORIZED_ASSET'",
    "S03": "'L1_TIMESERIES_GAP'",
    "S06": "'L1_IEQ_GREENWASHING'",
    "S08": "'L2_HIGH_DEMAND_IEQ_GAP'",
}
READING_ORDER = ("indoor_co2_ppm", "indoor_temp_c")

# Columns a rule does not set: no energy, and no air quality figures.
DEFAULTS = {
    "waste_kwh": "0D", "financial_cost": "0D", "carbon_kg": "0D",
    "recommendation": "CAST(NULL AS STRING)", "cognitive_loss_nzd": "CAST(NULL AS DOUBLE)",
    "avg_co2_ppm": "CAST(NULL AS DOUBLE)", "peak_co2_ppm": "CAST(NULL AS BIGINT)",
    "occupants": "CAST(NULL AS BIGINT)", "emit_group": "1", "emit_entity": "asset_ord",
}


def _log(**values: str) -> str:
    return columns([*FACILITY_LOG, *EMIT], **{**DEFAULTS, **values})


def unauthorised_totals(profile: DataFrame, registry: DataFrame) -> DataFrame:
    """Readings of unregistered devices, with their unverified energy (kept out of all KPIs).

    The profile has reduced readings to one row per device before the registry is consulted.
    """
    return sql(
        """
        SELECT t.asset_id, n_rows, first_ts AS start_time, last_ts AS end_time, kwh AS kwh_unverified
        FROM {profile} t LEFT ANTI JOIN {registry} r ON t.asset_id = r.asset_id
        """,
        profile=profile, registry=registry,
    )


def unauthorised(profile: DataFrame, registry: DataFrame, p: AuditParams) -> DataFrame:
    """One event per device that is not registered."""
    minutes = f"n_rows * {p.slot_minutes}"
    log = _log(
        scenario="'S01'", status=STATUS["S01"], area_sqm="0D", anomaly_duration_mins=minutes,
        total_assessed_mins=minutes, emit_group="0", emit_entity="0L",
    )
    return sql(f"SELECT {log} FROM {{devices}}", devices=unauthorised_totals(profile, registry))


def telemetry_gaps(slots: DataFrame, registry: DataFrame, p: AuditParams) -> DataFrame:
    """One event per metered asset whose month is less than 95 % complete, from the profile with missing slots."""
    log = _log(
        start_time="first_ts", end_time="last_ts", scenario="'S03'", status=STATUS["S03"],
        anomaly_duration_mins="missing_mins",
    )
    return sql(
        f"SELECT {log} FROM {{gaps}} JOIN {{sites}} USING (asset_id) WHERE completeness < {{completeness}}",
        p, gaps=slots, sites=metered(registry),
    )


def air_quality_rules(p: AuditParams, scenarios: Sequence[str]) -> list[RunRule]:
    uncomfortable = (
        f"{holds(f'indoor_co2_ppm > {p.zone_co2_ppm}')} OR {holds(f'indoor_temp_c < {p.zone_temp_low}D')} "
        f"OR {holds(f'indoor_temp_c > {p.zone_temp_high}D')}"
    )
    peak = {"co2_max": "indoor_co2_ppm"}
    rules = {
        "S06": RunRule("S06", f"indoor_co2_ppm > {p.co2_ppm}", p.co2_rows, peaks=peak),
        "S08": RunRule(
            "S08", uncomfortable, p.zone_rows, peaks=peak,
            sums={"co2_sum": "indoor_co2_ppm", "co2_n": "CAST(indoor_co2_ppm IS NOT NULL AS INT)"},
        ),
    }
    return [rules[s] for s in scenarios]


def air_quality(
    telemetry: DataFrame, registry: DataFrame, exemptions: DataFrame, p: AuditParams,
    scenarios: Sequence[str] = ("S06", "S08"), profile: DataFrame | None = None,
) -> DataFrame:
    """S06 and S08 from one ordered pass over the readings; a stored profile saves another one.

    The registry is joined to the finished events and to the per-asset profile, not to readings.
    """
    runs = sustained_events(
        telemetry, air_quality_rules(p, scenarios), tiebreak=READING_ORDER, chunk_hours=p.chunk_hours
    )
    return air_quality_events(runs, registry, exemptions, p, profile or asset_profile(telemetry, p), scenarios)


def air_quality_events(
    runs: DataFrame, registry: DataFrame, exemptions: DataFrame, p: AuditParams, profile: DataFrame,
    scenarios: Sequence[str] = ("S06", "S08"),
) -> DataFrame:
    """Log rows of finished runs."""
    found = sql(
        """
        SELECT * FROM {sites} JOIN (SELECT asset_id, total_assessed_mins FROM {profile}) USING (asset_id)
          JOIN (SELECT *, rule AS scenario FROM {runs}) USING (asset_id)
        WHERE scenario = 'S06' OR space_designation = 'HIGH_DEMAND'
        """,
        sites=metered(registry), profile=profile, runs=runs,
    )
    zone = lambda x: f"CASE WHEN scenario = 'S08' THEN {x} END"
    figures = {}
    if "S08" in scenarios:
        staff = "coalesce(occupant_count, 0L)"
        loss = f"{staff} * {p.salary_nzd}D * {p.impairment}D * (n_rows * {p.slot_minutes} / {p.work_minutes}D)"
        figures = {
            "cognitive_loss_nzd": zone(half_even(loss, 2)),
            "avg_co2_ppm": zone(half_even("try_divide(co2_sum, co2_n)", 0)),
            "peak_co2_ppm": zone("CAST(co2_max AS BIGINT)"),
            "occupants": zone(staff),
        }
    log = _log(
        status=f"CASE scenario WHEN 'S08' THEN {STATUS['S08']} ELSE {STATUS['S06']} END",
        anomaly_duration_mins=f"n_rows * {p.slot_minutes}", recommendation=ADVICE, **figures,
    )
    return sql(f"SELECT {log} FROM {{events}}", events=drop_exempt(found, exemptions, profile))
