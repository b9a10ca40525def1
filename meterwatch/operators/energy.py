"""Energy rules: sub-meter drift (S04), after-hours running (S05), degradation (S07), benchmark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meterwatch.config import GUARD, AuditParams
from meterwatch.functions.text import (
    assessed_minutes, carbon_nz, columns, cost_nzd, half_even, holds, sql, whole_minutes,
)
from meterwatch.operators.exemptions import drop_exempt
from meterwatch.operators.prep import metered
from meterwatch.operators.profile import asset_profile, cusum, hourly_baseline
from meterwatch.operators.runs import CHUNK, RunRule, chunk_runs, chunks_of_days, run_events, with_chunk
from meterwatch.schemas import EMIT, ENERGY_LOG

STATUS = {
    "S04": "'L2_METER_LEAKAGE'",
    "S05": "'L2_AFTER_HOURS_SPIKE'",
    "S07": "'L2_EFFICIENCY_DEGRADATION'",
    "S10": "'L1_NABERSNZ_BREACH'",
}
READING_ORDER = ("hvac_power_kw", "total_power_kw", "lighting_power_kw", "it_load_power_kw")

# Columns that only some rules set.
DEFAULTS = {
    "nabersnz_ratio": "CAST(NULL AS DOUBLE)", "ytd_actual_mj_sqm": "CAST(NULL AS DOUBLE)",
    "nabersnz_budget_mj": "CAST(NULL AS DOUBLE)", "days_elapsed": "CAST(NULL AS BIGINT)",
    "peak_hvac_kw": "CAST(NULL AS DOUBLE)", "cusum_trigger_date": "CAST(NULL AS STRING)",
    "baseline_daily_kwh": "CAST(NULL AS DOUBLE)", "cusum_threshold": "CAST(NULL AS DOUBLE)",
    "avg_diff_ratio": "CAST(NULL AS DOUBLE)", "emit_group": "1", "emit_entity": "asset_ord",
}


def _log(p: AuditParams, **values: str) -> str:
    """Select list of the energy log; cost and carbon come from the unrounded `kwh`."""
    priced = {
        "waste_kwh": half_even("kwh", 4), "financial_cost": cost_nzd("kwh", p), "carbon_kg": carbon_nz("kwh", p),
    }
    return columns([*ENERGY_LOG, *EMIT], **{**DEFAULTS, **priced, **values})


def after_hours(p: AuditParams) -> str:
    """Weekends, and weekday hours outside business time; an unknown day class is out of scope."""
    closed = f"(hour(timestamp) < {p.open_hour} OR hour(timestamp) >= {p.close_hour})"
    return f"day_type = 'WEEKEND' OR (day_type = 'WEEKDAY' AND {closed})"


def with_hour_limit(chunked: DataFrame, baseline: DataFrame, chunks: DataFrame) -> DataFrame:
    """Attach each row's (asset, hour) limit.

    The up to 24 limits of an asset are packed into one map and repeated per (asset, chunk) of `chunks`, so
    that the join uses the key by which the rows are ordered afterwards: readings shuffle once,
    and an asset with very many readings is spread over its chunks.
    """
    limits = sql(
        f"""
        SELECT asset_id, {CHUNK}, limits
        FROM {{chunks}}
        JOIN (SELECT asset_id, map_from_entries(collect_list(struct(hour, limit_kw))) AS limits
              FROM {{baseline}} WHERE limit_kw IS NOT NULL GROUP BY asset_id) USING (asset_id)
        """,
        chunks=chunks, baseline=baseline,
    )
    return sql(
        f"""
        SELECT r.*, try_element_at(l.limits, hour(r.timestamp)) AS limit_kw
        FROM {{readings}} r LEFT JOIN {{limits}} l ON r.asset_id = l.asset_id AND r.{CHUNK} = l.{CHUNK}
        """,
        readings=chunked, limits=limits,
    )


def power_rules(p: AuditParams, scenarios: Sequence[str]) -> list[RunRule]:
    gap = "abs(total_power_kw - (hvac_power_kw + lighting_power_kw + it_load_power_kw))"
    ratio = f"try_divide({gap}, total_power_kw + {GUARD}D)"
    rules = {
        "S04": RunRule(
            "S04", f"{ratio} > {p.leak_ratio}D", p.leak_rows, sums={"gap_kw": gap, "gap_ratio": ratio}
        ),
        "S05": RunRule(
            "S05", "hvac_power_kw > limit_kw", p.idle_rows, scope=after_hours(p),
            sums={"excess_kw": "greatest(hvac_power_kw - limit_kw, 0D)"}, peaks={"hvac_max": "hvac_power_kw"},
        ),
    }
    return [rules[s] for s in scenarios]


def power_events(
    telemetry: DataFrame, enriched: DataFrame, registry: DataFrame, exemptions: DataFrame, p: AuditParams,
    scenarios: Sequence[str] = ("S04", "S05"), profile: DataFrame | None = None, days: DataFrame | None = None,
) -> DataFrame:
    """S04 and S05 from one ordered pass over the enriched readings.

    Baselines and the asset profile need no weather and read plain telemetry. A profile and a daily
    rollup that are already stored save a pass over the readings each.
    """
    baseline = hourly_baseline(telemetry, p) if "S05" in scenarios else None
    runs = run_events(power_runs(enriched, p, scenarios, baseline, days), power_rules(p, scenarios))
    return power_log(runs, registry, exemptions, p, profile or asset_profile(telemetry, p), scenarios)


def power_runs(
    enriched: DataFrame, p: AuditParams, scenarios: Sequence[str] = ("S04", "S05"), baseline: DataFrame | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Runs of S04 and S05 per chunk of the enriched readings, S05 against the limits of `baseline`."""
    readings = with_chunk(enriched, p.chunk_hours)
    if "S05" in scenarios:
        seen = chunks_of_days(days, p.chunk_hours) if days else readings.select("asset_id", CHUNK).distinct()
        readings = with_hour_limit(readings, baseline, seen)
    return chunk_runs(readings, power_rules(p, scenarios), tiebreak=READING_ORDER)


def power_log(
    runs: DataFrame, registry: DataFrame, exemptions: DataFrame, p: AuditParams, profile: DataFrame,
    scenarios: Sequence[str] = ("S04", "S05"),
) -> DataFrame:
    """Log rows of finished runs."""
    minutes = f"n_rows * {p.slot_minutes}"
    leak_kwh = f"gap_kw / n_rows * ({minutes} / 60D)" if "S04" in scenarios else "0D"
    idle_kwh = f"excess_kw * {p.slot_hours}D" if "S05" in scenarios else "0D"
    found = sql(
        f"""
        SELECT *, CASE scenario WHEN 'S04' THEN {leak_kwh} ELSE {idle_kwh} END AS kwh
        FROM {{sites}} JOIN (SELECT asset_id, total_assessed_mins FROM {{profile}}) USING (asset_id)
          JOIN (SELECT *, rule AS scenario FROM {{runs}}) USING (asset_id)
        """,
        sites=metered(registry), profile=profile, runs=runs,
    )
    extras = {}
    if "S04" in scenarios:
        extras["avg_diff_ratio"] = f"CASE scenario WHEN 'S04' THEN {half_even('gap_ratio / n_rows', 4)} END"
    if "S05" in scenarios:
        extras["peak_hvac_kw"] = f"CASE scenario WHEN 'S05' THEN {half_even('hvac_max', 2)} END"
    log = _log(
        p, timestamp="start_time", anomaly_duration_mins=minutes,
        status=f"CASE scenario WHEN 'S04' THEN {STATUS['S04']} ELSE {STATUS['S05']} END", **extras,
    )
    return sql(f"SELECT {log} FROM {{events}}", events=drop_exempt(found, exemptions, profile))


def asset_verdicts(days: DataFrame, registry: DataFrame, p: AuditParams) -> DataFrame:
    """One row per metered asset with all inputs of S07, S10 and the benchmark summary.

    Both rules read the same daily rollup of the enriched readings.
    """
    per_asset = sql(
        """
        SELECT asset_id, sum(n_rows) AS n_rows, min(first_ts) AS first_ts, max(last_ts) AS last_ts,
               sum(total_kwh) AS total_kwh, sum(cdd_hours) AS cdd_hours, max(mu) AS mu,
               max(threshold) AS threshold, max(clean_days) AS clean_days,
               min(date) FILTER (WHERE alarm) AS alarm_date,
               count_if(NOT clean_day) AS dirty_days,
               coalesce(sum(greatest(hvac_kwh - mu, 0D)) FILTER (WHERE NOT clean_day), 0D) AS excess_kwh,
               min(dirty_from) AS dirty_from, max(dirty_to) AS dirty_to
        FROM {days} GROUP BY asset_id
        """,
        days=cusum(days, p),
    )
    measured = f"""
        SELECT *, n_rows / {{expected_rows}} >= {{completeness}} AS complete,
               {assessed_minutes('first_ts', 'last_ts', p.slot_minutes)} AS total_assessed_mins,
               greatest({whole_minutes('first_ts', 'last_ts')} DIV 1440, 1L) AS days_elapsed,
               total_kwh * {{mj_per_kwh}} AS actual_mj,
               ({{base_mj_sqm}} + {{mj_per_cdd}} * cdd_hours) * area_sqm AS budget_mj
        FROM {{sites}} JOIN {{per_asset}} USING (asset_id)"""
    rated = f"""
        SELECT *, {holds('complete AND budget_mj > 0')} AS assessed,
               complete AND clean_days >= {{min_clean_days}} AS baselined,
               CASE WHEN budget_mj > 0 THEN actual_mj / budget_mj END AS ratio
        FROM ({measured})"""
    return sql(
        f"""
        SELECT *, {holds('assessed AND ratio > {overrun_ratio}')} AS breach,
               baselined AND alarm_date IS NOT NULL AS degraded
        FROM ({rated})
        """,
        p, sites=metered(registry), per_asset=per_asset,
    )


def verdict_events(
    verdicts: DataFrame, exemptions: DataFrame, p: AuditParams,
    scenarios: Sequence[str] = ("S07", "S10"),
) -> DataFrame:
    """S07 and S10 events of the per-asset verdicts; S07 exemptions are tested on the alarm date."""
    held = {"S07": "degraded", "S10": "breach"}
    fired = ", ".join(f"CASE WHEN {held[s]} THEN '{s}' END" for s in scenarios)
    found = sql(
        f"""
        SELECT *, CASE scenario WHEN 'S07' THEN CAST(alarm_date AS TIMESTAMP_NTZ) END AS tested_at,
               CASE scenario WHEN 'S07' THEN excess_kwh ELSE (actual_mj - budget_mj) / {{mj_per_kwh}} END AS kwh
        FROM (SELECT *, explode(array_compact(array({fired}))) AS scenario FROM {{verdicts}})
        """,
        p, verdicts=verdicts,
    )
    drift = lambda x: f"CASE scenario WHEN 'S07' THEN {x} END"
    bench = lambda x: f"CASE scenario WHEN 'S10' THEN {x} END"
    either = lambda s07, s10: f"CASE scenario WHEN 'S07' THEN {s07} ELSE {s10} END"
    log = _log(
        p,
        timestamp=either("dirty_from", "first_ts"), end_time=either("dirty_to", "last_ts"),
        status=either(STATUS["S07"], STATUS["S10"]),
        anomaly_duration_mins=either("dirty_days", "days_elapsed") + " * 1440",
        nabersnz_ratio=bench(half_even("ratio", 3)),
        ytd_actual_mj_sqm=bench(half_even("actual_mj / area_sqm", 1)),
        nabersnz_budget_mj=bench(half_even("budget_mj", 1)),
        days_elapsed=bench("days_elapsed"),
        cusum_trigger_date=drift("date_format(alarm_date, 'yyyy-MM-dd')"),
        baseline_daily_kwh=drift(half_even("mu", 1)),
        cusum_threshold=drift(half_even("threshold", 1)),
    )
    return sql(f"SELECT {log} FROM {{events}}", events=drop_exempt(found, exemptions, verdicts, at="tested_at"))


def benchmark_summary(verdicts: DataFrame) -> DataFrame:
    """Intensity against budget of every assessed asset, breaching or not (SUM-NZ)."""
    return verdicts.where("assessed").selectExpr(
        "asset_id",
        f"{half_even('ratio', 3)} AS nabersnz_ratio",
        f"{half_even('actual_mj / area_sqm', 1)} AS ytd_actual_mj_sqm",
        f"{half_even('budget_mj / area_sqm', 1)} AS budget_mj_sqm",
        "breach",
    )
