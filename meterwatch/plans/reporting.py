"""Reporting tables over the star schema. Each returns data; rendering is left to the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.config import DEPARTMENTS, UNMETERED_DEPARTMENTS, AuditParams
from meterwatch.functions.text import fixed, half_even, sql

AU_METRICS = ("avoidable_cost_au", "avoidable_carbon_au")


def with_site(df: DataFrame, assets: DataFrame) -> DataFrame:
    """Add `site`, the display name, falling back to the id."""
    return sql(
        """
        SELECT f.*, coalesce(a.display_name, f.asset_id) AS site
        FROM {df} f LEFT JOIN {assets} a ON f.asset_id = a.asset_id
        """,
        df=df, assets=assets,
    )


def with_check(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Add `audit_check`, the scenario name, falling back to the code, and the standard."""
    return sql(
        """
        SELECT f.*, coalesce(s.scenario_name, f.scenario) AS audit_check, s.standard
        FROM {fact} f LEFT JOIN {scenarios} s ON f.scenario = s.scenario
        """,
        fact=fact, scenarios=scenarios,
    )


def named_events(fact: DataFrame, assets: DataFrame, scenarios: DataFrame, where: str) -> DataFrame:
    return with_check(with_site(fact.where(where), assets), scenarios)


def kpi_delta(kpi: DataFrame, prior: DataFrame) -> DataFrame:
    """KPIs against the prior month; lower is better (M1). Of several prior values of a metric the greatest counts."""
    joined = f"""
        SELECT k.*, p.prior_value, metric IN {AU_METRICS} AND coalesce(note, '') <> '' AS held,
               CASE WHEN metric IN {AU_METRICS} THEN value_aud ELSE value_nzd END AS value
        FROM {{kpi}} k LEFT JOIN (SELECT metric, max(prior_value) AS prior_value FROM {{prior}} GROUP BY metric) p
          USING (metric)"""
    rated = f"""
        SELECT *, CASE WHEN NOT held AND prior_value <> 0 THEN (value - prior_value) / prior_value * 100 END AS change
        FROM ({joined})"""
    return sql(
        f"""
        SELECT metric, label, unit, CASE WHEN NOT held THEN value END AS value, prior_value,
               {half_even('change', 1)} AS delta_pct,
               CASE WHEN held THEN 'Under Review' WHEN change IS NULL THEN 'No prior-month comparison'
                    WHEN change > 0 THEN 'worse' WHEN change < 0 THEN 'better' ELSE 'unchanged' END AS direction
        FROM ({rated})
        """,
        kpi=kpi, prior=prior,
    )


def prior_of(kpi: DataFrame) -> DataFrame:
    """A month's KPIs as the prior values of the next one (SRC2)."""
    value = f"CASE WHEN metric IN {AU_METRICS} THEN value_aud ELSE value_nzd END"
    return kpi.selectExpr("metric", f"CAST({value} AS DOUBLE) AS prior_value", "label")


def compliance_matrix(fact: DataFrame, assets: DataFrame) -> DataFrame:
    """Every (asset, department) with its finding flag (M2).

    Departments are a fixed short list per region, laid out beside each asset. Australian assets
    show three departments, of which energy compliance always awaits verification.
    """
    cells = f"""
        SELECT asset_id, display_name, region,
               explode(CASE region WHEN 'AU' THEN array{UNMETERED_DEPARTMENTS} ELSE array{DEPARTMENTS} END) AS department
        FROM {{assets}} WHERE region IN ('NZ', 'AU')"""
    found = "SELECT asset_id, department, count(*) AS findings FROM {fact} GROUP BY 1, 2"
    return sql(
        f"""
        SELECT asset_id, display_name, region, department, coalesce(findings, 0) AS findings,
               CASE WHEN region = 'AU' AND department = 'Energy Compliance' THEN 'To Verify'
                    WHEN findings > 0 THEN 'Finding' ELSE 'Clear' END AS state
        FROM ({cells}) LEFT JOIN ({found}) USING (asset_id, department)
        """,
        assets=assets, fact=fact,
    )


def compliance_matrix_wide(matrix: DataFrame) -> DataFrame:
    """The matrix with one column per department."""
    keyed = matrix.groupBy("asset_id", "display_name", "region")
    return keyed.pivot("department", list(DEPARTMENTS)).agg({"state": "max"})


def short_label(asset_id: str) -> str:
    """Compact asset label (M3)."""
    return f"replace(replace(replace({asset_id}, 'Asset_', 'A'), '_NZ_Boundary', ''), '_AU_Sydney', ' SYD')"


def drill_down(
    fact: DataFrame, scenarios: DataFrame, department: str | None = None, asset_id: str | None = None
) -> DataFrame:
    """Events of a department and an asset in time order; None selects all (M4)."""
    picked = fact
    if department is not None:
        picked = picked.where(picked.department == department)
    if asset_id is not None:
        picked = picked.where(picked.asset_id == asset_id)
    return sql(
        """
        SELECT asset_id, department, event_id, audit_check, event_time, anomaly_duration_mins, financial_cost,
               financial_exposure, carbon_kg, detail
        FROM {events} ORDER BY event_time NULLS LAST, event_seq
        """,
        events=with_check(picked, scenarios),
    )


def ieq_exceedance(fact: DataFrame, assets: DataFrame, p: AuditParams, scenario: str = "S06") -> DataFrame:
    """Hours in breach and within limits of the working month per asset (M5 for S06, M6 for S08)."""
    per_asset = sql(
        f"""
        SELECT asset_id, sum(anomaly_duration_mins) / 60 AS hours, count(*) AS events
        FROM {{fact}} WHERE scenario = '{scenario}' GROUP BY asset_id
        """,
        fact=fact,
    )
    return with_site(per_asset, assets).selectExpr(
        "asset_id", "site",
        f"{half_even('hours', 2)} AS exceedance_hours",
        f"{half_even(f'{p.working_hours}D - hours', 2)} AS compliant_hours",
        f"{half_even(f'hours / {p.working_hours}D * 100', 1)} AS breach_pct",
        "events",
    )


def ieq_daily(fact: DataFrame) -> DataFrame:
    """S08 per day: hours, peak CO2, events (M7)."""
    return sql(
        f"""
        SELECT to_date(event_time) AS date, {half_even('sum(anomaly_duration_mins) / 60', 2)} AS exceedance_hours,
               CAST(max(peak_co2_ppm) AS BIGINT) AS peak_co2, count(*) AS events
        FROM {{fact}} WHERE scenario = 'S08' GROUP BY 1
        """,
        fact=fact,
    )


def ieq_daily_total(daily: DataFrame, p: AuditParams) -> DataFrame:
    """Totals over the daily table: rounded hours added up, highest peak (M7)."""
    hours = "sum(exceedance_hours)"
    return sql(
        f"""
        SELECT {half_even(hours, 1)} AS exceedance_hours,
               {half_even(f'{hours} / {p.working_hours}D * 100', 1)} AS breach_pct, max(peak_co2) AS peak_co2
        FROM {{daily}}
        """,
        daily=daily,
    )


def ieq_log(fact: DataFrame, assets: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Indoor environment events in time order (M8)."""
    return sql(
        """
        SELECT event_id, site, audit_check, event_time, peak_co2_ppm, anomaly_duration_mins, detail
        FROM {events} ORDER BY event_time NULLS LAST, event_seq
        """,
        events=named_events(fact, assets, scenarios, "scenario IN ('S06', 'S08')"),
    )


def energy_event_log(fact: DataFrame, assets: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Energy events in time order with their quantities."""
    return sql(
        """
        SELECT event_id, site, audit_check, event_time, anomaly_duration_mins, waste_kwh, financial_cost, carbon_kg
        FROM {events} ORDER BY event_time NULLS LAST, event_seq
        """,
        events=named_events(fact, assets, scenarios, "scenario IN ('S04', 'S05', 'S07', 'S10')"),
    )


def benchmark_rank(summary: DataFrame, assets: DataFrame, p: AuditParams) -> DataFrame:
    """NZ benchmark position by rising intensity; high-demand zones get a raised budget (M9)."""
    raised = half_even("budget_mj_sqm * {zone_budget_factor}", 1)
    return sql(
        f"""
        SELECT asset_id, coalesce(display_name, asset_id) AS site, nabersnz_ratio, ytd_actual_mj_sqm, budget_mj_sqm,
               CASE WHEN breach THEN 'Above Budget' ELSE 'Within Budget' END AS benchmark_status,
               CASE space_designation WHEN 'HIGH_DEMAND' THEN {raised} END AS authorised_budget_mj_sqm
        FROM {{summary}} LEFT JOIN (SELECT asset_id, display_name, space_designation FROM {{assets}}) USING (asset_id)
        ORDER BY ytd_actual_mj_sqm, asset_id
        """,
        p, summary=summary, assets=assets,
    )


def benchmark_au_status(summary: DataFrame, assets: DataFrame) -> DataFrame:
    """Australian benchmark position, under review while suspended."""
    return with_site(summary, assets).selectExpr(
        "asset_id", "site", "ytd_actual_mj_sqm", "budget_mj_sqm",
        "CASE WHEN coalesce(suspended, true) THEN 'Under Review' WHEN breach THEN 'Above Budget' "
        "ELSE 'Within Budget' END AS benchmark_status",
    )


def energy_timeline(fact: DataFrame, assets: DataFrame) -> DataFrame:
    """Energy events with computed end, label and mark: points, or a span for S07."""
    return sql(
        """
        SELECT asset_id, site, CASE scenario WHEN 'S04' THEN 'Sub-Meter Drift' WHEN 'S05' THEN 'After-Hours Waste'
                 ELSE 'Efficiency Degradation' END AS label, event_time,
               event_time + make_dt_interval(0, 0, 0, CAST(anomaly_duration_mins * 60 AS BIGINT)) AS end_time,
               CASE scenario WHEN 'S07' THEN 'span' ELSE 'point' END AS mark,
               anomaly_duration_mins, waste_kwh, financial_cost
        FROM {events}
        """,
        events=with_site(fact.where("scenario IN ('S04', 'S05', 'S07')"), assets),
    )


def evidence_findings(fact: DataFrame, assets: DataFrame) -> DataFrame:
    """Flagged invoices, billing reconciliation, travel and waste findings.

    Travel findings name an employee, who is shown by id.
    """
    held = "contains(status, 'SUSPENDED')"
    price = f"concat('AUD ', {fixed('financial_exposure', 0, grouped=True)})"
    exposure = f"concat('AUD ', {fixed('financial_exposure', 2, grouped=True)})"
    return sql(
        f"""
        SELECT scenario, CASE scenario WHEN 'S11' THEN asset_id ELSE site END AS site,
               CASE WHEN scenario = 'S02' THEN 'Flagged invoice' WHEN scenario = 'S11' THEN 'Flagged travel'
                    WHEN scenario = 'S12' THEN 'Uncertified waste' WHEN {held} THEN 'Under Review' ELSE 'Variance' END AS state,
               CASE WHEN scenario = 'S11' THEN {price} WHEN scenario = 'S09' AND NOT {held} THEN {exposure} END AS amount,
               CASE WHEN scenario = 'S09' AND {held} THEN 'Invoice authenticity under review. Billing variance analysis will resume once document integrity is confirmed.'
                    ELSE detail END AS finding
        FROM {{events}}
        """,
        events=with_site(fact.where("scenario IN ('S02', 'S09', 'S11', 'S12')"), assets),
    )


def evidence_log(fact: DataFrame, assets: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Compliance events with names, breached standard and reader-facing text."""
    return sql(
        """
        SELECT event_id, CASE WHEN contains(asset_id, 'Asset') THEN site ELSE asset_id END AS site, audit_check,
               standard AS standard_breached,
               replace(detail, 'S09 analysis suspended — upstream S02 hash breach unresolved.',
                       'Analysis suspended — invoice authenticity under review.') AS finding
        FROM {events}
        """,
        events=named_events(fact, assets, scenarios, "category = 'Compliance'"),
    )
