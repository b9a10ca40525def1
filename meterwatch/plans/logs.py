"""The three audit logs and the reports over rule outcomes."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

from meterwatch.config import AuditParams
from meterwatch.functions.sizing import stored_table
from meterwatch.functions.text import half_even, sql
from meterwatch.operators import energy, evidence, facility
from meterwatch.operators.prep import enrich
from meterwatch.operators.profile import daily_rollup, slot_profile


@dataclass(frozen=True)
class AuditInputs:
    """The tables an audit reads. `invoices`, `travel` and `waste` carry `row_ord`.

    `rejects` counts the readings left out, `quarantine` holds the values that failed their schema, `prior` last month's
    KPIs; an audit works without them.
    """

    telemetry: DataFrame
    weather: DataFrame
    registry: DataFrame
    exemptions: DataFrame
    invoices: DataFrame
    travel: DataFrame
    waste: DataFrame
    params: AuditParams = field(default_factory=AuditParams)
    rejects: DataFrame | None = None
    prior: DataFrame | None = None
    quarantine: DataFrame | None = None


def enriched(a: AuditInputs) -> DataFrame:
    return enrich(a.telemetry, a.weather, a.params)


def asset_profile(a: AuditInputs) -> DataFrame:
    """One row per asset for S01, S03 and the assessed time of all events."""
    return slot_profile(a.telemetry, a.params)


def daily(a: AuditInputs) -> DataFrame:
    """One row per asset and day for S07, S10 and the days that S05 looks at."""
    return daily_rollup(enriched(a), a.params)


def facility_events(a: AuditInputs, profile: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One pass over the readings beside the profile, none if the runs are known."""
    p = a.params
    if runs is None:
        air = facility.air_quality(a.telemetry, a.registry, a.exemptions, p, profile=profile)
    else:
        air = facility.air_quality_events(runs, a.registry, a.exemptions, p, profile)
    return (
        facility.unauthorised(profile, a.registry, p)
        .unionByName(facility.telemetry_gaps(profile, a.registry, p))
        .unionByName(air)
    )


def energy_events(
    a: AuditInputs, profile: DataFrame, days: DataFrame, verdicts: DataFrame, runs: DataFrame | None = None
) -> DataFrame:
    """Two passes over the readings beside profile and daily rollup, none if the runs are known."""
    p = a.params
    if runs is None:
        power = energy.power_events(
            a.telemetry, enriched(a), a.registry, a.exemptions, p, profile=profile, days=days
        )
    else:
        power = energy.power_log(runs, a.registry, a.exemptions, p, profile)
    return power.unionByName(energy.verdict_events(verdicts, a.exemptions, p))


def compliance_events(a: AuditInputs) -> DataFrame:
    """S02, S09, S11 and S12. The findings of S02 are stored: S09 takes its untrusted assets from them."""
    p = a.params
    hashes = stored_table(evidence.hash_integrity(a.invoices), "hash_findings")
    return (
        hashes.unionByName(evidence.billing_variance(a.invoices, a.registry, p, hashes))
        .unionByName(evidence.travel_class(a.travel, p))
        .unionByName(evidence.hazardous_waste(a.waste, p))
    )


def scenario_totals(energy_log: DataFrame, compliance_log: DataFrame) -> DataFrame:
    """Energy, money and carbon per scenario, two decimals (RPT1)."""
    measures = ("waste_kwh", "financial_cost", "financial_exposure", "carbon_kg")
    per_event = energy_log.select("scenario", "waste_kwh", "financial_cost", "carbon_kg").unionByName(
        compliance_log.select("scenario", "financial_exposure", "carbon_kg"), allowMissingColumns=True
    )
    totals = ", ".join(f"{half_even(f'coalesce(sum({m}), 0D)', 2)} AS {m}" for m in measures)
    return sql(f"SELECT scenario, {totals} FROM {{events}} GROUP BY scenario", events=per_event)


def outcome_counts(a: AuditInputs, profile: DataFrame, days: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Checked records per scenario and outcome, compliant and skipped ones included (RPT2).

    Readings are not read again: profile, daily rollup and verdicts hold their counts.
    `amount` is the unverified energy for S01 and the row count otherwise.
    """
    p = a.params

    def counted(scenario: str, outcome: str, df: DataFrame, amount: str = "CAST(count(*) AS DOUBLE)") -> DataFrame:
        return sql(
            f"SELECT '{scenario}' AS scenario, {outcome} AS outcome, count(*) AS n, {amount} AS amount "
            "FROM {df} GROUP BY 1, 2",
            df=df,
        )

    devices = facility.unauthorised_totals(profile, a.registry)
    baseline = sql(
        """
        SELECT 'S05' AS scenario, outcome, sum(n) AS n, CAST(sum(n) AS DOUBLE) AS amount
        FROM (SELECT inline(array(struct('baseline_row' AS outcome, clean_rows AS n),
                                  struct('excluded_row' AS outcome, n_rows - clean_rows AS n))) FROM {days})
        WHERE n > 0 GROUP BY outcome
        """,
        days=days,
    )
    skipped = "CASE WHEN NOT complete THEN 'skipped_incomplete'"
    parts = [
        counted("S01", "'unverified'", devices, half_even("sum(kwh_unverified)", 2)),
        counted("S02", f"coalesce({evidence.HASH_OUTCOME}, 'verified')", a.invoices),
        baseline,
        counted(
            "S07", f"{skipped} WHEN NOT baselined THEN 'skipped_no_baseline' "
            "WHEN degraded THEN 'alarm' ELSE 'no_degradation' END", verdicts,
        ),
        counted("S09", "coalesce(status, 'within_threshold')", evidence.billing_checks(a.invoices, a.registry, p)),
        counted("S10", f"{skipped} WHEN breach THEN 'breach' ELSE 'on_track' END", verdicts),
        counted("S11", f"CASE WHEN {evidence.short_haul_business(p)} THEN 'flagged' ELSE 'compliant' END", a.travel),
        counted("S12", evidence.waste_outcome(p), a.waste),
    ]
    return reduce(DataFrame.unionByName, parts)
