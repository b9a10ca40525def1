"""Evidence rules: invoice hashes (S02), billing variance (S09), travel class (S11), waste.

Inputs carry `row_ord`, a number that orders the events before their time and asset do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.config import GUARD, AuditParams
from meterwatch.functions.text import columns, fixed, half_even, holds, sql, strip
from meterwatch.schemas import COMPLIANCE_LOG, EMIT

TYPES = {
    "billing_month": "DATE", "route": "STRING", "booked_class": "STRING", "flight_hours": "DOUBLE",
    "ticket_price_aud": "DOUBLE", "employee_id": "STRING", "waste_type": "STRING",
    "disposal_date": "STRING", "quantity_kg": "DOUBLE", "actual_billed_kwh": "DOUBLE",
    "inferred_kwh": "DOUBLE", "variance_pct": "DOUBLE",
}
# The finding texts here and in the rules below.
HASH_MISSING = "Invoice hash field is null — evidence chain cannot be established"
SUSPENDED = (
    "S09 analysis suspended — upstream S02 hash breach unresolved. "
    "Billing data cannot be relied upon until invoice integrity is confirmed."
)
# L1_HASH_MISSING, L1_HASH_MISMATCH, or null for a verified invoice
HASH_OUTCOME = """CASE WHEN uploaded_pdf_hash IS NULL OR original_crypto_signature IS NULL THEN 'L1_HASH_MISSING'
     WHEN uploaded_pdf_hash <> original_crypto_signature THEN 'L1_HASH_MISMATCH' END"""
UNMETERED_AU = "region = 'AU' AND NOT coalesce(has_iot, false)"


def _log(scenario: str, **values: str) -> str:
    given = {c: f"CAST(NULL AS {t})" for c, t in TYPES.items()}
    given |= {"financial_exposure": "0D", "carbon_kg": "0D", "scenario": f"'{scenario}'"}
    given |= {"emit_group": str(int(scenario[1:])), "emit_entity": "row_ord"}
    return columns([*COMPLIANCE_LOG, *EMIT], **{**given, **values})


def hash_integrity(invoices: DataFrame) -> DataFrame:
    """Invoices whose hash is missing or differs from the signature."""
    mismatch = (
        "format_string('PDF hash [%s] does not match original signature [%s] — tampered or corrupted invoice', "
        "uploaded_pdf_hash, original_crypto_signature)"
    )
    log = _log(
        "S02", ref_id="asset_id", billing_month="billing_month",
        detail=f"CASE status WHEN 'L1_HASH_MISSING' THEN '{HASH_MISSING}' ELSE {mismatch} END",
    )
    return sql(
        f"SELECT {log} FROM (SELECT *, {HASH_OUTCOME} AS status FROM {{invoices}}) WHERE status IS NOT NULL",
        invoices=invoices,
    )


def untrusted_assets(invoices: DataFrame) -> DataFrame:
    """Assets with any S02 finding, in any month."""
    return sql(f"SELECT DISTINCT asset_id FROM {{invoices}} WHERE {HASH_OUTCOME} IS NOT NULL", invoices=invoices)


def billing_checks(invoices: DataFrame, registry: DataFrame, p: AuditParams, hash_findings: DataFrame | None = None) -> DataFrame:
    """Every invoice of an unmetered Australian asset with its billing outcome.

    Findings of `hash_integrity` that are already stored save another look at the hashes. The cascade mark is settled per asset first, so that invoices join once, against one row per
    asset; adaptive execution can split an asset with very many invoices.
    """
    sites = f"""
        SELECT r.asset_id, area_sqm * {{au_median_mj_sqm}} / {{mj_per_kwh}} / 12 AS inferred,
               u.asset_id IS NOT NULL AS untrusted
        FROM {{registry}} r LEFT JOIN {{untrusted}} u ON r.asset_id = u.asset_id
        WHERE {UNMETERED_AU}"""
    compared = f"""
        SELECT *, abs(actual_billed_kwh - inferred) AS gap,
               abs(actual_billed_kwh - inferred) / (inferred + {GUARD}D) AS variance
        FROM {{invoices}} JOIN ({sites}) USING (asset_id)"""
    return sql(
        f"""
        SELECT *, CASE WHEN untrusted THEN 'SUSPENDED_PENDING_S02'
                       WHEN variance > {{billing_variance}} THEN 'L4_BILLING_VARIANCE' END AS status
        FROM ({compared})
        """,
        p, registry=registry, invoices=invoices,
        untrusted=untrusted_assets(invoices) if hash_findings is None else hash_findings.select("asset_id").distinct(),
    )


def billing_variance(invoices: DataFrame, registry: DataFrame, p: AuditParams, hash_findings: DataFrame | None = None) -> DataFrame:
    """Billed energy against the benchmark, suspended where S02 fired for the asset."""
    text = (
        f"concat('Billed ', {fixed('actual_billed_kwh', 0)}, ' kWh vs NABERS-inferred ', {fixed('inferred', 0)}, "
        f"' kWh — variance ', {fixed('variance * 100', 1)}, '% exceeds {p.billing_variance * 100:g}% threshold')"
    )
    off = lambda x: f"CASE status WHEN 'L4_BILLING_VARIANCE' THEN {x} END"
    log = _log(
        "S09", ref_id="asset_id", billing_month="billing_month",
        detail=f"coalesce({off(text)}, '{SUSPENDED}')",
        financial_exposure=f"coalesce({off(half_even(f'gap * {p.aud_per_kwh}D', 2))}, 0D)",
        carbon_kg=f"coalesce({off(half_even(f'gap * {p.au_kg_per_kwh}D', 3))}, 0D)",
        actual_billed_kwh=off("actual_billed_kwh"), inferred_kwh=off(half_even("inferred", 1)),
        variance_pct=off(half_even("variance * 100", 1)),
    )
    return sql(
        f"SELECT {log} FROM {{checks}} WHERE status IS NOT NULL", checks=billing_checks(invoices, registry, p, hash_findings)
    )


def short_haul_business(p: AuditParams) -> str:
    """Unknown on missing hours, which a filter and a CASE treat as no finding; stays pushable."""
    return f"{strip('booked_class')} = 'Business' AND try_cast(flight_hours AS DOUBLE) < {p.short_haul_hours}D"


def travel_class(travel: DataFrame, p: AuditParams) -> DataFrame:
    """Business class below six hours."""
    hours, price = "try_cast(flight_hours AS DOUBLE)", "try_cast(ticket_price_aud AS DOUBLE)"
    log = _log(
        "S11", ref_id="CAST(ticket_id AS STRING)", asset_id="employee_id", status="'L3_TRAVEL_CLASS_AUDIT'",
        detail=f"concat('Business class on short-haul route ', route, ' (', {fixed(hours, 1)}, "
               f"' hrs) — exceeds {p.short_haul_hours:g}-hour short-haul threshold')",
        financial_exposure=half_even(price, 2), route="route", booked_class=strip("booked_class"),
        flight_hours=hours, ticket_price_aud=price, employee_id="employee_id",
    )
    return sql(f"SELECT {log} FROM {{travel}} WHERE {short_haul_business(p)}", travel=travel)


NO_CERTIFICATE = strip("coalesce(disposal_cert_url, '')") + " = ''"


def is_hazardous(p: AuditParams) -> str:
    return strip("waste_type") + " IN (" + ", ".join(f"'{k}'" for k in p.hazardous) + ")"


def waste_outcome(p: AuditParams) -> str:
    return f"""CASE WHEN NOT {holds(is_hazardous(p))} THEN 'non_hazardous'
        WHEN {NO_CERTIFICATE} THEN 'certificate_missing' ELSE 'certified' END"""


def hazardous_waste(waste: DataFrame, p: AuditParams) -> DataFrame:
    """Hazardous or electronic waste without a certificate."""
    log = _log(
        "S12", ref_id="manifest_id", status="'L3_WASTE_CERT_MISSING'",
        detail=f"concat({strip('waste_type')}, ' disposal record has no certificate URL — compliance with "
               "HSNO Act 1996 and Basel Convention cannot be verified')",
        waste_type=strip("waste_type"), disposal_date="disposal_date",
        quantity_kg="try_cast(quantity_kg AS DOUBLE)",
    )
    return sql(f"SELECT {log} FROM {{waste}} WHERE {is_hazardous(p)} AND {NO_CERTIFICATE}", waste=waste)


def au_benchmark_summary(invoices: DataFrame, registry: DataFrame, p: AuditParams) -> DataFrame:
    """Benchmark position of each unmetered Australian asset (SUM-AU).

    An untrusted asset gets the benchmark median as placeholder; one without invoices gets no row.
    """
    billed = f"""
        SELECT asset_id, avg(actual_billed_kwh) AS billed, bool_or({HASH_OUTCOME} IS NOT NULL) AS suspended
        FROM {{invoices}} GROUP BY asset_id"""
    monthly = f"""
        SELECT asset_id, area_sqm, suspended, CASE WHEN suspended
                 THEN area_sqm * {{au_median_mj_sqm}} / {{mj_per_kwh}} / 12 ELSE billed END AS month_kwh
        FROM {{registry}} JOIN ({billed}) USING (asset_id) WHERE {UNMETERED_AU}"""
    rated = f"SELECT *, month_kwh * 12 * {{mj_per_kwh}} / area_sqm AS mj_sqm FROM ({monthly})"
    return sql(
        f"""
        SELECT asset_id, area_sqm, {half_even('month_kwh', 1)} AS inferred_kwh_month,
               {half_even('mj_sqm', 1)} AS ytd_actual_mj_sqm, {p.au_budget_mj_sqm}D AS budget_mj_sqm,
               {half_even(f'mj_sqm / {p.au_budget_mj_sqm}D', 3)} AS nabers_ratio,
               {holds(f'mj_sqm > {p.au_budget_mj_sqm}D * {p.overrun_ratio}D')} AS breach, suspended,
               CASE WHEN suspended THEN 'S02_HASH_BREACH' ELSE '' END AS suspension_reason
        FROM ({rated})
        """,
        p, registry=registry, invoices=invoices,
    )
