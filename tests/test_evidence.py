"""Evidence rules against known findings."""

from __future__ import annotations

from datetime import date

import pytest

from helpers import rows
from meterwatch import config, schemas
from meterwatch.config import AuditParams
from meterwatch.operators import evidence

P = AuditParams()
NOV, DEC = date(2025, 11, 1), date(2025, 12, 1)
SYDNEY, HQ = "Asset_11_AU_Sydney", "Asset_01_NZ_Boundary"


@pytest.fixture(scope="module")
def registry(spark):
    return config.registry(spark).cache()


def invoices(spark, *data):
    full = [(i, *row) for i, row in enumerate(data)]
    return spark.createDataFrame(full, "row_ord bigint, " + schemas.INVOICES)


def bill(asset, kwh, up="h", orig="h", month=NOV):
    return (asset, month, kwh, 0.0, up, orig)


# The inputs and findings of the published outputs.
def test_published_findings(spark, registry):
    inv = invoices(spark, bill(HQ, 5000.0), bill(SYDNEY, 7500.0, "TAMPERED_HASH_999", "VALID_SIGNATURE_888"))
    s02 = evidence.hash_integrity(inv).collect()
    assert [(e.ref_id, e.status, e.detail) for e in s02] == [(
        SYDNEY, "L1_HASH_MISMATCH",
        "PDF hash [TAMPERED_HASH_999] does not match original signature [VALID_SIGNATURE_888] — "
        "tampered or corrupted invoice")]
    s09 = evidence.billing_variance(inv, registry, P).collect()
    assert [(e.asset_id, e.status, e.financial_exposure, e.billing_month) for e in s09] == [
        (SYDNEY, "SUSPENDED_PENDING_S02", 0.0, NOV)]
    au = evidence.au_benchmark_summary(inv, registry, P).collect()
    assert [(r.inferred_kwh_month, r.ytd_actual_mj_sqm, r.budget_mj_sqm, r.nabers_ratio, r.breach, r.suspended,
             r.suspension_reason) for r in au] == [(6134.3, 265.0, 165.0, 1.606, True, True, "S02_HASH_BREACH")]


def test_one_bad_invoice_suspends_all_months(spark, registry):
    inv = invoices(spark, bill(SYDNEY, 7500.0), bill(SYDNEY, 7500.0, None, "x", DEC))
    assert [e.status for e in evidence.hash_integrity(inv).collect()] == ["L1_HASH_MISSING"]
    assert rows(evidence.billing_variance(inv, registry, P), "billing_month", "status") == [
        (NOV, "SUSPENDED_PENDING_S02"), (DEC, "SUSPENDED_PENDING_S02")]


def test_billing_variance_beyond_fifteen_percent(spark, registry):
    inferred = 1000.0 * 265.0 / 3.6 / 12
    exact = inferred + 0.15 * (inferred + 1e-6)
    inv = invoices(spark, bill(SYDNEY, 7500.0), bill(SYDNEY, exact - 1e-6, month=DEC), bill(HQ, 99999.0),
                   bill(SYDNEY, None, month=DEC))
    got = evidence.billing_variance(inv, registry, P).collect()
    assert len(got) == 1
    e = got[0]
    assert (e.status, e.financial_exposure, e.carbon_kg) == ("L4_BILLING_VARIANCE", 546.3, 915.046)
    assert e.detail == "Billed 7500 kWh vs NABERS-inferred 6134 kWh — variance 22.3% exceeds 15% threshold"
    assert (e.actual_billed_kwh, e.inferred_kwh, e.variance_pct) == (7500.0, 6134.3, 22.3)


def test_verified_invoices_rate_the_asset_by_its_mean(spark, registry):
    inv = invoices(spark, bill(SYDNEY, 3000.0), bill(SYDNEY, 4000.0, month=DEC))
    r = evidence.au_benchmark_summary(inv, registry, P).collect()[0]
    assert (r.inferred_kwh_month, r.ytd_actual_mj_sqm, r.nabers_ratio, r.breach, r.suspended, r.suspension_reason) == (
        3500.0, 151.2, 0.916, False, False, "")
    assert evidence.au_benchmark_summary(invoices(spark, bill(HQ, 1.0)), registry, P).count() == 0


def test_travel_class(spark):
    data = [
        (0, 1, "EMP_001", "SYD-AKL", "Economy", 450.0, 3.0), (1, 2, "EMP_002", "SYD-LHR", "Business", 8500.0, 24.0),
        (2, 3, "EMP_002", "SYD-AKL", " Business ", 2800.0, 3.0), (3, 4, "EMP_003", "SYD-PER", "Business", 900.0, 6.0),
        (4, 5, "EMP_004", "SYD-MEL", "business", 300.0, 1.5), (5, 6, "EMP_005", "SYD-MEL", "Business", 300.0, None),
    ]
    got = evidence.travel_class(spark.createDataFrame(data, "row_ord bigint, " + schemas.TRAVEL), P).collect()
    assert [(e.ref_id, e.asset_id, e.financial_exposure, e.booked_class, e.detail) for e in got] == [(
        "3", "EMP_002", 2800.0, "Business",
        "Business class on short-haul route SYD-AKL (3.0 hrs) — exceeds 6-hour short-haul threshold")]


def test_hazardous_waste(spark):
    row = lambda i, kind, url: (i, f"WM_{i}", HQ, kind, "11/20/2025", 45.0, url)
    data = [row(1, "E-Waste", None), row(2, " Hazardous ", "  "), row(3, "Hazardous", "u"), row(4, "Paper", None), row(5, None, None)]
    got = evidence.hazardous_waste(spark.createDataFrame(data, "row_ord bigint, " + schemas.WASTE), P)
    assert rows(got, "ref_id", "waste_type", "disposal_date", "quantity_kg") == [
        ("WM_1", "E-Waste", "11/20/2025", 45.0), ("WM_2", "Hazardous", "11/20/2025", 45.0)]
    assert got.where("ref_id = 'WM_1'").collect()[0].detail == (
        "E-Waste disposal record has no certificate URL — compliance with HSNO Act 1996 and Basel Convention "
        "cannot be verified")


def test_all_white_space_is_stripped(spark):
    from meterwatch.config import AuditParams
    from meterwatch.operators import evidence

    p = AuditParams()
    travel = spark.createDataFrame([(1, "e", "\tBusiness ", "2.0", "100", "A-B")], "ticket_id long, employee_id string, booked_class string, flight_hours string, ticket_price_aud string, route string")
    assert travel.where(evidence.short_haul_business(p)).count() == 1
    waste = spark.createDataFrame([("\t",), (" \n",), ("http://x",)], "disposal_cert_url string")
    assert waste.where(evidence.NO_CERTIFICATE).count() == 2


def test_hashes_are_made_and_compared_once(spark, registry, tmp_path):
    """Conditions do not repeat the hash of an invoice, and S09 compares no hashes but reads the stored findings of S02."""
    from datetime import datetime

    from meterwatch.plans import bindings

    orders = [(i, 1, "F" if i % 2 else "P", 100.0 * i, datetime(1995, 1, 1 + i), "1-URGENT" if i < 14 else "2-HIGH") for i in range(28)]
    for name, data in (("orders", orders), ("customer", [(1, "c", 3, 5.0, "BUILDING")]), ("nation", [(3, "n", 0)])):
        spark.createDataFrame(data, bindings.COLUMNS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    t = bindings.TestTables(spark, str(tmp_path))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = evidence.hash_integrity(t.invoices)
    assert plan(found).count("sha2(") - plan(found).count("|altered") == 1  # an altered text is hashed for a few alone
    stored = spark.createDataFrame(found.collect(), found.schema)
    resumed = evidence.billing_variance(t.invoices, t.registry, P, stored)
    assert "altered" not in plan(resumed)
    assert sorted(map(str, resumed.collect())) == sorted(map(str, evidence.billing_variance(t.invoices, t.registry, P).collect()))
    assert found.count() == 3
