"""Periods one after the other against one run over all of them; staged publication; ids that go on."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta

import pytest

from helpers import SITE, START, ZONE, exemptions, reading, slot, telemetry, weather
from meterwatch import config, schemas
from meterwatch.config import AuditParams
from meterwatch.operators import profile
from meterwatch.plans import logs, pipeline
from meterwatch.plans.audit import Audit
from meterwatch.plans.history import History
from meterwatch.plans.logs import AuditInputs
from meterwatch.sources.store import Store

CUTS = ["2025-11-01 00:00:00", "2025-11-05 00:00:00", "2025-11-06 00:00:00", "2025-11-09 00:00:00"]
POLICY = AuditParams(leak_rows=2, idle_sigma=0.5, idle_rows=2, alarm_sigma=0.3, min_clean_days=2, overrun_ratio=0.01, base_mj_sqm=0.01)


def readings():
    """Four assets over eight days; breaches last across the borders, one asset pauses for a whole period."""
    rng = random.Random(9)
    data = []
    for asset in (SITE, ZONE, "Asset_03_NZ_Boundary", "Asset_99"):
        for i in range(96 * 8):
            if rng.random() < (0.02 if asset == SITE else 0.1) or (asset.startswith("Asset_03") and 384 <= i < 480):
                continue
            co2 = 1300 if i % 97 < 9 or 370 <= i < 500 else rng.choice([500, 900, 1100])
            hvac = 5 + (i // 96) * 0.8 + rng.random() * 3
            trait = rng.choice(["L0_CLEAN_COMPLIANT"] * 4 + ["L2_DRIFT"]) if i // 96 not in (2, 6) else "L2_DRIFT"
            data.append(reading(slot(i), asset=asset, co2=co2, total=hvac + 5 + rng.choice([0, 0, 4]), hvac=round(hvac, 3), trait=trait))
    return data


def inputs(spark, data, params):
    empty = lambda schema: spark.createDataFrame([], "row_ord bigint, " + schema)
    invoices = [(1, "Asset_11_AU_Sydney", START.date(), 7500.0, None, "x", "y")]
    return AuditInputs(
        telemetry=telemetry(spark, data), weather=weather(spark, 96 * 9, temp=25.0), registry=config.registry(spark),
        exemptions=exemptions(spark, [(ZONE, "S08", slot(100), slot(130))]),
        invoices=spark.createDataFrame(invoices, "row_ord bigint, " + schemas.INVOICES),
        travel=empty(schemas.TRAVEL), waste=empty(schemas.WASTE), params=params)


def in_period(data, lo, hi):
    return [r for r in data if lo <= str(r[0]) < hi]


def comparable(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def whole(spark):
    params = replace(POLICY.for_period(CUTS[0], CUTS[-1]), period=None)
    return Audit(inputs(spark, readings(), params))


@pytest.fixture(scope="module")
def kept(spark, whole, tmp_path_factory):
    data = readings()
    baseline = profile.hourly_baseline(whole.inputs.telemetry, whole.inputs.params)
    history = History(Store(spark, str(tmp_path_factory.mktemp("store"))), POLICY, baseline)
    for lo, hi in zip(CUTS[:-1], CUTS[1:]):
        history.add(inputs(spark, in_period(data, lo, hi), POLICY.for_period(lo, hi)))
    return history


def test_periods_equal_one_run(spark, whole, kept):
    found = kept.audit(inputs(spark, [], POLICY))
    for log in ("facility", "energy"):
        got, want = getattr(found, log), getattr(whole, log)
        assert comparable(got.select(*want.columns)) == comparable(want)
        assert {r.scenario for r in want.select("scenario").distinct().collect()} == (
            {"S01", "S03", "S06", "S08"} if log == "facility" else {"S04", "S05", "S07", "S10"})
    assert comparable(found.outcome_counts()) == comparable(whole.outcome_counts())


def test_no_readings_in_the_plans(spark, kept, tmp_path):
    telemetry(spark, readings()[:50]).write.parquet(str(tmp_path / "ledger"))
    a = replace(inputs(spark, [], POLICY), telemetry=spark.read.parquet(str(tmp_path / "ledger")))
    found = kept.audit(a)
    plans = [logs.facility_events(found.inputs, found.profile, kept.runs("air")),
             logs.energy_events(found.inputs, found.profile, found.days, found.verdicts, kept.runs("power"))]
    assert not any(str(tmp_path) in p._jdf.queryExecution().executedPlan().toString() for p in plans)


def test_the_last_chart_equals_that_of_all_days(spark, whole, kept):
    chart = {(r.asset_id, r.date): r for r in profile.cusum(whole.days, whole.inputs.params).collect()}
    rows = kept.store.as_of("cusum").collect()
    assert len(rows) == 4 * 3
    for r in rows:
        assert r.cusum == pytest.approx(chart[r.asset_id, r.date].cusum, abs=1e-6) and r.alarm == chart[r.asset_id, r.date].alarm


def test_adding_the_latest_period_again_changes_nothing(spark, kept):
    before = comparable(kept.runs("air"))
    kept.add(inputs(spark, in_period(readings(), *CUTS[-2:]), POLICY.for_period(*CUTS[-2:])))
    assert comparable(kept.runs("air")) == before and len(kept.periods()) == 3


def test_periods_must_follow(spark, kept):
    for lo, hi in (("2025-11-20", "2025-11-21"), ("2025-11-01", "2025-11-05"), ("2025-11-09 06:00:00", "2025-11-10")):
        with pytest.raises(ValueError):
            kept.add(inputs(spark, [], POLICY.for_period(lo, hi)))


def published(store, period):
    paths = {r.name: r.path for r in store.entries() if r.period == period}
    return {r.event_id: (r.scenario, r.asset_id, str(r.event_time)) for r in store.spark.read.parquet(paths["fact_audit_events"]).collect()}


def test_ids_go_on_and_prior_kpis_come_from_the_store(spark, tmp_path):
    data = readings()
    history = History(Store(spark, str(tmp_path / "s")), POLICY)
    ids = []
    for lo, hi in zip(CUTS[:2], CUTS[1:3]):
        a = inputs(spark, in_period(data, lo, hi), POLICY.for_period(lo, hi))
        history.add(a)
        history.publish(a)
        ids.append(published(history.store, lo))
    for earlier, later in zip(ids[:-1], ids[1:]):
        same = {v: k for k, v in earlier.items()}
        assert all(same.get(v, k) == k for k, v in later.items())
        new = set(later) - set(earlier)
        assert min(int(k[4:]) for k in new) > max(int(k[4:]) for k in earlier)
        assert len(new) > 0 and len(set(later.values())) == len(later)
    delta = {r.metric: r for r in history.store.as_of("report_kpi_delta").collect()}
    prior = {r.metric: r for r in history.store.as_of("dim_kpi_summary", CUTS[1]).collect()}
    assert delta["avoidable_cost_nz"].prior_value == prior["avoidable_cost_nz"].value_nzd > 0
    first = history.store.spark.read.parquet(next(r.path for r in history.store.entries() if r.name == "dim_kpi_summary"))
    assert first.count() == 6 and "report_kpi_delta" not in {r.name for r in history.store.entries() if r.period == CUTS[0]}


def test_a_broken_run_leaves_the_old_tables(spark, tmp_path):
    data = readings()
    store = Store(spark, str(tmp_path / "s"))
    a = inputs(spark, data, replace(POLICY, period=None))
    pipeline.publish_staged(a, store.begin("2025-11"), Audit(a))
    before = {r.name: r.path for r in store.entries()}
    kpi = comparable(store.as_of("dim_kpi_summary"))
    draft = store.begin("2025-11")
    real = draft.write

    def failing(table, name):
        if name == "dim_priority_actions":
            raise RuntimeError("executor lost")
        real(table, name)

    draft.write = failing
    with pytest.raises(RuntimeError):
        pipeline.publish_staged(a, draft, Audit(a))
    assert len(draft.written) > 5 and {r.name: r.path for r in store.entries()} == before
    assert comparable(store.as_of("dim_kpi_summary")) == kpi and len(before) > 20


def test_store_reads_csv_and_picks_periods(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), "csv")
    assert store.entries() == [] and store.read("t") is None and store.as_of("t") is None
    for period, value in (("2025-10", 1), ("2025-11", 2), ("2025-10", 3)):
        draft = store.begin(period)
        draft.write(spark.createDataFrame([(value, 'a "quoted" text')], "v bigint, t string"), "t")
        with pytest.raises(ValueError):
            draft.write(spark.range(1), "t")
        assert draft.read("t").count() == 1
        draft.commit()
    assert sorted(r.v for r in store.read("t", "v bigint, t string").collect()) == [2, 3]
    assert store.as_of("t", "2025-11", "v bigint, t string").first().v == 3 and store.as_of("t").first().t == 'a "quoted" text'
    assert store.read("t", before="2025-10") is None and store.periods("t") == ["2025-10", "2025-11"]


def test_unnamed_period_is_the_default_time():
    assert pipeline.period_of(AuditParams()) == "2025-11-01 00:00:00"
    assert pipeline.period_of(AuditParams().for_period("2025-10-01", "2025-11-01")) == str(START - timedelta(31))
