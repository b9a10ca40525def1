"""Telemetry rules on literal months."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from helpers import SITE, START, ZONE, exemptions, reading, rows, slot, telemetry, weather
from meterwatch import config
from meterwatch.config import AuditParams
from meterwatch.operators import energy, facility
from meterwatch.operators.exemptions import exempt_slices
from meterwatch.operators.prep import enrich
from meterwatch.operators.profile import asset_profile, daily_rollup, slot_profile

P = AuditParams()


@pytest.fixture(scope="module")
def registry(spark):
    return config.registry(spark).cache()


def test_unknown_device_is_one_event_without_energy(spark, registry):
    data = [reading(slot(50), asset="Asset_99_UNKNOWN_Boundary", total=400.0), reading(slot(0)),
            reading(slot(1), asset="Asset_11_AU_Sydney")]
    got = facility.unauthorised(asset_profile(telemetry(spark, data), P), registry, P).collect()
    assert len(got) == 1  # a registered site without meters is known
    e = got[0]
    assert (e.asset_id, e.status, e.start_time, e.end_time) == (
        "Asset_99_UNKNOWN_Boundary", "L0_UNAUTHORIZED_ASSET", slot(50), slot(50))
    assert (e.anomaly_duration_mins, e.total_assessed_mins, e.waste_kwh, e.financial_cost) == (15, 15, 0.0, 0.0)
    total = facility.unauthorised_totals(asset_profile(telemetry(spark, data), P), registry).collect()[0]
    assert total.kwh_unverified == 100.0


def test_two_day_hole(spark, registry):
    hole = set(range(14 * 96, 16 * 96))
    data = [reading(slot(i)) for i in range(2877) if i not in hole]
    e = facility.telemetry_gaps(slot_profile(telemetry(spark, data), P), registry, P).collect()[0]
    assert (e.scenario, e.anomaly_duration_mins, e.total_assessed_mins) == ("S03", 2880, 43140)
    full = [reading(slot(i)) for i in range(2877)]
    assert facility.telemetry_gaps(slot_profile(telemetry(spark, full), P), registry, P).count() == 0


def test_co2_breach_is_strict_and_ignores_exemptions(spark, registry):
    data = [reading(slot(i), co2=c) for i, c in enumerate([1000, 1001, 1250, 1000, 1250, None, 1250, 1250])]
    ex = exemptions(spark, [(SITE, "S06", START, slot(99))])
    got = facility.air_quality(telemetry(spark, data), registry, ex, P, ("S06",))
    assert rows(got, "start_time", "end_time", "anomaly_duration_mins") == [
        (slot(1), slot(2), 30), (slot(6), slot(7), 30)]
    assert {r.recommendation for r in got.collect()} == {"Monitor and increase fresh air supply"}


def test_high_demand_zone(spark, registry):
    data = [
        reading(slot(i), asset=ZONE, co2=c, temp=t) for i, (c, t) in enumerate([
            (820, 22.0), (825, 22.0),     # too much CO2; the mean of 822.5 rounds half to even
            (800, 21.0),                  # at the limits: fine
            (700, 20.9), (700, 23.1),     # too cold, then too warm: one event
            (700, 22.0),
            (810, None),                  # one slot only
            (None, 22.0),
        ])
    ]
    data += [reading(slot(i), asset=SITE, co2=900) for i in range(4)]  # an ordinary site
    got = facility.air_quality(telemetry(spark, data), registry, exemptions(spark), P)
    assert rows(got, "scenario", "start_time", "cognitive_loss_nzd", "avg_co2_ppm", "peak_co2_ppm", "occupants") == [
        ("S08", slot(0), 432.69, 822.0, 825, 40), ("S08", slot(3), 432.69, 700.0, 700, 40)]


def test_exemption_bounds_are_closed(spark, registry):
    data = [reading(slot(i), asset=ZONE, co2=900 if i % 4 < 2 else 500) for i in range(16)]
    frame = telemetry(spark, data)
    starts = lambda ex: [t for (t,) in rows(
        facility.air_quality(frame, registry, exemptions(spark, ex), P, ("S08",)), "start_time")]
    assert starts([]) == [slot(0), slot(4), slot(8), slot(12)]
    assert starts([(ZONE, "S08", slot(4), slot(8))]) == [slot(0), slot(12)]
    assert starts([(ZONE, "S04", slot(0), slot(99)), (SITE, "S08", slot(0), slot(99))]) == starts([])
    # an approval that began months before and ends months later
    assert starts([(ZONE, "S08", datetime(2025, 1, 1), datetime(2026, 12, 31))]) == []


def test_submeter_drift(spark, registry):
    loads = [45.0] * 4 + [10.0] * 2 + [45.0] * 3
    data = [reading(slot(i), total=t) for i, t in enumerate(loads)]  # sub-meters add up to 10
    frame = telemetry(spark, data)
    got = energy.power_events(frame, frame, registry, exemptions(spark), P, ("S04",)).collect()
    assert len(got) == 1
    e = got[0]
    assert (e.status, e.anomaly_duration_mins, e.waste_kwh, e.financial_cost, e.carbon_kg) == (
        "L2_METER_LEAKAGE", 60, 35.0, 8.75, 3.85)
    assert e.avg_diff_ratio == pytest.approx(0.7778)
    ex = exemptions(spark, [(SITE, "S04", START, START)])
    assert energy.power_events(frame, frame, registry, ex, P, ("S04",)).count() == 0


def test_after_hours_event_bridges_business_hours(spark, registry):
    # a clean week sets the limits, then heating runs through Thursday and Friday night
    data = []
    for i in range(14 * 96):
        ts = slot(i)
        quiet = 5.0 + (i % 2) * 0.2
        night = ts.hour < 7 or ts.hour >= 20
        hot = datetime(2025, 11, 13, 20) <= ts < datetime(2025, 11, 14, 23) and night
        data.append(reading(ts, hvac=30.0 if hot else quiet, trait="L2_IDLE" if hot else config.CLEAN))
    plain = telemetry(spark, data)
    got = energy.power_events(
        plain, enrich(plain, weather(spark), P), registry, exemptions(spark), P, ("S05",)).collect()
    assert len(got) == 1
    e = got[0]
    assert (e.timestamp, e.end_time) == (datetime(2025, 11, 13, 20), datetime(2025, 11, 14, 22, 45))
    assert e.anomaly_duration_mins == (16 + 28 + 12) * 15  # rows, not the span
    assert e.peak_hvac_kw == 30.0


def test_no_weather_or_no_baseline_means_no_after_hours_events(spark, registry):
    data = [reading(slot(i), hvac=5.0 + i % 2, trait=config.CLEAN) for i in range(96)]
    data += [reading(slot(96 + i), hvac=500.0, trait="X") for i in range(8)]
    plain = telemetry(spark, data)
    blind = enrich(plain, weather(spark, n=96), P)
    assert energy.power_events(plain, blind, registry, exemptions(spark), P, ("S05",)).count() == 0
    dirty = plain.withColumnRenamed("audit_trait", "old").selectExpr("*", "'X' AS audit_trait").drop("old")
    seen = enrich(dirty, weather(spark), P)
    assert energy.power_events(dirty, seen, registry, exemptions(spark), P, ("S05",)).count() == 0


def drifting(days=30, dirty_from=11, creep=8.0, total=10.0, skip=()):
    out = []
    for i in range(days * 96):
        d = i // 96
        if d in skip:
            continue
        late = d >= dirty_from
        out.append(reading(slot(i), hvac=10.0 + 0.1 * (d % 3) + (creep * (d - dirty_from + 1) if late else 0),
                           total=total, trait="L2_DRIFT" if late else config.CLEAN))
    return out


def test_degradation_event(spark, registry):
    frame = telemetry(spark, drifting())
    verdicts = energy.asset_verdicts(daily_rollup(enrich(frame, weather(spark), P), P), registry, P)
    got = energy.verdict_events(verdicts, exemptions(spark), P, ("S07",)).collect()
    assert len(got) == 1
    e = got[0]
    assert (e.status, e.anomaly_duration_mins, e.cusum_trigger_date) == (
        "L2_EFFICIENCY_DEGRADATION", 19 * 1440, "2025-11-12")
    assert (e.timestamp, e.end_time) == (slot(11 * 96), slot(30 * 96 - 1))
    mu = sum((10 + 0.1 * (d % 3)) * 24 for d in range(11)) / 11
    excess = sum(max((10 + 0.1 * (d % 3) + 8 * (d - 10)) * 24 - mu, 0) for d in range(11, 30))
    assert e.waste_kwh == pytest.approx(excess, abs=1e-3) and e.baseline_daily_kwh == pytest.approx(mu, abs=0.05)
    # exempt on the alarm date
    on_alarm = exemptions(spark, [(SITE, "S07", datetime(2025, 11, 12), datetime(2025, 11, 12))])
    assert energy.verdict_events(verdicts, on_alarm, P, ("S07",)).count() == 0


def test_degradation_needs_a_complete_month_and_clean_days(spark, registry):
    for data in (drifting(skip=(14, 15)), drifting(dirty_from=2)):
        verdicts = energy.asset_verdicts(daily_rollup(enrich(telemetry(spark, data), weather(spark), P), P), registry, P)
        assert energy.verdict_events(verdicts, exemptions(spark), P, ("S07",)).count() == 0


def test_benchmark(spark, registry):
    # 2,500 m2, no cooling: the budget is 105,000 MJ or 29,166.67 kWh
    hot = weather(spark, temp=20.3)  # two cooling degrees in every slot
    for kw, wx, breach in ((40.0, weather(spark), False), (45.0, weather(spark), True), (45.0, hot, False)):
        frame = telemetry(spark, [reading(slot(i), total=kw, hvac=1.0) for i in range(2880)])
        verdicts = energy.asset_verdicts(daily_rollup(enrich(frame, wx, P), P), registry, P)
        got = energy.verdict_events(verdicts, exemptions(spark), P, ("S10",)).collect()
        assert bool(got) == breach
        summary = energy.benchmark_summary(verdicts).collect()
        assert len(summary) == 1 and summary[0].breach == breach
    frame = telemetry(spark, [reading(slot(i), total=45.0, hvac=1.0) for i in range(2880)])
    e = energy.verdict_events(
        energy.asset_verdicts(daily_rollup(enrich(frame, weather(spark), P), P), registry, P), exemptions(spark), P, ("S10",)
    ).collect()[0]
    assert (e.days_elapsed, e.anomaly_duration_mins, e.nabersnz_ratio) == (29, 29 * 1440, 1.111)
    assert e.waste_kwh == pytest.approx(45 * 720 - 105000 / 3.6, abs=1e-3)
    assert e.nabersnz_budget_mj == 105000.0


def test_empty_telemetry(spark, registry):
    frame = telemetry(spark, [])
    assert facility.air_quality(frame, registry, exemptions(spark), P).count() == 0
    assert facility.telemetry_gaps(slot_profile(frame, P), registry, P).count() == 0
    enriched = enrich(frame, weather(spark, n=4), P)
    assert energy.power_events(frame, enriched, registry, exemptions(spark), P).count() == 0
    assert energy.asset_verdicts(daily_rollup(enriched, P), registry, P).count() == 0


def test_cooling_degrees_keep_unknown_weather_unknown(spark):
    frame = telemetry(spark, [reading(slot(0)), reading(slot(1)), reading(slot(0) + timedelta(minutes=1))])
    got = enrich(frame, weather(spark, temp=20.3), P).orderBy("timestamp").collect()
    assert [None if r.cdd is None else round(r.cdd, 6) for r in got] == [2.0, None, 2.0]
    assert [r.is_weekday for r in got] == [0, 0, 0]  # 1 November 2025 is a Saturday


def test_half_hour_slots(spark, registry):
    p = AuditParams(slot_minutes=30)
    data = [reading(START + timedelta(minutes=30 * i), total=2.0, hvac=2.0, light=0.0, it=0.0) for i in range(48)]
    data.append(reading(START, asset="Asset_99", total=4.0))
    frame = telemetry(spark, data)
    days = daily_rollup(enrich(frame, weather(spark), p), p)
    assert {(r.asset_id, r.n_rows, r.total_kwh, r.hvac_kwh) for r in days.collect()} == {
        (SITE, 48, 48.0, 48.0), ("Asset_99", 1, 2.0, 2.5)}
    slots = {r.asset_id: r for r in slot_profile(frame, p).collect()}
    assert (slots[SITE].missing_slots, slots[SITE].kwh, slots[SITE].total_assessed_mins) == (0, 48.0, 23 * 60 + 30)
    assert facility.unauthorised_totals(asset_profile(frame, p), registry).first().kwh_unverified == 2.0
    with pytest.raises(ValueError, match="divide"):
        AuditParams(slot_minutes=25)


def test_stored_profile_and_days_change_nothing(spark, registry):
    data = [reading(slot(i), hvac=9.0 if i % 50 in (1, 2, 3, 4, 5) and i > 400 else 2.0 + i % 2, total=60.0 if i % 97 < 6 else 10.0,
                    co2=1200 if i % 31 < 3 else 500) for i in range(960)]
    frame = telemetry(spark, data)
    enriched, none = enrich(frame, weather(spark), P), exemptions(spark)
    for hours in (24, 5, 48):
        p = AuditParams(chunk_hours=hours, idle_sigma=0.5)
        profile, days = slot_profile(frame, p), daily_rollup(enriched, p)
        alone = energy.power_events(frame, enriched, registry, none, p).collect()
        shared = energy.power_events(frame, enriched, registry, none, p, profile=profile, days=days).collect()
        assert sorted(map(str, alone)) == sorted(map(str, shared)) and {r.scenario for r in alone} == {"S04", "S05"}
        air = [facility.air_quality(frame, registry, none, p, profile=x).collect() for x in (None, profile)]
        assert sorted(map(str, air[0])) == sorted(map(str, air[1])) and air[0]


def test_open_ended_approval_adds_no_more_chunks_than_the_asset_has(spark, registry):
    data = [reading(slot(i), co2=1200, asset=ZONE) for i in range(96 * 40)]
    profile = slot_profile(telemetry(spark, data), P)
    forever = exemptions(spark, [(ZONE, "S08", datetime(1990, 1, 1), datetime(9999, 12, 31)),
                                 (ZONE, "S08", datetime(2030, 1, 1), datetime(9999, 12, 31)),
                                 ("Asset_without_readings", "S08", START, datetime(9999, 12, 31))])
    assert exempt_slices(forever, profile).count() <= 3
    left = facility.air_quality(telemetry(spark, data), registry, forever, P, ("S08",))
    assert left.count() == 0
