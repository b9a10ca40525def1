"""BLK2: the ordered pass against every pair, and a chunk full of approvals."""

from __future__ import annotations

import random
import time
from datetime import timedelta

import pytest

from helpers import START, exemptions
from meterwatch.operators.exemptions import drop_exempt

EVENT = "asset_id string, scenario string, start_time timestamp_ntz, kwh double, chunk int, at string"


def spans(spark, events):
    by = {}
    for a, _, t, *_ in events:
        if t is not None:
            lo, hi = by.get(a, (t, t))
            by[a] = (min(lo, t), max(hi, t))
    return spark.createDataFrame([(a, lo, hi) for a, (lo, hi) in by.items()], "asset_id string, first_ts timestamp_ntz, last_ts timestamp_ntz")


@pytest.mark.parametrize("chunk_days", [1, 7, 30])
def test_every_pair(spark, chunk_days):
    rng = random.Random(chunk_days)
    minute = lambda: START + timedelta(minutes=15 * rng.randint(0, 96 * 60))
    approvals = []
    for _ in range(150):
        t = minute()
        approvals.append((f"a{rng.randint(0, 3)}", rng.choice(["S04", "S05", "S06"]), t, t + timedelta(minutes=15 * rng.choice([-4, 0, 0, 3, 90, 4000]))))
    approvals.append(("a0", "S05", START + timedelta(days=20), START + timedelta(days=3_000_000 // 2)))
    events = [(f"a{rng.randint(0, 4)}", rng.choice(["S04", "S05", "S06", "S10"]), minute(), float(i), 7, "x") for i in range(1500)]
    events += events[:5] + [("a1", "S04", None, -1.0, 7, "x")]
    # S06 takes no exemptions
    exempt = lambda a, s, t: t is not None and s in ("S04", "S05") and any(
        a == b and s == r and lo <= t <= hi for b, r, lo, hi in approvals)
    frame = spark.createDataFrame(events, EVENT)
    got = drop_exempt(frame, exemptions(spark, approvals), spans(spark, events), chunk_days=chunk_days)
    assert got.columns == frame.columns
    assert sorted(r.kwh for r in got.collect()) == sorted(e[3] for e in events if not exempt(*e[:3]))


def test_a_chunk_of_many_approvals_takes_linear_time(spark):
    n = 100_000
    approvals = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS exemption_id", "'a' AS asset_id", "'S04' AS scenario_id",
        "TIMESTAMP_NTZ'2025-11-01' + make_interval(0, 0, 0, 0, 0, 0, id * 20) AS start_time",
        "TIMESTAMP_NTZ'2025-11-01' + make_interval(0, 0, 0, 0, 0, 0, id * 20 + 9) AS end_time", "'t' AS application_type")
    events = spark.range(n).selectExpr(
        "'a' AS asset_id", "'S04' AS scenario", "TIMESTAMP_NTZ'2025-11-01' + make_interval(0, 0, 0, 0, 0, 0, id * 20 + id % 20) AS start_time")
    span = events.selectExpr("asset_id", "start_time AS t").groupBy("asset_id").agg({"t": "min"}).toDF("asset_id", "first_ts")
    span = span.selectExpr("*", "TIMESTAMP_NTZ'2025-11-30' AS last_ts")
    start = time.time()
    assert drop_exempt(events, approvals, span).count() == n // 2
    assert time.time() - start < 30  # every pair would be 10^10
