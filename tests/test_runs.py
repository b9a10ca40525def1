"""BLK1 against a plain loop, within and across chunks."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from helpers import START, slot
from meterwatch.operators.runs import RunRule, advance_runs, chunk_runs, merge_runs, no_marks, sustained_events


def by_loop(series, cond, scope, k):
    """series: {asset: [(ts, value)]} in time order."""
    found = []
    for asset, points in series.items():
        run = []
        for ts, v in [*points, (None, None)]:
            if ts is not None and not scope(ts, v):
                continue
            if ts is not None and cond(v):
                run.append((ts, v))
                continue
            if len(run) >= k:
                found.append((asset, run[0][0], run[-1][0], len(run), float(sum(x for _, x in run)), float(max(x for _, x in run))))
            run = []
    return sorted(found)


def frame(spark, series):
    return spark.createDataFrame(
        [(a, ts, v) for a, pts in series.items() for ts, v in pts], "asset_id string, timestamp timestamp_ntz, v bigint"
    )


def result(df, rule):
    return sorted(
        (r.asset_id, r.start_time, r.end_time, r.n_rows, r.total, r.top) for r in df.where(f"rule = '{rule}'").collect()
    )


def random_series(seed):
    rng = random.Random(seed)
    series = {}
    for a in range(6):
        ts, points = START, []
        for _ in range(rng.randint(1, 400)):
            ts += timedelta(minutes=15 * rng.choice([1, 1, 1, 2, 30, 200]))
            points.append((ts, rng.choice([0, 0, 1, 5, 9]) if a % 2 else rng.choice([5, 9, 9, 0])))
        series[f"a{a}"] = points
    return series


@pytest.mark.parametrize("chunk_hours", [1, 24, 7 * 24, 2400])
def test_matches_the_loop_for_several_rules_at_once(spark, chunk_hours):
    series = random_series(chunk_hours)
    measures = {"sums": {"total": "v"}, "peaks": {"top": "v"}}
    rules = [
        RunRule("high", "v > 4", 2, **measures),
        RunRule("any", "v > 0", 4, **measures),
        RunRule("night", "v > 4", 2, scope="hour(timestamp) >= 20 OR hour(timestamp) < 7", **measures),
    ]
    out = sustained_events(frame(spark, series), rules, tiebreak=("v",), chunk_hours=chunk_hours).cache()
    everywhere = lambda ts, v: True
    assert result(out, "high") == by_loop(series, lambda v: v > 4, everywhere, 2)
    assert result(out, "any") == by_loop(series, lambda v: v > 0, everywhere, 4)
    night = lambda ts, v: ts.hour >= 20 or ts.hour < 7
    assert result(out, "night") == by_loop(series, lambda v: v > 4, night, 2)


def simple(spark, values, k=2, start=START, holes=()):
    pts = [(slot(i, start), v) for i, v in enumerate(values) if i not in holes]
    rule = RunRule("r", "v > 0", k, sums={"total": "v"}, peaks={"top": "v"})
    return [(r.start_time, r.end_time, r.n_rows) for r in
            sustained_events(frame(spark, {"a": pts}), [rule]).orderBy("start_time").collect()]


def test_length_limit_and_series_borders(spark):
    assert simple(spark, [1, 1, 0, 1, 0, 1, 1]) == [(slot(0), slot(1), 2), (slot(5), slot(6), 2)]
    assert simple(spark, [1, 1, 1, 0, 1, 1, 1, 1], k=4) == [(slot(4), slot(7), 4)]


def test_a_missing_slot_does_not_split_a_run(spark):
    assert simple(spark, [1, 1, 1, 1, 0], holes={1, 2}) == [(slot(0), slot(3), 2)]


def test_one_run_over_many_chunks(spark):
    late = datetime(2025, 11, 1, 22)
    out = simple(spark, [0, *[1] * 300, 0, 1, 1], start=late)
    assert out == [(slot(1, late), slot(300, late), 300), (slot(302, late), slot(303, late), 2)]


def test_a_clean_chunk_between_breaching_chunks_splits(spark):
    day = [1] * 96
    assert [n for _, _, n in simple(spark, [*day, *[0] * 96, *day])] == [96, 96]
    # a run may end exactly at midnight and the next day start clean
    assert [n for _, _, n in simple(spark, [*day, 0, *[1] * 95])] == [96, 95]


def test_unknown_readings_do_not_breach(spark):
    assert simple(spark, [1, 1, None, 1, 1]) == [(slot(0), slot(1), 2), (slot(3), slot(4), 2)]


def split_frame(spark, series, borders):
    """The series cut at row numbers of its own order of times."""
    times = sorted({ts for pts in series.values() for ts, _ in pts})
    cuts = [times[0], *[times[int(len(times) * b)] for b in borders], times[-1] + timedelta(1)]
    return [frame(spark, {a: [(t, v) for t, v in pts if lo <= t < hi] for a, pts in series.items()} | {"none": []})
            for lo, hi in zip(cuts[:-1], cuts[1:])]


MEASURES = {"sums": {"total": "v"}, "peaks": {"top": "v"}}
TWO = [
    RunRule("high", "v > 4", 2, **MEASURES),
    RunRule("night", "v > 4", 3, scope="hour(timestamp) >= 20 OR hour(timestamp) < 7", **MEASURES),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_periods_one_after_the_other_equal_one_run(spark, seed, tmp_path):
    series = random_series(seed) | {"steady": [(slot(i), 9) for i in range(700)], "gone": [(slot(i), 9) for i in range(5)]}
    whole = sustained_events(frame(spark, series), TWO, tiebreak=("v",))
    marks, found = no_marks(spark, TWO), []
    for n, part in enumerate(split_frame(spark, series, (0.1, 0.35, 0.36, 0.8))):
        period = merge_runs(chunk_runs(part, TWO, tiebreak=("v",)), TWO, n)
        advance_runs(marks, period, TWO).write.parquet(str(tmp_path / f"{n}"))
        done = spark.read.parquet(str(tmp_path / f"{n}"))
        marks = done.where("open_end")
        assert marks.groupBy("asset_id", "rule").count().where("count > 1").count() == 0
        found.append(done.where("NOT open_end"))
    found.append(marks.where("n_rows >= CASE rule WHEN 'high' THEN 2 ELSE 3 END"))
    rejoined = found[0]
    for part in found[1:]:
        rejoined = rejoined.unionByName(part)
    for rule in ("high", "night"):
        assert result(rejoined, rule) == result(whole, rule) != []


def test_merging_is_associative(spark):
    series = random_series(8)
    a, b, c = (chunk_runs(part, TWO, tiebreak=("v",)) for part in split_frame(spark, series, (0.3, 0.6)))
    one = lambda n, *parts: merge_runs(parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0], TWO, n)
    left = one(0, one(0, one(0, a), one(1, b)), one(2, c))
    right = one(0, one(0, a), one(1, one(1, b), one(2, c)))
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))
