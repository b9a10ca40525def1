"""Per-asset and per-day summaries of telemetry. All aggregate map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.config import CLEAN, AuditParams
from meterwatch.functions.sizing import stored_table
from meterwatch.functions.text import assessed_minutes, micros, slot_offset, sql


def asset_profile(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """Rows, first and last reading, energy, completeness and assessed minutes per asset (BLK4, BLK5)."""
    return sql(
        f"""
        SELECT asset_id, count(*) AS n_rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
               coalesce(sum(total_power_kw), 0D) * {p.slot_hours}D AS kwh, count(*) / {{expected_rows}} AS completeness,
               {assessed_minutes('min(timestamp)', 'max(timestamp)', p.slot_minutes)} AS total_assessed_mins
        FROM {{telemetry}} GROUP BY asset_id
        """,
        p, telemetry=telemetry,
    )


def slot_classes(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """Rows, energy, first and last reading and distinct times per asset and offset within the slot.

    A day's slots are marked as bits, so that a day of readings leaves a map task as one row and no
    single time is shuffled. The classes of two periods are those of one when they are added up.
    """
    minutes = p.slot_minutes
    words = range(-(-1440 // minutes // 60))
    slot = f"((hour(timestamp) * 60 + minute(timestamp)) DIV {minutes})"
    marks = ", ".join(
        f"bit_or(CASE WHEN {slot} DIV 60 = {w} THEN shiftleft(1L, CAST({slot} % 60 AS INT)) ELSE 0L END) AS w{w}"
        for w in words
    )
    times = f"""
        SELECT asset_id, to_date(timestamp) AS day, {slot_offset('timestamp', minutes)} AS offset, count(*) AS n, sum(total_power_kw) AS kw,
               min(timestamp) AS first_ts, max(timestamp) AS last_ts, {marks}
        FROM {{telemetry}} GROUP BY 1, 2, 3"""
    return sql(
        f"""
        SELECT asset_id, offset, sum(n) AS n, sum(kw) AS kw, sum({' + '.join(f'bit_count(w{w})' for w in words)}) AS n_times,
               min(first_ts) AS first_ts, max(last_ts) AS last_ts
        FROM ({times}) GROUP BY 1, 2
        """,
        telemetry=telemetry,
    )


def slot_summary(classes: DataFrame, p: AuditParams) -> DataFrame:
    """The asset profile plus missing slots of the grid that starts at the first reading (BLK6).

    Times with the same offset within a slot belong together, and the class of the first reading is the
    grid. No grid is generated. `classes` may hold the classes of several periods.
    """
    added = """
        SELECT asset_id, offset, sum(n) AS n, sum(kw) AS kw, sum(n_times) AS n_times, min(first_ts) AS first_ts, max(last_ts) AS last_ts
        FROM {classes} GROUP BY 1, 2"""
    spans = f"""
        SELECT asset_id, sum(n) AS n_rows, coalesce(sum(kw), 0D) * {p.slot_hours}D AS kwh, min_by(n_times, first_ts) AS on_grid,
               min(first_ts) AS first_ts, max(last_ts) AS last_ts
        FROM ({added}) GROUP BY asset_id"""
    return _summary(spans, p, classes=classes)


def _summary(spans: str, p: AuditParams, **frames: DataFrame) -> DataFrame:
    # a last reading that jitters to just before its slot still fills it
    whole = f"(({micros('last_ts')} - {micros('first_ts')} + {round(p.jitter_seconds * 1_000_000)}) DIV {p.slot_minutes * 60_000_000})"
    counted = f"SELECT *, {whole} + 1 - on_grid AS missing_slots FROM ({spans})"
    return sql(
        f"""
        SELECT asset_id, n_rows, first_ts, last_ts, kwh, n_rows / {{expected_rows}} AS completeness,
               {assessed_minutes('first_ts', 'last_ts', p.slot_minutes)} AS total_assessed_mins,
               missing_slots, missing_slots * {{slot_minutes}} AS missing_mins
        FROM ({counted})
        """,
        p, **frames,
    )


def slot_profile(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """The asset profile with missing slots, from one pass over the readings."""
    return slot_summary(slot_classes(telemetry, p), p)


def minute_classes(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """Rows, energy, span, seconds and seen slots per asset and whole minute of the offset within the slot.

    Seconds of jitter share a class, so at most `slot_minutes` rows per asset and day are shuffled. `n_times` is the
    number of distinct times of a class whose readings have the same seconds, `lo` = `hi`.
    """
    minutes = p.slot_minutes
    words = range(-(-1440 // minutes // 60))
    slot = f"((hour(timestamp) * 60 + minute(timestamp)) DIV {minutes})"
    marks = ", ".join(
        f"bit_or(CASE WHEN {slot} DIV 60 = {w} THEN shiftleft(1L, CAST({slot} % 60 AS INT)) ELSE 0L END) AS w{w}"
        for w in words
    )
    second = "extract(SECOND FROM timestamp)"
    days = f"""
        SELECT asset_id, to_date(timestamp) AS day, minute(timestamp) % {minutes} AS m, count(*) AS n, sum(total_power_kw) AS kw,
               min(timestamp) AS first_ts, max(timestamp) AS last_ts, min({second}) AS lo, max({second}) AS hi, {marks}
        FROM {{telemetry}} GROUP BY 1, 2, 3"""
    return sql(
        f"""
        SELECT asset_id, m, sum(n) AS n, sum(kw) AS kw, min(first_ts) AS first_ts, max(last_ts) AS last_ts, min(lo) AS lo, max(hi) AS hi,
               sum({' + '.join(f'bit_count(w{w})' for w in words)}) AS n_times
        FROM ({days}) GROUP BY 1, 2
        """,
        telemetry=telemetry,
    )


def grid_counts(telemetry: DataFrame, starts: DataFrame, p: AuditParams) -> DataFrame:
    """Slots seen on the grid that begins at `start`, for the assets of `starts`; a reading may lie `jitter_seconds` beside.

    The grid's slots are bits of one row per asset and 60 slots. `starts` holds one row per asset; Spark broadcasts it
    within its own bound of bytes and otherwise joins by asset.
    """
    slot, near = p.slot_minutes * 60_000_000, round(p.jitter_seconds * 1_000_000)
    placed = f"""
        SELECT asset_id, d, CAST(floor((d + {slot // 2}) / {slot}) AS BIGINT) AS k
        FROM (SELECT t.asset_id, {micros('t.timestamp')} - {micros('s.start')} AS d FROM {{telemetry}} t JOIN {{starts}} s ON t.asset_id = s.asset_id)"""
    words = f"""
        SELECT asset_id, k DIV 60 AS word, bit_or(shiftleft(1L, CAST(k % 60 AS INT))) AS seen
        FROM ({placed}) WHERE k >= 0 AND abs(d - k * {slot}) <= {near} GROUP BY 1, 2"""
    return sql(
        f"SELECT asset_id, sum(bit_count(seen)) AS on_grid FROM ({words}) GROUP BY asset_id",
        telemetry=telemetry, starts=starts,
    )


def grid_profile(telemetry: DataFrame, p: AuditParams, earlier: DataFrame | None = None) -> DataFrame:
    """Rows, energy, span and seen grid slots per asset: one row each, and those of several periods add up.

    The grid begins at the asset's first reading, which `earlier` rows of former periods know. Where the readings of its
    minute have the same seconds the classes hold the answer; readings are looked up again only for assets whose
    seconds vary, and for all if the policy allows jitter.
    """
    classes = stored_table(minute_classes(telemetry, p), "minute_classes")
    before = classes.selectExpr("asset_id", "first_ts")
    if earlier is not None:
        before = before.unionByName(earlier.select("asset_id", "first_ts"))
    starts = before.groupBy("asset_id").agg(F.min("first_ts").alias("start"))
    same_minute = f"m = minute(start) % {p.slot_minutes}"
    parts = stored_table(sql(
        f"""
        SELECT asset_id, any_value(start) AS start, sum(n) AS n, sum(kw) AS kw, min(first_ts) AS first_ts, max(last_ts) AS last_ts,
               coalesce(sum(n_times) FILTER (WHERE {same_minute} AND lo = hi AND lo = extract(SECOND FROM start)), 0L) AS on_grid,
               coalesce(bool_or({same_minute} AND lo <> hi), false) AS jitters
        FROM {{classes}} JOIN {{starts}} USING (asset_id) GROUP BY asset_id
        """,
        classes=classes, starts=starts,
    ), "grid_parts")
    unclear = parts.where("jitters OR " + ("true" if p.jitter_seconds else "false")).select("asset_id", "start")
    plain = parts.drop("start", "jitters")
    if unclear.isEmpty():
        return plain
    counted = grid_counts(telemetry, unclear, p).withColumnRenamed("on_grid", "looked_up")
    looked = unclear.select("asset_id").join(counted, "asset_id", "left").selectExpr("asset_id", "coalesce(looked_up, 0L) AS looked_up")
    return plain.join(looked, "asset_id", "left").selectExpr(
        "* EXCEPT (on_grid, looked_up)", "coalesce(looked_up, on_grid) AS on_grid"
    )


def grid_summary(parts: DataFrame, p: AuditParams) -> DataFrame:
    """The asset profile with missing slots, from the grid profiles of all periods (BLK4, BLK5, BLK6)."""
    added = f"""
        SELECT asset_id, sum(n) AS n_rows, coalesce(sum(kw), 0D) * {p.slot_hours}D AS kwh, sum(on_grid) AS on_grid,
               min(first_ts) AS first_ts, max(last_ts) AS last_ts
        FROM {{parts}} GROUP BY asset_id"""
    return _summary(added, p, parts=parts)


def hour_moments(telemetry: DataFrame) -> DataFrame:
    """Number, mean and summed squared deviation of clean HVAC power per asset and hour: `merge_moments` adds them up."""
    return sql(
        f"""
        SELECT asset_id, hour(timestamp) AS hour, count(hvac_power_kw) AS n, avg(hvac_power_kw) AS mean,
               var_pop(hvac_power_kw) * count(hvac_power_kw) AS m2
        FROM {{telemetry}} WHERE audit_trait = '{CLEAN}' GROUP BY 1, 2
        """,
        telemetry=telemetry,
    )


def day_moments(daily: DataFrame) -> DataFrame:
    """The same of clean days' HVAC energy per asset."""
    return sql(
        f"""
        SELECT asset_id, count(hvac_kwh) AS n, avg(hvac_kwh) AS mean, var_pop(hvac_kwh) * count(hvac_kwh) AS m2
        FROM {{daily}} WHERE day_trait = '{CLEAN}' GROUP BY 1
        """,
        daily=daily,
    )


def merge_moments(parts: DataFrame, *keys: str) -> DataFrame:
    """The moments of all parts of a key together. Deviations are taken from the common mean, not as a difference of squares."""
    by = ", ".join(keys)
    centred = f"SELECT *, sum(n * mean) OVER (PARTITION BY {by}) / sum(n) OVER (PARTITION BY {by}) AS centre FROM {{parts}} WHERE n > 0"
    return sql(
        f"""
        SELECT {by}, sum(n) AS n, any_value(centre) AS mean, sum(m2 + n * (mean - centre) * (mean - centre)) AS m2
        FROM ({centred}) GROUP BY {by}
        """,
        parts=parts,
    )


def baseline_of(moments: DataFrame, p: AuditParams) -> DataFrame:
    """HVAC mean, sample deviation and limit of merged hour moments (BLK7)."""
    return sql(
        """
        SELECT asset_id, hour, mean AS mean_kw, std_kw, mean + {idle_sigma} * std_kw AS limit_kw
        FROM (SELECT *, CASE WHEN n > 1 THEN sqrt(m2 / (n - 1)) END AS std_kw FROM {moments})
        """,
        p, moments=moments,
    )


def hourly_baseline(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """HVAC mean, sample deviation and limit per asset and hour, over clean rows (BLK7)."""
    return sql(
        f"""
        SELECT *, mean_kw + {{idle_sigma}} * std_kw AS limit_kw
        FROM (SELECT asset_id, hour(timestamp) AS hour, avg(hvac_power_kw) AS mean_kw,
                     stddev_samp(hvac_power_kw) AS std_kw
              FROM {{telemetry}} WHERE audit_trait = '{CLEAN}' GROUP BY 1, 2)
        """,
        p, telemetry=telemetry,
    )


def daily_rollup(telemetry: DataFrame, p: AuditParams) -> DataFrame:
    """One row per asset and day: rows, energy, modal trait, time bounds (BLK8).

    Counting per trait first lets every step hash-aggregate with a bounded state; the mode is then
    the most frequent trait, the smallest one on a tie.
    """
    cooling = "sum(cdd)" if "cdd" in telemetry.columns else "CAST(NULL AS DOUBLE)"
    dirty = f"NOT (audit_trait <=> '{CLEAN}')"
    per_trait = f"""
        SELECT asset_id, to_date(timestamp) AS date, audit_trait, count(*) AS n, sum(hvac_power_kw) AS hvac,
               sum(total_power_kw) AS total, {cooling} AS cdd, min(timestamp) AS lo, max(timestamp) AS hi
        FROM {{telemetry}} GROUP BY 1, 2, 3"""
    return sql(
        f"""
        SELECT asset_id, date, sum(n) AS n_rows, sum(CASE WHEN {dirty} THEN 0L ELSE n END) AS clean_rows,
               coalesce(sum(hvac), 0D) * {p.slot_hours}D AS hvac_kwh, coalesce(sum(total), 0D) * {p.slot_hours}D AS total_kwh,
               coalesce(sum(cdd), 0D) * {p.slot_hours}D AS cdd_hours,
               min(CASE WHEN audit_trait IS NOT NULL THEN struct(-n AS votes, audit_trait) END).audit_trait AS day_trait,
               min(lo) AS first_ts, max(hi) AS last_ts,
               min(lo) FILTER (WHERE {dirty}) AS dirty_from, max(hi) FILTER (WHERE {dirty}) AS dirty_to
        FROM ({per_trait}) GROUP BY asset_id, date
        """,
        telemetry=telemetry,
    )


def cusum(daily: DataFrame, p: AuditParams) -> DataFrame:
    """One-sided CUSUM of daily HVAC energy against the clean-day mean (BLK9).

    c(t) = max(0, c(t-1) + x - mu - K) equals S(t) - min(0, min S(1..t)) for the running sum S of
    the increments. A window holds one row per calendar day of an asset.
    """
    so_far = "PARTITION BY asset_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    clean_kwh = "CASE WHEN clean_day THEN hvac_kwh END"
    days = f"SELECT *, coalesce(day_trait = '{CLEAN}', false) AS clean_day FROM {{daily}}"
    based = f"""
        SELECT *, avg({clean_kwh}) OVER (PARTITION BY asset_id) AS mu,
               stddev_samp({clean_kwh}) OVER (PARTITION BY asset_id) * {{alarm_sigma}} AS threshold,
               count({clean_kwh}) OVER (PARTITION BY asset_id) AS clean_days
        FROM ({days})"""
    drifted = f"SELECT *, sum(hvac_kwh - mu - mu * {{slack_share}}) OVER ({so_far}) AS drift FROM ({based})"
    charted = f"""
        SELECT * EXCEPT (drift), drift - least(0D, min(drift) OVER ({so_far})) AS cusum
        FROM ({drifted})"""
    return sql(
        f"SELECT *, coalesce(cusum > threshold, false) AS alarm FROM ({charted})", p, daily=daily
    )


def day_basis(moments: DataFrame, p: AuditParams) -> DataFrame:
    """Mean, alarm threshold and number of clean days per asset, of merged day moments."""
    return sql(
        """
        SELECT asset_id, mean AS mu, CASE WHEN n > 1 THEN sqrt(m2 / (n - 1)) * {alarm_sigma} END AS threshold, n AS clean_days
        FROM {moments}
        """,
        p, moments=moments,
    )


def no_prefix(daily: DataFrame) -> DataFrame:
    """The chart's state before the first period."""
    return daily.selectExpr(
        "asset_id", "0 AS t", "0D AS x", "CAST(array() AS ARRAY<STRUCT<t: INT, x: DOUBLE>>) AS hull"
    ).where("false")


def cusum_prefix(before: DataFrame, daily: DataFrame) -> DataFrame:
    """The chart's state behind a period's days: number of days t, summed energy x, and the lower hull of all (t, x).

    With the drift S(t) = x(t) - m t, the least S so far lies on the lower convex hull of the points (t, x), whatever
    the allowance m. So the state serves a baseline that later periods move, and older days are not read again. A point
    belongs to the hull if no slope to its left is steeper than one to its right.
    """
    points = """
        SELECT asset_id, b.t AS t0, b.x AS x0, coalesce(hull, CAST(array() AS ARRAY<STRUCT<t: INT, x: DOUBLE>>)) AS hull,
               transform(coalesce(days, array()), d -> d.hvac_kwh) AS steps
        FROM {before} b FULL JOIN (SELECT asset_id, array_sort(collect_list(struct(date, hvac_kwh))) AS days FROM {daily} GROUP BY 1) USING (asset_id)"""
    # bounded by the days of the period
    summed = f"""
        SELECT *, aggregate(steps, struct(coalesce(t0, 0) AS t, coalesce(x0, 0D) AS x, hull AS seen),
                            (s, v) -> struct(s.t + 1 AS t, s.x + v AS x, concat(s.seen, array(struct(s.t + 1 AS t, s.x + v AS x))) AS seen)) AS s
        FROM ({points})"""
    steeper = "filter(s.seen, q -> q.t < p.t), q -> (p.x - q.x) / (p.t - q.t)"
    flatter = "filter(s.seen, q -> q.t > p.t), q -> (q.x - p.x) / (q.t - p.t)"
    return sql(
        f"""
        SELECT asset_id, s.t AS t, s.x AS x,
               filter(s.seen, p -> coalesce(array_max(transform({steeper})) <= array_min(transform({flatter})), true)) AS hull
        FROM ({summed})
        """,
        before=before, daily=daily,
    )


def cusum_resumed(before: DataFrame, daily: DataFrame, basis: DataFrame, p: AuditParams) -> DataFrame:
    """The chart of a period's days behind the state of all earlier ones, against the clean-day mean of `basis`.

    Equal to the last rows of `cusum` over all days, if `basis` holds the moments of all days.
    """
    in_order = "PARTITION BY asset_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    based = f"""
        SELECT d.*, coalesce(day_trait = '{CLEAN}', false) AS clean_day, mu, threshold, coalesce(clean_days, 0) AS clean_days, t AS t0, x AS x0, hull,
               mu + mu * {{slack_share}} AS allowance
        FROM {{daily}} d LEFT JOIN {{basis}} USING (asset_id) LEFT JOIN {{before}} USING (asset_id)"""
    drifted = f"""
        SELECT *, coalesce(x0, 0D) + sum(hvac_kwh) OVER ({in_order}) - allowance * (coalesce(t0, 0) + count(*) OVER ({in_order})) AS drift,
               least(0D, coalesce(array_min(transform(hull, h -> h.x - allowance * h.t)), 0D)) AS low
        FROM ({based})"""
    charted = f"""
        SELECT * EXCEPT (drift, low, t0, x0, hull, allowance), drift - least(low, min(drift) OVER ({in_order})) AS cusum
        FROM ({drifted})"""
    return sql(
        f"SELECT *, coalesce(cusum > threshold, false) AS alarm FROM ({charted})", p, daily=daily, basis=basis, before=before
    )
