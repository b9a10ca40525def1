"""The registered queries as plain SQL over the test tables, written independently of the plans.

`SHARED` holds named common table expressions; a query lists the ones it needs by using their names.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding after removing float summation noise."""
    return f"round_even(round_even({expr}, {digits + 6}), {digits})"


def text(expr: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rnd(expr, digits)})"


def grouped(expr: str, digits: int = 0) -> str:
    whole = f"format('{{:,}}', CAST(trunc({rnd(expr, digits)}) AS BIGINT))"
    if digits == 0:
        return whole
    cents = f"CAST(round({rnd(expr, digits)} * {10**digits}) AS BIGINT) % {10**digits}"
    return f"{whole} || '.' || lpad(CAST({cents} AS VARCHAR), {digits}, '0')"


def minutes(a: str, b: str) -> str:
    return f"CAST(floor(epoch({b} - {a}) / 60) AS BIGINT)"


def runs(name: str, source: str, cond: str, rows: int, extra: str = "") -> str:
    """Islands of consecutive rows where `cond` holds, at least `rows` long."""
    return f"""
      SELECT asset_id, '{name}' AS scenario, min(timestamp) AS start_time, max(timestamp) AS end_time,
             count(*) AS n_rows {extra}
      FROM (SELECT *, sum(edge) OVER (PARTITION BY asset_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS blk
            FROM (SELECT *, CASE WHEN on_ IS NOT DISTINCT FROM lag(on_) OVER (PARTITION BY asset_id ORDER BY timestamp)
                            THEN 0 ELSE 1 END AS edge
                  FROM (SELECT *, coalesce({cond}, false) AS on_ FROM {source})))
      WHERE on_ GROUP BY asset_id, blk HAVING count(*) >= {rows}"""


NOT_EXEMPT = """NOT EXISTS (SELECT 1 FROM exemptions x WHERE x.asset_id = e.asset_id
      AND x.scenario_id = e.scenario AND x.start_time <= e.{at} AND x.end_time >= e.{at})"""

DEPARTMENTS = """CASE WHEN scenario IN ('S01','S03') THEN 'IT / Data' WHEN scenario IN ('S02','S09') THEN 'Finance / Legal'
    WHEN scenario = 'S10' THEN 'Energy Compliance' WHEN scenario IN ('S11','S12') THEN 'ESG / Compliance'
    ELSE 'Facilities' END"""

# white space at either end does not count: blank, tab, line feed, no-break space
WHITE = "' ' || chr(9) || chr(10) || chr(160)"
ADVICE = "'Monitor and increase fresh air supply'"

SHARED = {
    "registry": """
      SELECT c_custkey AS asset_ord,
        'Asset_' || c_custkey || CASE WHEN n_regionkey = 0 THEN '_AU_Sydney' ELSE '_NZ_Boundary' END AS asset_id,
        20 + abs(c_acctbal) / 10 AS area_sqm, CAST(10 + n_nationkey AS BIGINT) AS occupant_count,
        CASE WHEN n_regionkey = 0 THEN 'AU' ELSE 'NZ' END AS region, n_name AS location,
        n_regionkey <> 0 AS has_iot,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'HIGH_DEMAND' ELSE 'STANDARD' END AS space_designation,
        c_name AS display_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "telemetry": """
      SELECT timestamp, asset_id, CAST(400 + (10 * k_sum) // k_n AS BIGINT) AS indoor_co2_ppm,
        18 + k_sum / k_n / 12 AS indoor_temp_c, total_power_kw, hvac_power_kw, lighting_power_kw, it_load_power_kw,
        CASE WHEN unmetered > total_power_kw / 2 THEN 'L1_METER_FAULT'
             WHEN day(timestamp) >= 24 THEN 'L2_LATE_DRIFT' ELSE 'L0_CLEAN_COMPLIANT' END AS audit_trait
      FROM (SELECT time_bucket(INTERVAL '15 minutes', ts) AS timestamp, 'Asset_' || user_id || '_NZ_Boundary' AS asset_id,
          sum(value) AS total_power_kw,
          coalesce(sum(value) FILTER (event_type IN ('click', 'view')), 0) AS hvac_power_kw,
          coalesce(sum(value) FILTER (event_type = 'signup'), 0) AS lighting_power_kw,
          coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS it_load_power_kw,
          coalesce(sum(value) FILTER (event_type = 'error'), 0) AS unmetered,
          sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_sum, count(json_extract_string(props, '$.k')) AS k_n
        FROM events GROUP BY ALL)""",
    "hourly": """
      SELECT date_trunc('hour', ts) AS timestamp,
        10 + avg(CAST(json_extract_string(props, '$.k') AS BIGINT)) / 5 AS outdoor_temp_c
      FROM events GROUP BY ALL""",
    "resampled": """
      SELECT t0 + i * INTERVAL '15 minutes' AS timestamp,
        CASE WHEN t1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (i * 900.0 / epoch(t1 - t0)) END AS outdoor_temp_c
      FROM (SELECT t0, v0, t1, v1,
              unnest(range(CASE WHEN t1 IS NULL THEN 1 ELSE CAST(epoch(t1 - t0) / 900 AS BIGINT) END)) AS i
            FROM (SELECT timestamp AS t0, outdoor_temp_c AS v0, lead(timestamp) OVER (ORDER BY timestamp) AS t1,
                         lead(outdoor_temp_c) OVER (ORDER BY timestamp) AS v1 FROM hourly))""",
    "weather": f"""
      SELECT timestamp, {rnd('outdoor_temp_c', 2)} AS outdoor_temp_c,
        CASE WHEN isodow(timestamp) >= 6 THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type
      FROM resampled""",
    "enriched": """
      SELECT t.*, w.outdoor_temp_c, w.day_type, hour(t.timestamp) AS hour,
        CASE WHEN w.day_type = 'WEEKDAY' THEN 1 ELSE 0 END AS is_weekday,
        CASE WHEN w.outdoor_temp_c IS NOT NULL THEN greatest(w.outdoor_temp_c - 18.3, 0.0) END AS cdd
      FROM telemetry t LEFT JOIN weather w ON w.timestamp = t.timestamp""",
    "exemptions": """
      SELECT 'EX_' || o_orderkey AS exemption_id, 'Asset_' || o_custkey || '_NZ_Boundary' AS asset_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'S04' WHEN '2-HIGH' THEN 'S05' WHEN '3-MEDIUM' THEN 'S06'
          WHEN '4-NOT SPECIFIED' THEN 'S07' ELSE 'S08' END AS scenario_id,
        s AS start_time,
        CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) = 28 THEN TIMESTAMP '9999-12-31' ELSE s + INTERVAL '36 hours' END AS end_time
      FROM (SELECT *, TIMESTAMP '2024-01-01' + (date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30)
                      * INTERVAL '1 day' AS s FROM orders)""",
    "invoices": """
      SELECT o_orderkey AS row_ord,
        'Asset_' || o_custkey || CASE WHEN n_regionkey = 0 THEN '_AU_Sydney' ELSE '_NZ_Boundary' END AS asset_id,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_month, o_totalprice / 100 AS actual_billed_kwh,
        CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) = 7 THEN NULL
             WHEN o_orderpriority = '1-URGENT' AND day(o_orderdate) = 13 THEN sha256(t || '|altered')
             -- written as NA, which stands for no hash
             WHEN o_orderpriority = '2-HIGH' AND day(o_orderdate) = 17 THEN NULL
             ELSE sha256(t) END AS uploaded_pdf_hash,
        CASE WHEN o_orderpriority <> '2-HIGH' OR day(o_orderdate) <> 17 THEN sha256(t) END AS original_crypto_signature
      FROM (SELECT *, o_orderkey || '|' || CAST(o_totalprice AS DECIMAL(18, 2)) AS t FROM orders)
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "travel": """
      SELECT l_orderkey * 10 + l_linenumber AS row_ord, l_orderkey * 10 + l_linenumber AS ticket_id,
        'EMP_' || o_custkey AS employee_id, 'S' || l_suppkey || '-P' || l_partkey AS route,
        CASE o_orderpriority WHEN '1-URGENT' THEN ' Business ' WHEN '3-MEDIUM' THEN chr(9) || 'Business' || chr(160)
          WHEN '2-HIGH' THEN 'business' ELSE 'Economy' END AS booked_class,
        l_extendedprice AS ticket_price_aud, CAST(l_quantity AS DOUBLE) AS flight_hours
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "waste": """
      SELECT d.doc_id AS row_ord, 'WM_' || d.doc_id AS manifest_id, 'Asset_' || d.doc_id || '_NZ_Boundary' AS asset_id,
        CASE lang WHEN 'fr' THEN 'Hazardous' || chr(10) WHEN 'de' THEN ' E-Waste ' ELSE 'General' END AS waste_type,
        CASE WHEN source = 'src0' THEN 'not a date' ELSE CASE d.doc_id % 7 WHEN 0 THEN strftime(dd, '%Y-%m-%d')
          WHEN 1 THEN strftime(dd, '%-m/%-d/%Y') WHEN 2 THEN strftime(dt, '%Y-%m-%d %H:%M:%S')
          WHEN 3 THEN strftime(dt, '%Y-%m-%dT%H:%M:%S') WHEN 4 THEN strftime(dd, '%Y/%m/%d')
          WHEN 5 THEN strftime(dt, '%-m/%-d/%Y %-H:%M') ELSE '  ' || strftime(dt, '%Y-%m-%d %H:%M:%S') || '.5 ' END END AS disposal_date,
        CASE d.doc_id % 7 WHEN 0 THEN CAST(dd AS TIMESTAMP) WHEN 1 THEN CAST(dd AS TIMESTAMP) WHEN 4 THEN CAST(dd AS TIMESTAMP)
          WHEN 6 THEN dt + INTERVAL '500 milliseconds' ELSE dt END AS disposal_day, n_chars / 10 AS quantity_kg,
        CASE WHEN quality = 1 THEN 'cert/' || d.doc_id WHEN quality = 0 AND n_chars % 2 = 0 THEN '  '
          WHEN quality = 0 THEN chr(9) || chr(160) END AS disposal_cert_url
      FROM (SELECT *, dd + to_hours(CAST(n_chars % 24 AS INTEGER)) + to_minutes(CAST(n_chars % 60 AS INTEGER)) AS dt
            FROM (SELECT *, DATE '2024-01-01' + CAST(n_chars % 30 AS INTEGER) AS dd FROM documents)) d
      LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "profile": f"""
      SELECT asset_id, count(*) AS n_rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
        count(*) / 60.0 AS completeness,
        greatest({minutes('min(timestamp)', 'max(timestamp)')}, 15) AS total_assessed_mins
      FROM telemetry GROUP BY asset_id""",
    "sites": """
      SELECT r.*, p.n_rows AS asset_rows, p.first_ts, p.last_ts, p.completeness, p.total_assessed_mins
      FROM registry r JOIN profile p ON p.asset_id = r.asset_id WHERE r.has_iot""",
    "baseline": """
      SELECT asset_id, hour(timestamp) AS hour, avg(hvac_power_kw) AS mean_kw, stddev_samp(hvac_power_kw) AS std_kw,
        avg(hvac_power_kw) + 0.5 * stddev_samp(hvac_power_kw) AS limit_kw
      FROM telemetry WHERE audit_trait = 'L0_CLEAN_COMPLIANT' GROUP BY ALL""",
    "s01": """
      SELECT asset_id, count(*) AS n, min(timestamp) AS start_time, max(timestamp) AS end_time,
        sum(total_power_kw) * 0.25 AS kwh_unverified
      FROM telemetry t WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.asset_id = t.asset_id) GROUP BY asset_id""",
    "gaps": f"""
      SELECT asset_id, count(*) AS n_rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
        CAST({minutes('min(timestamp)', 'max(timestamp)')} // 15 + 1 - count(DISTINCT timestamp) AS BIGINT) AS missing_slots
      FROM telemetry GROUP BY asset_id""",
    "facility_log": f"""
      SELECT start_time, end_time, asset_id, 'S01' AS scenario, 'L0_UNAUTHORIZED_ASSET' AS status, 0.0::DOUBLE AS area_sqm,
        n * 15 AS anomaly_duration_mins, n * 15 AS total_assessed_mins, 0.0::DOUBLE AS waste_kwh,
        0.0::DOUBLE AS financial_cost, 0.0::DOUBLE AS carbon_kg, NULL::VARCHAR AS recommendation,
        NULL::DOUBLE AS cognitive_loss_nzd, NULL::DOUBLE AS avg_co2_ppm, NULL::BIGINT AS peak_co2_ppm,
        NULL::BIGINT AS occupants, 0 AS emit_group, 0::BIGINT AS emit_entity
      FROM s01
      UNION ALL
      SELECT s.first_ts, s.last_ts, s.asset_id, 'S03', 'L1_TIMESERIES_GAP', s.area_sqm, g.missing_slots * 15,
        s.total_assessed_mins, 0, 0, 0, NULL, NULL, NULL, NULL, NULL, 1, s.asset_ord
      FROM sites s JOIN gaps g ON g.asset_id = s.asset_id WHERE s.completeness < 0.95
      UNION ALL
      SELECT e.start_time, e.end_time, e.asset_id, 'S06', 'L1_IEQ_GREENWASHING', s.area_sqm, e.n_rows * 15,
        s.total_assessed_mins, 0, 0, 0, {ADVICE}, NULL, NULL, NULL, NULL, 1, s.asset_ord
      FROM ({runs('S06', 'telemetry', 'indoor_co2_ppm > 1000', 2)}) e JOIN sites s ON s.asset_id = e.asset_id
      UNION ALL
      SELECT e.start_time, e.end_time, e.asset_id, 'S08', 'L2_HIGH_DEMAND_IEQ_GAP', s.area_sqm, e.n_rows * 15,
        s.total_assessed_mins, 0, 0, 0, {ADVICE},
        {rnd('s.occupant_count * 300000.0::DOUBLE * 0.15::DOUBLE * (e.n_rows * 15 / 124800.0::DOUBLE)', 2)},
        {rnd('e.co2_avg', 0)}, e.co2_max, s.occupant_count, 1, s.asset_ord
      FROM ({runs('S08', 'telemetry', 'indoor_co2_ppm > 800 OR indoor_temp_c < 21 OR indoor_temp_c > 23', 2,
                  ', avg(indoor_co2_ppm) AS co2_avg, max(indoor_co2_ppm) AS co2_max')}) e
      JOIN sites s ON s.asset_id = e.asset_id
      WHERE s.space_designation = 'HIGH_DEMAND' AND {NOT_EXEMPT.format(at='start_time')}""",
    "s04_runs": f"""{runs('S04',
        '''(SELECT *, abs(total_power_kw - (hvac_power_kw + lighting_power_kw + it_load_power_kw)) AS gap,
             abs(total_power_kw - (hvac_power_kw + lighting_power_kw + it_load_power_kw)) / (total_power_kw + 1e-6) AS ratio
            FROM telemetry)''', 'ratio > 0.10', 2, ', avg(gap) AS gap_avg, avg(ratio) AS ratio_avg')}""",
    "s05_runs": f"""{runs('S05',
        '''(SELECT e.*, b.limit_kw FROM enriched e LEFT JOIN baseline b ON b.asset_id = e.asset_id AND b.hour = e.hour
            WHERE e.day_type = 'WEEKEND' OR (e.day_type = 'WEEKDAY' AND (e.hour < 7 OR e.hour >= 20)))''',
        'hvac_power_kw > limit_kw', 2,
        ', sum(greatest(hvac_power_kw - limit_kw, 0)) * 0.25 AS kwh, max(hvac_power_kw) AS hvac_max')}""",
    "traits": """
      SELECT asset_id, CAST(timestamp AS DATE) AS date, audit_trait, count(*) AS n
      FROM telemetry GROUP BY ALL""",
    "daily": """
      SELECT e.asset_id, CAST(e.timestamp AS DATE) AS date, count(*) AS n_rows,
        sum(hvac_power_kw) * 0.25 AS hvac_kwh, sum(total_power_kw) * 0.25 AS total_kwh,
        coalesce(sum(cdd), 0) * 0.25 AS cdd_hours, any_value(m.audit_trait) AS day_trait,
        min(timestamp) AS first_ts, max(timestamp) AS last_ts,
        min(timestamp) FILTER (e.audit_trait <> 'L0_CLEAN_COMPLIANT') AS dirty_from,
        max(timestamp) FILTER (e.audit_trait <> 'L0_CLEAN_COMPLIANT') AS dirty_to
      FROM enriched e JOIN (SELECT * FROM traits
          QUALIFY row_number() OVER (PARTITION BY asset_id, date ORDER BY n DESC, audit_trait) = 1) m
        ON m.asset_id = e.asset_id AND m.date = CAST(e.timestamp AS DATE)
      GROUP BY ALL""",
    "control": """
      SELECT *, drift - least(0, min(drift) OVER (PARTITION BY asset_id ORDER BY date ROWS UNBOUNDED PRECEDING)) AS cusum
      FROM (SELECT *, sum(hvac_kwh - mu - 0.10::DOUBLE * mu) OVER (PARTITION BY asset_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS drift
        FROM (SELECT *, day_trait = 'L0_CLEAN_COMPLIANT' AS clean_day,
            avg(hvac_kwh) FILTER (day_trait = 'L0_CLEAN_COMPLIANT') OVER (PARTITION BY asset_id) AS mu,
            0.5 * stddev_samp(hvac_kwh) FILTER (day_trait = 'L0_CLEAN_COMPLIANT') OVER (PARTITION BY asset_id) AS threshold,
            count(*) FILTER (day_trait = 'L0_CLEAN_COMPLIANT') OVER (PARTITION BY asset_id) AS clean_days
          FROM daily))""",
    "verdicts": f"""
      SELECT *, total_kwh * 3.6::DOUBLE AS actual_mj, (42.0::DOUBLE + 0.08::DOUBLE * cdd_hours) * area_sqm AS budget_mj,
        total_kwh * 3.6::DOUBLE / ((42.0::DOUBLE + 0.08::DOUBLE * cdd_hours) * area_sqm) AS ratio,
        greatest({minutes('first_ts', 'last_ts')} // 1440, 1) AS days_elapsed
      FROM (SELECT s.asset_id, any_value(s.asset_ord) AS asset_ord, any_value(s.area_sqm) AS area_sqm,
          any_value(s.total_assessed_mins) AS total_assessed_mins, any_value(s.completeness) >= 0.95 AS complete,
          sum(total_kwh) AS total_kwh, sum(cdd_hours) AS cdd_hours, any_value(s.first_ts) AS first_ts,
          any_value(s.last_ts) AS last_ts, any_value(mu) AS mu, any_value(threshold) AS threshold,
          any_value(clean_days) AS clean_days, min(date) FILTER (cusum > threshold) AS alarm_date,
          count(*) FILTER (NOT clean_day) AS dirty_days,
          coalesce(sum(greatest(hvac_kwh - mu, 0)) FILTER (NOT clean_day), 0) AS excess_kwh,
          min(dirty_from) AS dirty_from, max(dirty_to) AS dirty_to
        FROM control c JOIN sites s ON s.asset_id = c.asset_id GROUP BY s.asset_id)""",
    "energy_raw": """
      SELECT e.asset_id, e.scenario, 'L2_METER_LEAKAGE' AS status, e.start_time AS timestamp, e.end_time, s.area_sqm,
        e.n_rows * 15 AS anomaly_duration_mins, s.total_assessed_mins,
        e.gap_avg * (e.n_rows * 15 / 60.0::DOUBLE) AS kwh, e.start_time AS tested_at, s.asset_ord,
        e.ratio_avg, NULL::DOUBLE AS hvac_max, NULL::DATE AS alarm_date, NULL::DOUBLE AS mu, NULL::DOUBLE AS threshold,
        NULL::DOUBLE AS ratio, NULL::DOUBLE AS actual_mj, NULL::DOUBLE AS budget_mj, NULL::BIGINT AS days_elapsed
      FROM s04_runs e JOIN sites s ON s.asset_id = e.asset_id
      UNION ALL
      SELECT e.asset_id, e.scenario, 'L2_AFTER_HOURS_SPIKE', e.start_time, e.end_time, s.area_sqm, e.n_rows * 15,
        s.total_assessed_mins, e.kwh, e.start_time, s.asset_ord, NULL, e.hvac_max, NULL, NULL, NULL, NULL, NULL, NULL, NULL
      FROM s05_runs e JOIN sites s ON s.asset_id = e.asset_id
      UNION ALL
      SELECT asset_id, 'S07', 'L2_EFFICIENCY_DEGRADATION', dirty_from, dirty_to, area_sqm, dirty_days * 1440,
        total_assessed_mins, excess_kwh, CAST(alarm_date AS TIMESTAMP), asset_ord, NULL, NULL, alarm_date, mu, threshold,
        NULL, NULL, NULL, NULL
      FROM verdicts WHERE complete AND clean_days >= 3 AND alarm_date IS NOT NULL
      UNION ALL
      SELECT asset_id, 'S10', 'L1_NABERSNZ_BREACH', first_ts, last_ts, area_sqm, days_elapsed * 1440, total_assessed_mins,
        (actual_mj - budget_mj) / 3.6::DOUBLE, NULL, asset_ord, NULL, NULL, NULL, NULL, NULL, ratio, actual_mj, budget_mj, days_elapsed
      FROM verdicts WHERE complete AND budget_mj > 0 AND ratio > 1.10""",
    "energy_log": f"""
      SELECT timestamp, end_time, asset_id, scenario, status, area_sqm,
        CAST(anomaly_duration_mins AS BIGINT) AS anomaly_duration_mins, total_assessed_mins,
        {rnd('kwh', 4)} AS waste_kwh, {rnd('kwh * 0.25::DOUBLE', 2)} AS financial_cost, {rnd('kwh * 0.11::DOUBLE', 3)} AS carbon_kg,
        {rnd('ratio', 3)} AS nabersnz_ratio, {rnd('actual_mj / area_sqm', 1)} AS ytd_actual_mj_sqm,
        {rnd('budget_mj', 1)} AS nabersnz_budget_mj, days_elapsed, {rnd('hvac_max', 2)} AS peak_hvac_kw,
        strftime(alarm_date, '%Y-%m-%d') AS cusum_trigger_date, {rnd('mu', 1)} AS baseline_daily_kwh,
        {rnd('threshold', 1)} AS cusum_threshold, {rnd('ratio_avg', 4)} AS avg_diff_ratio,
        1 AS emit_group, asset_ord AS emit_entity
      FROM energy_raw e WHERE {NOT_EXEMPT.format(at='tested_at')}""",
    "hash_checks": """
      SELECT *, CASE WHEN uploaded_pdf_hash IS NULL OR original_crypto_signature IS NULL THEN 'L1_HASH_MISSING'
        WHEN uploaded_pdf_hash <> original_crypto_signature THEN 'L1_HASH_MISMATCH' END AS hash_status FROM invoices""",
    "untrusted": "SELECT DISTINCT asset_id FROM hash_checks WHERE hash_status IS NOT NULL",
    "billing": """
      SELECT i.*, i.asset_id IN (SELECT asset_id FROM untrusted) AS held, inferred,
        abs(actual_billed_kwh - inferred) AS gap, abs(actual_billed_kwh - inferred) / (inferred + 1e-6) AS variance
      FROM invoices i JOIN (SELECT asset_id, area_sqm * 265.0::DOUBLE / 3.6::DOUBLE / 12 AS inferred FROM registry
                            WHERE region = 'AU' AND NOT has_iot) r ON r.asset_id = i.asset_id""",
    "compliance_log": f"""
      SELECT asset_id AS ref_id, asset_id, 'S02' AS scenario, hash_status AS status,
        CASE hash_status WHEN 'L1_HASH_MISSING' THEN 'Invoice hash field is null — evidence chain cannot be established'
          ELSE 'PDF hash [' || uploaded_pdf_hash || '] does not match original signature [' || original_crypto_signature
               || '] — tampered or corrupted invoice' END AS detail,
        0.0::DOUBLE AS financial_exposure, 0.0::DOUBLE AS carbon_kg, billing_month, NULL::VARCHAR AS route,
        NULL::VARCHAR AS booked_class, NULL::DOUBLE AS flight_hours, NULL::DOUBLE AS ticket_price_aud,
        NULL::VARCHAR AS employee_id, NULL::VARCHAR AS waste_type, NULL::VARCHAR AS disposal_date,
        NULL::DOUBLE AS quantity_kg, NULL::DOUBLE AS actual_billed_kwh, NULL::DOUBLE AS inferred_kwh,
        NULL::DOUBLE AS variance_pct, 2 AS emit_group, row_ord AS emit_entity, NULL::TIMESTAMP AS disposal_day
      FROM hash_checks WHERE hash_status IS NOT NULL
      UNION ALL
      SELECT asset_id, asset_id, 'S09', 'SUSPENDED_PENDING_S02',
        'S09 analysis suspended — upstream S02 hash breach unresolved. Billing data cannot be relied upon until invoice integrity is confirmed.',
        0, 0, billing_month, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 9, row_ord, NULL
      FROM billing WHERE held
      UNION ALL
      SELECT asset_id, asset_id, 'S09', 'L4_BILLING_VARIANCE',
        'Billed ' || {text('actual_billed_kwh', 0)} || ' kWh vs NABERS-inferred ' || {text('inferred', 0)}
          || ' kWh — variance ' || {text('variance * 100', 1)} || '% exceeds 15% threshold',
        {rnd('gap * 0.40::DOUBLE', 2)}, {rnd('gap * 0.67::DOUBLE', 3)}, billing_month, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
        actual_billed_kwh, {rnd('inferred', 1)}, {rnd('variance * 100', 1)}, 9, row_ord, NULL
      FROM billing WHERE NOT held AND variance > 0.15
      UNION ALL
      SELECT CAST(ticket_id AS VARCHAR), employee_id, 'S11', 'L3_TRAVEL_CLASS_AUDIT',
        'Business class on short-haul route ' || route || ' (' || {text('flight_hours', 1)}
          || ' hrs) — exceeds 6-hour short-haul threshold',
        {rnd('ticket_price_aud', 2)}, 0, NULL, route, trim(booked_class, {WHITE}), flight_hours, ticket_price_aud, employee_id,
        NULL, NULL, NULL, NULL, NULL, NULL, 11, row_ord, NULL
      FROM travel WHERE trim(booked_class, {WHITE}) = 'Business' AND flight_hours < 6.0
      UNION ALL
      SELECT manifest_id, asset_id, 'S12', 'L3_WASTE_CERT_MISSING',
        trim(waste_type, {WHITE}) || ' disposal record has no certificate URL — compliance with HSNO Act 1996 and Basel Convention cannot be verified',
        0, 0, NULL, NULL, NULL, NULL, NULL, NULL, trim(waste_type, {WHITE}), disposal_date, quantity_kg, NULL, NULL, NULL,
        12, row_ord, disposal_day
      FROM waste WHERE trim(waste_type, {WHITE}) IN ('Hazardous', 'E-Waste')
        AND (disposal_cert_url IS NULL OR trim(disposal_cert_url, {WHITE}) = '')""",
    "fact_all": f"""
      SELECT *, {DEPARTMENTS} AS department,
        CASE WHEN contains(asset_id, 'Sydney') OR contains(asset_id, '_AU_') THEN 'AU' ELSE 'NZ' END AS region
      FROM (
        SELECT 1 AS category_ord, emit_group, emit_entity, asset_id, scenario, status, 'Facility' AS category,
          start_time AS event_time, CAST(anomaly_duration_mins AS DOUBLE) AS anomaly_duration_mins, waste_kwh,
          financial_cost, 0.0::DOUBLE AS financial_exposure, carbon_kg, cognitive_loss_nzd,
          CAST(peak_co2_ppm AS DOUBLE) AS peak_co2_ppm, 0.0::DOUBLE AS nabersnz_ratio, recommendation AS detail
        FROM facility_log
        UNION ALL
        SELECT 2, emit_group, emit_entity, asset_id, scenario, status, 'Energy', timestamp, anomaly_duration_mins,
          waste_kwh, financial_cost, 0, carbon_kg, 0, 0, nabersnz_ratio, '' FROM energy_log
        UNION ALL
        SELECT 3, emit_group, emit_entity, asset_id, scenario, status, 'Compliance',
          CASE WHEN disposal_date <> 'not a date' THEN CAST(disposal_day AS TIMESTAMP) ELSE TIMESTAMP '2024-01-01' END,
          0, 0, 0, financial_exposure, carbon_kg, 0, 0, 0, detail
        FROM (SELECT * REPLACE (coalesce(disposal_date, 'not a date') AS disposal_date) FROM compliance_log))""",
    "numbered": """
      SELECT *, row_number() OVER (ORDER BY category_ord, emit_group, emit_entity, scenario, event_time, asset_id,
        detail, financial_exposure) AS event_seq FROM fact_all""",
    "fact": "SELECT *, printf('EVT_%04d', event_seq) AS event_id FROM numbered",
    "assets": "SELECT * FROM registry",
    "net": """
      SELECT coalesce(sum(cost), 0) AS attributable_cost, coalesce(sum(carbon), 0) AS attributable_carbon,
        coalesce(sum(over_cost), 0) AS net_overrun_cost, coalesce(sum(over_carbon), 0) AS net_overrun_carbon
      FROM (SELECT financial_cost AS cost, carbon_kg AS carbon, 0.0::DOUBLE AS over_cost, 0.0::DOUBLE AS over_carbon
            FROM fact_all WHERE scenario IN ('S04', 'S05', 'S07') AND region = 'NZ'
            UNION ALL
            SELECT 0, 0, f.financial_cost * greatest(f.waste_kwh - coalesce(x.kwh, 0), 0) / f.waste_kwh,
                   f.carbon_kg * greatest(f.waste_kwh - coalesce(x.kwh, 0), 0) / f.waste_kwh
            FROM fact_all f LEFT JOIN (SELECT asset_id, sum(waste_kwh) AS kwh FROM fact_all
                WHERE scenario IN ('S04', 'S05', 'S07') AND region = 'NZ' GROUP BY asset_id) x ON x.asset_id = f.asset_id
            WHERE f.scenario = 'S10' AND f.region = 'NZ' AND f.waste_kwh > 0)""",
    "kpi": f"""
      SELECT metric, nzd AS value_nzd, aud AS value_aud, label, unit,
        CASE WHEN metric IN ('avoidable_cost_au', 'avoidable_carbon_au') AND au_cost = 0
               THEN 'Under Review — pending invoice verification'
             WHEN metric = 's08_productivity_loss' THEN 'Zero-cost remedy available' ELSE '' END AS note
      FROM (SELECT unnest([
              {{metric: 'total_violations', nzd: v, aud: 0.0::DOUBLE, label: 'Data & Compliance Violations', unit: 'count', au_cost: au_cost}},
              {{metric: 'avoidable_cost_nz', nzd: {rnd('c', 2)}, aud: 0.0::DOUBLE, label: 'Avoidable Energy Cost (NZ)', unit: 'NZD', au_cost: au_cost}},
              {{metric: 'avoidable_cost_au', nzd: 0.0::DOUBLE, aud: {rnd('au_cost', 2)}, label: 'Avoidable Energy Cost (AU)', unit: 'AUD', au_cost: au_cost}},
              {{metric: 'avoidable_carbon_nz', nzd: {rnd('k', 1)}, aud: 0.0::DOUBLE, label: 'Avoidable Carbon Emissions (NZ)', unit: 'kgCO2e', au_cost: au_cost}},
              {{metric: 'avoidable_carbon_au', nzd: 0.0::DOUBLE, aud: {rnd('au_carbon', 1)}, label: 'Avoidable Carbon Emissions (AU)', unit: 'kgCO2e', au_cost: au_cost}},
              {{metric: 's08_productivity_loss', nzd: {rnd('loss', 2)}, aud: 0.0::DOUBLE, label: 'HIGH-DEMAND Zone Staff Productivity Loss', unit: 'NZD', au_cost: au_cost}}],
              recursive := true)
            FROM (SELECT (SELECT CAST(count(*) AS DOUBLE) FROM fact_all WHERE scenario IN ('S01','S02','S03','S11','S12')) AS v,
                (SELECT attributable_cost + net_overrun_cost FROM net) AS c,
                (SELECT attributable_carbon + net_overrun_carbon FROM net) AS k,
                (SELECT coalesce(sum(financial_exposure), 0) FROM fact_all WHERE scenario = 'S09') AS au_cost,
                (SELECT coalesce(sum(carbon_kg), 0) FROM fact_all WHERE scenario = 'S09') AS au_carbon,
                (SELECT coalesce(sum(cognitive_loss_nzd), 0) FROM fact_all WHERE scenario = 'S08') AS loss))""",
    "summary_nz": f"""
      SELECT asset_id, {rnd('ratio', 3)} AS nabersnz_ratio, {rnd('actual_mj / area_sqm', 1)} AS ytd_actual_mj_sqm,
        {rnd('budget_mj / area_sqm', 1)} AS budget_mj_sqm, ratio > 1.10 AS breach
      FROM verdicts WHERE complete AND budget_mj > 0""",
    "summary_au": f"""
      SELECT asset_id, area_sqm, {rnd('kwh', 1)} AS inferred_kwh_month, {rnd('mj', 1)} AS ytd_actual_mj_sqm,
        165.0::DOUBLE AS budget_mj_sqm, {rnd('mj / 165.0::DOUBLE', 3)} AS nabers_ratio, mj > 165.0::DOUBLE * 1.10::DOUBLE AS breach,
        suspended, CASE WHEN suspended THEN 'S02_HASH_BREACH' ELSE '' END AS suspension_reason
      FROM (SELECT *, kwh * 12 * 3.6::DOUBLE / area_sqm AS mj
            FROM (SELECT r.asset_id, area_sqm, suspended,
                    CASE WHEN suspended THEN area_sqm * 265.0::DOUBLE / 3.6::DOUBLE / 12 ELSE billed END AS kwh
                  FROM registry r JOIN (SELECT asset_id, avg(actual_billed_kwh) AS billed,
                      bool_or(hash_status IS NOT NULL) AS suspended FROM hash_checks GROUP BY asset_id) i
                    ON i.asset_id = r.asset_id WHERE region = 'AU' AND NOT has_iot))""",
    "scenarios": None,  # filled in below from the scenario list
    "top1": """
      SELECT * FROM (SELECT *, CASE WHEN scenario IN ('S02','S09','S12') THEN 1 WHEN scenario IN ('S07','S08','S10') THEN 2
            WHEN scenario IN ('S06','S11') THEN 3 END AS priority,
          CASE WHEN scenario IN ('S02','S09','S12') THEN financial_exposure WHEN scenario IN ('S07','S08','S10') THEN financial_cost
            ELSE anomaly_duration_mins END AS measure FROM fact)
      WHERE priority IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY priority ORDER BY measure DESC NULLS LAST, event_seq) = 1""",
    "detailed": f"""
      SELECT t.* REPLACE (
        CASE t.scenario
          WHEN 'S10' THEN asset_id || ' YTD energy intensity is ' || {text('(nabersnz_ratio - 1) * 100', 1)}
            || '% above its climate-adjusted NABERSNZ budget (ratio ' || {text('nabersnz_ratio', 3)}
            || '). Current rating at risk of downgrade at next annual assessment. Primary driver: sustained high IT load. Recommended: workload migration assessment or data centre exclusion application to NZGBC.'
          WHEN 'S06' THEN asset_id || ' recorded ' || x.events || ' sustained CO2 exceedance events above 1,000 ppm during November workdays (total '
            || {text('x.mins', 0)} || ' minutes), breaching NZS 4303:1990 ventilation requirements.'
          WHEN 'S08' THEN asset_id || ' HIGH-DEMAND zone recorded ' || x.events || ' IEQ gap events in November. Estimated staff productivity loss: NZD '
            || {grouped('x.loss')} || '. Recoverable through HVAC fresh air recalibration within authorised +20% energy budget.'
          ELSE CASE WHEN trim(coalesce(detail, '')) NOT IN ('', 'nan') THEN trim(detail) ELSE status || ' detected at ' || asset_id END
        END AS detail)
      FROM top1 t LEFT JOIN (SELECT scenario, count(*) AS events, sum(anomaly_duration_mins) AS mins,
          coalesce(sum(cognitive_loss_nzd), 0) AS loss FROM fact_all GROUP BY scenario) x ON x.scenario = t.scenario""",
    "named": """
      SELECT f.*, coalesce(s.scenario_name, f.scenario) AS audit_check, s.standard,
        coalesce(a.display_name, f.asset_id) AS site
      FROM fact f LEFT JOIN scenarios s ON s.scenario = f.scenario LEFT JOIN registry a ON a.asset_id = f.asset_id""",
    "matrix": """
      SELECT c.asset_id, c.display_name, c.region, c.department, coalesce(n, 0) AS findings,
        CASE WHEN c.region = 'AU' AND c.department = 'Energy Compliance' THEN 'To Verify'
             WHEN coalesce(n, 0) > 0 THEN 'Finding' ELSE 'Clear' END AS state
      FROM (SELECT asset_id, display_name, region, unnest(CASE WHEN region = 'AU'
              THEN ['Energy Compliance', 'Finance / Legal', 'ESG / Compliance']
              ELSE ['Facilities', 'Energy Compliance', 'IT / Data', 'Finance / Legal', 'ESG / Compliance'] END) AS department
            FROM registry) c
      LEFT JOIN (SELECT asset_id, department, count(*) AS n FROM fact_all GROUP BY ALL) f
        ON f.asset_id = c.asset_id AND f.department = c.department""",
    "zone_days": f"""
      SELECT CAST(event_time AS DATE) AS date, {rnd('sum(anomaly_duration_mins) / 60', 2)} AS exceedance_hours,
        CAST(max(peak_co2_ppm) AS BIGINT) AS peak_co2, count(*) AS events
      FROM fact_all WHERE scenario = 'S08' GROUP BY 1""",
}


def _scenario_rows() -> str:
    from meterwatch.config import SCENARIOS

    quoted = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in SCENARIOS)
    return (
        "SELECT *, scenario NOT IN ('S01', 'S03', 'S04', 'S05') AS ceo_visible FROM (VALUES "
        f"{quoted}) v(scenario, scenario_name, department, audit_group, severity_level, engine, standard)"
    )


SHARED["scenarios"] = _scenario_rows()


def with_shared(query: str) -> str:
    """Prefix a query with the shared expressions it uses, dependencies first."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in SHARED:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                need(SHARED[name])
                if name not in order:
                    order.append(name)

    need(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({SHARED[n]})" for n in order) + "\n" + query
