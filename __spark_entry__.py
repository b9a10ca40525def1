
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterwatch import config, schemas  # noqa: E402
from meterwatch.config import CLEAN  # noqa: E402
from meterwatch.functions import dates  # noqa: E402
from meterwatch.functions.sizing import stored_table  # noqa: E402
from meterwatch.functions.text import carbon_nz, cost_nzd, half_even, sql  # noqa: E402
from meterwatch.operators import energy, evidence, facility, prep, profile  # noqa: E402
from meterwatch.operators.exemptions import drop_exempt  # noqa: E402
from meterwatch.operators.runs import RunRule, advance_runs, chunk_runs, merge_runs, no_marks, sustained_events  # noqa: E402
from meterwatch.plans import bindings as b  # noqa: E402
from meterwatch.plans import logs, reporting, star  # noqa: E402
from meterwatch.sources import tables  # noqa: E402
from meterwatch.sources import weather as wx  # noqa: E402
from oracle_queries import WHITE, grouped, rnd, runs, with_shared  # noqa: E402

P = b.PARAMS
TESTDATA = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sustained ventilation and high-demand breaches."""
    return _air_quality(b.tables(spark, TESTDATA), "S06", "S08")


# ---------------------------------------------------------------- sources and preparation


def _weather_explode(t: b.TestTables) -> DataFrame:
    # one landed payload per day, as text
    payload = sql(
        f"""
        SELECT p.* FROM (
          SELECT from_json(to_json(struct(struct(h.time AS time, h.temp AS temperature_2m) AS hourly)),
                           '{schemas.WEATHER_PAYLOAD}') AS p
          FROM (SELECT sort_array(collect_list(struct(date_format(timestamp, "yyyy-MM-dd'T'HH:mm") AS time,
                                                      {half_even('outdoor_temp_c', 2)} AS temp))) AS h
                FROM {{hourly}} GROUP BY to_date(timestamp)))
        """,
        hourly=t.hourly_weather,
    )
    return wx.explode_payload(payload)


def _dim_scenarios(t: b.TestTables) -> DataFrame:
    # the dimension as the fact uses it: events and assets per scenario
    return sql(
        """
        SELECT s.*, coalesce(events, 0) AS events, coalesce(assets, 0) AS assets FROM {scenarios} s
        LEFT JOIN (SELECT scenario, count(*) AS events, count(DISTINCT asset_id) AS assets FROM {fact} GROUP BY 1) f ON s.scenario = f.scenario
        """,
        scenarios=config.scenarios(t.spark), fact=t.fact,
    )


def _parse_strict(t: b.TestTables) -> DataFrame:
    texts = t.source("orders").selectExpr("o_orderkey", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS text")
    return tables.conform(texts.withColumnRenamed("text", "event_time"), "o_orderkey bigint, event_time timestamp_ntz")


def _scan_projection(t: b.TestTables) -> DataFrame:
    high = t.source("events").where("value > 100")
    return tables.conform(high, "event_id bigint, user_id bigint, value double").where("value IS NOT NULL")


def _prior_optional(t: b.TestTables) -> DataFrame:
    # no prior month was ever delivered
    absent = tables.read_optional(t.spark, f"{t.sf_dir}/dim_baseline_prior_month.csv", schemas.PRIOR)
    return reporting.kpi_delta(star.kpi_summary(t.fact), absent)


def _picked(t: b.TestTables) -> DataFrame:
    # the asset with the most events, the smallest id on a tie
    busiest = sql(
        """
        SELECT * FROM {fact} WHERE asset_id =
          (SELECT min_by(asset_id, struct(-n, asset_id)) FROM (SELECT asset_id, count(*) AS n FROM {fact} GROUP BY asset_id))
        """,
        fact=t.fact,
    )
    return reporting.drill_down(busiest, config.scenarios(t.spark), "Facilities")


def _enriched(t: b.TestTables) -> DataFrame:
    return prep.enrich(t.telemetry, t.weather, P)


def _resampled(t: b.TestTables) -> DataFrame:
    return wx.resample_linear(t.hourly_weather)


def _overlaid(t: b.TestTables) -> DataFrame:
    hot = wx.overlay(_resampled(t), "outdoor_temp_c", "2024-01-25 14:00:00", "2024-01-25 15:00:00", 26.5)
    return wx.rounded(hot, 6)


# ---------------------------------------------------------------- blocks


_CO2 = RunRule("co2", "indoor_co2_ppm > 1000", 2, sums={"co2_sum": "indoor_co2_ppm"}, peaks={"co2_max": "indoor_co2_ppm"})
_CO2_COLUMNS = (
    "asset_id", "start_time", "end_time", "n_rows", "CAST(co2_sum AS BIGINT) AS co2_sum", "CAST(co2_max AS BIGINT) AS co2_max",
)


def _sustained(t: b.TestTables) -> DataFrame:
    return sustained_events(t.telemetry, [_CO2], tiebreak=facility.READING_ORDER).selectExpr(*_CO2_COLUMNS)


def _resumed(t: b.TestTables) -> DataFrame:
    # period after period, each behind the open runs of those before it
    rules = [_CO2]
    marks, done = no_marks(t.spark, rules), []
    for n, part in enumerate(t.periods()):
        runs = merge_runs(chunk_runs(part, rules, tiebreak=facility.READING_ORDER), rules, n)
        done.append(stored_table(advance_runs(marks, runs, rules), f"resumed_{n}"))
        marks = done[-1].where("open_end")
    closed = reduce(DataFrame.unionByName, [d.where("NOT open_end") for d in done], marks.where(f"n_rows >= {_CO2.min_rows}"))
    return closed.selectExpr(*_CO2_COLUMNS)


def _grid_under_jitter(t: b.TestTables) -> DataFrame:
    p = replace(P, jitter_seconds=15.0)
    return profile.grid_summary(profile.grid_profile(t.jittered, p), p).select("asset_id", "missing_slots", "missing_mins")


def _merged_baseline(t: b.TestTables) -> DataFrame:
    parts = reduce(DataFrame.unionByName, [profile.hour_moments(part) for part in t.periods()])
    return profile.baseline_of(profile.merge_moments(parts, "asset_id", "hour"), P)


def _merged_slots(t: b.TestTables) -> DataFrame:
    state = None
    for n, part in enumerate(t.periods()):
        now = stored_table(profile.grid_profile(part, P, state), f"slots_{n}")
        state = now if state is None else state.unionByName(now)
    return profile.grid_summary(state, P).select("asset_id", "missing_slots", "missing_mins")


def _resumed_chart(t: b.TestTables) -> DataFrame:
    # the chart of the last period, behind the state of the earlier ones
    days = [profile.daily_rollup(part, P) for part in t.periods()]
    state = profile.no_prefix(days[0])
    for n, past in enumerate(days[:-1]):
        state = stored_table(profile.cusum_prefix(state, past), f"chart_{n}")
    moments = reduce(DataFrame.unionByName, [profile.day_moments(d) for d in days])
    basis = profile.day_basis(profile.merge_moments(moments, "asset_id"), P)
    chart = profile.cusum_resumed(state, days[-1], basis, P)
    return chart.selectExpr("asset_id", "date", *_six("mu", "threshold", "cusum"), "alarm")


def _continued_ids(t: b.TestTables) -> DataFrame:
    a = t.audit
    fact = star.fact_audit_events(a.facility, a.energy, a.compliance, P, t.first_event_ids)
    return fact.select("event_seq", "event_id", "scenario", "asset_id", "event_time")


def _exemption_anti_join(t: b.TestTables) -> DataFrame:
    # every reading, tested as if it were an S04 event
    readings = t.telemetry.selectExpr("asset_id", "'S04' AS scenario", "timestamp")
    return drop_exempt(readings, t.exemptions, t.audit.profile, at="timestamp")


def _cost_carbon(t: b.TestTables) -> DataFrame:
    kwh = f"total_power_kw * {P.slot_hours}D"
    return t.telemetry.selectExpr(
        "asset_id", "timestamp", f"{half_even(kwh, 4)} AS kwh",
        f"{cost_nzd(kwh, P)} AS financial_cost", f"{carbon_nz(kwh, P)} AS carbon_kg",
    )


def _six(*names: str) -> list[str]:
    return [f"{half_even(n, 6)} AS {n}" for n in names]


def _daily(t: b.TestTables) -> DataFrame:
    return profile.daily_rollup(_enriched(t), P).selectExpr("asset_id", "date", "n_rows", *_six("hvac_kwh"), "day_trait")


def _cusum(t: b.TestTables) -> DataFrame:
    chart = profile.cusum(profile.daily_rollup(t.telemetry, P), P)
    return chart.selectExpr("asset_id", "date", *_six("mu", "threshold", "cusum"), "alarm")


# ---------------------------------------------------------------- rules


def _air_quality(t: b.TestTables, *codes: str) -> DataFrame:
    found = facility.air_quality(t.telemetry, t.registry, t.exemptions, P, codes, profile=t.audit.profile)
    return found.select(*schemas.FACILITY_LOG)


def _power(t: b.TestTables, *codes: str) -> DataFrame:
    readings = _enriched(t) if "S05" in codes else t.telemetry
    found = energy.power_events(
        t.telemetry, readings, t.registry, t.exemptions, P, codes, profile=t.audit.profile, days=t.audit.days
    )
    return found.select(*schemas.ENERGY_LOG)


def _verdicts(t: b.TestTables) -> DataFrame:
    return energy.asset_verdicts(t.audit.days, t.registry, P)


def _verdict_events(t: b.TestTables, code: str) -> DataFrame:
    return energy.verdict_events(_verdicts(t), t.exemptions, P, (code,)).select(*schemas.ENERGY_LOG)


def _summary_au(t: b.TestTables) -> DataFrame:
    return evidence.au_benchmark_summary(t.invoices, t.registry, P)


def _evidence(found: DataFrame) -> DataFrame:
    return found.select(*schemas.COMPLIANCE_LOG)


# ---------------------------------------------------------------- star schema and reports


def _assets(t: b.TestTables) -> DataFrame:
    return star.dim_assets(t.registry)


def _matrix(t: b.TestTables) -> DataFrame:
    return reporting.compliance_matrix(t.fact, _assets(t))


BY_TABLES: dict[str, Callable[[b.TestTables], DataFrame]] = {
    # sources
    "scan_projection": _scan_projection,
    "prior_optional": _prior_optional,
    "weather_explode": _weather_explode,
    "dim_assets": _assets,
    "dim_scenarios": _dim_scenarios,
    # preparation
    "parse_strict": _parse_strict,
    "parse_lenient": lambda t: dates.with_time(t.waste, "disposal_date", "event_time", P.default_event_time).select(
        "manifest_id", "disposal_date", "event_time"
    ),
    "date_forms": lambda t: dates.report(t.waste, "disposal_date"),
    "weather_enrich": lambda t: prep.weather_enrich(t.telemetry, t.weather).select(
        "asset_id", "timestamp", "outdoor_temp_c", "day_type"
    ),
    "time_features": lambda t: _enriched(t).select("asset_id", "timestamp", "hour", "is_weekday"),
    "cooling_degrees": lambda t: _enriched(t).selectExpr("asset_id", "timestamp", *_six("cdd")),
    "site_label": lambda t: prep.site_label(t.telemetry, t.registry).select("asset_id", "timestamp", "location"),
    "resample_linear": lambda t: wx.rounded(_resampled(t), 6),
    "day_type": lambda t: wx.with_day_type(_resampled(t)).select("timestamp", "day_type"),
    "interval_overlay": _overlaid,
    "format_ts": lambda t: wx.as_text(_resampled(t)),
    "iot_scope": lambda t: t.telemetry.select("asset_id", "timestamp").join(
        prep.metered(t.registry).select("asset_id"), "asset_id", "left_semi"
    ),
    # blocks
    "sustained_events": _sustained,
    "sustained_events_resumed": _resumed,
    "exemption_anti_join": _exemption_anti_join,
    "cost_carbon": _cost_carbon,
    "completeness": lambda t: profile.asset_profile(t.telemetry, P).selectExpr(
        "asset_id", "n_rows", *_six("completeness"), f"completeness >= {P.completeness}D AS complete"
    ),
    "assessed_span": lambda t: profile.asset_profile(t.telemetry, P).select("asset_id", "total_assessed_mins"),
    "missing_slots": lambda t: profile.slot_profile(t.telemetry, P).select(
        "asset_id", "missing_slots", "missing_mins"
    ),
    "missing_slots_jitter": _grid_under_jitter,
    "missing_slots_merged": _merged_slots,
    "baseline_merged": lambda t: _merged_baseline(t).selectExpr("asset_id", "hour", *_six("mean_kw", "std_kw", "limit_kw")),
    "cusum_resumed": _resumed_chart,
    "hourly_baseline": lambda t: profile.hourly_baseline(t.telemetry, P).selectExpr(
        "asset_id", "hour", *_six("mean_kw", "std_kw", "limit_kw")
    ),
    "daily_rollup_mode": _daily,
    "cusum": _cusum,
    "facility_log": lambda t: t.audit.facility.select(*schemas.FACILITY_LOG),
    "energy_log": lambda t: t.audit.energy.select(*schemas.ENERGY_LOG),
    "compliance_log": lambda t: t.audit.compliance.select(*schemas.COMPLIANCE_LOG),
    # rules
    "s01_unauthorised": lambda t: facility.unauthorised(t.audit.profile, t.registry, P).select(
        *schemas.FACILITY_LOG
    ),
    "s02_invoice_hash": lambda t: _evidence(evidence.hash_integrity(t.invoices)),
    "s02_cascade": lambda t: evidence.untrusted_assets(t.invoices),
    "s03_gap": lambda t: facility.telemetry_gaps(t.audit.profile, t.registry, P).select(*schemas.FACILITY_LOG),
    "s04_submeter": lambda t: _power(t, "S04"),
    "s05_after_hours": lambda t: _power(t, "S05"),
    "s06_co2": lambda t: _air_quality(t, "S06"),
    "s07_cusum": lambda t: _verdict_events(t, "S07"),
    "s08_high_demand": lambda t: _air_quality(t, "S08"),
    "s09_billing": lambda t: _evidence(evidence.billing_variance(t.invoices, t.registry, P)),
    "s10_benchmark": lambda t: _verdict_events(t, "S10"),
    "s11_travel": lambda t: _evidence(evidence.travel_class(t.travel, P)),
    "s12_waste": lambda t: _evidence(evidence.hazardous_waste(t.waste, P)),
    "benchmark_summary_nz": lambda t: energy.benchmark_summary(_verdicts(t)),
    "benchmark_summary_au": _summary_au,
    "scenario_totals": lambda t: logs.scenario_totals(t.audit.energy, t.audit.compliance),
    "outcome_counts": lambda t: t.audit.outcome_counts(),
    # star schema
    "fact_normalise": lambda t: star.energy_facts(t.audit.energy).select(
        "category", "scenario", "asset_id", "event_time", *star.MEASURES, "detail"
    ),
    "fact_events": lambda t: t.fact.select(*schemas.FACT),
    "event_ids": lambda t: t.fact.select("event_seq", "event_id", "scenario", "asset_id", "event_time"),
    "event_ids_continued": _continued_ids,
    "kpi_violations": lambda t: star.violations(t.fact),
    "kpi_net_avoidable": lambda t: star.net_avoidable(t.fact).selectExpr(
        *[f"{half_even(c, 3)} AS {c}" for c in NET_COLUMNS]
    ),
    "kpi_summary": lambda t: star.kpi_summary(t.fact),
    "priority_top1": lambda t: star.priority_top1(t.fact).select(
        "priority", "scenario", "asset_id", "event_id", "measure"
    ),
    "priority_detail": lambda t: star.priority_detail(star.priority_top1(t.fact), t.fact).select(
        "priority", "event_id", "detail"
    ),
    "priority_actions": lambda t: star.priority_actions(t.fact, config.scenarios(t.spark)),
    "events_by_category": lambda t: star.events_by_category(t.fact),
    # reporting tables
    "kpi_delta": lambda t: reporting.kpi_delta(star.kpi_summary(t.fact), b.prior_month(t.spark)),
    "compliance_matrix": _matrix,
    "compliance_matrix_wide": lambda t: reporting.compliance_matrix_wide(_matrix(t)).toDF(
        "asset_id", "display_name", "region", "facilities", "energy", "it_data", "finance", "esg"
    ),
    "short_label": lambda t: t.registry.selectExpr("asset_id", f"{reporting.short_label('asset_id')} AS label"),
    "drill_down": lambda t: reporting.drill_down(t.fact, config.scenarios(t.spark)),
    "drill_down_picked": _picked,
    "ieq_exceedance": lambda t: reporting.ieq_exceedance(t.fact, _assets(t), P),
    "ieq_high_demand": lambda t: reporting.ieq_exceedance(t.fact, _assets(t), P, "S08"),
    "ieq_daily": lambda t: reporting.ieq_daily(t.fact),
    "ieq_daily_total": lambda t: reporting.ieq_daily_total(reporting.ieq_daily(t.fact), P),
    "ieq_log": lambda t: reporting.ieq_log(t.fact, _assets(t), config.scenarios(t.spark)),
    "benchmark_rank": lambda t: reporting.benchmark_rank(energy.benchmark_summary(_verdicts(t)), _assets(t), P),
    "benchmark_au_status": lambda t: reporting.benchmark_au_status(_summary_au(t), _assets(t)),
    "energy_timeline": lambda t: reporting.energy_timeline(t.fact, _assets(t)),
    "energy_event_log": lambda t: reporting.energy_event_log(t.fact, _assets(t), config.scenarios(t.spark)),
    "evidence_findings": lambda t: reporting.evidence_findings(t.fact, _assets(t)),
    "evidence_log": lambda t: reporting.evidence_log(t.fact, _assets(t), config.scenarios(t.spark)),
}
NET_COLUMNS = ("attributable_cost", "attributable_carbon", "net_overrun_cost", "net_overrun_carbon")


def _absent(err: ModuleNotFoundError, *names: str) -> bool:
    return any((err.name or "") == n or (err.name or "").startswith(f"{n}.") for n in names)


try:  # the training-data operators can be taken out as a whole; a fault inside them is not hidden
    from meterwatch.llm.queries import ORACLE_SQL as LLM_SQL
    from meterwatch.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if not _absent(missing, "meterwatch.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if not _absent(missing, "corpus_pipeline", "meterwatch.llm"):
        raise
    corpus_pipeline = None


def queries() -> dict[str, Query]:
    found = {name: lambda spark, sf, run=run: run(b.tables(spark, sf)) for name, run in BY_TABLES.items()}
    found |= LLM_QUERIES
    return found if corpus_pipeline is None else found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    facility_cols, energy_cols = ", ".join(schemas.FACILITY_LOG), ", ".join(schemas.ENERGY_LOG)
    compliance_cols, fact_cols = ", ".join(schemas.COMPLIANCE_LOG), ", ".join(schemas.FACT)
    of = lambda cols, log, code: f"SELECT {cols} FROM {log} WHERE scenario = '{code}'"
    exceedance = lambda code: f"""
        SELECT asset_id, any_value(site) AS site, {rnd('sum(anomaly_duration_mins) / 60', 2)} AS exceedance_hours,
          {rnd('286.0::DOUBLE - sum(anomaly_duration_mins) / 60', 2)} AS compliant_hours,
          {rnd('sum(anomaly_duration_mins) / 60 / 286.0::DOUBLE * 100', 1)} AS breach_pct, count(*) AS events
        FROM named WHERE scenario = '{code}' GROUP BY asset_id"""
    oracles = {
        "scan_projection": "SELECT event_id, user_id, value FROM events WHERE value > 100",
        "weather_explode": f"SELECT timestamp, {rnd('outdoor_temp_c', 2)} AS outdoor_temp_c FROM hourly",
        "dim_assets": f"SELECT {', '.join(schemas.DIM_ASSETS)} FROM registry",
        "dim_scenarios": """SELECT s.*, coalesce(events, 0) AS events, coalesce(assets, 0) AS assets FROM scenarios s LEFT JOIN
            (SELECT scenario, count(*) AS events, count(DISTINCT asset_id) AS assets FROM fact GROUP BY 1) f ON f.scenario = s.scenario""",
        "parse_strict": "SELECT o_orderkey, date_trunc('second', o_orderdate) AS event_time FROM orders",
        "parse_lenient": """SELECT manifest_id, disposal_date, CASE WHEN disposal_date = 'not a date'
            THEN TIMESTAMP '2024-01-01' ELSE CAST(disposal_day AS TIMESTAMP) END AS event_time FROM waste""",
        "date_forms": """SELECT 'disposal_date' AS column, form, bool_and(disposal_date <> 'not a date') AS is_read, count(*) AS n
            FROM (SELECT *, CASE WHEN disposal_date = 'not a date' THEN disposal_date ELSE list_extract(['Y-9-9', '9/9/Y', 'Y-9-9 9:9:9',
              'Y-9-9T9:9:9', 'Y/9/9', '9/9/Y 9:9', 'Y-9-9 9:9:9.f'], CAST(row_ord % 7 AS INTEGER) + 1) END AS form FROM waste) GROUP BY form""",
        "weather_enrich": "SELECT asset_id, timestamp, outdoor_temp_c, day_type FROM enriched",
        "time_features": "SELECT asset_id, timestamp, CAST(hour AS INTEGER) AS hour, is_weekday FROM enriched",
        "cooling_degrees": f"SELECT asset_id, timestamp, {rnd('cdd', 6)} AS cdd FROM enriched",
        "site_label": """SELECT t.asset_id, timestamp, r.display_name AS location FROM telemetry t
            LEFT JOIN registry r ON r.asset_id = t.asset_id""",
        "resample_linear": f"SELECT timestamp, {rnd('outdoor_temp_c', 6)} AS outdoor_temp_c FROM resampled",
        "day_type": "SELECT timestamp, day_type FROM weather",
        "interval_overlay": f"""SELECT timestamp, CASE WHEN timestamp BETWEEN TIMESTAMP '2024-01-25 14:00:00'
            AND TIMESTAMP '2024-01-25 15:00:00' THEN 26.5::DOUBLE ELSE {rnd('outdoor_temp_c', 6)} END AS outdoor_temp_c
            FROM resampled""",
        "format_ts": f"""SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp,
            {rnd('outdoor_temp_c', 2)} AS outdoor_temp_c FROM resampled""",
        "iot_scope": """SELECT asset_id, timestamp FROM telemetry t
            WHERE asset_id IN (SELECT asset_id FROM registry WHERE has_iot)""",
        "sustained_events": f"""SELECT asset_id, start_time, end_time, n_rows, co2_sum, co2_max FROM
            ({runs('co2', 'telemetry', 'indoor_co2_ppm > 1000', 2,
                   ', CAST(sum(indoor_co2_ppm) AS BIGINT) AS co2_sum, max(indoor_co2_ppm) AS co2_max')})""",
        "sustained_events_resumed": f"""SELECT asset_id, start_time, end_time, n_rows, co2_sum, co2_max FROM
            ({runs('co2', 'telemetry', 'indoor_co2_ppm > 1000', 2,
                   ', CAST(sum(indoor_co2_ppm) AS BIGINT) AS co2_sum, max(indoor_co2_ppm) AS co2_max')})""",
        "missing_slots_jitter": """
            SELECT asset_id, (any_value(last) - any_value(first) + 15000000) // 900000000 + 1 - count(DISTINCT k) FILTER (near) AS missing_slots,
              ((any_value(last) - any_value(first) + 15000000) // 900000000 + 1 - count(DISTINCT k) FILTER (near)) * 15 AS missing_mins
            FROM (SELECT *, abs(us - first - k * 900000000) <= 15000000 AS near FROM (
              SELECT *, (us - first + 450000000) // 900000000 AS k FROM (
                SELECT *, min(us) OVER (PARTITION BY asset_id) AS first, max(us) OVER (PARTITION BY asset_id) AS last FROM (
                  SELECT asset_id, epoch_us(timestamp) + ((minute(timestamp) * 7 + hour(timestamp) * 3 + day(timestamp)) % 21 - 10) * 1000000 AS us
                  FROM telemetry)))) GROUP BY asset_id""",
        "missing_slots_merged": "SELECT asset_id, missing_slots, missing_slots * 15 AS missing_mins FROM gaps",
        "baseline_merged": f"""SELECT asset_id, CAST(hour AS INTEGER) AS hour, {rnd('mean_kw', 6)} AS mean_kw,
            {rnd('std_kw', 6)} AS std_kw, {rnd('limit_kw', 6)} AS limit_kw FROM baseline""",
        "cusum_resumed": f"""SELECT asset_id, date, {rnd('mu', 6)} AS mu, {rnd('threshold', 6)} AS threshold, {rnd('cusum', 6)} AS cusum,
            coalesce(cusum > threshold, false) AS alarm FROM control WHERE date >= DATE '{b.PERIOD_STARTS[-1]}'""",
        "event_ids_continued": """
            SELECT seq AS event_seq, 'EVT_' || CASE WHEN seq < 1000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END AS event_id,
              scenario, asset_id, event_time
            FROM (SELECT *, row_number() OVER (ORDER BY category <> 'Compliance', event_seq) AS seq FROM fact)""",
        "exemption_anti_join": """SELECT asset_id, 'S04' AS scenario, timestamp FROM telemetry t WHERE NOT EXISTS
            (SELECT 1 FROM exemptions x WHERE x.asset_id = t.asset_id AND x.scenario_id = 'S04'
               AND t.timestamp BETWEEN x.start_time AND x.end_time)""",
        "cost_carbon": f"""SELECT asset_id, timestamp, {rnd('total_power_kw * 0.25::DOUBLE', 4)} AS kwh,
            {rnd('total_power_kw * 0.25::DOUBLE * 0.25::DOUBLE', 2)} AS financial_cost,
            {rnd('total_power_kw * 0.25::DOUBLE * 0.11::DOUBLE', 3)} AS carbon_kg FROM telemetry""",
        "completeness": f"""SELECT asset_id, n_rows, {rnd('completeness', 6)} AS completeness,
            completeness >= 0.95 AS complete FROM profile""",
        "assessed_span": "SELECT asset_id, total_assessed_mins FROM profile",
        "missing_slots": "SELECT asset_id, missing_slots, missing_slots * 15 AS missing_mins FROM gaps",
        "hourly_baseline": f"""SELECT asset_id, CAST(hour AS INTEGER) AS hour, {rnd('mean_kw', 6)} AS mean_kw,
            {rnd('std_kw', 6)} AS std_kw, {rnd('limit_kw', 6)} AS limit_kw FROM baseline""",
        "daily_rollup_mode": f"SELECT asset_id, date, n_rows, {rnd('hvac_kwh', 6)} AS hvac_kwh, day_trait FROM daily",
        "cusum": f"""SELECT asset_id, date, {rnd('mu', 6)} AS mu, {rnd('threshold', 6)} AS threshold,
            {rnd('cusum', 6)} AS cusum, coalesce(cusum > threshold, false) AS alarm FROM control""",
        "facility_log": f"SELECT {facility_cols} FROM facility_log",
        "energy_log": f"SELECT {energy_cols} FROM energy_log",
        "compliance_log": f"SELECT {compliance_cols} FROM compliance_log",
        "s01_unauthorised": of(facility_cols, "facility_log", "S01"),
        "s02_invoice_hash": of(compliance_cols, "compliance_log", "S02"),
        "s02_cascade": "SELECT asset_id FROM untrusted",
        "s03_gap": of(facility_cols, "facility_log", "S03"),
        "s04_submeter": of(energy_cols, "energy_log", "S04"),
        "s05_after_hours": of(energy_cols, "energy_log", "S05"),
        "s06_co2": of(facility_cols, "facility_log", "S06"),
        "s07_cusum": of(energy_cols, "energy_log", "S07"),
        "s08_high_demand": of(facility_cols, "facility_log", "S08"),
        "s09_billing": of(compliance_cols, "compliance_log", "S09"),
        "s10_benchmark": of(energy_cols, "energy_log", "S10"),
        "s11_travel": of(compliance_cols, "compliance_log", "S11"),
        "s12_waste": of(compliance_cols, "compliance_log", "S12"),
        "benchmark_summary_nz": "SELECT * FROM summary_nz",
        "benchmark_summary_au": "SELECT * FROM summary_au",
        "scenario_totals": f"""SELECT scenario, {rnd('sum(waste_kwh)', 2)} AS waste_kwh,
              {rnd('sum(financial_cost)', 2)} AS financial_cost, {rnd('sum(financial_exposure)', 2)} AS financial_exposure,
              {rnd('sum(carbon_kg)', 2)} AS carbon_kg
            FROM fact_all WHERE category IN ('Energy', 'Compliance') GROUP BY scenario""",
        "outcome_counts": f"""
            SELECT 'S01' AS scenario, 'unverified' AS outcome, count(*) AS n, {rnd('sum(kwh_unverified)', 2)} AS amount FROM s01
            UNION ALL SELECT scenario, outcome, count(*), CAST(count(*) AS DOUBLE) FROM (
              SELECT 'S02' AS scenario, coalesce(hash_status, 'verified') AS outcome FROM hash_checks
              UNION ALL SELECT 'S05', CASE WHEN audit_trait = '{CLEAN}' THEN 'baseline_row' ELSE 'excluded_row' END FROM telemetry
              UNION ALL SELECT 'S07', CASE WHEN NOT complete THEN 'skipped_incomplete' WHEN clean_days < 3 THEN 'skipped_no_baseline'
                  WHEN alarm_date IS NOT NULL THEN 'alarm' ELSE 'no_degradation' END FROM verdicts
              UNION ALL SELECT 'S09', CASE WHEN held THEN 'SUSPENDED_PENDING_S02' WHEN variance > 0.15 THEN 'L4_BILLING_VARIANCE'
                  ELSE 'within_threshold' END FROM billing
              UNION ALL SELECT 'S10', CASE WHEN NOT complete THEN 'skipped_incomplete' WHEN ratio > 1.10 THEN 'breach'
                  ELSE 'on_track' END FROM verdicts
              UNION ALL SELECT 'S11', CASE WHEN trim(booked_class, {WHITE}) = 'Business' AND flight_hours < 6 THEN 'flagged'
                  ELSE 'compliant' END FROM travel
              UNION ALL SELECT 'S12', CASE WHEN trim(waste_type, {WHITE}) NOT IN ('Hazardous', 'E-Waste') THEN 'non_hazardous'
                  WHEN trim(coalesce(disposal_cert_url, ''), {WHITE}) = '' THEN 'certificate_missing' ELSE 'certified' END FROM waste)
            GROUP BY ALL""",
        "fact_normalise": f"""SELECT category, scenario, asset_id, event_time, {', '.join(star.MEASURES)}, detail
            FROM fact_all WHERE category = 'Energy'""",
        "fact_events": f"SELECT {fact_cols} FROM fact",
        "event_ids": "SELECT event_seq, event_id, scenario, asset_id, event_time FROM fact",
        "kpi_violations": """SELECT count(*) AS total_violations FROM fact_all
            WHERE scenario IN ('S01', 'S02', 'S03', 'S11', 'S12')""",
        "kpi_net_avoidable": "SELECT " + ", ".join(f"{rnd(c, 3)} AS {c}" for c in NET_COLUMNS) + " FROM net",
        "kpi_summary": "SELECT metric, value_nzd, value_aud, label, unit, note FROM kpi",
        "priority_top1": "SELECT priority, scenario, asset_id, event_id, measure FROM top1",
        "priority_detail": "SELECT priority, event_id, detail FROM detailed",
        "priority_actions": """SELECT priority, CASE priority WHEN 1 THEN 'Legal & Reputational Risk'
              WHEN 2 THEN 'Financial & Operational Impact' ELSE 'Regulatory & Certification Risk' END AS dimension,
              d.scenario, asset_id, s.scenario_name || ' — ' || status AS finding, detail, '' AS editable_recommendation
            FROM detailed d LEFT JOIN scenarios s ON s.scenario = d.scenario""",
        "events_by_category": "SELECT category, scenario, count(*) AS events FROM fact_all GROUP BY ALL",
        "kpi_delta": f"""
            SELECT metric, label, unit, CASE WHEN NOT held THEN value END AS value, prior_value, {rnd('change', 1)} AS delta_pct,
              CASE WHEN held THEN 'Under Review' WHEN change IS NULL THEN 'No prior-month comparison'
                WHEN change > 0 THEN 'worse' WHEN change < 0 THEN 'better' ELSE 'unchanged' END AS direction
            FROM (SELECT *, CASE WHEN NOT held AND prior_value <> 0 THEN (value - prior_value) / prior_value * 100 END AS change
              FROM (SELECT k.*, p.prior_value, k.metric IN ('avoidable_cost_au', 'avoidable_carbon_au') AND note <> '' AS held,
                  CASE WHEN k.metric IN ('avoidable_cost_au', 'avoidable_carbon_au') THEN value_aud ELSE value_nzd END AS value
                FROM kpi k LEFT JOIN (VALUES ('total_violations', 100.0::DOUBLE), ('avoidable_cost_nz', 5000.0::DOUBLE),
                  ('avoidable_cost_au', 10.0::DOUBLE), ('avoidable_carbon_nz', 0.0::DOUBLE),
                  ('s08_productivity_loss', 31200.0::DOUBLE)) p(metric, prior_value) ON p.metric = k.metric))""",
        "compliance_matrix": "SELECT * FROM matrix",
        "compliance_matrix_wide": """SELECT asset_id, display_name, region,
              max(state) FILTER (department = 'Facilities') AS facilities,
              max(state) FILTER (department = 'Energy Compliance') AS energy,
              max(state) FILTER (department = 'IT / Data') AS it_data,
              max(state) FILTER (department = 'Finance / Legal') AS finance,
              max(state) FILTER (department = 'ESG / Compliance') AS esg
            FROM matrix GROUP BY ALL""",
        "short_label": """SELECT asset_id, replace(replace(replace(asset_id, 'Asset_', 'A'), '_NZ_Boundary', ''),
            '_AU_Sydney', ' SYD') AS label FROM registry""",
        "prior_optional": """
            SELECT metric, label, unit, CASE WHEN NOT held THEN value END AS value, NULL::DOUBLE AS prior_value,
              NULL::DOUBLE AS delta_pct, CASE WHEN held THEN 'Under Review' ELSE 'No prior-month comparison' END AS direction
            FROM (SELECT *, metric IN ('avoidable_cost_au', 'avoidable_carbon_au') AND note <> '' AS held,
                CASE WHEN metric IN ('avoidable_cost_au', 'avoidable_carbon_au') THEN value_aud ELSE value_nzd END AS value
              FROM kpi)""",
        "drill_down_picked": """SELECT asset_id, department, event_id, audit_check, event_time, anomaly_duration_mins,
            financial_cost, financial_exposure, carbon_kg, detail FROM named WHERE department = 'Facilities' AND asset_id =
            (SELECT asset_id FROM named GROUP BY asset_id ORDER BY count(*) DESC, asset_id LIMIT 1)""",
        "drill_down": """SELECT asset_id, department, event_id, audit_check, event_time, anomaly_duration_mins,
            financial_cost, financial_exposure, carbon_kg, detail FROM named""",
        "ieq_exceedance": exceedance("S06"),
        "ieq_high_demand": exceedance("S08"),
        "ieq_daily": "SELECT * FROM zone_days",
        "ieq_daily_total": f"""SELECT {rnd('sum(exceedance_hours)', 1)} AS exceedance_hours,
            {rnd('sum(exceedance_hours) / 286.0::DOUBLE * 100', 1)} AS breach_pct, max(peak_co2) AS peak_co2 FROM zone_days""",
        "ieq_log": """SELECT event_id, site, audit_check, event_time, peak_co2_ppm, anomaly_duration_mins, detail
            FROM named WHERE scenario IN ('S06', 'S08')""",
        "benchmark_rank": f"""SELECT s.asset_id, r.display_name AS site, nabersnz_ratio, ytd_actual_mj_sqm, budget_mj_sqm,
              CASE WHEN breach THEN 'Above Budget' ELSE 'Within Budget' END AS benchmark_status,
              CASE WHEN space_designation = 'HIGH_DEMAND' THEN {rnd('budget_mj_sqm * 1.2::DOUBLE', 1)} END AS authorised_budget_mj_sqm
            FROM summary_nz s JOIN registry r ON r.asset_id = s.asset_id""",
        "benchmark_au_status": """SELECT s.asset_id, r.display_name AS site, ytd_actual_mj_sqm, budget_mj_sqm,
              CASE WHEN suspended THEN 'Under Review' WHEN breach THEN 'Above Budget' ELSE 'Within Budget' END AS benchmark_status
            FROM summary_au s JOIN registry r ON r.asset_id = s.asset_id""",
        "energy_timeline": """SELECT asset_id, site, CASE scenario WHEN 'S04' THEN 'Sub-Meter Drift' WHEN 'S05' THEN 'After-Hours Waste'
              ELSE 'Efficiency Degradation' END AS label, event_time,
              event_time + CAST(anomaly_duration_mins AS BIGINT) * INTERVAL '1 minute' AS end_time,
              CASE WHEN scenario = 'S07' THEN 'span' ELSE 'point' END AS mark, anomaly_duration_mins, waste_kwh, financial_cost
            FROM named WHERE scenario IN ('S04', 'S05', 'S07')""",
        "energy_event_log": """SELECT event_id, site, audit_check, event_time, anomaly_duration_mins, waste_kwh,
            financial_cost, carbon_kg FROM named WHERE scenario IN ('S04', 'S05', 'S07', 'S10')""",
        "evidence_findings": f"""SELECT scenario, CASE WHEN scenario = 'S11' THEN asset_id ELSE site END AS site,
              CASE scenario WHEN 'S02' THEN 'Flagged invoice' WHEN 'S09' THEN CASE WHEN contains(status, 'SUSPENDED')
                THEN 'Under Review' ELSE 'Variance' END WHEN 'S11' THEN 'Flagged travel' ELSE 'Uncertified waste' END AS state,
              CASE WHEN scenario = 'S11' THEN 'AUD ' || {grouped('financial_exposure')}
                WHEN scenario = 'S09' AND NOT contains(status, 'SUSPENDED') THEN 'AUD ' || {grouped('financial_exposure', 2)} END AS amount,
              CASE WHEN contains(status, 'SUSPENDED') THEN 'Invoice authenticity under review. Billing variance analysis will resume once document integrity is confirmed.'
                ELSE detail END AS finding
            FROM named WHERE scenario IN ('S02', 'S09', 'S11', 'S12')""",
        "evidence_log": """SELECT event_id, CASE WHEN contains(asset_id, 'Asset') THEN site ELSE asset_id END AS site,
              audit_check, standard AS standard_breached, replace(detail,
                'S09 analysis suspended — upstream S02 hash breach unresolved.',
                'Analysis suspended — invoice authenticity under review.') AS finding
            FROM named WHERE category = 'Compliance'""",
    }
    found = {name: with_shared(query) for name, query in oracles.items()} | LLM_SQL
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
