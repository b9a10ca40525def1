"""A whole audit run: input tables in a folder to published logs, star schema and summaries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from meterwatch import config, schemas
from meterwatch.config import AuditParams
from meterwatch.functions import dates
from meterwatch.functions.sizing import run_scope, stored_table
from meterwatch.operators import energy, evidence
from meterwatch.plans import logs, reporting, star
from meterwatch.plans.audit import Audit
from meterwatch.plans.logs import AuditInputs
from meterwatch.schemas import COMPLIANCE_LOG, ENERGY_LOG, FACILITY_LOG, FACT
from meterwatch.sources import quarantine, tables
from meterwatch.sources import weather as wx
from meterwatch.sources.store import Draft, Store

# Names of the input tables.
INPUTS = {
    "telemetry": "fact_telemetry_ledger",
    "weather": "external_auckland_weather",
    "exemptions": "fact_exemption_registry",
    "invoices": "dim_invoices_proxy",
    "travel": "fact_travel_expense",
    "waste": "fact_waste_manifest",
}

PRIOR = "dim_baseline_prior_month"
INVOICE_ORDER = "year(billing_month) * 12 + month(billing_month)"


def load(
    spark: SparkSession, folder: str, fmt: str = "csv", params: AuditParams | None = None,
    registry: DataFrame | None = None, given: Mapping[str, DataFrame] | None = None, payload: str | None = None,
) -> AuditInputs:
    """Inputs from `folder`, one CSV file or Parquet folder per table.

    `given` replaces tables by frames, for instance of a database; `payload` is a file of hourly weather as it is downloaded,
    which is landed on the 15-minute grid instead of reading a weather table. A table whose columns have to be cast
    is stored once; rows that fail go to the quarantine, and the run ends if they are more than `reject_share`. A CSV
    ledger is landed by month, where a period prunes it. With a period, readings and weather outside it are left
    out; invoices, tickets and manifests are audited whole.
    """
    params, given = params or AuditParams(), dict(given or {})
    if payload is not None:
        given["weather"] = wx.landed(wx.explode_payload(wx.read_payload(spark, payload)))
    aside: list[DataFrame] = []

    def table(name: str) -> DataFrame:
        if name in given:
            return tables.strip_headers(given[name])
        path = f"{folder}/{INPUTS[name]}"
        if fmt == "csv":
            return tables.read_csv_text(spark, f"{path}.csv")
        return tables.strip_headers(spark.read.parquet(path))

    def kept(sifted: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        held = stored_table(sifted, f"sifted_{name}", partition_by)
        quarantine.check_budget(held, INPUTS[name], params.reject_share)
        aside.append(quarantine.rejects(held, INPUTS[name]))
        return quarantine.accepted(held)

    def fitted(name: str, schema: str, *optional: str) -> DataFrame:
        raw = table(name)
        if quarantine.needs_sifting(raw, schema):
            return kept(quarantine.sift(raw, schema, optional), name)
        return tables.conform(raw, schema, optional)

    evidence_table = lambda name, schema, order, *optional: tables.with_row_ord(fitted(name, schema, *optional), order)
    raw = table("telemetry")
    if quarantine.needs_sifting(tables.resolve_columns(raw, tables.TELEMETRY_ALIASES), schemas.TELEMETRY):
        ledger = kept(tables.ledger(raw, quarantine.sift), "telemetry", ("month",))
    else:
        ledger = tables.ledger(raw)
    weather = fitted("weather", schemas.WEATHER).selectExpr("*", f"{tables.MONTH} AS month")
    inputs = AuditInputs(
        telemetry=tables.readings(ledger, params.period),
        weather=tables.one_per_time(tables.readings(weather, params.period)),
        registry=registry or config.registry(spark),
        exemptions=fitted("exemptions", schemas.EXEMPTIONS, "application_type"),
        invoices=evidence_table("invoices", schemas.INVOICES, INVOICE_ORDER, "inferred_kwh"),
        travel=evidence_table("travel", schemas.TRAVEL, "ticket_id"),
        # manifests have no number: their events go by date and asset
        waste=evidence_table("waste", schemas.WASTE, "0"),
        params=params,
        rejects=tables.rejected(ledger),
        prior=tables.read_optional(spark, f"{folder}/{PRIOR}{'.csv' if fmt == 'csv' else ''}", schemas.PRIOR, fmt),
    )
    return replace(inputs, quarantine=reduce(DataFrame.unionByName, aside) if aside else None)


def publish(a: AuditInputs, write: Callable[[DataFrame, str], None], audit: Audit | None = None) -> None:
    """Compute every output table once and hand it to `write(table, name)`.

    Profile, daily rollup, verdicts, logs and fact are stored before they are read again, so that no
    rule runs twice. Tables are written also when they are empty.
    """
    p, audit = a.params, audit or Audit(a)
    fact, scenarios, assets = audit.fact, config.scenarios(a.telemetry.sparkSession), star.dim_assets(a.registry)
    summary_nz = energy.benchmark_summary(audit.verdicts)
    summary_au = evidence.au_benchmark_summary(a.invoices, a.registry, p)
    kpi = star.kpi_summary(fact)

    write(audit.facility.select(*FACILITY_LOG), "facility_audit_log")
    write(audit.energy.select(*ENERGY_LOG), "energy_audit_log")
    write(audit.compliance.select(*COMPLIANCE_LOG), "esg_compliance_audit_log")
    write(summary_nz, "nabersnz_summary")
    write(summary_au, "nabers_au_summary")
    write(fact.select(*FACT), "fact_audit_events")
    write(assets, "dim_assets")
    write(scenarios, "dim_scenarios")
    write(kpi, "dim_kpi_summary")
    write(star.priority_actions(fact, scenarios), "dim_priority_actions")

    write(dates.report(a.waste, "disposal_date"), "report_date_forms")
    if a.quarantine is not None:
        write(a.quarantine, "quarantine")
    if a.rejects is not None:
        write(a.rejects, "rejected_readings")
    if a.prior is not None:
        write(reporting.kpi_delta(kpi, a.prior), "report_kpi_delta")
    daily = reporting.ieq_daily(fact)
    reports = {
        "scenario_totals": logs.scenario_totals(audit.energy, audit.compliance),
        "outcome_counts": audit.outcome_counts(),
        "events_by_category": star.events_by_category(fact),
        "compliance_matrix": reporting.compliance_matrix(fact, assets),
        "drill_down": reporting.drill_down(fact, scenarios),
        "co2_exceedance": reporting.ieq_exceedance(fact, assets, p),
        "high_demand_exceedance": reporting.ieq_exceedance(fact, assets, p, "S08"),
        "ieq_daily": daily,
        "ieq_daily_total": reporting.ieq_daily_total(daily, p),
        "ieq_log": reporting.ieq_log(fact, assets, scenarios),
        "benchmark_rank": reporting.benchmark_rank(summary_nz, assets, p),
        "benchmark_au_status": reporting.benchmark_au_status(summary_au, assets),
        "energy_timeline": reporting.energy_timeline(fact, assets),
        "energy_event_log": reporting.energy_event_log(fact, assets, scenarios),
        "evidence_findings": reporting.evidence_findings(fact, assets),
        "evidence_log": reporting.evidence_log(fact, assets, scenarios),
    }
    for name, table in reports.items():
        write(table, f"report_{name}")


def run(spark: SparkSession, folder: str, out: str, fmt: str = "csv", params: AuditParams | None = None) -> None:
    """Audit the tables of `folder` and write all outputs below `out` in the same format."""
    sink = tables.write_csv if fmt == "csv" else tables.write_parquet
    with run_scope(spark):
        publish(load(spark, folder, fmt, params), partial(_into, sink, out))


def run_staged(
    spark: SparkSession, folder: str, root: str, fmt: str = "csv", params: AuditParams | None = None, store_fmt: str = "parquet"
) -> Store:
    """Audit the tables of `folder` into the store at `root`, whose tables switch all at once when every one is written.

    Event ids go on behind those of the store's periods. Without a table of prior KPIs, those of the latest
    earlier period of the store count.
    """
    store = Store(spark, root, store_fmt)
    with run_scope(spark):
        a = load(spark, folder, fmt, params)
        draft = store.begin(period_of(a.params))
        publish_staged(a, draft, Audit(a, store.read("fact_audit_events")))
    return store


def period_of(p: AuditParams) -> str:
    return p.period[0] if p.period else p.default_event_time


def publish_staged(a: AuditInputs, draft: Draft, audit: Audit) -> None:
    """Write all output tables to the draft and commit it."""
    prior = a.prior
    if prior is None or prior.isEmpty():
        kpi = draft.store.as_of("dim_kpi_summary", draft.period)
        prior = prior if kpi is None else reporting.prior_of(kpi)
    publish(replace(a, prior=prior), draft.write, audit)
    draft.commit()


def _into(sink: Callable[[DataFrame, str], None], out: str, table: DataFrame, name: str) -> None:
    sink(table, f"{out}/{name}")
