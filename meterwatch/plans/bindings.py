"""Audit inputs read from the generic test tables.

Users stand for metered assets, customers for the registry, orders for invoices and exemptions,
line items for travel tickets and documents for waste manifests. The telemetry ledger, the landed
weather and the event fact are tables: they are written once per session to the shared folder.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch import schemas
from meterwatch.config import CLEAN, AuditParams, literal_table
from meterwatch.functions.sizing import stored_table
from meterwatch.functions.text import sql
from meterwatch.plans import star
from meterwatch.plans.audit import Audit
from meterwatch.sources import weather as wx
from meterwatch.sources.tables import conform

# The test month is sparse: about 67 readings per asset instead of 2,880.
PARAMS = AuditParams(
    expected_rows=60, leak_rows=2, idle_sigma=0.5, idle_rows=2, alarm_sigma=0.5,
    default_event_time="2024-01-01 00:00:00",
)
START = "2024-01-01"
PERIOD_STARTS = ("2024-01-08", "2024-01-20")
AU, NZ = "'_AU_Sydney'", "'_NZ_Boundary'"

# Declared so that opening a table starts no job.
COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double",
    "documents": "doc_id bigint, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


class TestTables:
    """The audit inputs of one test data folder, each defined on first use."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, params: AuditParams = PARAMS):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    def source(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def customers(self) -> DataFrame:
        return sql(
            f"""
            SELECT *, CASE n_regionkey WHEN 0 THEN 'AU' ELSE 'NZ' END AS region,
                   concat('Asset_', c_custkey, CASE n_regionkey WHEN 0 THEN {AU} ELSE {NZ} END) AS asset_id
            FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
            """,
            customer=self.source("customer"), nation=self.source("nation"),
        )

    @cached_property
    def registry(self) -> DataFrame:
        """Customers as sites; Australian ones have no meters."""
        return sql(
            """
            SELECT c_custkey AS asset_ord, asset_id, 20 + abs(c_acctbal) / 10 AS area_sqm,
                   CAST(10 + n_nationkey AS BIGINT) AS occupant_count, region, n_name AS location,
                   region = 'NZ' AS has_iot,
                   CASE c_mktsegment WHEN 'BUILDING' THEN 'HIGH_DEMAND' ELSE 'STANDARD' END AS space_designation,
                   c_name AS display_name
            FROM {customers}
            """,
            customers=self.customers,
        )

    @cached_property
    def telemetry_view(self) -> DataFrame:
        """Events summed per user and 15-minute slot."""
        of = lambda *kinds: (
            "coalesce(sum(value) FILTER (WHERE event_type IN (" + ", ".join(f"'{k}'" for k in kinds) + ")), 0D)"
        )
        slots = f"""
            SELECT user_id, window.start AS timestamp, sum(value) AS total_power_kw,
                   {of('click', 'view')} AS hvac_power_kw, {of('signup')} AS lighting_power_kw,
                   {of('purchase')} AS it_load_power_kw, {of('error')} AS unmetered, sum(k) AS k_sum, count(k) AS k_n
            FROM (SELECT *, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {{events}})
            GROUP BY user_id, window(ts, '15 minutes')"""
        return sql(
            f"""
            SELECT timestamp, concat('Asset_', user_id, {NZ}) AS asset_id,
                   400 + (10 * k_sum) DIV k_n AS indoor_co2_ppm, 18 + k_sum / k_n / 12 AS indoor_temp_c,
                   total_power_kw, hvac_power_kw, lighting_power_kw, it_load_power_kw,
                   CASE WHEN unmetered > total_power_kw / 2 THEN 'L1_METER_FAULT'
                        WHEN day(timestamp) >= 24 THEN 'L2_LATE_DRIFT' ELSE '{CLEAN}' END AS audit_trait
            FROM ({slots})
            """,
            events=self.source("events"),
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        return stored_table(self.telemetry_view, f"telemetry_{self._folder}")

    @cached_property
    def hourly_weather(self) -> DataFrame:
        return sql(
            """
            SELECT window.start AS timestamp, 10 + sum(k) / count(k) / 5 AS outdoor_temp_c
            FROM (SELECT ts, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events})
            GROUP BY window(ts, '1 hour')
            """,
            events=self.source("events"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        return stored_table(wx.landed(self.hourly_weather), f"weather_{self._folder}")

    @cached_property
    def exemptions(self) -> DataFrame:
        """Every order as a 36-hour approval, moved into the test month; a few have no end."""
        return sql(
            f"""
            SELECT concat('EX_', o_orderkey) AS exemption_id, concat('Asset_', o_custkey, {NZ}) AS asset_id,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 'S04' WHEN '2-HIGH' THEN 'S05' WHEN '3-MEDIUM' THEN 'S06'
                     WHEN '4-NOT SPECIFIED' THEN 'S07' ELSE 'S08' END AS scenario_id,
                   start_time, CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) = 28 THEN TIMESTAMP_NTZ'9999-12-31'
                     ELSE start_time + INTERVAL '36' HOUR END AS end_time, o_orderstatus AS application_type
            FROM (SELECT *, CAST(date_add(DATE'{START}', date_diff(o_orderdate, DATE'1995-01-01') % 30)
                                 AS TIMESTAMP_NTZ) AS start_time FROM {{orders}})
            """,
            orders=self.source("orders"),
        )

    @cached_property
    def invoices(self) -> DataFrame:
        """Orders as invoices; some hashes are missing, written as NA, or of another text.

        The hash comes out of an array, so that conditions on it are not rewritten to hash the text each time they name it.
        """
        raw = sql(
            """
            SELECT o_orderkey AS row_ord, asset_id, trunc(o_orderdate, 'MM') AS billing_month,
                   o_totalprice / 100 AS actual_billed_kwh,
                   CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) = 7 THEN NULL
                        WHEN o_orderpriority = '1-URGENT' AND day(o_orderdate) = 13 THEN sha2(concat(text, '|altered'), 256)
                        WHEN o_orderpriority = '2-HIGH' AND day(o_orderdate) = 17 THEN 'NA'
                        ELSE signature END AS uploaded_pdf_hash,
                   CASE WHEN o_orderpriority = '2-HIGH' AND day(o_orderdate) = 17 THEN 'NA'
                        ELSE signature END AS original_crypto_signature
            FROM (SELECT *, explode(array(sha2(text, 256))) AS signature
                  FROM (SELECT *, concat(o_orderkey, '|', CAST(o_totalprice AS DECIMAL(18, 2))) AS text FROM {orders}))
            JOIN {customers} ON o_custkey = c_custkey
            """,
            orders=self.source("orders"), customers=self.customers,
        )
        return conform(raw, "row_ord bigint, " + schemas.INVOICES, ("inferred_kwh",))

    @cached_property
    def travel(self) -> DataFrame:
        """Line items as tickets, their order's customer as traveller."""
        return sql(
            """
            SELECT l_orderkey * 10 + l_linenumber AS row_ord, l_orderkey * 10 + l_linenumber AS ticket_id,
                   concat('EMP_', o_custkey) AS employee_id, concat('S', l_suppkey, '-P', l_partkey) AS route,
                   CASE o_orderpriority WHEN '1-URGENT' THEN ' Business ' WHEN '3-MEDIUM' THEN '\\tBusiness\\u00A0'
                     WHEN '2-HIGH' THEN 'business'
                     ELSE 'Economy' END AS booked_class,
                   l_extendedprice AS ticket_price_aud, CAST(l_quantity AS DOUBLE) AS flight_hours
            FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
            """,
            lineitem=self.source("lineitem"), orders=self.source("orders"),
        )

    @cached_property
    def waste(self) -> DataFrame:
        """Documents as manifests, their labels as certificates; dates are written in seven forms."""
        return sql(
            f"""
            SELECT doc_id AS row_ord, concat('WM_', doc_id) AS manifest_id, concat('Asset_', doc_id, {NZ}) AS asset_id,
                   CASE lang WHEN 'fr' THEN 'Hazardous\\n' WHEN 'de' THEN ' E-Waste ' ELSE 'General' END AS waste_type,
                   CASE WHEN source = 'src0' THEN 'not a date' ELSE CASE doc_id % 7
                     WHEN 0 THEN date_format(day, 'yyyy-MM-dd') WHEN 1 THEN date_format(day, 'M/d/yyyy')
                     WHEN 2 THEN date_format(at, 'yyyy-MM-dd HH:mm:ss') WHEN 3 THEN date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
                     WHEN 4 THEN date_format(day, 'yyyy/MM/dd') WHEN 5 THEN date_format(at, 'M/d/yyyy H:mm')
                     ELSE concat('  ', date_format(at, 'yyyy-MM-dd HH:mm:ss'), '.5 ') END END AS disposal_date,
                   n_chars / 10 AS quantity_kg,
                   CASE WHEN quality = 1 THEN concat('cert/', doc_id) WHEN quality = 0 AND n_chars % 2 = 0 THEN '  '
                        WHEN quality = 0 THEN '\\t\\u00A0' END AS disposal_cert_url
            FROM (SELECT *, CAST(day AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(n_chars % 24 AS INT), CAST(n_chars % 60 AS INT)) AS at
                  FROM (SELECT *, date_add(DATE'{START}', CAST(n_chars % 30 AS INT)) AS day FROM {{documents}}))
            LEFT JOIN {{labels}} USING (doc_id)
            """,
            documents=self.source("documents"), labels=self.source("labels"),
        )

    @cached_property
    def audit(self) -> Audit:
        """The stored tables that a run of the pipeline makes as well."""
        return Audit(self)

    @cached_property
    def jittered(self) -> DataFrame:
        """The readings up to ten seconds beside their slots."""
        shift = "make_dt_interval(0, 0, 0, CAST((minute(timestamp) * 7 + hour(timestamp) * 3 + day(timestamp)) % 21 - 10 AS DECIMAL(8, 6)))"
        return self.telemetry.withColumn("timestamp", F.expr(f"timestamp + {shift}"))

    def periods(self) -> list[DataFrame]:
        """The readings in three consecutive periods."""
        cuts = [START, *PERIOD_STARTS, "2100-01-01"]
        return [self.telemetry.where(f"timestamp >= TIMESTAMP_NTZ'{lo}' AND timestamp < TIMESTAMP_NTZ'{hi}'") for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]

    @cached_property
    def first_event_ids(self) -> DataFrame:
        """Events that a first run has published: those of the evidence chain."""
        facts = star.compliance_facts(self.audit.compliance, self.params.default_event_time)
        return stored_table(star.with_event_ids(facts).select(*schemas.FACT), "first_event_ids")

    @property
    def fact(self) -> DataFrame:
        return self.audit.fact

    @property
    def _folder(self) -> str:
        return self.sf_dir.strip("/").replace("/", "_")


_OPEN: dict[tuple[str, str], TestTables] = {}


def tables(spark: SparkSession, sf_dir: str) -> TestTables:
    """The inputs of a folder, shared by all queries of an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = TestTables(spark, sf_dir)
    return _OPEN[key]


def prior_month(spark: SparkSession) -> DataFrame:
    """Last month's KPIs: one metric is missing, one is zero."""
    rows = [
        ("total_violations", 100.0, ""), ("avoidable_cost_nz", 5000.0, ""), ("avoidable_cost_au", 10.0, ""),
        ("avoidable_carbon_nz", 0.0, ""), ("s08_productivity_loss", 31200.0, ""),
    ]
    return literal_table(spark, rows, schemas.PRIOR)
