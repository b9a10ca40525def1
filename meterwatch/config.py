"""Audit parameters and reference dimensions."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from meterwatch import schemas


@dataclass(frozen=True)
class AuditParams:
    """Thresholds and rates; the defaults are the published audit policy."""

    # interval grid
    slot_minutes: int = 15
    expected_rows: int = 2880
    completeness: float = 0.95
    # how far beside its slot a reading may lie and still fill it
    jitter_seconds: float = 0.0

    # money and carbon
    nzd_per_kwh: float = 0.25
    aud_per_kwh: float = 0.40
    nz_kg_per_kwh: float = 0.11
    au_kg_per_kwh: float = 0.67
    mj_per_kwh: float = 3.6

    # S04 sub-meter drift
    leak_ratio: float = 0.10
    leak_rows: int = 4

    # S05 after-hours running
    open_hour: int = 7
    close_hour: int = 20
    idle_sigma: float = 3.0
    idle_rows: int = 4

    # S06 ventilation
    co2_ppm: float = 1000.0
    co2_rows: int = 2

    # S07 degradation
    slack_share: float = 0.10
    alarm_sigma: float = 5.0
    min_clean_days: int = 3

    # S08 high-demand zones
    zone_co2_ppm: float = 800.0
    zone_temp_low: float = 21.0
    zone_temp_high: float = 23.0
    zone_rows: int = 2
    salary_nzd: float = 300000.0
    impairment: float = 0.15
    work_minutes: float = 124800.0

    # S10 benchmark
    cooling_base_c: float = 18.3
    base_mj_sqm: float = 42.0
    mj_per_cdd: float = 0.08
    overrun_ratio: float = 1.10

    # S09 and the Australian benchmark
    au_median_mj_sqm: float = 265.0
    billing_variance: float = 0.15
    au_budget_mj_sqm: float = 165.0

    # S11, S12
    short_haul_hours: float = 6.0
    hazardous: tuple[str, ...] = ("Hazardous", "E-Waste")

    # share of a table's rows that may fail their schema and are set aside; more are an error
    reject_share: float = 0.001

    # reporting
    default_event_time: str = "2025-11-01 00:00:00"
    working_hours: float = 286.0
    zone_budget_factor: float = 1.2

    # how many hours one ordered window spans before its runs are stitched; shorten it where a
    # single asset sends more readings a day than one task should sort
    chunk_hours: int = 24

    # first and first excluded time of the audit; None takes all readings as one month
    period: tuple[str, str] | None = None

    def __post_init__(self) -> None:
        if self.slot_minutes <= 0 or 60 % self.slot_minutes:
            raise ValueError(f"slot_minutes must divide an hour, got {self.slot_minutes}")
        if not 0 <= self.jitter_seconds < self.slot_minutes * 30:
            raise ValueError(f"jitter must be less than half a slot, got {self.jitter_seconds} s")

    @property
    def slot_hours(self) -> float:
        return self.slot_minutes / 60

    def for_period(self, start: str, end: str) -> AuditParams:
        """The same policy for the readings of [start, end), with the rows and working hours that it should hold."""
        first, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
        if first >= last:
            raise ValueError(f"empty period {start} to {end}")
        days = [first + timedelta(days=n) for n in range(-(-(last - first) // timedelta(days=1)))]
        workdays = sum(day.weekday() < 5 for day in days)
        return replace(
            self, period=(str(first), str(last)), default_event_time=str(first),
            expected_rows=int((last - first) / timedelta(minutes=self.slot_minutes)),
            working_hours=float(workdays * (self.close_hour - self.open_hour)),
        )


CLEAN = "L0_CLEAN_COMPLIANT"
EXEMPTABLE = ("S04", "S05", "S07", "S08")
GUARD = 1e-6

# The registered sites (asset_id, area_sqm, occupant_count, region, location,
# has_iot, space_designation, display_name), in registration order.
SITES = [
    ("Asset_01_NZ_Boundary", 1200.0, 45, "NZ", "Auckland_HQ", True, "STANDARD", "Auckland HQ / L5"),
    ("Asset_02_NZ_Boundary", 2500.0, 100, "NZ", "Auckland_HQ", True, "STANDARD", "Auckland HQ / L6"),
    ("Asset_03_NZ_Boundary", 800.0, 35, "NZ", "Auckland_HQ", True, "STANDARD", "Auckland HQ / L7"),
    ("Asset_04_NZ_Boundary", 3200.0, 145, "NZ", "Auckland_HQ", True, "STANDARD", "10 Queen St / L3"),
    ("Asset_05_NZ_Boundary", 1500.0, 65, "NZ", "Auckland_HQ", True, "STANDARD", "10 Queen St / L4"),
    ("Asset_06_NZ_Boundary", 4000.0, 95, "NZ", "Auckland_HQ", True, "STANDARD", "Fanshawe St Campus"),
    ("Asset_07_NZ_Boundary", 950.0, 40, "NZ", "Auckland_HQ", True, "STANDARD", "45 Shortland St"),
    ("Asset_08_NZ_Boundary", 2100.0, 75, "NZ", "Auckland_HQ", True, "STANDARD", "Wynyard Quarter Office"),
    ("Asset_09_NZ_Boundary", 1100.0, 40, "NZ", "Auckland_HQ", True, "HIGH_DEMAND", "Commercial Bay Tower / L28"),
    ("Asset_10_NZ_Boundary", 1800.0, 62, "NZ", "Auckland_HQ", True, "STANDARD", "Viaduct Harbour Office"),
    ("Asset_11_AU_Sydney", 1000.0, 55, "AU", "Sydney_Office", False, "STANDARD", "Sydney Office / 88 Phillip St"),
]

# The audit scenarios (scenario, name, department, group, severity, engine, standard).
SCENARIOS = [
    ("S01", "Unauthorised Device Detection", "IT / Data", "Group 1 — Data Integrity", "L0", "IoT & Facility",
     "ISA/IEC 62443-2-1 · ISO/IEC 27402:2023"),
    ("S02", "Invoice Hash Integrity", "Finance / Legal", "Group 1 — Data Integrity", "L1", "ESG Evidence",
     "ISO/IEC 27001:2022 · ISAE 3000"),
    ("S03", "Telemetry Data Gap", "IT / Data", "Group 1 — Data Integrity", "L1", "IoT & Facility",
     "ISO 50001:2018 · IPMVP EVO 10000-1:2022"),
    ("S04", "Sub-Meter Calibration Drift", "Facilities", "Group 2 — Energy", "L2", "Energy",
     "LEED v4.1 Advanced Energy Metering"),
    ("S05", "After-Hours HVAC Idle Running", "Facilities", "Group 2 — Energy", "L2", "Energy",
     "ASHRAE Guideline 14-2023 · ISO 50001:2018"),
    ("S06", "IEQ Greenwashing Detection", "Facilities", "Group 3 — IEQ", "L1", "IoT & Facility",
     "NZS 4303:1990"),
    ("S07", "Equipment Efficiency Degradation", "Facilities", "Group 2 — Energy", "L2", "Energy",
     "ISO 50001:2018 · DOE/LBNL EMIS"),
    ("S08", "High-Demand Zone IEQ Optimisation", "Facilities", "Group 3 — IEQ", "L2", "IoT & Facility",
     "WELL Building Standard v2"),
    ("S09", "Invoice vs. NABERS Benchmark", "Finance / Legal", "Group 4 — Evidence", "L4", "ESG Evidence",
     "IPMVP Option C · ISAE 3000"),
    ("S10", "NABERSNZ Benchmarking Compliance", "Energy Compliance", "Group 2 — Energy", "L1", "Energy",
     "NABERSNZ Rules v1.2 · AS/NZS 3598.1:2014"),
    ("S11", "Scope 3 Travel Class Audit", "ESG / Compliance", "Group 5 — Scope 3", "L3", "ESG Evidence",
     "GHG Protocol Scope 3 Cat.6 · ISO 14083:2023"),
    ("S12", "Hazardous Waste Disposal Compliance", "ESG / Compliance", "Group 5 — Scope 3", "L3", "ESG Evidence",
     "HSNO Act 1996 · Basel Convention · GRI 306:2020"),
]

DETAIL_ONLY = ("S01", "S03", "S04", "S05")  # scenarios not shown at executive level
DEPARTMENTS = ("Facilities", "Energy Compliance", "IT / Data", "Finance / Legal", "ESG / Compliance")
UNMETERED_DEPARTMENTS = ("Energy Compliance", "Finance / Legal", "ESG / Compliance")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small configured table as a local relation, whose size the optimizer knows."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value).lower() if isinstance(value, bool) else repr(value)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({', '.join(name for name, _ in fields)})")


def registry(spark: SparkSession) -> DataFrame:
    """The configured sites; `asset_ord` keeps their registration order."""
    return literal_table(spark, [(n, *site) for n, site in enumerate(SITES, 1)], schemas.REGISTRY)


def scenarios(spark: SparkSession) -> DataFrame:
    """Scenario dimension (SRC6)."""
    known = literal_table(spark, SCENARIOS, schemas.SCENARIO)
    return known.selectExpr("*", f"scenario NOT IN {DETAIL_ONLY} AS ceo_visible")
