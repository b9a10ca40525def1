"""SQL text shared by the rules, and the helper that runs it over frames.

Whole expressions travel to the JVM as text: one call per statement instead of one per operator.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame

from meterwatch.config import AuditParams


def sql(query: str, params: AuditParams | None = None, **frames: DataFrame) -> DataFrame:
    """Run a query whose `{name}` places are frames or audit parameters."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(query, **frames, **(asdict(params) if params else {}))


def half_even(x: str, digits: int) -> str:
    """Round to `digits` decimals, ties to even.

    A first rounding six digits further out removes the noise that the order of a distributed
    float sum leaves behind, so that a tie is seen as a tie on every run.
    """
    fine, coarse = 10 ** (digits + 6), 10**digits
    return f"(rint(rint(({x}) * {fine}D) / {fine}D * {coarse}D) / {coarse}D)"


def strip(x: str) -> str:
    """Text without white space at either end: tabs, line ends and no-break spaces as well as blanks."""
    return rf"regexp_replace({x}, r'^[\s\u00A0]+|[\s\u00A0]+$', '')"


def fixed(x: str, digits: int, grouped: bool = False) -> str:
    """Text with a fixed number of decimals, half-even, optionally with thousands commas."""
    return f"format_string('%{',' if grouped else ''}.{digits}f', {half_even(x, digits)})"


def holds(cond: str) -> str:
    """A condition that is false, not unknown, on missing readings."""
    return f"coalesce({cond}, false)"


def whole_minutes(start: str, end: str) -> str:
    """Whole minutes between two timestamps, without any time-zone conversion."""
    return f"CAST(CAST({end} - {start} AS INTERVAL MINUTE) AS BIGINT)"


def assessed_minutes(first: str, last: str, floor: int) -> str:
    """Minutes under assessment, at least one slot (BLK5)."""
    return f"greatest({whole_minutes(first, last)}, {floor}L)"


def micros(ts: str) -> str:
    """Microseconds of a timestamp since 1970 by its own fields, without any time-zone conversion."""
    clock = f"(hour({ts}) * 3600L + minute({ts}) * 60L) * 1000000L + CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT)"
    return f"(unix_date(to_date({ts})) * 86400000000L + {clock})"


def slot_offset(ts: str, minutes: int) -> str:
    """How far a timestamp lies past the start of its slot within the hour."""
    return f"make_dt_interval(0, 0, minute({ts}) % {minutes}, extract(SECOND FROM {ts}))"


def day_chunk(ts: str, days: int) -> str:
    """Number of the `days`-long calendar chunk that holds a timestamp."""
    return f"CAST(floor(unix_date(to_date({ts})) / {days}) AS INT)"


def hour_chunk(ts: str, hours: int) -> str:
    """Number of the `hours`-long chunk that holds a timestamp, days being the default."""
    day = f"unix_date(to_date({ts}))"
    return day if hours == 24 else f"CAST(floor(({day} * 24 + hour({ts})) / {hours}) AS INT)"


def cooling_degrees(temp: str, base: float) -> str:
    """Degrees above the base temperature; null stays null (`greatest` alone would skip it) (PRE7)."""
    return f"CASE WHEN {temp} IS NOT NULL THEN greatest({temp} - {base}D, 0D) END"


def cost_nzd(kwh: str, p: AuditParams) -> str:
    """Cost of unrounded energy (BLK3)."""
    return half_even(f"({kwh}) * {p.nzd_per_kwh}D", 2)


def carbon_nz(kwh: str, p: AuditParams) -> str:
    """Carbon of unrounded energy (BLK3)."""
    return half_even(f"({kwh}) * {p.nz_kg_per_kwh}D", 3)


def columns(names: list[str], **values: str) -> str:
    """A select list: the given expression for a name, or the column itself."""
    return ", ".join(f"{values[n]} AS {n}" if n in values else n for n in names)
