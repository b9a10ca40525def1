"""Dates in text: the form of a whole column decides how its values are read (PRE2).

A date is year-month-day or two numbers and a year, parted by `-`, `/` or `.`, with a time behind a blank or `T` or without.
Two numbers before the year can mean month and day or day and month. The column votes: values whose first number passes
twelve speak for day first, those whose second one does for month first; without a majority the month is first, as it is
with dots only if the column says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.functions.text import sql, strip

# without braces, which stand for frames in statements
_CLOCK = r"(?:[ T](\d\d?):(\d\d)(?::([0-5]?\d(?:\.\d+)?))?Z?)?"
YEAR_FIRST = rf"^(\d\d\d\d)([-/.])(\d\d?)\2(\d\d?){_CLOCK}$"
YEAR_LAST = rf"^(\d\d?)([-/.])(\d\d?)\2(\d\d\d\d){_CLOCK}$"


def _made(text: str, pattern: str, year: int, month: int, day: int) -> str:
    part = lambda n: f"CAST(regexp_extract({text}, r'{pattern}', {n}) AS INT)"
    clock = lambda n, kind: f"CAST(coalesce(nullif(regexp_extract({text}, r'{pattern}', {n}), ''), '0') AS {kind})"
    return f"try_make_timestamp_ntz({part(year)}, {part(month)}, {part(day)}, {clock(5, 'INT')}, {clock(6, 'INT')}, {clock(7, 'DECIMAL(8, 6)')})"


def read_time(text: str, day_first: str = "false") -> str:
    """Text in any of the forms to a timestamp; null if it is none of them."""
    given = strip(text)
    return (
        f"CASE WHEN {given} RLIKE r'{YEAR_FIRST}' THEN {_made(given, YEAR_FIRST, 1, 3, 4)} "
        f"WHEN {given} RLIKE r'{YEAR_LAST}' THEN CASE WHEN {day_first} THEN {_made(given, YEAR_LAST, 4, 3, 1)} "
        f"ELSE {_made(given, YEAR_LAST, 4, 1, 3)} END END"
    )


def shape(text: str) -> str:
    """The form of a value: `Y` for a year, `9` for another number."""
    year = f"regexp_replace({strip(text)}, r'\\d\\d\\d\\d', 'Y')"
    fraction = f"regexp_replace({year}, r':\\d+\\.[\\dY]+', ':9.f')"
    return f"regexp_replace({fraction}, r'\\d+', '9')"


def votes(df: DataFrame, column: str) -> DataFrame:
    """One row: day_first, and the most frequent form in which the column's dates are written (the first on a tie)."""
    counted = f"""
        SELECT {shape('text')} AS form, count(*) AS n,
               count_if(text RLIKE r'{YEAR_LAST}' AND CAST(regexp_extract(text, r'{YEAR_LAST}', 1) AS INT) > 12) AS for_day,
               count_if(text RLIKE r'{YEAR_LAST}' AND CAST(regexp_extract(text, r'{YEAR_LAST}', 3) AS INT) > 12) AS for_month
        FROM (SELECT {strip(column)} AS text FROM {{df}})
        WHERE text RLIKE r'{YEAR_FIRST}' OR text RLIKE r'{YEAR_LAST}' GROUP BY 1"""
    return sql(
        f"""
        SELECT coalesce(sum(for_day) > sum(for_month), false) AS day_first, min(struct(-n AS votes, form)).form AS form
        FROM ({counted})
        """,
        df=df,
    )


def with_time(df: DataFrame, column: str, out: str, default: str | None = None, strict: bool = False) -> DataFrame:
    """Add `out`, the time that the column's text means; `default` where it means none.

    With `strict` only the column's most frequent form counts, and every other value is read as none.
    """
    day_first = "(SELECT day_first FROM {votes})"
    read = read_time(column, day_first)
    if strict:
        read = f"CASE WHEN {shape(column)} = (SELECT form FROM {{votes}}) THEN {read} END"
    value = read if default is None else f"coalesce({read}, TIMESTAMP_NTZ'{default}')"
    return sql(f"SELECT *, {value} AS {out} FROM {{df}}", df=df, votes=votes(df, column))


def report(df: DataFrame, column: str) -> DataFrame:
    """Values per form, and whether they are read: at most one row for each way in which the column is written."""
    timed = with_time(df.select(column), column, "read_as")
    return sql(
        f"""
        SELECT '{column}' AS column, {shape(column)} AS form, read_as IS NOT NULL AS is_read, count(*) AS n
        FROM {{timed}} WHERE {column} IS NOT NULL GROUP BY ALL
        """,
        timed=timed,
    )
