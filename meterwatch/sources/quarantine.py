"""Rows that do not fit their schema are set aside with column, text and reason, as long as they are few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwatch.sources.tables import cast_values, nan_to_null

REJECTS = "_rejects"  # a name that inputs do not have
QUARANTINE = "source string, column string, text string, reason string, row string"


def needs_sifting(df: DataFrame, schema: str) -> bool:
    """Whether any column of the schema has to be cast from another type."""
    kinds = dict(df.dtypes)
    return any(kinds.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString() for f in T.StructType.fromDDL(schema))


def sift(df: DataFrame, schema: str, optional: Sequence[str] = ()) -> DataFrame:
    """The columns of `conform`, with null for a value that does not fit, and all such values of the row in `_rejects`."""
    made = cast_values(df, schema, optional, "try_cast")
    failed = ", ".join(
        f"CASE WHEN {given} IS NOT NULL AND {value} IS NULL AND lower({given}) <> 'nan' "
        f"THEN struct('{name}' AS column, CAST({given} AS STRING) AS text, 'not a {kind}' AS reason) END"
        for name, given, value, kind in made if given is not None and kind != "string"
    )
    row = f"to_json(struct({', '.join(f'`{c}`' for c in df.columns)}))"
    fitted = df.selectExpr(
        *[f"{value} AS {name}" for name, _, value, _ in made],
        f"transform(array_compact(array({failed})), x -> struct(x.column, x.text, x.reason, {row} AS row)) AS {REJECTS}" if failed
        else f"CAST(array() AS ARRAY<STRUCT<column: STRING, text: STRING, reason: STRING, row: STRING>>) AS {REJECTS}",
    )
    return nan_to_null(fitted)


def accepted(sifted: DataFrame) -> DataFrame:
    return sifted.where(f"size({REJECTS}) = 0").drop(REJECTS)


def rejects(sifted: DataFrame, source: str) -> DataFrame:
    """One row per value that does not fit: its column, text and reason, and the row it stands in."""
    return sifted.selectExpr(f"'{source}' AS source", f"inline({REJECTS})")


def check_budget(sifted: DataFrame, source: str, share: float) -> None:
    """An error if more than `share` of the rows do not fit; reads the rejects of a stored table alone."""
    n, bad = sifted.agg(F.count("*"), F.count_if(F.size(REJECTS) > 0)).first()
    if bad > share * n:
        said = "; ".join(f"{r.column}: {r.text!r} is {r.reason}" for r in rejects(sifted, source).limit(3).collect())
        raise ValueError(f"{bad} of {n} rows of {source} do not fit, more than {share:g} of them ({said})")

