"""Sustained events: runs of consecutive breaching rows (BLK1).

Adjacency is by row position in time order, not by clock time: missing slots and rows outside a
rule's scope do not split a run.

One asset may hold a large share of all rows, so no task orders a whole series. Rows are ordered
within (asset, chunk of hours); a chunk reduces to its breaching runs and a mark of its first row.
Only the first run of a chunk and a run that lasts to its end can continue elsewhere, and these, at
most two per chunk and rule, are stitched per asset. All rules of a call share one exchange and one
sort of the readings.

Stitching is associative: the runs of several chunks reduce to those of one longer chunk, of the same
form. A period of readings is such a chunk, and what earlier periods leave behind is one open run per
asset and rule, a mark that the next period continues or closes. No period's readings are read twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from meterwatch.functions.text import holds, hour_chunk, sql


CHUNK = "_run_chunk"  # a name that inputs do not have


@dataclass(frozen=True)
class RunRule:
    """One breach condition, as SQL. `scope` limits the sequence to the rows where it holds."""

    name: str
    breach: str
    min_rows: int
    scope: str | None = None
    sums: Mapping[str, str] = field(default_factory=dict)
    peaks: Mapping[str, str] = field(default_factory=dict)


def with_chunk(df: DataFrame, hours: int, ts: str = "timestamp") -> DataFrame:
    return df.selectExpr("*", f"{hour_chunk(ts, hours)} AS {CHUNK}")


def chunks_of_days(days: DataFrame, hours: int) -> DataFrame:
    """The chunks that an asset's days reach into; `days` holds one row per asset and date."""
    if hours == 24:
        return days.selectExpr("asset_id", f"unix_date(date) AS {CHUNK}")
    at = lambda hour: f"CAST(floor((unix_date(date) * 24 + {hour}) / {hours}) AS INT)"
    return days.selectExpr("asset_id", f"explode(sequence({at(0)}, {at(23)})) AS {CHUNK}").distinct()


def measures(rules: Sequence[RunRule]) -> tuple[list[str], list[str]]:
    """Names of the summed and of the greatest measures of any rule."""
    return sorted({m for r in rules for m in r.sums}), sorted({m for r in rules for m in r.peaks})


def _folded(rules: Sequence[RunRule]) -> str:
    sums, peaks = measures(rules)
    return "".join([f", sum({m}) AS {m}" for m in sums] + [f", max({m}) AS {m}" for m in peaks])


def chunk_runs(
    df: DataFrame, rules: Sequence[RunRule], key: str = "asset_id", ts: str = "timestamp",
    tiebreak: Sequence[str] = (), chunk_hours: int = 24,
) -> DataFrame:
    """Breaching runs of every chunk, and a row that does not breach where a chunk begins with one.

    Returns key, chunk, rule, run (1 if it begins the chunk), breach, open_end (it lasts to the chunk's
    end), n_rows, start_time, end_time and the measures. Readings that `with_chunk` has already marked
    are used as they are.
    """
    readings = df if CHUNK in df.columns else with_chunk(df, chunk_hours, ts)
    sums, peaks = measures(rules)
    order = ", ".join([ts, *tiebreak])
    in_order = f"PARTITION BY {key}, {CHUNK} ORDER BY {order}"
    so_far = f"{in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    flags, around, marks, members = [], [], [], []
    for n, r in enumerate(rules):
        on, prev = f"on{n}", f"prev{n}"
        if r.scope is None:
            flags.append(f"{holds(r.breach)} AS {on}")
            around += [f"lag({on}) OVER ({in_order}) AS {prev}", f"lead({on}) OVER ({in_order}) IS NULL AS end{n}"]
        else:
            flags.append(f"CASE WHEN {holds(r.scope)} THEN {holds(r.breach)} END AS {on}")
            around += [
                f"last({on}, true) OVER ({so_far} 1 PRECEDING) AS {prev}",
                f"count({on}) OVER ({so_far} CURRENT ROW) = count({on}) OVER (PARTITION BY {key}, {CHUNK}) AS end{n}",
            ]
        marks += [
            f"sum(CASE WHEN {on} IS NULL OR {on} <=> {prev} THEN 0 ELSE 1 END) OVER ({so_far} CURRENT ROW) AS run{n}",
            f"{on} IS NOT NULL AND ({on} OR {prev} IS NULL) AS keep{n}",
        ]
        # measures are computed after the exchange: only the columns they read travel through it
        own = {**r.sums, **r.peaks}
        values = "".join(f", '{m}', CAST({own.get(m, 'NULL')} AS DOUBLE)" for m in [*sums, *peaks])
        members.append(
            f"CASE WHEN keep{n} THEN named_struct('rule', '{r.name}', 'breach', {on}, 'run', run{n}, "
            f"'at_end', end{n}{values}) END"
        )
    kept = " OR ".join(f"keep{n}" for n in range(len(rules)))

    flagged = f"SELECT *, {', '.join(flags)} FROM {{readings}}"
    compared = f"SELECT *, {', '.join(around)} FROM ({flagged})"
    numbered = f"SELECT *, {', '.join(marks)} FROM ({compared})"
    # breaching rows go on, and of every chunk its first row, which shows that the chunk exists
    candidates = f"""
        SELECT {key}, {CHUNK} AS chunk, {ts} AS ts, inline(array({', '.join(members)}))
        FROM ({numbered}) WHERE {kept}"""
    return sql(
        f"""
        SELECT {key}, chunk, rule, run, bool_or(breach) AS breach, bool_or(breach AND at_end) AS open_end,
               count(*) AS n_rows, min(ts) AS start_time, max(ts) AS end_time{_folded(rules)}
        FROM ({candidates}) WHERE breach IS NOT NULL
        GROUP BY {key}, chunk, rule, run
        """,
        readings=readings,
    )


def _stitched(key: str) -> str:
    """SQL: the runs of `{runs}` with the block of runs that each continues."""
    along = f"PARTITION BY {key}, rule, part ORDER BY chunk, run"
    # a border run waits for its neighbours in the asset's part, an inner run stays in its chunk
    placed = "SELECT *, CASE WHEN run > 1 AND NOT open_end THEN chunk END AS part FROM {runs}"
    joined = f"""
        SELECT *, CASE WHEN run = 1 AND breach AND coalesce(lag(open_end) OVER ({along}), false)
                       THEN 0 ELSE 1 END AS fresh
        FROM ({placed})"""
    return f"""
        SELECT *, sum(fresh) OVER ({along} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block
        FROM ({joined})"""


def _enough(rules: Sequence[RunRule]) -> str:
    return f"CASE rule {' '.join(f"WHEN '{r.name}' THEN {r.min_rows}" for r in rules)} END"


def run_events(runs: DataFrame, rules: Sequence[RunRule], key: str = "asset_id") -> DataFrame:
    """Stitched runs of at least `min_rows` rows."""
    return sql(
        f"""
        SELECT {key}, rule, min(start_time) AS start_time, max(end_time) AS end_time,
               sum(n_rows) AS n_rows{_folded(rules)}
        FROM ({_stitched(key)}) WHERE breach
        GROUP BY {key}, rule, part, block
        HAVING sum(n_rows) >= {_enough(rules)}
        """,
        runs=runs,
    )


def sustained_events(
    df: DataFrame, rules: Sequence[RunRule], key: str = "asset_id", ts: str = "timestamp",
    tiebreak: Sequence[str] = (), chunk_hours: int = 24,
) -> DataFrame:
    """Runs of at least `min_rows` breaching rows per asset and rule.

    Returns key, rule, start_time, end_time, n_rows and one column per measure named by any rule.
    """
    return run_events(chunk_runs(df, rules, key, ts, tiebreak, chunk_hours), rules, key)


def merge_runs(runs: DataFrame, rules: Sequence[RunRule], chunk: int, key: str = "asset_id") -> DataFrame:
    """The runs of all chunks as those of one, numbered `chunk`; of the same form as `chunk_runs`.

    Only runs at either end can still grow; of the others those that are long enough remain.
    """
    bounds = f"PARTITION BY {key}, rule, part"
    ends = f"""
        SELECT *, part IS NULL AND chunk = min(chunk) OVER ({bounds}) AS at_first,
               part IS NULL AND chunk = max(chunk) OVER ({bounds}) AS at_last
        FROM ({_stitched(key)})"""
    whole = f"""
        SELECT {key}, rule, bool_or(breach) AS breach, bool_or(at_first AND run = 1) AS first,
               bool_or(at_last AND open_end) AS open_end, sum(n_rows) AS n_rows,
               min(start_time) AS start_time, max(end_time) AS end_time{_folded(rules)}
        FROM ({ends}) GROUP BY {key}, rule, part, block"""
    named = ", ".join([*measures(rules)[0], *measures(rules)[1]])
    return sql(
        f"""
        SELECT {key}, {chunk} AS chunk, rule, CASE WHEN first THEN 1L ELSE 2L END AS run, breach, open_end, n_rows,
               start_time, end_time{', ' + named if named else ''}
        FROM ({whole}) WHERE first OR (breach AND (open_end OR n_rows >= {_enough(rules)}))
        """,
        runs=runs,
    )


def no_marks(spark: SparkSession, rules: Sequence[RunRule], key: str = "asset_id") -> DataFrame:
    """The marks before the first period."""
    named = "".join(f", {m} double" for m in [*measures(rules)[0], *measures(rules)[1]])
    return spark.createDataFrame(
        [], f"{key} string, chunk int, rule string, run bigint, breach boolean, open_end boolean, n_rows bigint, "
            f"start_time timestamp_ntz, end_time timestamp_ntz{named}"
    )


def advance_runs(marks: DataFrame, period: DataFrame, rules: Sequence[RunRule], key: str = "asset_id") -> DataFrame:
    """One period's runs behind the marks of all earlier ones; `open_end` tells new marks from closed events.

    `marks` holds at most one open run per asset and rule. An asset without a row of a rule in the period
    keeps its mark. Closed runs are long enough to be events; a mark is one as soon as it is.
    """
    before = marks.selectExpr("* EXCEPT (chunk, run)", "0 AS chunk", "1L AS run")
    now = period.selectExpr("* EXCEPT (chunk)", "1 AS chunk")
    merged = merge_runs(before.unionByName(now), rules, 0, key)
    return merged.where(f"breach AND (open_end OR n_rows >= {_enough(rules)})")
