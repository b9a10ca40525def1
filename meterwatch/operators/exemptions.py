"""Interval anti-join of events against approved exemptions (BLK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.config import EXEMPTABLE
from meterwatch.functions.text import day_chunk, sql


def exempt_slices(exemptions: DataFrame, spans: DataFrame, chunk_days: int = 30) -> DataFrame:
    """Exemptions cut at calendar chunks, one row per distinct start within a chunk.

    An approval only counts from the day of its asset's first reading to the last one (`first_ts` and `last_ts` of
    `spans`, one row per asset), so that one without an end adds no more chunks than the asset has.

    Overlapping approvals that cover a chunk's beginning fall together, and events meet only those of their own chunk.
    """
    return sql(
        f"""
        SELECT asset_id AS ex_asset, scenario_id AS ex_scenario, ex_chunk,
               greatest(start_time, CAST(date_from_unix_date(ex_chunk * {chunk_days}) AS TIMESTAMP_NTZ)) AS ex_start,
               max(end_time) AS ex_end
        FROM (SELECT *, explode(sequence({day_chunk('greatest(start_time, lo)', chunk_days)},
                                         {day_chunk('least(end_time, hi)', chunk_days)})) AS ex_chunk
              FROM {{exemptions}}
              JOIN (SELECT asset_id, CAST(to_date(first_ts) AS TIMESTAMP_NTZ) AS lo, last_ts AS hi FROM {{spans}}) USING (asset_id)
              WHERE scenario_id IN {EXEMPTABLE} AND start_time <= end_time AND start_time <= hi AND end_time >= lo)
        GROUP BY 1, 2, 3, 4
        """,
        exemptions=exemptions, spans=spans,
    )


def drop_exempt(
    events: DataFrame, exemptions: DataFrame, spans: DataFrame, at: str = "start_time", chunk_days: int = 30
) -> DataFrame:
    """Events whose time lies in no approved interval (closed) of their asset and scenario.

    `spans` holds first_ts and last_ts of every asset, between which its events lie. Slices and events of an asset,
    scenario and chunk are put in one order, slices first at equal times, and an event is exempt if the latest end
    of the slices so far reaches it: one sorted pass, however many approvals and events meet.
    """
    key = ("asset_id", "scenario", "chunk")
    in_order = f"PARTITION BY {', '.join(key)} ORDER BY at, is_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    together = f"""
        SELECT ex_asset AS asset_id, ex_scenario AS scenario, ex_chunk AS chunk, ex_start AS at, false AS is_event, ex_end, NULL AS event
        FROM {{slices}}
        UNION ALL
        SELECT asset_id, scenario, {day_chunk(at, chunk_days)}, CAST({at} AS TIMESTAMP_NTZ), true, NULL, struct(e.*) FROM {{events}} e"""
    return sql(
        f"""
        SELECT event.* FROM (SELECT event, is_event, at, max(ex_end) OVER ({in_order}) AS covered FROM ({together}))
        WHERE is_event AND NOT coalesce(covered >= at, false)
        """,
        events=events, slices=exempt_slices(exemptions, spans, chunk_days),
    )
