"""Audits that go on from period to period: what a period leaves behind is merged, its readings are not read again.

A period adds to the store, below one commit:

- `slots`: rows, energy, span and seen slots of the grid per asset, which add up to the profile (S01, S03),
- `hours`: moments of clean HVAC power per asset and hour, the baseline of S05,
- `days`: one row per asset and day (S07, S10),
- `chart`: the CUSUM chart's state per asset, from which the next period's chart resumes,
- `air_runs`, `power_runs`: runs that ended within it, and `air_open`, `power_open`: runs that may go on.

An audit over all periods reads these tables alone. It equals one run over all readings, but for one thing: the limits of S05
are those known when a period was added, so that what was published is not judged anew; with a given `baseline` it
equals that too. Periods begin and end at midnight and follow each other; adding the latest one again replaces it.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame

from meterwatch.config import AuditParams
from meterwatch.functions.sizing import run_scope, stored_table
from meterwatch.operators import energy, facility, profile
from meterwatch.operators.runs import RunRule, advance_runs, chunk_runs, merge_runs, no_marks, run_events
from meterwatch.plans import logs, pipeline
from meterwatch.plans.audit import Audit
from meterwatch.plans.logs import AuditInputs
from meterwatch.sources.store import Draft, Store

PERIOD = "start timestamp_ntz, end timestamp_ntz"


class History:
    """Periods of one policy over one store."""

    def __init__(self, store: Store, policy: AuditParams, baseline: DataFrame | None = None):
        self.store, self.policy, self.baseline = store, policy, baseline
        self.rules: dict[str, list[RunRule]] = {
            "air": facility.air_quality_rules(policy, ("S06", "S08")), "power": energy.power_rules(policy, ("S04", "S05")),
        }

    def add(self, a: AuditInputs) -> None:
        """Add the readings of `a`, those of its period, and commit what they leave behind."""
        start, end = self._checked(a.params)
        with run_scope(self.store.spark):
            self._add(a, start, end)

    def _add(self, a: AuditInputs, start: str, end: str) -> None:
        spark = self.store.spark
        draft = self.store.begin(start)
        draft.write(spark.sql(f"SELECT TIMESTAMP_NTZ'{start}' AS start, TIMESTAMP_NTZ'{end}' AS end"), "period")
        draft.write(profile.grid_profile(a.telemetry, a.params, self.store.read("slots", before=start)), "slots")
        draft.write(profile.hour_moments(a.telemetry), "hours")
        draft.write(logs.daily(a), "days")
        self._chart(draft, a.params)
        air = chunk_runs(a.telemetry, self.rules["air"], tiebreak=facility.READING_ORDER, chunk_hours=a.params.chunk_hours)
        self._advance(draft, "air", air)
        limits = self.baseline if self.baseline is not None else profile.baseline_of(
            profile.merge_moments(self._with_earlier(draft, "hours"), "asset_id", "hour"), a.params
        )
        self._advance(draft, "power", energy.power_runs(logs.enriched(a), a.params, baseline=limits, days=draft.read("days")))
        draft.commit()

    def _checked(self, p: AuditParams) -> tuple[str, str]:
        if p.period is None or any(not t.endswith("00:00:00") for t in p.period):
            raise ValueError("a period needs a start and an end at midnight")
        known = self.periods()
        last = next((e for s, e in reversed(known) if s < p.period[0]), p.period[0])
        if any(s > p.period[0] for s, _ in known) or last != p.period[0]:
            raise ValueError(f"{p.period[0]} does not follow the periods of the store")
        return p.period

    def periods(self) -> list[tuple[str, str]]:
        """Start and end of every period, in order."""
        table = self.store.read("period", PERIOD)
        return [] if table is None else sorted((str(r.start), str(r.end)) for r in table.collect())

    def _with_earlier(self, draft: Draft, name: str) -> DataFrame:
        now = draft.read(name)
        earlier = self.store.read(name, before=draft.period)
        return now if earlier is None else earlier.unionByName(now)

    def _advance(self, draft: Draft, kind: str, runs: DataFrame) -> None:
        rules = self.rules[kind]
        marks = self.store.as_of(f"{kind}_open", draft.period)
        marks = no_marks(self.store.spark, rules) if marks is None else marks
        done = stored_table(advance_runs(marks, merge_runs(runs, rules, 1), rules), f"{kind}_advanced")
        draft.write(done.where("NOT open_end"), f"{kind}_runs")
        draft.write(done.where("open_end"), f"{kind}_open")

    def _chart(self, draft: Draft, p: AuditParams) -> None:
        days = draft.read("days")
        before = self.store.as_of("chart", draft.period)
        before = profile.no_prefix(days) if before is None else before
        draft.write(profile.day_moments(days), "day_moments")
        basis = profile.day_basis(profile.merge_moments(self._with_earlier(draft, "day_moments"), "asset_id"), p)
        draft.write(profile.cusum_resumed(before, days, basis, p).select("asset_id", "date", "mu", "threshold", "cusum", "alarm"), "cusum")
        draft.write(profile.cusum_prefix(before, days), "chart")

    def runs(self, kind: str) -> DataFrame:
        """Finished events of all periods; a run that is still open counts as it stands."""
        closed = self.store.read(f"{kind}_runs").unionByName(self.store.as_of(f"{kind}_open"))
        # every row is a whole run of its own
        return run_events(closed.selectExpr("* EXCEPT (chunk, run, open_end)", "0 AS chunk", "2L AS run", "false AS open_end"), self.rules[kind])

    def params(self) -> AuditParams:
        known = self.periods()
        return self.policy.for_period(known[0][0], known[-1][1])

    def audit(self, a: AuditInputs, earlier: DataFrame | None = None) -> HistoryAudit:
        """The audit of all periods; of `a` the registry, exemptions and evidence count, not the readings."""
        return HistoryAudit(replace(a, params=self.params()), self, earlier)

    def publish(self, a: AuditInputs) -> None:
        """Publish all output tables over all periods under the latest one."""
        draft = self.store.begin(self.periods()[-1][0])
        with run_scope(self.store.spark):
            audit = self.audit(a, self.store.read("fact_audit_events"))
            pipeline.publish_staged(audit.inputs, draft, audit)


class HistoryAudit(Audit):
    """An audit whose profile, days and runs are merged from the store."""

    def __init__(self, inputs: AuditInputs, history: History, earlier: DataFrame | None = None):
        super().__init__(inputs, earlier)
        self.history = history

    @cached_property
    def profile(self) -> DataFrame:
        return stored_table(profile.grid_summary(self.history.store.read("slots"), self.inputs.params), "profile")

    @cached_property
    def days(self) -> DataFrame:
        return self.history.store.read("days")

    @cached_property
    def facility(self) -> DataFrame:
        return stored_table(logs.facility_events(self.inputs, self.profile, self.history.runs("air")), "facility_events")

    @cached_property
    def energy(self) -> DataFrame:
        found = logs.energy_events(self.inputs, self.profile, self.days, self.verdicts, self.history.runs("power"))
        return stored_table(found, "energy_events")
