"""One audit over its inputs: what several outputs read is computed and stored once.

The ledger is read five times: profile, daily rollup, air-quality runs, after-hours baseline, power runs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from meterwatch.functions.sizing import stored_table
from meterwatch.operators import energy, profile
from meterwatch.plans import logs, star
from meterwatch.plans.logs import AuditInputs


class Audit:
    """Stored intermediates, logs and event fact of one audit, each derived on first use.

    `earlier` holds the events of former runs, whose ids go on.
    """

    def __init__(self, inputs: AuditInputs, earlier: DataFrame | None = None):
        self.inputs, self.earlier = inputs, earlier

    @cached_property
    def profile(self) -> DataFrame:
        a = self.inputs
        return stored_table(profile.grid_summary(profile.grid_profile(a.telemetry, a.params), a.params), "profile")

    @cached_property
    def days(self) -> DataFrame:
        return stored_table(logs.daily(self.inputs), "days")

    @cached_property
    def verdicts(self) -> DataFrame:
        return stored_table(energy.asset_verdicts(self.days, self.inputs.registry, self.inputs.params), "verdicts")

    @cached_property
    def facility(self) -> DataFrame:
        return stored_table(logs.facility_events(self.inputs, self.profile), "facility_events")

    @cached_property
    def energy(self) -> DataFrame:
        found = logs.energy_events(self.inputs, self.profile, self.days, self.verdicts)
        return stored_table(found, "energy_events")

    @cached_property
    def compliance(self) -> DataFrame:
        return stored_table(logs.compliance_events(self.inputs), "compliance_events")

    @cached_property
    def fact(self) -> DataFrame:
        """The event fact, which its numbering stores."""
        return star.fact_audit_events(self.facility, self.energy, self.compliance, self.inputs.params, self.earlier)

    def outcome_counts(self) -> DataFrame:
        return logs.outcome_counts(self.inputs, self.profile, self.days, self.verdicts)
