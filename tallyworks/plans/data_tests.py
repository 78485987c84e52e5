"""The data tests of staging, marts and reports: what must hold of each row, of keys and of references, and how bad it is if not.

A rule is a condition in SQL that holds of the rows that fail. All rules on the rows of a model are counted in one scan of it; keys are
counted by one aggregation, references by one anti-join. An error fails a run, a warning is told.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import categories as K
from ..operators.rows import key_differences

#: the names under which staging models go into models.Context
STAGES = {"stg_trainings": "trainings", "stg_training_modules": "modules", "stg_participants": "participants", "stg_enrollments": "enrollments", "stg_progress_events": "events", "stg_survey_responses": "responses", "stg_coach_assignments": "assignments"}
LIVE = "not is_quarantined and not is_deleted"
MATCHES = ("matched", "ambiguous", "unmatched")
RESULT = "model string, test string, severity string, failures bigint"


@dataclass(frozen=True)
class Rule:
    model: str
    name: str
    #: of rows: SQL that is true where the rule fails
    fails: str | None = None
    #: of keys: the columns that name a row
    keys: tuple[str, ...] = ()
    #: of references: column, model and column referred to
    refers: tuple[str, str, str] | None = None
    severity: str = "error"
    where: str = "true"


def there(model: str, *columns: str, where: str = "true") -> list[Rule]:
    return [Rule(model, f"{c} not null", f"{c} is null", where=where) for c in columns]


def unique(model: str, *keys: str) -> list[Rule]:
    return [Rule(model, f"{', '.join(keys)} unique", keys=keys)]


def accepted(model: str, column: str, values: tuple[str, ...]) -> list[Rule]:
    listed = ", ".join(f"'{v}'" for v in values)
    return [Rule(model, f"{column} accepted", f"{column} not in ({listed})", severity="warn")]


def between(model: str, low: float, high: float | None, *columns: str) -> list[Rule]:
    return [Rule(model, f"{c} in range", f"{c} < {low}" + (f" or {c} > {high}" if high is not None else "")) for c in columns]


def refers(model: str, column: str, to: str, parent: str | None = None, severity: str = "error", where: str = "true") -> list[Rule]:
    return [Rule(model, f"{column} in {to}", refers=(column, to, parent or column), severity=severity, where=where)]


def instants(model: str, low: str, high: str, *columns: str) -> list[Rule]:
    return [Rule(model, f"{c} in time", f"{c} < timestamp '{low}' or {c} >= timestamp '{high}'") for c in columns]


def rules(low: str = "2020-01-01", high: str = "2026-09-02") -> list[Rule]:
    """low and high bound CRM instants."""
    unknown = lambda values: (*values, "unknown")
    t, m, p, e, v, r, a = STAGES
    noted = {"severity": "warn", "where": LIVE}
    claimed = {"severity": "warn", "where": "matched_enrollment_id is not null"}
    shares = ("completed_share", "abandoned_share", "other_status_share")
    return [
        *there(t, "training_id", "training_name", "duration_weeks", "is_active"), *unique(t, "training_id"), *accepted(t, "variant", unknown(K.VARIANTS)),
        *unique(m, "training_id", "module_id"), *there(m, "training_id", "module_id", "module_order"), *refers(m, "training_id", t), *between(m, 1, None, "module_order"), *between(m, 0, None, "estimated_hours"),
        *there(p, "participant_id"), *unique(p, "participant_id"), *accepted(p, "funding_type", unknown(K.FUNDING)), *instants(p, low, high, "created_at_utc", "modified_at_utc"), Rule(p, "created_at_utc not after modified_at_utc", "created_at_utc > modified_at_utc", severity="warn"),
        *there(e, "enrollment_id"), *unique(e, "enrollment_id"), *refers(e, "participant_id", p, **noted), *refers(e, "training_id", t, **noted), *accepted(e, "status", unknown(K.STATUSES)),
        *there(v, "event_id"), *unique(v, "event_id"), *refers(v, "enrollment_id", e, **noted), *accepted(v, "event_type", unknown(K.EVENTS)), *there(v, "event_at_utc", where="not is_quarantined"),
        *there(r, "response_id"), *unique(r, "response_id"), *refers(r, "enrollment_id", e, **noted), *accepted(r, "survey_type", unknown(dict.fromkeys(K.QUESTIONS.values()))), *accepted(r, "question_key", unknown(K.QUESTIONS)),
        *unique(a, "coach_assignment_id", "snapshot_date"), *there(a, "coach_assignment_id", "snapshot_date"), *accepted(a, "training_match_status", MATCHES), *accepted(a, "ampel", ("green", "yellow", "red", "unknown")), *refers(a, "matched_enrollment_id", e, "enrollment_id", **claimed), *accepted(a, "match_status", MATCHES),
        *there("dim_trainings", "training_id"), *unique("dim_trainings", "training_id"),
        *unique("dim_training_modules", "training_id", "module_id"), *there("dim_training_modules", "training_id", "module_id"), *refers("dim_training_modules", "training_id", "dim_trainings"), *between("dim_training_modules", 1, None, "module_order"), *between("dim_training_modules", 0, None, "estimated_hours"),
        *there("dim_participants", "participant_id"), *unique("dim_participants", "participant_id"), *accepted("dim_participants", "funding_type", unknown(K.FUNDING)),
        *there("fct_enrollments", "enrollment_id"), *unique("fct_enrollments", "enrollment_id"), *refers("fct_enrollments", "participant_id", "dim_participants", severity="warn"), *refers("fct_enrollments", "training_id", "dim_trainings", severity="warn"),
        *there("fct_progress_events", "event_id"), *unique("fct_progress_events", "event_id"), *refers("fct_progress_events", "enrollment_id", "fct_enrollments", severity="warn"),
        *there("fct_enrollment_progress", "enrollment_id"), *unique("fct_enrollment_progress", "enrollment_id"), *refers("fct_enrollment_progress", "enrollment_id", "fct_enrollments", severity="warn"), *between("fct_enrollment_progress", 0, 1, "completed_module_share", "time_progress_share"),
        *there("fct_survey_responses", "response_id"), *unique("fct_survey_responses", "response_id"), *refers("fct_survey_responses", "enrollment_id", "fct_enrollments", severity="warn"),
        *unique("fct_coach_assignments", "coach_assignment_id", "snapshot_date"), *there("fct_coach_assignments", "coach_assignment_id", "snapshot_date"), *refers("fct_coach_assignments", "matched_enrollment_id", "fct_enrollments", "enrollment_id", **claimed), *accepted("fct_coach_assignments", "match_status", MATCHES),
        *there("int_enrollment_progress", "enrollment_id"), *unique("int_enrollment_progress", "enrollment_id"), *between("int_enrollment_progress", 0, None, "total_module_count", "completed_module_count"), *between("int_enrollment_progress", 0, 1, "completed_module_share"),
        *there("int_feedback_nps", "training_id", "feedback_quarter"), *unique("int_feedback_nps", "training_id", "feedback_quarter"), *between("int_feedback_nps", -100, 100, "nps"),
        *there("rpt_active_enrollments_by_training", "training_id"), *unique("rpt_active_enrollments_by_training", "training_id"), *refers("rpt_active_enrollments_by_training", "training_id", "dim_trainings"), *between("rpt_active_enrollments_by_training", 0, None, "active_enrollment_count"),
        *unique("rpt_completion_abandonment_by_training_funding", "training_id", "funding_type"), *there("rpt_completion_abandonment_by_training_funding", "training_id", "funding_type"), *between("rpt_completion_abandonment_by_training_funding", 1, None, "eligible_enrollment_count"), *between("rpt_completion_abandonment_by_training_funding", 0, 1, *shares),
        *there("rpt_progress_vs_time", "enrollment_id"), *unique("rpt_progress_vs_time", "enrollment_id"), *between("rpt_progress_vs_time", 0, 1, "completed_module_share", "time_progress_share"),
        *unique("rpt_progress_vs_time_summary", "training_id", "reporting_date"), *between("rpt_progress_vs_time_summary", 0, 1, "behind_schedule_share", "average_completed_module_share", "average_time_progress_share"),
        *unique("rpt_nps_by_training_quarter", "training_id", "feedback_quarter"), *there("rpt_nps_by_training_quarter", "training_id", "feedback_quarter"), *refers("rpt_nps_by_training_quarter", "training_id", "dim_trainings"), *between("rpt_nps_by_training_quarter", -100, 100, "nps"),
        *there("rpt_coach_utilization", "coach"), *unique("rpt_coach_utilization", "coach"),
    ]


def _row_rules(df: DataFrame, of_rows: list[Rule]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.expr(f"({r.fails}) and ({r.where})")).alias(f"f{i}") for i, r in enumerate(of_rows)])
    each = F.array(*[F.struct(F.lit(r.model).alias("model"), F.lit(r.name).alias("test"), F.lit(r.severity).alias("severity"), F.col(f"f{i}").alias("failures")) for i, r in enumerate(of_rows)])
    return counts.select(F.inline(each))


def _told(r: Rule, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count("*").alias("failures")).select(F.lit(r.model).alias("model"), F.lit(r.name).alias("test"), F.lit(r.severity).alias("severity"), "failures")


def evaluate(of: Callable[[str], DataFrame], every: list[Rule]) -> DataFrame:
    """(model, test, severity, failures) of each rule; failures are rows, or keys that several rows have. A null reference is none."""
    parts = []
    for model in dict.fromkeys(r.model for r in every):
        mine, df = [r for r in every if r.model == model], of(model)
        if of_rows := [r for r in mine if r.fails]:
            parts.append(_row_rules(df, of_rows))
        for r in mine:
            if r.keys:
                whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in r.keys])
                parts.append(_told(r, df.where(whole & F.expr(r.where)).groupBy(*r.keys).count().where("count > 1")))
            elif r.refers:
                column, to, parent = r.refers
                known = of(to).select(F.col(parent).alias("_parent")).distinct()
                parts.append(_told(r, df.where(F.col(column).isNotNull() & F.expr(r.where)).join(known, F.col(column) == F.col("_parent"), "left_anti")))
    return reduce(DataFrame.unionByName, parts)


def parity(model: str, curated: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of curated days and of staging are the same, null keys included."""
    return _told(Rule(model, "keys as curated"), key_differences(curated, staged, keys))
