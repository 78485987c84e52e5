"""Intermediate, mart and report models over curated tables.

A model is a function of a context; the runner builds what it needs once, in order of its dependencies. Inputs are the
staging models of plans/staging.py: enrollments, participants, trainings, modules, events, responses, assignments.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, numbers
from ..functions.categories import OPEN_STATUSES
from ..operators.rows import flag_present, progress, with_total

C = F.col
BEHIND = "-0.15"
MODELS: dict[str, Callable[[Context], DataFrame]] = {}


@dataclass
class Context:
    inputs: dict[str, DataFrame]
    reporting_date: str
    built: dict[str, DataFrame] = field(default_factory=dict)
    #: stores a model under its name and gives it back, so that what builds on it does not build it again
    store: Callable[[str, DataFrame], DataFrame] | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.inputs:
            return self.inputs[name]
        if name not in self.built:
            made = MODELS[name](self)
            self.built[name] = self.store(name, made) if self.store else made
        return self.built[name]

    @property
    def cutoff(self):
        return F.lit(self.reporting_date).cast("date")


def model(f):
    MODELS[f.__name__] = f
    return f


def good(df: DataFrame) -> DataFrame:
    return df.where(~C("is_quarantined") & ~C("is_deleted"))


def n(x=None, name="n"):
    return (F.count("*") if x is None else x).cast("bigint").alias(name)


@model
def int_active_enrollments(c):
    late = lambda x: F.coalesce(x, F.lit(False))
    return good(c["enrollments"]).where("status = 'aktiv'").withColumns({"reporting_date": c.cutoff, "changed_after": late(F.to_date("status_changed_at_utc") > c.cutoff), "past_end": late(C("planned_end_date") < c.cutoff), "starts_after": late(C("cohort_start_date") > c.cutoff)})


@model
def int_completed_enrollments(c):
    people = c["participants"].where(~C("is_deleted")).select(C("participant_id").alias("_p"), C("funding_type").alias("funding"))
    df = good(c["enrollments"]).where(C("planned_end_date") < c.cutoff).join(people, C("participant_id") == C("_p"), "left")
    done, gone = C("status") == "abgeschlossen", C("status").isin("abgebrochen", "storniert")
    return df.withColumns({"funding_type": F.coalesce("funding", F.lit("unknown")), "missing_participant": C("_p").isNull(), "completed": done, "abandoned": gone, "other": ~done & ~gone}).drop("_p", "funding")


@model
def int_enrollment_progress(c):
    own = good(c["enrollments"]).select("enrollment_id", "training_id", "status", "cohort_start_date", "planned_end_date")
    total = good(c["modules"]).groupBy("training_id").agg(n(F.count_distinct("module_id"), "total_module_count"))
    known = good(c["modules"]).select("training_id", "module_id").distinct().withColumn("_own", F.lit(True))
    events = good(c["events"]).where(F.to_date("event_at_utc") <= c.cutoff).select("enrollment_id", "module_id", "event_type", "event_at_utc")
    met = events.join(own.select("enrollment_id", "training_id"), "enrollment_id").join(known, ["training_id", "module_id"], "left")
    per = met.groupBy("enrollment_id").agg(n(F.count_distinct(F.when((C("event_type") == "module_completed") & C("_own"), C("module_id"))), "completed_module_count"), n(name="event_count"), F.min("event_at_utc").alias("first_event"), F.max("event_at_utc").alias("last_event"))
    out = own.join(total, "training_id", "left").join(per, "enrollment_id", "left").withColumns({k: F.coalesce(k, F.lit(0).cast("bigint")) for k in ("completed_module_count", "event_count")})
    return out.withColumn("completed_module_share", numbers.share(C("completed_module_count"), C("total_module_count")).cast("decimal(9,6)"))


@model
def int_enrollment_time_progress(c):
    out = progress(c["int_enrollment_progress"], "cohort_start_date", "planned_end_date", c.cutoff, C("status") == "aktiv")
    gap = C("completed_module_share") - C("time_share")
    # decimals throughout: 0.80 - 0.95 is not below -0.15 in doubles
    return out.withColumns({"progress_gap": gap, "is_behind_schedule": gap <= F.lit(BEHIND).cast("decimal(9,6)"), "reporting_date": c.cutoff})


@model
def int_feedback_nps(c):
    good_answers = good(c["responses"]).where((C("question_key") == "nps") & C("is_answer_valid") & C("answer_score").between(0, 10) & (C("answer_score") == F.round("answer_score")) & (F.to_date("submitted_at_utc") <= c.cutoff))
    df = good_answers.join(good(c["enrollments"]).select("enrollment_id", "training_id"), "enrollment_id").join(good(c["trainings"]).select("training_id"), "training_id")
    df = df.withColumns({"feedback_quarter": dates.quarter_start(C("submitted_at_utc")), "g": numbers.nps_group(C("answer_score"))})
    out = df.groupBy("training_id", "feedback_quarter").agg(n(name="valid_response_count"), *[n(F.count_if(C("g") == k), f"{k}_count") for k in ("promoter", "passive", "detractor")])
    return out.withColumns({"feedback_quarter_label": dates.quarter_label(C("feedback_quarter")), "nps": numbers.share(100 * (C("promoter_count") - C("detractor_count")), C("valid_response_count"))})


@model
def int_coach_assignment_matches(c):
    e = good(c["enrollments"]).select(C("enrollment_id").alias("_e"), C("status").alias("enrollment_status"))
    a = c["assignments"].withColumn("_claimed", C("matched_enrollment_id")).drop("matched_enrollment_id")
    a = a.join(e, (C("match_status") == "matched") & (C("_claimed") == C("_e")), "left")
    a = a.withColumns({"matched_enrollment_id": C("_e"), "is_confident": C("_e").isNotNull(), "is_open": F.coalesce(C("enrollment_status").isin(*OPEN_STATUSES), F.lit(False))})
    a = a.crossJoin(F.broadcast(c["assignments"].agg(F.max("snapshot_date").alias("coach_snapshot_as_of_date")))).withColumn("is_latest", C("snapshot_date") == C("coach_snapshot_as_of_date"))
    # rows without a match claim nothing; their own id spreads them over the tasks
    w = Window.partitionBy("snapshot_date", "matched_enrollment_id", F.when(C("matched_enrollment_id").isNull(), C("coach_assignment_id")))
    ok = C("is_confident")
    a = a.withColumns({"claims": F.coalesce(F.count_if(ok).over(w), F.lit(0)), "lo": F.min(F.when(ok, C("coach"))).over(w), "hi": F.max(F.when(ok, C("coach"))).over(w)})
    a = a.withColumns({"has_conflict": F.coalesce(C("lo") != C("hi"), F.lit(False)), "is_red": F.coalesce(ok & C("is_open") & (C("ampel") == "red"), F.lit(False)), "snapshot_mismatch_flag": C("coach_snapshot_as_of_date") != c.cutoff})
    return a.drop("_e", "_claimed", "lo", "hi")


#: columns of marts; what carries personal data or free text is in none of them
QUALITY = ("validation_status", "quality_flags", "ingested_at")
DIM_TRAININGS = ("training_id", "training_name", "track", "variant", "duration_weeks", "list_price_eur", "is_active", "source_as_of_date", "has_consistent_modules", *QUALITY)
DIM_MODULES = ("training_id", "module_id", "module_order", "module_name", "estimated_hours", "source_as_of_date", "validation_status", "ingested_at")
DIM_PARTICIPANTS = ("participant_id", "canonical_participant_id", "has_duplicate_identity", "first_name", "last_name", "city", "federal_state", "funding_type", "acquisition_channel", "is_email_valid", "is_birth_date_valid", "created_at_utc", "modified_at_utc", *QUALITY)
FCT_ENROLLMENTS = (
    "enrollment_id", "participant_id", "training_id", "cohort_start_date", "cohort_start_date_unparsed_raw", "planned_end_date", "planned_end_date_unparsed_raw", "planned_duration_days", "status", "is_open_status",
    "status_changed_at_utc", "created_at_utc", "modified_at_utc", "funding_type", "has_participant_reference", "has_training_reference", "is_participant_in_dim", *QUALITY,
)
FCT_EVENTS = ("event_id", "enrollment_id", "module_id", "event_type", "event_at_utc", "has_enrollment_reference", "has_module_reference", "is_module_in_enrollment_training", "is_event_before_cohort_start", *QUALITY)
FCT_RESPONSES = (
    "response_id", "enrollment_id", "training_id", "survey_type", "survey_week", "question_key", "answer_score", "answer_context", "nps_category", "submitted_at_utc", "is_answer_missing", "is_answer_valid",
    "is_question_valid_for_survey_type", "is_survey_week_valid", "has_enrollment_reference", "is_enrollment_in_fact", *QUALITY,
)
FCT_ASSIGNMENTS = (
    "coach_assignment_id", "snapshot_date", "coach", "training_id", "training_unmapped_raw", "cohort_start_date", "matched_participant_id", "matched_enrollment_id", "match_status", "match_method", "is_confident", "enrollment_status", "is_open",
    "ampel", "is_red", "last_contact_date", "business_key_duplicate_flag", "has_conflict", "is_latest", "coach_snapshot_as_of_date", "snapshot_mismatch_flag", *QUALITY,
)


@model
def dim_trainings(c):
    return good(c["trainings"]).select(*DIM_TRAININGS)


@model
def dim_training_modules(c):
    return good(c["modules"]).select(*DIM_MODULES)


@model
def dim_participants(c):
    """Without e-mail address and birth date."""
    return good(c["participants"]).withColumn("has_duplicate_identity", C("canonical_participant_id") != C("participant_id")).select(*DIM_PARTICIPANTS)


@model
def fct_enrollments(c):
    people = c["dim_participants"].select(C("participant_id").alias("_p"), "funding_type")
    out = good(c["enrollments"]).join(people, C("participant_id") == C("_p"), "left")
    return out.withColumns({"funding_type": F.coalesce("funding_type", F.lit("unknown")), "is_participant_in_dim": C("_p").isNotNull()}).select(*FCT_ENROLLMENTS)


@model
def fct_enrollment_progress(c):
    df = c["int_enrollment_time_progress"].withColumn("is_active", C("status") == "aktiv")
    names = {"planned_duration_days": "planned_days", "time_progress_share": "time_share", "time_progress_quality_flag": "time_flag", "progress_event_count": "event_count", "last_event_at_utc": "last_event"}
    shown = ("enrollment_id", "training_id", "status", "is_active", "completed_module_count", "total_module_count", "completed_module_share", "elapsed_days", "planned_duration_days", "time_progress_share", "time_progress_quality_flag", "progress_gap", "is_behind_schedule", "progress_event_count", "last_event_at_utc", "reporting_date")
    return df.select(*[C(names.get(x, x)).alias(x) for x in shown])


@model
def fct_progress_events(c):
    return good(c["events"]).select(*FCT_EVENTS)


@model
def fct_survey_responses(c):
    """One row per response; free text is not passed on."""
    e = good(c["enrollments"]).select(C("enrollment_id").alias("_e"), "training_id")
    return good(c["responses"]).join(e, C("enrollment_id") == C("_e"), "left").withColumn("is_enrollment_in_fact", C("_e").isNotNull()).select(*FCT_RESPONSES)


@model
def fct_coach_assignments(c):
    """What the workbook calls a training that no spelling maps to is fetched again from staging, by the row's key."""
    raw = c["assignments"].select(C("coach_assignment_id").alias("_id"), C("snapshot_date").alias("_day"), "training_unmapped_raw")
    same = (C("coach_assignment_id") == C("_id")) & (C("snapshot_date") == C("_day"))
    return c["int_coach_assignment_matches"].drop("training_unmapped_raw").join(raw, same).select(*FCT_ASSIGNMENTS)


def training_names(c: Context) -> DataFrame:
    return c["dim_trainings"].select("training_id", "training_name")


@model
def rpt_active_enrollments_by_training(c):
    per = c["int_active_enrollments"].groupBy("training_id").agg(n(name="active_enrollment_count"), n(F.count_if("changed_after"), "status_changed_after_cutoff_count"), n(F.count_if("past_end"), "past_planned_end_count"), n(F.count_if("starts_after"), "cohort_start_after_cutoff_count"))
    counts = [x for x in per.columns if x != "training_id"]
    out = training_names(c).join(per, "training_id", "left").withColumns({x: F.coalesce(x, F.lit(0).cast("bigint")) for x in counts})
    flag = lambda x, name: F.when(C(x) > 0, name)
    return out.withColumns({"reporting_date": c.cutoff, "data_quality_flags": F.array_compact(F.array(F.lit("current_status_used_no_status_history"), flag("status_changed_after_cutoff_count", "status_changed_after_cutoff"), flag("past_planned_end_count", "active_past_planned_end"), flag("cohort_start_after_cutoff_count", "cohort_start_after_cutoff")))})


@model
def rpt_completion_abandonment_by_training_funding(c):
    per = c["int_completed_enrollments"].groupBy("training_id", "funding_type").agg(n(name="eligible_enrollment_count"), n(F.count_if("completed"), "completed_count"), n(F.count_if("abandoned"), "abandoned_count"), n(F.count_if("other"), "other_status_count"), n(F.count_if("missing_participant"), "missing_participant_count"))
    names = {"completed_share": "completed_count", "abandoned_share": "abandoned_count", "other_status_share": "other_status_count"}
    out = per.withColumns({k: numbers.share(C(v), C("eligible_enrollment_count")) for k, v in names.items()})
    return out.join(training_names(c), "training_id", "left").withColumn("reporting_date", c.cutoff)


@model
def rpt_progress_vs_time(c):
    df = c["fct_enrollment_progress"].where("is_active").join(training_names(c), "training_id", "left")
    return df.select("enrollment_id", "training_id", "training_name", "completed_module_count", "total_module_count", "completed_module_share", "elapsed_days", "planned_duration_days", "time_progress_share", "time_progress_quality_flag", "progress_gap", "is_behind_schedule", "reporting_date")


@model
def rpt_progress_vs_time_summary(c):
    ok = C("is_behind_schedule").isNotNull()
    aggs = [F.max("training_name").alias("training_name"), n(name="active_enrollment_count"), n(F.count_if(ok), "evaluable_active_enrollment_count"), n(F.count_if(F.coalesce("is_behind_schedule", F.lit(False))), "behind_schedule_count"), F.avg("completed_module_share").cast("double").alias("average_completed_module_share"), F.avg("time_progress_share").cast("double").alias("average_time_progress_share")]
    out = with_total(c["rpt_progress_vs_time"], "training_id", aggs)
    return out.withColumns({"training_name": F.when(C("is_total") == 0, C("training_name")).otherwise("ALL"), "behind_schedule_share": numbers.share(C("behind_schedule_count"), C("evaluable_active_enrollment_count")), "reporting_date": c.cutoff})


@model
def rpt_nps_by_training_quarter(c):
    return c["int_feedback_nps"].join(training_names(c), "training_id").withColumn("reporting_date", c.cutoff)


@model
def rpt_coach_utilization(c):
    a = c["fct_coach_assignments"].where("is_latest")
    # one row per coach and enrollment first: distinct counts without expanding rows
    per = a.groupBy("coach", "matched_enrollment_id").agg(F.bool_or(C("is_confident") & C("is_open")).alias("open"), F.bool_or("is_red").alias("red"), n(name="k"), n(F.count_if(C("match_status") == "unmatched"), "un"), n(F.count_if(C("match_status") == "ambiguous"), "am"), F.max("snapshot_date").alias("day"))
    return per.groupBy("coach").agg(n(F.count_if(C("open") & C("matched_enrollment_id").isNotNull()), "active_or_paused_enrollment_count"), n(F.count_if("red"), "red_enrollment_count"), n(F.sum("un"), "unmatched_enrollment_count"), n(F.sum("am"), "ambiguous_assignment_count"), n(F.sum("k"), "workbook_row_count"), F.max("day").alias("coach_snapshot_date")).withColumns({"reporting_date": c.cutoff, "snapshot_mismatch_flag": F.coalesce(C("coach_snapshot_date") != c.cutoff, F.lit(True))})


@model
def rpt_coach_unassigned_enrollments(c):
    latest = c["fct_coach_assignments"].where("is_latest")
    e = flag_present(good(c["enrollments"]).where(C("status").isin(*OPEN_STATUSES)), latest.where("is_confident"), {"enrollment_id": "matched_enrollment_id"}, "assigned")
    left = e.agg(n(name="active_or_paused_enrollment_count"), n(F.count_if("assigned"), "assigned_active_or_paused_enrollment_count"), n(F.count_if(~C("assigned")), "unassigned_active_or_paused_enrollment_count"))
    right = latest.agg(n(F.count_if(C("match_status") == "ambiguous"), "ambiguous_workbook_row_count"), n(F.count_if(C("match_status") == "unmatched"), "unmatched_workbook_row_count"), F.max("snapshot_date").alias("coach_snapshot_date"))
    return left.crossJoin(right).withColumns({"reporting_date": c.cutoff, "snapshot_mismatch_flag": F.coalesce(C("coach_snapshot_date") != c.cutoff, F.lit(True))})
