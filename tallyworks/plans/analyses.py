"""The five questions as final tables: their columns, rounded, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .models import Context

C = F.col
UNASSIGNED = "(unassigned active/paused enrollments)"


def _rounded(df: DataFrame, columns: tuple[str, ...], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def active(c: Context) -> DataFrame:
    return c["rpt_active_enrollments_by_training"].select("training_id", "training_name", "active_enrollment_count", "reporting_date", "data_quality_flags").orderBy("training_id")


def completion(c: Context) -> DataFrame:
    df = c["rpt_completion_abandonment_by_training_funding"].select("training_id", "training_name", "funding_type", "eligible_enrollment_count", "completed_count", "abandoned_count", "other_status_count", "completed_share", "abandoned_share")
    return _rounded(df, ("completed_share", "abandoned_share")).orderBy(C("training_id").asc_nulls_last(), "funding_type")


def progress(c: Context) -> DataFrame:
    shares = ("behind_schedule_share", "average_completed_module_share", "average_time_progress_share")
    df = c["rpt_progress_vs_time_summary"].select("training_id", "training_name", "active_enrollment_count", "evaluable_active_enrollment_count", "behind_schedule_count", *shares, "is_total")
    return _rounded(df, shares).orderBy("is_total", C("training_id").asc_nulls_last()).drop("is_total")


def satisfaction(c: Context) -> DataFrame:
    df = c["rpt_nps_by_training_quarter"].orderBy("training_id", "feedback_quarter")
    return _rounded(df.select("training_id", "training_name", "feedback_quarter_label", "valid_response_count", "promoter_count", "passive_count", "detractor_count", "nps"), ("nps",), 1)


def coaches(c: Context) -> DataFrame:
    """Per coach, and a row for the enrollments without one; the columns are matched by name."""
    columns = ("coach", "active_or_paused_enrollment_count", "red_enrollment_count", "unmatched_enrollment_count", "ambiguous_assignment_count", "reporting_date", "coach_snapshot_date", "snapshot_mismatch_flag")
    left = c["rpt_coach_unassigned_enrollments"].select(
        C("coach_snapshot_date"), F.lit(UNASSIGNED).alias("coach"), C("unassigned_active_or_paused_enrollment_count").alias("active_or_paused_enrollment_count"),
        C("unmatched_workbook_row_count").alias("unmatched_enrollment_count"), C("ambiguous_workbook_row_count").alias("ambiguous_assignment_count"), "reporting_date", "snapshot_mismatch_flag",
    )
    return c["rpt_coach_utilization"].select(*columns).unionByName(left, allowMissingColumns=True).orderBy(C("coach").asc_nulls_last())


#: title and table by name, in the order of export
ANALYSES = {
    "active_by_training": ("Active enrollments of each training", active),
    "completion_by_training_funding": ("Completed and abandoned, by training and funding", completion),
    "progress_by_training": ("Progress against elapsed time", progress),
    "nps_by_training_quarter": ("Net promoter score by quarter", satisfaction),
    "coach_load": ("Coaches and enrollments without one", coaches),
}
