"""What must hold of the built models; each assertion gives the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks
from .models import Context, good

C = F.col
REPORTS = ("rpt_active_enrollments_by_training", "rpt_completion_abandonment_by_training_funding", "rpt_progress_vs_time", "rpt_progress_vs_time_summary", "rpt_nps_by_training_quarter", "rpt_coach_utilization", "rpt_coach_unassigned_enrollments")
#: a fact and the staging input that it must have as many rows as, good ones only where True
FACTS = {"fct_enrollments": ("enrollments", True), "fct_progress_events": ("events", True), "fct_survey_responses": ("responses", True), "fct_coach_assignments": ("assignments", False), "fct_enrollment_progress": ("enrollments", True)}


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _repeated(c: Context, names: tuple[str, ...], keys: list[str]) -> DataFrame:
    return _all([checks.unique_combination(c[name], keys).select(F.lit(name).alias("model"), F.concat_ws(", ", *keys).alias("row")) for name in names])


def _says(name: str, broken: DataFrame, row: str) -> DataFrame:
    return broken.select(F.lit(name).alias("model"), C(row).cast("string").alias("row"))


def _row_counts(c: Context) -> DataFrame:
    out = []
    for fact, (source, only_good) in FACTS.items():
        rows = good(c[source]) if only_good else c[source]
        both = c[fact].agg(F.count("*").alias("a")).crossJoin(rows.agg(F.count("*").alias("b")))
        out.append(both.where("a <> b").select(F.lit(fact).alias("model"), F.concat_ws(" for ", "a", "b").alias("row")))
    return _all(out)


def assertions(c: Context) -> dict[str, DataFrame]:
    """(model, row) of what breaks each assertion."""
    q2, nps, use, left = c["rpt_completion_abandonment_by_training_funding"], c["rpt_nps_by_training_quarter"], c["rpt_coach_utilization"], c["rpt_coach_unassigned_enrollments"]
    shares = ("completed_share", "abandoned_share", "other_status_share")
    odd_shares = reduce(lambda a, b: a | b, [checks.not_between(s, 0, 1) for s in shares[:2]])
    assigned = use.agg(F.sum("active_or_paused_enrollment_count").alias("per_coach")).crossJoin(left)
    dates = [c[r].agg(F.count_if(~C("reporting_date").eqNullSafe(c.cutoff)).alias("n")).where("n > 0").select(F.lit(r).alias("model"), C("n").cast("string").alias("row")) for r in REPORTS]
    return {
        "coaches together have the assigned enrollments": _says("rpt_coach_utilization", assigned.where("per_coach < assigned_active_or_paused_enrollment_count"), "per_coach"),
        "completed, abandoned and others add up": _says("rpt_completion_abandonment_by_training_funding", q2.where((C("completed_count") + C("abandoned_count") + C("other_status_count") != C("eligible_enrollment_count")) | odd_shares | (F.abs(sum(C(s) for s in shares) - 1) > 1e-9)), "training_id"),
        "one row an enrollment": _repeated(c, ("fct_enrollments", "fct_enrollment_progress", "rpt_progress_vs_time", "int_enrollment_progress"), ["enrollment_id"]),
        "one row a training and quarter": _repeated(c, ("rpt_nps_by_training_quarter", "int_feedback_nps"), ["training_id", "feedback_quarter"]),
        "facts have their sources' rows": _row_counts(c),
        "promoters, passives and detractors add up": _says("rpt_nps_by_training_quarter", nps.where((C("promoter_count") + C("passive_count") + C("detractor_count") != C("valid_response_count")) | C("nps").isNull() | checks.not_between("nps", -100, 100) | (F.abs(C("nps") - 100.0 * (C("promoter_count") - C("detractor_count")) / C("valid_response_count")) > 1e-9)), "training_id"),
        "no more modules completed than there are": _says("int_enrollment_progress", c["int_enrollment_progress"].where(checks.exceeds("completed_module_count", "total_module_count")), "enrollment_id"),
        "parts do not exceed their wholes": _all([
            _says("rpt_coach_utilization", use.where(checks.exceeds("red_enrollment_count", "active_or_paused_enrollment_count") | checks.exceeds("unmatched_enrollment_count", "workbook_row_count")), "coach"),
            _says("rpt_coach_unassigned_enrollments", left.where(C("assigned_active_or_paused_enrollment_count") + C("unassigned_active_or_paused_enrollment_count") != C("active_or_paused_enrollment_count")), "reporting_date"),
        ]),
        "reports are as of the cutoff": _all(dates),
        "one row a training and date": _repeated(c, ("rpt_active_enrollments_by_training", "rpt_progress_vs_time_summary"), ["training_id", "reporting_date"]),
        "unmatched rows have no enrollment": _says("fct_coach_assignments", c["fct_coach_assignments"].where(C("match_status").isin("ambiguous", "unmatched") & (C("matched_enrollment_id").isNotNull() | C("is_confident"))), "coach_assignment_id"),
    }


def broken(c: Context) -> dict[str, int]:
    """The number of rows that break each assertion that does not hold, from one job."""
    every = _all([df.select(F.lit(name).alias("name"), "model", "row") for name, df in assertions(c).items()])
    return {r[0]: r[1] for r in every.groupBy("name").count().collect()}
