import datetime as dt
import io
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyworks.operators import match, rows
from tallyworks.plans import curation, data_tests, models, staging
from tallyworks.sources import extract, http, workbook
from tallyworks.sources.lake import Lake
from tallyworks.streaming.mirror import mirror


def curated(spark):
    people = curation.participants(spark.createDataFrame([("1", "anna", "WEBER", " A@x.de", "1990-01-01", "köln", "hessen", "Selbstzahler", "2026-03-01T08:00:00"), ("2", "b", "c", "a@x.de", "not-a-date", None, None, None, "2026-03-01T08:00:00")], "participant_id string, first_name string, last_name string, email string, birth_date string, city string, federal_state string, funding_type string, modified_at string"), "2026-08-31")
    trainings = spark.createDataFrame([("T01", "Data", False), ("T02", "Web", False)], "training_id string, training_name string, is_quarantined boolean")
    modules = spark.createDataFrame([("T01", f"M{i}") for i in range(5)] + [("T02", "W1")], "training_id string, module_id string")
    raw = [("1", "1", "t01", "2026-02-02", "2026-12-01", "aktiv"), ("2", "9", "T01", "2026-01-01", "2026-06-01", "abgeschlossen"), ("3", "1", "T02", "2026-01-01", "2026-03-01", "Aktiv"), ("4", "1", "T01", "2026-05-01", "2026-04-01", "aktiv"), (None, "1", "T01", "2026-01-01", "2026-02-01", "abgebrochen")]
    e = spark.createDataFrame([(*r, "2026-03-01T08:00:00", "2026-01-01T08:00:00", "2026-03-01T08:00:00") for r in raw], "enrollment_id string, participant_id string, training_id string, cohort_start_date string, planned_end_date string, status string, status_changed_at string, created_at string, modified_at string")
    enrolled = curation.enrollments(e, people, trainings, "2026-08-31")
    ev = [(f"e{i}", "1", f"m{i}", "module_completed", "2026-03-01T10:00:00Z") for i in range(4)] + [("x1", "1", "W1", "module_completed", "2026-03-01T10:00:00Z"), ("x2", "1", "M4", "module_completed", "2026-09-01T00:30:00Z"), ("x2", "1", "M4", "module_completed", "2026-09-01T00:30:00Z"), ("x3", "7", "QQ", "quiz_passed", "2026-01-01T00:00:00Z")]
    events = curation.progress_events(spark.createDataFrame(ev, "event_id string, enrollment_id string, module_id string, event_type string, event_time string"), enrolled, modules)
    s = [("1", "1", "abschlussfeedback", None, "nps", "9"), ("2", "1", "abschlussfeedback", None, "nps", "6/10"), ("3", "1", "abschlussfeedback", None, "nps", "eleven"), ("4", "1", "wochenfeedback", "1", "tempo", "7"), ("5", "1", "wochenfeedback", "1", "freitext", "fine")]
    answers = curation.survey_responses(spark.createDataFrame([(*r, "2026-03-03T10:00:00Z") for r in s], "response_id string, enrollment_id string, survey_type string, survey_week string, question_key string, answer_value string, submitted_at string"), enrolled)
    day = dt.date(2026, 8, 31)
    coach = spark.createDataFrame([("a", day, "Coach A", "matched", "1", "red"), ("b", day, "Coach B", "matched", "1", "green"), ("c", day, "Coach A", "ambiguous", None, None), ("d", day, "Coach A", "matched", "99", "red")], "coach_assignment_id string, snapshot_date date, coach string, match_status string, enrollment_id string, ampel string")
    return {"participants": people, "trainings": trainings, "modules": modules, "enrollments": enrolled, "events": events, "responses": answers, "assignments": coach}


STAGES = {into: name for name, into in data_tests.STAGES.items()}


def staged(name, df):
    """Curated rows as staging has them; what these few rows lack is null."""
    contract = staging.modules_contract() if name == "modules" else staging.specs()[STAGES[name]].contract
    lineage = {"_run_id": F.lit("r"), "_ingested_at": F.lit("2026-08-31").cast("timestamp"), "_snapshot_date": F.lit("2026-08-31").cast("date"), "_source_as_of": F.lit(None).cast("string"), "is_quarantined": F.lit(False)}
    df = df.withColumns({k: v for k, v in lineage.items() if k not in df.columns})

    def column(n, kind):
        try:
            return df.select(contract.read[n].cast(kind).alias(n)).columns and contract.read[n].cast(kind).alias(n)
        except AnalysisException:
            return F.lit(False if n == "is_deleted" else None).cast(kind).alias(n)

    return df.select(*[column(n, kind) for n, kind in contract.types.items()])


def test_curation_and_models(spark):
    raw = curated(spark)
    c = models.Context({n: staged(n, df.withColumnRenamed("enrollment_id", "matched_enrollment_id") if n == "assignments" else df) for n, df in raw.items()}, "2026-08-31")
    flags = {r.enrollment_id: (r.quality_flags, r.validation_status) for r in c["enrollments"].collect()}
    assert flags["1"] == (["training_id_normalization_applied"], "valid") and flags["2"] == (["missing_participant_reference"], "valid")
    assert flags["3"] == (["active_past_planned_end"], "valid") and flags["4"] == (["planned_end_before_start", "active_past_planned_end"], "valid") and flags[None][0] == ["missing_source_id"]
    assert {r.participant_id: r.quality_flags for r in c["participants"].collect()} == {"1": ["email_normalization_applied", "normalized_email_collision", "text_whitespace_normalized"], "2": ["normalized_email_collision", "invalid_birth_date", "missing_city", "missing_federal_state", "missing_funding_type"]}
    assert {r.canonical_participant_id for r in c["participants"].collect()} == {"1"}
    ev = {r.event_id: r.quality_flags for r in c["events"].collect()}
    assert ev["x1"] == ["module_not_in_enrollment_training"] and ev["x2"] == ["duplicate_source_id", "exact_duplicate_source_payload"] and ev["x3"] == ["missing_enrollment_reference", "missing_module_reference"]
    an = {r.response_id: (r.answer_score, r.is_answer_valid) for r in c["responses"].collect()}
    assert an == {"1": (Decimal("9.00"), True), "2": (Decimal("6.00"), True), "3": (None, False), "4": (Decimal("7.00"), False), "5": (None, None)}
    p = {r.enrollment_id: r for r in c["rpt_progress_vs_time"].collect()}
    assert p["1"].completed_module_share == Decimal("0.800000") and p["1"].completed_module_count == 4 and p["3"].time_progress_quality_flag == "past_planned_end" and p["3"].is_behind_schedule
    total = c["rpt_progress_vs_time_summary"].where("is_total = 1").first()
    assert total.training_id == "ALL" and total.active_enrollment_count == 3 and total.behind_schedule_count == 1
    q1 = {r.training_id: r for r in c["rpt_active_enrollments_by_training"].collect()}
    assert q1["T01"].active_enrollment_count == 2 and q1["T02"].data_quality_flags == ["current_status_used_no_status_history", "active_past_planned_end"]
    q2 = c["rpt_completion_abandonment_by_training_funding"].collect()
    assert sorted((r.training_id, r.funding_type, r.completed_count, r.missing_participant_count) for r in q2) == [("T01", "selbstzahler", 0, 0), ("T01", "unknown", 1, 1), ("T02", "selbstzahler", 0, 0)]
    assert [(r.nps, r.feedback_quarter_label) for r in c["rpt_nps_by_training_quarter"].collect()] == [(0.0, "2026-Q1")]
    u = {r.coach: r for r in c["rpt_coach_utilization"].collect()}
    assert (u["Coach A"].active_or_paused_enrollment_count, u["Coach A"].red_enrollment_count, u["Coach A"].ambiguous_assignment_count, u["Coach A"].workbook_row_count) == (1, 1, 1, 3)
    r = c["rpt_coach_unassigned_enrollments"].first()
    assert (r.active_or_paused_enrollment_count, r.assigned_active_or_paused_enrollment_count, r.unassigned_active_or_paused_enrollment_count) == (3, 1, 2) and not r.snapshot_mismatch_flag
    assert all(x.has_conflict for x in c["fct_coach_assignments"].where("is_confident").collect())
    for name in models.MODELS:
        assert c[name].count() >= 0


def test_gap_of_exactly_the_threshold_is_behind(spark):
    gap = F.lit("0.80").cast("decimal(9,6)") - F.lit("0.95").cast("decimal(9,6)")
    assert spark.range(1).select(gap <= F.lit(models.BEHIND).cast("decimal(9,6)")).first()[0] and not 0.80 - 0.95 <= -0.15


def test_ladder_and_demotion(spark):
    a = spark.createDataFrame([(1, "x@y", "n1", "T1"), (2, None, "n2", "T1"), (3, None, "n3", "T1"), (4, None, "n9", "T1"), (5, None, None, None)], "row int, email string, name string, training string")
    k = spark.createDataFrame([(10, "x@y", "n7", "T1"), (20, "b@y", "n2", "T1"), (21, "c@y", "n2", "T2"), (30, "d@y", "n3", "T1"), (31, "e@y", "n3", "T1")], "id int, email string, name string, training string")
    got = match.ladder(a, k, "row", "id", [match.Rung("unique_email", ["email"]), match.Rung("name_training", ["name", "training"])])
    assert {r.row: (r.status, r.method, r.matched_id) for r in got.collect()} == {1: ("matched", "unique_email", 10), 2: ("matched", "name_training", 20), 3: ("ambiguous", None, None), 4: ("unmatched", None, None), 5: ("unmatched", None, None)}
    same = got.withColumns({"key": F.lit("k"), "complete": F.col("row") <= 2})
    assert {r.row: r.status for r in match.demote_shared(same, "key", "complete").collect()} == {1: "ambiguous", 2: "ambiguous", 3: "ambiguous", 4: "unmatched", 5: "unmatched"}


class Api:
    def __init__(self, total, grow=False):
        self.records, self.grow, self.calls, self.fails = [{"id": i} for i in range(total)], grow, 0, 1

    def __call__(self, method, url, headers, body):
        self.calls += 1
        if method == "POST":
            return 200, {}, b'{"access_token": "t", "expires_in": 3600}'
        if self.fails:
            self.fails -= 1
            return 503, {"Retry-After": "0"}, b""
        args = dict(p.split("=") for p in url.split("?")[1].split("&"))
        at, size = int(args.get("page_token", 0)), int(args["page_size"])
        data = self.records[at : at + size]
        nxt = at + size if at + size < len(self.records) else None
        return 200, {}, json.dumps({"data": data, "pagination": {"returned": len(data), "total_count": len(self.records) + (at if self.grow else 0), "next_token": nxt and str(nxt)}}).encode()


def test_api_client():
    for total in (0, 1, 2, 40, 499, 500, 501, 1000, 1200):
        got, pages = http.Client("http://a", "u", "s", Api(total), sleep=lambda _: None).fetch_all("/x")
        assert len(got) == len(pages) == total
    with pytest.raises(http.ApiError, match="changed"):
        http.Client("http://a", "u", "s", Api(1200, grow=True), sleep=lambda _: None).fetch_all("/x")
    with pytest.raises(http.ApiError, match="6 attempts"):
        http.Client("http://a", "u", "s", lambda *a: (503, {}, b""), sleep=lambda _: None).get("/x")


def test_workbook_and_load_rules():
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1">{cell("A1", " Coach ")}{cell("B1", "Ampel")}</row><row r="2">{cell("A2", "A")}{cell("C2", "x")}</row><row r="3"></row><row r="4">{cell("B4", "rot")}</row></sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Betreuung" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", sheet)
    assert workbook.read_sheet(out.getvalue(), "Betreuung", ["Coach", "Ampel"]) == [{"Coach": "A", "Ampel": None, "unnamed_column_3": "x", "_source_row_number": 2}, {"Coach": None, "Ampel": "rot", "_source_row_number": 4}]
    with pytest.raises(ValueError, match="headers"):
        workbook.read_sheet(out.getvalue(), "Betreuung", ["Coach"])
    with pytest.raises(ValueError, match="missing"):
        extract.check_contract([{"a": 1}], ["a", "b"])
    extract.check_contract([{"a": 1}, {"b": 1}], ["a", "b"])
    assert extract.newest(["2026-01-02T00:00:00", "x", None, "2026-01-10T00:00:00Z"]) == "2026-01-10T00:00:00Z"
    assert extract.newest(["2026-01-02T01:00:00+02:00", " 2026-01-02T00:30:00z", 7]) == " 2026-01-02T00:30:00z"
    assert extract.newest(["2026-01-02T00:30:00", "2026-01-02T03:00:00+02:00", "2026-01-02T01:00:00Z"]) == "2026-01-02T03:00:00+02:00"
    log = [{"dataset": "d", "snapshot_date": s, "status": "LOADED", "watermark": w} for s, w in (("2026-01-01", "2026-01-01"), ("2026-01-02", "2026-01-05"))]
    assert extract.watermark(log, "d", "2026-01-02") == "2026-01-01"
    extract.check_shrink(10, 5)
    with pytest.raises(ValueError):
        extract.check_shrink(10, 4)
    assert [extract.to_text(v) for v in (True, 1, [1], "x", None)] == ["true", "1", "[1]", "x", None]


def test_lake_merge_and_mirror(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    day = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    lake.replace_snapshot("raw", "2026-01-01", day((1, "a")))
    lake.replace_snapshot("raw", "2026-01-02", day((2, "b")))
    lake.replace_snapshot("raw", "2026-01-02", day((2, "c"), (3, "d")))
    assert sorted((r.id, r.v) for r in lake.read("raw").collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert lake.days("raw") == ["2026-01-01", "2026-01-02"] and lake.read_day("raw", "2026-01-02").count() == 2
    lake.replace_snapshot("raw", "2026-01-02", None)
    assert lake.read("raw").count() == 1 and lake.names() == ["raw"]
    with pytest.raises(KeyError):
        lake.read("other")
    real, lake.versions = lake.versions, lambda: real()[:-1]  # as a writer sees it that began before the last commit
    with pytest.raises(RuntimeError, match="another writer"):
        lake.replace_snapshot("raw", "2026-01-03", day((9, "z")))
    lake.versions = real
    assert lake.days("raw") == ["2026-01-01"]
    lake.upsert("t", day((1, "x"), (2, "y")), ["id"])
    lake.upsert("t", day((2, "z")), ["id"])
    assert sorted((r.id, r.v) for r in lake.read("t").collect()) == [(1, "x"), (2, "z")]
    assert lake.vacuum() > 0 and lake.vacuum() == 0 and lake.read("raw").count() == 1
    old, new = day((1, "v2"), (2, "v1")), day((1, "v1"), (2, "v3"))
    assert {r.id: r.v for r in rows.merge_newest(old, new, ["id"], [F.col("v").desc()]).collect()} == {1: "v2", 2: "v3"}
    kids = spark.createDataFrame([("T1", "a"), ("T2", "b")], "training_id string, m string")
    assert [r.m for r in rows.replace_children(kids, kids.limit(0), kids.where("training_id = 'T1'"), "training_id").collect()] == ["b"]
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "c")], "id int, v string")
    assert rows.dedupe_latest(nulls, ["id"], [F.col("v").desc()]).count() == 3
    day((1, "p"), (1, "q"), (5, "r")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, v string").parquet(f"{tmp_path}/in")
    mirror(stream, lake, "t", ["id"], ["v"], f"{tmp_path}/cp").awaitTermination()
    assert sorted((r.id, r.v) for r in lake.read("t").collect()) == [(1, "x"), (2, "z"), (5, "r")]
