import datetime as dt
import io
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import coach
from tallyworks.plans.runner import DATASETS, Run, check_log
from tallyworks.sources import export, workbook
from tallyworks.sources.http import ApiError
from tallyworks.sources.lake import Lake

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(rows):
    """An .xlsx file: texts inline, days as numbers in a date style."""
    def cell(ref, v):
        if isinstance(v, dt.date):
            return f'<c r="{ref}" s="1"><v>{(v - dt.date(1899, 12, 30)).days}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'

    lines = [f'<row r="{i}">{"".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r) if v is not None)}</row>' for i, r in enumerate([coach.FIELDS, *rows], 1)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Betreuung" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><numFmts><numFmt numFmtId="170" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet {NS}><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


class Source:
    """The API as its client sees it: filters take the mark in."""

    def __init__(self):
        when = lambda i: f"2026-03-0{i}T08:00:00"
        self.down = set()
        self.data = {
            "/trainings": [{"training_id": "T01", "training_name": "Data Analyst", "track": "Data", "variant": "Vollzeit", "duration_weeks": 16, "list_price_eur": 9900, "is_active": True, "modules": [{"module_id": f"T01-M0{i}", "module_order": i, "module_name": "M", "estimated_hours": 8} for i in (1, 2)]}],
            "/participants": [{"participant_id": i, "first_name": f"First{i}", "last_name": f"Last{i}", "email": f"p{i}@example.com", "birth_date": "1990-01-01", "city": "Berlin", "federal_state": "Berlin", "funding_type": "selbstzahler", "acquisition_channel": "web", "created_at": when(i), "modified_at": when(i)} for i in (1, 2)],
            "/enrollments": [{"enrollment_id": i, "participant_id": i, "training_id": "T01", "cohort_start_date": "2026-02-02", "planned_end_date": "2026-12-01", "status": "aktiv", "status_changed_at": when(i), "created_at": when(1), "modified_at": when(i)} for i in (1, 2)],
            "/progress-events": [{"event_id": f"ev-{i}", "enrollment_id": i, "module_id": "T01-M01", "event_type": "module_completed", "event_time": f"2026-03-0{i}T10:00:00Z"} for i in (1, 2)],
            "/survey-responses": [{"response_id": i, "enrollment_id": i, "survey_type": "abschlussfeedback", "survey_week": None, "question_key": "nps", "answer_value": "9", "submitted_at": f"2026-03-0{i + 2}T10:00:00Z"} for i in (1, 2)],
        }

    def get(self, path):
        return {"data": self.data[path], "as_of": "2026-09-01"}

    def fetch_all(self, path, params, page_size):
        if path in self.down:
            raise ApiError("down")
        mark = next((d.mark for d in DATASETS.values() if d.path == path))
        found = [r for r in self.data[path] if all(r[mark] >= v for v in params.values())]
        return found, [1] * len(found)


def test_runs(spark, tmp_path):
    source, lake, file, out = Source(), Lake(spark, f"{tmp_path}/lake"), tmp_path / "b.xlsx", tmp_path / "out"
    rows = [("Last1, First1", "p1@example.com", "DA VZ", dt.date(2026, 2, 2), "Coach A", "rot", dt.date(2026, 8, 25), None), ("First2 Last2", None, "Data Analyst VZ", "02/2026", "Coach B", "grün", "14.06.26", "Notiz")]
    file.write_bytes(book(rows))
    go = lambda day, layer="all", **k: Run(spark, lake, day, **k).run(layer, source, str(file), str(out))
    status = lambda day: {r.dataset: (r.status, r.row_count) for r in lake.read("meta_extraction_log").where(f"snapshot_date = '{day}'").collect()}

    assert go("2026-08-30") == 0
    assert status("2026-08-30") == {n: ("LOADED", 1 if n == "trainings" else 2) for n in DATASETS}
    got = {r.excel_row_number: (r.match_status, r.match_method, r.matched_participant_id, r.matched_enrollment_id, r.ampel, r.last_contact_date, r.cohort_start_date) for r in lake.read("curated_coach_rows").collect()}
    assert got == {2: ("matched", "unique_email", "1", "1", "red", dt.date(2026, 8, 25), dt.date(2026, 2, 2)), 3: ("matched", "name_training", "2", "2", "green", dt.date(2026, 6, 14), dt.date(2026, 2, 1))}
    assert len(list(out.glob("*.csv"))) == 5 and (out / "results.md").read_text().count("\n## ") == 5
    assert "T01" in (out / "active_by_training.csv").read_text()

    # a rerun of the day replaces its rows; the next day brings nothing new
    assert go("2026-08-30", "raw") == 0 and lake.read("raw_participants").count() == 2
    assert go("2026-08-31", "raw") == 0
    assert set(status("2026-08-31").values()) == {("NO_CHANGES", 0)} and lake.days("raw_progress_events") == ["2026-08-30"]

    # changed and new rows come alone, and one of the same second as the mark too; a source that is down leaves the others
    people, events = source.data["/participants"], source.data["/progress-events"]
    people[0] = people[0] | {"city": "Köln", "modified_at": "2026-04-01T08:00:00"}
    people.append(people[1] | {"participant_id": 3, "modified_at": "2026-04-02T08:00:00"})
    events.append(events[1] | {"event_id": "ev-3"})
    source.down = {"/survey-responses"}
    before = (out / "results.md").stat().st_mtime_ns
    assert go("2026-09-01") == 2 and (out / "results.md").stat().st_mtime_ns == before
    assert {k: v for k, v in status("2026-09-01").items() if v[0] != "NO_CHANGES"} == {"participants": ("LOADED", 2), "progress_events": ("LOADED", 1), "survey_responses": ("FAILED", None)}
    day = {r.participant_id: (r.city_clean, r.quality_flags, r.duplicate_id_count) for r in lake.read_day("curated_participants", "2026-09-01").collect()}
    assert day == {"1": ("Köln", [], 1), "3": ("Berlin", ["normalized_email_collision"], 1)}
    late = Run(spark, lake, "2026-09-01")
    late.stage()
    context = late.models()
    assert context["participants"].count() == 3 and context["participants"].where("participant_id = '1'").first().city == "Köln"
    assert context["rpt_coach_unassigned_enrollments"].first().assigned_active_or_paused_enrollment_count == 2

    # a raw day that goes takes its curated day along; a shrunken full read is refused unless allowed
    del events[-1], people[1:]
    assert go("2026-09-01") == 2 and lake.days("curated_progress_events") == ["2026-08-30"]
    source.down = set()
    source.data["/enrollments"] = []
    assert go("2026-09-02", "raw", full=True) == 2 and status("2026-09-02")["enrollments"][0] == "FAILED"
    assert go("2026-09-02", "raw", full=True, allow_shrink=True) == 0
    runs = lake.read("meta_runs").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in runs} == {"SUCCESS": 4, "PARTIAL_SUCCESS": 3}
    assert Run(spark, Lake(spark, f"{tmp_path}/none"), "2026-09-02").run("reports", out=str(out)) == 1

    # a second build changes nothing, and one from scratch is the same; a day that is gone from the log is not read
    assert not [r for r in lake.read("meta_curation_log").collect() if (r.dataset, r.snapshot_date) == ("progress_events", "2026-09-01")]
    assert Run(spark, lake, "2026-09-02").run("verify") == 0
    assert lake.read("fct_progress_events").count() == 2 and lake.describe("stg_enrollments")[0] == ("enrollment_id", "string", True)
    tests = {(r.model, r.test): (r.severity, r.failures) for r in lake.read("meta_data_tests").where("snapshot_date = '2026-09-02'").collect()}
    assert len(tests) > 90 and tests["stg_enrollments", "keys as curated"] == ("error", 0) and not any(n for s, n in tests.values() if s == "error")
    # an error keeps the last build
    was = lake.files("fct_enrollments")
    stg = lake.read("stg_enrollments")
    lake.publish({"stg_enrollments": lake.stage("stg_enrollments", stg.unionByName(stg))}, whole=True)
    with pytest.raises(ValueError, match="stg_enrollments: enrollment_id unique"):
        Run(spark, lake, "2026-09-03").build()
    assert lake.files("fct_enrollments") == was


def test_log_rows(spark):
    row = {"snapshot_date": "2026-01-01", "dataset": "x", "run_id": "r", "status": "LOADED", "load_mode": "full", "records_fetched": 0, "row_count": 0}
    check_log("meta_extraction_log", row)
    check_log("meta_extraction_log", {"snapshot_date": "2026-01-01", "dataset": "x", "run_id": "r", "status": "FAILED", "error": "e"})
    for wrong in ({"row_count": None}, {"status": "DONE"}, {"status": "FAILED"}, {"dataset": None}):
        with pytest.raises(ValueError):
            check_log("meta_extraction_log", row | wrong)


def test_export_texts(tmp_path):
    values = [None, dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3), 0.5, 2.0, 1 / 3, Decimal("1.50"), ["a", "b"], True]
    assert [export.render(v) for v in values] == ["", "2026-01-02", "2026-01-02T03:00:00", "0.5", "2", "0.3333", "1.50", "a, b", "True"]
    assert export.markdown(["a", "b|c"], [["1", "x|y"]]) == "| a | b/c |\n|---|---|\n| 1 | x/y |"


def test_dates_in_a_sheet():
    got = workbook.read_sheet(book([("n", None, None, dt.date(2026, 2, 2), None, None, None, None)]), "Betreuung", list(coach.FIELDS))
    assert got[0]["Kohorte"] == "2026-02-02" and got[0]["_source_row_number"] == 2
    with pytest.raises(ValueError, match="no sheet"):
        workbook.read_sheet(book([]), "Other", list(coach.FIELDS))
