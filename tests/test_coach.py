import datetime as dt
from decimal import Decimal

import pytest

from tallyworks.functions import trainings
from tallyworks.plans import coach, curation


def test_training_spellings(spark):
    cases = {"DA VZ": ("T01", "matched"), "  Data  Analyst ": (None, "ambiguous"), "KI & ML Grundlagen": ("T07", "matched"), "KI/ML-Grundlagen": ("T07", "matched"), "Python für Data Analytics (bb)": ("T06", "matched"), "Python f. DA": ("T06", "matched"), "Kochen": (None, "unmatched"), "n/a": (None, "missing"), "KI und Machine Learning Grundlagen": ("T07", "matched")}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    table = trainings.spellings(spark)
    got = {r.t: (r.mapped.training_id, r.mapped.status) for r in trainings.map_training(df, df.t, table).collect()}
    assert got == cases | {None: (None, "missing")}


def test_spellings_from_a_file(spark, tmp_path, monkeypatch):
    def write(*rows):
        (tmp_path / "s.csv").write_text("spelling,training_ids\n" + "\n".join(rows) + "\n", encoding="utf-8")
        return trainings.spellings(spark, str(tmp_path / "s.csv"))

    good = write("Neue Schulung,T01", "neue  schulung, T01 ", "Über & Unter,T02|T03")
    assert sorted((r.key, r.ids) for r in good.collect()) == [("neue schulung", ["T01"]), ("ueber und unter", ["T02", "T03"])]
    df = spark.createDataFrame([("NEUE Schulung",), ("über und unter",), ("DA VZ",)], "t string")
    want = [("NEUE Schulung", "T01", "matched"), ("über und unter", None, "ambiguous"), ("DA VZ", None, "unmatched")]
    assert [(r.t, r.m.training_id, r.m.status) for r in trainings.map_training(df, df.t, good, "m").collect()] == want
    monkeypatch.setattr(trainings, "BROADCAST", 1)
    assert "Broadcast" not in trainings.map_training(df, df.t, good, "m")._jdf.queryExecution().optimizedPlan().toString()
    for rows, why in ((("a,T01", "A,T02"), "different ids"), (("a,T09",), "ids that are none"), (("---,T01",), "without a spelling"), (("a,",), "ids that are none"), (("a,|",), "ids that are none")):
        with pytest.raises(ValueError, match=why):
            write(*rows)


ROW = "`Teilnehmer*in` string, `E-Mail` string, Training string, Kohorte string, Coach string, Ampel string, `Letzter Kontakt` string, Notizen string, _source_row_number int"


@pytest.fixture(scope="module")
def known(spark):
    p = [(str(i), f, n, e, None, None, None, None, "2026-03-01T08:00:00") for i, f, n, e in ((1, "First1", "Last1", "p1@example.com"), (2, "First2", "Last2", "p2@example.com"), (3, "Ann", "Twin", "twin@x.de"), (4, "Bea", "Twin", "twin@x.de"), (5, "Eva", "Same", "e5@x.de"), (6, "Eva", "Same", "e6@x.de"))]
    people = curation.participants(spark.createDataFrame(p, "participant_id string, first_name string, last_name string, email string, birth_date string, city string, federal_state string, funding_type string, modified_at string"), "2026-08-31")
    trainings = spark.createDataFrame([(f"T0{i}",) for i in range(1, 9)], "training_id string")
    e = [("1", "1", "T01", "2026-02-02"), ("2", "2", "T01", "2026-02-02"), ("3", "3", "T03", "2026-02-02"), ("4", "4", "T03", "2026-02-02"), ("5", "5", "T05", "2026-02-02"), ("6", "6", "T05", "2026-05-04"), ("7", "6", "T05", "2026-09-07"), ("8", "1", "T06", "2026-02-02"), ("9", "1", "T06", "2026-03-02")]
    rows = [(*r, "2026-12-01", "aktiv", "2026-03-01T08:00:00", "2026-01-01T08:00:00", "2026-03-01T08:00:00") for r in e]
    enrolled = curation.enrollments(spark.createDataFrame(rows, "enrollment_id string, participant_id string, training_id string, cohort_start_date string, planned_end_date string, status string, status_changed_at string, created_at string, modified_at string"), people, trainings, "2026-08-31")
    return people, enrolled


def test_coach_rows(spark, known):
    raw = [
        ("Last1, First1", "p1@example.com", "DA VZ", "2026-02-02", "Coach A", "rot", "2026-08-25", None, 2),
        ("First2 Last2", None, "Data Analyst VZ", "02/2026", "Coach B", "grün", "14.06.26", " Notiz ", 3),
        ("Twin, Ann", "twin@x.de", "DS VZ", "02.02.2026", "Coach A", "g", None, None, 4),
        ("Eva Same", None, "DE VZ", "2026-02-02", "Coach A", "lila", "x", None, 5),
        ("Eva Same", None, "DE VZ", None, "Coach A", None, None, None, 6),
        ("Eva Same", None, "Data Scientist", "soon", None, "y", None, None, 7),
        ("Nobody", None, "Kochen", None, None, None, None, None, 8),
        ("Last1, First1", "P1@example.com", "Python", "2026-07-06", "Coach A", "red", None, None, 9),
        ("x", "p2@example.com", "DA VZ", "2026-02-02", "Coach A", "red", None, None, 10),
        ("y", "p2@example.com", "DA VZ", "2026-02-02", "Coach A", "red", None, None, 11),
        (None,) * 8 + (12,),
    ]
    df = coach.assignments(spark.createDataFrame(raw, ROW), *known, "liste.xlsx", "2026-08-31")
    got = {r.excel_row_number: r for r in df.collect()}
    assert len(got) == len(raw) == df.select("coach_assignment_id").distinct().count()
    want = {
        2: ("matched", "unique_email", "1", "1", 1, 1, "matched"), 3: ("matched", "name_training", "2", "2", 1, 1, "matched"), 4: ("matched", "name_training_cohort", "3", "3", 1, 1, "matched"),
        5: ("matched", "name_training_cohort", "5", "5", 1, 1, "matched"), 6: ("ambiguous", "ambiguous_candidates", None, None, 3, 3, "ambiguous"), 7: ("ambiguous", "ambiguous_candidates", None, None, 2, 0, "unmatched"),
        8: ("unmatched", "no_match", None, None, 0, 0, "unmatched"), 9: ("matched", "unique_email", "1", None, 1, 2, "ambiguous"),
        10: ("ambiguous", "ambiguous_candidates", None, None, 2, 0, "unmatched"), 11: ("ambiguous", "ambiguous_candidates", None, None, 2, 0, "unmatched"), 12: ("unmatched", "no_match", None, None, 0, 0, "unmatched"),
    }
    assert {k: (r.match_status, r.match_method, r.matched_participant_id, r.matched_enrollment_id, r.candidate_count, r.enrollment_candidate_count, r.enrollment_match_status) for k, r in got.items()} == want
    assert got[2].quality_flags == [] and got[2].ampel == "red" and got[3].last_contact_date == dt.date(2026, 6, 14) and got[3].notizen == "Notiz" and got[3].cohort_start_date == dt.date(2026, 2, 1)
    assert got[5].quality_flags == ["missing_email", "invalid_ampel", "invalid_last_contact_date", "incomplete_row"] and got[5].is_quarantined
    assert "ambiguous_training" in got[7].quality_flags and "invalid_cohort_date" in got[7].quality_flags and got[7].coach == "unknown"
    assert got[6].candidate_ids == ["5", "6", "7"] and got[7].candidate_ids == ["5", "6"] and got[8].candidate_ids == got[2].candidate_ids == []
    assert "duplicate_business_key" in got[10].quality_flags and got[10].email_assignment_count == 2 and "ambiguous_enrollment_match" in got[9].quality_flags
    assert coach.assignments(spark.createDataFrame([], ROW), *known, "f", "2026-08-31").count() == 0


def test_catalog(spark):
    m = lambda *ids: [(i, n + 1, f"Module {i}", 8) for n, i in enumerate(ids)]
    raw = spark.createDataFrame([("t01", " Data  Analyst", "Data", "Vollzeit", "16", "9.900,00", "true", m("T01-M01", "T01-M02")), ("T02", None, None, "quer", "1,5", "x", "maybe", m("T01-M01")), ("T03", "DS", "Data", None, None, None, None, None), (None, "?", "?", "teilzeit", "4", "1", "ja", [])], "training_id string, training_name string, track string, variant string, duration_weeks string, list_price_eur string, is_active string, modules array<struct<module_id string, module_order int, module_name string, estimated_hours int>>")
    df = curation.trainings(raw)
    got = {r.training_id: r for r in df.collect()}
    assert got["T01"].quality_flags == [] and got["T01"].price_eur == Decimal("9900.00") and got["T01"].weeks == 16 and got["T01"].active
    assert got["T02"].quality_flags == ["invalid_variant", "invalid_duration_weeks", "invalid_list_price_eur", "invalid_is_active", "inconsistent_training_modules"] and got["T02"].is_variant_valid is False
    assert got["T03"].quality_flags == ["missing_variant", "missing_is_active", "inconsistent_training_modules"] and got["T03"].is_variant_valid is None
    assert got[None].is_quarantined
    assert sorted((r.training_id, r.module_id) for r in curation.modules(df).collect()) == [("T01", "T01-M01"), ("T01", "T01-M02"), ("T02", "T01-M01")]
