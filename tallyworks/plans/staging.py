"""Staging: one typed row per source record, kept up to date day by day.

A model reads the curated days that the curation log names. The first build, or a full one, reads them all; a later one reads
from the newest day that the model holds (or a given one), since a rerun may have replaced that day. Only the buckets that the batch has keys
in are written anew. The result is always that of a full build over the same days: the newest version of a key wins across
what is stored and the batch, and keys whose stored version came from a day that no longer says so are looked up in older days.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import dedupe_latest
from ..sources.contract import Contract, row_is_whole
from ..sources.lake import Lake
from . import curation

C = F.col
DAY = "snapshot_date"


def _kept(raw: str, clean: str) -> Column:
    """The source's text where no clean value could be read from it."""
    return F.when(C(clean).isNull(), C(raw))


def _lineage(zone: str | None) -> dict:
    zoned = {"source_timezone": ("string", F.lit(zone).cast("string"))} if zone else {}
    return zoned | {
        "source_as_of_date": ("date", F.try_to_date("_source_as_of", "yyyy-MM-dd")), "run_id": ("string!", C("_run_id")), "ingested_at": ("timestamp!", C("_ingested_at")),
        DAY: ("date!", C("_snapshot_date")), "payload_hash": "string!", "quality_flags": "array<string>!", "validation_status": "string!", "is_quarantined": "boolean!", "is_deleted": ("boolean!", F.lit(False)),
    }


def _local(name: str, utc: str) -> dict:
    """A CRM time: as delivered, as an instant, and its text where neither could be read."""
    return {name: ("timestamp_ntz", F.when(C(utc).isNotNull(), F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), C(utc).cast("timestamp_ntz")))), f"{name}_utc": ("timestamp", C(utc)), f"{name}_unparsed_raw": ("string", _kept(name, utc))}


@dataclass(frozen=True)
class Model:
    dataset: str
    keys: tuple[str, ...]
    contract: Contract
    #: the newest version comes first; payload_hash ends every order
    newest: tuple[str, ...] = ()

    def order(self) -> list[Column]:
        return [C(c).desc_nulls_last() for c in (*self.newest, "ingested_at", "run_id", "payload_hash")]

    def latest(self, df: DataFrame, *dealt: str) -> DataFrame:
        return dedupe_latest(df, [*self.keys], self.order(), dealt)


NAMES = ("stg_trainings", "stg_participants", "stg_enrollments", "stg_progress_events", "stg_survey_responses", "stg_coach_assignments")


@cache
def specs() -> dict[str, Model]:
    """Made at first use: expressions need a session."""
    return {
        "stg_trainings": Model("trainings", ("training_id",), Contract({
            "training_id": "string", "training_name": "string", "track": "string", "variant": ("string", C("variant_clean")), "duration_weeks": ("int", C("weeks")), "list_price_eur": ("decimal(12,2)", C("price_eur")),
            "is_active": ("boolean", C("active")), "has_consistent_modules": "boolean", "modules": curation.MODULES,
        } | _lineage(None)), ("source_as_of_date", DAY)),
        "stg_participants": Model("participants", ("participant_id",), Contract({
            "participant_id": "string", "canonical_participant_id": "string", "first_name": ("string", C("first_name_clean")), "last_name": ("string", C("last_name_clean")), "name_match_key": "string", "email": ("string", C("email_clean")), "is_email_valid": "boolean",
            "birth_date": ("date", C("birth")), "birth_date_unparsed_raw": ("string", _kept("birth_date", "birth")), "is_birth_date_valid": "boolean", "city": ("string", C("city_clean")), "federal_state": ("string", C("state")), "funding_type": ("string", C("funding")), "acquisition_channel": ("string", C("channel")),
        } | _local("created_at", "created_at_utc") | _local("modified_at", "modified_at_utc") | _lineage("Europe/Berlin")), ("modified_at_utc",)),
        "stg_enrollments": Model("enrollments", ("enrollment_id",), Contract({
            "enrollment_id": "string", "participant_id": "string", "training_id": "string", "cohort_start_date": ("date", C("cohort_start")), "cohort_start_date_unparsed_raw": ("string", _kept("cohort_start_date", "cohort_start")),
            "planned_end_date": ("date", C("planned_end")), "planned_end_date_unparsed_raw": ("string", _kept("planned_end_date", "planned_end")), "planned_duration_days": "int", "status": ("string", C("status_clean")), "is_status_valid": "boolean", "is_open_status": "boolean",
            "has_participant_reference": ("boolean", C("has_participant")), "has_training_reference": ("boolean", C("has_training")),
        } | _local("status_changed_at", "changed_at_utc") | _local("created_at", "created_at_utc") | _local("modified_at", "modified_at_utc") | _lineage("Europe/Berlin")), ("modified_at_utc",)),
        "stg_progress_events": Model("progress_events", ("event_id",), Contract({
            "event_id": "string", "enrollment_id": "string", "module_id": "string", "event_type": ("string", C("event_kind")), "is_event_type_valid": "boolean", "has_enrollment_reference": ("boolean", C("has_enrollment")), "has_module_reference": ("boolean", C("has_module")),
            "enrollment_training_id": ("string", C("enrolled_training")), "module_training_id": ("string", C("module_training")), "is_module_in_enrollment_training": ("boolean", C("is_module_in_training")), "is_event_before_cohort_start": ("boolean", C("is_before_start")),
            "event_at_utc": "timestamp", "event_at_unparsed_raw": ("string", _kept("event_time", "event_at_utc")),
        } | _lineage("UTC")), ("event_at_utc",)),
        "stg_survey_responses": Model("survey_responses", ("response_id",), Contract({
            "response_id": "string", "enrollment_id": "string", "survey_type": ("string", C("survey_kind")), "survey_week": ("int", C("week")), "question_key": ("string", C("question")), "answer_value": ("string", F.nullif(F.btrim("answer_value"), F.lit(""))), "answer_score": ("decimal(5,2)", C("score")), "answer_context": "string",
            "is_answer_missing": "boolean", "is_answer_valid": "boolean", "nps_category": "string", "is_question_valid_for_survey_type": ("boolean", C("is_question_valid")), "is_survey_week_valid": "boolean", "has_enrollment_reference": ("boolean", C("has_enrollment")),
            "submitted_at_utc": "timestamp", "submitted_at_unparsed_raw": ("string", _kept("submitted_at", "submitted_at_utc")),
        } | _lineage("UTC")), ("submitted_at_utc",)),
        "stg_coach_assignments": Model("coach_rows", ("coach_assignment_id", DAY), Contract({
            "coach_assignment_id": "string", "excel_row_number": "int", "coach": "string", "training_id": "string", "training_match_status": "string", "training_unmapped_raw": ("string", _kept("training_raw", "training_id")),
            "cohort_start_date": "date", "cohort_start_date_unparsed_raw": ("string", _kept("kohorte_raw", "cohort_start_date")), "ampel": "string", "ampel_status": "string", "ampel_unmapped_raw": ("string", F.when(C("ampel_status") == "unmapped", C("ampel_raw"))),
            "last_contact_date": "date", "last_contact_date_unparsed_raw": ("string", _kept("letzter_kontakt_raw", "last_contact_date")), "matched_participant_id": "string", "matched_enrollment_id": "string", "match_status": "string", "match_method": "string",
            "candidate_count": "bigint", "candidate_ids": "array<string>", "enrollment_candidate_count": "bigint", "enrollment_match_status": "string", "coach_assignment_business_key": "string", "business_key_duplicate_flag": ("boolean", C("is_business_key_duplicate")), "has_complete_business_key": "boolean",
            "completeness_status": ("string", F.when(C("is_incomplete"), "incomplete").otherwise("complete")), "is_incomplete": "boolean",
        } | _lineage(None)), ()),
    }


@cache
def modules_contract() -> Contract:
    return Contract({
        "training_id": "string", "module_id": "string", "module_order": "int", "module_name": "string", "estimated_hours": "int", "source_as_of_date": "date", "run_id": "string!", "ingested_at": "timestamp!",
        DAY: "date!", "quality_flags": "array<string>!", "validation_status": "string!", "is_quarantined": "boolean!", "is_deleted": "boolean!",
    })


def days(lake: Lake, dataset: str) -> list[str]:
    """The curated days that the log names. Days that it does not name are not read, and a day that is not there raises."""
    log = lake.read("meta_curation_log").where(C("dataset") == dataset).select(DAY).distinct() if "meta_curation_log" in lake.names() else None
    named = sorted(r[0] for r in log.collect()) if log is not None else []
    if not named:
        raise LookupError(f"the curation log names no day of {dataset}")
    return named


def typed(name: str, df: DataFrame) -> DataFrame:
    return specs()[name].contract.select(df)


def source(lake: Lake, name: str, named: list[str]) -> DataFrame:
    return typed(name, lake.read_days(f"curated_{specs()[name].dataset}", named))


def newest_day(lake: Lake, name: str) -> str | None:
    """The newest day that the model holds; null if there is no model yet or it has no row."""
    if name not in lake.names():
        return None
    day = lake.read(name).agg(F.max(DAY)).first()[0]
    return day.isoformat() if day else None


def refresh(lake: Lake, name: str, from_day: str | None = None, full: bool = False) -> dict[str, str | None]:
    """Stage the model's next version, for Lake.publish(). from_day reads from that day on, whatever the model holds."""
    model, named = specs()[name], days(lake, specs()[name].dataset)
    newest = None if full else newest_day(lake, name)
    if newest is None:
        return lake.merge(name, source(lake, name, named), [*model.keys], None, model.contract, pick=model.latest)
    start = from_day or newest
    # a literal: of the model's files only those with rows from that day on are read below, of curated days only these
    since = C(DAY) >= F.lit(start).cast("date")
    read = [d for d in named if d >= start]
    if len(read) == len(named) and lake.read(name).where(~since).isEmpty():
        # every row is read again
        return lake.merge(name, source(lake, name, read), [*model.keys], None, model.contract, pick=model.latest)
    stale = lake.read(name).where(since)
    batch = model.latest(source(lake, name, read)) if read else stale.limit(0)
    on = [*model.keys, "payload_hash", DAY]
    lost = stale.where(row_is_whole([*model.keys])).join(batch.select(*on), on, "left_anti").select(*model.keys).distinct()
    earlier = [d for d in named if d < start]
    if earlier and not lost.isEmpty():
        batch = model.latest(batch.unionByName(source(lake, name, earlier).join(lost, [*model.keys], "left_semi").select(batch.columns)))
    return lake.merge(name, batch, [*model.keys], lambda old, new: model.latest(old.where(~since).unionByName(new)), model.contract, touch=stale)


def training_modules(trainings: DataFrame) -> DataFrame:
    """One row per training and module, from stg_trainings; a training without modules has none. The catalog is small: every build makes all."""
    rest = ("source_as_of_date", "run_id", "ingested_at", DAY, "quality_flags", "validation_status", "is_quarantined", "is_deleted")
    return modules_contract().select(curation.modules(trainings).join(trainings.select("training_id", *rest), "training_id"))


def build(lake: Lake, from_day: str | None = None, full: bool = False) -> None:
    """Bring all models up to date, in one commit, and then the modules, which are read from the trainings."""
    paths: dict[str, str | None] = {}
    for name in NAMES:
        paths |= refresh(lake, name, from_day, full)
    lake.publish(paths)
    lake.commit({"stg_training_modules": training_modules(lake.read("stg_trainings"))}, {"stg_training_modules": modules_contract()})
