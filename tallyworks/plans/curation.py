"""Typing and standardizing source rows: bad values are flagged, no row is dropped."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import categories as K
from ..functions import dates, numbers, text
from ..functions.ids import payload_hash
from ..operators.rows import dedupe_latest, flag_present

C = F.col
MODULES = "array<struct<module_id:string,module_order:int,module_name:string,estimated_hours:int>>"


class Issue(NamedTuple):
    when: Column
    rule: str
    severity: str


def issue(when: Column, rule: str, severity: str = "error") -> Issue:
    return Issue(when, rule, severity)


def counted(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """df with payload_hash and the numbers of rows of the same id and of the same id and payload; rows without an id count as single.

    One shuffle deals the rows out as they come, before anything is derived from them. The hash is taken after it.
    """
    # rows without an id all count 1; what they hold spreads them over the tasks
    df = df.withColumn("_apart", F.when(C(key).isNull(), F.xxhash64(*fields))).repartition(key, "_apart")
    df = df.withColumn("payload_hash", payload_hash(df, fields))
    number = lambda *more: F.when(C(key).isNull(), 1).otherwise(F.count("*").over(Window.partitionBy(key, "_apart", *more)))
    return df.withColumn("duplicate_id_count", number()).withColumn("duplicate_payload_count", number("payload_hash")).drop("_apart")


def finish(df: DataFrame, key: str, issues: list[Issue]) -> DataFrame:
    """quality_flags, validation_status and is_quarantined of what counted() gave; a missing id is an error."""
    issues = [issue(C(key).isNull(), "missing_source_id"), *issues]
    # all conditions as one number, so that none is computed again for each use
    bits = [F.when(x.when, F.lit(1 << n).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for n, x in enumerate(issues)]
    out = df.withColumn("_found", reduce(lambda a, b: a.bitwiseOR(b), bits))
    has = lambda numbers: C("_found").bitwiseAND(F.lit(sum(1 << n for n in numbers)).cast("bigint")) != 0
    of = lambda severity: has([n for n, x in enumerate(issues) if x.severity == severity])
    rules = [F.when(C("duplicate_id_count") > 1, "duplicate_source_id"), F.when(C("duplicate_payload_count") > 1, "exact_duplicate_source_payload"), *[F.when(has([n]), x.rule) for n, x in enumerate(issues)]]
    status = F.when(of("error"), "quarantined").when(of("review"), "review").otherwise("valid")
    named = F.array_except(F.array(*rules), F.array(F.lit(None).cast("string")))  # each once, in this order
    return out.withColumns({"quality_flags": named, "validation_status": status, "is_quarantined": of("error")}).drop("_found")


def own_fields(raw: DataFrame) -> list[str]:
    """The source's fields; lineage columns begin with an underscore."""
    return [c for c in raw.columns if not c.startswith("_")]


def known_value(status: Column) -> Column:
    """Whether a category is in its domain; null if there is none."""
    return F.when(status != "missing", status == "mapped")


def invalid(raw: str, clean: Column) -> Column:
    return ~text.is_missing(C(raw)) & clean.isNull()


def category(name: str, status: Column) -> list[Issue]:
    return [issue(status == "unmapped", f"invalid_{name}"), issue(status == "missing", f"missing_{name}", "note")]


def parsed(name: str, clean: Column) -> list[Issue]:
    """Issues of a date or an instant: not readable is an error, missing is noted."""
    return [issue(invalid(name, clean), f"invalid_{name}"), issue(text.is_missing(C(name)), f"missing_{name}", "note")]


def enrollments(raw: DataFrame, participants: DataFrame, trainings: DataFrame, as_of: str) -> DataFrame:
    """Only values that cannot be read are errors; what looks odd is noted and the row stays valid."""
    as_sent, status = C("training_id"), K.standard(C("_slug"), K.STATUSES)
    df = raw.withColumns({"enrollment_id": text.trim_text(C("enrollment_id")), "participant_id": text.trim_text(C("participant_id")), "training_id": text.normalize_upper(as_sent), "training_id_changed": text.normalize_upper(as_sent) != as_sent})
    df = flag_present(flag_present(df, participants, {"participant_id": "participant_id"}, "has_participant"), trainings, {"training_id": "training_id"}, "has_training")
    df = counted(df, "enrollment_id", own_fields(raw)).withColumn("_slug", text.slugify(C("status")))
    df = df.withColumns({"cohort_start": dates.parse_flexible_date(C("cohort_start_date")), "planned_end": dates.parse_flexible_date(C("planned_end_date")), "status_clean": status["value"], "changed_at_utc": dates.parse_local_timestamp(C("status_changed_at")), "created_at_utc": dates.parse_local_timestamp(C("created_at")), "modified_at_utc": dates.parse_local_timestamp(C("modified_at"))})
    df = df.withColumns({"is_status_valid": known_value(status["status"]), "is_open_status": F.when(status["status"] == "mapped", C("status_clean").isin(*K.OPEN_STATUSES)), "planned_duration_days": F.datediff("planned_end", "cohort_start")})
    limit = dates.local_to_utc(F.lit(as_of).cast("date").cast("timestamp_ntz") + F.expr("interval 1 day")).cast("timestamp")
    return finish(df, "enrollment_id", [
        issue(C("training_id_changed"), "training_id_normalization_applied", "note"), *parsed("cohort_start_date", C("cohort_start")), *parsed("planned_end_date", C("planned_end")),
        issue(C("planned_end") < C("cohort_start"), "planned_end_before_start", "note"), *category("status", status["status"]),
        issue(~C("has_participant"), "missing_participant_reference", "note"), issue(~C("has_training"), "missing_training_reference", "note"),
        *parsed("status_changed_at", C("changed_at_utc")), *parsed("created_at", C("created_at_utc")), *parsed("modified_at", C("modified_at_utc")),
        issue(C("changed_at_utc") < C("created_at_utc"), "status_changed_before_created", "note"), issue(C("changed_at_utc") >= limit, "status_changed_after_reference_date", "note"),
        issue((C("status_clean") == "aktiv") & (C("planned_end") < F.lit(as_of).cast("date")), "active_past_planned_end", "note"),
    ]).drop("_slug")


def participants(raw: DataFrame, as_of: str, everyone: DataFrame | None = None) -> DataFrame:
    """everyone: the whole raw history, in which shared addresses are looked for (else raw itself)."""
    fields = own_fields(raw)
    funding, state = K.standardize(C("funding_type"), K.FUNDING), K.federal_state(C("federal_state"))
    df = raw.withColumns({"participant_id": text.trim_text(C("participant_id")), "first_name_clean": text.person_name(C("first_name")), "last_name_clean": text.person_name(C("last_name")), "email_clean": text.normalize_email(C("email")), "city_clean": text.city_name(C("city")), "state": F.coalesce(state, text.clean_text(C("federal_state")), F.lit("unknown")), "funding": funding["value"], "birth": dates.parse_flexible_date(C("birth_date")), "modified_at_utc": dates.parse_local_timestamp(C("modified_at"))})
    known = df if everyone is None else everyone.select(text.trim_text(C("participant_id")).alias("participant_id"), text.normalize_email(C("email")).alias("email_clean"))
    shared = known.where("email_clean is not null").groupBy("email_clean").agg((F.count_distinct("participant_id") > 1).alias("shared_email"), F.min(F.struct(F.length("participant_id").alias("n"), C("participant_id").alias("id")))["id"].alias("canonical_id"))
    df = df.join(shared, "email_clean", "left").withColumn("canonical_participant_id", F.coalesce("canonical_id", "participant_id")).drop("canonical_id")
    df = df.withColumns({"name_match_key": text.name_key(C("first_name"), C("last_name")), "is_email_valid": F.when(C("email_clean").isNotNull(), text.is_email(C("email_clean"))), "is_birth_date_valid": F.when(invalid("birth_date", C("birth")), False).when(C("birth").isNotNull(), C("birth").between(F.lit("1900-01-01").cast("date"), F.lit(as_of).cast("date")))})
    if "created_at" in fields:
        df = df.withColumn("created_at_utc", dates.parse_local_timestamp(C("created_at")))
    more = []
    if "acquisition_channel" in fields:
        channel = K.standardize(C("acquisition_channel"), None)
        df, more = df.withColumn("channel", channel["value"]), category("acquisition_channel", channel["status"])
    spaced = [text.trim_text(F.regexp_replace(C(c), r"(?U)\s+", " ")).eqNullSafe(C(c)) for c in ("first_name", "last_name", "city", "email", "federal_state", "funding_type", "acquisition_channel") if c in fields]
    created = parsed("created_at", dates.parse_local_timestamp(C("created_at"))) if "created_at" in fields else []
    return finish(counted(df, "participant_id", fields), "participant_id", [
        issue(C("first_name_clean").isNull(), "missing_first_name", "note"), issue(C("last_name_clean").isNull(), "missing_last_name", "note"), issue(C("email_clean").isNull(), "missing_email", "note"),
        issue(C("email_clean") != C("email"), "email_normalization_applied", "note"), issue(F.coalesce("shared_email", F.lit(False)), "normalized_email_collision", "note"),
        issue(C("email_clean").isNotNull() & ~text.is_email(C("email_clean")), "invalid_email_format", "note"), issue(invalid("birth_date", C("birth")), "invalid_birth_date"),
        issue(~C("birth").between(F.lit("1900-01-01").cast("date"), F.lit(as_of).cast("date")), "implausible_birth_date", "note"), issue(C("city_clean").isNull(), "missing_city", "note"),
        issue(~text.is_missing(C("federal_state")) & state.isNull(), "invalid_federal_state"), issue(text.is_missing(C("federal_state")), "missing_federal_state", "note"),
        *category("funding_type", funding["status"]), *more, issue(~F.forall(F.array(*spaced), lambda v: v), "text_whitespace_normalized", "note"), *created, *parsed("modified_at", C("modified_at_utc")),
    ])


def progress_events(raw: DataFrame, enrolled: DataFrame, modules: DataFrame) -> DataFrame:
    e = enrolled.groupBy(C("enrollment_id").alias("_e")).agg(F.max_by("training_id", F.coalesce("modified_at_utc", F.lit("1970-01-01").cast("timestamp"))).alias("enrolled_training"), F.max("cohort_start").alias("_start"))
    m = modules.groupBy(C("module_id").alias("_m")).agg(F.min("training_id").alias("module_training"))
    kind = K.standard(C("_slug"), K.EVENTS)
    df = raw.withColumns({"event_id": text.trim_text(C("event_id")), "enrollment_id": text.trim_text(C("enrollment_id")), "module_id": text.normalize_upper(C("module_id"))})
    df = df.join(e, C("enrollment_id") == C("_e"), "left").join(m, C("module_id") == C("_m"), "left")
    df = counted(df, "event_id", own_fields(raw)).withColumn("_slug", text.slugify(C("event_type")))
    df = df.withColumns({"event_kind": kind["value"], "event_at_utc": dates.parse_utc_timestamp(C("event_time"))})
    local = F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), C("event_at_utc").cast("timestamp_ntz")).cast("date")
    df = df.withColumns({"is_event_type_valid": known_value(kind["status"]), "has_enrollment": C("_e").isNotNull(), "has_module": C("_m").isNotNull(), "is_module_in_training": C("module_training") == C("enrolled_training"), "is_before_start": local < C("_start")})
    return finish(df, "event_id", [
        *category("event_type", kind["status"]), issue(C("_e").isNull(), "missing_enrollment_reference", "note"), issue(C("_m").isNull(), "missing_module_reference", "note"),
        issue(C("module_training") != C("enrolled_training"), "module_not_in_enrollment_training", "note"), *parsed("event_time", C("event_at_utc")), issue(C("is_before_start"), "event_before_cohort_start", "note"),
    ]).drop("_e", "_m", "_start", "_slug")


def survey_responses(raw: DataFrame, enrolled: DataFrame) -> DataFrame:
    """is_answer_valid is null for questions without a scale and for missing answers."""
    kind, question = K.standard(C("_kind"), tuple(dict.fromkeys(K.QUESTIONS.values()))), K.standard(C("_question"), tuple(K.QUESTIONS))
    df = raw.withColumns({"response_id": text.trim_text(C("response_id")), "enrollment_id": text.trim_text(C("enrollment_id"))})
    df = counted(flag_present(df, enrolled, {"enrollment_id": "enrollment_id"}, "has_enrollment"), "response_id", own_fields(raw))
    df = df.withColumns({"_kind": text.slugify(C("survey_type")), "_question": text.slugify(C("question_key"))})
    df = df.withColumns({"survey_kind": kind["value"], "question": question["value"], "week": numbers.whole_number(C("survey_week")), "submitted_at_utc": dates.parse_utc_timestamp(C("submitted_at")), "_a": numbers.parse_answer(C("answer_value"))})
    low = F.coalesce(*[F.when(C("question") == q, lo) for q, (lo, _) in K.RANGES.items()])
    high = F.coalesce(*[F.when(C("question") == q, hi) for q, (_, hi) in K.RANGES.items()])
    rated, numeric = low.isNotNull(), C("_a.kind").isin("number", "ratio")
    df = df.withColumns({"expected_type": K.lookup(C("question"), K.QUESTIONS), "is_rated": rated, "score": F.when(rated, C("_a.score")), "scale_off": F.coalesce(rated & (C("_a.kind") == "ratio") & (C("_a.scale") != high), F.lit(False))})
    fits = F.coalesce((C("_a.score") == F.floor("_a.score")) & C("_a.score").between(low, high), F.lit(False)) & ~C("scale_off")
    week_fits = F.when(C("survey_kind") == "wochenfeedback", F.coalesce(C("week") >= 1, F.lit(False))).otherwise(C("week").isNull())
    df = df.withColumns({"is_answer_valid": F.when(rated & numeric, fits).when(rated & (C("_a.kind") == "text"), False), "is_survey_week_valid": week_fits})
    context = F.when(C("_a.kind") == "missing", "unknown").when(C("_a.kind") == "ratio", F.regexp_replace(C("_a.scale").cast("string"), r"\.?0+$", "")).when(C("_a.kind") == "text", "text").otherwise("unknown")
    df = df.withColumns({"is_answer_missing": C("_a.kind") == "missing", "answer_context": F.when(rated, context).when(C("_a.kind") == "missing", "unknown").otherwise("text"), "is_question_valid": C("survey_kind") == C("expected_type"), "nps_category": F.when((C("question") == "nps") & C("is_answer_valid"), numbers.nps_group(C("score")))})
    return finish(df, "response_id", [
        issue(invalid("survey_week", C("week")), "invalid_survey_week"), *category("survey_type", kind["status"]), *category("question_key", question["status"]), issue(~C("has_enrollment"), "missing_enrollment_reference", "note"),
        issue(C("survey_kind") != C("expected_type"), "question_not_valid_for_survey_type"), issue(~C("is_survey_week_valid"), "survey_week_inconsistent", "note"),
        issue(C("is_rated") & (C("_a.kind") == "missing"), "missing_survey_answer", "note"), issue(C("is_rated") & (C("_a.kind") == "text"), "malformed_survey_answer"), issue(C("scale_off"), "survey_answer_scale_mismatch"),
        issue(C("is_rated") & numeric & ~C("scale_off") & ~C("is_answer_valid"), "survey_answer_out_of_range"), issue(C("is_answer_valid") & ((C("_a.kind") == "ratio") | C("answer_value").contains(",")), "survey_answer_format_normalized", "note"),
        *parsed("submitted_at", C("submitted_at_utc")),
    ]).drop("_a", "_kind", "_question")


def trainings(raw: DataFrame) -> DataFrame:
    """The catalog. Modules are consistent if their orders are 1 to n and their ids differ and begin with the training's."""
    fields = own_fields(raw)
    variant, weeks, price = K.standardize(C("variant"), K.VARIANTS), numbers.whole_number(C("duration_weeks")), numbers.money(C("list_price_eur"))
    ids = F.transform("modules", lambda m: text.normalize_upper(m["module_id"]))
    orders = F.transform("modules", lambda m: m["module_order"].cast("int"))
    df = raw.withColumns({"training_id": text.normalize_upper(C("training_id")), "training_name": F.coalesce(text.clean_text(C("training_name")), F.lit("unknown")), "track": F.coalesce(text.clean_text(C("track")), F.lit("unknown"))})
    df = df.withColumns({"variant_clean": variant["value"], "is_variant_valid": F.when(variant["status"] != "missing", variant["status"] == "mapped"), "weeks": weeks, "price_eur": price, "active": K.parse_boolean(C("is_active").cast("string"))})
    prefixed = F.forall(ids, lambda i: F.coalesce(i.startswith(F.concat(C("training_id"), F.lit("-"))), F.lit(False)))
    ordered = F.sort_array(orders).eqNullSafe(F.sequence(F.lit(1), F.greatest(F.size("modules"), F.lit(1))))
    sound = (F.size("modules") > 0) & ordered & (F.size(F.array_distinct(ids)) == F.size(ids)) & prefixed
    df = df.withColumn("has_consistent_modules", F.coalesce(sound, F.lit(False)))
    return finish(counted(df, "training_id", fields), "training_id", [
        issue(variant["status"] == "unmapped", "invalid_variant"), issue(variant["status"] == "missing", "missing_variant", "note"), issue(invalid("duration_weeks", C("weeks")), "invalid_duration_weeks"),
        issue(invalid("list_price_eur", C("price_eur")), "invalid_list_price_eur"), issue(invalid("is_active", C("active").cast("string")), "invalid_is_active"), issue(text.is_missing(C("is_active").cast("string")), "missing_is_active", "note"),
        issue(~C("has_consistent_modules"), "inconsistent_training_modules", "note"),
    ])


def modules(catalog: DataFrame) -> DataFrame:
    """One row per training and module, the first by order and name where the catalog repeats one, from trainings()."""
    rows = catalog.where("training_id is not null").select("training_id", F.explode("modules").alias("m"))
    rows = rows.select("training_id", text.normalize_upper(C("m.module_id")).alias("module_id"), C("m.module_order").cast("int").alias("module_order"), text.clean_text(C("m.module_name")).alias("module_name"), C("m.estimated_hours").cast("int").alias("estimated_hours")).where("module_id is not null")
    return dedupe_latest(rows, ["training_id", "module_id"], [C(c).asc_nulls_last() for c in ("module_order", "module_name", "estimated_hours")])
