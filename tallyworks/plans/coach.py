"""Workbook rows of the coaches: cleaned, and linked to people and enrollments without guessing.

Matching looks each row up in tables of candidate counts, one row per key, so that neither a name nor an address that many
people share multiplies rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, text, trainings
from ..functions.categories import traffic_light
from ..functions.ids import business_key, stable_id
from .curation import counted, finish, issue

C = F.col
REQUIRED = ("Teilnehmer*in", "E-Mail", "Training", "Kohorte", "Coach")
FIELDS = (*REQUIRED, "Ampel", "Letzter Kontakt", "Notizen")
#: candidates of an ambiguous row that are listed; all are counted
CANDIDATES = 20


def _look_up(rows: DataFrame, known: DataFrame, name: str, left: list[str], right: list[str], value: str) -> DataFrame:
    """rows with {name}_n, how many different values known holds under the row's keys, and {name}_id, the least of them."""
    counts = known.groupBy(*[C(r).alias(f"_{name}_{r}") for r in right]).agg(F.count_distinct(value).alias(f"{name}_n"), F.min(value).alias(f"{name}_id"))
    on = [C(a) == C(f"_{name}_{b}") for a, b in zip(left, right, strict=True)]
    out = rows.join(counts, on, "left").drop(*[f"_{name}_{r}" for r in right])
    return out.withColumn(f"{name}_n", F.coalesce(f"{name}_n", F.lit(0).cast("bigint")))


def _key(kind: str, *parts: Column) -> Column:
    """One text for a kind of lookup and its keys; null if a key is."""
    return F.concat(F.lit(kind), *[x for p in parts for x in (F.lit("\x1f"), p.cast("string"))])


def _listed(rows: DataFrame, people: DataFrame, e: DataFrame) -> DataFrame:
    """rows with candidate_ids, the CANDIDATES smallest ids that there are under their key _of, none without one.

    The rank cuts each task's share of a key before the shuffle, so that a key that many share stays as small as any.
    """
    mail, name, training, cohort = C("p_email"), C("p_name"), C("e_training"), C("e_cohort")
    who = [("mail", mail), ("name", name), ("both", mail, name)]
    what = [("nm", name, training), ("nm_c", name, training, cohort), ("bo", mail, name, training), ("bo_c", mail, name, training, cohort)]
    known = [people.select(_key(*k).alias("_key"), C("pid").alias("_v")) for k in who] + [e.select(_key(*k).alias("_key"), C("eid").alias("_v")) for k in what]
    each = reduce(DataFrame.unionByName, known).where("_key is not null and _v is not null").distinct()
    least = each.withColumn("_r", F.row_number().over(Window.partitionBy("_key").orderBy("_v"))).where(C("_r") <= CANDIDATES)
    lists = least.groupBy("_key").agg(F.sort_array(F.collect_list("_v")).alias("candidate_ids"))
    out = rows.join(lists, C("_of") == C("_key"), "left").drop("_key", "_of")
    return out.withColumn("candidate_ids", F.coalesce("candidate_ids", F.array().cast("array<string>")))


def match_people(rows: DataFrame, people: DataFrame, enrolled: DataFrame) -> DataFrame:
    """rows (email_match_key, name_match_key, training_id, cohort_start_date) with the match, one row each.

    people: (pid, p_email, p_name), one row per pid. enrolled: (eid, e_pid, e_training, e_cohort), one row per eid.
    An address that one person has decides, whatever the enrollment; else name and training do, among those of the name who
    also have the address if there are any. Cohorts narrow where they fit and are passed over where none fits.
    """
    e = enrolled.join(people, C("e_pid") == C("pid"), "left").where("e_pid is not null")
    out = _look_up(rows, people, "mail", ["email_match_key"], ["p_email"], "pid")
    out = _look_up(out, people, "name", ["name_match_key"], ["p_name"], "pid")
    out = _look_up(out, people, "both", ["email_match_key", "name_match_key"], ["p_email", "p_name"], "pid")
    out = out.withColumn("_pid", F.when(C("mail_n") == 1, C("mail_id")))
    out = _look_up(out, e, "any", ["_pid"], ["e_pid"], "eid")
    mail, by_name = ["email_match_key"], ["name_match_key"]
    for name, left, right in (("own", ["_pid"], ["e_pid"]), ("nm", by_name, ["p_name"]), ("bo", mail + by_name, ["p_email", "p_name"])):
        out = _look_up(out, e, name, [*left, "training_id"], [*right, "e_training"], "eid")
        out = _look_up(out, e, f"{name}_c", [*left, "training_id", "cohort_start_date"], [*right, "e_training", "e_cohort"], "eid")

    def pick(field: str) -> tuple[Column, Column]:
        """With and without cohort, among those who also have the address if there are any."""
        some = C("both_n") > 0
        return F.when(some, C(f"bo_c_{field}")).otherwise(C(f"nm_c_{field}")), F.when(some, C(f"bo_{field}")).otherwise(C(f"nm_{field}"))

    sure = C("mail_n") == 1
    (near_n, far_n), (near_id, far_id) = pick("n"), pick("id")
    own_n = F.when(C("training_id").isNull(), C("any_n")).when(C("own_c_n") > 0, C("own_c_n")).otherwise(C("own_n"))
    own_id = F.when(C("own_c_n") > 0, C("own_c_id")).otherwise(C("own_id"))
    own_status = F.when(C("training_id").isNull(), "unmatched").when(own_n == 1, "matched").when(own_n > 1, "ambiguous").otherwise("unmatched")
    hits = F.when(near_n > 0, near_n).otherwise(far_n)
    hit = F.when(near_n > 0, near_id).otherwise(far_id)
    named_n = F.when(C("both_n") > 0, C("both_n")).otherwise(C("name_n"))
    rivals = F.greatest("mail_n", named_n)
    # enrollments that compete, else people
    m, k, t, day = C("email_match_key"), C("name_match_key"), C("training_id"), C("cohort_start_date")
    some = C("both_n") > 0
    of = F.when(near_n > 0, F.when(some, _key("bo_c", m, k, t, day)).otherwise(_key("nm_c", k, t, day))).when(far_n > 0, F.when(some, _key("bo", m, k, t)).otherwise(_key("nm", k, t)))
    of = F.coalesce(of, F.when(C("mail_n") >= named_n, _key("mail", m)), F.when(some, _key("both", m, k)), _key("name", k))
    status = F.when(sure | (hits == 1), "matched").when((hits > 1) | (rivals > 1), "ambiguous").otherwise("unmatched")
    method = F.when(sure, "unique_email").when((hits == 1) & (near_n > 0), "name_training_cohort").when(hits == 1, "name_training").when(status == "ambiguous", "ambiguous_candidates").otherwise("no_match")
    out = out.withColumns({
        "match_status": status, "match_method": method,
        "matched_enrollment_id": F.when(sure, F.when(own_status == "matched", own_id)).when(hits == 1, hit),
        "candidate_count": F.when(sure | (hits == 1), 1).when(hits > 1, hits).when(rivals > 1, rivals).otherwise(0).cast("bigint"),
        "_of": F.when(status == "ambiguous", of),
        "enrollment_candidate_count": F.when(sure, own_n).otherwise(hits).cast("bigint"),
        "enrollment_match_status": F.when(sure, own_status).when(hits == 1, "matched").when(hits > 1, "ambiguous").otherwise("unmatched"),
    })
    out = _listed(out, people, e)
    owner = e.select(C("eid").alias("_eid"), C("e_pid").alias("_owner"))
    out = out.join(owner, C("matched_enrollment_id") == C("_eid"), "left").withColumn("matched_participant_id", F.coalesce("_pid", "_owner"))
    news = ("match_status", "match_method", "matched_participant_id", "matched_enrollment_id", "candidate_count", "candidate_ids", "enrollment_candidate_count", "enrollment_match_status")
    return out.select(*[c for c in rows.columns if c not in news], *news)


def _counted(df: DataFrame, key: str, name: str) -> DataFrame:
    """df with the number of rows that share the key; a null key counts 0."""
    counts = df.where(C(key).isNotNull()).groupBy(C(key).alias("_k")).agg(F.count("*").alias(name))
    return df.join(counts, C(key) == C("_k"), "left").drop("_k").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def assignments(raw: DataFrame, participants: DataFrame, enrollments: DataFrame, file: str, day: str, spellings: DataFrame | None = None) -> DataFrame:
    """raw (FIELDS as text, _source_row_number) of one workbook and day, against curated participants and enrollments.

    spellings: what a training may be called, the package's table if not given. A match whose complete business key other rows
    share becomes ambiguous. No row goes.
    """
    x = {f: C(f"`{f}`") for f in FIELDS}
    who, mapped, email = text.split_name(x["Teilnehmer*in"]), C("mapped"), text.normalize_email(x["E-Mail"])
    raw = trainings.map_training(raw, x["Training"], trainings.spellings(raw.sparkSession) if spellings is None else spellings)
    coach, light = text.clean_text(x["Coach"]), traffic_light(x["Ampel"])
    df = raw.select(
        stable_id(F.lit(file), F.lit(day), C("_source_row_number").cast("string")).alias("coach_assignment_id"), F.lit(day).cast("date").alias("snapshot_date"), C("_source_row_number").alias("excel_row_number"),
        *[x[f].alias(f"{text_name}_raw") for f, text_name in zip(FIELDS, ("teilnehmer", "email", "training", "kohorte", "coach", "ampel", "letzter_kontakt", "notizen"), strict=True)],
        who["last"].alias("participant_last_name_raw"), who["first"].alias("participant_first_name_raw"), text.name_key(x["Teilnehmer*in"]).alias("name_match_key"),
        text.trim_text(x["E-Mail"]).alias("email"), email.alias("email_match_key"), mapped["training_id"].alias("training_id"), mapped["status"].alias("_mapped"),
        F.when(mapped["status"] == "missing", "unmatched").otherwise(mapped["status"]).alias("training_match_status"),
        dates.parse_flexible_date(x["Kohorte"], month_year=True).alias("cohort_start_date"), F.coalesce(coach, F.lit("unknown")).alias("coach"), F.coalesce(light, F.lit("unknown")).alias("ampel"), F.when(light.isNotNull(), "mapped").when(text.is_missing(x["Ampel"]), "missing").otherwise("unmapped").alias("ampel_status"),
        dates.parse_flexible_date(x["Letzter Kontakt"]).alias("last_contact_date"), text.trim_text(x["Notizen"]).alias("notizen"),
        F.exists(F.array(*[text.is_missing(x[f]) for f in REQUIRED]), lambda v: v).alias("is_incomplete"), *[C(c) for c in raw.columns if c.startswith("_")],
    )
    key = business_key(C("email_match_key"), C("training_id"), C("cohort_start_date"))
    df = df.withColumns({"coach_assignment_business_key": key["key"], "has_complete_business_key": key["complete"]})
    df = _counted(_counted(df, "coach_assignment_business_key", "business_key_count"), "email_match_key", "email_assignment_count")
    df = df.withColumn("is_business_key_duplicate", C("business_key_count") > 1)
    # the newest delivery of a person and of an enrollment counts; one row per id, by aggregation
    newest = F.struct(F.coalesce("modified_at_utc", F.lit("0001-01-01").cast("timestamp")), "payload_hash")
    last = lambda d, k, *cols: d.where(C(k).isNotNull()).groupBy(k).agg(F.max_by(F.struct(*cols), newest).alias("s"))
    people = last(participants, "participant_id", C("email_clean").alias("e"), text.name_key(C("first_name"), C("last_name")).alias("n")).select(C("participant_id").alias("pid"), C("s.e").alias("p_email"), C("s.n").alias("p_name"))
    known = last(enrollments, "enrollment_id", "participant_id", "training_id", "cohort_start").select(C("enrollment_id").alias("eid"), C("s.participant_id").alias("e_pid"), C("s.training_id").alias("e_training"), C("s.cohort_start").alias("e_cohort"))
    # rows match by four keys: each combination is looked up once and alone, whole rows are only joined to what it gives
    by = ("email_match_key", "name_match_key", "training_id", "cohort_start_date")
    found = match_people(df.select(*by).distinct(), people, known).withColumnsRenamed({k: f"_of_{k}" for k in by})
    df = df.join(found, reduce(and_, [C(k).eqNullSafe(C(f"_of_{k}")) for k in by]), "left").drop(*[f"_of_{k}" for k in by])
    down = (C("match_status") == "matched") & C("is_business_key_duplicate") & C("has_complete_business_key")
    df = df.withColumn("_down", down).withColumns({
        "match_status": F.when(C("_down"), "ambiguous").otherwise(C("match_status")), "match_method": F.when(C("_down"), "ambiguous_candidates").otherwise(C("match_method")),
        "matched_participant_id": F.when(~C("_down"), C("matched_participant_id")), "matched_enrollment_id": F.when(~C("_down"), C("matched_enrollment_id")),
        "candidate_count": F.when(C("_down"), C("business_key_count")).otherwise(C("candidate_count")), "enrollment_candidate_count": F.when(C("_down"), 0).otherwise(C("enrollment_candidate_count")),
        "enrollment_match_status": F.when(C("_down"), "unmatched").otherwise(C("enrollment_match_status")),
    }).drop("_down").withColumn("enrollment_id", C("matched_enrollment_id"))
    gone = lambda c: text.is_missing(C(c))
    matched = C("match_status") == "matched"
    fields = [c for c in df.columns if c.endswith("_raw")]
    return finish(counted(df, "coach_assignment_id", fields), "coach_assignment_id", [
        issue(C("name_match_key").isNull(), "missing_teilnehmer", "note"), issue(C("email_match_key").isNull(), "missing_email", "note"), issue(C("email_match_key").isNotNull() & ~text.is_email(C("email_match_key")), "invalid_email_format", "note"),
        issue(C("_mapped") == "missing", "missing_training", "review"), issue(C("_mapped") == "unmatched", "unmatched_training", "review"), issue(C("_mapped") == "ambiguous", "ambiguous_training", "review"),
        issue(~gone("kohorte_raw") & C("cohort_start_date").isNull(), "invalid_cohort_date"), issue(gone("kohorte_raw"), "missing_cohort", "note"), issue(C("coach") == "unknown", "missing_coach", "note"),
        issue(~gone("ampel_raw") & (C("ampel") == "unknown"), "invalid_ampel"), issue(gone("ampel_raw"), "missing_ampel", "note"), issue(~gone("letzter_kontakt_raw") & C("last_contact_date").isNull(), "invalid_last_contact_date"),
        issue(C("is_incomplete"), "incomplete_row", "note"), issue(C("is_business_key_duplicate"), "duplicate_business_key", "note"),
        issue(C("match_status") == "unmatched", "unmatched_participant", "review"), issue(C("match_status") == "ambiguous", "ambiguous_participant_match", "review"),
        issue(matched & (C("enrollment_match_status") == "ambiguous"), "ambiguous_enrollment_match", "review"), issue(matched & (C("enrollment_match_status") == "unmatched"), "no_matching_enrollment", "note"),
    ]).drop("_mapped")
