"""The models and analyses as standalone queries: their inputs are made from the driver's tables, here and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.categories import EVENTS, FUNDING, OPEN_STATUSES, STATUSES, VARIANTS
from ..sources.tables import table as T
from . import data_tests as rules
from .analyses import ANALYSES
from .assertions import REPORTS
from .models import DIM_MODULES, DIM_PARTICIPANTS, DIM_TRAININGS, FCT_ASSIGNMENTS, FCT_ENROLLMENTS, FCT_EVENTS, FCT_RESPONSES, Context

C = F.col
AS_OF = "1998-06-30"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _pick(values: tuple[str, ...], x: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (x % len(values) + 1).cast("int"))


def _text(x) -> Column:
    return C(x).cast("string") if isinstance(x, str) else x.cast("string")


def _lineage(key: Column, at: Column) -> list[Column]:
    status = F.when(key % 31 == 0, "review").otherwise("valid").alias("validation_status")
    return [(at + F.expr("interval 50 days")).alias("ingested_at"), status, F.array(F.concat(F.lit("f"), _text(key % 5))).alias("quality_flags"), (key % 53 == 0).alias("is_deleted")]


def inputs(spark, d: str) -> dict[str, DataFrame]:
    """The staging models' columns that models read, from the driver's tables."""
    o, l, key, cust = T(spark, d, "orders"), T(spark, d, "lineitem"), C("o_orderkey"), C("o_custkey")
    dated, days = cust % 23 != 0, (cust % 200 - 5).cast("int")
    e = o.select(
        _text(key).alias("enrollment_id"), F.concat(F.when(cust % 17 == 0, "x").otherwise(""), _text("o_custkey")).alias("participant_id"), F.concat(F.lit("T0"), _text(key % 9)).alias("training_id"),
        _pick(STATUSES, key).alias("status"), _pick(STATUSES, key).isin(*OPEN_STATUSES).alias("is_open_status"), F.when(dated, C("o_orderdate").cast("date")).alias("cohort_start_date"), F.when(~dated, "soon").alias("cohort_start_date_unparsed_raw"),
        F.when(dated, F.date_add(C("o_orderdate").cast("date"), days)).alias("planned_end_date"), F.when(~dated, "later").alias("planned_end_date_unparsed_raw"), F.when(dated, days).alias("planned_duration_days"),
        (C("o_orderdate") + F.expr("interval 40 days")).alias("status_changed_at_utc"), C("o_orderdate").alias("created_at_utc"), (C("o_orderdate") + F.expr("interval 41 days")).alias("modified_at_utc"),
        (cust % 17 != 0).alias("has_participant_reference"), (key % 9 != 0).alias("has_training_reference"), (key % 29 == 0).alias("is_quarantined"), *_lineage(key, C("o_orderdate")),
    )
    now, k = F.lit("1998-05-01 00:00:00").cast("timestamp_ntz"), C("c_custkey")
    p = T(spark, d, "customer").select(
        _text(k).alias("participant_id"), _text(k - k % 3).alias("canonical_participant_id"), C("c_name").alias("first_name"), F.upper("c_mktsegment").alias("last_name"), F.concat(F.lit("City "), _text("c_nationkey")).alias("city"), F.lit("unknown").alias("federal_state"),
        _pick(FUNDING, k).alias("funding_type"), F.lower("c_mktsegment").alias("acquisition_channel"), F.when(k % 7 != 0, k % 11 != 0).alias("is_email_valid"), F.when(k % 5 != 0, k % 13 != 0).alias("is_birth_date_valid"), now.alias("created_at_utc"), (now + F.expr("interval 1 day")).alias("modified_at_utc"),
        F.lit("secret@x.de").alias("email"), F.lit("1990-01-01").cast("date").alias("birth_date"), (k % 31 == 0).alias("is_quarantined"), *_lineage(k + 1, now),
    )
    nk = C("n_nationkey")
    t = T(spark, d, "nation").where(nk.between(1, 8)).select(
        F.concat(F.lit("T0"), _text(nk)).alias("training_id"), C("n_name").alias("training_name"), F.concat(F.lit("track "), _text("n_regionkey")).alias("track"), _pick(VARIANTS, nk).alias("variant"), (nk + 10).cast("int").alias("duration_weeks"), (nk * 100).cast("decimal(12,2)").alias("list_price_eur"),
        (nk % 2 == 0).alias("is_active"), F.lit("1998-05-02").cast("date").alias("source_as_of_date"), (nk != 3).alias("has_consistent_modules"), (nk == 7).alias("is_quarantined"), *_lineage(nk, now),
    )
    pk = C("p_partkey")
    m = T(spark, d, "part").where("p_partkey <= 60").select(
        F.concat(F.lit("T0"), _text(pk % 8 + 1)).alias("training_id"), F.concat(F.lit("M"), _text(pk)).alias("module_id"), (pk / 8 + 1).cast("int").alias("module_order"), C("p_name").alias("module_name"), C("p_size").cast("int").alias("estimated_hours"), F.lit("1998-05-02").cast("date").alias("source_as_of_date"),
        F.lit(False).alias("is_quarantined"), *_lineage(pk, now),
    )
    row = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part, supp = C("l_partkey"), C("l_suppkey")
    ev = l.select(
        row.alias("event_id"), _text("l_orderkey").alias("enrollment_id"), F.concat(F.lit("M"), _text(part % 70 + 1)).alias("module_id"), _pick(EVENTS, C("l_linenumber")).alias("event_type"), C("l_shipdate").alias("event_at_utc"), (part % 3 != 0).alias("has_enrollment_reference"), (part % 70 < 60).alias("has_module_reference"),
        F.when(part % 4 != 0, part % 5 == 0).alias("is_module_in_enrollment_training"), F.when(part % 6 != 0, part % 7 == 0).alias("is_event_before_cohort_start"), (supp % 37 == 0).alias("is_quarantined"), *_lineage(part, C("l_shipdate")),
    )
    score, nps, line = (C("l_quantity").cast("int") % 12).cast("decimal(5,2)"), C("l_linenumber") % 2 == 0, C("l_linenumber")
    r = l.select(
        row.alias("response_id"), _text("l_orderkey").alias("enrollment_id"), F.when(nps, "abschlussfeedback").otherwise("wochenfeedback").alias("survey_type"), F.when(nps, "nps").otherwise("tempo").alias("question_key"), score.alias("answer_score"), F.when(line % 3 == 0, "10").otherwise("unknown").alias("answer_context"),
        F.when(nps & (score <= 10), numbers.nps_group(score)).alias("nps_category"), (line % 4 == 0).alias("is_answer_missing"), (score <= 10).alias("is_answer_valid"), F.when(line != 5, line < 6).alias("is_question_valid_for_survey_type"), (line != 6).alias("is_survey_week_valid"), (part % 3 != 0).alias("has_enrollment_reference"),
        F.lit("private text").alias("answer_value"), line.alias("survey_week"), C("l_shipdate").alias("submitted_at_utc"), (part % 41 == 0).alias("is_quarantined"), *_lineage(part, C("l_shipdate")),
    )
    status = F.when(part % 4 == 0, "ambiguous").when(part % 4 == 1, "unmatched").otherwise("matched")
    mapped = part % 8 != 0
    a = l.where("l_orderkey % 5 = 0 and l_linenumber <= 3").select(
        row.alias("coach_assignment_id"), F.date_add(F.lit("1998-06-29").cast("date"), line % 2).alias("snapshot_date"), F.concat(F.lit("Coach "), _text(supp % 10)).alias("coach"), F.when(mapped, F.concat(F.lit("T0"), _text(part % 8))).alias("training_id"), F.when(~mapped, F.concat(F.lit("spelt "), _text(part))).alias("training_unmapped_raw"),
        F.when(mapped, C("l_shipdate").cast("date")).alias("cohort_start_date"), F.when(status == "matched", _text(supp)).alias("matched_participant_id"), status.alias("match_status"), F.when(status == "matched", "unique_email").otherwise("no_match").alias("match_method"), F.when(status == "matched", _text("l_orderkey")).alias("matched_enrollment_id"),
        F.when(C("l_returnflag") == "R", "red").when(C("l_returnflag") == "A", "green").otherwise("yellow").alias("ampel"), F.when(part % 3 == 0, C("l_shipdate").cast("date")).alias("last_contact_date"), (part % 9 == 0).alias("business_key_duplicate_flag"), (part % 19 == 0).alias("is_quarantined"), *_lineage(part, C("l_shipdate")),
    )
    return {"enrollments": e, "participants": p, "trainings": t, "modules": m, "events": ev, "responses": r, "assignments": a}


def _listed(values: tuple[str, ...], x: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST({x} % {len(values)} AS INT) + 1]"


DAY = f"DATE '{AS_OF}'"


def _shared(key: str, at: str) -> str:
    return f"{at} + INTERVAL 50 DAY AS ingested_at, CASE WHEN ({key}) % 31 = 0 THEN 'review' ELSE 'valid' END AS validation_status, 'f' || (({key}) % 5) AS quality_flags"


LIVE, NOW = "({}) % 53 <> 0", "TIMESTAMP '1998-05-01 00:00:00'"
PARTS: dict[str, str] = {
    "e": f"""SELECT CAST(o_orderkey AS VARCHAR) AS eid, CASE WHEN o_custkey % 17 = 0 THEN 'x' ELSE '' END || o_custkey AS pid, 'T0' || (o_orderkey % 9) AS tid, {_listed(STATUSES, 'o_orderkey')} AS st,
 CASE WHEN o_custkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END AS c0, CASE WHEN o_custkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 200 - 5 AS INT) END AS c1, o_orderdate + INTERVAL 40 DAY AS changed, o_orderdate AS created, o_custkey % 17 <> 0 AS has_p, o_orderkey % 9 <> 0 AS has_t,
 {_shared('o_orderkey', 'o_orderdate')} FROM orders WHERE o_orderkey % 29 <> 0 AND {LIVE.format('o_orderkey')}""",
    "p": f"SELECT *, CAST(c_custkey AS VARCHAR) AS pid, {_listed(FUNDING, 'c_custkey')} AS funding, c_custkey % 31 = 0 AS bad, {_shared('c_custkey + 1', NOW)} FROM customer WHERE {LIVE.format('c_custkey + 1')}",
    "t": f"SELECT *, 'T0' || n_nationkey AS tid, n_name AS tname, {_listed(VARIANTS, 'n_nationkey')} AS variant, {_shared('n_nationkey', NOW)} FROM nation WHERE n_nationkey BETWEEN 1 AND 8 AND n_nationkey <> 7",
    "m": f"SELECT *, 'T0' || (p_partkey % 8 + 1) AS tid, 'M' || p_partkey AS mid, {_shared('p_partkey', NOW)} FROM part WHERE p_partkey <= 60 AND {LIVE.format('p_partkey')}",
    "ev": f"SELECT *, CAST(l_orderkey AS VARCHAR) AS eid, 'M' || (l_partkey % 70 + 1) AS mid, {_listed(EVENTS, 'l_linenumber')} AS kind, l_shipdate AS ts, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, {_shared('l_partkey', 'l_shipdate')} FROM lineitem WHERE l_suppkey % 37 <> 0 AND {LIVE.format('l_partkey')}",
    "r": f"SELECT *, CAST(l_orderkey AS VARCHAR) AS eid, l_linenumber % 2 = 0 AS asks, CAST(l_quantity AS INT) % 12 AS score, l_shipdate AS ts, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, {_shared('l_partkey', 'l_shipdate')} FROM lineitem WHERE l_partkey % 41 <> 0 AND {LIVE.format('l_partkey')}",
    "a": f"""SELECT *, DATE '1998-06-29' + CAST(l_linenumber % 2 AS INT) AS snap, 'Coach ' || (l_suppkey % 10) AS coach, CASE l_partkey % 4 WHEN 0 THEN 'ambiguous' WHEN 1 THEN 'unmatched' ELSE 'matched' END AS ms,
 CASE WHEN l_partkey % 4 > 1 THEN CAST(l_orderkey AS VARCHAR) END AS eid, l_returnflag = 'R' AS red, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, {_shared('l_partkey', 'l_shipdate')} FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 3""",
    "done": f"""SELECT e.*, coalesce(p.funding, 'unknown') AS funding, p.pid IS NULL AS lacks, st = 'abgeschlossen' AS yes, st IN ('abgebrochen', 'storniert') AS no FROM e LEFT JOIN p ON p.pid = e.pid WHERE c1 < {DAY}""",
    "pr": f"""SELECT e.*, k.total, coalesce(x.done, 0) AS done, coalesce(x.n, 0) AS n, x.lo, x.hi, CAST(coalesce(x.done, 0) / CAST(k.total AS DOUBLE) AS DECIMAL(9,6)) AS share FROM e LEFT JOIN (SELECT tid, count(DISTINCT mid) AS total FROM m GROUP BY 1) k ON k.tid = e.tid
 LEFT JOIN (SELECT ev.eid, count(DISTINCT CASE WHEN kind = 'module_completed' AND m.mid IS NOT NULL THEN ev.mid END) AS done, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM ev JOIN e ON e.eid = ev.eid LEFT JOIN m ON m.mid = ev.mid AND m.tid = e.tid WHERE CAST(ts AS DATE) <= {DAY} GROUP BY 1) x ON x.eid = e.eid""",
    "tm": f"""SELECT *, share - time AS gap, share - time <= CAST(-0.15 AS DECIMAL(9,6)) AS behind FROM (SELECT *, date_diff('day', c0, c1) AS planned, date_diff('day', c0, {DAY}) AS elapsed,
 CASE WHEN st = 'aktiv' AND date_diff('day', c0, c1) > 0 THEN CAST(least(greatest(date_diff('day', c0, {DAY}) / CAST(date_diff('day', c0, c1) AS DOUBLE), 0.0), 1.0) AS DECIMAL(9,6)) END AS time,
 CASE WHEN st <> 'aktiv' THEN 'not_active' WHEN c0 IS NULL THEN 'missing_dates' WHEN date_diff('day', c0, c1) <= 0 THEN 'non_positive_planned_duration' WHEN c0 > {DAY} THEN 'cohort_not_started' WHEN c1 < {DAY} THEN 'past_planned_end' ELSE 'ok' END AS flag FROM pr)""",
    "nps": f"""SELECT e.tid, date_trunc('quarter', ts) AS q, count(*) AS n, count(*) FILTER (WHERE score >= 9) AS hi, count(*) FILTER (WHERE score IN (7, 8)) AS mid, count(*) FILTER (WHERE score < 7) AS lo FROM r JOIN e USING (eid) JOIN t ON t.tid = e.tid
 WHERE asks AND score <= 10 AND CAST(ts AS DATE) <= {DAY} GROUP BY 1, 2""",
    "cm": """SELECT a.*, e.eid AS own, e.st AS st, e.eid IS NOT NULL AS sure, coalesce(e.st IN ('angemeldet', 'aktiv', 'pausiert'), false) AS opened, snap = (SELECT max(snap) FROM a) AS newest, count(*) FILTER (WHERE e.eid IS NOT NULL) OVER w AS claims,
 coalesce(min(CASE WHEN e.eid IS NOT NULL THEN coach END) OVER w <> max(CASE WHEN e.eid IS NOT NULL THEN coach END) OVER w, false) AS clash FROM a LEFT JOIN e ON e.eid = a.eid WINDOW w AS (PARTITION BY snap, e.eid)""",
    "per": f"""SELECT tid, count(*) AS n, count(*) FILTER (WHERE CAST(changed AS DATE) > {DAY}) AS late, count(*) FILTER (WHERE c1 < {DAY}) AS past, count(*) FILTER (WHERE c0 > {DAY}) AS ahead FROM e WHERE st = 'aktiv' GROUP BY 1""",
    "act": "SELECT tm.*, tname FROM tm LEFT JOIN t USING (tid) WHERE st = 'aktiv'",
    "summary": """SELECT coalesce(tid, 'ALL') AS tid, CASE WHEN grouping(tid) = 0 THEN max(tname) ELSE 'ALL' END AS tname, grouping(tid) AS total, count(*) AS n, count(behind) AS known, count(*) FILTER (WHERE behind) AS late, avg(share) AS share, avg(time) AS time FROM act GROUP BY ROLLUP (tid)""",
    "load": """SELECT coach, count(DISTINCT CASE WHEN sure AND opened THEN own END) AS n, count(DISTINCT CASE WHEN sure AND opened AND red THEN own END) AS red, count(*) FILTER (WHERE ms = 'unmatched') AS un, count(*) FILTER (WHERE ms = 'ambiguous') AS am, count(*) AS k, max(snap) AS snap FROM cm WHERE newest GROUP BY 1""",
    "free": """SELECT count(*) AS n, count(*) FILTER (WHERE eid IN (SELECT own FROM cm WHERE newest AND sure)) AS has, (SELECT count(*) FROM cm WHERE newest AND ms = 'ambiguous') AS am, (SELECT count(*) FROM cm WHERE newest AND ms = 'unmatched') AS un, (SELECT max(snap) FROM cm) AS snap FROM e WHERE st IN ('angemeldet', 'aktiv', 'pausiert')""",
}
WITH = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in PARTS.items())
DAY_TEXT, SNAP, SHIFTED = f"'{AS_OF}' AS reporting_date", "CAST(snap AS VARCHAR) AS coach_snapshot_date", f"snap <> {DAY} AS snapshot_mismatch_flag"
QUARTER = "strftime(q, '%Y') || '-Q' || quarter(q)"
FLAGS = "array_to_string(list_filter(['current_status_used_no_status_history', CASE WHEN late > 0 THEN 'status_changed_after_cutoff' END, CASE WHEN past > 0 THEN 'active_past_planned_end' END, CASE WHEN ahead > 0 THEN 'cohort_start_after_cutoff' END], lambda x: x IS NOT NULL), ',')"


def _flat(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in types that any engine shares: dates and lists as text, decimals and averages as doubles of six digits."""
    out = []
    for f in (df.schema[c] for c in columns):
        kind, x = f.dataType.simpleString(), C(f.name)
        x = x.cast("string") if kind == "date" else F.array_join(x, ",") if kind.startswith("array") else x.cast("double") if kind.startswith("decimal") else x
        out.append((F.round(x, 6) if f.name.startswith("average_") else x).alias(f.name))
    return df.select(*out)


def _add(name: str, columns: str, sql: str, made=None) -> None:
    """columns: those compared, in the order of sql."""
    key = name if made else f"model_{name}"
    QUERIES[key] = lambda spark, d: _flat((made or (lambda c: c[name]))(Context(inputs(spark, d), AS_OF)), columns.split())
    SQL[key] = f"{WITH}\n{sql}"


_add("int_active_enrollments", "enrollment_id training_id reporting_date changed_after past_end starts_after", f"SELECT eid AS enrollment_id, tid AS training_id, {DAY_TEXT}, CAST(changed AS DATE) > {DAY} AS changed_after, coalesce(c1 < {DAY}, false) AS past_end, coalesce(c0 > {DAY}, false) AS starts_after FROM e WHERE st = 'aktiv'")
_add("int_completed_enrollments", "enrollment_id training_id funding_type missing_participant completed abandoned other", "SELECT eid AS enrollment_id, tid AS training_id, funding AS funding_type, lacks AS missing_participant, yes AS completed, no AS abandoned, NOT yes AND NOT no AS other FROM done")
_add("int_enrollment_progress", "enrollment_id training_id total_module_count completed_module_count event_count first_event last_event completed_module_share", "SELECT eid AS enrollment_id, tid AS training_id, total AS total_module_count, done AS completed_module_count, n AS event_count, lo AS first_event, hi AS last_event, CAST(share AS DOUBLE) AS completed_module_share FROM pr")
_add("int_enrollment_time_progress", "enrollment_id planned_days elapsed_days time_share time_flag progress_gap is_behind_schedule", "SELECT eid AS enrollment_id, planned AS planned_days, elapsed AS elapsed_days, CAST(time AS DOUBLE) AS time_share, flag AS time_flag, CAST(gap AS DOUBLE) AS progress_gap, behind AS is_behind_schedule FROM tm")
_add("int_feedback_nps", "training_id feedback_quarter feedback_quarter_label valid_response_count promoter_count passive_count detractor_count nps", f"SELECT tid AS training_id, strftime(q, '%Y-%m-%d') AS feedback_quarter, {QUARTER} AS feedback_quarter_label, n AS valid_response_count, hi AS promoter_count, mid AS passive_count, lo AS detractor_count, CAST(100 * (hi - lo) AS DOUBLE) / n AS nps FROM nps")
_add("int_coach_assignment_matches", "snapshot_date coach match_status matched_enrollment_id is_confident is_open is_latest claims has_conflict is_red", "SELECT CAST(snap AS VARCHAR) AS snapshot_date, coach, ms AS match_status, own AS matched_enrollment_id, sure AS is_confident, opened AS is_open, newest AS is_latest, claims, clash AS has_conflict, sure AND opened AND red AS is_red FROM cm")
_add("dim_trainings", " ".join(DIM_TRAININGS), "SELECT tid AS training_id, tname AS training_name, 'track ' || n_regionkey AS track, variant, CAST(n_nationkey + 10 AS INT) AS duration_weeks, CAST(n_nationkey * 100 AS DOUBLE) AS list_price_eur, n_nationkey % 2 = 0 AS is_active, '1998-05-02' AS source_as_of_date, n_nationkey <> 3 AS has_consistent_modules, validation_status, quality_flags, ingested_at FROM t")
_add("dim_training_modules", " ".join(DIM_MODULES), "SELECT tid AS training_id, mid AS module_id, CAST(p_partkey // 8 + 1 AS INT) AS module_order, p_name AS module_name, CAST(p_size AS INT) AS estimated_hours, '1998-05-02' AS source_as_of_date, validation_status, ingested_at FROM m")
_add("dim_participants", " ".join(DIM_PARTICIPANTS), f"SELECT pid AS participant_id, CAST(c_custkey - c_custkey % 3 AS VARCHAR) AS canonical_participant_id, c_custkey % 3 <> 0 AS has_duplicate_identity, c_name AS first_name, upper(c_mktsegment) AS last_name, 'City ' || c_nationkey AS city, 'unknown' AS federal_state, funding AS funding_type, lower(c_mktsegment) AS acquisition_channel, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 11 <> 0 END AS is_email_valid, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 13 <> 0 END AS is_birth_date_valid, {NOW} AS created_at_utc, {NOW} + INTERVAL 1 DAY AS modified_at_utc, validation_status, quality_flags, ingested_at FROM p WHERE NOT bad")
_add("fct_enrollments", " ".join(FCT_ENROLLMENTS), "SELECT eid AS enrollment_id, e.pid AS participant_id, tid AS training_id, CAST(c0 AS VARCHAR) AS cohort_start_date, CASE WHEN c0 IS NULL THEN 'soon' END AS cohort_start_date_unparsed_raw, CAST(c1 AS VARCHAR) AS planned_end_date, CASE WHEN c1 IS NULL THEN 'later' END AS planned_end_date_unparsed_raw, CAST(date_diff('day', c0, c1) AS INT) AS planned_duration_days, st AS status, st IN ('angemeldet', 'aktiv', 'pausiert') AS is_open_status, changed AS status_changed_at_utc, created AS created_at_utc, created + INTERVAL 41 DAY AS modified_at_utc, coalesce(p.funding, 'unknown') AS funding_type, has_p AS has_participant_reference, has_t AS has_training_reference, p.pid IS NOT NULL AS is_participant_in_dim, e.validation_status, e.quality_flags, e.ingested_at FROM e LEFT JOIN p ON p.pid = e.pid AND NOT p.bad")
_add("fct_enrollment_progress", "enrollment_id training_id status is_active completed_module_count total_module_count completed_module_share elapsed_days planned_duration_days time_progress_share time_progress_quality_flag progress_gap is_behind_schedule progress_event_count last_event_at_utc reporting_date", f"SELECT eid AS enrollment_id, tid AS training_id, st AS status, st = 'aktiv' AS is_active, done AS completed_module_count, total AS total_module_count, CAST(share AS DOUBLE) AS completed_module_share, elapsed AS elapsed_days, planned AS planned_duration_days, CAST(time AS DOUBLE) AS time_progress_share, flag AS time_progress_quality_flag, CAST(gap AS DOUBLE) AS progress_gap, behind AS is_behind_schedule, n AS progress_event_count, hi AS last_event_at_utc, {DAY_TEXT} FROM tm")
_add("fct_progress_events", " ".join(FCT_EVENTS), "SELECT id AS event_id, eid AS enrollment_id, mid AS module_id, kind AS event_type, ts AS event_at_utc, l_partkey % 3 <> 0 AS has_enrollment_reference, l_partkey % 70 < 60 AS has_module_reference, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 5 = 0 END AS is_module_in_enrollment_training, CASE WHEN l_partkey % 6 <> 0 THEN l_partkey % 7 = 0 END AS is_event_before_cohort_start, validation_status, quality_flags, ingested_at FROM ev")
_add("fct_survey_responses", " ".join(FCT_RESPONSES), "SELECT id AS response_id, r.eid AS enrollment_id, e.tid AS training_id, CASE WHEN asks THEN 'abschlussfeedback' ELSE 'wochenfeedback' END AS survey_type, l_linenumber AS survey_week, CASE WHEN asks THEN 'nps' ELSE 'tempo' END AS question_key, CAST(score AS DOUBLE) AS answer_score, CASE WHEN l_linenumber % 3 = 0 THEN '10' ELSE 'unknown' END AS answer_context, CASE WHEN asks AND score <= 10 THEN CASE WHEN score > 8 THEN 'promoter' WHEN score > 6 THEN 'passive' ELSE 'detractor' END END AS nps_category, ts AS submitted_at_utc, l_linenumber % 4 = 0 AS is_answer_missing, score <= 10 AS is_answer_valid, CASE WHEN l_linenumber <> 5 THEN l_linenumber < 6 END AS is_question_valid_for_survey_type, l_linenumber <> 6 AS is_survey_week_valid, l_partkey % 3 <> 0 AS has_enrollment_reference, e.eid IS NOT NULL AS is_enrollment_in_fact, r.validation_status, r.quality_flags, r.ingested_at FROM r LEFT JOIN e ON e.eid = r.eid")
_add("fct_coach_assignments", " ".join(FCT_ASSIGNMENTS), f"SELECT id AS coach_assignment_id, CAST(snap AS VARCHAR) AS snapshot_date, coach, CASE WHEN l_partkey % 8 <> 0 THEN 'T0' || (l_partkey % 8) END AS training_id, CASE WHEN l_partkey % 8 = 0 THEN 'spelt ' || l_partkey END AS training_unmapped_raw, CASE WHEN l_partkey % 8 <> 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS cohort_start_date, CASE WHEN ms = 'matched' THEN CAST(l_suppkey AS VARCHAR) END AS matched_participant_id, own AS matched_enrollment_id, ms AS match_status, CASE WHEN ms = 'matched' THEN 'unique_email' ELSE 'no_match' END AS match_method, sure AS is_confident, st AS enrollment_status, opened AS is_open, CASE l_returnflag WHEN 'R' THEN 'red' WHEN 'A' THEN 'green' ELSE 'yellow' END AS ampel, sure AND opened AND red AS is_red, CASE WHEN l_partkey % 3 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS last_contact_date, l_partkey % 9 = 0 AS business_key_duplicate_flag, clash AS has_conflict, newest AS is_latest, CAST((SELECT max(snap) FROM a) AS VARCHAR) AS coach_snapshot_as_of_date, (SELECT max(snap) FROM a) <> {DAY} AS snapshot_mismatch_flag, validation_status, quality_flags, ingested_at FROM cm")
_add("rpt_active_enrollments_by_training", "training_id training_name active_enrollment_count status_changed_after_cutoff_count past_planned_end_count cohort_start_after_cutoff_count reporting_date data_quality_flags", f"SELECT tid AS training_id, tname AS training_name, coalesce(n, 0) AS active_enrollment_count, coalesce(late, 0) AS status_changed_after_cutoff_count, coalesce(past, 0) AS past_planned_end_count, coalesce(ahead, 0) AS cohort_start_after_cutoff_count, {DAY_TEXT}, {FLAGS} AS data_quality_flags FROM t LEFT JOIN per USING (tid)")
DONE = "SELECT tid, tname, funding, count(*) AS n, count(*) FILTER (WHERE yes) AS y, count(*) FILTER (WHERE no) AS g, count(*) FILTER (WHERE NOT yes AND NOT no) AS o, count(*) FILTER (WHERE lacks) AS w FROM done LEFT JOIN t USING (tid) GROUP BY ALL"
_add("rpt_completion_abandonment_by_training_funding", "training_id training_name funding_type eligible_enrollment_count completed_count abandoned_count other_status_count missing_participant_count completed_share abandoned_share other_status_share reporting_date", f"SELECT tid AS training_id, tname AS training_name, funding AS funding_type, n AS eligible_enrollment_count, y AS completed_count, g AS abandoned_count, o AS other_status_count, w AS missing_participant_count, y / CAST(n AS DOUBLE) AS completed_share, g / CAST(n AS DOUBLE) AS abandoned_share, o / CAST(n AS DOUBLE) AS other_status_share, {DAY_TEXT} FROM ({DONE})")
_add("rpt_progress_vs_time", "enrollment_id training_name completed_module_share planned_duration_days time_progress_share time_progress_quality_flag is_behind_schedule", "SELECT eid AS enrollment_id, tname AS training_name, CAST(share AS DOUBLE) AS completed_module_share, planned AS planned_duration_days, CAST(time AS DOUBLE) AS time_progress_share, flag AS time_progress_quality_flag, behind AS is_behind_schedule FROM act")
_add("rpt_progress_vs_time_summary", "training_id training_name is_total active_enrollment_count evaluable_active_enrollment_count behind_schedule_count average_completed_module_share average_time_progress_share behind_schedule_share", "SELECT tid AS training_id, tname AS training_name, CAST(total AS INT) AS is_total, n AS active_enrollment_count, known AS evaluable_active_enrollment_count, late AS behind_schedule_count, round(share, 6) AS average_completed_module_share, round(time, 6) AS average_time_progress_share, CASE WHEN known > 0 THEN late / CAST(known AS DOUBLE) END AS behind_schedule_share FROM summary")
_add("rpt_nps_by_training_quarter", "training_id training_name feedback_quarter_label valid_response_count nps", f"SELECT tid AS training_id, tname AS training_name, {QUARTER} AS feedback_quarter_label, n AS valid_response_count, CAST(100 * (hi - lo) AS DOUBLE) / n AS nps FROM nps JOIN t USING (tid)")
_add("rpt_coach_utilization", "coach active_or_paused_enrollment_count red_enrollment_count unmatched_enrollment_count ambiguous_assignment_count workbook_row_count coach_snapshot_date snapshot_mismatch_flag", f"SELECT coach, n AS active_or_paused_enrollment_count, red AS red_enrollment_count, un AS unmatched_enrollment_count, am AS ambiguous_assignment_count, k AS workbook_row_count, {SNAP}, {SHIFTED} FROM load")
_add("rpt_coach_unassigned_enrollments", "active_or_paused_enrollment_count assigned_active_or_paused_enrollment_count unassigned_active_or_paused_enrollment_count ambiguous_workbook_row_count unmatched_workbook_row_count coach_snapshot_date snapshot_mismatch_flag", f"SELECT n AS active_or_paused_enrollment_count, has AS assigned_active_or_paused_enrollment_count, n - has AS unassigned_active_or_paused_enrollment_count, am AS ambiguous_workbook_row_count, un AS unmatched_workbook_row_count, {SNAP}, {SHIFTED} FROM free")

_SQL_OF = {
    "active_by_training": ("training_id training_name active_enrollment_count reporting_date data_quality_flags", f"SELECT tid AS training_id, tname AS training_name, coalesce(n, 0) AS active_enrollment_count, {DAY_TEXT}, {FLAGS} AS data_quality_flags FROM t LEFT JOIN per USING (tid)"),
    "completion_by_training_funding": ("training_id training_name funding_type eligible_enrollment_count completed_count abandoned_count other_status_count completed_share abandoned_share", f"SELECT tid AS training_id, tname AS training_name, funding AS funding_type, n AS eligible_enrollment_count, y AS completed_count, g AS abandoned_count, o AS other_status_count, round(y / CAST(n AS DOUBLE), 4) AS completed_share, round(g / CAST(n AS DOUBLE), 4) AS abandoned_share FROM ({DONE})"),
    "progress_by_training": ("training_id training_name active_enrollment_count evaluable_active_enrollment_count behind_schedule_count behind_schedule_share average_completed_module_share average_time_progress_share", "SELECT tid AS training_id, tname AS training_name, n AS active_enrollment_count, known AS evaluable_active_enrollment_count, late AS behind_schedule_count, round(late / CAST(known AS DOUBLE), 4) AS behind_schedule_share, round(share, 4) AS average_completed_module_share, round(time, 4) AS average_time_progress_share FROM summary"),
    "nps_by_training_quarter": ("training_id training_name feedback_quarter_label valid_response_count promoter_count passive_count detractor_count nps", f"SELECT tid AS training_id, tname AS training_name, {QUARTER} AS feedback_quarter_label, n AS valid_response_count, hi AS promoter_count, mid AS passive_count, lo AS detractor_count, round(CAST(100 * (hi - lo) AS DOUBLE) / n, 1) AS nps FROM nps JOIN t USING (tid)"),
    "coach_load": ("coach active_or_paused_enrollment_count red_enrollment_count unmatched_enrollment_count ambiguous_assignment_count reporting_date coach_snapshot_date snapshot_mismatch_flag", f"SELECT coach, n AS active_or_paused_enrollment_count, red AS red_enrollment_count, un AS unmatched_enrollment_count, am AS ambiguous_assignment_count, {DAY_TEXT}, {SNAP}, {SHIFTED} FROM load UNION ALL SELECT '(unassigned active/paused enrollments)', n - has, NULL, un, am, '{AS_OF}', CAST(snap AS VARCHAR), snap <> {DAY} FROM free"),
}
for _name, (_columns, _sql) in _SQL_OF.items():
    _add(f"analysis_{_name}", _columns, _sql, ANALYSES[_name][1])


def wrong_report_dates(spark, d: str) -> DataFrame:
    """Reports with rows that are not as of the cutoff, by a condition on the whole report; the context's cutoff is a day off here for one."""
    c = Context(inputs(spark, d), AS_OF)
    out = None
    for name in REPORTS:
        off = F.lit("1998-07-01" if name == "rpt_coach_utilization" else AS_OF).cast("date")
        one = c[name].agg(F.count_if(~C("reporting_date").eqNullSafe(off)).alias("bad_rows")).where("bad_rows > 0").select(F.lit(name).alias("model"), C("bad_rows").cast("bigint").alias("bad_rows"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES["wrong_report_dates"] = wrong_report_dates
SQL["wrong_report_dates"] = f"{WITH}\nSELECT 'rpt_coach_utilization' AS model, count(*) AS bad_rows FROM load HAVING count(*) > 0"


def data_tests(spark, d: str) -> DataFrame:
    """The data tests of marts, intermediate models and reports, all of them, with the number of rows or keys that fail."""
    c = Context(inputs(spark, d), AS_OF)
    return rules.evaluate(lambda n: c[rules.STAGES.get(n, n)], [r for r in rules.rules() if not r.model.startswith("stg_")])


def _failures() -> str:
    """The same in SQL: for most rules what the inputs make of them can be counted in the tables that they are made from."""
    shown = {
        ("fct_enrollments", "participant_id in dim_participants"): "SELECT count(*) FROM e WHERE pid NOT IN (SELECT pid FROM p WHERE NOT bad)", ("fct_enrollments", "training_id in dim_trainings"): "SELECT count(*) FROM e WHERE tid NOT IN (SELECT tid FROM t)",
        ("fct_progress_events", "event_id unique"): "SELECT count(*) FROM (SELECT id FROM ev GROUP BY 1 HAVING count(*) > 1)", ("fct_progress_events", "enrollment_id in fct_enrollments"): "SELECT count(*) FROM ev WHERE eid NOT IN (SELECT eid FROM e)",
        ("fct_survey_responses", "response_id unique"): "SELECT count(*) FROM (SELECT id FROM r GROUP BY 1 HAVING count(*) > 1)", ("fct_survey_responses", "enrollment_id in fct_enrollments"): "SELECT count(*) FROM r WHERE eid NOT IN (SELECT eid FROM e)",
        ("fct_coach_assignments", "coach_assignment_id, snapshot_date unique"): "SELECT count(*) FROM (SELECT id, snap FROM cm GROUP BY 1, 2 HAVING count(*) > 1)", ("dim_training_modules", "training_id in dim_trainings"): "SELECT count(*) FROM m WHERE tid NOT IN (SELECT tid FROM t)",
        ("dim_training_modules", "module_order in range"): "SELECT count(*) FROM m WHERE p_partkey // 8 + 1 < 1", ("rpt_completion_abandonment_by_training_funding", "training_id in dim_trainings"): "SELECT 0",
        ("int_feedback_nps", "nps in range"): "SELECT count(*) FROM nps WHERE 100 * (hi - lo) > 100 * n OR 100 * (lo - hi) > 100 * n", ("rpt_completion_abandonment_by_training_funding", "eligible_enrollment_count in range"): f"SELECT count(*) FROM ({DONE}) WHERE n < 1",
    }
    told = [f"SELECT '{r.model}' AS model, '{r.name}' AS test, '{r.severity}' AS severity, CAST(({shown.get((r.model, r.name), 'SELECT 0')}) AS BIGINT) AS failures" for r in rules.rules() if not r.model.startswith("stg_")]
    return f"{WITH}\n" + "\nUNION ALL ".join(told)


QUERIES["data_tests"] = data_tests
SQL["data_tests"] = _failures()
