"""Standalone queries over the driver's tables, and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categories, dates, ids, numbers, text
from ..operators import checks, match, rows
from ..sources.tables import table as T

FLAGSHIP = "progress_summary_union"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def n(x=None, name: str = "n") -> Column:
    return (F.count("*") if x is None else x).cast("bigint").alias(name)


C = F.col

ACTIVE = """SELECT n.n_nationkey, n.n_name, count(o.o_orderkey) FILTER (WHERE o.o_orderstatus = 'O') AS active_count,
 count(o.o_orderkey) FILTER (WHERE o.o_orderstatus = 'O' AND o.o_orderdate >= TIMESTAMP '2001-01-01') AS late_count,
 count(o.o_orderkey) FILTER (WHERE o.o_orderstatus = 'O' AND o.o_totalprice > 300000) AS large_count
 FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2"""


@query(ACTIVE)
def active_by_group(spark, d):
    orders = T(spark, d, "orders").where("o_orderstatus = 'O'").join(T(spark, d, "customer"), C("o_custkey") == C("c_custkey"))
    counts = orders.groupBy(C("c_nationkey").alias("n_nationkey")).agg(n(name="active_count"), n(F.count_if(C("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")), "late_count"), n(F.count_if(C("o_totalprice") > 300000), "large_count"))
    return rows.zero_filled(T(spark, d, "nation").select("n_nationkey", "n_name"), counts, ["n_nationkey"])


@query(f"""SELECT n_nationkey, concat_ws(',', 'current_status_only', CASE WHEN late_count > 0 THEN 'late' END, CASE WHEN large_count > 0 THEN 'large' END) AS flags FROM ({ACTIVE})""")
def caveat_flags(spark, d):
    made = F.array_compact(F.array(F.lit("current_status_only"), F.when(C("late_count") > 0, "late"), F.when(C("large_count") > 0, "large")))
    return active_by_group(spark, d).select("n_nationkey", F.array_join(made, ",").alias("flags"))


@query("""SELECT coalesce(c.c_mktsegment, 'unknown') AS segment, o.o_orderpriority AS priority, count(*) AS eligible_count,
 count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_count, count(*) FILTER (WHERE o_orderstatus = 'P') AS abandoned_count,
 CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS completed_share, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) / count(*) AS abandoned_share,
 count(*) FILTER (WHERE c.c_custkey IS NULL) AS missing_count
 FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2""")
def outcome_rates(spark, d):
    cust = T(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    o = T(spark, d, "orders").where(C("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).join(cust, C("o_custkey") == C("c_custkey"), "left")
    out = o.groupBy(F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment"), C("o_orderpriority").alias("priority")).agg(n(name="eligible_count"), n(F.count_if(C("o_orderstatus") == "F"), "completed_count"), n(F.count_if(C("o_orderstatus") == "P"), "abandoned_count"), n(F.count_if(C("c_custkey").isNull()), "missing_count"))
    return out.withColumns({f"{k}_share": numbers.share(C(f"{k}_count"), C("eligible_count")) for k in ("completed", "abandoned")})


@query("""SELECT o.o_orderkey, coalesce(l.part_count, 0) AS part_count, coalesce(l.line_count, 0) AS line_count, l.first_ship, l.last_ship
 FROM orders o LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS part_count, count(*) AS line_count, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey""")
def agg_before_join(spark, d):
    lines = T(spark, d, "lineitem").groupBy(C("l_orderkey").alias("o_orderkey")).agg(n(F.count_distinct("l_partkey"), "part_count"), n(name="line_count"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    out = T(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("part_count", "line_count")})


PROGRESS = """SELECT o_orderkey, seg, planned_days, elapsed_days,
 CASE WHEN active AND planned_days > 0 THEN CAST(least(greatest(CAST(elapsed_days AS DOUBLE) / planned_days, 0.0), 1.0) AS DECIMAL(9,6)) END AS time_share,
 CASE WHEN NOT active THEN 'not_active' WHEN e IS NULL THEN 'missing_dates' WHEN planned_days <= 0 THEN 'non_positive_planned_duration' WHEN DATE '2000-06-30' < s THEN 'cohort_not_started' WHEN DATE '2000-06-30' > e THEN 'past_planned_end' ELSE 'ok' END AS time_flag
 FROM (SELECT *, date_diff('day', s, e) AS planned_days, date_diff('day', s, DATE '2000-06-30') AS elapsed_days FROM
 (SELECT o.o_orderkey, c.c_mktsegment AS seg, CAST(o.o_orderdate AS DATE) AS s, CAST(l.e AS DATE) AS e, o.o_orderstatus = 'O' AS active
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS e FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey))"""


def _progress(spark, d):
    ends = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("e"))
    o = T(spark, d, "orders").join(T(spark, d, "customer").select("c_custkey", C("c_mktsegment").alias("seg")), C("o_custkey") == C("c_custkey")).join(ends, C("o_orderkey") == C("l_orderkey"), "left").withColumn("s", C("o_orderdate").cast("date"))
    out = rows.progress(o, "s", "e", F.lit("2000-06-30").cast("date"), C("o_orderstatus") == "O")
    return out.select("o_orderkey", "seg", "planned_days", "elapsed_days", "time_share", "time_flag")


@query(f"SELECT * REPLACE (CAST(time_share AS DOUBLE) AS time_share) FROM ({PROGRESS})")
def progress_detail(spark, d):
    return _progress(spark, d).withColumn("time_share", C("time_share").cast("double"))


SUMMARY = f"""WITH p AS ({PROGRESS}), g AS (SELECT seg, 0 AS is_total, * EXCLUDE (seg) FROM p UNION ALL SELECT 'ALL', 1, * EXCLUDE (seg) FROM p)
 SELECT seg, is_total, count(*) AS row_count, count(time_share) AS evaluable_count, count(*) FILTER (WHERE time_share <= 0.5) AS behind_count,
 CAST(count(*) FILTER (WHERE time_share <= 0.5) AS DOUBLE) / nullif(count(time_share), 0) AS behind_share, CAST(sum(time_share) AS DOUBLE) / nullif(count(time_share), 0) AS average_share FROM g GROUP BY 1, 2"""


def _summary() -> list[Column]:
    behind = F.count_if(F.coalesce(C("time_share") <= F.lit("0.5").cast("decimal(2,1)"), F.lit(False)))
    return [n(name="row_count"), n(F.count("time_share"), "evaluable_count"), n(behind, "behind_count"), numbers.share(behind, F.count("time_share")).alias("behind_share"), numbers.share(F.sum("time_share"), F.count("time_share")).alias("average_share")]


@query(SUMMARY)
def progress_summary_union(spark, d):
    p = _progress(spark, d)
    return p.groupBy("seg").agg(F.lit(0).alias("is_total"), *_summary()).unionByName(p.agg(F.lit("ALL").alias("seg"), F.lit(1).alias("is_total"), *_summary()))


@query(SUMMARY)
def progress_summary_rollup(spark, d):
    return rows.with_total(_progress(spark, d), "seg", _summary())


NPS = """SELECT seg, CAST(quarter_start AS VARCHAR) AS quarter_start, strftime(quarter_start, '%Y') || '-Q' || quarter(quarter_start) AS quarter_label, count(*) AS valid_count, count(*) FILTER (WHERE score >= 9) AS promoters,
 count(*) FILTER (WHERE score BETWEEN 7 AND 8) AS passives, count(*) FILTER (WHERE score <= 6) AS detractors,
 CAST(100 * (count(*) FILTER (WHERE score >= 9) - count(*) FILTER (WHERE score <= 6)) AS DOUBLE) / count(*) AS nps
 FROM (SELECT c.c_mktsegment AS seg, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start, CAST(floor(o_totalprice) AS BIGINT) % 11 AS score FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey) GROUP BY seg, quarter_start"""


@query(NPS)
def nps_by_quarter(spark, d):
    o = T(spark, d, "orders").join(T(spark, d, "customer"), C("o_custkey") == C("c_custkey"))
    o = o.select(C("c_mktsegment").alias("seg"), dates.quarter_start(C("o_orderdate")).alias("quarter_start"), numbers.nps_group(F.floor("o_totalprice").cast("bigint") % 11).alias("g"))
    out = o.groupBy("seg", "quarter_start").agg(n(name="valid_count"), *[n(F.count_if(C("g") == k), f"{k}s") for k in ("promoter", "passive", "detractor")])
    return out.withColumns({"quarter_label": dates.quarter_label(C("quarter_start")), "quarter_start": C("quarter_start").cast("string"), "nps": numbers.share(100 * (C("promoters") - C("detractors")), C("valid_count"))})


@query(f"SELECT seg, CAST(sum(valid_count) AS BIGINT) AS valid_count, CAST(100 * (sum(promoters) - sum(detractors)) AS DOUBLE) / CAST(sum(valid_count) AS DOUBLE) AS nps FROM ({NPS}) GROUP BY 1")
def nps_pooled(spark, d):
    out = nps_by_quarter(spark, d).groupBy("seg").agg(n(F.sum("valid_count"), "valid_count"), F.sum("promoters").alias("p"), F.sum("detractors").alias("q"))
    return out.select("seg", "valid_count", numbers.share(100 * (C("p") - C("q")), C("valid_count")).alias("nps"))


@query(f"SELECT *, CAST(quarter_start AS DATE) >= (SELECT CAST(date_trunc('quarter', max(o_orderdate)) AS DATE) FROM orders) AS is_partial FROM ({NPS})")
def nps_partial_quarter(spark, d):
    as_of = T(spark, d, "orders").agg(F.max("o_orderdate").alias("as_of"))
    out = nps_by_quarter(spark, d).crossJoin(F.broadcast(as_of))  # one row
    return out.withColumn("is_partial", dates.in_running_quarter(C("quarter_start"), C("as_of"))).drop("as_of")


LINE_ORDER = "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_quantity DESC, l_discount DESC, l_tax DESC"


def _line_order():
    return [C(c).desc_nulls_last() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) = 1")
def dedupe_latest(spark, d):
    return rows.dedupe_latest(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], _line_order()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query(f"""WITH l AS (SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey) FROM lineitem)
 SELECT l_orderkey, l_linenumber, l_partkey FROM l WHERE l_orderkey IS NULL UNION ALL (SELECT l_orderkey, l_linenumber, l_partkey FROM l WHERE l_orderkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) = 1)""")
def dedupe_null_keys(spark, d):
    lines = T(spark, d, "lineitem").withColumn("l_orderkey", F.when(C("l_orderkey") % 5 != 0, C("l_orderkey")))
    return rows.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], _line_order()).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders) AS is_latest FROM orders")
def latest_snapshot_flag(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.trunc(C("o_orderdate").cast("date"), "month").alias("m"))
    # one row, so the cross join is a broadcast of a constant
    return o.crossJoin(F.broadcast(o.agg(F.max("m").alias("top")))).select("o_orderkey", (C("m") == C("top")).alias("is_latest"))


@query("""SELECT l_partkey, max(k) AS claim_count, min(lo) AS owner_min, max(hi) AS owner_max, coalesce(min(lo) <> max(hi), false) AS has_conflict FROM (
 SELECT l_partkey, count(*) FILTER (WHERE l_returnflag = 'R') OVER w AS k, min(l_suppkey) FILTER (WHERE l_returnflag = 'R') OVER w AS lo, max(l_suppkey) FILTER (WHERE l_returnflag = 'R') OVER w AS hi
 FROM lineitem WINDOW w AS (PARTITION BY l_partkey)) GROUP BY 1""")
def conflicting_owner(spark, d):
    out = rows.owner_conflicts(T(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"), ["l_partkey"], C("l_returnflag") == "R", "l_suppkey")
    return out.select("l_partkey", C("claim_count").cast("bigint"), "owner_min", "owner_max", "has_conflict")


@query("""SELECT s.s_suppkey, count(DISTINCT CASE WHEN o.o_orderstatus = 'O' THEN o.o_orderkey END) AS open_orders, count(DISTINCT CASE WHEN l.l_returnflag = 'R' THEN o.o_orderkey END) AS returned_orders,
 count(l.l_orderkey) AS line_count, max(s.s_name) AS s_name, coalesce(bool_or(l.l_quantity > 49), true) AS has_large
 FROM supplier s LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1""")
def per_owner_utilization(spark, d):
    l = T(spark, d, "lineitem").join(T(spark, d, "orders"), C("l_orderkey") == C("o_orderkey"), "left")
    # distinct orders are found by a first aggregation, so that no row is expanded for each distinct count
    per = l.groupBy("l_suppkey", "o_orderkey").agg(F.bool_or(C("o_orderstatus") == "O").alias("open"), F.bool_or(C("l_returnflag") == "R").alias("back"), n(name="k"), F.bool_or(C("l_quantity") > 49).alias("large"))
    per = per.groupBy("l_suppkey").agg(n(F.count_if(C("open") & C("o_orderkey").isNotNull()), "open_orders"), n(F.count_if(C("back") & C("o_orderkey").isNotNull()), "returned_orders"), n(F.sum("k"), "line_count"), F.bool_or("large").alias("large"))
    out = T(spark, d, "supplier").join(per, C("s_suppkey") == C("l_suppkey"), "left")
    return out.select("s_suppkey", "s_name", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("open_orders", "returned_orders", "line_count")], F.coalesce("large", F.lit(True)).alias("has_large"))


@query("""SELECT count(*) AS open_count, count(*) FILTER (WHERE r.k IS NOT NULL) AS assigned_count, count(*) FILTER (WHERE r.k IS NULL) AS unassigned_count, max(o_orderdate) AS last_date
 FROM (SELECT * FROM orders WHERE o_orderstatus = 'O') o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') r ON r.k = o.o_orderkey""")
def unassigned_summary(spark, d):
    assigned = T(spark, d, "lineitem").where("l_returnflag = 'R'")
    o = rows.flag_present(T(spark, d, "orders").where("o_orderstatus = 'O'"), assigned, {"o_orderkey": "l_orderkey"}, "has")
    return o.agg(n(name="open_count"), n(F.count_if("has"), "assigned_count"), n(F.count_if(~C("has")), "unassigned_count"), F.max("o_orderdate").alias("last_date"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
 SELECT 'left' AS side, count(*) AS n FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'right', count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def key_parity_except(spark, d):
    a = T(spark, d, "orders").where("o_orderstatus = 'F'").select(C("o_custkey").alias("k"))
    b = T(spark, d, "customer").where("c_acctbal > 0").select(C("c_custkey").alias("k"))
    return rows.key_differences(a, b, ["k"]).groupBy("side").agg(n())


@query("SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL BY NAME SELECT r_name AS name, r_regionkey AS k FROM region")
def union_by_name(spark, d):
    return T(spark, d, "nation").select(C("n_nationkey").alias("k"), C("n_name").alias("name")).unionByName(T(spark, d, "region").select(C("r_name").alias("name"), C("r_regionkey").alias("k")))


@query("SELECT count(*) AS n, count(DISTINCT o_custkey) AS keys FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def fk_violations(spark, d):
    return checks.relationships(T(spark, d, "orders"), "o_custkey", T(spark, d, "customer").where("c_nationkey < 20"), "c_custkey").agg(n(), n(F.count_distinct("o_custkey"), "keys"))


@query("SELECT count(*) AS groups, CAST(sum(c - 1) AS BIGINT) AS surplus FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def dup_key_groups(spark, d):
    return checks.unique_combination(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).agg(n(name="groups"), n(F.sum(C("count") - 1), "surplus"))


@query("""SELECT count(*) FILTER (WHERE l_discount < 0.02 OR l_discount > 0.08) AS outside, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01' OR l_shipdate >= TIMESTAMP '2000-01-01') AS out_of_time,
 count(*) FILTER (WHERE l_tax > l_discount) AS unordered, count(*) FILTER (WHERE l_returnflag IS DISTINCT FROM 'N') AS other, count(*) FILTER (WHERE l_linestatus NOT IN ('O')) AS unaccepted FROM lineitem""")
def range_checks(spark, d):
    return checks.failing(T(spark, d, "lineitem"), {
        "outside": checks.not_between("l_discount", 0.02, 0.08), "out_of_time": checks.out_of_time("l_shipdate", "1996-01-01", "2000-01-01"), "unordered": checks.exceeds("l_tax", "l_discount"),
        "other": checks.differs_from("l_returnflag", "N"), "unaccepted": checks.unaccepted("l_linestatus", ["O"]),
    })


@query("SELECT (SELECT count(*) FROM orders) AS before_count, (SELECT count(*) FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey) AS after_count, (SELECT count(*) FROM orders) <> (SELECT count(*) FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey) AS multiplied")
def row_multiplication_check(spark, d):
    o = T(spark, d, "orders")
    after = o.join(T(spark, d, "customer"), C("o_custkey") == C("c_custkey")).agg(n(name="after_count"))
    return o.agg(n(name="before_count")).crossJoin(after).withColumn("multiplied", C("before_count") != C("after_count"))


@query("SELECT c_nationkey, count(*) AS n, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS share FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1 HAVING count(*) >= 50 ORDER BY share, c_nationkey LIMIT 5")
def topk_min_group(spark, d):
    g = T(spark, d, "orders").join(T(spark, d, "customer"), C("o_custkey") == C("c_custkey")).groupBy("c_nationkey").agg(n(), numbers.share(F.count_if(C("o_orderstatus") == "F"), F.count("*")).alias("share"))
    return rows.top_groups(g, C("n"), 50, [C("share"), C("c_nationkey")], 5)


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10 OFFSET 20")
def limit_offset_pick(spark, d):
    return T(spark, d, "customer").orderBy(C("c_acctbal").desc(), "c_custkey").offset(20).limit(10).select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 200 OFFSET 100")
def hash_pick(spark, d):
    return rows.hash_pick(T(spark, d, "orders"), "o_orderkey", 200, 100).select("o_orderkey", "o_custkey", C("o_totalprice").cast("double").alias("o_totalprice"))


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_orderstatus = 'F' AND o_custkey = c_custkey")
def conditional_left_join(spark, d):
    return T(spark, d, "orders").join(T(spark, d, "customer"), (C("o_orderstatus") == "F") & (C("o_custkey") == C("c_custkey")), "left").select("o_orderkey", "c_name")


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part")
def text_slug(spark, d):
    return T(spark, d, "part").select("p_partkey", text.slugify(F.concat_ws(" / ", "p_name", "p_type")).alias("slug"))


@query("SELECT p_partkey, array_to_string(list_sort(regexp_extract_all(lower(p_type || ' ' || p_name), '[a-z0-9]+')), ' ') AS name_key FROM part")
def name_key(spark, d):
    return T(spark, d, "part").select("p_partkey", text.name_key(C("p_type"), C("p_name")).alias("name_key"))


@query("SELECT s_suppkey, 'Anna-Lena Von O''Neil' AS a, upper(substr(lower(s_name), 1, 1)) || substr(lower(s_name), 2) AS b FROM (SELECT s_suppkey, regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g') AS s_name FROM supplier)")
def title_case(spark, d):
    s = T(spark, d, "supplier").withColumn("s_name", F.lower(F.regexp_replace("s_name", "[^A-Za-z0-9]", "")))
    return s.select("s_suppkey", text.person_name(F.lit("  anna-lena  VON o'neil ")).alias("a"), text.person_name(C("s_name")).alias("b"))


@query("SELECT p_partkey, CAST(p_partkey * 1000 + p_size AS DOUBLE) AS grouped, CAST(-p_size AS DOUBLE) / 8 AS plain, CAST(NULL AS DOUBLE) AS odd FROM part")
def grouped_numbers(spark, d):
    read = lambda x: numbers.parse_decimal(x).cast("double")
    number = F.translate(F.format_number(C("p_partkey") * 1000 + C("p_size"), 0), ",", ".")
    eighth = (-C("p_size") / 8).cast("decimal(9,3)").cast("string")
    return T(spark, d, "part").select("p_partkey", read(number).alias("grouped"), read(F.when(C("p_size") % 2 == 0, eighth).otherwise(F.translate(eighth, ".", ","))).alias("plain"), read(F.concat(F.lit("+"), number)).alias("odd"))


@query("""SELECT n_nationkey, upper(lower(n_name)[1]) || lower(n_name)[2:] || ' am Main' AS city, 'Am ' || upper(lower(n_name)[1]) || lower(n_name)[2:] AS first_word, 'Van Der ' || upper(lower(n_name)[1]) || lower(n_name)[2:] AS person
 FROM (SELECT n_nationkey, regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g') AS n_name FROM nation)""")
def city_and_person_names(spark, d):
    name = F.lower(F.regexp_replace("n_name", "[^A-Za-z0-9]", ""))
    return T(spark, d, "nation").select("n_nationkey", text.city_name(F.concat(F.lit("  "), name, F.lit(" AM  main "))).alias("city"), text.city_name(F.concat(F.lit("am "), name)).alias("first_word"), text.person_name(F.concat(F.lit("van der "), F.upper(name))).alias("person"))


@query(f"""SELECT n_nationkey, {list(categories.STATES)}[CAST(n_nationkey % 16 AS INT) + 1] AS state, CASE n_nationkey % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'red' END AS light,
 CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS answer FROM nation""")
def vocabularies(spark, d):
    pick = lambda *values: F.element_at(F.array(*map(F.lit, values)), (C("n_nationkey") % len(values) + 1).cast("int"))
    return T(spark, d, "nation").select("n_nationkey", categories.federal_state(F.upper(pick(*categories.STATES))).alias("state"), categories.traffic_light(pick("GRÜN!", " gelb", "r", "y")).alias("light"), categories.parse_boolean(pick(" Ja", "0", "vielleicht")).alias("answer"))


@query("SELECT p_partkey, CAST(CAST(round(CAST(p_retailprice AS DECIMAL(14,2)) * 1000, 2) AS DECIMAL(12,2)) AS DOUBLE) AS price FROM part")
def german_number_roundtrip(spark, d):
    cents = (C("p_retailprice").cast("decimal(14,2)") * 1000).cast("decimal(14,2)")
    german = F.translate(F.format_number(cents, 2), ",.", ".,")
    return T(spark, d, "part").select("p_partkey", numbers.money(german).cast("double").alias("price"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS full_date, strftime(o_orderdate, '%Y-%m-%d') AS short_date, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start FROM orders")
def german_date_roundtrip(spark, d):
    day = C("o_orderdate")
    return T(spark, d, "orders").where(F.lit(True)).select("o_orderkey", dates.parse_flexible_date(F.date_format(day, "dd.MM.yyyy")).cast("string").alias("full_date"), F.coalesce(F.when(F.year(day) >= 2000, dates.parse_flexible_date(F.date_format(day, "d.M.yy"))), dates.parse_flexible_date(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))).cast("string").alias("short_date"), dates.parse_flexible_date(F.date_format(day, "M/yyyy"), True).cast("string").alias("month_start"))


@query("SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) % 11 AS DOUBLE) AS score, 10 AS scale, 'ratio' AS kind FROM orders")
def answer_parse(spark, d):
    a = numbers.parse_answer(F.concat((F.floor("o_totalprice").cast("bigint") % 11).cast("string"), F.lit(" /10")))
    return T(spark, d, "orders").select("o_orderkey", a["score"].cast("double").alias("score"), a["scale"].cast("int").alias("scale"), a["kind"].alias("kind"))


@query("SELECT event_id, CAST(timezone('UTC', timezone('Europe/Berlin', ts)) AS TIMESTAMP) AS utc FROM events")
def berlin_local_utc(spark, d):
    return T(spark, d, "events").select("event_id", dates.local_to_utc(C("ts").cast("timestamp_ntz")).alias("utc"))


@query("SELECT DISTINCT strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter_start, strftime(o_orderdate, '%Y') || '-Q' || quarter(o_orderdate) AS quarter_label FROM orders")
def quarter_label(spark, d):
    return T(spark, d, "orders").select(dates.quarter_start(C("o_orderdate")).cast("string").alias("quarter_start"), dates.quarter_label(C("o_orderdate")).alias("quarter_label")).distinct()


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, d):
    return T(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT p_partkey, i AS module_order, p_brand || '-' || i AS module_id FROM part, unnest(range(CAST(p_size % 4 AS BIGINT))) AS t(i)")
def json_array_explode(spark, d):
    modules = F.to_json(F.struct(F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < C("p_size") % 4), lambda i: F.struct(i.alias("module_order"), F.concat_ws("-", "p_brand", i).alias("module_id"))).alias("modules")))
    parsed = F.from_json(F.get_json_object(modules, "$.modules"), "array<struct<module_order: bigint, module_id: string>>")
    return T(spark, d, "part").select("p_partkey", F.explode(parsed).alias("m")).select("p_partkey", "m.module_order", "m.module_id")


@query("SELECT l_orderkey, l_linenumber, sha256(concat_ws('|', l_orderkey, l_partkey, l_linenumber)) AS id FROM lineitem")
def stable_row_id(spark, d):
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ids.stable_id(C("l_orderkey"), C("l_partkey"), C("l_linenumber")).alias("id"))


@query("""SELECT array_to_string(list_filter([CASE WHEN k > 1 THEN 'duplicate_source_id' END, CASE WHEN p > 1 THEN 'exact_duplicate_source_payload' END, CASE WHEN l_quantity > 45 THEN 'large' END], lambda f: f IS NOT NULL), ',') AS flags, count(*) AS n
 FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS k, count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag) AS p FROM lineitem) GROUP BY 1""")
def duplicate_flags(spark, d):
    from pyspark.sql.window import Window

    l = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    k, p = F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber")), F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber", "l_returnflag"))
    issues = F.filter(F.array(F.when(C("l_quantity") > 45, F.struct(F.lit("large").alias("rule")))), lambda x: x.isNotNull())
    made = checks.flags(issues, F.array(F.when(C("k") > 1, "duplicate_source_id"), F.when(C("p") > 1, "exact_duplicate_source_payload")))
    return l.withColumns({"k": k, "p": p}).select(F.array_join(made, ",").alias("flags")).groupBy("flags").agg(n())


@query("SELECT CASE WHEN o_totalprice > 400000 THEN 'quarantined' WHEN o_totalprice > 300000 OR o_orderstatus = 'P' THEN 'review' ELSE 'valid' END AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, d):
    issue = lambda when, rule, severity: F.when(when, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity")))
    issues = F.array_compact(F.array(issue(C("o_totalprice") > 400000, "huge", "error"), issue(C("o_totalprice") > 300000, "large", "review"), issue(C("o_orderstatus") == "P", "pending", "review")))
    return T(spark, d, "orders").select(checks.statuses(issues).alias("status")).groupBy("status").agg(n())


@query("SELECT c_nationkey, arg_min(CAST(c_custkey AS VARCHAR), (length(CAST(c_custkey AS VARCHAR)), CAST(c_custkey AS VARCHAR))) AS canonical_id FROM customer GROUP BY 1")
def canonical_id(spark, d):
    return T(spark, d, "customer").groupBy("c_nationkey").agg(ids.least_by_length(C("c_custkey").cast("string")).alias("canonical_id"))


@query("SELECT coalesce(o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'), false) AS has_reference, count(*) AS n FROM orders GROUP BY 1")
def reference_flags(spark, d):
    building = T(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    return rows.flag_present(T(spark, d, "orders"), building, {"o_custkey": "c_custkey"}, "has_reference").groupBy("has_reference").agg(n())


@query("""WITH a AS (SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey END AS k1, s_nationkey AS k2, CASE WHEN s_suppkey % 2 = 0 THEN CAST(floor(s_acctbal / 500) AS BIGINT) END AS k3 FROM supplier),
 c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 1 THEN c_custkey ELSE c_custkey - c_custkey % 4 END AS k1, c_nationkey AS k2, CAST(floor(c_acctbal / 500) AS BIGINT) AS k3 FROM customer),
 r1 AS (SELECT row_id, count(DISTINCT id) AS n, min(id) AS id FROM a JOIN c USING (k1) GROUP BY 1),
 r2 AS (SELECT row_id, count(DISTINCT id) AS n, min(id) AS id FROM a JOIN c USING (k2, k3) GROUP BY 1),
 r3 AS (SELECT row_id, count(DISTINCT id) AS n, min(id) AS id FROM (SELECT * FROM a WHERE k3 IS NULL) a JOIN c USING (k2) GROUP BY 1)
 SELECT a.row_id, CASE WHEN r1.n = 1 OR r2.n = 1 OR r3.n = 1 AND coalesce(r2.n, 0) = 0 THEN CASE WHEN r1.n = 1 THEN 'matched' WHEN r2.n = 1 THEN 'matched' WHEN coalesce(r2.n, 0) > 1 THEN 'ambiguous' ELSE 'matched' END
  WHEN greatest(coalesce(r1.n, 0), coalesce(r2.n, 0), coalesce(r3.n, 0)) > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status,
  CASE WHEN r1.n = 1 THEN 'unique_key' WHEN r2.n = 1 THEN 'two_keys' WHEN coalesce(r2.n, 0) = 0 AND r3.n = 1 THEN 'one_key' END AS method,
  CASE WHEN r1.n = 1 THEN r1.id WHEN r2.n = 1 THEN r2.id WHEN coalesce(r2.n, 0) = 0 AND r3.n = 1 THEN r3.id END AS matched_id
 FROM a LEFT JOIN r1 USING (row_id) LEFT JOIN r2 USING (row_id) LEFT JOIN r3 USING (row_id)""")
def match_ladder(spark, d):
    a = T(spark, d, "supplier").select(C("s_suppkey").alias("row_id"), F.when(C("s_suppkey") % 3 == 0, C("s_suppkey")).alias("k1"), C("s_nationkey").alias("k2"), F.when(C("s_suppkey") % 2 == 0, F.floor(C("s_acctbal") / 500).cast("bigint")).alias("k3"))
    c = T(spark, d, "customer").select(C("c_custkey").alias("id"), F.when(C("c_custkey") % 2 == 1, C("c_custkey")).otherwise(C("c_custkey") - C("c_custkey") % 4).alias("k1"), C("c_nationkey").alias("k2"), F.floor(C("c_acctbal") / 500).cast("bigint").alias("k3"))
    rungs = [match.Rung("unique_key", ["k1"]), match.Rung("two_keys", ["k2", "k3"], stop_if_many=True), match.Rung("one_key", ["k2"], C("k3").isNull())]
    return match.ladder(a, c, "row_id", "id", rungs).select("row_id", "status", "method", C("matched_id"))


@query("""WITH m AS (SELECT max(ts) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-15'), stored AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15')
 SELECT event_id, user_id, ts FROM events e, m WHERE e.ts >= m.mark AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.ts = m.mark AND s.event_id = e.event_id AND s.ts = e.ts)""")
def watermark_boundary(spark, d):
    e = T(spark, d, "events").select("event_id", "user_id", "ts")
    stored = e.where(C("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    mark = stored.agg(F.max("ts")).first()[0]  # one value, so that the scan gets a literal to push down
    return rows.beyond_watermark(e, stored, "ts", mark)


@query("SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderkey % 2 = 0 AND o_orderdate >= TIMESTAMP '1999-01-01' AS changed FROM orders")
def incremental_merge(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", F.lit(False).alias("changed"))
    batch = o.where((C("o_orderkey") % 2 == 0) & (C("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))).withColumn("changed", F.lit(True))
    return rows.merge_by_key(o, batch, ["o_orderkey"])


@query(f"SELECT seg, measure, value FROM (UNPIVOT (SELECT seg, behind_share, average_share FROM ({SUMMARY})) ON behind_share, average_share INTO NAME measure VALUE value)")
def unpivot_measures(spark, d):
    return progress_summary_union(spark, d).unpivot("seg", ["behind_share", "average_share"], "measure", "value").where("value is not null")


@query("""SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), '<null>'), coalesce(CAST(o_orderdate AS VARCHAR), '<null>'), coalesce(CAST(o_orderkey AS VARCHAR), '<null>'),
 coalesce(o_orderpriority, '<null>'), coalesce(o_orderstatus, '<null>'), coalesce(CAST(o_totalprice AS VARCHAR), '<null>'))), 1, 15) AS UBIGINT)) AS VARCHAR) AS checksum FROM orders""")
def table_checksum(spark, d):
    return T(spark, d, "orders").agg(n(name="row_count"), ids.table_checksum(T(spark, d, "orders")).cast("string").alias("checksum"))
