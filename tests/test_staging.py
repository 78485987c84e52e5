import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import data_tests, rebuild, staging
from tallyworks.plans.runner import CURATED
from tallyworks.sources.contract import Contract, SchemaViolation
from tallyworks.sources.lake import Lake

EVENT = "event_id string, enrollment_id string, module_id string, event_kind string, is_event_type_valid boolean, has_enrollment boolean, has_module boolean, enrolled_training string, module_training string, is_module_in_training boolean, is_before_start boolean, event_time string, event_at_utc timestamp, _source_as_of string, _run_id string, _ingested_at timestamp, payload_hash string, quality_flags array<string>, validation_status string, is_quarantined boolean"
NAME = "stg_progress_events"


def event(key, at, payload, day, kind="quiz_passed"):
    when = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=at)
    return (key, "e", "m", kind, True, True, True, "T", "T", True, False, "text", when, None, f"run-{day}", dt.datetime(2026, 2, day), payload, [], "valid", False)


def put(lake, spark, day, rows, extra=None):
    df = spark.createDataFrame(rows, EVENT)
    lake.replace_snapshot("curated_progress_events", f"2026-02-{day:02d}", df if extra is None else df.withColumn(extra, F.lit("new")))
    lake.upsert("meta_curation_log", spark.createDataFrame([(f"2026-02-{day:02d}", "progress_events", "r", len(rows))], CURATED), ["snapshot_date", "dataset"], buckets=1)


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def fresh(lake):
    """What a build over the whole history would give."""
    return staging.specs()[NAME].latest(staging.source(lake, NAME, staging.days(lake, "progress_events")))


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_equals_full_whatever_comes(spark, tmp_path, seed):
    """Older versions in newer days, days that are replaced, rows that vanish from them, rows without a key, repeated rows."""
    rng = random.Random(seed)
    lake = Lake(spark, str(tmp_path))
    some = lambda day, n: [event(rng.choice([None, *map(str, range(12))]), rng.randrange(50), f"p{rng.randrange(6)}", day) for _ in range(n)]
    for day, replace in ((1, False), (2, False), (2, True), (4, False), (5, False), (4, True)):
        put(lake, spark, day, some(day, 14))
        # a day before the newest that is replaced takes a build from that day on
        lake.publish(staging.refresh(lake, NAME, from_day=f"2026-02-{day:02d}" if replace else None))
        assert content(lake.read(NAME)) == content(fresh(lake)), (seed, day)
    before = lake.read(NAME)
    lake.publish(staging.refresh(lake, NAME))
    assert content(lake.read(NAME)) == content(before)
    lake.publish(staging.refresh(lake, NAME, full=True))
    assert content(lake.read(NAME)) == content(before)


def test_only_new_days_and_touched_buckets(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    put(lake, spark, 1, [event(str(i), i, "p", 1) for i in range(200)])
    lake.publish(staging.refresh(lake, NAME))
    put(lake, spark, 2, [event("7", 500, "q", 2)], extra="unknown_column")
    first, read = lake.files(NAME), []
    real = lake.read_days
    lake.read_days = lambda name, days: read.append(real(name, days)) or read[-1]
    lake.publish(staging.refresh(lake, NAME, from_day="2026-02-02"))
    assert len(read) == 1 and all("curated_progress_events@2026-02-02" in f for f in read[0].inputFiles())
    changed = {k for k, p in lake.files(NAME).items() if first.get(k) != p}
    assert len(first) > 20 and len(changed) == 1
    assert {r.event_id: r.payload_hash for r in lake.read(NAME).collect()}["7"] == "q" and lake.read(NAME).count() == 200
    # the default begins with the newest day that is held
    assert staging.newest_day(lake, NAME) == "2026-02-02"
    assert "unknown_column" not in lake.read(NAME).columns


def test_the_log_decides_what_is_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(LookupError, match="names no day"):
        staging.refresh(lake, NAME)
    put(lake, spark, 1, [event("1", 1, "p", 1)])
    lake.replace_snapshot("curated_progress_events", "2026-02-03", spark.createDataFrame([event("2", 1, "p", 3)], EVENT))
    assert [r.event_id for r in staging.source(lake, NAME, staging.days(lake, "progress_events")).collect()] == ["1"]
    put(lake, spark, 2, [event("3", 1, "p", 2)], extra="since_day_two")
    days = lake.read_days("curated_progress_events", staging.days(lake, "progress_events"))
    assert {(r.event_id, r.since_day_two) for r in days.collect()} == {("1", None), ("3", "new")}
    lake.commit({"curated_progress_events@2026-02-02": None})
    with pytest.raises(KeyError):
        staging.source(lake, NAME, staging.days(lake, "progress_events"))


def test_contracts_stop_commits(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    contract = Contract({"id": "int!", "price": "decimal(5,2)", "day": "date", "tags": "array<string>!"})
    good = spark.createDataFrame([(1, "1.50", "2026-01-01", ["a"])], "id int, price string, day string, tags array<string>").select("id", F.col("price").cast("decimal(5,2)").alias("price"), F.col("day").cast("date").alias("day"), "tags")
    lake.commit({"t": good.select("tags", "day", "price", "id")}, {"t": contract})
    assert lake.read("t").columns == ["id", "price", "day", "tags"]
    live = lake.files("t")
    wrong = {
        "a number as text": good.withColumn("id", F.col("id").cast("string")), "a wide number": good.withColumn("id", F.lit(2**40)), "a wide decimal": good.withColumn("price", F.lit("1000.00").cast("decimal(6,2)")),
        "a date as text": good.withColumn("day", F.lit("2026-01-01")), "no value": good.withColumn("id", F.lit(None).cast("int")), "no list": good.withColumn("tags", F.lit(None).cast("array<string>")),
        "a text for a list": good.withColumn("tags", F.lit("a")), "one too many": good.withColumn("more", F.lit(1)), "one too few": good.drop("day"),
    }
    for case, df in wrong.items():
        with pytest.raises(SchemaViolation):
            lake.commit({"t": df}, {"t": contract})
        assert lake.files("t") == live, case
    with pytest.raises(SchemaViolation, match="missing"):
        Contract({"id": "int!"}, open=True).enforce(good.drop("id"))
    assert "price" in Contract({"id": "int!"}, open=True).enforce(good).columns


def test_buckets_and_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(500).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    lake.upsert("t", rows, ["k"])
    one = lake.versions()[-1]
    before = lake.files("t")
    lake.upsert("t", spark.createDataFrame([(3, "b"), (1000, "c")], "k int, v string"), ["k"])
    after = lake.files("t")
    assert 1 <= len({k for k in after if after[k] != before.get(k)}) <= 2 and lake.read("t").count() == 501
    assert {r.v for r in lake.read("t").where("k in (3, 1000)").collect()} == {"b", "c"}
    old = lake.at(one)
    assert old.read("t").count() == 500 and {r.v for r in old.read("t").collect()} == {"a"}
    found = rebuild.differences(rebuild.fingerprints(old, ["t"]), rebuild.fingerprints(lake, ["t", "none"]))
    assert found == ["t: 500 rows, then 501"] and rebuild.differences(rebuild.fingerprints(old, ["t"]), rebuild.fingerprints(old, ["t"])) == []
    with pytest.raises(RuntimeError):
        old.commit({"t": None})
    with pytest.raises(KeyError):
        lake.at(99).read("t")
    assert lake.vacuum() and lake.read("t").count() == 501


def test_rules(spark):
    t = spark.createDataFrame([(1, "a", 5), (1, "b", 11), (2, None, 3), (None, "z", None)], "id int, kind string, n int")
    parent = spark.createDataFrame([("a",), ("b",)], "kind string")
    every = [*data_tests.there("t", "id"), *data_tests.unique("t", "id"), *data_tests.accepted("t", "kind", ("a", "b")), *data_tests.between("t", 4, 10, "n"), *data_tests.refers("t", "kind", "p", severity="warn", where="id is not null"), *data_tests.refers("t", "kind", "p")]
    got = [tuple(r) for r in data_tests.evaluate({"t": t, "p": parent}.get, every).collect()]
    assert sorted(got) == sorted([("t", "id not null", "error", 1), ("t", "id unique", "error", 1), ("t", "kind accepted", "warn", 1), ("t", "n in range", "error", 2), ("t", "kind in p", "warn", 0), ("t", "kind in p", "error", 1)])
    assert data_tests.evaluate({"t": t.limit(0), "p": parent.limit(0)}.get, every).where("failures > 0").count() == 0
