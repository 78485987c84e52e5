import duckdb
import pytest

from tallyworks.plans import assertions, model_queries
from tallyworks.plans.models import MODELS, Context

from .test_catalog import D, TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{D}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(model_queries.SQL))
def test_model_equals_sql(spark, duck, name):
    df = model_queries.QUERIES[name](spark, D)
    got = sorted((tuple(r) for r in df.collect()), key=str)
    want = sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({model_queries.SQL[name]})").fetchall(), key=str)
    assert got and got == want


def test_every_model_has_a_query():
    assert {f"model_{m}" for m in MODELS} <= {*model_queries.SQL}


def test_assertions_hold_and_break(spark):
    c = Context(model_queries.inputs(spark, D), model_queries.AS_OF)
    assert assertions.broken(c) == {}
    twice = c.inputs["enrollments"]
    c.inputs["enrollments"] = twice.unionByName(twice.where("not is_quarantined and enrollment_id <= '2'"))
    c = Context(c.inputs, c.reporting_date)
    use = c["rpt_coach_utilization"]
    c.built["rpt_coach_utilization"] = use.withColumns({"red_enrollment_count": use.active_or_paused_enrollment_count + 1, "reporting_date": use.coach_snapshot_date - 9})
    assert {"one row an enrollment", "parts do not exceed their wholes", "reports are as of the cutoff"} <= {*assertions.broken(c)}


def test_marts_carry_no_personal_data(spark):
    c = Context(model_queries.inputs(spark, D), model_queries.AS_OF)
    private = {"email", "birth_date", "birth_date_unparsed_raw", "answer_value", "notizen", "notizen_raw", "email_raw", "teilnehmer_raw"}
    for name in MODELS:
        if not name.startswith("int_"):
            assert not private & {*c[name].columns}, name
