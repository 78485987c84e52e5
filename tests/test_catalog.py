import duckdb
import pytest

from tallyworks.plans import catalog

D = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{D}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, D)
    got = sorted((tuple(r) for r in df.collect()), key=str)
    want = sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.SQL[name]})").fetchall(), key=str)
    assert got == want


def test_union_and_rollup_agree_and_checksum_ignores_order(spark):
    both = [sorted(map(str, catalog.QUERIES[q](spark, D).select("seg", "is_total", "row_count", "average_share").collect())) for q in ("progress_summary_union", "progress_summary_rollup")]
    assert both[0] == both[1]
    assert catalog.QUERIES["table_checksum"](spark, D).collect() == catalog.QUERIES["table_checksum"](spark, D).collect()


def test_hash_pick_is_the_same_for_any_partitions_and_takes_null_keys(spark):
    from tallyworks.operators import rows

    df = spark.createDataFrame([(i % 40 or None, i) for i in range(80)], "k long, v long").dropDuplicates(["k"]).select("k")
    picks = [[r.k for r in rows.hash_pick(df.repartition(p), "k", 7, 3).collect()] for p in (1, 5)]
    assert picks[0] == picks[1] and len(picks[0]) == 7
    assert len(rows.hash_pick(df, "k", 100, 0).collect()) == 40 and rows.hash_pick(df.where("false"), "k", 3).count() == 0


def test_a_running_quarter(spark):
    from pyspark.sql import functions as F

    from tallyworks.functions import dates

    df = spark.createDataFrame([("2026-06-30",), ("2026-07-01",), ("2026-10-01",), (None,)], "x string")
    got = [r[0] for r in df.select(dates.in_running_quarter(F.col("x"), F.lit("2026-08-31"))).collect()]
    assert got == [False, True, True, None]
