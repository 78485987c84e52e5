from pyspark.sql import functions as F

from tallyworks.llm import linedup

from .test_linedup import plain


def test_a_line_in_every_document_and_clashing_names(spark):
    rows = [(i, f"the line of every document\nonly in text {i}\nshared by {i // 2} and its twin") for i in range(300)]
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], "doc_id long, text string, id string, th string, goes string")
    got = linedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "id", "th", "goes", "n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()), key=str) == plain(rows)
    assert got.where("id <> 'a' or th <> 'b' or goes <> 'c'").isEmpty()


def test_no_run_is_left_in_the_catalog_and_texts_are_not_sorted(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("the common line\nline "), F.col("id").cast("string")).alias("text"))
    runs = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("tallyworks_run_")}
    before = runs()
    out = linedup.dedup_lines(df)
    assert out.where("n_dropped = 1").count() == 49
    assert runs() == before
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortAggregate", "")
