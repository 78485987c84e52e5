from tallyworks.llm import linedup

from . import oracle

SCHEMA = "doc_id long, text string, n_lines string, id int"


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    oracle.same(linedup.op8_line_dedup(spark, d), linedup.OP8_SQL, d)


def plain(rows, least=10):
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip(" \t\n\x0b\f\r"))
    owner = {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= least and i is not None:
                owner.setdefault(key(s), set()).add(i)
    out = []
    for i, t in rows:
        kept = [s for s in (t or "").split("\n") if i is None or len(key(s)) < least or min(owner[key(s)]) == i]
        n = (t or "").count("\n") + 1
        out.append((i, "\n".join(kept), n, n - len(kept)))
    return sorted(out, key=str)


def test_odd_rows_in_any_number_of_batches(spark):
    long = "\n".join(f"line number {i % 700} here" for i in range(3000))
    rows = [(5, "Shared LINE here\nÄown line of five"), (2, " shared line HERE\t\nshort\nshort"), (7, "shared line here\n\nx"), (None, "shared line here"), (9, None), (4, ""), (4, "shared line here"), (11, long), (12, long), (12, long), (1, "äOWN LINE OF FIVE\n")]
    for batches in (1, 2, 5):
        df = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA)
        got = linedup.dedup_lines(df, batches)
        assert got.columns == ["doc_id", "text", "id", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()), key=str) == plain(rows)
    assert linedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_compacted_and_found_again(spark):
    runs = linedup.LineRuns(spark, fanout=2, buckets=3)
    for i in range(5):
        runs.dedup(spark.createDataFrame([(i, f"a line of batch {i}\nthe common line")], "doc_id long, text string")).collect()
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    again = linedup.LineRuns(spark, runs.root).open()
    assert [len(x) for x in again.levels] == [1, 0, 1] and again.buckets == 3
    out = again.dedup(spark.createDataFrame([(99, "the common line\na line of batch 3\nall new to it")], "doc_id long, text string"))
    assert out.first().text == "all new to it"
    plan = again.owners(spark.createDataFrame([(1, 2)], "h1 long, h2 long"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Bucketed: true")
