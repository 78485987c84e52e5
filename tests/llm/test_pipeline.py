import os
import time
from collections import Counter

import corpus_pipeline
import pytest
from tallyworks.llm import common, mixing, packing, quality, shingles

from .test_linedup import plain as plain_lines
from .test_packing import held
from .test_simhash import plain_components, plain_fp

D = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    made = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, D).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        made.append(docs.collect())
    good, lines, single, mixed, packed = made
    scores = {r.doc_id: r.predicted for r in quality.op9_quality(spark, D).collect()}
    assert {r.doc_id for r in good} == {i for i, p in scores.items() if p}
    assert sorted((r.doc_id, r.text) for r in lines) == sorted((i, t) for i, t, _, _ in plain_lines([(r.doc_id, r.text) for r in good]))
    fp = {r.doc_id: plain_fp(r.text) for r in lines}
    root = plain_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 2])
    assert sorted(r.doc_id for r in single) == sorted(i for i in root if root[i] == i)
    words = Counter({r.doc_id: len(r.text.encode().split()) for r in single})
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(words) and max(copies.values()) <= 3
    total = sum(words.values())
    assert 0.8 * total < sum(words[i] * n for i, n in copies.items()) <= total
    held(packed, packing.CAPACITY, packing.PER_SOURCE)
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.size
    assert got == Counter({i: words[i] * n for i, n in copies.items()})
    assert [tuple(r)[0:2] for r in sorted(corpus_pipeline.run(spark, D).collect())] == [tuple(r)[0:2] for r in sorted(packed)]


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "Some words of a text.\nAnd more of them here.", "en", None, 9), (2, "Some words of a text.\nAnd more of them here.", "en", None, 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).write.mode("overwrite").parquet(f"{tmp_path}/{len(some)}{name}")
            docs = spark.read.parquet(f"{tmp_path}/{len(some)}{name}")
        assert docs.count() == (2 if some else 0)


def test_repeated_rows_are_mixed_as_one_document(spark):
    """A row that comes 320 times: as many words go out as the mix takes, not as many for each row."""
    rows = [(1, "one two three four five", "en", "a", 23)] * 320 + [(2, "x " * 5, "en", None, 10)] * 3 + [(i, f"w{i} " * 10, "de", "b", 40) for i in range(10, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r[0]: r[1] for r in mixing.mix(docs).groupBy("doc_id").sum("taken").collect()}
    words = Counter()
    for r in corpus_pipeline.mix_sources(spark, docs, "").collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({i: n for i, n in taken.items() if n}) and sum(words.values()) <= 320 * 5 + 3 * 5 + 400


def test_near_duplicates_leave_little_on_disk(spark, tmp_path, monkeypatch):
    """What the stage's tables leave is less than a fifth of the texts."""
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path / "shared"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.write.option("compression", "zstd").parquet(f"{tmp_path}/docs")
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet"))
    single = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert size("shared") < 0.2 * size("docs")
    assert 0 < single.count() < docs.count()


def shuffled(spark):
    """Bytes that all tasks so far have written for shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    time.sleep(0.5)
    spark.range(1).foreach(lambda _: None)  # the store takes up what came since its last update
    sc.listenerBus().waitUntilEmpty(30_000)
    executors = sc.statusStore().executorList(False)
    return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))


@pytest.fixture
def as_if_large(spark):
    """Spark broadcasts nothing by itself."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def random_texts(spark, tmp_path, n=600):
    """(documents, bytes of their texts): texts that hardly compress, and near copies of two of them."""
    rows = [(i, " ".join(os.urandom(60).hex() for _ in range(60)), "en", "ab"[i % 2], 0) for i in range(n)]
    rows += [(n + i, rows[i][1] + " and more", "en", "a", 0) for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/random")
    # hexadecimal digits hold half a byte each
    return spark.read.parquet(f"{tmp_path}/random"), sum(len(r[1]) for r in rows) / 2


def test_mixing_shuffles_texts_once(spark, tmp_path, as_if_large):
    docs, size = random_texts(spark, tmp_path)
    before = shuffled(spark)
    assert corpus_pipeline.mix_sources(spark, docs, "").agg({"text": "max"}).first()[0]
    once = shuffled(spark)
    docs.groupBy("doc_id").agg({"text": "max"}).agg({"max(text)": "max"}).first()
    of_one = shuffled(spark) - once
    assert of_one >= size and once - before < 1.5 * of_one


def test_mixing_takes_rows_without_an_id_and_the_least_of_repeated_ones(spark):
    rows = [(None, "one two three", "en", "a", 1), (None, "four five six", None, "a", 2), (None, None, "en", "a", 0), (1, "a b c", "en", "a", 9), (1, "a b c", "de", "a", 9)]
    got = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").collect()
    # of a single source the mix takes every row once
    assert Counter(map(tuple, got)) == Counter({rows[0]: 1, rows[1]: 1, rows[4]: 2})


def test_near_links_send_candidates_only(spark, tmp_path, monkeypatch, as_if_large):
    """Texts that are no candidates stay where they are; beyond HELD the links are the same."""
    docs, size = random_texts(spark, tmp_path)
    before = shuffled(spark)
    got = sorted(map(tuple, shingles.near_links(docs).collect()))
    assert shuffled(spark) - before < 0.5 * size
    monkeypatch.setattr(shingles, "HELD", 0)
    assert sorted(map(tuple, shingles.near_links(docs).collect())) == got and len(got) == 2
