import itertools

import numpy as np

from tallyworks.llm import quality

D = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    counts, trans = np.array([1, 4, 3, 1]), rng.normal(size=(2, 2))
    odds = rng.normal(size=counts.sum())
    got, pairs = quality._marginals(odds, trans, counts)
    want, both, at = [], np.zeros((2, 2)), 0
    for n in counts:
        p, z, own = np.zeros(n), 0.0, np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(odds[at + t] * y[t] for t in range(n)) + sum(trans[y[t - 1], y[t]] for t in range(1, n)))
            z += s
            p += s * np.array(y)
            for t in range(1, n):
                own[y[t - 1], y[t]] += s
        want += list(p / z)
        both += own / z
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, both)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality.op9_quality(spark, D).collect()}
    assert len(got) == spark.read.parquet(f"{D}/documents.parquet").count()
    pairs = [(got[r.doc_id].score, got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{D}/labels.parquet").collect() if got[r.doc_id].held_out]
    good, bad = [s for s, _, q in pairs if q], [s for s, _, q in pairs if not q]
    assert good and bad and all(0 <= s <= 1 for s, _, _ in pairs)
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    assert np.mean([p for _, p, q in pairs if q]) > 0.95 and np.mean([p for _, p, q in pairs if not q]) < 0.4


def test_lines_taken_are_bounded_and_repeated_ids_defined(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("plain words in a line\n" if i % 2 else "!!! ### BAD BAD\n") * 30) for i in range(1, 60)] + [(1, "another text of one")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    whole = quality.train(docs, labels)
    assert np.allclose(whole.weights, quality.train(docs.repartition(5), labels).weights)
    monkeypatch.setattr(quality, "LINES", 100)
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda lev, *a: seen.append(len(lev)) or fit(lev, *a))
    quality.train(docs, labels)
    assert 100 < seen[0] <= 200


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x", 0.5), (3, "Some plain words here.\n" * 20000, 0.5), (3, "THE!! THE!! " * 30, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1), (2, None)], "doc_id long, quality int")
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored) and scored[0].score == scored[1].score
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).count() == 0


def test_rounds_are_cut_by_bytes_and_rows():
    sizes = np.array([0.0, 3e6, 3e6, 9e6, 1.0, 1.0])
    assert quality.rounds(sizes) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert quality.rounds(np.zeros(1100)) == [(0, 512), (512, 1024), (1024, 1100)] and quality.rounds(np.empty(0)) == []
