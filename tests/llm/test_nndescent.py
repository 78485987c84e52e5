import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import nndescent
from tallyworks.llm.vectors import usable


def clustered(n, seed=5, groups=10, d=64):
    """Unit vectors about as hard as the given ones: the neighbours of a vector are hardly nearer than the rest of its group."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, d))[rng.integers(0, groups, n)] * 0.6 + rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


def recall(rows, x, every=20, top=20):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in range(0, len(x), every):
        s = x.astype(np.float64) @ x[q].astype(np.float64)
        s[q] = -np.inf
        want = set(np.argsort(-s, kind="stable")[:top].tolist())
        hit, total = hit + len(want & got.get(q, set())), total + len(want)
    return hit / total


@pytest.fixture(scope="module")
def vectors(spark):
    x = clustered(4000)
    return x, frame(spark, x).cache()


def test_rounds_make_the_graph(spark, vectors):
    """Without rounds of NN-descent the same search finds far less."""
    x, df = vectors
    least = {}
    for rounds in (0, 40):
        nodes, packed, n = nndescent.build(usable(df), rounds=rounds, block=128)
        edges = nodes.select(F.col("u").alias("query_id"), F.inline("near")).select("query_id", F.col("w").alias("vec_id"), "sim").where("query_id % 20 = 0")
        best = edges.groupBy("query_id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("sim", "vec_id")))), 1, 20).alias("b"))
        least[rounds] = recall(best.select("query_id", F.inline("b")).collect(), x)
    assert least[0] < 0.2 and least[40] > 0.7


def test_recall_of_the_query(spark, vectors):
    x, df = vectors
    assert recall(nndescent.nearest(df, block=128).collect(), x) >= 0.95


def test_large_groups_of_equal_vectors(spark):
    x = clustered(60)
    x = np.vstack([x[:1]] * 500 + [x])
    got = {}
    for r in nndescent.nearest(frame(spark, x)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 560, 20))
    for q, found in got.items():
        s = x.astype(np.float64) @ x[q].astype(np.float64)
        s[q] = -np.inf
        want = sorted(range(len(x)), key=lambda i: (-round(s[i], 12), i))[:20]
        assert [i for _, i, _ in sorted(found)] == want
