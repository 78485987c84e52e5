import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tallyworks.llm import nndescent, vamana

from . import oracle


def fixture(folder, n=1500):
    """Groups of near and exact copies, chains of links, and vectors that take no part."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 32))
    near = x[rng.integers(0, 40, 500)] + rng.normal(size=(500, 32)) * rng.uniform(0.02, 0.5, size=(500, 1))
    chain = [x[50]]
    for _ in range(60):  # each links with the next ones only
        chain.append(chain[-1] + rng.normal(size=32) * 0.25)
    x = np.vstack([x, near, chain, x[:30], x[:5]]).astype(np.float32)
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(len(x)), x, strict=True)]
    nan, inf = float("nan"), float("inf")
    rows += [(9000, None), (9001, [0.0] * 32), (9002, [nan] + [1.0] * 31), (9003, [inf] + [1.0] * 31), (9004, [None] + [1.0] * 31), (9005, [0.0] * 32), (9006, [nan] + [1.0] * 31)]
    ids, vecs = zip(*rows, strict=True)
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vecs, pa.list_(pa.float32())), "label": pa.array([0] * len(rows), pa.int32())}), f"{folder}/embeddings.parquet")
    for name in set(oracle.TABLES) - {"embeddings"}:
        pq.write_table(pa.table({"x": [1]}), f"{folder}/{name}.parquet")
    return rows


def test_query_equals_sql_where_there_are_links(spark, tmp_path):
    fixture(tmp_path)
    got = vamana.op1_vamana(spark, str(tmp_path))
    assert got.where("n_links > 5").count() > 100
    oracle.same(got, vamana.OP1_SQL, tmp_path)


def test_nearest_on_the_same_vectors(spark, tmp_path):
    rows = fixture(tmp_path)
    vecs = {i: np.array(v, float) for i, v in rows if i < 9000}
    ids = np.array(sorted(vecs))
    x = np.array([vecs[i] for i in ids])
    got = {}
    for r in nndescent.op7_nearest(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {i for i in vecs if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        s = x @ vecs[q]
        s[ids == q] = -np.inf
        hit += (s[np.searchsorted(ids, found)] >= np.sort(s)[-20] - 1e-9).sum()
    assert hit / (20 * len(got)) >= 0.95
