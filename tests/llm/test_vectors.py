import numpy as np

from tallyworks.llm import common, nndescent, vamana

from .test_simhash import plain_components

SCHEMA = "vec_id long, embedding array<float>, id string"


def table(seed=3, n=300, near=200):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    x = np.vstack([x, x[rng.integers(0, 5, near)] + rng.normal(size=(near, 16)) * 0.25, x[:3]])
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x.astype(np.float32))]
    nan, inf = float("nan"), float("inf")
    return rows + [(9000, None, "x"), (9001, [0.0] * 16, "x"), (9002, [nan] + [1.0] * 15, "x"), (9003, [inf] + [1.0] * 15, None), (9004, [None] + [1.0] * 15, "x"), (9005, [], "x"), (9006, [1.0], "x"), (None, [1.0] * 16, "x"), rows[0], rows[7]]


def usable(rows):
    return {i: np.array(v, np.float64) for i, v, _ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}


def test_links_equal_brute_force(spark):
    rows = table()
    vecs = usable(rows)
    ids = sorted(vecs)
    x = np.array([vecs[i] for i in ids])
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T >= 0.95
    np.fill_diagonal(s, False)
    root = plain_components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(s), strict=True)])
    want = {i: (int(n), root[i]) for i, n in zip(ids, s.sum(axis=1), strict=True)}
    df = spark.createDataFrame(rows, SCHEMA)
    for block in (vamana.BLOCK, 60):
        got = vamana.link(df, block=block).collect()
        assert len(got) == len({r[0] for r in rows})
        for r in got:
            n, comp = want.get(r.vec_id, (0, r.vec_id))
            assert r.n_links <= n and r.component_id == comp and r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
        assert sum(r.n_links for r in got) >= 0.99 * sum(n for n, _ in want.values())
    assert vamana.link(df.limit(0)).count() == 0


def test_search_recall_and_odd_rows(spark):
    rows = table(n=1500)
    vecs = usable(rows)
    ids = np.array(sorted(vecs))
    x = np.array([vecs[i] for i in ids])
    got = {}
    for r in nndescent.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in vecs if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        found.sort()
        s = x @ vecs[q]
        s[ids == q] = -np.inf
        assert [r for r, _, _ in found] == list(range(1, 21)) and [(-v, i) for _, i, v in found] == sorted((-v, i) for _, i, v in found)
        assert all(abs(v - vecs[i] @ vecs[q]) < 1e-9 for _, i, v in found)
        hit += len({i for _, i, _ in found} & set(ids[np.argsort(-s)[:20]]))
    assert hit / (20 * len(got)) >= 0.9
    few = spark.createDataFrame(rows[:5] + rows[-4:-2], SCHEMA)
    assert [r.vec_id for r in nndescent.nearest(few).where("query_id = 0").orderBy("vec_id").collect()] == [1, 2, 3, 4]
    assert nndescent.nearest(few.limit(0)).count() == 0


def test_steps_give_the_same_links_and_leave_no_vectors(spark, tmp_path, monkeypatch):
    """Many small steps, blocks and wide shards: links as by brute force, and what stays on disk is less than the vectors."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 32))
    x = np.vstack([x, x[rng.integers(0, 60, 500)] + rng.normal(size=(500, 32)) * 0.2]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    got = {r.vec_id: r.n_links for r in vamana.link(df, block=700, search=1000, send=1).collect()}
    assert (np.array([got[i] for i in range(len(x))]) <= want).all() and sum(got.values()) >= 0.99 * want.sum() > 0
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 0.5 * x.nbytes


def test_steps_are_ranges_of_all_units():
    assert vamana._steps(np.array([], float), 10) == []
    rows = np.array([3, 4, 20, 1, 1, 8, 9], float)
    steps = vamana._steps(rows, 10)
    assert [s for s, _ in steps] == [0, *[e for _, e in steps[:-1]]] and steps[-1][1] == len(rows) and len(steps) > 3
    assert all(rows[a:b].sum() <= 10 + rows.max() for a, b in steps)
