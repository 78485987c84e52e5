import random
from collections import defaultdict

import numpy as np
import xxhash

from tallyworks.llm import simhash
from tallyworks.llm.components import components


def plain_fp(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_matches_definition():
    for t in [None, "", " \n", "One", "one two", "A b c d", "ÀB c d é f", "x " * 400, "\x85 q \x1c z w"]:
        assert simhash.fingerprint(None if t is None else t.encode()) == plain_fp(t)


def test_gray_index_equals_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(12)]]))
    index = simhash.GrayIndex(fps)
    q, m = index.within(fps, 2)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 2}
    assert set(zip(q.tolist(), m.tolist(), strict=True)) == want


def clusters(rng):
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice([0, 1, 40])):
            fps.add(x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return sorted(fps)


def check_links(spark, limit, most):
    fps = clusters(random.Random(5))
    want = plain_components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= limit])
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    edges = simhash.links(df, limit, most)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 * limit for r in edges.collect())
    got = {r.node: r.component for r in components(edges).collect()}
    groups, wanted = defaultdict(set), defaultdict(set)
    for x in fps:
        groups[got.get(simhash._signed(x), simhash._signed(x))].add(x)
        wanted[want[x]].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_links_by_index_and_by_overflow(spark):
    for limit in (0, 1, 2):
        for most in (simhash.GROUP, 8):
            check_links(spark, limit, most)


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    fp = {r.doc_id: plain_fp(r.text) for r in docs}
    want = plain_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 2])
    got = simhash.op3_simhash(spark, d).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{v:016x}", want[k]) for k, v in fp.items()} and len(got) == len(docs)


def test_odd_rows(spark):
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t", None), (None, "", "x"), (5, "a b c " * 5000, "x"), (5, "a b c " * 5000, "x"), (9, "a b c " * 5000, "x")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 1), (1, 1), (2, 1), (3, 1), (5, 5), (5, 5), (9, 5)]
    nobody = simhash.near_duplicates(spark.createDataFrame([(None, "lone words here")], "doc_id long, text string")).collect()
    assert [tuple(r)[0::2] for r in nobody] == [(None, None)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
