import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyworks.llm import prefix_trie as P

from . import oracle

TURNS = "conv_id long, turn long, role string, text string, c string, key string"


def brute(rows):
    """Nodes by a dictionary of all prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    unit = lambda t: (hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()[:32], len(t[3]))
    convs = {c: [x[2:] for x in sorted(v, key=lambda t: (t[:2], unit(t)))] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + convs[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out = []
    for k in members:
        todo, leaves, saved = [k], 0, 0
        while todo:
            x = todo.pop()
            leaves += not kids[x]
            saved += (len(members[x]) - 1) * (len(x[-1][1]) if x else 0)
            todo += kids[x]
        sha = hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
        out.append((len(k), min(members[k]), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves, saved, sha))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    return sorted(map(tuple, P.nodes(P.rebuilt(P.sequences(df)), **options).collect()), key=str)


def conversations(seed, n, hot):
    """Many share turns, a third are equal, ids are sparse, negative too."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 6 * n), n):
        turns = [("u", "same")] * 7 if rng.random() < hot else [(rng.choice("ua"), rng.choice(["", "hi", "yes", "é\U0001f600"])) for _ in range(rng.randrange(1, 9))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


def test_query_equals_sql(spark):
    for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        oracle.same(P.op13_prefix_trie(spark, d), P.OP13_SQL, d)


@pytest.mark.parametrize(("seed", "n", "hot", "per"), [(1, 300, 0.4, 10), (2, 300, 0.0, 37), (3, 120, 1.0, 5), (4, 300, 0.4, 10**6)])
def test_random_conversations_against_brute_force(spark, monkeypatch, seed, n, hot, per):
    monkeypatch.setattr(P, "PIECE", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        rows = conversations(seed, n, hot)
        assert run(spark, rows, turns_a_range=per) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    rows = [(1, None, "u", "a"), (1, None, "u", "b"), (1, 0, None, None), (1, 0, None, None), (None, 0, "u", "x"), (2, 5, "u", "long " * 100_000), (100, 0, "u", "k"), (101, 0, "u", "own"), (101, 1, "", "a:b"), (103, -4, "a", ":b")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "u", "t")]) == []
    # a role and a text do not run together
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("1", ":a"), ("", "1:1:a")], "role string, text string")
    assert df.select(P.unit(df.role, df.text).alias("u")).distinct().count() == 4


def test_the_loser_tree_carries_prefixes():
    rng = random.Random(5)
    word = lambda: bytes([rng.randrange(3)]) * P.UNIT
    for k in (1, 2, 3, 7, 16):
        runs = []
        for _ in range(k):
            keys = sorted((b"".join(word() for _ in range(rng.randrange(6))), rng.randrange(1000)) for _ in range(rng.randrange(1, 40)))
            runs.append([(key, c, P.common(keys[i - 1][0], key) if i else 0) for i, (key, c) in enumerate(keys)])
        got = list(P.merged(runs))
        assert [g[:2] for g in got] == sorted(x[:2] for r in runs for x in r)
        assert [g[2] for g in got[1:]] == [P.common(a[0], b[0]) for a, b in zip(got, got[1:])]
