from collections import Counter, defaultdict
from fractions import Fraction

from tallyworks.llm import mixing

from . import oracle


def reshared(sizes, weights, most=3):
    """Targets by rounds, as the contract words them."""
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        level = Fraction(left, sum(weights[s] for s in free)) if free else 0
        over = [s for s in free if level * weights[s] > most * sizes[s]]
        if not over:
            return capped | {s: level * weights[s] for s in free}
        capped |= {s: Fraction(most * sizes[s]) for s in over}


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    oracle.same(mixing.op6_mixing(spark, d), mixing.OP6_SQL, d)


def test_targets_by_rounds(spark):
    for sizes in ({"a": 5, "b": 0, "c": 900, None: 3}, {"a": 1000, "b": 1, "c": 1, "d": 2, "e": 50}, {"z": 7}, {"a": 0, "b": 0}):
        rows = [(k, v) for k, v in sizes.items()]
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
        names = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
        want = reshared(sizes, {s: 1 + i % 3 for i, s in enumerate(names)})
        assert all(abs(got[s] - float(want[s])) < 1e-9 for s in sizes) and len(got) == len(sizes)


def test_taken_is_near_target_and_bounded(spark):
    docs = [(i, "w " * (1 + i % 17), "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    per, targets, source = Counter(), {}, {i: s for i, _, s in docs}
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        per[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
    assert all(abs(per[s] - targets[s]) <= 17 for s in targets) and sum(per.values()) <= sum(r.size for r in got)


def test_queue_interleaves_by_finish(spark):
    docs = [(i, "a b c", "x" if i % 2 else "y") for i in range(400)]
    _, taken = mixing.queue(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    order = taken.collect()
    assert [r.finish for r in order] == sorted(r.finish for r in order)


def test_odd_rows(spark):
    rows = [(1, None, "a", "q"), (None, "two words", None, "q"), (None, "two words", None, "q"), (3, "", "b", "q"), (4, "x " * 30000, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.size, r.taken))
    assert len(got) == 5 and [s for s, _ in by[None]] == [2, 2] and by[1] == [(0, 0)] and by[3] == [(0, 0)] and by[4][0][0] == 30000
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
