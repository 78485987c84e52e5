import random
from collections import Counter, defaultdict

from tallyworks.llm import packing


def plain(pieces, capacity, per_source):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and b["s"][source] < per_source and (cluster < 0 or cluster not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": Counter(), "c": set()})
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= size
        bins[i]["s"][source] += 1
        bins[i]["c"].add(cluster)
    return out


def test_best_fit_equals_brute_force():
    for seed in range(20):
        rng = random.Random(seed)
        pieces = sorted(((rng.randint(1, 60), int(rng.random() ** 3 * 5), rng.choice([-1, -1, 0, 0, 1, 2])) for _ in range(200)), reverse=True)
        assert packing.best_fit(pieces, 100, 1 + seed % 3) == plain(pieces, 100, 1 + seed % 3)


def held(rows, capacity, per_source):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for b in bins.values():
        b.sort(key=lambda r: r.offset)
        assert sum(r.size for r in b) <= capacity and [r.offset for r in b] == [sum(x.size for x in b[:i]) for i in range(len(b))]
        assert max(Counter(r.source for r in b).values()) <= per_source and len({r.cluster for r in b}) == len(b)
    return bins


def test_query_packs_everything_tightly(spark):
    d = "/root/testdata/sf0.01"
    rows = packing.op2_packing(spark, d).collect()
    bins = held(rows, packing.CAPACITY, packing.PER_SOURCE)
    words = {r.doc_id: len(__import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.size
    assert got == Counter({k: v for k, v in words.items() if v})
    assert sum(words.values()) / (len(bins) * packing.CAPACITY) > 0.95


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y z", None), (None, "x y z", None), (4, "w " * 25, "a"), (4, "w " * 25, "a"), (5, "X Y\tz", "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, cluster int")
    for shard in (1000, 2):
        got = packing.pack(df, capacity=10, per_source=2, shard=shard).collect()
        held(got, 10, 2)
        assert sum(r.size for r in got) == 59 and len(got) == 9
    assert packing.pack(df.limit(0)).count() == 0


def test_bins_do_not_depend_on_partitions(spark):
    rows = [(i % 70, "w " * (7 * i % 45), "ab"[i % 2]) for i in range(400)] + [(None, "w " * 25, "a")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    ways = [sorted(map(tuple, packing.pack(x, capacity=20, per_source=2, shard=50).collect()), key=str) for x in (df.repartition(1), df.repartition(7), df.repartition(5, "text"))]
    assert ways[0] == ways[1] == ways[2]
