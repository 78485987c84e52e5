import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyworks.llm import divergence as D

from . import oracle

DOCS = "doc_id long, text string, lang string, source string, l string, term string"


def brute(rows, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(w for d in own for w in set(d[2]))
        kept = sorted((w for w, n in df.items() if n >= 3), key=str.encode)
        count = defaultdict(Counter)
        for _, source, words in own:
            count[source].update(w for w in words if df[w] >= 3)
        p = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}  # noqa: E731, B023
        ps, q = {s: p(c) for s, c in count.items()}, p(sum(count.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s, c in count.items():
            pairs = sorted(((-sum(f(ps[s][w], ps[o][w]) for w in kept), o.encode()) for o in ps if o != s))
            terms = sorted((-f(ps[s][w], q[w]), w.encode()) for w in kept if c[w] and ps[s][w] > q[w])[:top]
            out += [(lang, s, part, x.decode(), -v, i) for part, found in (("pair", pairs), ("term", terms)) for i, (v, x) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **options):
    return sorted(map(tuple, D.audit(spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS), **options).collect()))


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "É", "日本", "a-b", "x1y", "über", "z" * 300] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    source = lambda: rng.choice([None, "", "s0", "s0", "s0", "s1", "s2", "ß"])
    return [(i, " ".join(rng.choices(words, k=rng.randrange(60))), rng.choice(["en", "en", "de", None, "rare"]) if i else "only", source()) for i in range(n)]


def test_query_equals_sql(spark):
    for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        oracle.same(D.op12_divergence(spark, d), D.OP12_SQL, d)


@pytest.mark.parametrize(("entries", "wide", "piece", "top"), [(400_000, 8192, 1 << 20, 200), (20, 3, 16, 4), (1, 1, 1, 200)])
def test_random_documents_against_brute_force(spark, monkeypatch, entries, wide, piece, top):
    for name, value in (("ENTRIES", entries), ("WIDE", wide), ("PIECE", piece)):
        monkeypatch.setattr(D, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = corpus(entries, 120)
        assert run(spark, rows, top=top) == brute(rows, top)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    # groups without terms and a language that keeps none still have their pairs; repeated rows count each
    rows = [(1, None, "en", "a"), (1, None, "en", "b"), (2, "one two", "de", "a"), (3, "", "de", "b"), (4, "!", "de", None), *[(5, "Same \x00same _x", "en", "c")] * 3, (None, "q " * 100_000, None, None)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("de", "a", "pair", "b", 0, 2) in got
    assert run(spark, []) == []


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(300):
        total = rng.randrange(1, 2 ** rng.randrange(1, 53))
        count = rng.randrange(1, total + 1)
        assert D.scaled(np.int64(count), np.int64(total)) == 1 + math.floor(10**9 * count // total)
