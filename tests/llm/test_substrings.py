import hashlib
import random
import re
from collections import Counter

from tallyworks.llm import substrings

from . import oracle


def plain(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[p : p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {q for p in range(len(w) - window + 1) if count[tuple(w[p : p + window])] > 1 for q in range(p, p + window)}
        out.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, u string, kept int")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.cut_repeats(df, **options).collect()), key=str)


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    oracle.same(substrings.op4_substrings(spark, d), substrings.OP4_SQL, d)


def test_random_texts_against_brute_force(spark):
    for seed, (window, period, cover) in enumerate([(35, 21, (0, 1, 4, 14, 16)), (9, 7, (0, 1, 3)), (7, 7, (0, 1, 3))]):
        rng = random.Random(seed)
        word = lambda: rng.choice("abc") if window < 10 else f"w{rng.randrange(3000)}"  # noqa: E731, B023
        passages = [[word() for _ in range(n)] for n in (window - 1, window, window + 1, 3 * window, 90)]
        rows = []
        for i in range(60):
            text = []
            for _ in range(rng.randrange(5)):
                text += [word() for _ in range(rng.randrange(60))]
                text += rng.choice(passages) if rng.random() < 0.5 else []
            rows.append((i, " ".join(text)))
        assert run(spark, rows, window=window, period=period, cover=cover) == plain(rows, window)


def test_odd_rows(spark):
    long = " ".join(f"n{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (None, "a b c"), (4, "z " * 36), (5, "q " * 35), (6, long), (6, long), (None, "tail " + long), (8, " \t".join(f"n{i}" for i in range(100, 140)) + "\x0b")]
    assert run(spark, rows) == plain(rows, 35)
    assert run(spark, []) == []


def test_rounds_do_not_change_results(spark, monkeypatch):
    monkeypatch.setattr(substrings, "ROUND_BYTES", 300)
    rows = [(i, " ".join(f"p{j}" for j in range(i % 3, 80))) for i in range(12)]
    assert run(spark, rows) == plain(rows, 35)
    kept = run(spark, rows)[0][3]
    assert substrings.sha256_hex(kept) == hashlib.sha256(kept.encode()).hexdigest()
