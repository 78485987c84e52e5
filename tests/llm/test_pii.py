import hashlib
import re
from pathlib import Path

from tallyworks.llm import pii

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [(m.start(), i, m.end()) for i, (kind, p) in enumerate(BASE) for m in re.finditer(p, text or "") if good(kind, m[0])]
    return [f"{BASE[i][0]}:{s}:{e}" for s, i, e in sorted(spans)]


ODD = [
    "x@y.com_a@z.com b@c d@e.f. @g.h j@k..l 1@2.3", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 4.5.6.7890",
    "4111 1111-1111 1111 4111111111111112 4111-1111-1111-1111 5 5 5 5  4242424242424242", "+1 (555) 123-4567 +49.30.1234567- +1 2 +123456789012345678 ++44 20 7946 0958)",
    "café \U0001f600 a@b.org +33 1 23 45 67 89", "1" * 30000 + "@x.y", "a" * 100000, "1 " * 40000, "a@b.c" * 3000, "+" + "(" * 50000, "", None, "\n", "12.34.56.78.\n@",
    "a@b.c@d.e f@g.h-@i.j", "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6-7-8-9-0-1", "123456789012-", "+1-555-123-4567 1-555-123-4567",
]


def test_base_equals_brute_force(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, ODD[0], "y"), (3, ODD[3], "y"), (3, ODD[3], "y")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op10_pii(spark, str(tmp_path)).collect()
    by = {i: t for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        want = plain(by[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (r.doc_id, r.spans[:200], want[:5])
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert [r[f"n_{k}"] for k, _ in BASE] == [sum(w.startswith(k) for w in want) for k, _ in BASE]


def test_query_on_the_tables(spark):
    d = "/root/testdata/sf0.001"
    by = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in pii.op10_pii(spark, d).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain(by[r.doc_id])).encode()).hexdigest()


def test_the_method_adds_spans_and_em_ranks_labelers(spark):
    texts = ["please call (555) 123-4567 now", "dear Dr. Anna Weber, contact us", 'set token = "9f86d081884c7d659a2feaa0c55ad015"', "mail jane [at] example.org"] * 5 + ["nothing here at all"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {pii.KINDS[s.kind] for r in pii.find(df).collect() for s in r.spans}
    assert kinds == {"phone", "name", "secret", "email"}
    rows = [((0, 1, 1, 1, 1, 1), 1, 900), ((0, -1, -1, -1, -1, 1), 1, 800), ((0, 1, 1, 0, 1, -1), 1, 50)]
    bias, weights = pii.fit(rows)[0]
    assert weights[0][1] > 0 > weights[0][-1] and abs(weights[4][1]) < weights[0][1]


def test_empty_table_and_native_code(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    for name in ("pii", "linedup", "components"):
        source = Path(pii.__file__).with_name(f"{name}.py").read_text()
        assert not re.search(r"udf|mapIn|applyIn|pandas|pyarrow|\.rdd\b", source)


def test_dotted_phone_numbers_without_a_hyphen(spark):
    texts = ["please call 555.123.4567 now", "please call (555) 123.4567 now", "please call 555-123-4567 now", "no number"]
    found = {r.doc_id: len(r.c) for r in pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 0}


def planted():
    """Texts with (kind, span text) that is personal data, and look-alikes that are not."""
    rows = []
    for i in range(60):
        a, b = 1000 + 37 * i % 9000, 1000 + 91 * i % 9000
        body = [int(c) for c in f"4{a:04}{b:04}{a * 7 % 1000000:06}"]
        last = next(d for d in range(10) if good("card", "".join(map(str, [*body, d]))))
        number = "".join(map(str, body))
        off = f"{number}{(last + 5) % 10}"
        number += str(last)
        groups = ".".join(number[k : k + 4] for k in range(0, 16, 4))
        rows += [
            (f"my card is {number} thanks", {("card", number)}),
            (f"paid by visa {groups} today", {("card", groups)}),
            (f"item {off} is in stock", set()),
            (f"credit note {off} was sent", set()),
            (f"serial 9{off}{off} of the box", set()),
            (f"mail bob{i} [at] example.org soon", {("email", f"bob{i} [at] example.org")}),
            (f"mail bob{i}@example.org soon", {("email", f"bob{i}@example.org")}),
            (f"please call 555-{i + 100}-{a} now", {("phone", f"555-{i + 100}-{a}")}),
            (f"please call +49 30 {a} {b} now", {("phone", f"+49 30 {a} {b}")}),
            (f"see section 555-{i + 100}-{a} there", set()),
            (f"sum +1 {i % 10} and so on", set()),
            (f"dear Dr. Anna Weber{'abcdef'[i % 6]}, hello", {("name", f"Dr. Anna Weber{'abcdef'[i % 6]}")}),
            (f"token = {'%032x' % (i * 7919 + 10**30 + i)} ok", {("secret", f"token = {'%032x' % (i * 7919 + 10**30 + i)}")}),
            (f"from host 10.0.{i}.{i + 3} in", {("ip", f"10.0.{i}.{i + 3}")}),
            (f"version 3.{i}.400.{i + 500} out", set()),
        ]
    return rows


def test_the_classifier_says_no_and_finds_what_is_disguised(spark):
    rows = planted()
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: {(pii.KINDS[s.kind], rows[r.doc_id][0][s.start : s.end]) for s in r.spans} for r in pii.find(df).collect()}
    proposed = {(r.doc_id, c.s, c.e) for r in pii.candidates(df).collect() for c in r.c}
    assert sum(map(len, found.values())) < len(proposed)  # fails if every candidate is accepted
    for kind in pii.KINDS:
        # a phone whose digits pass Luhn by chance is a card too: base, whatever the model says
        chance = {(i, (kind, t[int(s) : int(e)])) for i, (t, _) in enumerate(rows) for k, s, e in (x.split(":") for x in plain(t)) if k == kind == "card"}
        got = {(i, x) for i, xs in found.items() for x in xs if x[0] == kind}
        want = {(i, x) for i, (_, xs) in enumerate(rows) for x in xs if x[0] == kind}
        got -= chance - want
        print(kind, "precision", len(got & want) / max(1, len(got)), "recall", len(got & want) / len(want))
        assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got), (kind, sorted(got ^ want)[:5])


def test_a_failed_check_is_not_outvoted():
    good_, bad = (2, 1, 1, 1, 1, 1), (2, -1, 1, 1, 1, 1)
    for n_good, n_bad in ((1000, 1), (1, 1000), (500, 500), (0, 50)):
        bias, weights = pii.fit([(p, 1, n) for p, n in ((good_, n_good), (bad, n_bad)) if n])[2]
        assert bias + sum(w.get(v, 0.0) for w, v in zip(weights, (*bad[1:], 1), strict=True)) < 0, (n_good, n_bad)
