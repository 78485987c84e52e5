"""Personal data by weak supervision; built-in functions only.

Regular expressions propose spans; regex, gazetteer, context, boundary and shape labelers vote on each (1, 0 abstain, -1). How
far each labeler can be trusted for each kind, and apart for true and for false spans, is estimated by expectation maximisation
over the counts of vote patterns, of which there are at most KINDS * 3**5 * LENGTHS whatever the corpus, so that they fit the
driver. Spans on which a kind's own check (Luhn, digits, octets) has decided anchor it; a labeler that says the same of anything
ends without weight. Its posteriors train the final span classifier, a naive Bayes model over votes and lengths whose log odds
are added up in each document's row.
Spans that a strict pattern finds (the base) stay whatever the model says; it adds others. Nothing is shuffled but the
pattern counts.

The expressions are the base patterns with possessive loops and look-behinds, which give the same leftmost matches, need no
stack in a long run and try a run once, not at each of its characters.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone", "name", "secret")
LENGTHS = 4
VOTES = ("v_regex", "v_gazetteer", "v_context", "v_boundary", "v_shape")
CONTEXT = 40
SMOOTH = 0.01

_LOCAL = "[A-Za-z0-9._%+-]"
#: kind, expression, whether its matches can be base
PATTERNS = (
    ("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+", None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+[\x20]?(?:\[at\]|\(at\)|\{at\})[\x20]?[A-Za-z0-9-]{1,63}+(?:(?:\.|[\x20]?(?:\[dot\]|\(dot\))[\x20]?)[A-Za-z0-9-]{1,63}+)++", "at"),
    ("phone", r"(?<![0-9+().-])(?<![0-9+().-][\x20])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", None),
    ("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?[\x20]\p{Lu}\p{Ll}{1,30}+(?:[\x20]\p{Lu}\p{Ll}{1,30}+)?", None),
    ("card", r"(?<![0-9])(?<![0-9][./_])[0-9]{4}(?:\.[0-9]{4}\.[0-9]{4}\.|/[0-9]{4}/[0-9]{4}/|_[0-9]{4}_[0-9]{4}_)[0-9]{4}(?![./_]?[0-9])", None),
    ("secret", r"(?i)(?<![A-Za-z])(?:token|secret|passwd|password|api[_-]?key)[\x20]?[=:][\x20]?[\x22']?[A-Za-z0-9_/+-]{16,128}+", None),
)
BASE_PATTERNS = 4
#: gazetteer and context words, by kind
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|io|eu|de|fr|es|uk|info)$",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^(?:\+(?:1|7|20|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1-9]|9[0-8])|\(?[2-9])",
    "name": r"\x20(?:Anna|Ben|Carlos|Claire|David|Eva|Hans|Jean|John|José|Julia|Karl|Laura|Luis|Maria|Mary|Max|Paul|Peter|Sara|Sophie|Thomas)\b",
    "secret": r"(?=.*[0-9])(?=.*[A-Za-z])",
    "ip": r"^(?!0|127\.|255\.)",
}
CONTEXT_WORDS = {
    "email": r"(?i)(?:mail|contact|write|schreib|écrire|correo)",
    "ip": r"(?i)(?:\bip\b|address|host|server|login|from)",
    "card": r"(?i)(?:card|visa|master|credit|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|anruf|appel|llam)",
    "name": r"(?i)(?:dear|contact|sincerely|regards|geehrte|cher|estimad)",
    "secret": r"(?i)(?:token|secret|pass|key|auth)",
}
AGAINST = r"(?i)(?:version|section|isbn|chapter|release|kapitel|figure)[\x20.:]{0,3}$"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def each(i):
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), each), F.lit(0), lambda a, d: a + d) % 10 == 0


def _strict(kind: str, m: Column) -> Column:
    digits = _digits(m)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.try_to_number(F.when(F.length(F.ltrim(p, F.lit("0"))).between(1, 3), F.ltrim(p, F.lit("0"))), F.lit("999")), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans(text: Column, matches: Column, pieces: Column, kind: str, base: bool) -> Column:
    """Array of candidate structs: positions in code points from the lengths of matches and of the pieces between them."""
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, i: F.struct((acc["at"] + F.length(F.get(pieces, i)) + F.length(F.get(matches, i))).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(F.get(pieces, i)))).alias("out")),
        lambda acc: acc["out"],
    )

    def one(start, i):
        m, ctx, after = F.get(matches, i), F.right(F.get(pieces, i), F.lit(CONTEXT)), F.substring(F.get(pieces, i + 1), 1, 1)
        checked = base or kind == "card"
        strict = F.coalesce(_strict(kind, m), F.lit(False)) if checked else F.lit(False)
        digits = _digits(m)
        say = lambda good, bad: F.when(bad, -1).when(good, 1).otherwise(0)
        edge = F.right(ctx, F.lit(1)).rlike(r"[\p{L}\p{N}_]") | after.rlike(r"[\p{L}\p{N}_]")
        flat = (F.length(digits) > 3) & (F.length(F.replace(digits, F.substring(digits, 1, 1), F.lit(""))) == 0)
        votes = (
            F.when(strict, 1).otherwise(F.lit(-1 if checked else 0)),
            F.when(m.rlike(GAZETTEER[kind]), 1).otherwise(F.lit(-1 if kind in ("card", "secret") else 0)),
            say(ctx.rlike(CONTEXT_WORDS[kind]) | (m.rlike(CONTEXT_WORDS[kind]) if kind == "secret" else F.lit(False)), ctx.rlike(AGAINST)),
            say(~edge, edge),
            say(F.length(m).between(6, 64) & ~flat, flat | (F.length(m) > 128)),
        )
        size = F.least(F.floor(F.length(m) / 10), F.lit(LENGTHS - 1)).cast("int")
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("s"), (start + F.length(m)).alias("e"), (strict if base else F.lit(False)).alias("base"), *[v.cast("int").alias(n) for n, v in zip(VOTES, votes, strict=True)], size.alias("size"))

    return F.transform(starts, one)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, c): every document's candidate spans with their votes. A null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    made = []
    for i, (kind, pattern, needs) in enumerate(PATTERNS):
        has = F.contains(F.col("_t"), F.lit(needs)) if needs else F.lit(True)
        df = df.withColumn(f"_m{i}", F.when(has, F.regexp_extract_all(F.col("_t"), F.lit(pattern), F.lit(0))))
        df = df.withColumn(f"_p{i}", F.when(F.size(f"_m{i}") > 0, F.split(F.col("_t"), pattern, -1)))
        spans = F.when(F.size(f"_m{i}") > 0, _spans(F.col("_t"), F.col(f"_m{i}"), F.col(f"_p{i}"), kind, i < BASE_PATTERNS))
        df = df.withColumn(f"_s{i}", spans)
        made.append(f"_s{i}")
    kind_of = "array<struct<kind:int,s:int,e:int,base:boolean,v_regex:int,v_gazetteer:int,v_context:int,v_boundary:int,v_shape:int,size:int>>"
    return df.select(F.col("_id").alias(id_col), F.concat(*[F.coalesce(F.col(c), F.array().cast(kind_of)) for c in made]).alias("c"))


def _clip(p: float) -> float:
    return min(max(p, 0.002), 0.998)


def fit(patterns: list[tuple[tuple[int, ...], int, int]], rounds: int = 50) -> dict[int, tuple[float, list[dict[int, float]]]]:
    """From (votes, size, count) of each kind's patterns: kind -> (bias, log odds by value for each vote and for the size).

    patterns: ((kind, *votes), size, count). EM gives each labeler two rates per kind: how often it says 1 of true and of false
    spans, where it does not abstain. Both start from the rate over all its votes, the odds four times higher and lower, so that
    only a vote that it does not always cast says much, and stay in the counts as ten votes. Where the regex has voted, its word stands (anchors); the share of true spans is counted on the others, from 0.8. The posteriors then weigh the naive
    Bayes counts, smoothed by so little that one failed check among thousands that pass still tells.
    """
    by_kind = defaultdict(list)
    for (kind, *votes), size, n in patterns:
        by_kind[kind].append((votes, size, n))
    models = {}
    for kind, rows in by_kind.items():
        rates = [(sum(n for v, _, n in rows if v[j] > 0) + 1) / (sum(n for v, _, n in rows if v[j]) + 2) for j in range(len(VOTES))]
        start = [(4 * r / (1 + 3 * r), r / (4 - 3 * r)) for r in rates]
        says, prior = [(_clip(t), _clip(f)) for t, f in start], 0.8
        post: list[float] = []
        for _ in range(rounds):
            post = []
            for votes, _, _ in rows:
                odds = math.log(prior / (1 - prior))
                for (t, f), v in zip(says, votes, strict=True):
                    odds += math.log(t / f) if v > 0 else math.log((1 - t) / (1 - f)) if v < 0 else 0.0
                post.append(float(votes[0] > 0) if votes[0] else 1 / (1 + math.exp(-odds)))
            weighed = [(votes, p * n, (1 - p) * n) for p, (votes, _, n) in zip(post, rows, strict=True)]
            free = [(t, f) for votes, t, f in weighed if not votes[0]]
            prior = _clip((sum(t for t, _ in free) + 1) / (sum(t + f for t, f in free) + 2))
            for j in range(len(VOTES)):
                cast = [(v[j] > 0, t, f) for v, t, f in weighed if v[j]]
                true = (sum(t for up, t, _ in cast if up) + 10 * start[j][0]) / (sum(t for _, t, _ in cast) + 10)
                false = (sum(f for up, _, f in cast if up) + 10 * start[j][1]) / (sum(f for _, _, f in cast) + 10)
                says[j] = (_clip(true), _clip(false))
        yes = sum(p * n for p, (_, _, n) in zip(post, rows, strict=True)) + SMOOTH
        no = sum((1 - p) * n for p, (_, _, n) in zip(post, rows, strict=True)) + SMOOTH
        weights = []
        for j in range(len(VOTES) + 1):
            counts = defaultdict(lambda: [SMOOTH, SMOOTH])
            for p, (votes, size, n) in zip(post, rows, strict=True):
                value = votes[j] if j < len(VOTES) else size
                counts[value][0] += p * n
                counts[value][1] += (1 - p) * n
            k = SMOOTH * (3 if j < len(VOTES) else LENGTHS)
            weights.append({v: math.log(a / (yes + k)) - math.log(b / (no + k)) for v, (a, b) in counts.items()})
        models[kind] = (math.log(yes / no), weights)
    return models


def _odds(c: Column, models: dict) -> Column:
    out = F.lit(-1.0)
    for kind, (bias, weights) in models.items():
        total = F.lit(bias)
        for name, values in zip((*VOTES, "size"), weights, strict=True):
            term = F.lit(0.0)
            for v, w in values.items():
                term = F.when(c[name] == v, w).otherwise(term)
            total = total + term
        out = F.when(c["kind"] == kind, total).otherwise(out)
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, spans (array of struct kind, start, end, base; by start, then kind).

    Positions are code points, the end exclusive. Added spans do not overlap base spans. A null text has none; null and
    repeated ids and rows are documents like any other; other columns are not read; an empty table gives no rows.
    """
    table = materialize(candidates(docs, id_col, text_col), "pii-candidates")
    counted = table.select(F.explode("c").alias("c")).groupBy("c.kind", *[f"c.{v}" for v in VOTES], "c.size").count()
    models = fit([(tuple(r[:6]), r[6], r[7]) for r in sorted(map(tuple, counted.collect()))])
    base = F.filter("c", lambda c: c["base"])
    more = F.filter("c", lambda c: ~c["base"] & (_odds(c, models) >= 0))
    df = table.select(id_col, base.alias("b"), more.alias("m"))
    apart = F.filter("m", lambda c: ~F.exists("b", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    short = lambda x: F.transform(x, lambda c: F.struct(c["s"].alias("start"), c["kind"].alias("kind"), c["e"].alias("end"), c["base"].alias("base")))
    return df.select(id_col, F.array_sort(F.array_distinct(F.concat(short("b"), short(apart)))).alias("spans"))


def op10_pii(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda i: F.filter("spans", lambda s: s["base"] & (s["kind"] == i))
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
