"""Secrets, told from examples by who owns them; built-in functions only.

Patterns propose spans with the value that would be the secret. A value's hash is counted over the corpus by distinct owners and
repositories: what many owners hold is an example that was copied, what one or two hold and looks alive is a credential. Base
spans stay whatever their value; spans of the other patterns are added only if they are owned and alive.

Only hashes are shuffled, and only those of documents with candidates. A hash with at least 1/HOT of all candidates is looked up in
a broadcast table, which has HOT rows at most; the others meet their counts in a shuffle in which no key is larger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, materialize

KINDS = ("assign", "access", "hex", "provider", "jwt", "pem", "url", "quoted")
BASE = 3
#: a value of more owners is an example
OWNERS = 2
HOT = 1024
BLOCK = 256
DISTINCT = 8

_KEY = r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*+[:=]\x20*+[\x22']?"
#: expression (possessive, so that a run is read once), what a text must contain, what comes before and after the value, its least length
PATTERNS = (
    (_KEY + r"[A-Za-z0-9+/_.=-]++", None, "^" + _KEY, "", 6),
    (r"AKIA[A-Z0-9]{16,}+", "AKIA", "", "", 20),
    (r"(?<![0-9a-f])[0-9a-f]{24,}+", None, "", "", 24),
    (r"(?<![A-Za-z0-9])(?:gh[pousr]_|[sr]k_live_|xox[abprs]-|glpat-|AIza|npm_)[A-Za-z0-9_-]{16,}+", None, "", "", 16),
    (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ", "", "", 16),
    (r"-----BEGIN\x20(?:[A-Z]{1,20}\x20){0,3}PRIVATE\x20KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]{32,}+", "-----BEGIN", r"^-----BEGIN[A-Z\x20]*-----", "", 32),
    (r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D:/@\x22'<>]{1,64}:[^\x20\x09-\x0D:/@\x22'<>]{6,128}+@", "://", r"^[a-z0-9+.-]+://[^:]*:", "@$", 6),
    (r"(?<=[\x22'])[A-Za-z0-9+/_-]{20,128}+={0,2}(?=[\x22'])", None, "", "", 20),
)
#: values that stand for one
PLACEHOLDER = r"(?i)example|sample|dummy|change_?me|placeholder|redacted|your[_-]?|foobar|test|fake|1234567|(.)\1{4}"
SPAN = "array<struct<kind:int,s:int,e:int,live:boolean,key:string>>"


def running(lengths: Column) -> Column:
    """The sums of the elements before each element; block by block, since arrays are copied as they grow."""

    def scan(x: Column, start: Column) -> Column:
        end = F.aggregate(x, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))
        return end["out"]

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    block = lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))
    sums = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda a, n: a + n))
    starts = scan(sums, F.lit(0))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), starts.alias("at")), lambda x: scan(block(x["b"]), x["at"])))


def live(value: Column) -> Column:
    """Letters and digits, DISTINCT different characters, no placeholder."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT) & ~value.rlike(PLACEHOLDER)


def _spans(kind: int, matches: Column, pieces: Column, starts: Column) -> Column:
    _, _, before, after, least = PATTERNS[kind]

    def one(at, j):
        m = F.get(matches, j)
        start = at + F.length(F.get(pieces, j))
        value = F.regexp_replace(m, before, "") if before else m
        value = F.regexp_replace(value, after, "") if after else value
        return F.struct(F.lit(kind).alias("kind"), start.alias("s"), (start + F.length(m)).alias("e"), live(value).alias("live"), F.substring(F.sha2(value, 256), 1, 32).alias("key"), F.length(value).alias("n"))

    found = F.filter(F.transform(starts, one), lambda c: c["n"] >= least)
    return F.transform(found, lambda c: c.dropFields("n")).cast(SPAN)


def candidates(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """keep and c, every span that a pattern gives, in order of kind and start. Positions are code points, the end exclusive."""
    df = docs.select(*keep, F.coalesce(text, F.lit("")).alias("_t"))
    kept, made = [c for c in df.columns if c != "_t"], []
    for i, (pattern, needs, *_) in enumerate(PATTERNS):
        has = F.contains(F.col("_t"), F.lit(needs)) if needs else F.lit(True)
        matches, pieces, starts = F.col(f"_m{i}"), F.col(f"_p{i}"), F.col(f"_a{i}")
        df = df.withColumn(f"_m{i}", F.when(has, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))))
        df = df.withColumn(f"_p{i}", F.when(F.size(matches) > 0, F.split("_t", pattern, -1)))
        df = df.withColumn(f"_w{i}", F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p)))
        df = df.withColumn(f"_a{i}", F.when(F.size(matches) > 0, running(F.col(f"_w{i}"))))
        made.append(F.coalesce(_spans(i, matches, pieces, starts), F.array().cast(SPAN)))
    return df.select(*kept, F.concat(*made).alias("c"))


def ownership(found: DataFrame) -> DataFrame:
    """(key, n, owners, repositories) of candidates (key, owner, repo); a null owner or repository is one of its own."""
    rows = found.groupBy("key", "owner", "repo").agg(F.count("*").alias("n"))
    own = rows.groupBy("key", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    return own.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("owners"), F.sum("repos").alias("repositories"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", owners: int = OWNERS) -> DataFrame:
    """One row per document: id_col, spans (array of struct start, kind, end, base, owned, copied; by start, then kind).

    A document is a repository. owned: at most `owners` owners hold the value and it looks alive; copied: more hold it. Added spans
    overlap neither base spans nor added ones of an earlier kind. A null text has no span, a null owner is an owner; null and
    repeated ids and rows are documents like any other, of which equal ids are one repository; other columns are not read;
    an empty table gives no rows.
    """
    keep = (F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{owner_col}`").cast("string").alias("owner"))
    table = materialize(candidates(docs, F.col(f"`{text_col}`"), *keep), "secret-candidates")
    some, none = table.where(F.size("c") > 0), table.where(F.size("c") == 0)
    each = some.select("uid", "id", "owner", F.explode("c").alias("c"))
    counts = materialize(ownership(each.select("c.key", "owner", F.col("id").alias("repo"))), "secret-owners")
    total = counts.agg(F.sum("n")).first()[0] or 0
    seen = counts.select("key", (F.col("owners") > owners).alias("copied"), (F.col("n") * HOT >= total).alias("hot"))
    spans = each.select("uid", "c.*").join(F.broadcast(seen.where("hot").select("key", F.col("copied").alias("_hot"))), "key", "left")
    others = spans.where("_hot is null").drop("_hot").join(seen.where("not hot").select("key", "copied"), "key")
    judged = spans.where("_hot is not null").withColumnRenamed("_hot", "copied").unionByName(others)
    owned, base = F.col("live") & ~F.col("copied"), F.col("kind") < BASE
    told = judged.withColumns({"owned": owned, "base": base}).where("base or owned")
    shape = F.struct(F.col("s").alias("start"), "kind", F.col("e").alias("end"), "base", "owned", "copied")
    per = told.groupBy("uid").agg(F.array_sort(F.collect_list(shape)).alias("x"))
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    apart = F.filter("x", lambda a: a["base"] | ~F.exists("x", lambda b: meets(a, b) & (b["kind"] < a["kind"])))
    per = per.select("uid", apart.alias("spans"))
    empty = F.array().cast(per.schema["spans"].dataType)
    with_spans = some.select("uid", "id").join(per, "uid", "left").select("id", F.coalesce("spans", empty).alias("spans"))
    out = materialize(with_spans.unionByName(none.select("id", empty.alias("spans"))), "secret-spans")
    drop_tables(table, counts)
    return out.withColumnRenamed("id", id_col)


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    number = lambda that: F.size(F.filter("spans", that)).cast("long")
    of = lambda i: number(lambda s: s["base"] & (s["kind"] == i)).alias(f"n_{KINDS[i]}")
    counts = [of(i) for i in range(BASE)]
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), number(lambda s: s["owned"]).alias("n_owned"), number(lambda s: s["copied"]).alias("n_copied"))
