"""The training-data pipeline: quality, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import linedup, mixing, packing, quality, shingles, simhash
from tallyworks.llm.common import drop_read, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL can express neither the classifier nor packing; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(*COLUMNS), model).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; documents stay."""
    return _documents(linedup.dedup_lines(docs.select(*COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id (all rows without an id stay).

    A document is an id with a text: of an id with several texts each text has its own group, and of those in one group the
    text with the smallest hash stays. Repeated rows share one fate. Near are texts within op3's 2 bits and texts whose five-word shingles have a similarity of 0.8 or more.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")))
    also = shingles.near_links(docs)
    groups = simhash.near_duplicates(docs.select(key.alias("key"), "text"), "key", also=also)
    goes = materialize(groups.where("key <> component_id").select("key.doc_id", "key.th").distinct(), "pipeline-goes")
    drop_read(groups)
    drop_read(also)
    out = docs.select(*COLUMNS, key["th"].alias("th"))
    return out.join(goes, ["doc_id", "th"], "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. A document is an id with a text: what the mix takes of its repeated rows is added
    up, and its copies are those of one of them (the least by language, source and length, nulls first)."""
    one = docs.select("doc_id", F.xxhash64("text").alias("th"), F.struct("lang", "source", "n_chars", "text").alias("_d"))
    mixed = mixing.mix(docs).where("copies > 0").select("doc_id", "th", F.col("copies").alias("_copies"))
    # one grouping of both, so that the texts are shuffled once and null ids meet
    both = one.unionByName(mixed, allowMissingColumns=True).groupBy("doc_id", "th").agg(F.min("_d").alias("_d"), F.sum("_copies").alias("_copies"))
    out = both.where("_copies > 0").select("doc_id", "_d.*", "_copies")
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in bins; the copies that mixing made of a document never share one."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
