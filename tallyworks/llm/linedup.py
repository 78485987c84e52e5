"""Line dedup over levelled sorted runs of line hashes; built-in functions only.

Batches come in the order in which documents own their lines. A run is a table of (h1, h2, owner), bucketed and sorted by
the 128-bit hash of the line's key, holding the keys that one batch saw first. A batch's keys, aggregated to one row each,
merge-join every run: a key found there belongs to an earlier document. The rest anti-joins into a run of the batch's own at
level 0. `fanout` runs of a level are merged into one of the next, so that n batches leave about fanout * log(n) runs. Runs are
bucketed alike: looking them up deals out the batch's keys, never the runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, drop_tables, materialize, new_path, unused

MIN_LENGTH = 10
FANOUT = 4
BATCHES = 5
#: keys with more than one in HOT of a batch's lines are looked up by broadcast
HOT = 1024


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


class LineRuns:
    """The levelled runs, below one shared folder. open() finds those that an earlier session has left there."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.root = root or new_path(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def open(self) -> LineRuns:
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.levels = []
        for status in sorted(fs.listStatus(fs_path), key=lambda s: s.getPath().getName()) if fs.exists(fs_path) else []:
            level, buckets = map(int, status.getPath().getName().split("_")[1:3])
            path = status.getPath().toString()
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                name = f"tallyworks_run_{uuid.uuid4().hex}"
                self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, owner BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {buckets} BUCKETS LOCATION '{path}'")
                self.buckets = buckets
                self._put(level, name, path)
        return self

    def _put(self, level: int, name: str, path: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _write(self, keys: DataFrame, level: int) -> None:
        name = f"tallyworks_run_{uuid.uuid4().hex}"
        path = f"{self.root}/run_{level}_{self.buckets}_{sum(map(len, self.levels)):06d}_{name[-8:]}"
        keys.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).option("compression", "zstd").saveAsTable(name)
        self._put(level, name, path)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def owners(self, keys: DataFrame) -> DataFrame:
        """keys (h1, h2, ...) with `owner`, the document that an earlier batch gave the key to, or null."""
        found = []
        for i, run in enumerate(self.runs()):
            run = run.withColumnRenamed("owner", f"_owner{i}")
            keys = keys.join(run.hint("merge"), ["h1", "h2"], "left")
            found.append(f"_owner{i}")
        owner = F.coalesce(*found) if found else F.lit(None).cast("long")
        return keys.withColumn("owner", owner).drop(*found)

    def add(self, keys: DataFrame) -> None:
        """Write the new keys (h1, h2, owner) as a run, then merge levels that are full."""
        self._write(keys, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0][0])
            for name, _ in full[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self._write(merged, level + 1)
            for name, path in full:
                self.spark.sql(f"DROP TABLE {name}")
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
            level += 1

    def find(self, lines: DataFrame) -> DataFrame:
        """(id, th, goes): of a batch's lines (id, th, pos, h1, h2), the positions that go in each text. The batch's new keys are added.

        A key that holds more than a HOT-th of the batch's lines is looked up by broadcast, there being less than HOT of them; so
        no task gets all lines of one key.
        """
        keys = lines.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
        keys = materialize(self.owners(keys), "line-owners")
        many = (keys.agg(F.sum("n")).first()[0] or 0) // HOT
        shared = keys.where("owner is not null or low < high").select("h1", "h2", F.coalesce("owner", "low").alias("owner"), "n")
        hot = F.broadcast(shared.where(F.col("n") > many).drop("n"))
        rest = lines.join(hot, ["h1", "h2"], "left_anti").join(shared.where(F.col("n") <= many).drop("n"), ["h1", "h2"])
        goes = rest.unionByName(lines.join(hot, ["h1", "h2"])).where("id <> owner")
        goes = materialize(goes.groupBy("id", "th").agg(F.collect_set("pos").alias("goes")), "line-goes")
        self.add(keys.where("owner is null").select("h1", "h2", F.col("low").alias("owner")))
        drop_tables(keys)
        return goes

    def close(self, delete: bool = False) -> None:
        """Take the runs out of the catalog; their files stay for open() unless `delete` is set."""
        for level in self.levels:
            for name, path in level:
                self.spark.sql(f"DROP TABLE {name}")
                if delete:
                    where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                    where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.levels = []

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
        """docs as one batch, with text_col reduced to the lines that stay, and n_lines (before), n_dropped.

        A line whose key has at least min_length code points goes if an earlier batch holds the key, or another document of
        this batch with a smaller id; within the document that owns a key all its lines stay. A null text is one empty line
        and comes back as null; rows with a null id own nothing and keep all lines. Rows of one id count as one document.
        Other columns pass through, but for n_lines and n_dropped, which are replaced.
        """
        lines = materialize(_lines(docs, id_col, text_col, min_length), "line-keys")
        goes = self.find(lines)
        drop_tables(lines)
        return _without(docs, goes, id_col, text_col)


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """(id, th, pos, h1, h2): every line whose key is long enough, by the text's hash and the key's."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), _text_hash(text_col).alias("th"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    lines = lines.select("id", "th", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_length)
    return lines.select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def _without(docs: DataFrame, goes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs less the lines at the positions in goes, in one pass: what goes of a document is smaller than its text, so the hash
    tables are built on that side and no text is sorted. Rows without an id have nothing to look up."""
    i, t, g = unused(docs, "id", "th", "goes")
    goes = goes.withColumnsRenamed({"id": i, "th": t, "goes": g})
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = docs.where(F.col(id_col).isNotNull()).join(goes.hint("shuffle_hash"), (F.col(id_col) == F.col(i)) & (_text_hash(text_col) == F.col(t)), "left")
    out = known.select(*[f"`{c}`" for c in rest], g).unionByName(docs.where(F.col(id_col).isNull()).select(*[f"`{c}`" for c in rest], F.lit(None).cast("array<int>").alias(g)))
    n = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int")
    every = F.split(text, "\n", -1)
    stays = F.array_except(F.sequence(F.lit(0), n - 1), F.col(g))
    kept = F.when(F.col(g).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stays, lambda k: F.get(every, k)), "\n"))
    return out.select(*[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in rest], n.cast("long").alias("n_lines"), F.coalesce(F.size(g), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, fanout: int = FANOUT) -> DataFrame:
    """LineRuns.dedup() over a whole table, dealt into batches of rising ids. An empty table gives no rows.

    Documents are read once for the hashes of their lines, which alone go through the batches, and once to drop what goes.
    """
    marks = docs.agg(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or [] if batches > 1 else []
    lines = _lines(docs, id_col, text_col, min_length)
    marks = sorted(set(marks))
    lines = materialize(lines.withColumn("batch", sum([(F.col("id") > m).cast("int") for m in marks], F.lit(0))), "line-keys", "batch")
    runs = LineRuns(docs.sparkSession, fanout=fanout)
    goes = None
    for i in range(len(marks) + 1):
        found = runs.find(lines.where(F.col("batch") == i).drop("batch"))
        goes = found if goes is None else goes.unionByName(found)
    runs.close(delete=True)
    drop_tables(lines)
    return _without(docs, goes, id_col, text_col)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id)
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.owner IS NOT NULL AND s.owner <> l.doc_id AS goes FROM keyed l LEFT JOIN shared s USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
