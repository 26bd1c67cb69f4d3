"""Line dedup: lines that many documents repeat stay in one document only, found with levelled sorted runs of line hashes.

Documents are taken in batches by falling id. A batch's line keys, one row each with their number of documents and largest
id, are anti-joined with the runs of the batches before: what is new becomes a run of its own, what is known only adds to a
count. A run is a table bucketed and sorted by the 128-bit key hash, so a merge join neither moves nor sorts it, and a
level of `fan` runs is merged into one run of the next level. DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, scratch, union

LEAST = 20
DOCUMENTS = 3
BATCHES = 4
FAN = 3
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ("h1", "h2")


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. Lines of ASCII alone take the faster way."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def same_text(text: Column) -> list[Column]:
    """Two 64-bit hashes that tell texts apart; rows of one id and text lose the same lines."""
    filled = F.coalesce(text, F.lit(""))
    return [F.xxhash64(filled).alias("t1"), F.xxhash64(F.lit(1), filled).alias("t2")]


def occurrences(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, h1, h2, at, first): every line whose key is long enough, its place and whether the key is new in its document."""
    long = F.filter(F.transform(lines_of(F.col(text_col)), lambda x, k: F.struct(line_key(x).alias("key"), k.alias("at"))), lambda x: F.length(x["key"]) >= least)
    hashed = F.transform(long, lambda x: F.struct(F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit(1), x["key"]).alias("h2"), x["at"].alias("at")))
    rows = docs.select(F.col(id_col).alias("doc_id"), *same_text(F.col(text_col)), F.array_sort(hashed).alias("keys")).where(F.size("keys") > 0)
    before = lambda k: F.get("keys", k - 1)
    marked = F.transform("keys", lambda x, k: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), F.when((k > 0) & (before(k)["h1"] == x["h1"]) & (before(k)["h2"] == x["h2"]), 0).otherwise(1).alias("first")))
    return rows.select("doc_id", "t1", "t2", F.explode(marked).alias("x")).select("doc_id", "t1", "t2", "x.*")


class LineRuns:
    """Sorted runs of line keys (h1, h2, owner, docs), in levels. Runs share no key; close() forgets their tables."""

    def __init__(self, spark: SparkSession, fan: int = FAN) -> None:
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.more: list[DataFrame] = []
        self.names: list[str] = []

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        table = f"line_{name}_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", scratch(self.spark, table)).saveAsTable(table)
        self.names.append(table)
        return self.spark.table(table)

    def add(self, keys: DataFrame) -> None:
        """Takes a batch's (h1, h2, owner, docs), a row per key: new keys become a run, known ones add to the counts."""
        runs = [run for level in self.levels for run in level]
        batch = fresh = self._written(keys, "batch")
        for run in runs:
            self.more.append(batch.join(run.select(*KEY).hint("merge"), list(KEY), "left_semi"))
            fresh = fresh.join(run.select(*KEY).hint("merge"), list(KEY), "left_anti")
        self.levels[0].append(self._written(fresh, "run") if runs else batch)
        for k, level in enumerate(self.levels):
            if len(level) >= self.fan:
                merged = self._written(union(*level).repartition(self.buckets, *KEY), "merged")
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(merged)

    def totals(self) -> DataFrame:
        """(h1, h2, owner, docs) over all batches; the owner is the largest id of the first batch that held the key."""
        runs = [run.select(*KEY, "owner", "docs") for level in self.levels for run in level]
        later = [x.select(*KEY, F.lit(None).cast(x.schema["owner"].dataType).alias("owner"), "docs") for x in self.more]
        return union(*runs, *later).groupBy(*KEY).agg(F.max("owner").alias("owner"), F.sum("docs").alias("docs"))

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batches_by_id(rows: DataFrame, batches: int) -> list[DataFrame]:
    """The rows in batches of falling doc_id; an id lies in one batch, rows without an id in the last."""
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 100)).first()[0] or ()), reverse=True) if shares else []
    above = [F.col("doc_id") > x for x in cuts]
    parts = [rows.where(x if not k else x & ~above[k - 1]) for k, x in enumerate(above)]
    return [*parts, rows.where(F.col("doc_id").isNull() | ~above[-1]) if cuts else rows]


def repeated_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS, batches: int = BATCHES, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, gone): the places, in order, of the lines that a text loses; texts that lose none have no row."""
    rows = kept(occurrences(docs, least, id_col, text_col), "lines")
    runs = LineRuns(rows.sparkSession, fan)
    try:
        for part in batches_by_id(rows, batches):
            runs.add(part.groupBy(*KEY).agg(F.max("doc_id").alias("owner"), F.sum("first").alias("docs")))
        often = kept(runs.totals().where((F.col("docs") >= documents) & F.col("owner").isNotNull()).select(*KEY, "owner"), "often")
    finally:
        runs.close()
    lost = rows.join(often, list(KEY)).where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("owner")))
    return kept(lost.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_set("at")).alias("gone")), "gone")


def dedup_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS, batches: int = BATCHES, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text after dropping, n_lines (before) and n_dropped.

    Keys of at least `least` code points that stand in `documents` rows or more lose their lines everywhere but in the rows
    of the largest id that hold them. A null or empty text is one empty line and becomes an empty text. A row without an id
    comes after all ids: it loses a line that any id holds, and if none does, all keep it. Rows of one id keep alike; each
    row counts as a document. Long texts: memory is a small multiple of the text. Other columns stay; earlier ones named
    n_lines or n_dropped are replaced. Tables may be empty.
    """
    gone = repeated_lines(docs, least, documents, batches, fan, id_col, text_col).select(F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("gone").alias("_gone"))
    t1, t2 = same_text(F.col(text_col))
    rows = docs.select(*(c for c in docs.columns if c not in ("n_lines", "n_dropped")), t1.alias("_h1"), t2.alias("_h2"))
    rows = rows.join(gone, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_h1") == F.col("_t1")) & (F.col("_h2") == F.col("_t2")), "left")
    rows = rows.withColumn("_lines", lines_of(F.col(text_col))).withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    # What stays are the stretches between dropped lines.
    start = lambda k: F.when(k == 0, 0).otherwise(F.get("_gone", k - 1) + 1)
    end = lambda k: F.coalesce(F.get("_gone", k), F.size("_lines"))
    stretches = F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda k: F.slice("_lines", start(k) + 1, end(k) - start(k)))
    text = F.when(F.size("_gone") == 0, F.coalesce(text_col, F.lit(""))).otherwise(F.array_join(F.flatten(stretches), "\n"))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return rows.select(*columns, F.size("_lines").cast("long").alias("n_lines"), F.size("_gone").cast("long").alias("n_dropped"))


def sql(table: str = "documents") -> str:
    """The same in DuckDB's SQL, with plain groups by key."""
    space = " || ".join(f"chr({ord(c)})" for c in SPACE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {table}),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= {LEAST} GROUP BY key HAVING count(DISTINCT r) >= {DOCUMENTS}),
m AS (SELECT k.*, owner IS NOT NULL AND (doc_id IS NULL OR doc_id < owner) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r, doc_id"""
