"""Column helpers and scratch tables shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NAME = "^[A-Za-z0-9][A-Za-z0-9._-]*$"
FASTA_SUFFIX = "[.](fa|fna|fasta)([.]gz)?$"
FASTQ_SUFFIX = "[.](fastq|fq)([.]gz)?$"
UNCLASSIFIED = "^$|^Unclassified$|^[a-z]__$"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one in local runs that don't set it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = getattr(scratch, "own", None) or tempfile.mkdtemp(prefix="spark-")
        scratch.own = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes rows as a scratch table and reads it, which cuts lineage in iterations."""
    to = scratch(df.sparkSession, name)
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)


def settled(df: DataFrame, name: str) -> DataFrame:
    """kept(), for large tables: pressed harder, and the shuffle files of the write go as it ends; else they stay until the driver collects its garbage."""
    to, conf = scratch(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(to)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(to)


def running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """Adds sums up to and with each row in a total order over all rows: sorted in ranges, summed within each, ranges' sums before it added. Only a row per range meets in one task."""
    ranges = kept(df.orderBy(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    per = ranges.groupBy("_range").agg(*(F.sum(x).alias(f"_{k}") for k, x in sums.items()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_range", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranges.join(per, "_range").select(*df.columns, *((F.col(f"_{k}") + F.sum(x).over(inside)).alias(k) for k, x in sums.items()))


def numbered_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Adds _no, from 1 within equal keys, to rows that nothing else tells apart: they are written down and numbered by file and place in it, so a key's rows needn't meet."""
    rows = kept(df, "numbered").select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("_written"))
    files = rows.groupBy(*keys, F.col("_written.file_path").alias("_file")).agg(F.count("*").alias("n"))
    files = files.withColumn("_skip", F.sum("n").over(Window.partitionBy(*keys).orderBy("_file")) - F.col("n")).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_file", "_skip")
    rows = rows.withColumn("_in_file", F.row_number().over(Window.partitionBy(*keys, "_written.file_path").orderBy("_written.row_index")))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    return rows.join(files, same & (F.col("_written.file_path") == F.col("_file"))).select(*df.columns, (F.col("_in_file") + F.col("_skip")).alias("_no"))


def one_per(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """A table to look up in, (key, columns): of different rows under one key the greatest in the columns' order, nulls least."""
    best = df.groupBy(key).agg(F.max(F.struct(*columns)).alias("_best"))
    return best.select(key, *(F.col(f"_best.{c}").alias(c) for c in columns))


def classified(taxon: Column) -> Column:
    """Whether a taxon names something: not null, empty, Unclassified or a bare rank prefix."""
    return F.coalesce(~taxon.rlike(UNCLASSIFIED), F.lit(False))


def reasons(*pairs: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, joined by semicolons; `pass` if none does."""
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in pairs)))
    return F.when(F.size(found) == 0, "pass").otherwise(F.array_join(found, ";"))


def union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))
