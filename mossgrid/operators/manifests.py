"""Manifest checks and coverage groups. Manifests name samples and files, so they're small, but nothing here depends on that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.functions.common import FASTA_SUFFIX, FASTQ_SUFFIX, NAME, kept, union

#: Pairs of listed samples that one task makes.
TASK_PAIRS = 1 << 24


def read_type(reads: DataFrame) -> DataFrame:
    return reads.withColumn("read_type", F.when(F.size("reads") == 2, "short").when(F.size("reads") == 1, "long"))


def validate_manifests(reads: DataFrame, coassembly: DataFrame | None = None, multi: DataFrame | None = None, contigs: DataFrame | None = None, genomes: DataFrame | None = None) -> DataFrame:
    """(rule, key, detail): every broken rule, and what breaks it.

    reads: (sample, reads array); coassembly: (sample, group); multi: (sample); contigs: (sample, contigs), some of the
    samples; genomes: (mag, path). A null key stands for a row without a sample, group or MAG.
    """
    typed = read_type(reads)
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",")

    def rows(df: DataFrame, rule: str, key: str, detail: Column | None = None) -> DataFrame:
        text = F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))
        return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), text.alias("detail")).distinct()

    strange = lambda c, suffix: F.array_join(F.filter(c, lambda p: ~F.lower(p).rlike(suffix)), ",")
    out = [
        rows(typed.where(F.col("sample").isNull() | ~F.col("sample").rlike(NAME)), "bad_name", "sample"),
        rows(typed.groupBy("sample").count().where("count > 1"), "duplicate_sample", "sample", F.col("count")),
        rows(typed.where(F.col("read_type").isNull()), "not_one_or_two_files", "sample", F.when(F.size("reads") >= 0, F.size("reads"))),
        rows(typed.where(F.exists("reads", lambda p: ~F.lower(p).rlike(FASTQ_SUFFIX))), "bad_extension", "sample", strange(F.col("reads"), FASTQ_SUFFIX)),
    ]
    known = typed.select("sample", "read_type").distinct()
    if coassembly is not None:
        joined = coassembly.join(known, "sample", "left")
        independent = known.join(coassembly, "sample", "left_anti")
        out += [
            rows(coassembly.join(known, "sample", "left_anti"), "unknown_sample", "sample", F.col("group")),
            rows(coassembly.groupBy("group").agg(F.count_distinct("sample").alias("n"), listed("sample").alias("members")).where("n < 2"), "group_too_small", "group", F.col("members")),
            rows(joined.groupBy("group").agg(F.count_distinct("read_type").alias("n"), listed("read_type").alias("types")).where("n > 1"), "mixed_read_types", "group", F.col("types")),
            rows(coassembly.groupBy("sample").agg(F.count_distinct("group").alias("n"), listed("group").alias("groups")).where("n > 1"), "sample_in_two_groups", "sample", F.col("groups")),
            rows(coassembly.join(independent.select(F.col("sample").alias("group")), "group", "left_semi"), "group_named_as_sample", "group"),
        ]
    if multi is not None:
        out += [rows(multi.join(known, "sample", "left_anti"), "unknown_sample", "sample", F.lit("multi")), rows(multi.agg(F.count_distinct("sample").alias("n")).where("n < 2"), "too_few_multi_samples", "n")]
    if contigs is not None:
        out += [
            rows(contigs.join(known, "sample", "left_anti"), "unknown_sample", "sample", F.lit("contigs")),
            rows(contigs.groupBy("sample").count().where("count > 1"), "duplicate_contigs", "sample", F.col("count")),
            rows(contigs.where(F.col("contigs").isNull() | ~F.lower("contigs").rlike(FASTA_SUFFIX)), "bad_extension", "sample", F.col("contigs")),
        ]
    if genomes is not None:
        out += [duplicate_mags(genomes), rows(genomes.where(F.col("path").isNull() | ~F.lower("path").rlike(FASTA_SUFFIX)), "bad_extension", "mag", F.col("path"))]
    return union(*out)


def duplicate_mags(genomes: DataFrame) -> DataFrame:
    """(rule, key, detail) of names that several genomes bear."""
    return genomes.groupBy("mag").count().where("count > 1").select(F.lit("duplicate_mag").alias("rule"), F.col("mag").alias("key"), F.col("count").cast("string").alias("detail"))


def coverage_groups(reads: DataFrame, coassembly: DataFrame | None = None, multi: DataFrame | None = None) -> DataFrame:
    """(group, sample, assembly): pairs of read sample and assembly whose alignments count.

    Coassembly members pair with their group's assembly; listed samples with every listed assembly; all others with their own.
    """
    samples = reads.select("sample").distinct()
    if coassembly is not None:
        grouped = samples.join(coassembly, "sample").select("group", "sample", F.col("group").alias("assembly"))
        rest = samples.join(coassembly, "sample", "left_anti")
    elif multi is not None:
        listed = kept(samples.join(multi.select("sample").distinct(), "sample", "left_semi"), "listed")
        # The list is the user's: every read sample of it against every assembly of it is what was asked for. A list that one
        # task holds makes pairs for many, so samples are dealt out by the pairs they make.
        n = listed.count()
        parts = max(1, min(n, max(reads.sparkSession.sparkContext.defaultParallelism, n * n // TASK_PAIRS)))
        grouped = listed.repartition(parts).crossJoin(listed.select(F.col("sample").alias("assembly"))).select(F.lit("multi").alias("group"), "sample", "assembly")
        rest = samples.join(multi, "sample", "left_anti")
    else:
        return samples.select(F.col("sample").alias("group"), "sample", F.col("sample").alias("assembly"))
    return union(grouped, rest.select(F.col("sample").alias("group"), "sample", F.col("sample").alias("assembly")))
