"""Sinks of public tables, under their documented names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mossgrid.sources.named import folder_uri, tsv_line, write_named

#: The file of each metric's matrix.
MATRICES = {"relative_abundance": "coverm_rel_abd", "rpkm": "coverm_rpkm_abd", "tpm": "coverm_tpm_abd", "mean": "coverm_mean_abd", "all": "coverm_all_metrics"}


def write_tsv(df: DataFrame, path: str, na: str = "NA", upper_bools: tuple = ()) -> None:
    """Tab-separated text with a header, a folder of parts; nulls as na, the named boolean columns in capitals."""
    for c in upper_bools:
        df = df.withColumn(c, F.upper(F.col(c).cast("string")))
    df.write.option("sep", "\t").option("header", True).option("nullValue", na).option("emptyValue", "").csv(path)


def write_table(df: DataFrame, folder: str, name: str, order: tuple = (), na: str = "NA", upper_bools: tuple = ()) -> None:
    """One file `<folder>/<name>` with a header, in the given order; an empty table is its header. One task streams it, as it is one file: for tables that people read. write_tsv() is for larger ones."""
    rows = df.select(F.lit(name).alias("file"), tsv_line(df, na, upper_bools).alias("line"), *(F.col(c).alias(f"_{k}") for k, c in enumerate(order)))
    rows = rows.repartition(1).sortWithinPartitions(*(f"_{k}" for k in range(len(order)))) if order else rows.coalesce(1)
    write_named(rows, folder, "\t".join(df.columns), name)


def write_per_sample(df: DataFrame, folder: str, order: tuple = (), na: str = "NA") -> None:
    """A file `<sample>.tsv` for each sample with a header, without the sample's column; rows without a sample are left out."""
    own = df.drop("sample")
    rows = df.where("sample is not null").select(F.concat(F.col("sample").cast("string"), F.lit(".tsv")).alias("file"), tsv_line(own, na).alias("line"), *(F.col(c).alias(f"_{k}") for k, c in enumerate(order)))
    write_named(rows.repartition("file").sortWithinPartitions("file", *(f"_{k}" for k in range(len(order)))), folder, "\t".join(own.columns))


def write_matrix(wide: DataFrame, folder: str, metric: str, by: str = "mag") -> None:
    """A metric's matrix, or all metrics' table, under its documented name, by genome."""
    write_table(wide, folder, f"{MATRICES[metric]}.tsv", (by,))


def write_genome_list(mags: DataFrame, folder: str, name: str = "genomes.txt") -> None:
    """Names in byte order, one a line, in one file."""
    rows = mags.select(F.lit(name).alias("file"), F.col("mag").cast("string").alias("line")).where("line is not null").distinct()
    write_named(rows.repartition(1).sortWithinPartitions("line"), folder, None, name)


def write_mag_fasta(contigs: DataFrame, folder: str, suffix: str = ".fa") -> DataFrame:
    """One FASTA file `<mag><suffix>` for each genome of (mag, contig_id, seq), contigs by number; returns (mag, file, contigs). A genome is what one file holds, so one task writes it, record by record."""
    contig = F.col("contig_id").cast("string")
    number = F.coalesce(F.try_to_number(F.regexp_extract(contig, "([0-9]+)$", 1), F.lit("9999999999")), F.lit(0))
    rows = contigs.select(F.concat(F.col("mag").cast("string"), F.lit(suffix)).alias("file"), F.concat(F.lit(">"), contig, F.lit("\n"), F.coalesce("seq", F.lit(""))).alias("line"), number.alias("number"), contig.alias("contig"))
    write_named(rows.where("file is not null").repartition("file").sortWithinPartitions("file", "number", "contig"), folder)
    file = F.concat(F.lit(f"{folder_uri(contigs.sparkSession, folder)}/"), F.col("mag").cast("string"), F.lit(suffix))
    return contigs.where("mag is not null").groupBy("mag").agg(F.count("*").alias("contigs")).select("mag", file.alias("file"), "contigs")


def write_niche_provenance(status: DataFrame, path: str) -> None:
    """The gate's row as JSON, and its status line as text."""
    status.write.json(f"{path}/json")
    line = F.concat_ws("\t", F.lit("niche"), "status", "reason", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("mags", "samples", "taxa")))
    status.select(line.alias("value")).coalesce(1).write.text(f"{path}/status")
