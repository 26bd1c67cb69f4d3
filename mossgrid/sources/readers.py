"""Readers: manifests, sequences and the tables of upstream tools, as DataFrames."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mossgrid.functions.common import FASTA_SUFFIX, union
from mossgrid.sources.named import storage

#: Bytes of a plain FASTQ file that a task reads, and those read at a time.
RANGE_BYTES = 1 << 26
READ_BYTES = 1 << 22
FASTQ_ROWS = 4096


def read_tsv(spark: SparkSession, path: str | list[str], schema: str | None = None, header: bool = False) -> DataFrame:
    """Tab-separated text; `#` comments and blank lines are skipped, quotes are text. Without a schema the header names text columns."""
    reader = spark.read.option("sep", "\t").option("comment", "#").option("header", header or schema is None).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("quote", "")
    return (reader if schema is None else reader.schema(schema)).csv(path)


def resolved(path: Column, base: Column) -> Column:
    """A path as written if absolute or a URI, else below the manifest's folder."""
    folder = F.regexp_replace(base, "[^/]*$", "")
    return F.when(path.rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:)"), path).otherwise(F.concat(folder, path))


def read_reads_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(sample, reads, read_type): one or two files a sample; two are paired short reads."""
    rows = read_tsv(spark, path, "sample string, files string").select("sample", "files", F.col("_metadata.file_path").alias("base"))
    files = F.transform(F.split("files", r"\s*,\s*"), lambda p: resolved(p, F.col("base")))
    return rows.select("sample", files.alias("reads")).withColumn("read_type", F.when(F.size("reads") == 2, "short").when(F.size("reads") == 1, "long"))


def read_contig_manifest(spark: SparkSession, path: str) -> DataFrame:
    rows = read_tsv(spark, path, "sample string, file string").select("sample", "file", F.col("_metadata.file_path").alias("base"))
    return rows.select("sample", resolved(F.col("file"), F.col("base")).alias("contigs"))


def lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    rows = spark.read.text(path).select(F.trim("value").alias(name), F.col("_metadata.file_path").alias("base"))
    return rows.where((F.col(name) != "") & ~F.startswith(F.col(name), F.lit("#")))


def read_genome_list(spark: SparkSession, path: str) -> DataFrame:
    """(mag, path): the MAG is the file's name without its whole FASTA suffix."""
    rows = lines(spark, path, "file")
    return rows.select(F.regexp_replace(F.regexp_extract("file", "[^/]*$", 0), FASTA_SUFFIX, "").alias("mag"), resolved(F.col("file"), F.col("base")).alias("path"))


def read_coassembly_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "sample string, `group` string")


def read_multi_list(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path, "sample").select("sample").distinct()


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(genome, contig_id, header, seq) of plain or gzipped FASTA, a row per record."""
    raw = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", "^>", "").alias("r"), F.col("_metadata.file_name").alias("f"))
    header = F.regexp_extract("r", r"^[^\r\n]*", 0)
    seq = F.regexp_replace(F.regexp_replace("r", r"^[^\n]*(\n|$)", ""), r"\s", "")
    rows = raw.where(F.trim("r") != "").select(F.regexp_replace("f", FASTA_SUFFIX, "").alias("genome"), F.regexp_extract(header, r"^\S*", 0).alias("contig_id"), header.alias("header"), seq.alias("seq"))
    return rows


def listed_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """(URI, length) of all files at the paths, from one listing; a plain path belongs to the default file system. Nothing is read."""
    found = spark.read.format("binaryFile").load(paths).select("path", "length").collect()
    return sorted({(r.path, r.length) for r in found})


def opened(uri: str, start: int = 0) -> pa.NativeFile:
    """A file's bytes from a place on, unpacked if its name ends in .gz. Others than file: need a file system that Arrow knows."""
    files, path = storage(uri)
    if path.endswith(".gz"):
        return files.open_input_stream(path, compression="gzip")
    stream = files.open_input_file(path)
    stream.seek(start)
    return stream


def is_head(lines: list[bytes], at: int) -> bool:
    """Whether a record begins at a line: a quality line that starts like a header is followed, two lines on, by bases."""
    return lines[at][:1] == b"@" and at + 2 < len(lines) and lines[at + 2][:1] == b"+"


def fastq_batches(stream: pa.NativeFile, start: int, end: float, uri: str) -> Iterator[pa.RecordBatch]:
    """Records whose header begins in the bytes from start up to end. stream stands one byte before start, or at 0."""
    rest, place, framed = b"", max(0, start - 1), start == 0
    while True:
        more = stream.read(READ_BYTES)
        rest += more
        lines = rest.split(b"\n")
        if more or not lines[-1]:
            lines.pop()  # may go on, or stands after the last line end
        at = 0
        if not framed:  # the first whole line after start - 1, then the first header
            at = next((k for k in range(1, len(lines)) if is_head(lines, k)), len(lines))
            if at == len(lines) and more:
                continue
            place += sum(map(len, lines[:at])) + at
            framed = True
        used = at
        columns: tuple[list, list, list] = ([], [], [])
        while at < len(lines) and place < end:
            if not lines[at].strip():  # blank lines between records
                place += len(lines[at]) + 1
                at += 1
                used = at
                continue
            if at + 4 > len(lines):
                if not more and at + 3 == len(lines) and not lines[at + 1].strip():
                    lines.append(b"")  # the qualities of no base
                    continue
                if not more:
                    raise ValueError(f"{uri} ends within a record")
                break
            head, seq, _, qual = lines[at : at + 4]
            columns[0].append((head[1:].split(None, 1) or [b""])[0])
            columns[1].append(seq.strip())
            columns[2].append(qual.strip())
            place += sum(map(len, lines[at : at + 4])) + 4
            at += 4
            used = at
        for k in range(0, len(columns[0]), FASTQ_ROWS):
            n = len(columns[0][k : k + FASTQ_ROWS])
            yield pa.record_batch([pa.array([uri] * n), *(pa.array([x.decode("ascii", "replace") for x in c[k : k + FASTQ_ROWS]], pa.string()) for c in columns)], ["file", "read_id", "seq", "qual"])
        if place >= end or not more:
            return
        rest = rest[sum(map(len, lines[:used])) + used :]


@dataclass
class FastqRange(InputPartition):
    uri: str
    start: int
    end: float


class FastqSource(DataSource):
    """FASTQ files; a plain file in ranges of bytes, a packed one whole. Option `files`: lines of URI, a tab and the length."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "file string, read_id string, seq string, qual string"

    def reader(self, schema: object) -> DataSourceReader:
        files = [x.rsplit("\t", 1) for x in self.options["files"].split("\n") if x]
        return FastqReader([(uri, int(n)) for uri, n in files], int(self.options.get("rangebytes", RANGE_BYTES)))


class FastqReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], size: int) -> None:
        self.files, self.size = files, size

    def partitions(self) -> list[InputPartition]:
        out = []
        for uri, length in self.files:
            if uri.endswith(".gz") or length <= self.size:
                out.append(FastqRange(uri, 0, math.inf))
            else:
                out += [FastqRange(uri, a, min(a + self.size, length)) for a in range(0, length, self.size)]
        return out or [FastqRange("", 0, 0)]

    def read(self, partition: FastqRange) -> Iterator[pa.RecordBatch]:
        if partition.uri:
            with opened(partition.uri, max(0, partition.start - 1)) as stream:
                yield from fastq_batches(stream, partition.start, partition.end, partition.uri)


def fastq_of(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int) -> DataFrame:
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("files", "\n".join(f"{uri}\t{n}" for uri, n in files)).option("rangebytes", range_bytes).load()


def read_fastq(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, read_id, seq, qual) of plain or gzipped FASTQ on any storage that Spark and Arrow both know. Several tasks read a plain file of more than range_bytes."""
    return fastq_of(spark, listed_files(spark, paths), range_bytes)


def plain_path(uri: str) -> str:
    """A path without its scheme and host."""
    return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*(?=/))?/*(?=/)", "", uri)


def read_manifest_reads(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(sample, mate, file, read_id, seq, qual) of every file that a reads manifest names, listed at once. The manifest is a list of files, small next to them; its own table is joined by size."""
    named = manifest.select("sample", F.posexplode("reads").alias("mate", "path")).collect()
    found = {plain_path(uri): (uri, n) for uri, n in listed_files(spark, sorted({r.path for r in named}))} if named else {}
    rows = [(r.sample, r.mate + 1, found[plain_path(r.path)][0]) for r in named]
    files = spark.createDataFrame(rows, "sample string, mate int, file string")
    reads = fastq_of(spark, sorted(set(found.values())), range_bytes)
    return reads.join(files, "file").select("sample", "mate", "file", "read_id", "seq", "qual")


def read_alignments(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """PAF rows as (sample, read_id, contig, start, aligned_len, identity_pct, aligned_pct)."""
    paf = read_tsv(spark, path, "read_id string, qlen long, qs long, qe long, strand string, contig string, tlen long, ts long, te long, matches long, block long, mapq int")
    pct = lambda a, b: 100 * F.try_divide(a.cast("double"), b)
    return paf.select(F.lit(sample).cast("string").alias("sample"), "read_id", "contig", F.col("ts").alias("start"), (F.col("te") - F.col("ts")).alias("aligned_len"), pct(F.col("matches"), F.col("block")).alias("identity_pct"), pct(F.col("qe") - F.col("qs"), F.col("qlen")).alias("aligned_pct"))


def cigar_length(cigar: Column, operations: str) -> Column:
    """Bases of a CIGAR text under some of its operations."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"(\\d+)[{operations}]"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def read_sam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """Mapped SAM records in the columns of read_alignments. Identity is that of aligned columns without the edit distance (NM), null where it isn't given."""
    fields = F.split("value", "\t")
    rows = spark.read.text(path).where("value not like '@%' and value <> ''").select(fields.alias("f"), F.regexp_extract("value", "\tNM:i:(\\d+)", 1).alias("nm"))
    rows = rows.select(F.get("f", F.lit(0)).alias("read_id"), F.get("f", F.lit(1)).cast("int").alias("flag"), F.get("f", F.lit(2)).alias("contig"), F.get("f", F.lit(3)).cast("long").alias("pos"), F.get("f", F.lit(5)).alias("cigar"), F.when(F.col("nm") != "", F.col("nm").cast("long")).alias("nm"))
    rows = rows.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("contig") != "*"))
    columns, of_read, whole = (cigar_length(F.col("cigar"), x) for x in ("MID=X", "MI=X", "MIS=XH"))
    pct = lambda a, b: 100 * F.try_divide(a.cast("double"), b)
    return rows.select(F.lit(sample).cast("string").alias("sample"), "read_id", "contig", (F.col("pos") - 1).alias("start"), sam_aligned_length(F.col("cigar")).alias("aligned_len"), pct(columns - F.col("nm"), columns).alias("identity_pct"), pct(of_read, whole).alias("aligned_pct"))


def sam_aligned_length(cigar: Column) -> Column:
    """Reference bases of a CIGAR text."""
    return cigar_length(cigar, "MDN=X")


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def read_quality(spark: SparkSession, path: str, bin: str = "Name", completeness: str = "Completeness", contamination: str = "Contamination") -> DataFrame:
    return renamed(read_tsv(spark, path), bin=bin, completeness=completeness, contamination=contamination).withColumn("completeness", F.col("completeness").cast("double")).withColumn("contamination", F.col("contamination").cast("double"))


def read_gunc(spark: SparkSession, path: str) -> DataFrame:
    t = renamed(read_tsv(spark, path), bin="genome", **{"pass": "pass.GUNC", "reference_representation_score": "reference_representation_score"})
    return t.withColumn("reference_representation_score", F.expr("try_cast(reference_representation_score AS double)"))


def read_rna(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "genome string, kind string, type string, error string", header=True)


def read_taxonomy(spark: SparkSession, paths: list[str]) -> DataFrame:
    return union(*(renamed(read_tsv(spark, p), mag="user_genome", classification="classification") for p in paths))


def read_rna_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(genome, kind, type, error) from GFF files of RNA predictions, one a genome: tRNA types and rRNA genes by their product or name."""
    rows = read_tsv(spark, path, "seqid string, source string, feature string, start long, stop long, score string, strand string, phase string, attributes string")
    named = F.regexp_extract("attributes", "(?i)(?:^|;)(?:product|name)=([^;]*)", 1)
    genome = F.regexp_replace(F.regexp_extract("_metadata.file_name", "^.*$", 0), "[.]gff3?([.]gz)?$", "")
    trna, rrna = F.regexp_extract(named, "(?i)tRNA[-_ ]([A-Za-z]+)", 1), F.regexp_extract(named, "(?i)(5|16|23)S", 1)
    of_type = F.when(F.col("feature") == "tRNA", trna).when(rrna != "", F.concat(rrna, F.lit("S")))
    return rows.where("feature in ('tRNA', 'rRNA')").select(genome.alias("genome"), F.col("feature").alias("kind"), of_type.alias("type"), F.lit(None).cast("string").alias("error")).where("type <> ''")


def read_hits(spark: SparkSession, path: str, lengths: DataFrame | None = None) -> DataFrame:
    """(protein_id, subject, identity, query_coverage, evalue, bitscore), parts of 1, from the 12 tabular columns of BLAST and DIAMOND.

    Coverage needs the queries' lengths: from (protein_id, length), or a 13th column with them where lengths is None.
    """
    twelve = "protein_id string, subject string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
    rows = read_tsv(spark, path, twelve + ", qlen long")
    if lengths is not None:
        rows = rows.drop("qlen").join(lengths.select("protein_id", F.col("length").alias("qlen")), "protein_id", "left")
    covered = F.try_divide((F.abs(F.col("qend") - F.col("qstart")) + 1).cast("double"), F.col("qlen"))
    return rows.select("protein_id", "subject", (F.col("pident") / 100).alias("identity"), covered.alias("query_coverage"), "evalue", "bitscore")


def read_contig2bin(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "sample string, binner string, bin string, contig_id string")


def read_cazy(spark: SparkSession, path: str) -> DataFrame:
    """The tool's own columns, from its header."""
    return read_tsv(spark, path)


def read_hyd_groups(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "id string, HydDB_group string, class string")


def read_ko_descriptions(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "KO string, KO_gene_name string, KO_description string")
