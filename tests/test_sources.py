"""Every source and sink on files, read back."""

import gzip
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mossgrid.operators import coverage, manifests, sequences
from mossgrid.sources import named, readers, writers


def put(folder, name, text):
    path = f"{folder}/{name}"
    with (gzip.open if name.endswith(".gz") else open)(path, "wt") as f:
        f.write(text)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifests(spark, tmp_path):
    reads = put(tmp_path, "reads.tsv", "# samples\nS1\ta_1.fastq.gz, a_2.fastq.gz\n\nL1\t/data/l.fastq\n")
    got = {r.sample: r for r in readers.read_reads_manifest(spark, reads).collect()}
    assert [os.path.basename(p) for p in got["S1"].reads] == ["a_1.fastq.gz", "a_2.fastq.gz"] and got["S1"].reads[0].endswith(f"{tmp_path}/a_1.fastq.gz")
    assert got["L1"].reads == ["/data/l.fastq"] and (got["S1"].read_type, got["L1"].read_type) == ("short", "long")
    contigs = put(tmp_path, "contigs.tsv", "S1\tsub/S1.fa\n# no\n")
    assert readers.read_contig_manifest(spark, contigs).first().contigs.endswith(f"{tmp_path}/sub/S1.fa")
    genomes = put(tmp_path, "genomes.txt", "/g/one.fa\n\n# no\ntwo.v1.fna.gz\n")
    assert {r.mag for r in readers.read_genome_list(spark, genomes).collect()} == {"one", "two.v1"}
    assert rows(readers.read_coassembly_manifest(spark, put(tmp_path, "co.tsv", "S1\tg1\nS2\tg1\n"))) == [("S1", "g1"), ("S2", "g1")]
    assert rows(readers.read_multi_list(spark, put(tmp_path, "multi.txt", "S1\nS2\nS1\n"))) == [("S1",), ("S2",)]


def test_every_manifest_rule(spark):
    reads = spark.createDataFrame([("S 1", ["a.fastq"]), ("S2", ["a.fastq"]), ("S2", ["b.fastq"]), ("S3", ["a.fastq", "b.fastq", "c.fastq"]), ("S4", ["a.bam"]), ("S5", ["a.fq.gz", "b.fq.gz"]), ("S6", ["a.fq"])], "sample string, reads array<string>")
    groups = spark.createDataFrame([("S5", "g"), ("S6", "g"), ("S5", "h"), ("none", "h"), ("S6", "S4")], "sample string, group string")
    one = spark.createDataFrame([("gone",)], "sample string")
    got = {(r.rule, r.key) for r in manifests.validate_manifests(reads, groups, one).collect()}
    assert got == {("bad_name", "S 1"), ("duplicate_sample", "S2"), ("not_one_or_two_files", "S3"), ("bad_extension", "S4"), ("unknown_sample", "none"), ("unknown_sample", "gone"), ("group_too_small", "S4"), ("mixed_read_types", "g"), ("sample_in_two_groups", "S5"), ("sample_in_two_groups", "S6"), ("group_named_as_sample", "S4"), ("too_few_multi_samples", "1")}
    twice = spark.createDataFrame([("m",), ("m",), ("n",)], "mag string")
    assert rows(manifests.duplicate_mags(twice)) == [("duplicate_mag", "m", "2")]
    contigs = spark.createDataFrame([("S5", "x.fa"), ("S5", "x.FNA.gz"), ("S6", "x.txt"), ("other", "x.fasta")], "sample string, contigs string")
    genomes = spark.createDataFrame([("m", "m.fa"), ("m", "d/m.fna"), ("n", "n.gb"), ("k", None)], "mag string, path string")
    found = {tuple(r) for r in manifests.validate_manifests(reads, groups, one, contigs, genomes).collect()}
    assert {x for x in found if x[0] in ("duplicate_contigs", "duplicate_mag") or x[1] in ("other", "n", "k")} | {("bad_extension", "S6", "x.txt"), ("bad_extension", "S4", "a.bam"), ("not_one_or_two_files", "S3", "3"), ("mixed_read_types", "g", "long,short"), ("sample_in_two_groups", "S5", "g,h")} <= found
    assert {x for x in found if x[0] in ("duplicate_contigs", "duplicate_mag") or x[1] in ("other", "n", "k")} == {("duplicate_contigs", "S5", "2"), ("duplicate_mag", "m", "2"), ("unknown_sample", "other", "contigs"), ("bad_extension", "n", "n.gb"), ("bad_extension", "k", "")}


def test_sequences(spark, tmp_path):
    put(tmp_path, "one.fa", ">c1 first\nACGT\nAC\n>c2\nGG\n")
    put(tmp_path, "two.fasta.gz", ">c1\nTT\n")
    got = rows(readers.read_fasta(spark, [f"{tmp_path}/one.fa", f"{tmp_path}/two.fasta.gz"]))
    assert got == [("one", "c1", "c1 first", "ACGTAC"), ("one", "c2", "c2", "GG"), ("two", "c1", "c1", "TT")]
    fastq = "@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+r2\nII\n"
    put(tmp_path, "a b_1.fastq", fastq)
    put(tmp_path, "a b_2.fastq.gz", fastq.replace("r1", "r9"))
    manifest = put(tmp_path, "reads.tsv", "S1\ta b_1.fastq,a b_2.fastq.gz\n")
    found = rows(readers.read_manifest_reads(spark, readers.read_reads_manifest(spark, manifest)).select("sample", "mate", "read_id", "seq", "qual"))
    assert found == [("S1", 1, "r1", "ACGT", "IIII"), ("S1", 1, "r2", "GG", "II"), ("S1", 2, "r2", "GG", "II"), ("S1", 2, "r9", "ACGT", "IIII")]
    assert readers.read_fastq(spark, [f"{tmp_path}/a b_1.fastq"]).count() == 2


def test_alignments(spark, tmp_path):
    paf = put(tmp_path, "x.paf", "r1\t100\t0\t90\t+\tc1\t500\t10\t100\t81\t90\t60\n")
    assert rows(readers.read_alignments(spark, paf, "S1")) == [("S1", "r1", "c1", 10, 90, 90.0, 90.0)]
    sam = put(tmp_path, "x.sam", "@SQ\tSN:c1\tLN:500\nr1\t0\tc1\t11\t60\t5S80M2I3D13M\t*\t0\t0\tA\tI\tNM:i:8\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\nr3\t16\tc2\t1\t9\t10M\t*\t0\t0\tA\tI\n")
    got = rows(readers.read_sam(spark, sam))
    assert got == [(None, "r1", "c1", 10, 96, pytest.approx(100 * 90 / 98), 95.0), (None, "r3", "c2", 0, 10, None, 100.0)]


def test_result_tables(spark, tmp_path):
    quality = put(tmp_path, "q.tsv", "Name\tCompleteness\tContamination\tOther\nb1\t90.5\t1.0\tx\n")
    assert rows(readers.read_quality(spark, quality)) == [("b1", 90.5, 1.0)]
    gunc = put(tmp_path, "g.tsv", "genome\tpass.GUNC\treference_representation_score\nb1\tTrue\t0.8\nb2\tFalse\tnan?\n")
    assert rows(readers.read_gunc(spark, gunc)) == [("b1", "True", 0.8), ("b2", "False", None)]
    rna = put(tmp_path, "r.tsv", "genome\tkind\ttype\terror\nb1\ttRNA\tAla\t\n")
    assert [tuple(r)[:3] for r in readers.read_rna(spark, rna).collect()] == [("b1", "tRNA", "Ala")]
    gff = put(tmp_path, "b7.gff", "##gff-version 3\nc1\tx\ttRNA\t1\t70\t9\t+\t.\tID=1;product=tRNA-Ala\nc1\tx\trRNA\t1\t70\t9\t+\t.\tName=16S_rRNA;product=16S ribosomal RNA\nc1\tx\tCDS\t1\t70\t9\t+\t.\tproduct=y\n")
    assert rows(readers.read_rna_gff(spark, gff.replace("b7.gff", "*.gff"))) == [("b7", "rRNA", "16S", None), ("b7", "tRNA", "Ala", None)]
    one, two = (put(tmp_path, f"t{k}.tsv", f"user_genome\tclassification\tnote\nm{k}\td__B;p__P\t\n") for k in (1, 2))
    assert rows(readers.read_taxonomy(spark, [one, two])) == [("m1", "d__B;p__P"), ("m2", "d__B;p__P")]
    line = "p1\tref|1\t75.0\t80\t1\t0\t11\t90\t1\t80\t1e-60\t250.5"
    hits = put(tmp_path, "h.tsv", f"{line}\n")
    lengths = spark.createDataFrame([("p1", 100)], "protein_id string, length long")
    assert rows(readers.read_hits(spark, hits, lengths)) == [("p1", "ref|1", 0.75, 0.8, 1e-60, 250.5)]
    assert rows(readers.read_hits(spark, put(tmp_path, "h13.tsv", f"{line}\t160\n"))) == [("p1", "ref|1", 0.75, 0.5, 1e-60, 250.5)]
    assert rows(readers.read_contig2bin(spark, put(tmp_path, "c.tsv", "S1\tx\tb\tc1\n"))) == [("S1", "x", "b", "c1")]
    cazy = readers.read_cazy(spark, put(tmp_path, "z.tsv", "Gene ID\tEC#\nG1\t1.1\n"))
    assert cazy.columns == ["Gene ID", "EC#"] and cazy.count() == 1
    assert rows(readers.read_hyd_groups(spark, put(tmp_path, "hg.tsv", "id1\tgroup 1a\tNiFe\n"))) == [("id1", "group 1a", "NiFe")]
    assert rows(readers.read_ko_descriptions(spark, put(tmp_path, "ko.tsv", "K1\tabc\tan enzyme\n"))) == [("K1", "abc", "an enzyme")]


def text_of(folder):
    return "".join(open(f"{d}/{n}").read() for d, _, names in sorted(os.walk(folder)) for n in sorted(names) if n.startswith("part-"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None, True), ("a", "x", False)], "sample string, note string, selected boolean").coalesce(1)
    writers.write_tsv(df, f"{tmp_path}/tsv", upper_bools=("selected",))
    assert text_of(f"{tmp_path}/tsv") == "sample\tnote\tselected\nb\tNA\tTRUE\na\tx\tFALSE\n"
    writers.write_per_sample(df, f"{tmp_path}/per")
    assert open(f"{tmp_path}/per/b.tsv").read() == "note\tselected\nNA\ttrue\n"
    writers.write_genome_list(spark.createDataFrame([(x,) for x in ("b", "a", "B", "a", "_")], "mag string"), f"{tmp_path}/list")
    assert open(f"{tmp_path}/list/genomes.txt").read().split() == ["B", "_", "a", "b"]
    gate = spark.createDataFrame([("skipped", "too_few_taxa", 9, 8, 3)], "status string, reason string, mags long, samples long, taxa long")
    writers.write_niche_provenance(gate, f"{tmp_path}/gate")
    assert json.loads(text_of(f"{tmp_path}/gate/json"))["reason"] == "too_few_taxa" and text_of(f"{tmp_path}/gate/status") == "niche\tskipped\ttoo_few_taxa\tmags=9\tsamples=8\ttaxa=3\n"


def test_mag_fasta_under_documented_names(spark, tmp_path):
    stats = spark.createDataFrame([("S1", "x", 10), ("S1", "y", 30), ("S2", "z", 5)], "sample string, bin string, total_bp long")
    named = sequences.name_bins(stats, "magscot")
    contigs = spark.createDataFrame([("x", "c_2", "AC"), ("x", "c_10", "GT"), ("y", "c_1", "AA"), ("z", "c_1", "T")], "bin string, contig_id string, seq string")
    files = writers.write_mag_fasta(contigs.join(named.select("bin", F_name()), "bin").select("mag", "contig_id", "seq"), f"{tmp_path}/mags")
    assert sorted((r.mag, os.path.basename(r.file), r.contigs) for r in files.collect()) == [("S1_magscot_1", "S1_magscot_1.fa", 1), ("S1_magscot_2", "S1_magscot_2.fa", 2), ("S2_magscot_1", "S2_magscot_1.fa", 1)]
    assert open(f"{tmp_path}/mags/S1_magscot_2.fa").read() == ">c_2\nAC\n>c_10\nGT\n"
    back = readers.read_fasta(spark, [f"{tmp_path}/mags/S1_magscot_1.fa", f"{tmp_path}/mags/S1_magscot_2.fa"])
    assert rows(back.select("genome", "contig_id")) == [("S1_magscot_1", "c_1"), ("S1_magscot_2", "c_10"), ("S1_magscot_2", "c_2")]
    assert sorted(os.listdir(f"{tmp_path}/mags")) == ["S1_magscot_1.fa", "S1_magscot_2.fa", "S2_magscot_1.fa"]


def F_name():
    from pyspark.sql import functions as F

    return F.col("name").alias("mag")

def test_fastq_in_ranges(spark, tmp_path):
    """A plain file in ranges of bytes gives the records of the whole, wherever the edges fall."""
    draw = random.Random(9)
    records = [(f"r{k}", "".join(draw.choice("ACGT") for _ in range(n)), "".join(draw.choice("@+I!~") for _ in range(n))) for k in range(300) for n in [draw.choice([0, 1, 5, 40])]]
    text = "".join(f"@{i} note\n{s}\n+{draw.choice(['', i])}\n{q}\n" + draw.choice(["", "", "\n", "\r\n"]) for i, s, q in records)
    for name, body in (("a.fastq", text), ("b.fastq", text.replace("\n", "\r\n").rstrip()), ("c.fastq.gz", text)):
        path = put(tmp_path, name, body)
        for size in (1, 57, 1000, 1 << 20):
            if size == 1 and name != "a.fastq":
                continue
            size = 7 if size == 1 else size
            df = readers.read_fastq(spark, [path], size)
            assert sorted(tuple(r) for r in df.select("read_id", "seq", "qual").collect()) == sorted(records), (name, size)
            if name == "a.fastq" and size == 1000:
                assert df.rdd.getNumPartitions() > 5 and {r.file for r in df.select("file").distinct().collect()} == {f"file:{path}"}
    assert readers.read_manifest_reads(spark, spark.createDataFrame([], "sample string, reads array<string>")).count() == 0
    with pytest.raises(Exception, match="ends within a record"):
        readers.read_fastq(spark, [put(tmp_path, "cut.fastq", "@r\nACGT\n+\n")]).count()


def test_quotes_are_text(spark, tmp_path):
    ko = put(tmp_path, "ko.tsv", 'K1\t"abc\tan "enzyme"\n')
    assert rows(readers.read_ko_descriptions(spark, ko)) == [("K1", '"abc', 'an "enzyme"')]


def test_documented_names(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None, True), ("a", 1, "x\ty", False), ("b", 1, "z", None), (None, 7, "no sample", True)], "sample string, mag int, note string, selected boolean").repartition(3)
    writers.write_per_sample(df, f"{tmp_path}/coverm", ("mag",))
    assert sorted(os.listdir(f"{tmp_path}/coverm")) == ["a.tsv", "b.tsv"]
    assert open(f"{tmp_path}/coverm/b.tsv").read() == "mag\tnote\tselected\n1\tz\tNA\n2\tNA\ttrue\n" and open(f"{tmp_path}/coverm/a.tsv").read() == "mag\tnote\tselected\n1\tx y\tfalse\n"
    wide = spark.createDataFrame([("m2", 0.5, 0.0), ("m1", 0.25, 1.0)], "mag string, S1 double, S2 double")
    writers.write_matrix(wide, f"{tmp_path}/coverm", "tpm")
    assert open(f"{tmp_path}/coverm/coverm_tpm_abd.tsv").read() == "mag\tS1\tS2\nm1\t0.25\t1.0\nm2\t0.5\t0.0\n"
    writers.write_matrix(wide.limit(0), f"{tmp_path}/coverm", "all")
    assert open(f"{tmp_path}/coverm/coverm_all_metrics.tsv").read() == "mag\tS1\tS2\n"
    writers.write_matrix(wide.limit(1), f"{tmp_path}/coverm", "all")  # written again: replaced
    assert len(open(f"{tmp_path}/coverm/coverm_all_metrics.tsv").readlines()) == 2
    assert sorted(os.listdir(f"{tmp_path}/coverm")) == ["a.tsv", "b.tsv", "coverm_all_metrics.tsv", "coverm_tpm_abd.tsv"]


def test_failed_and_repeated_attempts_leave_nothing(tmp_path):
    """Drafts of attempts that fail, or that don't count, never get a name."""
    batch = lambda *x: pa.record_batch({"file": [f"{f}.fa" for f, _ in x], "line": [t for _, t in x]})

    def broken():
        yield batch(("one", ">a"), ("two", ">b"))
        raise OSError("lost")

    writer = named.NamedWriter(str(tmp_path), None, None, "_drafts-1")
    with pytest.raises(OSError):
        writer.write(broken())
    speculative, good = writer.write(iter([batch(("one", ">x"))])), writer.write(iter([batch(("one", ">a\nAC"), ("two", ">b")), batch(("two", ">c"))]))
    assert speculative.files and os.listdir(tmp_path) == ["_drafts-1"]
    writer.commit([good, None])
    assert sorted(os.listdir(tmp_path)) == ["one.fa", "two.fa"] and open(f"{tmp_path}/one.fa").read() == ">a\nAC\n" and open(f"{tmp_path}/two.fa").read() == ">b\n>c\n"
    again = named.NamedWriter(str(tmp_path), None, None, "_drafts-2")
    messages = [again.write(iter([batch(("one", ">z"))])), again.write(iter([batch(("one", ">y"))]))]
    with pytest.raises(ValueError, match="several places"):
        again.commit(messages)
    assert sorted(os.listdir(tmp_path)) == ["one.fa", "two.fa"] and open(f"{tmp_path}/one.fa").read() == ">a\nAC\n"
    third = named.NamedWriter(str(tmp_path), None, None, "_drafts-3")
    third.write(iter([batch(("three", ">a"))]))
    third.abort([None])
    assert sorted(os.listdir(tmp_path)) == ["one.fa", "two.fa"]


def test_first_attempt_fails(spark, tmp_path):
    """A job whose task fails leaves no file and no draft; the next one writes them."""
    fail = F.udf(lambda k: f"line {1 // k}", "string")
    rows_ = spark.createDataFrame([("x.txt", 1), ("y.txt", 1), ("y.txt", 0)], "file string, k int")
    with pytest.raises(Exception):
        named.write_named(rows_.select("file", fail("k").alias("line")).repartition("file"), f"{tmp_path}/out")
    assert not os.path.exists(f"{tmp_path}/out") or os.listdir(f"{tmp_path}/out") == []
    named.write_named(rows_.where("k > 0").select("file", fail("k").alias("line")).repartition("file"), f"{tmp_path}/out")
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["x.txt", "y.txt"]


def test_alignments_to_abundances(spark, tmp_path):
    """Files of alignments, contigs and bins to the documented tables."""
    put(tmp_path, "S1.fa", ">c1\n" + "A" * 100 + "\n>c2\n" + "C" * 50 + "\n>c3\nGG\n")
    paf = lambda r, c, n, a, b: f"{r}\t50\t0\t50\t+\t{c}\t{n}\t{a}\t{b}\t50\t50\t60\n"
    path = put(tmp_path, "S1.paf", paf("r1", "c1", 100, 0, 50) + paf("r2", "c1", 100, 30, 80) + paf("r3", "c2", 50, 0, 50) + paf("r4", "c3", 2, 0, 2))
    bins = readers.read_contig2bin(spark, put(tmp_path, "bins.tsv", "S1\tx\tm1\tc1\nS1\tx\tm2\tc2\n")).select("contig_id", F.col("bin").alias("mag"))
    good = coverage.filter_alignments(coverage.mag_alignments(readers.read_alignments(spark, path, "S1"), bins))
    lengths = coverage.mag_lengths(readers.read_fasta(spark, f"{tmp_path}/S1.fa"), bins)
    covered = coverage.covered_fraction(good, lengths)
    assert sorted((r.mag, r.reads, r.covered_bases, r.length, r.covered_fraction) for r in covered.collect()) == [("m1", 2, 80, 100, 0.8), ("m2", 1, 50, 50, 1.0)]
    metrics = coverage.abundance_metrics(covered, spark.createDataFrame([("S1", 4)], "sample string, total_reads long"))
    writers.write_per_sample(metrics.select("sample", "mag", "reads"), f"{tmp_path}/coverm", ("mag",))
    assert open(f"{tmp_path}/coverm/S1.tsv").read() == "mag\treads\nm1\t2\nm2\t1\nunmapped\t1\n"
    matrix = coverage.abundance_matrix(coverage.assigned_only(metrics), "mean", ["S1"])
    writers.write_matrix(matrix, f"{tmp_path}/coverm", "mean")
    assert open(f"{tmp_path}/coverm/coverm_mean_abd.tsv").read() == "mag\tS1\nm1\t1.0\nm2\t1.0\n"
