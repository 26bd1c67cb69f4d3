"""Every core operator on nulls in any column, repeated rows, empty tables and extra columns."""

import pytest
from pyspark.sql import functions as F

from mossgrid.operators import annotation, coverage, manifests, niche, quality, refine, sequences, similarity

TABLES = {
    "abundance": ("mag string, sample string, abundance double, reads long", [("m1", "s1", 2.0, 30), ("m2", "s1", 1.0, 40), ("m1", "s2", 0.0, 0)]),
    "taxonomy": ("mag string, taxon string", [("m1", "t1"), ("m2", "t2")]),
    "lineage": ("mag string, classification string", [("m1", "d__B;p__P"), ("m2", "")]),
    "hits": ("protein_id string, subject string, class string, identity double, query_coverage double, evalue double, bitscore double", [("p1", "x", "FeFe", 0.9, 0.95, 1e-60, 9.0), ("p1", "y", "NiFe", 0.9, 0.95, 1e-60, 8.0), ("p2", "x", "RHO", 0.5, 0.9, 1e-60, 7.0)]),
    "groups": ("id string, HydDB_group string, class string", [("x", "g1", "FeFe"), ("y", "g2", "NiFe")]),
    "ko": ("protein_id string, KO string", [("p1", "K1"), ("p2", "K2")]),
    "descriptions": ("KO string, KO_gene_name string, KO_description string", [("K1", "abc", "an enzyme")]),
    "list": ("knum string, definition string", [("K1", "abc; an enzyme"), ("K2", "plain")]),
    "genes": ("protein_id string, MAG string, MAG_contig_raw_id string, MAG_contig_id string, MAG_contig_gene_id string, function string", [("p1", "m1", "c", "c", "g1", "f")]),
    "quality": ("bin string, completeness double, contamination double", [("b1", 90.0, 1.0), ("b2", 20.0, 1.0)]),
    "gunc": ("bin string, pass string, reference_representation_score double", [("b1", "true", 0.9)]),
    "rna": ("bin string, genome string, kind string, type string, error string", [("b1", "b1", "tRNA", "Ala", None), ("b1", "b1", "rRNA", "16S", "late")]),
    "alignments": ("sample string, mag string, contig string, start long, aligned_len long, identity_pct double, aligned_pct double, assembly string, contig_len long", [("s1", "m1", "c", 0, 50, 99.0, 99.0, "a", 100), ("s1", "m1", "c", 20, 50, 99.0, 99.0, "a", 100)]),
    "lengths": ("mag string, length long", [("m1", 100)]),
    "contigs": ("genome string, sample string, bin string, contig_id string, seq string", [("m1", "s1", "b1", "c1", "ACGTTGCAACGTACGTTGCAACCA"), ("m2", "s1", "b1", "c2", "ACGTTGCAACGTACGTTGCAACCT")]),
    "bins": ("sample string, binner string, bin string, contig string, contig_id string, to_bin string", [("s1", "x", "b1", "c1", "c1", "b1"), ("s1", "y", "b2", "c1", "c1", "b2")]),
    "markers": ("sample string, contig string, marker string", [("s1", "c1", "m")]),
    "genomes": ("genome string, quality_score double, total_bp long", [("m1", 5.0, 10), ("m2", 6.0, 10)]),
    "reads": ("sample string, reads array<string>", [("s1", ["a.fq"]), ("s2", ["a.fq", "b.fq"])]),
    "assemblies": ("sample string, `group` string, assembly string", [("s1", "g", "a"), ("s2", "g", "a")]),
}

OPERATORS = {
    "taxon_abundance": lambda t: niche.taxon_abundance(t("abundance"), t("taxonomy")),
    "within_sample_percent": lambda t: niche.within_sample_percent(t("abundance")),
    "niche cv": lambda t: niche.niche_classification(t("abundance"), t("taxonomy")),
    "niche occupancy": lambda t: niche.niche_classification(t("abundance"), t("taxonomy"), metric="mean", method="occupancy"),
    "niche_gate": lambda t: niche.niche_gate(t("abundance"), t("taxonomy")),
    "genome_to_taxon": lambda t: niche.genome_to_taxon(t("taxonomy"), niche.niche_classification(t("abundance"), t("taxonomy"))),
    "best_hit": lambda t: annotation.best_hit(t("hits")),
    "hydrogenase_hits": lambda t: annotation.hydrogenase_hits(t("hits")),
    "terminal_hits": lambda t: annotation.terminal_hits(t("hits")),
    "confirm_fefe": lambda t: annotation.confirm_fefe(t("hits"), t("hits")),
    "add_hyd_group": lambda t: annotation.add_hyd_group(t("hits").drop("class"), t("groups")),
    "annotate_ko": lambda t: annotation.annotate_ko(t("ko"), t("descriptions")),
    "missing_ko": lambda t: annotation.missing_ko_descriptions(annotation.annotate_ko(t("ko"), t("descriptions"))),
    "ko_list": lambda t: annotation.ko_descriptions_from_list(t("list")),
    "gene_counts": lambda t: annotation.gene_counts(t("genes")),
    "stack": lambda t: annotation.stack_annotations(a=t("genes"), b=t("genes")),
    "pending": lambda t: annotation.pending_mags(t("taxonomy"), t("lineage")),
    "merge": lambda t: annotation.merge_annotations(t("genes"), t("genes")),
    "taxonomy_violations": lambda t: annotation.taxonomy_violations(t("taxonomy"), t("lineage")),
    "add_taxonomy": lambda t: annotation.add_taxonomy(t("abundance"), t("lineage")),
    "quality_summary": lambda t: quality.quality_summary(t("quality"), t("quality"), t("gunc"), t("rna").drop("bin"), trna_pass=1, rrna_pass=True),
    "dereplication_status": lambda t: quality.dereplication_status(quality.quality_summary(t("quality"), t("quality")), t("gunc")),
    "refined_counts": lambda t: quality.refined_counts(t("bins"), t("bins")),
    "covered_fraction": lambda t: coverage.covered_fraction(coverage.filter_alignments(t("alignments")), t("lengths")),
    "abundance_metrics": lambda t: coverage.abundance_metrics(coverage.covered_fraction(t("alignments"), t("lengths").distinct()), t("alignments").select("sample", F.lit(9).alias("total_reads")).distinct()),
    "abundance_table": lambda t: coverage.abundance_table(t("abundance"), ["s1", "s2"], ("reads",)),
    "differential_coverage": lambda t: coverage.differential_coverage(t("alignments"), t("assemblies")),
    "depth_vectors": lambda t: coverage.depth_vectors(coverage.differential_coverage(t("alignments"), t("assemblies")), t("assemblies")),
    "kmer_profile": lambda t: coverage.kmer_profile(t("contigs").withColumnRenamed("contig_id", "read_id"), t("contigs"), 9),
    "rename_contigs": lambda t: sequences.rename_contigs(t("contigs")),
    "bin_stats": lambda t: sequences.filter_bins_by_size(sequences.bin_stats(t("contigs")), 0),
    "name_bins": lambda t: sequences.name_bins(t("contigs").groupBy("sample", "bin").agg(F.sum(F.length("seq")).alias("total_bp")), "x"),
    "extract_bins": lambda t: sequences.extract_bins(t("contigs").drop("bin"), t("bins")),
    "tetranucleotides": lambda t: sequences.tetranucleotides(t("contigs"), "bin"),
    "contig_features": lambda t: sequences.contig_features(t("contigs"), "contig_id", t("contigs").select("contig_id", F.lit(1.0).alias("depth")).distinct()),
    "marker_clusters": lambda t: sequences.marker_clusters(sequences.contig_features(t("contigs")), t("markers").withColumnRenamed("contig", "contig_id")),
    "sketch_ani": lambda t: similarity.sketch_ani(similarity.sketches(t("contigs"), 9, 1), 9),
    "dereplicate": lambda t: similarity.dereplicate_sketches(t("genomes").dropna(subset=["genome"]).distinct(), similarity.sketches(t("contigs").dropna(subset=["genome"]), 9, 1), 9),
    "score_bins": lambda t: refine.score_bins(t("bins"), t("markers")),
    "refine_bins": lambda t: refine.refine_bins(t("bins"), t("markers")),
    "manifests": lambda t: manifests.validate_manifests(t("reads"), t("assemblies"), t("assemblies"), t("bins").withColumnRenamed("contig", "contigs"), t("taxonomy").withColumnRenamed("taxon", "path")),
    "coverage_groups": lambda t: manifests.coverage_groups(t("reads"), t("assemblies").select("sample", "group")),
}
#: Operators that keep a row for every row of their first table.
ROWS = {"within_sample_percent": "abundance", "add_hyd_group": "hits", "annotate_ko": "ko", "ko_list": "list", "add_taxonomy": "abundance", "quality_summary": "quality", "rename_contigs": "contigs"}
NOT_EMPTY = {"niche_gate", "missing_ko", "manifests"}


def odd(spark, name):
    """The table, each of its rows twice, one row of nulls, and the first row with a null in every column in turn."""
    schema, rows = TABLES[name]
    nulls = [tuple(None if k == at else v for k, v in enumerate(rows[0])) for at in range(len(rows[0]))]
    return spark.createDataFrame([*rows, *rows, *nulls, (None,) * len(rows[0])], schema).withColumn("n", F.lit(1)).withColumn("_row", F.lit("x"))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    made = OPERATORS[name](lambda t: odd(spark, t))
    got = made.collect()
    if name in ROWS:
        assert len(got) == odd(spark, ROWS[name]).count()
    empty = OPERATORS[name](lambda t: odd(spark, t).limit(0))
    assert empty.columns == made.columns and (empty.count() == 0 or name in NOT_EMPTY)
