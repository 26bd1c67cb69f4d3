"""Registered queries: every operator over column-mapped tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.functions.common import kept
from mossgrid.operators import annotation, coverage, manifests, niche, quality, refine, sequences, similarity

K = 21
SCALE = 50


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Proxies: tables mapped onto the operators' inputs


def abundance(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("mag"), (F.col("l_suppkey") % 8).alias("sample"))
    return rows.agg(F.sum(F.col("l_quantity").cast("long")).alias("abundance"), F.count("*").alias("reads"))


def taxonomy(spark: SparkSession, d: str, rank: str = "p_brand") -> DataFrame:
    return t(spark, d, "part").select(F.col("p_partkey").alias("mag"), F.col(rank).alias("taxon"))


def alignments(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").where("l_returnflag <> 'R'")
    return rows.select((F.col("l_suppkey") % 8).alias("sample"), (F.col("l_partkey") % 400).alias("mag"), F.col("l_linenumber").alias("contig"), ((F.col("l_orderkey") * 37) % 200).alias("start"), F.col("l_quantity").cast("long").alias("aligned_len"), (100 - F.round(100 * F.col("l_discount"))).alias("identity_pct"), (100 - 5 * F.round(100 * F.col("l_tax"))).alias("aligned_pct"))


ALIGNED = "SELECT l_suppkey % 8 AS sample, l_partkey % 400 AS mag, l_linenumber AS contig, (l_orderkey * 37) % 200 AS start, l_quantity::BIGINT AS aligned_len FROM lineitem WHERE l_returnflag <> 'R' AND 100 - round(100 * l_discount) >= 95 AND 100 - 5 * round(100 * l_tax) >= 75"


def hits(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part")
    kind = F.split("p_type", " ")[0]
    names = {"ECONOMY": "PsaA", "MEDIUM": "HbsT", "PROMO": "PsbA", "SMALL": "CoxL", "LARGE": "RHO"}
    label = F.lit("other")
    for a, b in names.items():
        label = F.when(kind == a, b).otherwise(label)
    part = part.select(F.col("p_partkey").alias("l_partkey"), label.alias("class"))
    rows = t(spark, d, "lineitem").join(part, "l_partkey")
    return rows.select(F.col("l_orderkey").alias("protein_id"), F.col("l_partkey").alias("subject"), "class", ((100 - 5 * F.round(100 * F.col("l_discount"))) / 100).alias("identity"), ((100 - 5 * F.round(100 * F.col("l_tax"))) / 100).alias("query_coverage"), F.lit(1e-60).alias("evalue"), F.col("l_extendedprice").alias("bitscore"))


CLASS = "CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 'PsaA' WHEN 'MEDIUM' THEN 'HbsT' WHEN 'PROMO' THEN 'PsbA' WHEN 'SMALL' THEN 'CoxL' WHEN 'LARGE' THEN 'RHO' ELSE 'other' END"
HITS = f"SELECT l_orderkey AS protein_id, l_partkey AS subject, {CLASS} AS class, (100 - 5 * round(100 * l_discount)) / 100 AS identity, (100 - 5 * round(100 * l_tax)) / 100 AS query_coverage, l_extendedprice AS bitscore FROM lineitem JOIN part ON l_partkey = p_partkey"


#: Letters that stand for bases, in this order A, C, G, T and again; upper-case ones like lower-case ones.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáåæçèéêëíîïñòóôöùúûüýßœÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÁÅÆÇÈÉÊËÍÎÏÑÒÓÔÖÙÚÛÜÝ"
BASES = ("ACGT" * 16)[: len(LETTERS)] + ("ACGT" * 16)[: len(UPPER)]


def contigs(spark: SparkSession, d: str) -> DataFrame:
    """Documents as contigs: letters of either case mapped onto ACGT, the rest left out."""
    seq = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), LETTERS + UPPER, BASES), "[^ACGT]", "")
    return t(spark, d, "documents").select(F.col("source").alias("sample"), F.col("source").alias("bin"), F.col("doc_id").alias("contig_id"), F.col("doc_id").alias("genome"), seq.alias("seq"))


SEQ = f"SELECT doc_id, source, regexp_replace(translate(coalesce(text, ''), '{LETTERS + UPPER}', '{BASES}'), '[^ACGT]', '', 'g') AS seq FROM documents"


def niche_query(method: str = "cv", correct: bool = False):  # noqa: ANN201
    def query(spark: SparkSession, d: str) -> DataFrame:
        metric, least = ("relative_abundance", 0.001) if method == "cv" else ("mean", 4.0)
        out = niche.niche_classification(abundance(spark, d), taxonomy(spark, d), "family", metric, method, correct, 20, least)
        r = lambda c: F.round(F.col(c), 6).alias(c)
        return out.select("taxon", F.col("member_mags").cast("long").alias("member_mags"), F.col("total_reads").cast("long").alias("total_reads"), r("overall_occupancy"), r("raw_si_cv"), r("corrected_si"), "eligible", "niche", "reason", "cv_quartile_rank", r("cv_low_tail_max"), r("cv_high_tail_min"), r("community_mean_corrected_si"), "correct_cv_classification")

    return query


def niche_sql(method: str = "cv", correct: bool = False) -> str:
    selected = "overall_occupancy" if method == "occupancy" else "corrected_si" if correct else "raw_si_cv"
    low, high = ("specialist", "generalist") if method == "occupancy" else ("generalist", "specialist")
    used = "abundance::DOUBLE" if method == "cv" else "abundance * 100.0::DOUBLE / sum(abundance) OVER (PARTITION BY sample)"
    return f"""
WITH a0 AS (SELECT l_partkey AS mag, l_suppkey % 8 AS sample, sum(l_quantity::BIGINT) AS abundance, count(*) AS reads FROM lineitem GROUP BY 1, 2),
a AS (SELECT mag, sample, reads, {used} AS abundance FROM a0),
ta AS (SELECT p_brand AS taxon, sample, sum(abundance) AS abundance, sum(reads) AS reads FROM a JOIN part ON mag = p_partkey GROUP BY 1, 2),
g AS (SELECT taxon, sample, coalesce(abundance, 0) AS abundance, coalesce(reads, 0) AS reads FROM (SELECT DISTINCT taxon FROM ta) CROSS JOIN (SELECT DISTINCT sample FROM a) LEFT JOIN ta USING (taxon, sample)),
s AS (SELECT taxon, avg(CASE WHEN abundance >= {0.001 if method == "cv" else 4} THEN 1.0 ELSE 0.0 END) AS overall_occupancy, sum(reads) AS total_reads, avg(abundance) AS mean, stddev_samp(abundance) / avg(abundance) AS raw_si_cv, stddev_samp(abundance) / avg(abundance) - sqrt(count(*) / sum(reads)) AS corrected_si FROM g GROUP BY taxon),
e AS (SELECT *, mean > 0 AND total_reads >= 20 AND {selected} IS NOT NULL AS eligible, {selected} AS sel FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY sel, taxon) AS k, count(*) FILTER (eligible) OVER () AS n FROM e),
l AS (SELECT *, CASE WHEN NOT eligible THEN 'unclassified_low_support' WHEN k <= n // 4 THEN '{low}' WHEN k > n - n // 4 THEN '{high}' ELSE 'intermediate' END AS niche FROM r),
m AS (SELECT p_brand AS taxon, count(DISTINCT mag) AS member_mags FROM a JOIN part ON mag = p_partkey GROUP BY 1)
SELECT taxon, member_mags::BIGINT AS member_mags, total_reads::BIGINT AS total_reads, round(overall_occupancy, 6) AS overall_occupancy, round(raw_si_cv, 6) AS raw_si_cv, round(corrected_si, 6) AS corrected_si, eligible, niche,
 CASE WHEN NOT eligible THEN concat_ws(';', CASE WHEN NOT mean > 0 THEN 'not_found' END, CASE WHEN total_reads < 20 THEN 'too_few_reads' END, CASE WHEN sel IS NULL THEN 'no_finite_value' END) WHEN k <= n // 4 THEN 'low_tail' WHEN k > n - n // 4 THEN 'high_tail' ELSE 'between_tails' END AS reason,
 CASE WHEN eligible THEN k END::BIGINT AS cv_quartile_rank,
 round(CASE WHEN eligible THEN max(sel) FILTER (eligible AND k <= n // 4) OVER () END, 6) AS cv_low_tail_max,
 round(CASE WHEN eligible THEN min(sel) FILTER (eligible AND k > n - n // 4) OVER () END, 6) AS cv_high_tail_min,
 round(avg(corrected_si) FILTER (eligible) OVER (), 6) AS community_mean_corrected_si, '{"TRUE" if correct else "FALSE"}' AS correct_cv_classification
FROM l LEFT JOIN m USING (taxon)"""


def taxon_abundance(spark: SparkSession, d: str) -> DataFrame:
    out = niche.taxon_abundance(abundance(spark, d), taxonomy(spark, d))
    return out.select("taxon", F.col("sample").cast("long").alias("sample"), F.col("abundance").cast("long").alias("abundance"), F.col("reads").cast("long").alias("reads"))


def niche_gate(spark: SparkSession, d: str) -> DataFrame:
    return niche.niche_gate(abundance(spark, d), taxonomy(spark, d, "p_type"))


def genome_to_taxon(spark: SparkSession, d: str) -> DataFrame:
    classes = niche.niche_classification(abundance(spark, d), taxonomy(spark, d))
    return niche.genome_to_taxon(taxonomy(spark, d), classes)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("bin"))
    estimates = docs.select("bin", ((F.col("bin") * 7919) % 101).cast("double").alias("completeness"), ((F.col("bin") * 104729) % 21).cast("double").alias("contamination"))
    gunc = t(spark, d, "labels").select(F.col("doc_id").alias("bin"), F.when(F.col("toxic") == 1, "false").otherwise("true").alias("pass"), F.lit(0.9).alias("reference_representation_score"))
    return quality.quality_summary(docs, estimates, gunc)


SUMMARY = """SELECT d.doc_id AS bin, ((d.doc_id * 7919) % 101)::DOUBLE AS completeness, ((d.doc_id * 104729) % 21)::DOUBLE AS contamination,
 ((d.doc_id * 7919) % 101 - 5 * ((d.doc_id * 104729) % 21))::DOUBLE AS quality_score, CASE WHEN toxic = 1 THEN 'false' WHEN l.doc_id IS NULL THEN 'unscored' ELSE 'true' END AS pass_gunc, 'not_run' AS pass_rna
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
QUALITY_SQL = f"""
WITH s AS ({SUMMARY}),
r AS (SELECT *, concat_ws(';', CASE WHEN completeness < 50 THEN 'low_completeness' END, CASE WHEN contamination > 10 THEN 'high_contamination' END, CASE WHEN pass_gunc = 'false' THEN 'gunc_failed' END) AS why FROM s)
SELECT bin, completeness, contamination, quality_score, pass_gunc, pass_rna, why = '' AS selected, CASE WHEN why = '' THEN 'pass' ELSE why END AS reason FROM r"""


def rna_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events as predictions: a tRNA type and perhaps an rRNA gene each; one in 97 has an error."""
    events = t(spark, d, "events")
    kind = F.col("event_type")
    rrna = F.when(kind == "click", "5S").when(kind == "view", "16S").when(kind == "error", "23S")
    genome = F.col("user_id").alias("genome")
    error = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("no hit in "), F.col("event_type")))
    return events.select(genome, F.lit("tRNA").alias("kind"), F.col("props").alias("type"), error.alias("error")).unionByName(events.select(genome, F.lit("rRNA").alias("kind"), rrna.alias("type"), F.lit(None).cast("string").alias("error")))


def rna_quality(spark: SparkSession, d: str) -> DataFrame:
    domains = t(spark, d, "events").where("user_id % 10 <> 0").select(F.col("user_id").alias("genome"), F.when(F.col("user_id") % 2 == 0, "Bacteria").otherwise("Archaea").alias("domain")).distinct()
    return quality.rna_report(rna_rows(spark, d), domains, 6, True).withColumn("trna_types", F.col("trna_types").cast("long"))


RNA_SQL = """
WITH q AS (SELECT user_id AS genome, count(DISTINCT props)::BIGINT AS trna_types, bool_or(event_type = 'click') AS rrna_5S, bool_or(event_type = 'view') AS rrna_16S, bool_or(event_type = 'error') AS rrna_23S,
 coalesce(array_to_string(list_sort(list(DISTINCT 'no hit in ' || event_type) FILTER (event_id % 97 = 0)), ';'), '') AS error FROM events GROUP BY 1)
SELECT genome, CASE WHEN genome % 10 <> 0 THEN CASE genome % 2 WHEN 0 THEN 'Bacteria' ELSE 'Archaea' END END AS domain, trna_types, "rrna_5S", "rrna_16S", "rrna_23S", CASE WHEN trna_types >= 6 AND "rrna_5S" AND "rrna_16S" AND "rrna_23S" THEN 'true' ELSE 'false' END AS pass, error FROM q"""


def covered(spark: SparkSession, d: str) -> DataFrame:
    good = coverage.filter_alignments(alignments(spark, d))
    lengths = good.select("mag").distinct().withColumn("length", F.lit(1750).cast("long"))
    return coverage.covered_fraction(good, lengths)


def covered_fraction(spark: SparkSession, d: str) -> DataFrame:
    out = covered(spark, d)
    return out.select("sample", "mag", F.col("reads").cast("long").alias("reads"), F.col("aligned_bp").cast("long").alias("aligned_bp"), F.col("covered_bases").cast("long").alias("covered_bases"), F.round("covered_fraction", 6).alias("covered_fraction"))


COVERED = f"""al AS ({ALIGNED}),
runs AS (SELECT *, start + aligned_len AS e, max(start + aligned_len) OVER (PARTITION BY sample, mag, contig ORDER BY start, start + aligned_len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM al),
cov AS (SELECT sample, mag, count(*) AS reads, sum(aligned_len) AS aligned_bp, sum(greatest(e - greatest(start, coalesce(before, start)), 0)) AS covered_bases FROM runs GROUP BY 1, 2)"""
COVERED_SQL = f"WITH {COVERED} SELECT sample, mag, reads::BIGINT AS reads, aligned_bp::BIGINT AS aligned_bp, covered_bases::BIGINT AS covered_bases, round(covered_bases / 1750, 6) AS covered_fraction FROM cov"


def metrics(spark: SparkSession, d: str) -> DataFrame:
    totals = t(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 8).alias("sample")).agg(F.count("*").alias("total_reads"))
    return coverage.abundance_metrics(covered(spark, d).withColumn("mag", F.col("mag").cast("string")), totals)


def abundance_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics(spark, d).select("sample", "mag", *(F.round(m, 6).alias(m) for m in coverage.METRICS), F.col("reads").cast("long").alias("reads"))


METRICS = f"""{COVERED},
tot AS (SELECT l_suppkey % 8 AS sample, count(*) AS total FROM lineitem GROUP BY 1),
x AS (SELECT cov.*, total, CASE WHEN covered_bases / 1750 >= 0.1 THEN aligned_bp / 1750 ELSE 0 END AS mean, sum(reads) OVER (PARTITION BY sample) AS mapped, reads / 1750 AS rate FROM cov JOIN tot USING (sample)),
y AS (SELECT sample, mag::VARCHAR AS mag, 100 * (mapped / total) * coalesce(mean / nullif(sum(mean) OVER (PARTITION BY sample), 0), 0) AS relative_abundance, rate * 1e9 / mapped AS rpkm, rate * 1e6 / sum(rate) OVER (PARTITION BY sample) AS tpm, mean, reads FROM x),
z AS (SELECT * FROM y UNION ALL SELECT sample, 'unmapped', 100 * (1 - coalesce(m, 0) / total), NULL, NULL, NULL, total - coalesce(m, 0) FROM tot LEFT JOIN (SELECT sample, sum(reads) AS m FROM cov GROUP BY 1) USING (sample))"""
METRICS_SQL = f"WITH {METRICS} SELECT sample, mag, round(relative_abundance, 6) AS relative_abundance, round(rpkm, 6) AS rpkm, round(tpm, 6) AS tpm, round(mean, 6) AS mean, reads::BIGINT AS reads FROM z"


def abundance_matrix(spark: SparkSession, d: str) -> DataFrame:
    wide = coverage.abundance_matrix(coverage.assigned_only(metrics(spark, d)), "tpm", list(range(8)))
    return wide.select("mag", *(F.round(F.col(f"`{k}`"), 6).alias(f"s{k}") for k in range(8)))


MATRIX_SQL = f"WITH {METRICS} SELECT mag, {', '.join(f'round(coalesce(max(tpm) FILTER (sample = {k}), 0), 6) AS s{k}' for k in range(8))} FROM z WHERE mag <> 'unmapped' GROUP BY mag"


def hydrogenase_hits(spark: SparkSession, d: str) -> DataFrame:
    return annotation.hydrogenase_hits(hits(spark, d)).select("protein_id", "subject", "class", "identity", "query_coverage", "bitscore", "hit_rank")


HYD_SQL = f"WITH h AS ({HITS}) SELECT protein_id, subject, class, identity, query_coverage, bitscore, row_number() OVER (PARTITION BY protein_id ORDER BY bitscore DESC, identity DESC, subject)::BIGINT AS hit_rank FROM h WHERE identity >= 0.5 AND query_coverage >= 0.9"


def terminal_hits(spark: SparkSession, d: str) -> DataFrame:
    return annotation.terminal_hits(hits(spark, d)).select("protein_id", F.col("subject").alias("Reference"), "class", "identity", "Required_identity")


TERMINAL = f"""h AS ({HITS}), c AS (SELECT *, CASE class WHEN 'PsaA' THEN 0.8 WHEN 'HbsT' THEN 0.75 WHEN 'PsbA' THEN 0.7 WHEN 'CoxL' THEN 0.6 WHEN 'RHO' THEN 0.4 ELSE 0.5 END::DOUBLE AS cutoff FROM h),
b AS (SELECT *, row_number() OVER (PARTITION BY protein_id ORDER BY bitscore DESC, identity DESC, subject) AS k FROM c WHERE query_coverage >= 0.8 AND identity >= cutoff)"""
TERMINAL_SQL = f'WITH {TERMINAL} SELECT protein_id, subject AS "Reference", class, identity, cutoff AS "Required_identity" FROM b WHERE k = 1'


def gene_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = annotation.terminal_hits(hits(spark, d)).select((F.col("subject") % 400).alias("MAG"), F.when(F.col("class") == "other", "Unclassified").otherwise(F.col("class")).alias("function"), F.col("protein_id").alias("MAG_contig_gene_id"))
    return annotation.gene_counts(rows).withColumn("genes", F.col("genes").cast("long"))


def ko_annotation(spark: SparkSession, d: str) -> DataFrame:
    """KO = part key; descriptions exist for the smaller sizes only."""
    return annotation.annotate_ko(*ko_lookup(spark, d)).groupBy("KO", "KO_gene_name", "KO_description").agg(F.count("*").alias("genes"))


def contig_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = sequences.bin_stats(sequences.filter_contigs(contigs(spark, d)))
    named = sequences.name_bins(sequences.filter_bins_by_size(stats, 10).withColumn("sample", F.lit("cohort")), "tool")
    return named.select("bin", "name", F.col("total_bp").cast("long").alias("total_bp"), F.col("contigs").cast("long").alias("contigs"))


def contig_rename(spark: SparkSession, d: str) -> DataFrame:
    return sequences.rename_contigs(contigs(spark, d)).select("contig_id", "new_id")


def bin_export(spark: SparkSession, d: str) -> DataFrame:
    table = contigs(spark, d)
    chosen = t(spark, d, "labels").where("quality = 1").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id").select(F.col("source").alias("sample"), F.col("doc_id").alias("contig_id"), F.col("source").alias("to_bin"))
    return sequences.extract_bins(table, chosen).select("to_bin", "contig_id", F.sha2("seq", 256).alias("seq_sha256"))


def tetranucleotide(spark: SparkSession, d: str) -> DataFrame:
    return sequences.tetranucleotides(contigs(spark, d), "bin").select("bin", "kmer", F.col("n").cast("long").alias("n"))


RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
TETRA_SQL = f"WITH s AS ({SEQ}), k AS (SELECT source AS bin, substr(seq, i, 4) AS f FROM (SELECT source, seq, unnest(range(1, length(seq) - 2)) AS i FROM s WHERE length(seq) >= 4)) SELECT bin, least(f, {RC.format('f')}) AS kmer, count(*)::BIGINT AS n FROM k GROUP BY 1, 2"


def pending_mags(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").withColumnRenamed("p_partkey", "mag")
    return annotation.pending_mags(part, part.where("p_size <= 25"))


def merged_annotations(spark: SparkSession, d: str) -> DataFrame:
    row = [F.col("protein_id"), F.col("class").alias("MAG"), F.col("subject").alias("MAG_contig_raw_id"), F.col("subject").alias("MAG_contig_id"), F.concat_ws("_", "class", "subject", "protein_id").alias("MAG_contig_gene_id")]
    all_hits = hits(spark, d)
    stacked = annotation.stack_annotations(hydrogenase=annotation.hydrogenase_hits(all_hits, True).select(*row), terminal=annotation.terminal_hits(all_hits).select(*row))
    return stacked.select("branch", *annotation.COMMON)


MERGED_SQL = f"""WITH {TERMINAL}, y AS (SELECT *, row_number() OVER (PARTITION BY protein_id ORDER BY bitscore DESC, identity DESC, subject) AS k FROM h WHERE identity >= 0.5 AND query_coverage >= 0.9),
u AS (SELECT 'hydrogenase' AS branch, protein_id, class, subject FROM y WHERE k = 1 UNION ALL SELECT 'terminal', protein_id, class, subject FROM b WHERE k = 1)
SELECT branch, protein_id, class AS "MAG", subject AS "MAG_contig_raw_id", subject AS "MAG_contig_id", class || '_' || subject || '_' || protein_id AS "MAG_contig_gene_id" FROM u"""


def manifest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as samples with one to three files; nations as coassembly groups."""
    s = t(spark, d, "supplier")
    files = F.transform(F.sequence(F.lit(1), (F.col("s_suppkey") % 3 + 1).cast("int")), lambda i: F.concat("s_name", F.lit("_"), i.cast("string"), F.lit(".fastq.gz")))
    return s.select(F.col("s_name").alias("sample"), files.alias("reads")), s.where("s_nationkey < 20").select(F.col("s_name").alias("sample"), F.concat(F.lit("g"), "s_nationkey").alias("group"))


def manifest_violations(spark: SparkSession, d: str) -> DataFrame:
    return manifests.validate_manifests(*manifest(spark, d))


MANIFEST_SQL = """WITH s AS (SELECT s_name AS sample, s_suppkey % 3 + 1 AS n, s_nationkey FROM supplier), g AS (SELECT sample, n, 'g' || s_nationkey AS grp FROM s WHERE s_nationkey < 20)
SELECT 'bad_name' AS rule, sample AS key, '' AS detail FROM s WHERE NOT regexp_matches(sample, '^[A-Za-z0-9][A-Za-z0-9._-]*$')
UNION ALL SELECT 'duplicate_sample', sample, count(*)::VARCHAR FROM s GROUP BY sample HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'not_one_or_two_files', sample, n::VARCHAR FROM s WHERE n > 2
UNION ALL SELECT 'group_too_small', grp, string_agg(DISTINCT sample, ',' ORDER BY sample) FROM g GROUP BY grp HAVING count(DISTINCT sample) < 2
UNION ALL SELECT 'mixed_read_types', grp, string_agg(DISTINCT CASE n WHEN 1 THEN 'long' WHEN 2 THEN 'short' END, ',' ORDER BY CASE n WHEN 1 THEN 'long' WHEN 2 THEN 'short' END) FROM g GROUP BY grp HAVING count(DISTINCT CASE n WHEN 1 THEN 'long' WHEN 2 THEN 'short' END) > 1
UNION ALL SELECT 'sample_in_two_groups', sample, string_agg(DISTINCT grp, ',' ORDER BY grp) FROM g GROUP BY sample HAVING count(DISTINCT grp) > 1"""


def coverage_groups(spark: SparkSession, d: str) -> DataFrame:
    return manifests.coverage_groups(*manifest(spark, d)).select(F.col("group").alias("grp"), "sample", "assembly")


GROUPS_SQL = "SELECT CASE WHEN s_nationkey < 20 THEN 'g' || s_nationkey ELSE s_name END AS grp, s_name AS sample, CASE WHEN s_nationkey < 20 THEN 'g' || s_nationkey ELSE s_name END AS assembly FROM supplier"


def differential_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Samples 0 to 3 share one assembly, the others have their own."""
    rows = alignments(spark, d).select("sample", F.when(F.col("sample") < 4, 0).otherwise(F.col("sample")).alias("assembly"), "contig", "aligned_len", F.lit(250).alias("contig_len"))
    groups = rows.select("sample", "assembly").distinct().withColumn("group", F.col("assembly"))
    out = coverage.differential_coverage(rows, groups)
    return out.select(F.col("group").cast("long").alias("grp"), F.col("contig").cast("long").alias("contig"), F.col("sample").cast("long").alias("sample"), F.round("depth", 6).alias("depth"))


DIFF_SQL = "SELECT CASE WHEN l_suppkey % 8 < 4 THEN 0 ELSE l_suppkey % 8 END::BIGINT AS grp, l_linenumber::BIGINT AS contig, l_suppkey % 8 AS sample, round(sum(l_quantity::BIGINT) / 250, 6) AS depth FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3"


def taxonomy_check(spark: SparkSession, d: str) -> DataFrame:
    """Part names by brand and type: large parts lack a classification, promoted ones have two."""
    part = t(spark, d, "part")
    one = part.where("p_size < 45").select(F.col("p_partkey").alias("mag"), F.col("p_brand").alias("classification"))
    two = part.where("p_type like 'PROMO%'").select(F.col("p_partkey").alias("mag"), F.col("p_type").alias("classification"))
    return annotation.taxonomy_violations(part.select(F.col("p_partkey").alias("mag")), annotation.merge_taxonomy(one, two))


TAXONOMY_SQL = """WITH c AS (SELECT p_partkey AS mag, p_brand AS classification FROM part WHERE p_size < 45 UNION ALL SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'PROMO%')
SELECT p_partkey AS mag, 'missing' AS problem FROM part WHERE p_partkey NOT IN (SELECT mag FROM c)
UNION ALL SELECT mag, 'inconsistent' FROM c GROUP BY mag HAVING count(DISTINCT classification) > 1"""


def merged_batches(spark: SparkSession, d: str) -> DataFrame:
    """Hits of all classes but one, then a batch of that class and of another again, put in twice: the table as if annotated at once."""
    rows = merged_annotations(spark, d).withColumn("evalue", F.lit("1e-50"))
    batch = rows.where("MAG in ('PsaA', 'RHO')")
    once = annotation.merge_annotations(rows.where("MAG <> 'PsaA'"), batch, ("evalue",))
    return annotation.merge_annotations(once, batch, ("evalue",))


def genomes_of(dna: DataFrame) -> DataFrame:
    return dna.groupBy("genome").agg(F.sum(F.length("seq").cast("long")).alias("total_bp")).withColumn("quality_score", F.col("genome") * 7919 % 101)


def representatives(dna: DataFrame) -> DataFrame:
    sketch = kept(similarity.sketches(dna, K, SCALE), "sketch")
    return similarity.dereplicate_sketches(genomes_of(dna), sketch, K)


def dereplicate(spark: SparkSession, d: str) -> DataFrame:
    """Documents as genomes: representatives and members at 99 % identity and 30 % aligned fraction. Documents without a sampled k-mer represent themselves; rows without an id are no genomes."""
    return representatives(contigs(spark, d).where("genome is not null"))


def selected_bins(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).where("bin is not null")


def dereplication_pass(spark: SparkSession, d: str) -> DataFrame:
    """The quality summary with what dereplication of the selected genomes kept."""
    summary = kept(selected_bins(spark, d), "summary")
    dna = contigs(spark, d).join(summary.where("selected").select(F.col("bin").alias("genome")).distinct(), "genome", "left_semi")
    found = representatives(dna).select(F.col("representative").alias("bin"))
    return quality.dereplication_status(summary, found).select("bin", "selected", "reason", "dereplication_pass")


def sketch_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of genomes from 95 % identity on."""
    sketch = kept(similarity.sketches(contigs(spark, d).where("genome is not null"), K, SCALE), "sketch")
    pairs = similarity.sketch_ani(sketch, K, 95)
    return pairs.where("ani >= 95").select("g1", "g2", *(F.round(c, 6).alias(c) for c in ("ani", "af1", "af2")))


def near_sql(genomes: str) -> str:
    """Tables up to near(g1, g2, ani, f1, f2): pairs of genomes that share hashes, both ways."""
    return f"""
s AS ({SEQ}), own AS (SELECT doc_id, seq FROM s WHERE doc_id IS NOT NULL AND {genomes}),
km AS (SELECT doc_id AS g, substr(seq, i, {K}) AS f FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - {K - 2})) AS i FROM own WHERE length(seq) >= {K})),
sk AS (SELECT g, h FROM (SELECT DISTINCT g, ('0x' || substr(md5(least(f, {RC.format("f")})), 1, 15))::BIGINT AS h FROM km) WHERE h % {SCALE} = 0),
sizes AS (SELECT g, count(*) AS n FROM sk GROUP BY g),
near AS (SELECT g1, g2, 100 * pow(shared / least(a.n, b.n), 1.0::DOUBLE / {K}) AS ani, 100 * shared / a.n AS f1, 100 * shared / b.n AS f2 FROM (SELECT x.g AS g1, y.g AS g2, count(*) AS shared FROM sk x JOIN sk y ON x.h = y.h AND x.g <> y.g GROUP BY 1, 2) JOIN sizes a ON a.g = g1 JOIN sizes b ON b.g = g2)"""


def greedy_sql(genomes: str = "true") -> str:
    """Tables up to rep(g, representative): one genome after the other in order of quality, each a representative unless an earlier one is near."""
    return f"""{near_sql(genomes)},
ok AS (SELECT * FROM near WHERE ani >= 99 AND greatest(f1, f2) >= 30),
ord AS (SELECT doc_id AS g, row_number() OVER (ORDER BY doc_id * 7919 % 101 DESC, sum(length(seq)) DESC, doc_id) AS k FROM own GROUP BY doc_id),
step AS (SELECT k, ord.g, coalesce(l, []) AS l FROM ord LEFT JOIN (SELECT g1, list(g2) AS l FROM ok GROUP BY g1) ON g1 = g),
walk(i, reps) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT i + 1, CASE WHEN list_has_any(reps, l) THEN reps ELSE list_append(reps, g) END FROM walk JOIN step ON k = i + 1),
chosen AS (SELECT unnest(reps) AS g FROM (SELECT reps FROM walk ORDER BY i DESC LIMIT 1)),
rep AS (SELECT g, g AS representative FROM chosen UNION ALL SELECT g1, first(g2 ORDER BY ani DESC, k) FROM ok JOIN ord ON ord.g = g2 WHERE g2 IN (SELECT g FROM chosen) AND g1 NOT IN (SELECT g FROM chosen) GROUP BY g1)"""


SELECTED = "(doc_id * 7919) % 101 >= 50 AND (doc_id * 104729) % 21 <= 10 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"


def candidate_bins(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Vectors as contigs of four samples, two binners (label, id modulo 7), and two in three with a marker of twelve."""
    v = t(spark, d, "embeddings").select(F.col("vec_id").alias("contig"), (F.col("vec_id") % 4).alias("sample"), "label")
    one = v.select("sample", F.lit("label").alias("binner"), F.col("label").cast("long").alias("bin"), "contig")
    two = v.select("sample", F.lit("modulo").alias("binner"), (F.col("contig") % 7).alias("bin"), "contig")
    markers = v.where("contig % 3 <> 0").select("sample", "contig", (F.floor(F.col("contig") / 4) % 12).alias("marker"))
    return one.unionByName(two), markers


def bin_scores(spark: SparkSession, d: str) -> DataFrame:
    out = refine.score_bins(*candidate_bins(spark, d), 12)
    return out.select("sample", "binner", "bin", F.col("contigs").cast("long").alias("contigs"), *(F.round(c, 6).alias(c) for c in ("completeness", "contamination", "quality_score")))


SCORES_SQL = """WITH v AS (SELECT vec_id AS contig, vec_id % 4 AS sample, label FROM embeddings),
c AS (SELECT sample, 'label' AS binner, label::BIGINT AS bin, contig FROM v UNION ALL SELECT sample, 'modulo', contig % 7, contig FROM v),
m AS (SELECT sample, binner, bin, contig // 4 % 12 AS marker, count(*) AS n FROM c WHERE contig % 3 <> 0 GROUP BY 1, 2, 3, 4),
p AS (SELECT sample, binner, bin, count(*) AS d, sum(n) AS n FROM m GROUP BY 1, 2, 3),
z AS (SELECT sample, binner, bin, count(*) AS contigs FROM c GROUP BY 1, 2, 3)
SELECT sample, binner, bin, contigs, round(coalesce(d, 0) * 100.0 / 12, 6)::DOUBLE AS completeness, round((coalesce(n, 0) - coalesce(d, 0)) * 100.0 / 12, 6)::DOUBLE AS contamination,
 round(coalesce(d, 0) * 100.0 / 12 - 5 * ((coalesce(n, 0) - coalesce(d, 0)) * 100.0 / 12), 6)::DOUBLE AS quality_score FROM z LEFT JOIN p USING (sample, binner, bin)"""


REFINE_LIMITS = (30, 15)


def fine_bins(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Candidate bins of some ten contigs at any size of the table, so that contamination counts: label or id modulo 7, within every 500 ids."""
    v = t(spark, d, "embeddings").select(F.col("vec_id").alias("contig"), (F.col("vec_id") % 5).alias("sample"), "label", F.floor(F.col("vec_id") / 500).alias("run")).where("sample < 4")
    one = v.select("sample", F.lit("label").alias("binner"), (F.col("label") + 100 * F.col("run")).cast("long").alias("bin"), "contig")
    two = v.select("sample", F.lit("modulo").alias("binner"), (F.col("contig") % 7 + 100 * F.col("run")).alias("bin"), "contig")
    markers = v.where("contig % 3 <> 0").select("sample", "contig", (F.floor(F.col("contig") / 4) % 12).alias("marker"))
    return one.unionByName(two), markers


def refine_bins(spark: SparkSession, d: str) -> DataFrame:
    """Bins without common contigs, at least 30 % complete and at most 15 % contaminated."""
    return refine.refine_bins(*fine_bins(spark, d), *REFINE_LIMITS, "metawrap", "checkm").select("sample", "binner", "bin", "contig", F.col("round").cast("long").alias("round"))


#: Tables up to taken(sample, binner, bin, contig, i): a step of the recursion is a round; rows marked done are out of the next.
REFINE_STEPS = f"""v AS (SELECT vec_id AS contig, vec_id % 5 AS sample, label, vec_id // 500 AS run FROM embeddings WHERE vec_id % 5 < 4),
own AS (SELECT sample, 'label' AS binner, label + 100 * run AS bin, contig FROM v UNION ALL SELECT sample, 'modulo', contig % 7 + 100 * run, contig FROM v),
mk AS (SELECT DISTINCT contig, contig // 4 % 12 AS marker FROM v WHERE contig % 3 <> 0), tot AS (SELECT count(DISTINCT marker) AS total FROM mk),
taken(i, sample, binner, bin, contig, done) AS (
 SELECT 0::BIGINT, sample, binner, bin, contig, false FROM own
 UNION ALL
 SELECT * FROM (
  WITH live AS (SELECT * FROM taken WHERE NOT done),
  per AS (SELECT sample, binner, bin, count(DISTINCT live.contig) AS size, count(DISTINCT marker) AS kinds, count(marker) AS copies FROM live LEFT JOIN mk ON mk.contig = live.contig GROUP BY ALL),
  pc AS (SELECT *, kinds * 100.0::DOUBLE / total AS com, (copies - kinds) * 100.0::DOUBLE / total AS con FROM per, tot),
  good AS (SELECT * FROM pc WHERE com >= {REFINE_LIMITS[0]} AND con <= {REFINE_LIMITS[1]}),
  ranked AS (SELECT live.sample, live.binner, live.bin, live.contig, size, row_number() OVER (PARTITION BY live.sample, live.contig ORDER BY com - 5 * con DESC, size DESC, live.binner, live.bin) AS k FROM live JOIN good ON good.sample = live.sample AND good.binner = live.binner AND good.bin = live.bin),
  pick AS (SELECT sample, binner, bin FROM ranked WHERE k = 1 GROUP BY sample, binner, bin HAVING count(*) = any_value(size)),
  gone AS (SELECT DISTINCT live.contig FROM live JOIN pick USING (sample, binner, bin))
  SELECT i + 1, sample, binner, bin, contig, (sample, binner, bin) IN (SELECT (sample, binner, bin) FROM pick) FROM live
  WHERE (SELECT count(*) FROM pick) > 0 AND ((sample, binner, bin) IN (SELECT (sample, binner, bin) FROM pick) OR contig NOT IN (SELECT contig FROM gone))))"""
REFINE_SQL = f"WITH RECURSIVE {REFINE_STEPS} SELECT sample, binner, bin, contig, i AS round FROM taken WHERE done"
REFINED_SQL = f"WITH RECURSIVE {REFINE_STEPS} SELECT s.sample, count(DISTINCT (binner, bin)) FILTER (WHERE done) AS bins FROM (SELECT DISTINCT vec_id % 5 AS sample FROM embeddings) s LEFT JOIN taken ON taken.sample = s.sample GROUP BY s.sample"


def refined_counts(spark: SparkSession, d: str) -> DataFrame:
    """Bins per sample; the fifth sample has none."""
    bins = refine_bins(spark, d).select("sample", "binner", "bin").distinct()
    samples = t(spark, d, "embeddings").select((F.col("vec_id") % 5).alias("sample"))
    return quality.refined_counts(samples, bins).select("sample", F.col("bins").cast("long").alias("bins"))


def marker_bins(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as contigs, clustered from their markers, and the bins' scores: contigs of one label and run of 50 share no marker."""
    v = t(spark, d, "embeddings")
    features = v.select(F.col("vec_id").alias("contig_id"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    marks = v.where("vec_id % 3 = 0").select(F.col("vec_id").alias("contig_id"), (F.floor(F.col("vec_id") / 3) % 12).alias("marker"))
    bins = kept(sequences.marker_clusters(features, marks).where("bin is not null"), "bins")
    placed = bins.select(F.lit(0).alias("sample"), F.lit("markers").alias("binner"), "bin", F.col("contig_id").alias("contig"))
    out = refine.score_bins(placed, marks.select(F.lit(0).alias("sample"), F.col("contig_id").alias("contig"), "marker"), 12)
    return out.select("bin", F.col("contigs").cast("long").alias("contigs"), F.round("completeness", 6).alias("completeness"), F.round("contamination", 6).alias("contamination"))


def gene_map(spark: SparkSession, d: str) -> DataFrame:
    """Orders as proteins: customer modulo 400 is the MAG."""
    o = t(spark, d, "orders")
    mag = (F.col("o_custkey") % 400).cast("string")
    return o.select(F.col("o_orderkey").alias("protein_id"), mag.alias("MAG"), F.col("o_custkey").cast("string").alias("MAG_contig_raw_id"), F.concat_ws("_", mag, "o_custkey").alias("MAG_contig_id"), F.concat_ws("_", mag, "o_custkey", "o_orderkey").alias("MAG_contig_gene_id"))


MAPPED = "SELECT o_orderkey AS protein_id, (o_custkey % 400)::VARCHAR AS \"MAG\", o_custkey::VARCHAR AS \"MAG_contig_raw_id\", (o_custkey % 400) || '_' || o_custkey AS \"MAG_contig_id\", (o_custkey % 400) || '_' || o_custkey || '_' || o_orderkey AS \"MAG_contig_gene_id\" FROM orders"


def hydrogenase_table(spark: SparkSession, d: str) -> DataFrame:
    """Part sizes up to 40 are groups of the reference, whose class is FeFe for one in three; even parts are in the second database."""
    part = t(spark, d, "part").where("p_size <= 40")
    kind = F.when(F.col("p_size") % 3 == 0, "FeFe").when(F.col("p_size") % 3 == 1, "NiFe").otherwise("Fe")
    groups = part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("HydDB_group"), kind.alias("class"))
    all_hits = hits(spark, d)
    found = annotation.add_hyd_group(annotation.hydrogenase_hits(all_hits).drop("class"), groups)
    second = all_hits.where("subject % 2 = 0").withColumn("subject", F.concat(F.lit("F"), "subject"))
    return annotation.hydrogenase_table(annotation.confirm_fefe(found, second), gene_map(spark, d))


HYD_TABLE_SQL = f"""WITH h AS ({HITS}), g AS (SELECT p_partkey AS subject, p_brand AS "HydDB_group", CASE p_size % 3 WHEN 0 THEN 'FeFe' WHEN 1 THEN 'NiFe' ELSE 'Fe' END AS "Gene" FROM part WHERE p_size <= 40),
f AS (SELECT protein_id, 'F' || subject AS subject, identity, bitscore, row_number() OVER (PARTITION BY protein_id ORDER BY bitscore DESC, identity DESC, 'F' || subject) AS k FROM h WHERE subject % 2 = 0),
j AS (SELECT h.protein_id, h.subject, "HydDB_group", "Gene", f.subject AS fs, f.identity AS fi, f.bitscore AS fb FROM h LEFT JOIN g USING (subject) LEFT JOIN f ON f.protein_id = h.protein_id AND k = 1 WHERE h.identity >= 0.5 AND query_coverage >= 0.9)
SELECT "MAG", "MAG_contig_raw_id", "MAG_contig_id", "MAG_contig_gene_id", "Gene", subject AS "HydDB_subject", "HydDB_group", CASE WHEN "Gene" = 'FeFe' THEN fs END AS "FeFe_subject", CASE WHEN "Gene" = 'FeFe' THEN fi END AS "FeFe_identity", CASE WHEN "Gene" = 'FeFe' THEN 1e-60::DOUBLE END AS "FeFe_evalue", CASE WHEN "Gene" = 'FeFe' THEN fb END AS "FeFe_bitscore"
FROM j JOIN ({MAPPED}) USING (protein_id) WHERE "Gene" IS DISTINCT FROM 'FeFe' OR fs IS NOT NULL"""


def terminal_table(spark: SparkSession, d: str) -> DataFrame:
    titles = t(spark, d, "part").select(F.col("p_partkey").alias("subject"), F.col("p_name").alias("title"))
    return annotation.terminal_table(annotation.terminal_hits(hits(spark, d)), gene_map(spark, d), titles)


TERMINAL_TABLE_SQL = f'WITH {TERMINAL} SELECT "MAG", "MAG_contig_raw_id", "MAG_contig_id", "MAG_contig_gene_id", class AS "Gene", subject AS "Reference", p_name AS "Reference_title", cutoff AS "Required_identity" FROM b JOIN ({MAPPED}) USING (protein_id) LEFT JOIN part ON p_partkey = subject WHERE k = 1'


def ko_lookup(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = t(spark, d, "part")
    lookup = annotation.ko_descriptions_from_list(part.where("p_size <= 25").select(F.col("p_partkey").alias("knum"), F.concat_ws("; ", "p_brand", "p_type").alias("definition")))
    return t(spark, d, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.col("l_partkey").alias("KO")), lookup


def kegg_table(spark: SparkSession, d: str) -> DataFrame:
    return annotation.kegg_table(annotation.annotate_ko(*ko_lookup(spark, d)), gene_map(spark, d))


def missing_ko_descriptions(spark: SparkSession, d: str) -> DataFrame:
    return annotation.missing_ko_descriptions(annotation.annotate_ko(*ko_lookup(spark, d)))


def abundance_table(spark: SparkSession, d: str) -> DataFrame:
    """All samples side by side in two metrics."""
    wide = coverage.abundance_table(coverage.assigned_only(metrics(spark, d)), list(range(8)), ("mean", "reads"))
    return wide.select("mag", *(F.round(F.col(f"`{k}_mean`"), 6).alias(f"s{k}_mean") for k in range(8)), *(F.col(f"`{k}_reads`").cast("long").alias(f"s{k}_reads") for k in range(8)))


def abundance_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Abundances with the ranks of a lineage: brand, type, container of words; two batches of each merged."""
    rows = abundance(spark, d)
    whole = annotation.merge_abundance(rows.where("mag % 2 = 0"), rows.where("mag % 2 = 1"))
    lineage = t(spark, d, "part").select(F.col("p_partkey").alias("mag"), F.concat_ws(";", F.lit("d__Bacteria"), "p_brand", F.get(F.split("p_type", " "), F.lit(0)), F.get(F.split("p_type", " "), F.lit(1))).alias("classification"))
    return annotation.add_taxonomy(whole, lineage).select("mag", "sample", F.col("abundance").cast("long").alias("abundance"), F.col("reads").cast("long").alias("reads"), "domain", "phylum", "class", "order", "family")


ABUNDANCE_TAXONOMY_SQL = """SELECT l_partkey AS mag, l_suppkey % 8 AS sample, sum(l_quantity::BIGINT)::BIGINT AS abundance, count(*)::BIGINT AS reads, 'd__Bacteria' AS domain, any_value(p_brand) AS phylum,
 split_part(any_value(p_type), ' ', 1) AS class, nullif(split_part(any_value(p_type), ' ', 2), '') AS "order", NULL::VARCHAR AS family FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


def multi_coverage_groups(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers of the first nations are read against each other's assemblies."""
    reads, _ = manifest(spark, d)
    listed = t(spark, d, "supplier").where("s_nationkey < 5").select(F.col("s_name").alias("sample"))
    return manifests.coverage_groups(reads, multi=listed).select(F.col("group").alias("grp"), "sample", "assembly")


def niche_gate_skip(spark: SparkSession, d: str) -> DataFrame:
    """Three orders of parts are too few taxa for classes."""
    return niche.niche_gate(abundance(spark, d), t(spark, d, "part").select(F.col("p_partkey").alias("mag"), (F.col("p_partkey") % 3).cast("string").alias("taxon")))


def contig_features(spark: SparkSession, d: str) -> DataFrame:
    """The whole vector of every document, in millionths: 136 frequencies in the order of their names."""
    rows = sequences.contig_features(contigs(spark, d).where("contig_id is not null"))
    millionths = F.array_join(F.transform("features", lambda x: F.floor(x * 1e6 + 0.5).cast("string")), ",")
    return rows.select("contig_id", F.size("features").cast("long").alias("features"), F.round(F.array_max("features"), 6).alias("largest"), millionths.alias("vector"))


FEATURES_SQL = f"""WITH s AS ({SEQ}), k AS (SELECT doc_id, substr(seq, i, 4) AS f FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - 2)) AS i FROM s WHERE doc_id IS NOT NULL AND length(seq) >= 4)),
n AS (SELECT doc_id, least(f, {RC.format("f")}) AS kmer, count(*) AS n FROM k GROUP BY 1, 2), whole AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY 1),
b AS (SELECT unnest(['A', 'C', 'G', 'T']) AS x), w AS (SELECT a.x || c.x || g.x || t.x AS f FROM b a, b c, b g, b t), names AS (SELECT DISTINCT least(f, {RC.format("f")}) AS kmer FROM w),
v AS (SELECT whole.doc_id, names.kmer, coalesce(n.n, 0) / total AS x FROM whole CROSS JOIN names LEFT JOIN n ON n.doc_id = whole.doc_id AND n.kmer = names.kmer)
SELECT doc_id AS contig_id, count(*)::BIGINT AS features, round(max(x), 6) AS largest, string_agg(floor(x * 1e6 + 0.5)::BIGINT::VARCHAR, ',' ORDER BY kmer) AS vector FROM v GROUP BY 1"""


def binning_features(spark: SparkSession, d: str) -> DataFrame:
    """Composition and depths in eight samples of every document as a contig, whole vectors in ten-thousandths: parts' quantities are the bases aligned to documents of their number."""
    dna = contigs(spark, d).where("contig_id is not null")
    lengths = dna.where("length(seq) > 0").select(F.col("contig_id").alias("contig"), F.length("seq").cast("long").alias("contig_len"))
    lengths = kept(lengths, "lengths")  # used twice, and each use would read all texts
    aligned = t(spark, d, "lineitem").select(F.col("l_partkey").alias("contig"), (F.col("l_suppkey") % 8).alias("sample"), F.lit("all").alias("assembly"), F.col("l_quantity").cast("long").alias("aligned_len")).join(lengths, "contig")
    groups = spark.range(8).select(F.lit("multi").alias("group"), F.col("id").alias("sample"), F.lit("all").alias("assembly"))
    depths = coverage.differential_coverage(aligned, groups)
    vectors = coverage.depth_vectors(depths, groups, lengths.select(F.lit("multi").alias("group"), "contig"))
    rows = sequences.contig_features(dna, "contig_id", vectors.select(F.col("contig").alias("contig_id"), "depths"))
    return rows.select("contig_id", F.size("features").cast("long").alias("features"), F.array_join(F.transform("features", lambda x: F.floor(x * 1e4 + 0.5).cast("string")), ",").alias("vector"))


BINNING_SQL = f"""WITH {{composition}},
len AS (SELECT doc_id, length(seq) AS bp FROM s WHERE doc_id IS NOT NULL AND length(seq) > 0), smp AS (SELECT range AS sample FROM range(8)),
dep AS (SELECT doc_id, l_suppkey % 8 AS sample, ln(1 + sum(l_quantity::BIGINT)::DOUBLE / any_value(bp)) AS x FROM lineitem JOIN len ON l_partkey = doc_id GROUP BY 1, 2),
grid AS (SELECT len.doc_id, smp.sample, coalesce(x, 0) AS x FROM len CROSS JOIN smp LEFT JOIN dep ON dep.doc_id = len.doc_id AND dep.sample = smp.sample),
z AS (SELECT doc_id, sample, CASE WHEN stddev_pop(x) OVER w > 1e-9 THEN (x - avg(x) OVER w) / stddev_pop(x) OVER w ELSE 0 END AS x FROM grid WINDOW w AS (PARTITION BY sample)),
joint AS (SELECT doc_id, 0 AS part, kmer AS name, x FROM v UNION ALL SELECT doc_id, 1, sample::VARCHAR, x FROM z WHERE doc_id IN (SELECT doc_id FROM whole))
SELECT doc_id AS contig_id, count(*)::BIGINT AS features, string_agg(floor(x * 1e4 + 0.5)::BIGINT::VARCHAR, ',' ORDER BY part, name) AS vector FROM joint GROUP BY 1""".replace("{composition}", FEATURES_SQL.removeprefix("WITH ").rpartition("\nSELECT")[0])


def kmer_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents as reads against those of labelled quality as genomes."""
    dna = contigs(spark, d).where("contig_id is not null").select(F.col("contig_id").alias("read_id"), "seq")
    known = t(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("read_id"))
    genomes = dna.join(known, "read_id", "left_semi").select(F.col("read_id").alias("genome"), "seq")
    return coverage.kmer_profile(dna, genomes, K).select("read_id", "mag", F.col("shared").cast("long").alias("shared"), F.round("fraction", 6).alias("fraction"))


PROFILE_SQL = f"""WITH s AS ({SEQ}), km AS (SELECT DISTINCT doc_id, least(f, {RC.format("f")}) AS kmer FROM (SELECT doc_id, substr(seq, i, {K}) AS f FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - {K - 2})) AS i FROM s WHERE doc_id IS NOT NULL AND length(seq) >= {K}))),
hit AS (SELECT a.doc_id AS read_id, b.doc_id AS mag, count(*) AS shared FROM km a JOIN km b USING (kmer) WHERE b.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY shared DESC, mag DESC) AS k FROM hit),
size AS (SELECT doc_id AS read_id, count(*) AS n FROM km GROUP BY 1)
SELECT read_id, mag, shared::BIGINT AS shared, round(shared / n, 6) AS fraction FROM best JOIN size USING (read_id) WHERE k = 1 AND shared / n >= 0.5"""


QUERIES = {
    "niche_cv": niche_query(), "niche_cv_corrected": niche_query(correct=True), "niche_occupancy": niche_query("occupancy"), "taxon_abundance": taxon_abundance, "niche_gate": niche_gate, "genome_to_taxon": genome_to_taxon,
    "quality_summary": candidates, "rna_quality": rna_quality, "covered_fraction": covered_fraction, "abundance_metrics": abundance_metrics, "abundance_matrix": abundance_matrix,
    "hydrogenase_hits": hydrogenase_hits, "terminal_hits": terminal_hits, "gene_counts": gene_counts, "ko_annotation": ko_annotation, "contig_stats": contig_stats, "contig_rename": contig_rename, "bin_export": bin_export,
    "tetranucleotide": tetranucleotide, "pending_mags": pending_mags, "merged_annotations": merged_annotations, "manifest_violations": manifest_violations, "coverage_groups": coverage_groups,
    "differential_coverage": differential_coverage, "taxonomy_check": taxonomy_check, "dereplicate": dereplicate,
    "dereplication_pass": dereplication_pass, "sketch_pairs": sketch_pairs, "bin_scores": bin_scores, "refine_bins": refine_bins, "refined_counts": refined_counts,
    "hydrogenase_table": hydrogenase_table, "terminal_table": terminal_table, "kegg_table": kegg_table, "missing_ko_descriptions": missing_ko_descriptions, "merged_batches": merged_batches, "abundance_table": abundance_table,
    "abundance_taxonomy": abundance_taxonomy, "multi_coverage_groups": multi_coverage_groups, "niche_gate_skip": niche_gate_skip, "contig_features": contig_features, "binning_features": binning_features, "marker_bins": marker_bins, "kmer_profile": kmer_profile,
}

ORACLE_SQL = {
    "niche_cv": niche_sql(), "niche_cv_corrected": niche_sql(correct=True), "niche_occupancy": niche_sql("occupancy"),
    "taxon_abundance": "SELECT p_brand AS taxon, l_suppkey % 8 AS sample, sum(l_quantity::BIGINT)::BIGINT AS abundance, count(*)::BIGINT AS reads FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
    "niche_gate": "SELECT CASE WHEN m >= 4 AND s >= 4 AND x >= 4 THEN 'run' ELSE 'skipped' END AS status, CASE WHEN m < 4 THEN 'too_few_mags' WHEN s < 4 THEN 'too_few_samples' WHEN x < 4 THEN 'too_few_taxa' ELSE 'pass' END AS reason, m AS mags, s AS samples, x AS taxa FROM (SELECT count(DISTINCT l_partkey) AS m, count(DISTINCT l_suppkey % 8) AS s, count(DISTINCT p_type) AS x FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)",
    "genome_to_taxon": f"SELECT p_partkey AS mag, p_brand AS taxon, niche, correct_cv_classification FROM part LEFT JOIN ({niche_sql()}) n ON p_brand = taxon",
    "quality_summary": QUALITY_SQL, "rna_quality": RNA_SQL, "covered_fraction": COVERED_SQL, "abundance_metrics": METRICS_SQL, "abundance_matrix": MATRIX_SQL, "hydrogenase_hits": HYD_SQL, "terminal_hits": TERMINAL_SQL,
    "gene_counts": f'WITH {TERMINAL} SELECT subject % 400 AS "MAG", class AS function, count(DISTINCT protein_id)::BIGINT AS genes FROM b WHERE k = 1 AND class <> \'other\' GROUP BY 1, 2',
    "ko_annotation": 'SELECT l_partkey AS "KO", CASE WHEN p_size <= 25 THEN p_brand END AS "KO_gene_name", CASE WHEN p_size <= 25 THEN p_type END AS "KO_description", count(*) AS genes FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3',
    "contig_stats": f"WITH s AS ({SEQ}), b AS (SELECT source AS bin, sum(length(seq))::BIGINT AS total_bp, count(*)::BIGINT AS contigs FROM s WHERE length(seq) >= 1500 GROUP BY 1 HAVING sum(length(seq)) >= 10000) SELECT bin, 'cohort_tool_' || row_number() OVER (ORDER BY total_bp DESC, bin) AS name, total_bp, contigs FROM b",
    "contig_rename": f"WITH s AS ({SEQ}) SELECT doc_id AS contig_id, source || '_' || row_number() OVER (PARTITION BY source ORDER BY length(seq) DESC, doc_id) AS new_id FROM s",
    "bin_export": f"WITH s AS ({SEQ}) SELECT source AS to_bin, s.doc_id AS contig_id, sha256(seq) AS seq_sha256 FROM s JOIN labels l ON s.doc_id = l.doc_id WHERE quality = 1",
    "tetranucleotide": TETRA_SQL, "pending_mags": "SELECT p_partkey AS mag FROM part WHERE p_size > 25", "merged_annotations": MERGED_SQL, "manifest_violations": MANIFEST_SQL, "coverage_groups": GROUPS_SQL, "differential_coverage": DIFF_SQL, "taxonomy_check": TAXONOMY_SQL,
    "dereplicate": f"WITH RECURSIVE {greedy_sql()} SELECT g AS genome, representative FROM rep",
    "dereplication_pass": f"WITH RECURSIVE {greedy_sql(SELECTED)}, q AS ({QUALITY_SQL}) SELECT bin, selected, reason, CASE WHEN NOT selected THEN 'Not evaluated' WHEN bin IN (SELECT representative FROM rep) THEN 'TRUE' ELSE 'FALSE' END AS dereplication_pass FROM q WHERE bin IS NOT NULL",
    "sketch_pairs": f"WITH {near_sql('true')} SELECT g1, g2, round(ani, 6) AS ani, round(f1, 6) AS af1, round(f2, 6) AS af2 FROM near WHERE g1 < g2 AND ani >= 95",
    "bin_scores": SCORES_SQL, "hydrogenase_table": HYD_TABLE_SQL, "terminal_table": TERMINAL_TABLE_SQL,
    "kegg_table": f'SELECT "MAG", "MAG_contig_raw_id", "MAG_contig_id", "MAG_contig_gene_id", l_partkey AS "Gene", CASE WHEN p_size <= 25 THEN p_brand END AS "KO_gene_name", CASE WHEN p_size <= 25 THEN p_type END AS "KO_description" FROM lineitem JOIN ({MAPPED}) ON protein_id = l_orderkey LEFT JOIN part ON l_partkey = p_partkey',
    "missing_ko_descriptions": "SELECT count(DISTINCT l_partkey) AS missing FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_size IS NULL OR p_size > 25",
    "abundance_table": f"WITH {METRICS} SELECT mag, {', '.join(f'round(coalesce(max(mean) FILTER (sample = {k}), 0), 6) AS s{k}_mean, coalesce(max(reads) FILTER (sample = {k}), 0)::BIGINT AS s{k}_reads' for k in range(8))} FROM z WHERE mag <> 'unmapped' GROUP BY mag",
    "abundance_taxonomy": ABUNDANCE_TAXONOMY_SQL,
    "multi_coverage_groups": "SELECT 'multi' AS grp, a.s_name AS sample, b.s_name AS assembly FROM supplier a, supplier b WHERE a.s_nationkey < 5 AND b.s_nationkey < 5 UNION ALL SELECT s_name, s_name, s_name FROM supplier WHERE s_nationkey >= 5",
    "niche_gate_skip": "SELECT 'skipped' AS status, 'too_few_taxa' AS reason, count(DISTINCT l_partkey) AS mags, count(DISTINCT l_suppkey % 8) AS samples, count(DISTINCT l_partkey % 3) AS taxa FROM lineitem",
    "merged_batches": f"SELECT *, '1e-50' AS evalue FROM ({MERGED_SQL})", "refine_bins": REFINE_SQL, "refined_counts": REFINED_SQL, "contig_features": FEATURES_SQL, "binning_features": BINNING_SQL, "kmer_profile": PROFILE_SQL,
}
