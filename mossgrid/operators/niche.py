"""Niche classes of taxa from abundances: coefficient of variation or occupancy over all samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.functions.common import classified, kept, reasons, running


def taxon_abundance(abundance: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(taxon, sample, abundance, reads): sums over the members of each classified taxon. Repeated rows of taxonomy count once, those of abundance add up; rows without a MAG belong to no taxon."""
    known = taxonomy.where(classified(F.col("taxon"))).select("mag", "taxon").distinct()
    return summed(abundance.join(known, "mag"))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("taxon", "sample").agg(F.sum("abundance").alias("abundance"), F.sum("reads").alias("reads"))


def within_sample_percent(abundance: DataFrame) -> DataFrame:
    """Abundance as a percentage of its sample's total; a sample without any has 0. Totals are one row per sample."""
    totals = abundance.groupBy(F.col("sample").alias("_sample")).agg(F.sum("abundance").alias("_total"))
    joined = abundance.join(totals, F.col("sample").eqNullSafe(F.col("_sample")))
    return joined.withColumn("abundance", F.coalesce(F.try_divide(F.col("abundance") * 100.0, F.col("_total")), F.lit(0.0))).drop("_sample", "_total")


def niche_stats(taxa: DataFrame, samples: int, min_percent: float = 0.001) -> DataFrame:
    """Per taxon over all samples, absent ones as zeros: occupancy, reads, mean, CV with sample deviation, the bias sqrt(K / R) and the corrected CV (negatives kept).

    taxa: (taxon, sample, abundance, reads), a row where the taxon was found. Zeros enter by their number, so no row stands
    for them.
    """
    found, k = F.count("abundance").cast("double"), F.lit(float(samples))
    occupied = F.sum(F.when(F.col("abundance") >= min_percent, 1).otherwise(0))
    per = taxa.groupBy("taxon").agg(found.alias("n"), occupied.alias("occupied"), F.sum("reads").alias("total_reads"), F.avg("abundance").alias("m"), F.var_pop("abundance").alias("v"))
    absent = k - F.col("n")
    occupied = F.col("occupied") + (absent if min_percent <= 0 else F.lit(0.0))
    # Squares around the joint mean: those of the found rows, and what the distance of their mean from 0 adds.
    squares = F.col("v") * F.col("n") + F.col("m") * F.col("m") * F.col("n") * F.try_divide(absent, k)
    out = per.select("taxon", F.try_divide(occupied, k).alias("overall_occupancy"), "total_reads", F.try_divide(F.col("m") * F.col("n"), k).alias("mean"), F.sqrt(F.try_divide(squares, k - 1)).alias("sd"))
    out = out.withColumn("raw_si_cv", F.try_divide("sd", "mean")).withColumn("expected_si_bias_sqrt_K_over_N", F.sqrt(F.try_divide(k, F.col("total_reads"))))
    return out.withColumn("corrected_si", F.col("raw_si_cv") - F.col("expected_si_bias_sqrt_K_over_N")).drop("sd")


def niche_eligible(stats: DataFrame, method: str, selected: Column, min_reads: int = 20) -> DataFrame:
    """Adds eligible and reason. Supported: mean above 0, reads enough and (cv) a finite selected value."""
    lacks = lambda c: ~F.coalesce(c, F.lit(False))
    finite = selected.isNotNull() & ~F.isnan(selected.cast("double")) if method == "cv" else F.lit(True)
    why = reasons((lacks(F.col("mean") > 0), "not_found"), (lacks(F.col("total_reads") >= min_reads), "too_few_reads"), (lacks(finite), "no_finite_value"))
    return stats.withColumn("reason", why).withColumn("eligible", F.col("reason") == "pass")


def classify_niche(stats: DataFrame, method: str = "cv", cv_correct: bool = False, min_reads: int = 20) -> DataFrame:
    """Ranks supported taxa (name breaks ties) and labels tails of floor(n / 4). Occupancy turns the labels around.

    reason tells where a taxon stands: low_tail, high_tail or between_tails of the ranking, or what it lacks to be ranked.
    """
    if method not in ("cv", "occupancy") or (cv_correct and method != "cv"):
        raise ValueError("method is cv or occupancy, and correction needs cv")
    selected = F.col({"cv": "corrected_si" if cv_correct else "raw_si_cv", "occupancy": "overall_occupancy"}[method])
    rows = niche_eligible(stats, method, selected, min_reads).withColumn("selected", selected)
    ok = F.col("eligible")
    # Supported taxa come first in the order, so their places are their ranks.
    rows = running(rows, [ok.desc(), F.col("selected"), F.col("taxon")], place=F.lit(1))
    rows = kept(rows.withColumn("cv_quartile_rank", F.when(ok, F.col("place")).cast("long")).drop("place"), "ranked")
    whole = rows.where(ok).agg(F.count("*").alias("n"), F.avg("corrected_si").alias("community_mean_corrected_si"))
    rows = rows.crossJoin(F.broadcast(whole))  # one row
    low, high = F.col("cv_quartile_rank") <= F.floor(F.col("n") / 4), F.col("cv_quartile_rank") > F.col("n") - F.floor(F.col("n") / 4)
    ends = rows.agg(F.max(F.when(low, F.col("selected"))).alias("lo"), F.min(F.when(high, F.col("selected"))).alias("hi"))
    rows = rows.crossJoin(F.broadcast(ends))  # one row
    names = ("generalist", "specialist") if method == "cv" else ("specialist", "generalist")
    rows = rows.withColumn("niche", F.when(~ok, "unclassified_low_support").when(low, names[0]).when(high, names[1]).otherwise("intermediate"))
    rows = rows.withColumn("reason", F.when(~ok, F.col("reason")).when(low, "low_tail").when(high, "high_tail").otherwise("between_tails"))
    rows = rows.withColumn("cv_low_tail_max", F.when(ok, F.col("lo"))).withColumn("cv_high_tail_min", F.when(ok, F.col("hi")))
    return rows.withColumn("method", F.lit(method)).withColumn("correct_cv_classification", F.lit("TRUE" if cv_correct else "FALSE")).drop("n", "lo", "hi", "selected")


def niche_classification(abundance: DataFrame, taxonomy: DataFrame, rank: str = "family", metric: str = "relative_abundance", method: str = "cv", cv_correct: bool = False, min_reads: int = 20, min_percent: float = 0.001) -> DataFrame:
    """The whole chain from long abundances (mag, sample, abundance, reads) and taxonomy (mag, taxon). Abundances are read once.

    Repeated rows of taxonomy count once, those of abundance add up. A MAG of several taxa counts in each. Rows without a MAG
    belong to no taxon, but to their sample's total. Without a sample, there are no taxa to rank, and the table is empty.
    """
    used = within_sample_percent(abundance) if method == "occupancy" and metric != "relative_abundance" else abundance
    known = taxonomy.where(classified(F.col("taxon"))).select("mag", "taxon").distinct()
    rows = kept(used.join(known, "mag", "left").select("mag", "taxon", "sample", "abundance", "reads"), "taxa")
    samples = rows.agg(F.count_distinct("sample").alias("k")).first()["k"]
    named = rows.where("taxon is not null")
    stats = niche_stats(summed(named), samples, min_percent)
    out = classify_niche(stats, method, cv_correct, min_reads)
    members = named.groupBy("taxon").agg(F.count_distinct("mag").alias("member_mags"))
    return out.join(members, "taxon", "left").withColumn("rank", F.lit(rank)).withColumn("abundance_metric", F.lit(metric))


def niche_gate(abundance: DataFrame, taxonomy: DataFrame, least: int = 4) -> DataFrame:
    """One row (status, reason, mags, samples, taxa): whether there are MAGs, samples and classified taxa enough; the first that lacks is the reason."""
    a = abundance.agg(F.count_distinct("mag").alias("mags"), F.count_distinct("sample").alias("samples"))
    t = abundance.select("mag").distinct().join(taxonomy.where(classified(F.col("taxon"))), "mag").agg(F.count_distinct("taxon").alias("taxa"))
    row = a.crossJoin(t)
    reason = F.when(F.col("mags") < least, "too_few_mags").when(F.col("samples") < least, "too_few_samples").when(F.col("taxa") < least, "too_few_taxa")
    return row.select(F.when(reason.isNull(), "run").otherwise("skipped").alias("status"), F.coalesce(reason, F.lit("pass")).alias("reason"), "mags", "samples", "taxa")


def genome_to_taxon(taxonomy: DataFrame, niche: DataFrame) -> DataFrame:
    """(mag, taxon, niche, correct_cv_classification) of every MAG; repeated rows stand once, a taxon without a class has nulls."""
    return taxonomy.select("mag", "taxon").distinct().join(niche.select("taxon", "niche", "correct_cv_classification"), "taxon", "left").select("mag", "taxon", "niche", "correct_cv_classification")
