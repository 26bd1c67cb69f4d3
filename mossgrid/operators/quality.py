"""Quality gates of candidate genomes, with four-state text flags and explicit reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.functions.common import one_per, reasons

RRNA = ("5S", "16S", "23S")


def with_quality_score(quality: DataFrame) -> DataFrame:
    return quality.withColumn("quality_score", F.col("completeness") - 5 * F.col("contamination"))


def refinement_thresholds(com: float, con: float, refiner: str = "magscot", estimator: str = "checkm2") -> tuple[float, float] | None:
    """Thresholds that a refiner gets, in percent: relaxed by 20 % of their own value, unchanged for MetaWRAP with CheckM, none for DAS Tool."""
    if refiner == "dastool":
        return None
    return (com, con) if (refiner, estimator) == ("metawrap", "checkm") else (com * 0.8, min(con * 1.2, 100.0))


def gunc_status(bins: DataFrame, gunc: DataFrame | None, least_score: float = 0.3) -> DataFrame:
    """Adds pass_gunc: not_run without results, else true or false, or unscored for missing rows, calls that are neither, and low representation."""
    if gunc is None:
        return bins.withColumn("pass_gunc", F.lit("not_run"))
    call = F.lower(F.col("call"))
    known = F.coalesce(call.isin("true", "false") & (F.col("score") >= least_score), F.lit(False))
    calls = one_per(gunc.select("bin", F.col("pass").cast("string").alias("call"), F.col("reference_representation_score").alias("score")), "bin", "score", "call")
    return bins.join(calls, "bin", "left").withColumn("pass_gunc", F.when(known, call).otherwise("unscored")).drop("call", "score")


def rna_quality(rna: DataFrame) -> DataFrame:
    """Per genome: distinct tRNA types, which rRNA genes were found, and the predictions' errors, joined by semicolons ("" if none)."""
    is_trna, is_rrna = F.col("kind") == "tRNA", F.col("kind") == "rRNA"
    found = lambda t: F.coalesce(F.max(is_rrna & (F.col("type") == t)), F.lit(False)).alias(f"rrna_{t}")
    errors = F.array_join(F.array_sort(F.collect_set("error")), ";").alias("error") if "error" in rna.columns else F.lit("").alias("error")
    return rna.groupBy("genome").agg(F.count_distinct(F.when(is_trna, F.col("type"))).alias("trna_types"), *map(found, RRNA), errors)


def rna_report(rna: DataFrame, domains: DataFrame, trna_pass: int | None = None, rrna_pass: bool = False) -> DataFrame:
    """The reported table: (genome, domain, trna_types, rrna_5S, rrna_16S, rrna_23S, pass, error). domains: (genome, domain); a genome without one has null."""
    found = rna_quality(rna).withColumn("pass", rna_status(trna_pass, rrna_pass)).join(domains.select("genome", "domain"), "genome", "left")
    return found.select("genome", "domain", "trna_types", *(f"rrna_{t}" for t in RRNA), "pass", "error")


def rna_status(trna_pass: int | None, rrna_pass: bool, predicted: bool = True) -> Column:
    """pass_rna over rna_quality columns: not_run, `Not filtered`, or true/false of the filters asked for."""
    if trna_pass is None and not rrna_pass:
        return F.lit("Not filtered" if predicted else "not_run")
    ok = F.lit(True)
    if trna_pass is not None:
        ok = ok & (F.coalesce("trna_types", F.lit(0)) >= trna_pass)
    for t in RRNA if rrna_pass else ():
        ok = ok & F.coalesce(f"rrna_{t}", F.lit(False))
    return F.when(ok, "true").otherwise("false")


def select_quality(df: DataFrame, com: float = 50, con: float = 10, score: float | None = None) -> DataFrame:
    """Adds selected and reason. Limits are inclusive; unscored and not_run never exclude."""
    lacks = lambda c: F.coalesce(~c, F.lit(True))
    why = reasons((lacks(F.col("completeness") >= com), "low_completeness"), (lacks(F.col("contamination") <= con), "high_contamination"), (F.lit(False) if score is None else lacks(F.col("quality_score") >= score), "low_quality_score"), (F.col("pass_gunc") == "false", "gunc_failed"), (F.col("pass_rna") == "false", "rna_failed"))
    return df.withColumn("reason", why).withColumn("selected", F.col("reason") == "pass")


def quality_summary(candidates: DataFrame, quality: DataFrame, gunc: DataFrame | None = None, rna: DataFrame | None = None, com: float = 50, con: float = 10, score: float | None = None, trna_pass: int | None = None, rrna_pass: bool = False) -> DataFrame:
    """Every candidate with its estimates, flags, selection and reason. Of several rows of a bin in another table one is taken (see one_per); a candidate without estimates isn't selected."""
    df = with_quality_score(candidates.select("bin").join(one_per(quality, "bin", "completeness", "contamination"), "bin", "left"))
    df = gunc_status(df, gunc)
    df = df if rna is None else df.join(rna_quality(rna).withColumnRenamed("genome", "bin"), "bin", "left")
    df = df.withColumn("pass_rna", rna_status(trna_pass, rrna_pass, True) if rna is not None else F.lit("not_run"))
    return select_quality(df, com, con, score).select("bin", "completeness", "contamination", "quality_score", "pass_gunc", "pass_rna", "selected", "reason")


def dereplication_status(summary: DataFrame, representatives: DataFrame | None, complete: bool = True) -> DataFrame:
    """Adds dereplication_pass to all candidates: Not evaluated, Pending, TRUE or FALSE."""
    if representatives is None or not complete:
        return summary.withColumn("dereplication_pass", F.when(F.col("selected"), "Pending").otherwise("Not evaluated"))
    marked = summary.join(representatives.select("bin").distinct().withColumn("kept", F.lit(True)), "bin", "left")
    return marked.withColumn("dereplication_pass", F.when(~F.col("selected"), "Not evaluated").when(F.col("kept"), "TRUE").otherwise("FALSE")).drop("kept")


def refined_counts(samples: DataFrame, bins: DataFrame) -> DataFrame:
    """Bins per sample; a sample without any counts 0."""
    return samples.select("sample").distinct().join(bins.groupBy("sample").agg(F.count("*").alias("n")), "sample", "left").select("sample", F.coalesce("n", F.lit(0)).alias("bins"))


def require_bins(counts: DataFrame) -> None:
    """Fails when every sample is empty."""
    if not counts.agg(F.sum("bins")).first()[0]:
        raise ValueError("No refined FASTA bins were collected")
