"""Bin refinement: candidate bins of several binners, scored by marker genes, become bins that share no contig."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, union
from mossgrid.operators.quality import refinement_thresholds

BIN = ("sample", "binner", "bin")


def score_bins(contig2bin: DataFrame, markers: DataFrame, total: int | None = None) -> DataFrame:
    """(sample, binner, bin, contigs, completeness, contamination, quality_score) in percent from single-copy markers.

    contig2bin: (sample, binner, bin, contig); markers: (sample, contig, marker), a row per copy. total is the number of
    different markers, counted if None. Bins without a marker are 0 % complete.
    """
    total = total or markers.agg(F.count_distinct("marker")).first()[0] or 1
    copies = markers.groupBy("sample", "contig", "marker").agg(F.count("*").alias("copies"))
    found = contig2bin.join(copies, ["sample", "contig"]).groupBy(*BIN, "marker").agg(F.sum("copies").alias("copies"))
    per = found.groupBy(*BIN).agg(F.count("*").alias("distinct_markers"), F.sum("copies").alias("copies"))
    sizes = contig2bin.groupBy(*BIN).agg(F.count_distinct("contig").alias("contigs"))
    out = sizes.join(per, list(BIN), "left").na.fill(0, ["distinct_markers", "copies"])
    out = out.withColumn("completeness", F.col("distinct_markers") * 100.0 / total).withColumn("contamination", (F.col("copies") - F.col("distinct_markers")) * 100.0 / total)
    return out.select(*BIN, "contigs", "completeness", "contamination", (F.col("completeness") - 5 * F.col("contamination")).alias("quality_score"))


def _scores(bins: DataFrame, total: int) -> DataFrame:
    """Completeness, contamination and place in the order of choice of (bin, contigs, kinds, copies)."""
    df = bins.withColumn("completeness", F.col("kinds") * 100.0 / total).withColumn("contamination", (F.col("copies") - F.col("kinds")) * 100.0 / total)
    score = F.col("completeness") - 5 * F.col("contamination")
    return df.withColumn("place", F.struct((-score).alias("score"), (-F.col("contigs")).alias("size"), "binner", "bin"))


def refine_bins(contig2bin: DataFrame, markers: DataFrame, com: float = 50, con: float = 10, refiner: str = "magscot", estimator: str = "checkm2") -> DataFrame:
    """(sample, binner, bin, contig, round): bins that share no contig, from those that meet the refiner's thresholds.

    In a round every bin is taken that is the best of all on each of its contigs (score, then more contigs, then binner and
    name). Its contigs leave the other bins. Copies of markers per bin are kept, and what left is subtracted: only bins that
    lost a contig are scored again, and only bins on a contig of such a bin are looked at in the next round. It ends with a
    round that takes none, after as many rounds as there are bins at most. Samples are independent, and one without a bin is
    a valid result. Repeated rows of contig2bin count once; rows with a null name no bin.
    """
    limits = refinement_thresholds(com, con, refiner, estimator) or (0.0, 100.0)
    total = markers.agg(F.count_distinct("marker")).first()[0] or 1
    key = list(BIN)
    found = kept(markers.groupBy("sample", "contig", "marker").agg(F.count("*").alias("copies")), "markers")
    left = kept(contig2bin.select(*BIN, "contig").dropna().distinct(), "bins")
    counts = kept(left.join(found, ["sample", "contig"]).groupBy(*BIN, "marker").agg(F.sum("copies").alias("copies")), "counts")
    summed = lambda rows: rows.groupBy(*BIN).agg(F.count("*").alias("kinds"), F.sum("copies").alias("copies"))
    bins = left.groupBy(*BIN).agg(F.count("*").alias("contigs")).join(summed(counts), key, "left").na.fill(0, ["kinds", "copies"])
    bins, active, taken, number = kept(bins, "state"), None, None, 0
    while True:
        number += 1
        good = _scores(bins, total).where((F.col("completeness") >= limits[0]) & (F.col("contamination") <= limits[1])).select(*BIN, "place")
        near = left if active is None else left.join(left.join(active, key, "left_semi").select("sample", "contig").distinct(), ["sample", "contig"], "left_semi")
        best = near.join(good, key).groupBy("sample", "contig").agg(F.min("place").alias("place"))
        won = best.groupBy("sample", F.col("place.binner").alias("binner"), F.col("place.bin").alias("bin")).agg(F.count("*").alias("won"), F.first(-F.col("place.size")).alias("contigs"))
        picked = kept(won.where("won = contigs").select(*BIN), "picked")
        if picked.isEmpty():
            break
        new = kept(left.join(picked, key, "left_semi").withColumn("round", F.lit(number)), "taken")
        taken = new if taken is None else union(taken, new)
        gone = new.select("sample", "contig").distinct()
        lost = kept(left.join(picked, key, "left_anti").join(gone, ["sample", "contig"], "left_semi"), "lost")
        left = kept(left.join(gone, ["sample", "contig"], "left_anti"), "left")
        changed = kept(lost.groupBy(*BIN).agg(F.count("*").alias("less")), "changed")
        less = lost.join(found, ["sample", "contig"]).groupBy(*BIN, "marker").agg(F.sum("copies").alias("less"))
        fewer = counts.join(changed.select(*BIN), key, "left_semi").join(less, [*BIN, "marker"], "left").select(*BIN, "marker", (F.col("copies") - F.coalesce("less", F.lit(0))).alias("copies"))
        same = lambda state: state.join(changed.select(*BIN), key, "left_anti").join(picked, key, "left_anti")
        fewer = kept(fewer.where("copies > 0"), "fewer")
        counts = kept(union(same(counts), fewer), "counts")
        scored = bins.join(changed, key).select(*BIN, (F.col("contigs") - F.col("less")).alias("contigs")).where("contigs > 0").join(summed(fewer), key, "left").na.fill(0, ["kinds", "copies"])
        bins = kept(union(same(bins), scored), "state")
        touched = left.join(changed, key, "left_semi").select("sample", "contig").distinct()
        active = kept(left.join(touched, ["sample", "contig"], "left_semi").select(*BIN).distinct(), "active")
    return contig2bin.select(*BIN, "contig", F.lit(0).alias("round")).limit(0) if taken is None else taken
