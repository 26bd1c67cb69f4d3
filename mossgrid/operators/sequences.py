"""Contigs and bins: filters, names, statistics and k-mer features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, numbered_rows, running
from mossgrid.functions.kmers import canonical_index, counted_codes, summed_counts

#: Centres that are broadcast: some 12 MB with 150 numbers each.
MOST_CLUSTERS = 10_000
#: Up to this k the counts of a sequence are one array.
ARRAY_K = 5


def filter_contigs(contigs: DataFrame, min_len: int = 1500) -> DataFrame:
    return contigs.where(F.length("seq") >= min_len)


def bin_stats(contigs: DataFrame) -> DataFrame:
    return contigs.groupBy("bin").agg(F.sum(F.length("seq").cast("long")).alias("total_bp"), F.count("*").alias("contigs"))


def filter_bins_by_size(stats: DataFrame, min_kb: int = 200) -> DataFrame:
    return stats.where(F.col("total_bp") >= min_kb * 1000)


def numbered(df: DataFrame, group: str, size: Column, name: str) -> Column:
    """1-based place within the group: larger first, then by name."""
    return F.row_number().over(Window.partitionBy(group).orderBy(size.desc(), F.col(name)))


def rename_contigs(contigs: DataFrame, group: str = "sample") -> DataFrame:
    """Adds new_id `<group>_<n>` to every row, contigs by length and name; names are different within a group.

    Numbers are given to (group, contig_id, length, hash of the sequence) in one order over all groups, sorted in ranges, so
    neither sequences nor a large group meet in one task. Rows of one contig_id have a number each; those that are equal in
    all of these take the next ones in any order. Rows without a group are named by number alone. A null sequence comes last.
    """
    length, text = F.length("seq"), F.xxhash64("seq")
    slim = contigs.select(F.col(group).alias("_group"), F.col("contig_id").alias("_contig"), length.alias("_length"), text.alias("_text"))
    placed = kept(running(slim, [F.col("_group"), F.col("_length").desc(), F.col("_contig"), F.col("_text")], _place=F.lit(1)), "places")
    first = placed.groupBy(F.col("_group").alias("_g")).agg(F.min("_place").alias("_first"))
    equal = placed.groupBy("_group", "_contig", "_length", "_text").agg(F.min("_place").alias("_place"), F.count("*").alias("_rows"))
    equal = kept(equal.join(first, F.col("_group").eqNullSafe(F.col("_g"))).withColumn("_place", F.col("_place") - F.col("_first")).drop("_g", "_first"), "equal")
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("contig_id").eqNullSafe(F.col("_contig")) & length.eqNullSafe(F.col("_length")) & (text == F.col("_text"))
    joined = lambda rows: contigs.join(rows, same)
    named = lambda df, more: df.select(*contigs.columns, F.concat_ws("_", F.col("_group").cast("string"), (F.col("_place") + more).cast("string")).alias("new_id"))
    if (several := equal.where("_rows > 1")).isEmpty():
        return named(joined(equal), 1)
    tied = numbered_rows(joined(several), "_group", "_contig", "_length", "_text")
    return named(joined(equal.where("_rows = 1")), 1).unionByName(named(tied, F.col("_no")))


def name_bins(stats: DataFrame, tool: str, group: str = "sample") -> DataFrame:
    """Adds name `<group>_<tool>_<n>`, bins by size and id."""
    return stats.withColumn("name", F.concat_ws("_", F.col(group).cast("string"), F.lit(tool), numbered(stats, group, F.col("total_bp"), "bin").cast("string")))


def extract_bins(contigs: DataFrame, contig2bin: DataFrame) -> DataFrame:
    return contigs.join(contig2bin, ["sample", "contig_id"])


def tetranucleotides(df: DataFrame, key: str, k: int = 4) -> DataFrame:
    """(key, kmer, n): counts of canonical k-mers; those with other letters than ACGT are left out. Null sequences are empty."""
    if k <= ARRAY_K:
        names, _ = canonical_index(k)
        spread = summed_counts(df, k, key).select(key, F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("kmer"), F.col("counts").alias("n"))).alias("x"))
        return spread.select(key, "x.kmer", "x.n").where("n > 0")
    letter = lambda place: F.substring(F.lit("ACGT"), (F.shiftright("code", 2 * place).bitwiseAND(F.lit(3)) + 1).cast("int"), F.lit(1))
    return counted_codes(df, k, key).groupBy(key, "code").agg(F.sum("n").alias("n")).select(key, F.concat(*(letter(p) for p in range(k - 1, -1, -1))).alias("kmer"), "n")


def contig_features(df: DataFrame, key: str = "contig_id", depth: DataFrame | None = None) -> DataFrame:
    """(key, features): frequencies of the 136 canonical tetranucleotides in name order, then the depths given.

    Sequences without a tetranucleotide have no row. depth: (key, depth), whose log is taken, or (key, depths) with vectors of
    one length as coverage.depth_vectors() gives them, taken as they are; a contig without depths has zeros.
    """
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    out = summed_counts(df, 4, key).select(key, F.transform("counts", lambda x: x / total).alias("features"))
    if depth is None:
        return out
    if "depths" not in depth.columns:
        depth = depth.select(key, F.array(F.log1p(F.coalesce("depth", F.lit(0.0)))).alias("depths"))
    depth = kept(depth.select(key, "depths"), "depths")  # asked for its size first
    size = depth.select(F.max(F.size("depths"))).first()[0] or 0
    return out.join(depth, key, "left").select(key, F.concat("features", F.coalesce("depths", F.array_repeat(F.lit(0.0), size))).alias("features"))


def cluster_contigs(features: DataFrame, k: int, key: str = "contig_id", seed: int = 1) -> DataFrame:
    """(key, bin): k-means over standardised features. It makes no claim to equal a binner."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    vectors = features.select(key, array_to_vector("features").alias("raw"))
    model = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True), KMeans(k=k, seed=seed, predictionCol="bin")]).fit(vectors)
    return model.transform(vectors).select(key, F.col("bin").cast("long").alias("bin"))


def standard_scale(features: DataFrame) -> tuple[list[float], list[float]]:
    """Mean and spread of every place of the vectors; a place without spread has 1. As many numbers as a vector has come to the driver."""
    rows = features.select(F.posexplode("features").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread")).orderBy("at").collect()
    return [r.mean for r in rows], [r.spread if r.spread > 1e-12 else 1.0 for r in rows]


def marker_seeds(markers: DataFrame, key: str = "contig_id") -> DataFrame:
    """The contigs (key) that hold the marker found in the median number of contigs, the first by name of equal ones: as many as genomes, if most markers are whole."""
    counts = markers.groupBy("marker").agg(F.count_distinct(key).alias("n"))
    middle = counts.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n)").alias("n"))
    chosen = counts.join(F.broadcast(middle), "n").agg(F.min("marker").alias("marker"))  # one row
    return markers.join(F.broadcast(chosen), "marker").select(key).distinct()


def marker_clusters(features: DataFrame, markers: DataFrame, key: str = "contig_id", rounds: int = 4, choices: int = 16, most: int = MOST_CLUSTERS) -> DataFrame:
    """(key, bin): contigs by nearest centre, where contigs that share a single-copy marker are never together.

    features: (key, features) with vectors of one length; markers: (key, marker). Centres start from marker_seeds(); each
    round contigs choose, then centres move to their members' mean. Contigs with markers ask for a bin in order of distance;
    of those that ask for a bin with one marker the nearest is let in, the others ask for their next. One that is refused by
    its `choices` nearest, as every contig where there are no markers, has a null bin. Centres are broadcast; more than
    `most` of them are an error. It makes no claim to equal a binner.
    """
    spark = features.sparkSession
    rows = kept(features.select(key, "features").where("features is not null"), "vectors")
    marks = kept(markers.select(key, "marker").dropna().distinct().join(rows.select(key), key, "left_semi"), "markers")
    mean, spread = standard_scale(rows)
    kind = rows.schema[key].dataType.simpleString()
    seeds = rows.join(marker_seeds(marks, key), key).orderBy(key).limit(most + 1).collect()
    if len(seeds) > most:
        raise ValueError(f"more than {most} seeds")
    if not seeds:
        return rows.select(key, F.lit(None).cast("long").alias("bin"))
    centres = (np.array([r.features for r in seeds], float) - mean) / spread
    placed = None
    for _ in range(rounds):
        placed = _placed(rows, marks, centres, np.array(mean), np.array(spread), key, kind, choices)
        # Sums of whole numbers, so that their order doesn't matter.
        scaled = rows.join(placed.where("bin is not null"), key).select("bin", F.posexplode("features").alias("at", "x")).groupBy("bin", "at").agg(F.sum(F.round(F.col("x") * (1 << 20)).cast("long")).alias("sum"), F.count("*").alias("n"))
        moved = scaled.groupBy("bin").agg(F.array_sort(F.collect_list(F.struct("at", (F.col("sum") / F.col("n") / (1 << 20)).alias("x")))).alias("x")).select("bin", F.transform("x", lambda v: v["x"]).alias("x"))
        centres = centres.copy()
        for r in moved.toLocalIterator():
            centres[r.bin] = (np.array(r.x) - mean) / spread
    return placed


def least_places(values: np.ndarray, few: int) -> np.ndarray:
    """The places of each row's `few` least values in their order, of equal ones the first; only these are sorted."""
    if 4 * few >= values.shape[1]:
        return np.argsort(values, axis=1, kind="stable")[:, :few]
    found = np.sort(np.argpartition(values, few - 1, axis=1)[:, :few], axis=1)
    there = np.take_along_axis(values, found, axis=1)
    found = np.take_along_axis(found, np.argsort(there, axis=1, kind="stable"), axis=1)
    tied = np.flatnonzero((values <= there.max(axis=1)[:, None]).sum(axis=1) > few)  # more equal ones than are taken
    found[tied] = np.argsort(values[tied], axis=1, kind="stable")[:, :few]
    return found


def _placed(rows: DataFrame, marks: DataFrame, centres: np.ndarray, mean: np.ndarray, spread: np.ndarray, key: str, kind: str, choices: int) -> DataFrame:
    there = rows.sparkSession.sparkContext.broadcast((centres, mean, spread))
    few = min(choices, len(centres))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, low, scale = there.value
        size = (own * own).sum(axis=1)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = (part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1) - low) / scale
                apart = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ own.T + size, 0)
                order = least_places(apart, few)
                lists = lambda values, t: pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * few), pa.array(values.ravel(), t))  # noqa: B023, E731
                yield pa.record_batch({key: part.column(0), "near": lists(order, pa.int64()), "apart": lists(np.take_along_axis(apart, order, axis=1), pa.float64())})

    near = kept(rows.mapInArrow(nearest, f"`{key}` {kind}, near array<long>, apart array<double>"), "nearest")
    asking = kept(near.join(marks.select(key).distinct(), key, "left_semi").withColumn("turn", F.lit(0)), "asking")
    for _ in range(few * 64):  # each turn refuses one at least; far fewer are needed
        asked = asking.where(F.col("turn") < few).select(key, F.get("near", F.col("turn")).alias("bin"), F.get("apart", F.col("turn")).alias("apart"))
        wanted = asked.join(marks, key).select("bin", "marker", F.struct("apart", key).alias("who"))
        first = wanted.groupBy("bin", "marker").agg(F.min("who").alias("first"))
        refused = kept(wanted.join(first, ["bin", "marker"]).where("who <> first").select(F.col(f"who.{key}").alias(key)).distinct(), "refused")
        if refused.isEmpty():
            break
        asking = kept(asking.join(refused.withColumn("_no", F.lit(1)), key, "left").withColumn("turn", F.col("turn") + F.coalesce("_no", F.lit(0))).drop("_no"), "asking")
    else:
        raise RuntimeError("contigs are still refused")
    free = near.join(asking.select(key), key, "left_anti").select(key, F.get("near", F.lit(0)).alias("bin"))
    return kept(asking.select(key, F.when(F.col("turn") < few, F.get("near", F.col("turn"))).alias("bin")).unionByName(free), "placed")
