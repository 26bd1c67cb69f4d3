"""Alignment filters, covered fraction and abundance metrics per sample and genome."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, settled, union
from mossgrid.functions.kmers import SLICE, class_best, class_hits, code_runs, counted_codes, distinct_sizes, spread

#: Positions of a contig that are united together.
TILE = 1 << 14
METRICS = ("relative_abundance", "rpkm", "tpm", "mean")


def filter_alignments(alignments: DataFrame, identity: float = 95, aligned: float = 75) -> DataFrame:
    return alignments.where((F.col("identity_pct") >= identity) & (F.col("aligned_pct") >= aligned))


def mag_alignments(alignments: DataFrame, contig2bin: DataFrame) -> DataFrame:
    """Alignments as readers give them, with the MAG of their contig; contig2bin: (contig_id, mag), a contig in one MAG. Those on other contigs are left out."""
    return alignments.join(contig2bin.select(F.col("contig_id").alias("contig"), "mag"), "contig")


def mag_lengths(contigs: DataFrame, contig2bin: DataFrame) -> DataFrame:
    """(mag, length) from (contig_id, seq)."""
    return contigs.select("contig_id", F.length("seq").cast("long").alias("bp")).join(contig2bin.select("contig_id", "mag"), "contig_id").groupBy("mag").agg(F.sum("bp").alias("length"))


def covered_bases(alignments: DataFrame, tile: int = TILE) -> DataFrame:
    """(sample, mag, contig, covered): positions under at least one alignment, by tiles of a contig.

    Spans are cut at the tiles' edges, so tiles are independent. Of the spans that start at one place the longest is kept
    before the shuffle, which leaves a tile at most as many as it has positions, however deep it is. Spans without a length,
    or with a null, cover nothing.
    """
    spans = alignments.select("sample", "mag", "contig", "start", (F.col("start") + F.col("aligned_len")).alias("end")).where("end > start")
    tiles = spans.withColumn("tile", F.explode(F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("end") - 1) / tile))))
    cut = tiles.select("sample", "mag", "contig", "tile", F.greatest(F.col("start"), F.col("tile") * tile).alias("start"), F.least(F.col("end"), (F.col("tile") + 1) * tile).alias("end"))
    longest = cut.groupBy("sample", "mag", "contig", "tile", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("sample", "mag", "contig", "tile").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start")))
    return longest.withColumn("covered", F.greatest(new, F.lit(0))).groupBy("sample", "mag", "contig").agg(F.sum("covered").alias("covered"))


def covered_fraction(alignments: DataFrame, lengths: DataFrame, tile: int = TILE) -> DataFrame:
    """(sample, mag, reads, aligned_bp, covered_bases, length, covered_fraction) of filtered alignments; lengths: (mag, length). Genomes without a length are left out; rows without a sample or genome too."""
    sums = alignments.groupBy("sample", "mag").agg(F.count("*").alias("reads"), F.sum("aligned_len").alias("aligned_bp"))
    covered = covered_bases(alignments, tile).groupBy("sample", "mag").agg(F.sum("covered").alias("covered_bases"))
    sums = sums.join(covered, ["sample", "mag"], "left").withColumn("covered_bases", F.coalesce("covered_bases", F.lit(0).cast("long")))
    return sums.join(lengths.select("mag", "length"), "mag").select("mag", "sample", "reads", "aligned_bp", "covered_bases", "length", F.try_divide("covered_bases", "length").alias("covered_fraction"))


def abundance_metrics(covered: DataFrame, totals: DataFrame, min_fraction: float = 0.1, rpkm_total: str = "mapped") -> DataFrame:
    """Relative abundance and mean (gated by covered fraction), RPKM, TPM and counts (ungated), with an `unmapped` row per sample.

    totals: (sample, total_reads). One pass gives both the gated and the ungated metrics; covered is written once, as a row
    per sample and genome is little next to its alignments.
    """
    depth = F.try_divide(F.col("aligned_bp").cast("double"), "length")
    df = covered.withColumn("mean", F.when(F.col("covered_fraction") >= min_fraction, depth).otherwise(0.0)).withColumn("rate", F.try_divide(F.col("reads").cast("double"), "length"))
    df = kept(df.select("sample", "mag", "reads", "mean", "rate"), "covered")
    sums = df.groupBy("sample").agg(F.sum("reads").alias("mapped"), F.sum("rate").alias("rates"), F.sum("mean").alias("means"))
    per_sample = kept(totals.select("sample", "total_reads").join(sums, "sample", "left"), "samples")
    df = df.join(per_sample, "sample")
    per = F.col("mapped") if rpkm_total == "mapped" else F.col("total_reads")
    share = F.coalesce(F.try_divide("mean", "means"), F.lit(0.0))
    rows = df.select(
        "sample",
        "mag",
        (100 * F.try_divide(F.col("mapped").cast("double"), "total_reads") * share).alias("relative_abundance"),
        F.try_divide(F.col("rate") * 1e9, per).alias("rpkm"),
        F.try_divide(F.col("rate") * 1e6, "rates").alias("tpm"),
        "mean",
        "reads",
    )
    mapped, none = F.coalesce("mapped", F.lit(0)), F.lit(None).cast("double")
    unmapped = 100 * (1 - F.coalesce(F.try_divide(mapped.cast("double"), F.col("total_reads")), F.lit(0.0)))
    rest = per_sample.select("sample", F.lit("unmapped").alias("mag"), unmapped.alias("relative_abundance"), none.alias("rpkm"), none.alias("tpm"), none.alias("mean"), (F.col("total_reads") - mapped).alias("reads"))
    return rows.unionByName(rest)


def assigned_only(abundance: DataFrame) -> DataFrame:
    return abundance.where(F.col("mag") != "unmapped")


def abundance_matrix(long: DataFrame, metric: str | Column, samples: list, by: tuple = ("mag",)) -> DataFrame:
    """Genomes by samples. Sample names are given, so the plan needs no pass to find them; absent cells are 0."""
    value = F.col(metric) if isinstance(metric, str) else metric
    return long.groupBy(*by).pivot("sample", samples).agg(F.first(value)).na.fill(0)


def abundance_table(long: DataFrame, samples: list, metrics: tuple = (*METRICS, "reads"), by: tuple = ("mag",)) -> DataFrame:
    """Genomes by samples for all metrics asked for, columns `<sample>_<metric>`. Absent cells are 0."""
    if unknown := set(metrics) - {*METRICS, "reads"}:
        raise ValueError(f"no such metrics: {sorted(unknown)}")
    return long.groupBy(*by).pivot("sample", samples).agg(*(F.first(m).alias(m) for m in metrics)).na.fill(0)


def differential_coverage(alignments: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, contig, sample, depth) of alignments whose (sample, assembly) pair is in a coverage group."""
    kept = alignments.join(groups, ["sample", "assembly"])
    return kept.groupBy("group", "contig", "sample").agg(F.try_divide(F.sum("aligned_len").cast("double"), F.first("contig_len")).alias("depth"))


def depth_vectors(depths: DataFrame, groups: DataFrame, contigs: DataFrame | None = None) -> DataFrame:
    """(group, contig, samples, depths): standardised log depths of every contig over the samples of its coverage group, in their order.

    depths: (group, contig, sample, depth) as differential_coverage() gives, a row for each depth above 0; groups: (group,
    sample, ...); contigs: (group, contig) to be there even without a depth. Zeros count by their number, so no grid of
    contigs and samples is made: a contig's vector is sparse until its last step. A sample whose depth is the same for all
    contigs is 0 everywhere. Rows of one contig and sample add up, those without a group, sample or contig are left out.
    """
    members = groups.select("group", "sample").dropna().distinct()
    per_group = members.groupBy("group").agg(F.array_sort(F.collect_set("sample")).alias("samples"))
    rows = depths.groupBy("group", "contig", "sample").agg(F.sum("depth").alias("depth")).join(members, ["group", "sample"]).where("contig is not null").select("group", "contig", "sample", F.log1p(F.coalesce("depth", F.lit(0.0))).alias("x"))
    rows = kept(rows, "depths")
    named = rows.select("group", "contig") if contigs is None else union(rows.select("group", "contig"), contigs.select("group", "contig"))
    named = named.dropna().distinct()
    sizes = named.groupBy("group").agg(F.count("*").alias("n"))
    sums = rows.groupBy("group", "sample").agg(F.sum("x").alias("sum"), F.sum(F.col("x") * F.col("x")).alias("squares"))
    stats = members.join(sums, ["group", "sample"], "left").na.fill(0.0, ["sum", "squares"]).join(sizes, "group")
    mean = F.col("sum") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0)))
    scale = stats.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("sample", F.struct(mean.alias("mean"), spread.alias("spread"))))).alias("scale"))
    scale = kept(per_group.join(scale, "group"), "scales")  # a row for each group
    sparse = rows.groupBy("group", "contig").agg(F.map_from_entries(F.collect_list(F.struct("sample", "x"))).alias("held"))
    found = named.join(sparse, ["group", "contig"], "left").join(scale, "group")
    value = lambda s: F.coalesce(F.try_element_at("held", s), F.lit(0.0))
    standard = lambda s: F.when(F.element_at("scale", s)["spread"] > 1e-9, (value(s) - F.element_at("scale", s)["mean"]) / F.element_at("scale", s)["spread"]).otherwise(0.0)
    return found.select("group", "contig", "samples", F.transform("samples", standard).alias("depths"))


#: What tells apart the sets of genomes that hold a k-mer: their number, the first one and a sum of their hashes.
CLASS = ("genomes", "first", "mixed")
HIT = ("number", *CLASS, "n")
#: Bases of reads and genomes whose k-mers meet in one bucket.
BUCKET = 1 << 22
#: Classes of reads, summed over the reads, that meet genomes in one group; and those of one kin, whose genomes each of its groups gets.
GROUP = 1 << 18
KIN = 1 << 20


def kmer_profile(reads: DataFrame, genomes: DataFrame, k: int = 21, min_shared: float = 0.5) -> DataFrame:
    """(read_id, mag, shared, fraction): each read's best genome by shared k-mers (of equal ones the last by name), if it shares that part of the read's.

    K-mers go to buckets by their minimizers, as stretches of packed bases, so what is shuffled is about twice the bases; a
    bucket's k-mers are told apart in one task, some BUCKET of them. K-mers held by an equal set of genomes are a class.
    Reads meet classes, not genomes, so a k-mer of all genomes brings a read one row a bucket. Of a read the classes of most
    genomes a k-mer are left out, as far as a genome can't reach min_shared by them alone; those of its other classes are its
    candidates. Reads are dealt by their kin, the genome that leads the classes of most of their k-mers, to groups of some
    GROUP classes, a kin of over KIN to several. A group gets each candidate of any of its reads once, with its list of classes,
    and counts in place, so pairs of reads and genomes near each other are never rows. Reads and genomes without a k-mer have no rows.
    """
    reads, genomes = _numbered(reads, "read_id"), _numbered(genomes.withColumnRenamed("genome", "mag"), "mag")
    bases = sum(x.agg(F.sum(F.length("seq").cast("long"))).first()[0] or 0 for x in (reads, genomes))
    buckets = bases // BUCKET + 1
    packed = code_runs(genomes, k, buckets).withColumn("known", F.lit(True)).unionByName(code_runs(reads, k, buckets).withColumn("known", F.lit(False)))

    def look_up(rows: pa.Table) -> pa.Table:
        batches = list(class_hits(rows, k))
        return pa.Table.from_batches(batches) if batches else pa.table({c: pa.array([], pa.int64()) for c in HIT})

    hits = settled(packed.groupBy("bucket").applyInArrow(look_up, ", ".join(f"{c} long" for c in HIT)), "hits")
    members = settled(hits.where("n = 0").select(*CLASS, F.col("number").alias("mag")).distinct(), "members")
    own = hits.where("n > 0").repartition("number").groupBy("number", *CLASS).agg(F.sum("n").alias("shared"))
    entry = F.struct((-F.col("genomes") / F.col("shared")).alias("dear"), *CLASS, "shared")
    led = own.groupBy("number", "first").agg(F.sum("shared").alias("met"), F.collect_list(entry).alias("entries"))
    found = led.groupBy("number").agg(F.sum("met").alias("met"), F.max(F.struct("met", "first"))["first"].alias("kin"), F.array_sort(F.flatten(F.collect_list("entries"))).alias("profile"))
    need = F.greatest(F.ceil(F.col("size") * min_shared - 1e-9), F.lit(1)).alias("need")
    found = found.join(_sizes(reads, k), "number").select("number", "kin", "size", need, "met", "profile").where("met >= need")
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("on"))
    fits = lambda a, x: a["on"] & (a["sum"] + x["shared"] < F.col("need"))
    heavy = F.aggregate("profile", start, lambda a, x: F.struct(F.when(fits(a, x), a["sum"] + x["shared"]).otherwise(a["sum"]).alias("sum"), F.when(fits(a, x), a["n"] + 1).otherwise(a["n"]).alias("n"), fits(a, x).alias("on")))["n"]
    found = settled(found.select("number", "kin", "size", "need", heavy.alias("heavy"), *(F.col(f"profile.{c}").alias(c) for c in (*CLASS, "shared"))), "profiles")

    total = found.agg(F.sum(F.size("shared"))).first()[0] or 0
    groups = max(found.sparkSession.sparkContext.defaultParallelism, total // GROUP + 1)
    large = found.groupBy("kin").agg(F.sum(F.size("shared")).alias("entries")).where(F.col("entries") > KIN).select("kin", F.ceil(F.col("entries") / KIN).alias("pieces"))
    # At most a row for each KIN entries.
    dealt = found.join(F.broadcast(large), "kin", "left").withColumn("group", F.pmod(F.xxhash64("kin"), F.lit(groups))).withColumn("piece", F.coalesce(F.pmod(F.xxhash64("number"), "pieces"), F.lit(0).cast("long")))
    place = ["group", "piece"]
    light = dealt.select(*place, F.explode(F.slice(F.arrays_zip(*CLASS), F.col("heavy") + 1, F.size("shared"))).alias("x")).select(*place, *(f"x.{c}" for c in CLASS)).distinct()
    light = settled(light, "light")
    asked = union(light.where("genomes = 1").select(*place, F.col("first").alias("mag")), light.where("genomes > 1").join(members, list(CLASS)).select(*place, "mag")).distinct()
    lists = members.groupBy("mag").agg(F.sort_array(F.collect_list(F.struct("first", "mixed"))).alias("x")).select("mag", "x.first", "x.mixed")
    names = genomes.select(F.col("number").alias("mag"), F.col("mag").alias("name")).distinct()
    known = asked.join(names, "mag").join(lists, "mag", "left")

    def best(reads: pa.Table, known: pa.Table) -> pa.Table:
        row, genome, shared = class_best(reads, known)
        told = pa.table({"number": reads["number"].take(pa.array(row)), "mag": known["name"].take(pa.array(genome)), "shared": pa.array(shared), "size": reads["size"].take(pa.array(row))})
        return told.filter(pa.array(shared >= reads["need"].to_numpy()[row]))

    kind = genomes.schema["mag"].dataType.simpleString()
    told = dealt.select(*place, "number", "need", "size", "first", "mixed", "shared").groupBy(*place).cogroup(known.groupBy(*place)).applyInArrow(best, f"number long, mag {kind}, shared long, size long")
    told = settled(told, "told").select("number", "mag", "shared", (F.col("shared") / F.col("size")).alias("fraction"))
    return told.join(reads.select("number", "read_id").distinct(), "number").select("read_id", "mag", "shared", "fraction").where(F.col("fraction") >= min_shared)


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """(number, key, seq) as written down, one number for all rows of a key; rows without a key or sequence are left out."""
    rows = settled(spread(df.select(key, "seq")).where(F.col(key).isNotNull() & (F.length("seq") > 0)).withColumn("number", F.monotonically_increasing_id()), "sequences")
    several = settled(rows.groupBy(key).agg(F.min("number").alias("_first"), F.count("*").alias("_rows")).where("_rows > 1").drop("_rows"), "several")
    if several.isEmpty():
        return rows
    return settled(rows.join(several, key, "left").withColumn("number", F.coalesce("_first", "number")).drop("_first"), "sequences")


def _sizes(reads: DataFrame, k: int) -> DataFrame:
    """(number, size): different k-mers of every read; those of several or long rows are counted by shuffling them."""
    spans = reads.groupBy("number").agg(F.count("*").alias("rows"), F.max(F.length("seq")).alias("longest"))
    apart = settled(spans.where((F.col("rows") > 1) | (F.col("longest") > SLICE)).select("number"), "long")
    if apart.isEmpty():
        return distinct_sizes(reads, k)
    codes = counted_codes(reads.join(apart, "number", "left_semi"), k, "number").select("number", "code").distinct()
    return distinct_sizes(reads.join(apart, "number", "left_anti"), k).unionByName(codes.groupBy("number").agg(F.count("*").alias("size")))
