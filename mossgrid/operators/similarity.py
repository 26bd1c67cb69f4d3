"""Whole-cohort dereplication: k-mer sketches, candidate pairs and representatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, running, union
from mossgrid.functions.kmers import sampled_hashes

#: Undecided genomes that a hash lists in the first round.
FRONT = 256
#: For pairs: classes in a range of lists at most, their hashes, and hashes of the classes whose pairs one task counts.
RANGE = 1 << 20
LISTED = 1 << 24
BLOCK = 1 << 18


def sketches(contigs: DataFrame, k: int = 21, scale: int = 50, min_size: int = 1) -> DataFrame:
    """(genome, hash): canonical k-mers whose hash is a multiple of scale (FracMinHash). Only sampled hashes leave the scan; k up to 31."""
    found = sampled_hashes(contigs, k, scale).distinct()
    return found if min_size <= 1 else found.join(found.groupBy("genome").count().where(F.col("count") >= min_size), "genome", "left_semi")


def candidate_pairs(sketch: DataFrame, least: float = 0.0) -> DataFrame:
    """(g1, g2, shared), g1 < g2, of genomes that share at least that part of the smaller one's hashes, and any at all."""
    return _pairs(sketch, least).select("g1", "g2", "shared")


def _pairs(sketch: DataFrame, least: float) -> DataFrame:
    """candidate_pairs() with the sizes n1 and n2 of the sketches.

    Genomes with equal sketches are one class until the end. Classes are numbered by size, so the smaller of a pair comes
    first; what it shares with all later ones is counted in one task, from the lists of its hashes. A task has the classes of
    one block, for the lists, and of the later classes one range. So neither pairs that only meet nor the hashes of pairs
    are shuffled: a hash's list goes to a block once, if the block has it, and what comes out are the pairs looked for.
    """
    sums = sketch_classes(sketch)
    ranks = kept(running(sums.groupBy("rep").agg(F.first("n").alias("n")), [F.col("n"), F.col("rep")], g=F.lit(1).cast("long")), "ranks")
    members = kept(sums.select("genome", "rep").join(dealt(ranks), "rep").select("genome", "g", "n"), "members")
    held = sketch.join(dealt(ranks.select(F.col("rep").alias("genome"), "g", "n")), "genome")
    most = ranks.agg(F.max("g"), F.sum("n")).first()
    classes, rows = (most[0] or 0), (most[1] or 0)
    width = min(classes, RANGE, LISTED * classes // max(rows, 1)) + 1
    lists = held.groupBy("hash", F.expr(f"g div {width}").alias("range")).agg(F.array_sort(F.collect_list(F.struct("g", "n"))).alias("list"))
    lists = lists.withColumn("held", F.sum(F.size("list")).over(Window.partitionBy("hash")))  # a row per range
    lists = kept(lists.where("held > 1").select("hash", "range", "list"), "lists")
    entries = lists.agg(F.sum(F.size("list"))).first()[0] or 0
    blocks = max(sketch.sparkSession.sparkContext.defaultParallelism, entries // BLOCK + 1)
    own = lists.select("hash", F.explode("list").alias("x")).groupBy("hash", F.expr(f"x.g % {blocks}").alias("block")).agg(F.array_sort(F.collect_list("x")).alias("own"))
    later = lists.select("hash", "range", F.col("list.g").alias("list"))
    # Of the block's classes those before the last one listed.
    met = own.join(dealt(later), "hash").where(F.col("own")[0]["g"] < F.element_at("list", -1))
    met = met.select("block", "range", F.col("own.g").alias("own"), F.col("own.n").alias("size"), "list")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from later_counts(batches, least)

    found = kept(met.groupBy("block", "range").applyInArrow(count, "a long, b long, shared long"), "shared")
    one, two = (members.select(F.col("g").alias(g), F.col("genome").alias(f"{g}_genome"), F.col("n").alias(f"{g}_n")) for g in ("a", "b"))
    apart = found.join(dealt(one), "a").join(dealt(two), "b")
    copies = members.alias("one").join(dealt(members.alias("two")), "g").where("one.genome < two.genome")
    copies = copies.select(F.col("one.genome").alias("g1"), F.col("two.genome").alias("g2"), F.col("one.n").alias("shared"), F.col("one.n").alias("n1"), F.col("one.n").alias("n2"))
    first = F.col("a_genome") < F.col("b_genome")
    swap = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return union(copies, apart.select(swap("a_genome", "b_genome").alias("g1"), swap("b_genome", "a_genome").alias("g2"), "shared", swap("a_n", "b_n").alias("n1"), swap("b_n", "a_n").alias("n2")))


def later_counts(batches: Iterator[pa.RecordBatch], least: float, dense: int = 1 << 20, most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """(a, b, shared) of classes a and later listed ones b that share at least that part of a's hashes, and any at all; rows (own, size, list) of a hash each: the block's classes with their sizes, and those listed, both in order.

    Of a's lists as many as it may lack can't bring a first meeting: where these are much longer than what the others have
    brought, they are only asked about that. From `dense` listed classes on, those of one a are counted in an array over the range.
    """
    flat = lambda x: x.flatten().to_numpy(zero_copy_only=False)
    parts = [[flat(batch.column(c)) for c in ("own", "size", "list")] + [batch.column(c).value_lengths().to_numpy() for c in ("own", "list")] for batch in batches if batch.num_rows]
    if not parts:
        return
    own, size, listed, owns, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    row = np.repeat(np.arange(len(owns)), owns)
    low = int(listed.min())
    high = int(max(listed.max(), own.max())) + 1
    at = np.repeat(np.arange(len(lengths)) * (high + 1), lengths)
    end = np.cumsum(lengths)[row]
    start = np.searchsorted(listed + at, row * (high + 1) + own, "right")
    order = np.flatnonzero(start < end)
    order = order[np.lexsort((end[order] - start[order], own[order]))]
    own, size, start, end = own[order], size[order], start[order], end[order]
    need = np.maximum(np.ceil(least * size - 1e-9), 1).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))[: len(own)]
    ready: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(own)], strict=True):
        least_shared = int(need[i])
        asked = j - i - least_shared + 1  # the shorter lists come first
        if asked <= 0:
            continue
        lists = [listed[x:y] for x, y in zip(start[i:j].tolist(), end[i:j].tolist(), strict=True)]
        total, short = int((end[i:j] - start[i:j]).sum()), int((end[i : i + asked] - start[i : i + asked]).sum())
        probe = total - short > 8 * short * (j - i - asked)
        for_all = lists[:asked] if probe else lists
        if (short if probe else total) < dense:
            later = np.sort(np.concatenate(for_all))
            new = np.flatnonzero(np.concatenate(([True], later[1:] != later[:-1])))
            shared, later = np.diff(np.append(new, len(later))), later[new]
        else:
            counts = np.zeros(high - low, np.int32)
            for x in for_all:
                counts[x - low] += 1  # a list has no class twice
            later = np.flatnonzero(counts)
            shared, later = counts[later].astype(np.int64), later + low
        if probe:
            for x in lists[asked:]:
                shared = shared + (x[np.minimum(np.searchsorted(x, later), len(x) - 1)] == later)
        enough = shared >= least_shared
        later, shared = later[enough], shared[enough]
        if len(later):
            ready.append((np.full(len(later), own[i]), later, shared))
            held += len(later)
        if held >= most:
            yield pa.record_batch({c: np.concatenate(x) for c, x in zip(("a", "b", "shared"), zip(*ready, strict=True), strict=True)})
            ready, held = [], 0
    if ready:
        yield pa.record_batch({c: np.concatenate(x) for c, x in zip(("a", "b", "shared"), zip(*ready, strict=True), strict=True)})


def sketch_classes(sketch: DataFrame) -> DataFrame:
    """(genome, rep, n): genomes with equal sketches, of n hashes, share the smallest name; their similarity is 100 and needs no join."""
    mixed = F.xxhash64("hash")  # small numbers have equal sums too often
    sums = sketch.groupBy("genome").agg(F.count("*").alias("n"), F.sum(mixed % 1000000007).alias("a"), F.bit_xor(mixed).alias("b"))
    reps = sums.groupBy("n", "a", "b").agg(F.min("genome").alias("rep"))
    return sums.join(reps, ["n", "a", "b"]).select("genome", "rep", "n")


def sketch_ani(sketch: DataFrame, k: int = 21, ani: float = 0) -> DataFrame:
    """(g1, g2, ani, af1, af2) in percent of pairs from an identity on: identity from the k-th root of containment, aligned fractions from shared parts."""
    pairs = _pairs(sketch, (ani / 100) ** k)
    identity = 100 * F.pow(F.col("shared") / F.least("n1", "n2"), 1.0 / k)
    return pairs.select("g1", "g2", identity.alias("ani"), (100 * F.col("shared") / F.col("n1")).alias("af1"), (100 * F.col("shared") / F.col("n2")).alias("af2"))


def dereplicate(genomes: DataFrame, pairs: DataFrame, ani: float = 99, af: float = 30) -> DataFrame:
    """(genome, representative): greedy by quality, as independent-set rounds.

    genomes: (genome, quality_score, total_bp). Per round, a genome without a better undecided neighbour becomes a
    representative and its neighbours members; a member goes to its most similar representative.
    """
    order = F.struct(-F.col("quality_score"), -F.col("total_bp"), F.col("genome"))
    near = pairs.where((F.col("ani") >= ani) & (F.greatest("af1", "af2") >= af))
    ranked = genomes.select("genome", order.alias("o"))
    edges = union(near.select(F.col("g1").alias("u"), F.col("g2").alias("v"), "ani"), near.select(F.col("g2").alias("u"), F.col("g1").alias("v"), "ani"))
    edges = edges.join(ranked.select(F.col("genome").alias("u"), F.col("o").alias("uo")), "u").join(ranked.select(F.col("genome").alias("v"), F.col("o").alias("vo")), "v")
    edges = kept(edges, "near")
    left, chosen = kept(genomes.select("genome"), "left"), None
    while not left.isEmpty():
        open_edges = edges.join(left.select(F.col("genome").alias("u")), "u", "left_semi").join(left.select(F.col("genome").alias("v")), "v", "left_semi")
        beaten = open_edges.where("vo < uo").select(F.col("u").alias("genome")).distinct()
        picked = kept(left.join(beaten, "genome", "left_anti"), "picked")
        chosen = picked if chosen is None else kept(union(chosen, picked), "chosen")
        covered = edges.join(picked.select(F.col("genome").alias("u")), "u", "left_semi").select(F.col("v").alias("genome")).distinct()
        left = kept(left.join(picked, "genome", "left_anti").join(covered, "genome", "left_anti"), "left")
    if chosen is None:
        return genomes.select("genome", F.col("genome").alias("representative"))
    own = chosen.select("genome", F.col("genome").alias("representative"))
    to = edges.join(chosen.select(F.col("genome").alias("v")), "v", "left_semi").join(chosen.select(F.col("genome").alias("u")), "u", "left_anti")
    best = to.groupBy("u").agg(F.min(F.struct(-F.col("ani"), F.col("vo"), F.col("v"))).alias("b")).select(F.col("u").alias("genome"), F.col("b.v").alias("representative"))
    return union(own, best)


def dealt(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the genomes: it's shuffled, as what is broadcast passes through the driver, anew in every round."""
    return df.hint("merge")


def _index(sketch: DataFrame, least: float) -> DataFrame:
    """(hash, g, n, prefix) of a written sketch (g, hash), without hashes of one genome. A genome's prefix is its rarest hashes, as many as a near one of its size or more may lack and one."""
    held = sketch.groupBy("hash").agg(F.count("*").alias("held"))
    sizes = sketch.groupBy("g").agg(F.count("*").alias("n"))
    rows = kept(sketch.join(dealt(held), "hash").where("held > 1").join(dealt(sizes), "g"), "held")
    order = Window.partitionBy("g").orderBy("held", "hash")  # a genome's own sketch, which its length bounds
    place = F.row_number().over(order) + F.col("n") - F.count("*").over(Window.partitionBy("g"))
    need = F.greatest(F.ceil(F.lit(least) * F.col("n") - 1e-9), F.lit(1))
    return kept(rows.withColumn("place", place).select("hash", "g", "n", (F.col("place") <= F.col("n") - need + 1).alias("prefix")), "index")


def _met(one: DataFrame, two: DataFrame, where: str) -> DataFrame:
    """(a, b) of rows of the index that meet under a hash of the smaller one's prefix."""
    x, y = (df.select("hash", F.col("g").alias(c), F.col("n").alias(f"{c}n"), F.col("prefix").alias(f"{c}p")) for df, c in ((one, "a"), (two, "b")))
    return x.join(dealt(y), "hash").where(f"({where}) AND (ap AND an <= bn OR bp AND bn <= an)").select("a", "b").distinct()


def _whole(index: DataFrame) -> DataFrame:
    """(g, n, hashes): a row per genome of an index, so that a round's pairs meet genomes, not rows of hashes."""
    return kept(index.groupBy("g").agg(F.first("n").alias("n"), F.collect_list("hash").alias("hashes")), "whole")


def _alike(pairs: DataFrame, whole: DataFrame, k: int, ani: float, af: float) -> DataFrame:
    """(a, b, ani) of the pairs that are near; whole: as _whole() gives it."""
    x, y = (whole.select(F.col("g").alias(c), F.col("hashes").alias(f"{c}h"), F.col("n").alias(f"{c}n")) for c in ("a", "b"))
    shared = pairs.join(dealt(x), "a").join(dealt(y), "b").select("a", "b", F.size(F.array_intersect("ah", "bh")).alias("shared"), F.least("an", "bn").alias("smaller"))
    found = shared.withColumn("ani", 100 * F.pow(F.col("shared") / F.col("smaller"), 1.0 / k))
    return found.where((F.col("ani") >= ani) & (100 * F.col("shared") / F.col("smaller") >= af)).select("a", "b", "ani")


def _near(pairs: DataFrame, index: DataFrame, k: int, ani: float, af: float) -> DataFrame:
    """_alike() by an index."""
    return _alike(pairs, _whole(index), k, ani, af)


def _picked(ready: DataFrame, edges: DataFrame) -> DataFrame:
    """Of the ready genomes (g) those that the greedy order chooses; edges: (a, b), a before b and near, for every b that is ready. An a that isn't ready keeps its b from being chosen."""
    if edges.isEmpty():
        return ready
    chosen = None
    while True:
        picked = kept(ready.join(edges.select(F.col("b").alias("g")), "g", "left_anti"), "picked")
        if picked.isEmpty():
            return chosen if chosen is not None else picked
        chosen = picked if chosen is None else union(chosen, picked)
        covered = kept(edges.join(picked.select(F.col("g").alias("a")), "a", "left_semi").select("b").distinct(), "covered")
        ready = kept(ready.join(picked, "g", "left_anti").join(covered.select(F.col("b").alias("g")), "g", "left_anti"), "ready")
        edges = kept(edges.join(covered, "b", "left_anti").join(covered.select(F.col("b").alias("a")), "a", "left_anti"), "edges")


def representatives(ranks: DataFrame, sketch: DataFrame, k: int = 21, ani: float = 99, af: float = 30, front: int = FRONT) -> DataFrame:
    """(g, representative) of every rank in ranks (g, from the best), by an index of representatives; sketch: (g, hash).

    In a round, a hash lists the first `front` undecided genomes that hold it. A genome that is among them under all of its
    hashes is ready: whatever near genome comes before it is listed beside it. Ready genomes without an undecided near one
    before them become representatives, and all other genomes are looked up in the lists of the new representatives only.
    So a group of near genomes costs its members times its representatives, and front pairs at most in each list. The front
    doubles by the round, so a round can be needed for each doubling up to the longest list.
    """
    index = _index(kept(sketch.select("g", "hash"), "sketch"), (ani / 100) ** k)
    whole = _whole(index)
    # Hashes of no prefix bring no pairs; they only count.
    listed = kept(index.join(dealt(index.where("prefix").select("hash").distinct()), "hash", "left_semi"), "listed")
    left, found, chosen = kept(ranks.select("g"), "left"), None, None
    while not left.isEmpty():
        live = listed.join(dealt(left), "g", "left_semi")
        first = live.withColumn("at", F.row_number().over(Window.partitionBy("hash").orderBy("g"))).where(F.col("at") <= front).drop("at")
        first = kept(first, "front")
        held = live.groupBy("g").agg(F.count("*").alias("all")).join(dealt(first.groupBy("g").agg(F.count("*").alias("first"))), "g", "left")
        waiting = held.where("first IS NULL OR first < all").select("g")
        ready = kept(left.join(dealt(waiting), "g", "left_anti"), "ready")
        pairs = _met(first, first.join(dealt(ready), "g", "left_semi"), "a < b")
        edges = kept(_alike(pairs, whole, k, ani, af).select("a", "b"), "edges")
        new = _picked(ready, edges)
        if new.isEmpty():
            raise RuntimeError("a round of dereplication chose no representative")
        chosen = new if chosen is None else union(chosen, new)
        others = ranks.select("g").join(dealt(chosen), "g", "left_anti")
        looked_up = _met(listed.join(dealt(others), "g", "left_semi"), listed.join(dealt(new), "g", "left_semi"), "true")
        near = kept(_alike(looked_up, whole, k, ani, af), "near")
        found = near if found is None else union(found, near)
        gone = union(new, near.select(F.col("a").alias("g")).distinct())
        left, front = kept(left.join(dealt(gone), "g", "left_anti"), "left"), 2 * front
    if chosen is None:
        return ranks.select("g", F.col("g").alias("representative"))
    best = found.groupBy(F.col("a").alias("g")).agg(F.min(F.struct(-F.col("ani"), "b")).alias("x")).select("g", F.col("x.b").alias("representative"))
    return union(chosen.select("g", F.col("g").alias("representative")), best)


def dereplicate_sketches(genomes: DataFrame, sketch: DataFrame, k: int = 21, ani: float = 99, af: float = 30) -> DataFrame:
    """(genome, representative) of every genome: the greedy choice by quality, then length, then name; a member goes to its most similar representative.

    genomes: (genome, quality_score, total_bp), names unique and not null; sketch: (genome, hash). Genomes with equal
    sketches have the same neighbours and each other, so only the best of each goes through representatives(), and the
    others follow it. A genome without a sketch is its own representative.
    """
    order = F.struct(-F.col("quality_score"), -F.col("total_bp"), F.col("genome"))
    classes = genomes.join(sketch_classes(sketch), "genome", "left").withColumn("rep", F.coalesce("rep", "genome"))
    classes = kept(classes.select("genome", "quality_score", "total_bp", "rep"), "classes")
    heads = classes.groupBy("rep").agg(F.min(order).alias("o")).select("rep", F.col("o.genome").alias("genome"), F.col("o").alias("order"))
    ranks = kept(running(heads, [F.col("order"), F.col("rep")], g=F.lit(1).cast("long")).select("rep", "genome", "g"), "ranks")
    found = representatives(ranks.select("g"), sketch.join(ranks.select("genome", "g"), "genome").select("g", "hash"), k, ani, af)
    names = ranks.select(F.col("g").alias("representative"), F.col("genome").alias("name"))
    return classes.join(ranks.select("rep", "g"), "rep").join(found, "g").join(names, "representative").select("genome", F.col("name").alias("representative"))
