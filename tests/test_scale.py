"""What one key, one long sequence or one large group would break, and k-mer codes against plain Python."""

import contextlib
import hashlib
import pathlib
import random
import threading
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mossgrid.functions import kmers
from mossgrid.operators import annotation, coverage, manifests, refine, sequences, similarity

FLIP = str.maketrans("ACGT", "TGCA")


def canonical(text, k):
    text = (text or "").upper()
    return [min(w, w.translate(FLIP)[::-1]) for w in (text[i : i + k] for i in range(len(text) - k + 1)) if set(w) <= set("ACGT")]


@pytest.mark.parametrize("size", [1 << 18, 40])
def test_codes_equal_plain_kmers(size, monkeypatch):
    draw = random.Random(1)
    monkeypatch.setattr(kmers, "SLICE", size)
    seqs = ["".join(draw.choice("ACGTNacgtü"[: draw.choice([4, 5, 9, 10])]) for _ in range(draw.randrange(0, 200))) for _ in range(60)] + [None, "", "acgtACGT" * 30]
    column = pa.array(["skipped", *seqs], pa.string())[1:]
    for k in (1, 2, 3, 4, 5, 8, 11, 21, 31):
        got = Counter()
        for data, offsets, first in kmers.sequence_slices(column, k):
            codes, rows = kmers.canonical_codes(data, offsets, k)
            got.update((int(r) + first, bytes(t).decode()) for r, t in zip(rows, kmers.code_text(codes, k), strict=True))
        assert got == Counter((i, w) for i, s in enumerate(seqs) for w in canonical(s, k))


def test_hashes_equal_md5():
    draw = random.Random(2)
    for width in (1, 21, 31, 55):
        texts = [bytes(draw.choices(b"ACGT", k=width)) for _ in range(300)]
        want = [int(hashlib.md5(t).hexdigest()[:15], 16) for t in texts]
        assert kmers.md5_prefix(np.frombuffer(b"".join(texts), np.uint8).reshape(-1, width)).tolist() == want


def test_counts_and_sketches(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), "".join(draw.choice("ACGTN") for _ in range(draw.choice([0, 3, 50, 700])))) for _ in range(40)] + [("a", None), ("c", "AC")]
    df = spark.createDataFrame(rows, "genome string, seq string").withColumn("code", F.lit(1)).withColumn("counts", F.lit(1))
    for k in (3, 4, 7):
        want = Counter((g, w) for g, s in rows for w in canonical(s, k))
        assert {(r.genome, r.kmer): r.n for r in sequences.tetranucleotides(df, "genome", k).collect()} == want
    want = {(g, h) for g, s in rows for w in canonical(s, 21) if (h := int(hashlib.md5(w.encode()).hexdigest()[:15], 16)) % 5 == 0}
    assert {tuple(r) for r in similarity.sketches(df, 21, 5).collect()} == want
    assert similarity.sketches(df.limit(0), 21, 5).count() == 0 and sequences.contig_features(df.limit(0), "genome").count() == 0
    with pytest.raises(ValueError):
        similarity.sketches(df, 32)


def test_repeated_contig_ids_keep_their_rows(spark):
    draw = random.Random(4)
    rows = [(draw.choice(["a", "b", None]), draw.choice([1, 2, None]), draw.choice(["ACGT", "GGGG", "AC", None]), k) for k in range(300)]
    got = sequences.rename_contigs(spark.createDataFrame(rows, "sample string, contig_id long, seq string, own int")).collect()
    assert len(got) == len(rows) and {(r.sample, r.contig_id, r.seq, r.own) for r in got} == set(rows)
    for group in ("a", "b", None):
        own = [r for r in got if r.sample == group]
        assert {r.new_id for r in own} == {f"{group}_{k}" if group else str(k) for k in range(1, len(own) + 1)}
        by = sorted(own, key=lambda r: int(r.new_id.split("_")[-1]))
        lengths = [len(r.seq) if r.seq is not None else -1 for r in by]
        assert lengths == sorted(lengths, reverse=True)


def plain_cover(rows):
    places = {}
    for s, m, c, start, n in rows:
        if None not in (start, n) and n > 0:
            places.setdefault((s, m, c), set()).update(range(start, start + n))
    return {k: len(x) for k, x in places.items()}


def test_cover_of_one_deep_contig(spark):
    """All alignments on one contig: tiles share the work, and a tile keeps as many spans as it has positions."""
    draw = random.Random(5)
    rows = [("s", "m", "c", draw.randrange(0, 9000) // draw.choice([1, 1, 50]), draw.choice([0, 1, 30, 150, 2500])) for _ in range(4000)] + [("s", "m", "d", 5, None), ("s", "m", "d", None, 5), ("s", "n", "c", 63, 1), ("s", "n", "c", 64, 64), ("s", "n", "c", 10, 0)]
    df = spark.createDataFrame(rows, "sample string, mag string, contig string, start long, aligned_len long")
    for tile in (64, 1 << 14):
        assert {(r.sample, r.mag, r.contig): r.covered for r in coverage.covered_bases(df, tile).collect()} == plain_cover(rows)
    lengths = spark.createDataFrame([("m", 12000), ("n", 0)], "mag string, length long")
    got = {r.mag: r for r in coverage.covered_fraction(df, lengths, 64).collect()}
    assert got["m"].reads == 4002 and got["m"].covered_bases == plain_cover(rows)["s", "m", "c"] and (got["n"].covered_bases, got["n"].covered_fraction) == (65, None)
    assert coverage.covered_fraction(df.limit(0), lengths).count() == 0


def plain_profile(reads, genomes, k, least):
    known = {g: set().union(*(canonical(s, k) for h, s in genomes if h == g)) for g, _ in genomes}
    out = set()
    for r in {r for r, _ in reads}:
        own = set().union(*(canonical(s, k) for q, s in reads if q == r))
        best = max(((len(own & x), g) for g, x in known.items() if own & x), default=None)
        if best and best[0] / len(own) >= least:
            out.add((r, best[1], best[0], best[0] / len(own)))
    return out


@pytest.mark.parametrize("least", [0.0, 0.3, 0.5, 0.9, 1.0])
def test_profile_with_a_kmer_of_all_genomes(spark, least):
    draw = random.Random(6)
    dna = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    common, shared = dna(12), [dna(20) for _ in range(4)]
    genomes = [(g, common + "N" + dna(30) + "N" + shared[g % 4] + "N" + shared[g % 3]) for g in range(25)] + [(3, dna(20)), (99, "AC")]
    reads = [(r, draw.choice([common, genomes[r % 25][1][10:50], shared[r % 4], dna(25), common + "N" + dna(15), shared[0] + "N" + shared[1] + "N" + dna(9)])) for r in range(120)] + [(7, common), (500, None)]
    got = coverage.kmer_profile(spark.createDataFrame(reads, "read_id long, seq string"), spark.createDataFrame(genomes, "genome long, seq string"), 9, least)
    assert {tuple(r) for r in got.collect()} == plain_profile(reads, genomes, 9, least)


def test_one_large_near_group(spark):
    """Genomes that are all near each other cost a front of pairs and a look-up each; the choice is the greedy one."""
    draw = random.Random(7)
    base = draw.sample(range(1 << 40), 200)
    n = 2000
    sketch = {g: {*draw.sample(base, 198), (1 << 41) + g} for g in range(n)} | {n + g: {*draw.sample(base, 30), *draw.sample(range(1 << 42, 1 << 43), 170)} for g in range(40)}
    quality = {g: draw.randrange(100) for g in sketch}
    frame = spark.createDataFrame([(g, float(q), 1) for g, q in quality.items()], "genome long, quality_score double, total_bp long")
    rows = spark.createDataFrame(pa.table({"genome": [g for g, x in sketch.items() for _ in x], "hash": [h for x in sketch.values() for h in x]}).to_pandas())
    got = {r.genome: r.representative for r in similarity.dereplicate_sketches(frame, rows, 21, 99).collect()}
    order = sorted(sketch, key=lambda g: (-quality[g], g))
    near = lambda a, b: 100 * (len(sketch[a] & sketch[b]) / min(len(sketch[a]), len(sketch[b]))) ** (1 / 21)
    chosen = []
    for g in order:
        if not any(near(g, r) >= 99 for r in chosen):
            chosen.append(g)
    place = {g: k for k, g in enumerate(order)}
    want = {g: g if g in set(chosen) else min((r for r in chosen if near(g, r) >= 99), key=lambda r: (-near(g, r), place[r])) for g in sketch}
    assert got == want and len(chosen) < 60


@pytest.mark.parametrize("front", [1, 3])
def test_representatives_with_short_fronts(spark, front):
    """Many rounds: genomes behind the front wait, also for near ones that aren't ready."""
    draw = random.Random(8)
    bases = [draw.sample(range(1000), 40) for _ in range(4)]
    sketch = {g: set(draw.sample(bases[g % 4], draw.choice([36, 38, 40]))) | set(draw.sample(range(60), 2)) for g in range(1, 90)}
    rows = spark.createDataFrame([(g, h) for g, x in sketch.items() for h in x], "g long, hash long")
    near = lambda a, b: 100 * (len(sketch[a] & sketch[b]) / min(len(sketch[a]), len(sketch[b]))) ** (1 / 21)
    for ani in (99.2, 99.7):
        chosen = []
        for g in sorted(sketch):
            if not any(near(g, r) >= ani for r in chosen):
                chosen.append(g)
        want = {g: g if g in chosen else min((r for r in chosen if near(g, r) >= ani), key=lambda r: (-near(g, r), r)) for g in sketch}
        got = similarity.representatives(spark.createDataFrame([(g,) for g in sketch], "g long"), rows, 21, ani, 30, front)
        assert {r.g: r.representative for r in got.collect()} == want


def test_refinement_takes_several_rounds(spark):
    """Losing contigs lets a contaminated bin pass later; nothing repeats for bins that lost none."""
    rows = [("s", "x", "best", c) for c in "abc"] + [("s", "y", "late", c) for c in "cdef"] + [("s", "x", "none", "z")] + [("s", "y", None, "q")]
    markers = [("s", "a", 1), ("s", "b", 2), ("s", "c", 3), ("s", "d", 1), ("s", "e", 2), ("s", "f", 3), ("s", "c", 3)]
    bins = spark.createDataFrame(rows + rows[:2], "sample string, binner string, bin string, contig string")
    got = refine.refine_bins(bins, spark.createDataFrame(markers, "sample string, contig string, marker int"), 60, 40, "metawrap", "checkm").collect()
    assert sorted((r.bin, r.contig, r.round) for r in got) == [("best", "a", 1), ("best", "b", 1), ("best", "c", 1), ("late", "d", 2), ("late", "e", 2), ("late", "f", 2)]
    tight = refine.refine_bins(bins, spark.createDataFrame(markers, "sample string, contig string, marker int"), 60, 0, "metawrap", "checkm").collect()
    assert tight == []


def test_a_batch_merged_twice(spark):
    old = spark.createDataFrame([("m1", "g1", "1e-50"), ("m1", "g2", "1e-50"), ("m2", "g3", "1e-50"), (None, "g4", "1e-50")], "MAG string, gene string, evalue string")
    new = spark.createDataFrame([("m1", "g9", "1e-50"), ("m1", "g9", "1e-50")], "MAG string, gene string, evalue string")
    ledger = spark.createDataFrame([("m1",), ("m2",)], "MAG string")
    once = annotation.merge_annotations(old, new, ("evalue",), ledger)
    twice = annotation.merge_annotations(once, new, ("evalue",), ledger)
    want = [(None, "g4"), ("m1", "g9"), ("m1", "g9")]  # m2 was annotated again and has no hit now
    assert sorted((str(r.MAG), r.gene) for r in once.collect()) == sorted((str(r.MAG), r.gene) for r in twice.collect()) == sorted((str(a), b) for a, b in want)
    assert annotation.merge_annotations(old.limit(0), new, ("evalue",)).count() == 2
    for other in ("1e-5", None):
        with pytest.raises(ValueError, match="evalue"):
            annotation.merge_annotations(old, new.withColumn("evalue", F.lit(other).cast("string")), ("evalue",))


def test_bins_from_markers(spark):
    """Genomes of their own composition: bins follow them, and no bin holds a marker twice."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 10)) * 3
    rows, marks = [], []
    for k in range(300):
        genome = k % 6
        rows.append((k, (centres[genome] + rng.normal(size=10) * (0.3 if k < 290 else 6)).tolist()))
        if k % 5 < 2:
            marks += [(k, f"m{(k // 6) % 9}")] * (1 + k % 2)
    features = spark.createDataFrame(rows, "contig_id long, features array<double>")
    df = spark.createDataFrame([*marks, (None, "m1"), (3, None), (5000, "m1")], "contig_id long, marker string")
    got = {r.contig_id: r.bin for r in sequences.marker_clusters(features, df).collect()}
    assert len(got) == 300
    held = Counter((got[c], m) for c, m in set(marks) if got[c] is not None)
    assert max(held.values()) == 1
    free = [(got[k], k % 6) for k in range(290) if k not in {c for c, _ in marks}]
    main = {g: Counter(b for b, h in free if h == g).most_common(1)[0] for g in range(6)}
    assert sum(n for _, n in main.values()) > 0.6 * len(free)
    seeds = sequences.marker_seeds(df.dropna().where("contig_id < 5000")).collect()
    counts = Counter(m for c, m in set(marks))
    assert len(seeds) == sorted(counts.values())[(len(counts) - 1) // 2]
    assert {r.bin for r in sequences.marker_clusters(features, df.limit(0)).collect()} == {None}
    assert sequences.marker_clusters(features.limit(0), df).count() == 0
    with pytest.raises(ValueError):
        sequences.marker_clusters(features, df, most=2)


def test_depth_vectors_equal_plain(spark):
    draw = random.Random(10)
    groups = [("g", s) for s in "abcd"] + [("h", "x")]
    rows = [(g, draw.randrange(12), s, float(draw.randrange(1, 9))) for g, s in groups if s != "d" for _ in range(15)] + [("g", 3, "z", 5.0)]
    named = [("g", c) for c in range(14)]
    depth = {}
    for g, c, s, x in rows:
        if (g, s) in groups:
            depth[g, c, s] = depth.get((g, c, s), 0) + x
    contigs = sorted({(g, c) for g, c, _ in depth} | set(named))
    want = {}
    for g in "gh":
        own = [c for h, c in contigs if h == g]
        columns = []
        for s in sorted(s for h, s in groups if h == g):
            x = np.log1p([depth.get((g, c, s), 0.0) for c in own])
            columns.append((x - x.mean()) / x.std() if x.std() > 1e-9 else x * 0)
        want |= {(g, c): v for c, v in zip(own, np.array(columns).T, strict=True)}
    got = coverage.depth_vectors(spark.createDataFrame(rows, "group string, contig long, sample string, depth double"), spark.createDataFrame(groups, "group string, sample string"), spark.createDataFrame(named, "group string, contig long"))
    found = {(r.group, r.contig): r.depths for r in got.collect()}
    assert found.keys() == want.keys() and all(np.allclose(found[k], want[k]) for k in want)


@pytest.mark.parametrize("k", [3, 9, 21, 31])
def test_packed_stretches_keep_every_kmer_in_its_bucket(k):
    """Each k-mer comes back once for each place, and with its reverse complement always in the same bucket; neighbours share bytes."""
    draw = random.Random(k)
    texts = ["".join(draw.choices("ACGTN", [5, 5, 5, 5, 0.1], k=n)) for n in (0, 2, k, 40, 3000)] + ["A" * 900]
    texts += [x[::-1].translate(FLIP) for x in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    codes, rows = kmers.canonical_codes(data, offsets, k)
    bucket, row, count, held, bases = kmers.kmer_runs(data, offsets, k, 7)
    again, runs = kmers.run_codes(count, bases, k)
    assert sorted(zip(rows.tolist(), codes.tolist())) == sorted(zip(row[runs].tolist(), again.tolist()))
    places = {}
    for code, b in zip(again.tolist(), bucket[runs].tolist()):
        places.setdefault(code, set()).add(b)
    assert all(len(x) == 1 for x in places.values()) and len({b for x in places.values() for b in x}) > 1
    if k == 21:
        assert len(bases) + 3 * len(count) < 2 * len(codes)  # 16 bytes each as rows


def test_profile_counts_repeated_and_long_reads_once(spark, monkeypatch):
    """Rows of one id are one read, also where slices or rows share k-mers; a read of one genome in several buckets is one row."""
    monkeypatch.setattr(coverage, "BUCKET", 500)
    monkeypatch.setattr(coverage, "SLICE", 700)
    draw = random.Random(2)
    dna = lambda n: "".join(draw.choices("ACGT", k=n))
    one, two = dna(900), dna(300)
    reads = [("a", one), ("b", two[:200]), ("b", two[100:]), ("c", one[:150] + dna(140)), ("d", None), ("e", "ACG"), ("f", dna(80))]
    genomes = [("x", one), ("y", two[:160]), ("y", two[150:]), ("z", one)]
    found = coverage.kmer_profile(spark.createDataFrame([*reads, (None, two)], "read_id string, seq string"), spark.createDataFrame(genomes, "genome string, seq string"), 21, 0.4)
    assert {tuple(r) for r in found.collect()} == plain_profile(reads, genomes, 21, 0.4)


def test_pairs_of_a_long_list_are_dealt_out(spark, monkeypatch):
    """No task makes all pairs: they are as many as the square of the list."""
    monkeypatch.setattr(manifests, "TASK_PAIRS", 1000)
    reads = spark.range(210).select(F.col("id").cast("string").alias("sample"), F.array(F.lit("a.fq")).alias("reads"))
    found = manifests.coverage_groups(reads, multi=reads.where("sample < 200").select("sample"))
    per = [r["count"] for r in found.where("group = 'multi'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 200 * 200 and max(per) <= 1200
    assert found.where("group <> 'multi'").count() == 10 and found.distinct().count() == 40010


def test_depths_are_computed_once(spark):
    """The vectors' size is asked for before they are joined, which must not compute them again."""
    contigs = spark.createDataFrame([(i, "ACGT" * 5) for i in range(20)], "contig_id long, seq string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def vector(i):
        seen.add(1)
        return [float(i), 1.0]

    depth = contigs.where("contig_id < 15").select("contig_id", vector("contig_id").alias("depths"))
    rows = {r.contig_id: r.features for r in sequences.contig_features(contigs, "contig_id", depth).collect()}
    assert seen.value == 15
    assert len(rows) == 20 and rows[3][-2:] == [3.0, 1.0] and rows[19][-2:] == [0.0, 0.0]


def test_sequences_reach_python_in_small_batches(spark):
    """A batch is bounded in bytes, whatever the lengths of its sequences."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", (1 << 31) - 2)
    rows = spark.range(0, 400, 1, 1).select(F.col("id").alias("contig_id"), F.repeat(F.lit("ACGTTGCA"), 12500).alias("seq"))
    sized = lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches)
    sequences.contig_features(rows)
    assert max(r.n for r in rows.mapInArrow(sized, "n long").collect()) < 3 * kmers.BATCH_BYTES


def test_least_places_equal_a_whole_sort():
    draw = np.random.default_rng(1)
    for high in (3, 50, 10**6):  # many ties, some, hardly any
        values = draw.integers(0, high, (300, 500)).astype(float)
        assert (sequences.least_places(values, 16) == np.argsort(values, axis=1, kind="stable")[:, :16]).all()


def test_dereplication_sends_no_growing_table_through_the_driver(spark):
    """Tables of genomes and hashes are shuffled in every round, however small they look."""
    sketch = spark.createDataFrame([(g, h) for g in range(30) for h in range(g % 5, 40)], "g long, hash long")
    index = similarity._index(sketch, 0.8)
    met = similarity._met(index, index, "a < b")
    for df in (met, similarity._near(met, index, 21, 99, 30)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_common_hashes_are_counted_where_their_lists_are(spark, monkeypatch):
    """Many near genomes, copies and a hash of all: every pair with its exact number, over several ranges and blocks, by arrays and by probes too."""
    monkeypatch.setattr(similarity, "LISTED", 400)
    monkeypatch.setattr(similarity, "BLOCK", 200)
    rng = random.Random(3)
    sets = {g: {1, *rng.sample(range(10 + g % 4, 40 + g % 4), rng.randint(1, 12))} for g in range(150)} | {g: {1, *range(100, 100 + g // 8)} for g in range(150, 190)}
    df = spark.createDataFrame([(f"g{g}", h) for g, held in sets.items() for h in held], "genome string, hash long")
    for least in (0.0, 0.34, 0.9):
        want = {(a, b, n) for i in sets for j in sets if (a := f"g{i}") < (b := f"g{j}") and (n := len(sets[i] & sets[j])) >= least * min(len(sets[i]), len(sets[j])) - 1e-9 and n}
        assert {tuple(r) for r in similarity.candidate_pairs(df, least).collect()} == want
    own, size, listed = [[1, 2]] * 3, [[3, 3]] * 3, [[1, 2, 5], [2, 5, 9], list(range(1, 400))]
    batch = pa.record_batch({c: pa.array(x, pa.list_(pa.int64())) for c, x in (("own", own), ("size", size), ("list", listed))})
    for least in (0.0, 0.5, 1.0):
        want = {(a, b, n) for a in (1, 2) for b in range(a + 1, 400) if (n := sum(b in x for x in listed)) >= max(least * 3, 1)}
        for dense in (1, 1 << 20):
            got = {x for b in similarity.later_counts(iter([batch]), least, dense, 4) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)}
            assert got == want, (least, dense)


def test_hashes_of_codes_are_those_of_their_texts():
    for k in range(1, kmers.MOST_K + 1):
        codes = np.array([0, 1, (1 << 2 * k) - 1, (1 << 2 * k) // 3, 0x1234567 % (1 << 2 * k)], np.uint64)
        assert kmers.code_md5(codes, k).tolist() == kmers.md5_prefix(kmers.code_text(codes, k)).tolist()


def test_pairs_of_a_round_meet_a_row_per_genome(spark):
    """What a pair is joined with is one row on each side, however many hashes its genomes have."""
    index = spark.range(3000).selectExpr("id % 300 AS hash", "id div 300 AS g", "300L AS n", "true AS prefix")
    whole = similarity._whole(index)
    assert whole.count() == 10 and {r.n for r in whole.collect()} == {300}
    pairs = spark.createDataFrame([(0, 1), (2, 9)], "a long, b long")
    assert {tuple(r) for r in similarity._alike(pairs, whole, 21, 99, 30).collect()} == {(0, 1, 100.0), (2, 9, 100.0)}


def test_what_needs_no_long_slices_reads_short_ones():
    """The arrays of a slice follow its bases, whatever the length of a sequence; slices overlap by k - 1 and leave nothing out."""
    text = "ACGT" * (kmers.NEAR_SLICE // 2)
    parts = [bytes(data) for data, _, _ in kmers.sequence_slices(pa.array([text]), 4, kmers.NEAR_SLICE)]
    assert max(map(len, parts)) <= kmers.NEAR_SLICE + 3 and parts[0] + b"".join(x[3:] for x in parts[1:]) == text.encode()


def test_best_genomes_by_classes_equal_plain_sums():
    """In small parts, with equal profiles, ties, classes that no genome of the group has, and genomes without a list."""
    draw = random.Random(11)
    genomes = [(g, f"g{draw.randrange(10**6):06}", [(draw.randrange(12) - 6, draw.randrange(3)) for _ in range(g % 7)] or None) for g in range(50, 90)]
    genomes = [(g, name, sorted(set(c)) if c else None) for g, name, c in genomes]
    profiles = [sorted({((m, s) if draw.random() < 0.9 else (draw.randrange(50, 95), 0)): draw.randrange(1, 4) for m, s in ((draw.randrange(14) - 7, draw.randrange(3)) for _ in range(draw.randrange(9)))}.items()) for _ in range(200)] * 2
    cells = lambda rows, at: pa.array([r and [c[at] for c in r] for r in rows], pa.list_(pa.int64()))
    known = pa.table({"mag": [g for g, _, _ in genomes], "name": [n for _, n, _ in genomes], "first": cells([c for _, _, c in genomes], 0), "mixed": cells([c for _, _, c in genomes], 1)})
    rows = [[(*c, n) for c, n in p] for p in profiles]
    table = pa.table({"first": cells(rows, 0), "mixed": cells(rows, 1), "shared": cells(rows, 2)})
    want = {}
    for row, p in enumerate(profiles):
        sums = [(sum(n for c, n in p if c in {*(own or ()), (g, 0)}), name, at) for at, (g, name, own) in enumerate(genomes)]
        if max(sums)[0]:
            want[row] = (max(sums)[2], max(sums)[0])
    for most in (1, 100, 1 << 21):
        row, genome, shared = kmers.class_best(table, known, most)
        assert {r: (g, n) for r, g, n in zip(row.tolist(), genome.tolist(), shared.tolist(), strict=True)} == want
    assert not len(kmers.class_best(table, known.slice(0, 0))[0]) and not len(kmers.class_best(table.slice(0, 0), known)[0])


def test_profile_of_a_near_group_stays_small_on_disk(spark, monkeypatch):
    """Reads near many genomes near each other: pairs of them are counted in place, so shuffled files don't grow with pairs by classes; and they go with each step."""
    monkeypatch.setattr(coverage, "KIN", 60_000)
    draw = random.Random(12)
    base = draw.choices("ACGT", k=800)
    near = lambda: "".join(draw.choice("ACGT") if draw.random() < 0.004 else x for x in base)
    genomes = [(g, near()) for g in range(120)]
    reads = [(r, near()) for r in range(300)]
    folders = [str(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    held = lambda: sum(p.stat().st_size for d in folders for p in pathlib.Path(d).rglob("shuffle_*.data") if p.exists())
    most, on, before = [0], threading.Event(), held()

    def watch():
        while not on.wait(0.1):
            with contextlib.suppress(FileNotFoundError):
                most[0] = max(most[0], held() - before)

    thread = threading.Thread(target=watch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if tables were large
    thread.start()
    try:
        got = {tuple(r) for r in coverage.kmer_profile(spark.createDataFrame(reads, "read_id long, seq string"), spark.createDataFrame(genomes, "genome long, seq string"), 21, 0.6).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        on.set()
        thread.join()
    assert got == plain_profile(reads, genomes, 21, 0.6) and len(got) == 300
    assert most[0] < 2e7


@pytest.mark.parametrize("bits", [4, 40])
def test_different_pairs_in_and_beyond_one_word(bits):
    draw = random.Random(bits)
    rows = [(draw.choice([0, 5, (1 << 62) - 1 if bits == 40 else 9]), draw.randrange(1 << bits) >> draw.choice([0, bits - 2])) for _ in range(500)]
    first, then = kmers._different(np.array([a for a, _ in rows], np.uint64), np.array([b for _, b in rows]), bits)
    assert list(zip(first.tolist(), then.tolist(), strict=True)) == sorted(set(rows))
    assert not len(kmers._different(first[:0], then[:0], bits)[0])
