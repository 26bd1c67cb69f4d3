import hashlib
import itertools
import math
import random
import re

import duckdb
import pytest

from mossgrid.operators import annotation, niche, quality, refine, sequences, similarity
from mossgrid.plans.queries import BASES, K, LETTERS, ORACLE_SQL, QUERIES, SCALE, UPPER

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == columns
    rows = lambda x: sorted((tuple(map(plain, r)) for r in x), key=str)
    assert rows(df.select(*(f"`{c}`" for c in columns)).collect()) == rows([tuple(r[k] for k in at) for r in want.fetchall()])


def test_thresholds_and_inclusive_limits(spark):
    assert quality.refinement_thresholds(50, 10) == (40, 12) and quality.refinement_thresholds(50, 90)[1] == 100
    assert quality.refinement_thresholds(50, 10, "metawrap", "checkm") == (50, 10) and quality.refinement_thresholds(50, 10, "dastool") is None
    rows = [("a", 50.0, 10.0), ("b", 49.9, 10.1), ("c", 90.0, 0.0)]
    q = spark.createDataFrame(rows, "bin string, completeness double, contamination double")
    gunc = spark.createDataFrame([("a", "false", 0.29), ("c", "false", 0.3)], "bin string, pass string, reference_representation_score double")
    got = {r.bin: (r.pass_gunc, r.pass_rna, r.reason) for r in quality.quality_summary(q.select("bin"), q, gunc).collect()}
    assert got == {"a": ("unscored", "not_run", "pass"), "b": ("unscored", "not_run", "low_completeness;high_contamination"), "c": ("false", "not_run", "gunc_failed")}


@pytest.mark.parametrize(("n", "tail"), [(25, 6), (4, 1), (3, 0)])
def test_tails(spark, n, tail):
    rows = [(f"t{i}", 1.0, 20 + 0 * i, 1.0, float(i // 2)) for i in range(n)] + [("low", 1.0, 19, 1.0, 0.0)]
    stats = spark.createDataFrame(rows, "taxon string, overall_occupancy double, total_reads long, mean double, raw_si_cv double").selectExpr("*", "raw_si_cv - 1 AS corrected_si")
    got = [r.niche for r in niche.classify_niche(stats).collect()]
    assert (got.count("generalist"), got.count("intermediate"), got.count("specialist"), got.count("unclassified_low_support")) == (tail, n - 2 * tail, tail, 1)


def test_cutoff_comes_before_best_hit_and_fefe_needs_a_second_hit(spark):
    hits = spark.createDataFrame([(1, "s", 0.79, 0.9, 1e-60, 900.0, "PsaA"), (1, "r", 0.41, 0.9, 1e-60, 100.0, "RHO"), (2, "f", 0.9, 0.95, 1e-60, 5.0, "FeFe"), (3, "f", 0.9, 0.95, 1e-60, 5.0, "FeFe"), (4, "n", 0.9, 0.95, 1e-60, 5.0, "NiFe")], "protein_id long, subject string, identity double, query_coverage double, evalue double, bitscore double, class string")
    assert {r.protein_id: r.subject for r in annotation.terminal_hits(hits).collect()}[1] == "r"
    confirmed = annotation.confirm_fefe(hits.where("protein_id > 1"), hits.where("protein_id = 2 OR protein_id = 4").drop("class"))
    assert sorted((r.protein_id, r.FeFe_subject) for r in confirmed.collect()) == [(2, "f"), (4, None)]


def greedy(genomes, sketch, k=21, ani=99, af=30):
    """genomes: {genome: (quality, length)}; sketch: {genome: hashes}. One genome after the other, against all representatives."""
    chosen, near, order = [], {}, lambda g: (-genomes[g][0], -genomes[g][1], g)
    for a, b in itertools.combinations(genomes, 2):
        shared, n = len(sketch[a] & sketch[b]), sorted((len(sketch[a]), len(sketch[b])))
        if shared and (x := 100 * (shared / n[0]) ** (1 / k)) >= ani and 100 * shared / n[0] >= af:
            near[a, b] = near[b, a] = x
    for g in sorted(genomes, key=order):
        if not any((g, r) in near for r in chosen):
            chosen.append(g)
    return {g: g if g in chosen else min((r for r in chosen if (g, r) in near), key=lambda r: (-near[g, r], order(r))) for g in genomes}


def test_dereplicate_equals_greedy(spark):
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{DATA}/documents.parquet' WHERE doc_id IS NOT NULL").fetchall()
    dna = {i: re.sub("[^ACGT]", "", t.translate(str.maketrans(LETTERS + UPPER, BASES))) for i, t in docs}
    flip = str.maketrans("ACGT", "TGCA")
    words = lambda x: {min(w, w.translate(flip)[::-1]) for w in (x[i : i + K] for i in range(len(x) - K + 1))}
    sketch = {i: {h for w in words(x) if (h := int(hashlib.md5(w.encode()).hexdigest()[:15], 16)) % SCALE == 0} for i, x in dna.items()}
    want = greedy({i: (i * 7919 % 101, len(x)) for i, x in dna.items()}, sketch, K)
    got = QUERIES["dereplicate"](spark, DATA).collect()
    assert len(got) == len(want) and {r.genome: r.representative for r in got} == want
    assert any(not x for x in sketch.values()) and any(g != r for g, r in want.items())


def test_candidate_pairs_share_enough_of_the_smaller_sketch(spark):
    draw = random.Random(3)
    common = set(range(10, 16))  # held by all
    sketch = {i: common | set(draw.sample(range(100, 160), draw.randrange(1, 30))) for i in range(40)} | {40: {1}, 41: set(common), 42: set(common)}
    df = spark.createDataFrame([(i, h) for i, x in sketch.items() for h in x], "genome long, hash long")
    for least in (0.0, 0.5, 0.81, 1.0):
        want = {(a, b, n) for a in sketch for b in sketch if a < b and (n := len(sketch[a] & sketch[b])) and n >= least * min(len(sketch[a]), len(sketch[b]))}
        assert {tuple(r) for r in similarity.candidate_pairs(df, least).collect()} == want and want


def plain_refine(bins, markers, com, con):
    """bins: {(sample, binner, bin): contigs}; markers: {(sample, contig): [marker]}."""
    total = len({m for x in markers.values() for m in x})
    left, out, number = {k: set(v) for k, v in bins.items()}, set(), 0
    while True:
        number += 1
        place = {}
        for (sample, binner, name), own in left.items():
            found = [m for c in own for m in markers.get((sample, c), [])]
            complete, extra = 100 * len(set(found)) / total, 100 * (len(found) - len(set(found))) / total
            if own and complete >= com and extra <= con:
                place[sample, binner, name] = (-(complete - 5 * extra), -len(own), binner, name)
        if not place:
            return out
        won = [k for k in place if all(place[k] <= place[j] for j in place if j[0] == k[0] and left[j] & left[k])]
        gone = {(k[0], c) for k in won for c in left[k]}
        out |= {(*k, c, number) for k in won for c in left[k]}
        left = {k: {c for c in own if (k[0], c) not in gone} for k, own in left.items()}


def test_refine_bins_equals_plain(spark):
    draw = random.Random(4)
    bins, markers = {}, {}
    for sample in ("s1", "s2", "none"):
        for c in range(60):
            if sample != "none" and draw.random() < 0.5:
                markers[sample, c] = [draw.randrange(8) for _ in range(draw.choice([1, 1, 2]))]
            for binner in ("a", "b", "c"):
                bins.setdefault((sample, binner, draw.randrange(5)), set()).add(c)
    frame = spark.createDataFrame([(*k, c) for k, own in bins.items() for c in own], "sample string, binner string, bin long, contig long")
    found = spark.createDataFrame([(s, c, m) for (s, c), x in markers.items() for m in x], "sample string, contig long, marker long")
    for com, con in ((50, 100), (50, 50), (95, 10)):
        low, high = quality.refinement_thresholds(com, con)
        got = {tuple(r) for r in refine.refine_bins(frame, found, com, con).collect()}
        assert got == plain_refine(bins, markers, low, high)
        assert len({(s, c) for s, _, _, c, _ in got}) == len(got) and not any(r[0] == "none" for r in got)
    assert refine.refine_bins(frame.limit(0), found).count() == 0


def test_refined_counts_and_the_empty_cohort(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "sample string")
    counts = quality.refined_counts(samples, spark.createDataFrame([("a", 1), ("a", 2)], "sample string, bin long"))
    assert {tuple(r) for r in counts.collect()} == {("a", 2), ("b", 0)}
    quality.require_bins(counts)
    with pytest.raises(ValueError, match="No refined FASTA bins were collected"):
        quality.require_bins(counts.where("sample = 'b'"))


def test_niche_stats_without_a_grid_equal_those_with_zeros(spark):
    draw = random.Random(5)
    rows = [(f"t{i}", f"s{k}", draw.choice([0.0, 3.5, 3.5, 700.25]), draw.randrange(5)) for i in range(20) for k in range(6) if draw.random() < 0.7] + [("same", f"s{k}", 0.1, 9) for k in range(6)]
    df = spark.createDataFrame(rows, "taxon string, sample string, abundance double, reads long")
    for least in (0.001, 0.0):
        for r in niche.niche_stats(df, 6, least).collect():
            values = [v for t, _, v, _ in rows if t == r.taxon]
            values += [0.0] * (6 - len(values))
            mean = sum(values) / 6
            sd = math.sqrt(sum((v - mean) ** 2 for v in values) / 5)
            assert r.mean == pytest.approx(mean) and r.overall_occupancy == pytest.approx(sum(v >= least for v in values) / 6)
            assert r.raw_si_cv is None if mean == 0 else r.raw_si_cv == pytest.approx(sd / mean, abs=1e-9)


def test_contigs_are_numbered_within_groups(spark):
    draw = random.Random(6)
    rows = [(draw.choice(["a", "b", None]), i, "A" * draw.randrange(1, 9)) for i in range(200)]
    got = {r.contig_id: r.new_id for r in sequences.rename_contigs(spark.createDataFrame(rows, "sample string, contig_id long, seq string")).collect()}
    for group in ("a", "b", None):
        order = sorted((r for r in rows if r[0] == group), key=lambda r: (-len(r[2]), r[1]))
        assert all(got[r[1]] == (f"{group}_{k}" if group else str(k)) for k, r in enumerate(order, 1))


def test_branches_can_be_left_out(spark):
    row = spark.createDataFrame([("p", "m", "r", "c", "g")], ", ".join(f"{c} string" for c in annotation.COMMON))
    assert {r.branch for r in annotation.stack_annotations(skip=("ko",), ko=row, cazy=row).collect()} == {"cazy"}
    with pytest.raises(ValueError):
        annotation.stack_annotations(skip=("other",), ko=row)


def test_old_and_new_annotations_of_one_setting_merge(spark):
    old, new = (spark.createDataFrame([(k, "1e-50")], "mag long, evalue string") for k in (1, 2))
    assert annotation.merge_annotations(old, new, ("evalue",)).count() == 2
    with pytest.raises(ValueError):
        annotation.merge_annotations(old, new.selectExpr("mag", "'1e-5' AS evalue"), ("evalue",))


def test_clusters_of_contigs(spark):
    rows = [(i, [float(i % 2), 1.0 - i % 2, 0.5]) for i in range(40)]
    got = sequences.cluster_contigs(spark.createDataFrame(rows, "contig_id long, features array<double>"), 2).collect()
    assert len({r.bin for r in got if r.contig_id % 2}) == 1 and len({r.bin for r in got}) == 2


def test_equal_sketches_are_joined_once(spark):
    draw = random.Random(7)
    bases = [set(draw.sample(range(1, 10**9), 60)) for _ in range(3)]
    kinds = [*bases, *(set(draw.sample(sorted(b), 55)) for b in bases), *(b | set(draw.sample(range(10**9, 2 * 10**9), 8)) for b in bases), set()]
    sketch = {i: draw.choice(kinds) for i in range(60)}
    genomes = {i: (draw.randrange(5), draw.randrange(3)) for i in range(60)}
    rows = spark.createDataFrame([(i, h) for i, x in sketch.items() for h in x], "genome long, hash long")
    frame = spark.createDataFrame([(i, float(q), n) for i, (q, n) in genomes.items()], "genome long, quality_score double, total_bp long")
    for limit in (99, 99.6):
        got = similarity.dereplicate_sketches(frame, rows, 21, limit).collect()
        assert {r.genome: r.representative for r in got} == greedy(genomes, sketch, 21, limit) and len(got) == 60
