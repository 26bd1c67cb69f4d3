"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Sources share a budget of words by weight, none above a multiple of its own size. Within a source, a document's expected
copies grow with the square root of its size up to that multiple. Whole copies are certain; the rest is drawn: documents
are ranked by random odds over inclusion odds (Pareto order sampling) and taken in that order until the source's words are
met, so that the sample has a fixed size in words. Ranks come from a hash of the id: reruns agree.

What is gathered for each source is a sum per size class and, level by level, 64 sums of ever finer rank buckets; a cut
falls in one of the finest buckets, and only its different places are sorted. A source of any share of the rows is spread
over all tasks, as are sources however many. Of rows that share a place in the order (one id, size and text) as many are
taken as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, running

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
LEVELS = 3
LEVEL_BITS = 6
SEED = "mix-1"
#: Columns that the operator adds for itself; documents can't have them.
INSIDE = frozenset("_s _mix _text _rate _id_text _expected _whole _part _rank _bucket _cut _last _row _no _file _skip".split())
SIZE = r"[^\x20\x09-\x0D]+"


def rank_value(inclusion: Column, u: Column) -> Column:
    """Pareto rank q / (1 + q), q being the odds of u over the odds of inclusion; it lies in 0 to 1."""
    up, down = u * (1 - inclusion), (1 - u) * inclusion
    return up / (up + down)


def uniform(id_text: Column, seed: str = SEED) -> Column:
    return (F.conv(F.substring(F.md5(F.concat(id_text, F.lit(f"|{seed}"))), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size): weights repeat over the sources in code point order, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = F.col("source").asc_nulls_last()
    numbered = running(per, [by_name], place=F.lit(1))
    weighed = numbered.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", (F.col("source_size") * most).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    filled = kept(running(weighed, [F.col("ratio"), by_name], caps=F.col("cap"), ws=F.col("w")), "filled")
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    # Sources below the level are full; what they leave is shared by the weights of the rest.
    lift = (F.lit(budget * (whole["size"] or 0)) - (F.col("caps") - F.col("cap"))) / (F.lit(whole["w"] or 0) - F.col("ws") + F.col("w"))
    level = filled.withColumn("lift", lift).where("lift <= ratio").agg(F.min(F.struct("ratio", "lift")).alias("x")).select("x.lift").first()["lift"]
    return filled.select("source", "source_size", F.least("cap", F.lit(float(level or 0)) * F.col("w")).alias("target"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def joined(rows: DataFrame, by_source: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the columns of a table that has one row per source."""
    return rows.join(by_source.withColumnRenamed("source", "_s"), same(F.col("source"), F.col("_s")), how).drop("_s")


def plan_mix(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """What every source takes, as (source, source_size, target, _mix) for `mix`. sizes: (doc_id, source, size, and optionally _text, a hash of the text), read several times."""
    sizes = sizes if "_text" in sizes.columns else sizes.withColumn("_text", F.lit(0).cast("long"))
    targets = kept(source_targets(sizes, weights, budget, most), "targets")
    classes = sizes.withColumn("m", measure()).groupBy("source", "m").agg(F.sum("size").alias("words"))
    down = Window.partitionBy("source").orderBy(F.desc("m"))
    rates = classes.withColumn("above", F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("under", F.sum(F.col("m") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing)))
    rates = joined(rates, targets)
    rates = rates.withColumn("rate", F.try_divide(F.col("target") - most * F.col("above"), F.col("under").cast("double"))).where(F.col("rate") * F.col("m") <= most)
    rates = rates.groupBy("source").agg(F.max_by("rate", "m").alias("rate"))
    plan = joined(targets, rates, "left").withColumn("rate", F.when(F.col("target") < most * F.col("source_size"), F.col("rate")))
    plan = kept(plan.select("source", "source_size", "target", F.struct("rate").alias("_mix")), "rates")

    drawn = with_ranks(sizes, plan, most, seed).select("source", "size", "target", "_text", *(F.col(f"_{x}").alias(x) for x in ("id_text", "whole", "part", "rank", "bucket")))
    sure = drawn.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("sure"))
    cut = kept(sure.select("source", (F.col("target") - F.col("sure")).alias("rest"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("before")), "rest")
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        inside = joined(drawn.where("part > 0"), cut).where(F.shiftright("bucket", shift + LEVEL_BITS) == F.col("at"))
        sums = inside.groupBy("source", F.shiftright("bucket", shift).alias("b")).agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
        sums = sums.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
        first = sums.where("upto > rest").groupBy("source").agg(F.min(F.struct("b", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("c"))
        cut = kept(first.select("source", "c.rest", F.col("c.b").alias("at"), "c.before"), "cuts")
    # Rows of one place are counted, then places are added up in their order.
    inside = joined(drawn.where("part > 0"), cut).where("bucket = at")
    places = inside.groupBy("source", "rank", "id_text", "size", "_text").agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("rank", "id_text", "size", "_text")
    places = places.withColumn("start", F.col("before") + F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") * F.col("n"))
    fits = lambda k: F.col("start") + k * F.col("size") - F.col("size") / 2 <= F.col("rest")
    guess = F.coalesce(F.floor(F.try_divide(F.col("rest") - F.col("start"), F.col("size").cast("double")) + 0.5), F.when(fits(F.lit(1)), F.col("n")).otherwise(0))
    places = places.withColumn("k", F.greatest(F.least(guess, F.col("n")), F.lit(0)))
    places = places.withColumn("k", F.when((F.col("k") > 0) & ~fits(F.col("k")), F.col("k") - 1).when((F.col("k") < F.col("n")) & fits(F.col("k") + 1), F.col("k") + 1).otherwise(F.col("k")))
    last = places.where("k > 0").groupBy("source").agg(F.max(F.struct(F.struct("rank", "id_text", "size", "_text").alias("place"), F.col("k").alias("take"), F.col("n").alias("ties"))).alias("last"))
    plan = joined(joined(plan, cut.select("source", F.col("at").alias("cut_bucket")), "left"), last, "left")
    return kept(plan.select("source", "source_size", "target", F.struct("_mix.rate", "cut_bucket", "last").alias("_mix")), "plan")


def measure() -> Column:
    """The inclusion measure: whole square root of the size, 1 at least."""
    return F.greatest(F.floor(F.sqrt("size")), F.lit(1)).cast("long")


def with_ranks(rows: DataFrame, plan: DataFrame, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Adds source_size, target and _mix of the source's plan; whole copies, the inclusion probability of one more (_part), and the rank and its finest bucket."""
    out = joined(rows, plan, "left").withColumn("_rate", F.col("_mix.rate"))
    expected = F.when(F.col("_rate").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.col("_rate") * measure()))
    out = out.withColumn("_id_text", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("_expected", expected).withColumn("_whole", F.floor("_expected"))
    out = out.withColumn("_part", F.col("_expected") - F.col("_whole")).withColumn("_rank", F.when(F.col("_part") > 0, rank_value(F.col("_part"), uniform(F.col("_id_text"), seed))))
    fine = F.least(F.floor(F.col("_rank") * float(1 << LEVEL_BITS * LEVELS)), F.lit((1 << LEVEL_BITS * LEVELS) - 1))
    return out.withColumn("_bucket", F.coalesce(fine, F.lit(0)).cast("long"))


def mix(rows: DataFrame, plan: DataFrame, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Adds copies, source_size and target to rows of (doc_id, source, size, _text, ...); _text goes.

    Where only some of the rows of one place are taken, those rows are written down and numbered by file and place in it.
    """
    drawn = with_ranks(rows, plan, most, seed)
    last, place = F.col("_mix.last"), F.struct("_rank", "_id_text", "size", "_text")
    drawn = drawn.withColumn("_cut", F.col("_mix.cut_bucket")).withColumn("_last", last["place"])
    before = (F.col("_part") > 0) & (F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")) | F.coalesce((F.col("_bucket") == F.col("_cut")) & (place < F.col("_last")), F.lit(False)))
    at = F.coalesce((F.col("_part") > 0) & (F.col("_bucket") == F.col("_cut")) & (place == F.col("_last")), F.lit(False))
    columns = [*rows.drop("_text").columns, "source_size", "target"]
    out = lambda df, more: df.select(*columns, (F.col("_whole") + F.when(more, 1).otherwise(0)).alias("copies"))
    if plan.where("_mix.last.take < _mix.last.ties").isEmpty():
        return out(drawn, before | at)
    split = at & (last["take"] < last["ties"])
    tied = kept(drawn.where(split), "ties").select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("_row"))
    files = tied.groupBy("source", F.col("_row.file_path").alias("_file")).agg(F.count("*").alias("n"))
    files = files.withColumn("_skip", F.sum("n").over(Window.partitionBy("source").orderBy("_file")) - F.col("n")).select(F.col("source").alias("_s"), "_file", "_skip")
    tied = tied.withColumn("_no", F.row_number().over(Window.partitionBy("source", "_row.file_path").orderBy("_row.row_index")))
    tied = tied.join(files, same(F.col("source"), F.col("_s")) & (F.col("_row.file_path") == F.col("_file")))
    return out(drawn.where(~split), before | at).unionByName(out(tied, F.col("_no") + F.col("_skip") <= last["take"]))


def sized(docs: DataFrame) -> list[Column]:
    """size and _text of documents."""
    return [F.coalesce(F.regexp_count("text", F.lit(SIZE)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("_text")]


def mix_documents(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Adds size, source_size, target and copies to every row of documents (doc_id, source, text, ...).

    Null text has size 0. A null source is a source of its own, last in order. A null id ranks as an empty one. Rows of one
    id and text share a place in the order, and as many of them are taken as fit. Documents without words take no words.
    Tables may be empty. Other columns stay, whatever their names; earlier ones of the four names are replaced, and names
    of INSIDE are an error.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    if clash := INSIDE.intersection(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are used inside")
    docs = docs.select("*", *sized(docs))
    sizes = kept(docs.select("doc_id", "source", "size", "_text"), "sizes")
    return mix(docs, plan_mix(sizes, weights, budget, most, seed), most, seed)


def mixed_sizes(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The same for sizes only: (doc_id, source, size, source_size, target, copies); texts are read once."""
    sizes = kept(docs.select("doc_id", "source", *sized(docs)), "sizes")
    return mix(sizes, plan_mix(sizes, weights, budget, most, seed), most, seed)


def sql(table: str = "documents") -> str:
    """The same draw in DuckDB's SQL, with one order over each whole source."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SIZE}')), 0)::BIGINT AS size FROM {table}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS w, (source_size * {MOST})::DOUBLE AS cap FROM per),
lev AS (SELECT *, cap / w AS ratio, ({BUDGET}::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lift FROM weighed),
lv AS (SELECT arg_min(lift, ratio) AS level FROM lev WHERE lift <= ratio),
tgt AS (SELECT source, source_size, least(cap, coalesce(level, 0) * w) AS target FROM lev LEFT JOIN lv ON true),
m AS (SELECT *, greatest(floor(sqrt(size)), 1)::BIGINT AS m FROM d),
cls AS (SELECT source, m, sum(size)::BIGINT AS words FROM m GROUP BY source, m),
run AS (SELECT source, m, coalesce(sum(words) OVER (PARTITION BY source ORDER BY m DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS above, (sum(m * words) OVER (PARTITION BY source ORDER BY m DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS under FROM cls),
cand AS (SELECT run.source, m, (target - {MOST} * above) / nullif(under, 0)::DOUBLE AS rate FROM run JOIN tgt ON run.source IS NOT DISTINCT FROM tgt.source),
rate AS (SELECT source, arg_max(rate, m) AS rate FROM cand WHERE rate * m <= {MOST} GROUP BY source),
plan AS (SELECT tgt.*, CASE WHEN target < {MOST} * source_size THEN rate END AS rate FROM tgt LEFT JOIN rate ON tgt.source IS NOT DISTINCT FROM rate.source),
e AS (SELECT m.*, source_size, target, coalesce(m.doc_id::VARCHAR, '') AS id_text, CASE WHEN rate IS NULL THEN {MOST}.0::DOUBLE ELSE least({MOST}.0::DOUBLE, rate * m) END AS expected FROM m JOIN plan ON m.source IS NOT DISTINCT FROM plan.source),
f AS (SELECT *, floor(expected) AS whole, expected - floor(expected) AS part, (('0x' || substr(md5(id_text || '|{SEED}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u FROM e),
g AS (SELECT *, CASE WHEN part > 0 THEN (u * (1 - part)) / (u * (1 - part) + (1 - u) * part) END AS rank FROM f),
h AS (SELECT *, target - sum(whole::BIGINT * size) OVER (PARTITION BY source) AS rest, sum(CASE WHEN part > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, id_text, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM g)
SELECT doc_id, size, source_size, target, ((whole + CASE WHEN part > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM h"""
