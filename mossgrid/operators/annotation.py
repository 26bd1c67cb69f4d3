"""Functional annotation: hit filters, best hits, lookups, counts, taxonomy checks and incremental merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import one_per, union

COMMON = ("protein_id", "MAG", "MAG_contig_raw_id", "MAG_contig_id", "MAG_contig_gene_id")
FEFE = ("FeFe_subject", "FeFe_identity", "FeFe_evalue", "FeFe_bitscore")
#: Identity cutoffs of terminal-enzyme classes; 0.50 otherwise.
CUTOFFS = {0.80: ("PsaA",), 0.75: ("HbsT",), 0.70: ("PsbA", "IsoA", "AtpA", "YgfK", "ARO"), 0.60: ("CoxL", "MmoX", "AmoA", "NxrA", "NuoF", "RbcL", "NiFe", "FeFe", "Fe"), 0.40: ("RHO",)}
OTHER_CUTOFF = 0.50


def best_hit(hits: DataFrame, by: str = "protein_id") -> DataFrame:
    """The best hit of each protein: bitscore, then E-value, identity and subject. Each task keeps its best before anything moves."""
    order = F.struct(F.col("bitscore").isNull(), -F.col("bitscore"), "evalue", F.col("identity").isNull(), -F.col("identity"), "subject")
    rest = [c for c in hits.columns if c != by]
    return hits.groupBy(by).agg(F.min_by(F.struct(*rest), order).alias("_best")).select(*(F.col(f"_best.{c}").alias(c) if c != by else F.col(c) for c in hits.columns))


def hydrogenase_hits(hits: DataFrame, best_only: bool = False, evalue: float = 1e-50, identity: float = 0.5, coverage: float = 0.9) -> DataFrame:
    """Qualifying hits with their rank within the protein."""
    ok = hits.where((F.col("evalue") <= evalue) & (F.col("identity") >= identity) & (F.col("query_coverage") >= coverage))
    if best_only:
        return best_hit(ok).withColumn("hit_rank", F.lit(1).cast("long"))
    w = Window.partitionBy("protein_id").orderBy(F.desc("bitscore"), "evalue", F.desc("identity"), "subject")
    return ok.withColumn("hit_rank", F.row_number().over(w).cast("long"))


def required_identity(name: str = "class"):  # noqa: ANN201
    out = F.lit(OTHER_CUTOFF)
    for cutoff, names in CUTOFFS.items():
        out = F.when(F.col(name).isin(*names), F.lit(cutoff)).otherwise(out)
    return out


def terminal_hits(hits: DataFrame, evalue: float = 1e-50, coverage: float = 0.8) -> DataFrame:
    """The best hit of each protein among those that meet their class's identity; the cutoff comes before the choice."""
    ok = hits.withColumn("Required_identity", required_identity()).where((F.col("evalue") <= evalue) & (F.col("query_coverage") >= coverage) & (F.col("identity") >= F.col("Required_identity")))
    return best_hit(ok)


def add_hyd_group(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds HydDB_group and class of the subject, null where the reference has none; of several rows of a reference one is taken (see one_per)."""
    return hits.join(one_per(groups.withColumnRenamed("id", "subject"), "subject", "HydDB_group", "class"), "subject", "left")


def confirm_fefe(hyd_hits: DataFrame, fefe_hits: DataFrame, evalue: float = 1e-50) -> DataFrame:
    """FeFe candidates stay only with a second hit at the same E-value limit, whose evidence is attached; other classes have none."""
    second = best_hit(fefe_hits.where(F.col("evalue") <= evalue)).select("protein_id", *(F.col(a).alias(b) for a, b in (("subject", "FeFe_subject"), ("identity", "FeFe_identity"), ("evalue", "FeFe_evalue"), ("bitscore", "FeFe_bitscore"))))
    joined = hyd_hits.join(second, "protein_id", "left")
    is_fefe = F.coalesce(F.col("class") == "FeFe", F.lit(False))
    for c in second.columns[1:]:
        joined = joined.withColumn(c, F.when(is_fefe, F.col(c)))
    return joined.where(~is_fefe | F.col("FeFe_subject").isNotNull())


def annotate_ko(assignments: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Adds gene name and description; an unmatched or null KO keeps its row with nulls. Of several descriptions of a KO one is taken (see one_per)."""
    return assignments.join(one_per(descriptions, "KO", "KO_gene_name", "KO_description"), "KO", "left")


def missing_ko_descriptions(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("KO").isNotNull() & F.col("KO_description").isNull()).agg(F.count_distinct("KO").alias("missing"))


def ko_descriptions_from_list(ko_list: DataFrame) -> DataFrame:
    """Descriptions from `knum` and `definition`: the part before the first `; ` is the gene name."""
    has = F.instr("definition", "; ") > 0
    return ko_list.select(F.col("knum").alias("KO"), F.when(has, F.substring_index("definition", "; ", 1)).alias("KO_gene_name"), F.when(has, F.expr("substring(definition, instr(definition, '; ') + 2)")).otherwise(F.col("definition")).alias("KO_description"))


def map_back(hits: DataFrame, gene_map: DataFrame) -> DataFrame:
    return hits.join(gene_map, "protein_id")


def gene_counts(annotations: DataFrame, function: str = "function") -> DataFrame:
    """Unique genes per MAG and function; unassigned ones don't count."""
    named = annotations.where(F.col(function).isNotNull() & ~F.col(function).isin("", "Unclassified", "NA"))
    return named.groupBy("MAG", function).agg(F.count_distinct("MAG_contig_gene_id").alias("genes"))


def hydrogenase_table(confirmed: DataFrame, gene_map: DataFrame) -> DataFrame:
    """The reported table: common columns, the matched reference and its group, and the second hit of FeFe rows. confirmed: hits with their group and FeFe evidence."""
    named = confirmed.select("protein_id", F.col("subject").alias("HydDB_subject"), "HydDB_group", F.col("class").alias("Gene"), *FEFE)
    return map_back(named, gene_map).select(*COMMON[1:], "Gene", "HydDB_subject", "HydDB_group", *FEFE)


def terminal_table(best: DataFrame, gene_map: DataFrame, titles: DataFrame) -> DataFrame:
    """The reported table: common columns, the reference, its title (subject, title) and the identity that its class requires."""
    named = best.join(titles.select("subject", "title"), "subject", "left").select("protein_id", F.col("class").alias("Gene"), F.col("subject").alias("Reference"), F.col("title").alias("Reference_title"), "Required_identity")
    return map_back(named, gene_map).select(*COMMON[1:], "Gene", "Reference", "Reference_title", "Required_identity")


def kegg_table(annotated: DataFrame, gene_map: DataFrame) -> DataFrame:
    """The reported table: common columns, gene name and description of the KO. annotated: (protein_id, KO, KO_gene_name, KO_description)."""
    return map_back(annotated.withColumnRenamed("KO", "Gene"), gene_map).select(*COMMON[1:], "Gene", "KO_gene_name", "KO_description")


def stack_annotations(skip: tuple = (), **branches: DataFrame) -> DataFrame:
    """The five common columns of every branch, with the branch's name; branches in skip are left out."""
    if unknown := set(skip) - branches.keys():
        raise ValueError(f"no such branches: {sorted(unknown)}")
    return union(*(df.select(*COMMON).withColumn("branch", F.lit(name)) for name, df in branches.items() if name not in skip))


def pending_mags(mags: DataFrame, ledger: DataFrame) -> DataFrame:
    return mags.select("mag").distinct().join(ledger.select("mag").distinct(), "mag", "left_anti")


def merge_annotations(old: DataFrame, new: DataFrame, settings: tuple = (), batch: DataFrame | None = None, mag: str = "MAG") -> DataFrame:
    """The table with a batch of MAGs put in: a MAG of the batch has the batch's rows only, so a repeated batch changes nothing.

    batch: the ledger of MAGs that were annotated, also those without a hit; by default those with rows. Rows of other
    settings may not mix: one value of each such column, nulls being one, or ValueError. Rows without a MAG stay from both.
    """
    if settings:
        both = union(old.select(*settings), new.select(*settings))
        # One pass: a column has one value if its least and largest are equal and nulls are all or none.
        found = both.agg(F.count("*").alias("rows"), *(f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(settings) for k, f in (("least", F.min), ("most", F.max), ("count", F.count)))).first()
        for i, c in enumerate(settings):
            if found[f"least{i}"] != found[f"most{i}"] or found[f"count{i}"] not in (0, found["rows"]):
                raise ValueError(f"rows differ in {c}: write to a new folder")
    done = (new if batch is None else batch).select(F.col(mag).alias("_mag")).distinct()
    return union(old.join(done, F.col(mag) == F.col("_mag"), "left_anti"), new)


def merge_taxonomy(*batches: DataFrame) -> DataFrame:
    return union(*batches)


def merge_abundance(*tables: DataFrame) -> DataFrame:
    return union(*tables)


def taxonomy_violations(mags: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(mag, problem): MAGs without a classification, with several, or with one that no MAG asks for."""
    per = taxonomy.groupBy("mag").agg(F.count_distinct("classification").alias("n"))
    asked = mags.select("mag").distinct()
    absent = asked.join(per.where("n > 0"), "mag", "left_anti").select("mag", F.lit("missing").alias("problem"))
    many = per.where("n > 1").join(asked, "mag", "left_semi").select("mag", F.lit("inconsistent").alias("problem"))
    return union(absent, many, per.join(asked, "mag", "left_anti").select("mag", F.lit("unknown").alias("problem")))


def add_taxonomy(abundance: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Abundance rows with the seven ranks of their lineage, nulls without one; of several lineages of a MAG one is taken (see one_per)."""
    taxonomy = one_per(taxonomy, "mag", "classification")
    lineage = F.split("classification", ";")
    ranks = ("domain", "phylum", "class", "order", "family", "genus", "species")
    return abundance.join(taxonomy.select("mag", *(F.get(lineage, k).alias(r) for k, r in enumerate(ranks))), "mag", "left")
