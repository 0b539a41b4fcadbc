"""Gene catalogs, shared-variant analysis and other products across tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn


def gene_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """gene_id_normalized and a flag for each table that has the gene: one union and one group instead of outer joins."""
    rows = None
    for name, df in tables.items():
        part = df.select(F.upper(F.trim("gene_id")).alias("gene_id_normalized"), F.lit(name).alias("t")).distinct()
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("gene_id_normalized").agg(*[F.bool_or(F.col("t") == name).alias(f"has_{name}") for name in tables])


def gene_catalog_by_joins(tables: dict[str, DataFrame]) -> DataFrame:
    """The same by full outer joins on the gene."""
    out = None
    for name, df in tables.items():
        part = df.select(F.upper(F.trim("gene_id")).alias("gene_id_normalized")).distinct().withColumn(f"has_{name}", F.lit(True))
        out = part if out is None else out.join(part, "gene_id_normalized", "full")
    return out.select("gene_id_normalized", *[F.coalesce(f"has_{name}", F.lit(False)).alias(f"has_{name}") for name in tables])


def pending(source: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `source` that `done` lacks."""
    return source.select(*keys).distinct().join(done.select(*keys).distinct(), list(keys), "left_anti")


def eligible_genes(points: DataFrame) -> DataFrame:
    """Genes with both dataset types."""
    return points.groupBy("gene_id").agg(F.count_distinct("dataset_type").alias("n")).where("n = 2").select("gene_id")


def shared_variants(points: DataFrame) -> DataFrame:
    """(gene, type, name, variant): variants that a phenotype shares with any phenotype of the other dataset type.

    A variant is shared if its gene has it in both types, so the pairs of phenotypes need never be listed."""
    rows = points.select("gene_id", "dataset_type", fn.slug(F.col("phenotype")).alias("name"), "variant_id").distinct()
    both = rows.groupBy("gene_id", "variant_id").agg(F.count_distinct("dataset_type").alias("n")).where("n = 2").select("gene_id", "variant_id")
    return rows.join(both, ["gene_id", "variant_id"], "left_semi").select("gene_id", F.lower("dataset_type").alias("type"), "name", "variant_id")


def shared_architecture(points: DataFrame) -> DataFrame:
    """For each gene, type and phenotype: the count of shared variants, and the first and last of their identity values."""
    value = F.get(fn.identity_interval(F.col("variant_id")), F.lit(0))
    return shared_variants(points).groupBy("gene_id", "type", "name").agg(F.count("*").alias("shared_variant_count"), F.min(value).alias("least"), F.max(value).alias("most"))


def best_transcripts(transcripts: DataFrame) -> DataFrame:
    """One transcript for each gene: canonical, MANE, APPRIS principal, protein coding, then the longest, then its id."""
    w = Window.partitionBy("gene_id").orderBy(F.col("is_canonical").desc(), F.col("is_mane").desc(), F.col("is_appris").desc(), (F.col("biotype") == "protein_coding").desc(), F.col("span").desc(), F.col("transcript_id"))
    return transcripts.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def canonical_transcripts(transcripts: DataFrame) -> DataFrame:
    """One transcript for each gene: the canonical one, else the primary one, else the first by `ord`."""
    w = Window.partitionBy("gene_id").orderBy(F.col("is_canonical").desc_nulls_last(), F.col("gencode_primary").desc_nulls_last(), F.col("ord"), F.col("transcript_id"))
    return transcripts.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_isoforms(transcripts: DataFrame, n: int = 12) -> DataFrame:
    """Hinted, canonical and primary transcripts of each gene; where a gene has none of these, its first n by `ord`. At most n, in
    order: canonical, primary, id."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    chosen = yes("hinted") | yes("is_canonical") | yes("gencode_primary")
    by_gene = Window.partitionBy("gene_id")
    rows = transcripts.withColumn("__chosen", chosen).withColumn("__any", F.max("__chosen").over(by_gene)).withColumn("__ord", F.row_number().over(by_gene.orderBy("ord", "transcript_id")))
    kept = rows.where(F.col("__chosen") | (~F.col("__any") & (F.col("__ord") <= n)))
    ranked = kept.withColumn("rank", F.row_number().over(by_gene.orderBy(yes("is_canonical").desc(), yes("gencode_primary").desc(), "transcript_id")))
    return ranked.where(F.col("rank") <= max(n, 1)).drop("__chosen", "__any", "__ord")


def ordered_exons(exons: DataFrame) -> DataFrame:
    """Exons of each transcript as one array in order of number (missing last), start and end."""
    item = F.struct(F.coalesce("exon_number", F.lit(1_000_000_000)).alias("exon_number"), F.col("start"), F.col("end"))
    return exons.groupBy("gene_id", "transcript_id").agg(F.array_sort(F.collect_list(item)).alias("exons"))


def fold_structural(variants: DataFrame) -> DataFrame:
    """Variants of each gene once by (id, start, end, type), as an array in order of start, end and id."""
    once = variants.dropDuplicates(["gene_id", "variant_id", "start", "end", "type"])
    return once.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "variant_id", "type"))).alias("variants"))


def payload_violations(counters: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Rows of a published counter table that break its contract: negative value, name that is not canonical, or repeated name."""
    canonical = F.when(F.col("axis") == "vc", fn.variation_label(F.col("name"))).when(F.col("axis") == "msc", fn.consequence_label(F.col("name"))).otherwise(fn.significance_label(F.col("name")))
    times = counters.groupBy(*scope, "axis", "name").agg(F.count("*").alias("times"), F.min("value").alias("least"))
    problem = F.when(F.col("least") < 0, "negative").when(~F.col("name").eqNullSafe(canonical), "not canonical").when(F.col("times") > 1, "repeated")
    return times.withColumn("problem", problem).where("problem is not null")
