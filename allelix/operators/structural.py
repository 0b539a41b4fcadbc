"""Structural variants: genes that they overlap, gene metadata, payloads by gene, merges and exon back-fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import catalog as cat
from allelix.operators import intervals as iv

IDENTITY = ("variant_id", "study_id", "variant_region", "variant_type")
GENE_FIELDS = ("gene_location", "strand", "biotype", "canonical_transcript")


def gene_metadata(genes: DataFrame, seed: DataFrame, annotation: DataFrame) -> DataFrame:
    """`genes` (gene_id, gene_stable_id, start, end, strand, biotype of the overlap, once for each gene) with the metadata to publish.

    A gene's `seed` row counts if location, strand and biotype are all there; else the annotation's values by stable id (gene_stable_id, start, end,
    strand, biotype, canonical_transcript), each one that is missing from the overlap.
    """
    given = seed.select("gene_id", *[F.col(f).alias(f"__s_{f}") for f in GENE_FIELDS])
    known = annotation.select("gene_stable_id", *[F.col(f).alias(f"__a_{f}") for f in ("start", "end", "strand", "biotype", "canonical_transcript")])
    rows = genes.dropDuplicates(["gene_id", "gene_stable_id"]).join(given, "gene_id", "left").join(known, "gene_stable_id", "left")
    whole = F.col("__s_gene_location").isNotNull() & F.col("__s_strand").isNotNull() & F.col("__s_biotype").isNotNull()
    start, end = F.coalesce("__a_start", "start"), F.coalesce("__a_end", "end")
    place = F.when(start.isNotNull() & end.isNotNull(), fn.region(start, end))
    found = {"gene_location": place, "strand": F.coalesce("__a_strand", "strand"), "biotype": F.coalesce("__a_biotype", "biotype"), "canonical_transcript": F.col("__a_canonical_transcript")}
    return rows.select("gene_id", "gene_stable_id", *[F.when(whole, F.col(f"__s_{f}")).otherwise(c).alias(f) for f, c in found.items()])


def overlaps(variants: DataFrame, genes: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Variants (chrom, start, end, ...) with each gene (gene_id, gene_stable_id, chrom, start, end, strand, biotype) that they overlap; genes of
    `fallback` where a variant has none. The join is on bins of several sizes, as a structural variant may be as long as a chromosome."""
    v = variants.withColumnsRenamed({"start": "v_start", "end": "v_end", "chrom": "v_chrom"}).withColumn("__id", F.xxhash64("variant_id", "study_id", "v_chrom", "v_start", "v_end", "variant_type"))

    def hits(table: DataFrame, rows: DataFrame) -> DataFrame:
        g = table.select("gene_id", "gene_stable_id", F.col("chrom").alias("g_chrom"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), "strand", "biotype")
        return iv.overlap_join_of_any_length(rows, g, ("v_chrom", "g_chrom"), ("v_start", "g_start"), ("v_end", "g_end"))

    local = hits(genes, v)
    if fallback is not None:
        local = local.unionByName(hits(fallback, v.join(local.select("__id").distinct(), "__id", "left_anti").select(v.columns)))
    return local.drop("__id", "g_chrom")


def fold_by_gene(rows: DataFrame) -> DataFrame:
    """(gene_id, gene fields, variants) of rows with the IDENTITY columns, start, end, phenotypes, clinical_significance and assembly_name.

    Each variant counts once by identity; the first non-null value of a gene field, by variant place, stands; variants are in order of start,
    end and id.
    """
    clean = rows.where("gene_id is not null and variant_id is not null and study_id is not null and start is not null and end is not null").withColumn("variant_region", fn.region(F.col("start"), F.col("end")))
    once = clean.withColumn("__n", F.row_number().over(Window.partitionBy("gene_id", *IDENTITY).orderBy(F.col("clinical_significance").asc_nulls_last(), F.to_json("phenotypes")))).where("__n = 1")
    item = F.struct("start", "end", "variant_id", "study_id", "variant_type", "phenotypes", "clinical_significance", "assembly_name", "variant_region")
    order = F.struct("start", "end", "variant_id")
    fields = [F.min_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in GENE_FIELDS if f in rows.columns]
    return once.groupBy("gene_id").agg(*fields, F.array_sort(F.collect_list(item)).alias("variants"))


def merge_folded(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two folded tables as one: missing gene fields of the old filled by the new, variants united by identity, the old one's first.
    Each table is read twice, for its gene fields and for its variants, so let both be read from files."""
    both = old.withColumn("__r", F.lit(0)).unionByName(new.withColumn("__r", F.lit(1)))
    fields = [F.min_by(f, F.when(F.col(f).isNotNull() & (F.col(f).cast("string") != ""), F.col("__r"))).alias(f) for f in GENE_FIELDS if f in old.columns]
    heads = both.groupBy("gene_id").agg(*fields)
    each = both.select("gene_id", "__r", F.explode("variants").alias("v"))
    identity = [F.coalesce(F.col(f"v.{c}").cast("string"), F.lit("")) for c in IDENTITY]
    once = each.withColumn("__n", F.row_number().over(Window.partitionBy("gene_id", *identity).orderBy("__r"))).where("__n = 1")
    return heads.join(once.groupBy("gene_id").agg(F.array_sort(F.collect_list("v")).alias("variants")), "gene_id", "left")


def gene_payloads(folded: DataFrame) -> DataFrame:
    """(gene_id, payload_json): gene fields and variants, names of fields in order; the canonical transcript as a list."""
    transcript = F.coalesce(F.col("canonical_transcript"), F.lit("[]")) if "canonical_transcript" in folded.columns else F.lit("[]")
    variant = lambda v: F.struct(v.assembly_name.alias("assembly_name"), v.clinical_significance.alias("clinical_significance"), v.phenotypes.alias("phenotype"), v.study_id.alias("study_id"), v.variant_id.alias("variant_id"), v.variant_region.alias("variant_region"), v.variant_type.alias("variant_type"))
    options = {"ignoreNullFields": "false"}
    head = F.to_json(F.struct("biotype", F.parse_json(transcript).alias("canonical_transcript"), "gene_location", "strand", F.transform("variants", variant).alias("variants")), options)
    return folded.select("gene_id", head.alias("payload_json"))


def transcript_id(transcript: str = "canonical_transcript"):
    """The id without version of the first transcript of a JSON list."""
    return fn.without_version(fn.clean_string(F.get_json_object(transcript, "$[0].id")))


def exon_patch(payloads: DataFrame, exons: DataFrame) -> DataFrame:
    """(gene_id, canonical_transcript) of genes whose transcript has no exons and is annotated with some.

    payloads: (gene_id, canonical_transcript as JSON list); exons: (transcript_id without version, exons as array of struct). What the
    payload says already stays; only the exons are added.
    """
    bare = payloads.where(F.coalesce(F.get_json_object("canonical_transcript", "$[0].Exon"), F.lit("[]")) == "[]").withColumn("transcript_id", transcript_id())
    found = bare.join(exons.where(F.size("exons") > 0), "transcript_id")
    own = F.get_json_object("canonical_transcript", "$[0]").cast("string")
    fields = F.map_filter(F.try_parse_json(own).cast("map<string,variant>"), lambda k, _: k != "Exon")
    merged = F.map_concat(fields, F.create_map(F.lit("Exon"), F.parse_json(F.to_json("exons"))))
    return found.select("gene_id", F.to_json(F.array(merged)).alias("canonical_transcript"))


def apply_patch(payloads: DataFrame, patch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The payloads with patched transcripts, and one row of counts: patch genes, applied, missing (not among the payloads) and skipped (empty)."""
    new = patch.select("gene_id", F.col("canonical_transcript").alias("__new"), F.lit(True).alias("__patched"))
    usable = F.coalesce(~F.col("__new").isin("[]", ""), F.lit(False))
    out = payloads.join(new, "gene_id", "left").withColumn("canonical_transcript", F.when(usable, F.col("__new")).otherwise(F.col("canonical_transcript"))).drop("__new", "__patched")
    met = new.join(payloads.select("gene_id", F.lit(True).alias("__known")).distinct(), "gene_id", "left")
    known = F.col("__known").isNotNull()
    return out, met.agg(F.count("*").alias("patch_genes"), F.count_if(known & usable).alias("applied_genes"), F.count_if(~known).alias("missing_genes"), F.count_if(known & ~usable).alias("skipped_genes"))


def patch_candidates(payloads: DataFrame, parts: int = 1, part: int = 0, limit: int | None = None) -> DataFrame:
    """Genes without exons of one of `parts` parts by hash, in order of name, at most `limit`."""
    lacking = payloads.where(F.coalesce(F.get_json_object("canonical_transcript", "$[0].Exon"), F.lit("[]")) == "[]").where(F.pmod(F.xxhash64("gene_id"), F.lit(parts)) == part)
    return lacking if limit is None else lacking.orderBy("gene_id").limit(max(limit, 0))


def described_hits(variants: DataFrame, genes: DataFrame, seed: DataFrame, annotation: DataFrame, terms: Sequence[str] = (), fallback: DataFrame | None = None) -> DataFrame:
    """Variants that speak of `terms`, each with every gene that it overlaps and the gene's metadata: the rows that `fold_by_gene` folds."""
    hits = overlaps(variants.where(fn.matches_terms(F.col("phenotypes"), tuple(terms))), genes, fallback)
    regions = hits.select("gene_id", "gene_stable_id", F.col("g_start").alias("start"), F.col("g_end").alias("end"), "strand", "biotype")
    described = gene_metadata(regions, seed, annotation)
    return hits.drop("strand", "biotype").join(described, ["gene_id", "gene_stable_id"]).withColumnsRenamed({"v_start": "start", "v_end": "end", "v_chrom": "chrom"}).drop("g_start", "g_end")


def run_counts(variants: DataFrame, hits: DataFrame, terms: Sequence[str] = ()) -> DataFrame:
    """One row: variants seen, without type, without phenotype and left out by their terms, and hits."""
    seen = variants.agg(F.count("*").alias("rows_seen"), F.count_if(F.col("variant_type").isNull()).alias("no_type"), F.count_if(F.size("phenotypes") == 0).alias("no_phenotype"), F.count_if(~fn.matches_terms(F.col("phenotypes"), tuple(terms))).alias("filtered"))
    return seen.crossJoin(hits.agg(F.count("*").alias("records_emitted")))


def build(variants: DataFrame, genes: DataFrame, seed: DataFrame, annotation: DataFrame, terms: Sequence[str] = (), fallback: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The structural-variant job: variants that speak of `terms`, with the genes they overlap and their metadata, folded by gene; and one row of
    run counts."""
    hits = described_hits(variants, genes, seed, annotation, terms, fallback)
    return fold_by_gene(hits), run_counts(variants, hits, terms)


def backfill(payloads: DataFrame, exon_rows: DataFrame, parts: int = 1, part: int = 0) -> tuple[DataFrame, DataFrame]:
    """The exon back-fill job: payloads with exons from annotation rows (gene_id, transcript_id, exon_number, start, end), and its counts."""
    exons = cat.ordered_exons(exon_rows).groupBy(fn.without_version(F.col("transcript_id")).alias("transcript_id")).agg(F.max("exons").alias("exons"))
    return apply_patch(payloads, exon_patch(patch_candidates(payloads, parts, part), exons))
