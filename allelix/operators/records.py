"""Record-level operators: filters, source-priority de-duplication, enrichment, validation, reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn

KEY = ("dataset_type", "gene_id", "variant_id", "phenotype")


def broadcast_if_few(small: DataFrame, rows: int = 1 << 18) -> DataFrame:
    """A table of configuration with the hint to broadcast it, if it has at most `rows` rows. Joined by a shuffle it would draw all rows of a large table into
    as many tasks as it has keys, which are few."""
    return F.broadcast(small) if small.count() <= rows else small


def core_keys(df: DataFrame) -> DataFrame:
    """Rows with gene (gene-like), variant and phenotype."""
    return df.where(fn.is_gene(F.col("gene_id")) & fn.clean_string(F.col("variant_id")).isNotNull() & fn.clean_string(F.col("phenotype")).isNotNull())


def of_types(df: DataFrame, types: Sequence[str]) -> DataFrame:
    return df.where(F.col("dataset_type").isin(*types)) if types else df


def genes_in(df: DataFrame, genes: DataFrame, exclude: bool = False) -> DataFrame:
    """Rows whose gene is (or is not) in the list; Spark broadcasts the list only if it is small by its statistics."""
    return df.join(genes.select("gene_id").distinct(), "gene_id", "left_anti" if exclude else "left_semi")


def hash_part(df: DataFrame, column: str, parts: int, part: int) -> DataFrame:
    """The rows of one of `parts` parts by SHA-1, the same in any engine."""
    return df.where(F.conv(F.substring(F.sha1(F.col(column).cast("binary")), 1, 8), 16, 10).cast("bigint") % parts == part)


def best_order(priority: Sequence[str]) -> list[Column]:
    """Source rank, then the smallest p-value with nulls last, the newest, the source, and the row key as a total tie-break."""
    return [fn.source_rank(F.col("source"), tuple(priority)).asc(), F.col("p_value").isNull().asc(), F.col("p_value").asc(), F.col("ingested_at").desc_nulls_last(), F.col("source").asc_nulls_last(), F.col("row_key").asc_nulls_last()]


def normalised_keys(df: DataFrame) -> DataFrame:
    """`df` with trimmed keys, the dataset type in upper case, the phenotype as slug, and blank labels and codes as null."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    new = {"dataset_type": F.upper(F.trim("dataset_type")), "gene_id": F.trim("gene_id"), "variant_id": F.trim("variant_id"), "phenotype": fn.slug(F.col("phenotype")), "disease_category": F.coalesce(F.trim("disease_category"), F.lit(""))}
    new |= {c: blank(F.col(c)) for c in ("variation_type", "clinical_significance", "most_severe_consequence", "ancestry", "ancestry_source_code", "ancestry_source_label", "phenotype_key")}
    return df.withColumns({c: e for c, e in new.items() if c in df.columns})


def dedup_by_source(df: DataFrame, priority: Sequence[str], by_variant: bool = False) -> DataFrame:
    """Points with normalised keys, the best row for each (dataset type, gene, variant, phenotype slug, ancestry code or else group).

    The filter on the row number lets Spark drop losers before the shuffle (window group limit). `by_variant` deals all rows, losers too, by type, gene and
    variant, so that a variant's points lie in one partition: what is then collapsed by variant is so before its shuffle."""
    rows = normalised_keys(df)
    if by_variant:
        rows = rows.repartition("dataset_type", "gene_id", "variant_id")
    w = Window.partitionBy("dataset_type", "gene_id", "variant_id", "phenotype", F.coalesce("ancestry_source_code", "ancestry")).orderBy(*best_order(priority))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def best_fields(df: DataFrame, keys: Sequence[str], fields: Sequence[str], priority: Sequence[str]) -> DataFrame:
    """The fields of the best row for each key. The filter on the row number drops losers before the shuffle; a struct of strings in an
    aggregate would make Spark sort all rows first."""
    w = Window.partitionBy(*keys).orderBy(*best_order(priority))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*keys, *fields)


def enrich(records: DataFrame, candidates: DataFrame, field: str, key: str, sources: Sequence[str]) -> DataFrame:
    """Fill `field` where it is missing: the candidate of the first source in `sources`, else the first candidate by (source, value)."""
    best = candidates.groupBy(key).agg(F.min_by("value", F.struct(fn.source_rank(F.col("source"), tuple(sources)).alias("r"), "source", "value")).alias("__value"))
    return records.join(best, key, "left").withColumn(field, F.coalesce(fn.clean_string(F.col(field)), F.col("__value"))).drop("__value")


REQUIRED, OPTIONAL = True, False


def validate(df: DataFrame, policies: Sequence[tuple[str, bool, str, str]]) -> DataFrame:
    """`df` with missing fields filled, `valid`, and `issues` (array<struct<field, message>>).

    policies: (field, required, "exclude" | "unknown" | "allow", value for unknown), in order. A record is excluded at the first
    required field of that kind that is missing, and later fields raise no issue and are not filled.
    """
    fields = list(dict.fromkeys(p[0] for p in policies))
    blank = F.struct(*[(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")).alias(f) for f in fields])
    flagged = df.withColumn("__blank", blank)
    alive, issues, values = F.lit(True), [], {}
    for field, required, strategy, unknown in policies:
        missing = F.col(f"__blank.`{field}`")
        if strategy == "unknown":
            values[field] = F.when(alive & missing, F.lit(unknown)).otherwise(F.col(field))
        if required:
            said = {"unknown": "set to unknown marker", "allow": "kept by policy", "exclude": "record excluded"}[strategy]
            issues.append(F.when(alive & missing, F.struct(F.lit(field).alias("field"), F.lit(f"Required field missing; {said}.").alias("message"))))
            if strategy == "exclude":
                alive = alive & ~missing
    found = F.filter(F.array(*issues), lambda x: x.isNotNull())
    return flagged.select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns], alive.alias("valid"), found.alias("issues"))


def unpivot_ancestry(df: DataFrame, ids: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """One row for each ancestry, values null or not, and one more with a null ancestry where all values are null."""
    long = df.select(*ids, F.explode(F.array(*[F.struct(F.lit(label).alias("ancestry"), F.col(c).cast("double").alias("ancestry_af")) for c, label in columns.items()])).alias("x")).select(*ids, "x.*")
    none = df.where(F.coalesce(*[F.col(c) for c in columns]).isNull()).select(*ids, F.lit(None).cast("string").alias("ancestry"), F.lit(None).cast("double").alias("ancestry_af"))
    return long.unionByName(none)


def drift(inventory: DataFrame, expected: Sequence[str]) -> DataFrame:
    """`inventory` (file, columns) with added, removed and status against the expected columns."""
    want = F.array(*[F.lit(c) for c in expected]) if expected else F.array().cast("array<string>")
    out = inventory.withColumn("added", F.array_except("columns", want)).withColumn("removed", F.array_except(want, "columns"))
    status = F.when(F.lit(not expected), "unchecked").when(F.size("removed") > 0, "breaking").when(F.size("added") > 0, "compatible_with_additions").otherwise("compatible")
    return out.withColumn("status", status)


def drift_of_groups(inventory: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Drift against groups of columns of which one each is needed."""
    missing = F.filter(F.array(*[F.when(~F.arrays_overlap("columns", F.array(*[F.lit(c) for c in g])), F.lit("one_of(" + "|".join(g) + ")")) for g in groups]), lambda x: x.isNotNull())
    known = F.array(*[F.lit(c) for g in groups for c in g])
    out = inventory.withColumn("added", F.array_except("columns", known)).withColumn("removed", missing)
    return out.withColumn("status", F.when(F.size("removed") > 0, "breaking").when(F.size("added") > 0, "compatible_with_additions").otherwise("compatible"))


def analysis_ready(df: DataFrame, release: str) -> DataFrame:
    """Points or source-normalised rows as the analysis-ready table: the gene also in upper case, with source and release."""
    new = {"release_id": F.lit(release), "gene_id_normalized": F.upper(fn.strip(F.col("gene_id"))), "source_id": F.col("source")}
    for name, default in (("source_row_id", ""), ("phenotype_path_json", "[]"), ("metadata_json", "{}")):
        if name not in df.columns:
            new[name] = F.lit(default)
    return df.withColumns(new)
