"""Variant-centric aggregation: rows are collapsed by variant inside a scope before anything is counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import records as rec

AXES = {"vc": ("variation_type", "variation"), "msc": ("most_severe_consequence", "most_severe_consequence"), "cs": ("clinical_significance", "clinical_significance")}


def best_per_variant(df: DataFrame, scope: Sequence[str], fields: Sequence[str] = ("variation_type", "most_severe_consequence", "clinical_significance", "p_value")) -> DataFrame:
    """One row for each variant of a scope: the one with the smallest p-value, nulls last, ties by row key. Losers go before the shuffle."""
    w = Window.partitionBy(*scope, "variant_id").orderBy(F.col("p_value").asc_nulls_last(), F.col("row_key").asc_nulls_last())
    return df.select(*dict.fromkeys([*scope, "variant_id", *fields, "p_value", "row_key"])).withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*scope, "variant_id", *fields)


def count_axes(best: DataFrame, scope: Sequence[str], unknown: bool = False) -> DataFrame:
    """(scope, axis, name, value): variants by label on each axis; unknown labels are left out or counted as Unknown.

    Raw values are counted first and their labels found after, so the label rules run once for each (scope, raw value), not for each variant.
    """
    raw = F.array(*[F.struct(F.lit(axis).alias("axis"), F.col(column).alias("raw")) for axis, (column, _) in AXES.items()])
    counted = best.select(*scope, F.explode(raw).alias("x")).select(*scope, "x.*").groupBy(*scope, "axis", "raw").agg(F.count("*").alias("n"))
    name = F.lit(None).cast("string")
    for axis, (_, kind) in AXES.items():
        name = F.when(F.col("axis") == axis, fn.axis_label(F.col("raw"), kind)).otherwise(name)
    rows = counted.withColumn("name", name)
    rows = rows.withColumn("name", F.coalesce("name", F.lit("Unknown"))) if unknown else rows.where("name is not null")
    return rows.groupBy(*scope, "axis", "name").agg(F.sum("n").alias("value"))


def aggregate_variants(df: DataFrame, scope: Sequence[str], unknown: bool = False) -> DataFrame:
    """Collapse by variant in the scope, then count: the one rule behind label, overall, roll-up and filtered totals."""
    return count_axes(best_per_variant(df, scope), scope, unknown)


def filtered(df: DataFrame, phenotypes: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """Totals over some phenotypes only; the collapse is done anew on what the filter leaves."""
    return aggregate_variants(df.where(F.col("phenotype").isin(*phenotypes)), scope)


def roll_up(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Points with category and label of the roll-up, from `mapping` (dataset_type, slug, mapped_category).

    Category: the map's for the dataset type, else for the type '', else the slug of the record's own. Label: the slug of
    parent_phenotype, if it is there and no number, else the category, else the slug of the phenotype.
    """
    keyed = df.withColumn("slug", fn.slug(F.col("phenotype")))
    entry = F.struct("dataset_type", F.coalesce("mapped_category", F.lit("")).alias("category"))
    by_type = mapping.dropDuplicates(["dataset_type", "slug"]).groupBy("slug").agg(F.map_from_entries(F.collect_list(entry)).alias("__by_type"))
    found = keyed.join(rec.broadcast_if_few(by_type), "slug", "left")
    blank = lambda c: F.nullif(c, F.lit(""))
    category = F.coalesce(blank(F.try_element_at("__by_type", F.col("dataset_type"))), blank(F.try_element_at("__by_type", F.lit(""))), fn.slug(F.col("disease_category")), F.lit(""))
    parent = blank(fn.slug(F.col("parent_phenotype"))) if "parent_phenotype" in df.columns else F.lit(None).cast("string")
    out = found.withColumn("category", category)
    label = F.coalesce(F.when(~parent.rlike("^[0-9]+$"), parent), blank(F.col("category")), F.col("slug"))
    return out.withColumn("label", label).drop("__by_type")


def ancestry_points(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope, ancestry, variant, value): the frequency of the newest row of each variant and ancestry."""
    order = F.struct(F.unix_micros("ingested_at").alias("t"), F.col("row_key").alias("row"))
    return df.where("ancestry is not null and ancestry_af is not null").groupBy(*scope, "ancestry", "variant_id").agg(F.max_by("ancestry_af", order).alias("value"))


def variant_index(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """One row for each (scope, variant): labels, p-value and source of the best row, merged ancestry frequencies (the newest row's of
    each population), sources, files, phenotype keys and record count.

    `df` is read once and dealt once, by scope and variant: a first group by population too, so that repeats are folded before anything is gathered,
    then the groups of a variant lie together.
    """
    keys = [*scope, "variant_id"]
    key = F.nullif("phenotype_key", F.lit("")) if "phenotype_key" in df.columns else F.lit(None).cast("string")
    labels = ["variation_type", "clinical_significance", "most_severe_consequence"]
    rows = df.select(*keys, "source", "source_file", *labels, "p_value", "row_key", "ancestry", "ancestry_af", "ingested_at", key.alias("__key")).repartition(*[F.col(k) for k in keys])
    rank = F.struct(F.col("p_value").isNull(), "p_value", F.col("row_key").isNull(), "row_key")
    newest = F.when(F.col("ancestry").isNotNull() & F.col("ancestry_af").isNotNull(), F.struct(F.unix_micros("ingested_at"), "row_key"))
    each = rows.groupBy(*keys, "ancestry").agg(
        F.min_by(F.struct(*labels, "p_value", "source"), rank).alias("best"), F.min(rank).alias("rank"), F.max_by("ancestry_af", newest).alias("value"), F.count("*").alias("n"),
        F.collect_set("source").alias("s"), F.collect_set("source_file").alias("f"), F.collect_set("__key").alias("k"),
    )
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    people = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("ancestry", "value")))
    found = each.groupBy(*keys).agg(F.min_by("best", "rank").alias("b"), people.alias("people"), united("s").alias("sources"), united("f").alias("source_files"), united("k").alias("phenotype_keys"), F.sum("n").alias("record_count"))
    named = [fn.variation_label(F.col("b.variation_type")).alias("variation"), fn.significance_label(F.col("b.clinical_significance")).alias("significance"), fn.consequence_label(F.col("b.most_severe_consequence")).alias("consequence")]
    ancestry = F.when(F.size("people") > 0, F.map_from_entries(F.array_sort("people"))).alias("ancestry")
    return found.select(*keys, *named, "b.p_value", "b.source", ancestry, "sources", "source_files", "phenotype_keys", "record_count")


def provenance(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Sources, ancestry groups and codes, number of files and records of each scope."""
    return df.groupBy(*scope).agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_set("ancestry")).alias("groups"),
        F.array_sort(F.collect_set("ancestry_source_code")).alias("codes"), F.count_distinct("source_file").alias("source_file_count"), F.count("*").alias("record_count"),
    )


def merge_counters(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counters of two batches summed by name. Not variant-safe across batches; recompute instead where points are at hand."""
    return old.unionByName(new).groupBy(*keys).agg(F.sum("value").alias("value"))


def merge_ancestry(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ancestry points (keys, value) of two batches as one: where both have a point the new one's value counts."""
    both = old.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)))
    return both.groupBy(*keys).agg(F.max_by("value", "__batch").alias("value"))


def fold_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one record folded: smallest p, the first label that is not blank by row key, the ancestry map and the map of source codes to
    frequencies (the newest row's of each)."""
    first = lambda c: F.min_by(fn.clean_string(F.col(c)), F.when(fn.clean_string(F.col(c)).isNotNull(), F.col("row_key"))).alias(c)
    heads = df.groupBy(*keys).agg(F.min("p_value").alias("p_value"), *[first(c) for c, _ in AXES.values()], F.count_distinct("ancestry").alias("n_ancestries"))
    order = F.struct(F.unix_micros("ingested_at").alias("t"), F.col("row_key").alias("row"))
    for name, column in (("ancestry", "ancestry"), ("source_ancestry", "ancestry_source_code")):
        one = df.where(F.col(column).isNotNull() & F.col("ancestry_af").isNotNull()).groupBy(*keys, column).agg(F.max_by("ancestry_af", order).alias("value"))
        gathered = one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "value")))).alias(name))
        heads = heads.join(gathered, list(keys), "left")
    return heads


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def run_counters(df: DataFrame) -> DataFrame:
    """Rows seen, without gene, without p-value and emitted, in one pass."""
    gene = fn.is_gene(F.col("gene_id"))
    return df.agg(F.count("*").alias("seen"), F.count_if(~gene).alias("no_gene"), F.count_if(gene & F.col("p_value").isNull()).alias("no_p"), F.count_if(gene & F.col("p_value").isNotNull()).alias("emitted"))
