"""Source adapters: raw tables, all columns strings, to canonical records or association points; and the raw preparation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import records as rec
from allelix.schemas import CANONICAL, POINTS, conform

# Population columns of the wide layout, ancestry columns of the raw layout with their labels, columns of prepared files.
POPULATIONS = (
    "Total", "European", "African", "African Others", "African American", "Asian", "East Asian", "Other Asian", "Latin American 1",
    "Latin American 2", "South Asian", "Other",
)
RAW_ANCESTRIES = {
    "gnomad_genome.af.af": "Total", "gnomad_genome.af.af_afr": "African", "gnomad_genome.af.af_amr": "Admixed American", "gnomad_genome.af.af_asj": "Ashkenazi Jewish",
    "gnomad_genome.af.af_eas": "East Asian", "gnomad_genome.af.af_fin": "Finnish", "gnomad_genome.af.af_nfe": "European", "gnomad_genome.af.af_oth": "Other",
}
PREPARED = (
    "dataset_type", "source_name", "marker_id", "study_id", "study", "pmid", "study_genome_build", "rsid", "pval", "gene", "phenotype", "functional_class",
    "var_class", "clinical_significance", "most_severe_consequence", "allele_string", "protein_start", "protein_end", "ancestry_data",
)
RAW_PROFILE = {
    "marker_id": ("MarkerID",), "study": ("Study",), "pmid": ("PMID",), "study_genome_build": ("StudyGenomeBuild",), "rsid": ("dbsnp.rsid", "MarkerID"), "pval": ("pval",),
    "gene": ("snpeff.ann.gene_id",), "phenotype": ("Phenotype",), "functional_class": ("snpeff.ann.putative_impact",), "var_class": ("dbsnp.vartype",),
    "clinical_significance": ("clinvar.rcv.clinical_significance",), "most_severe_consequence": ("snpeff.ann.effect",), "allele_string": ("dbsnp.alleles.allele",),
}


def given(df: DataFrame, *names: str) -> Column:
    """The first of the columns that is there and not blank."""
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    return fn.first_given(*have) if have else F.lit(None).cast("string")


def resolved(df: DataFrame, mapping: DataFrame | None, default: str = "CVD") -> DataFrame:
    """`df` with mapped_type and mapped_category for its `phenotype` slug; without a map, or where it has none, the default type."""
    if mapping is None:
        return df.withColumns({"mapped_type": F.lit(default), "mapped_category": F.lit(None).cast("string")})
    found = df.join(rec.broadcast_if_few(mapping.select(F.col("slug").alias("__slug"), "mapped_type", "mapped_category")), F.col("phenotype") == F.col("__slug"), "left").drop("__slug")
    return found.withColumn("mapped_type", F.coalesce("mapped_type", F.lit(default)))


def _canonical(df: DataFrame, dataset_id: str, source: str, metadata: dict[str, Column]) -> DataFrame:
    rows = df.withColumns({"dataset_id": F.lit(dataset_id), "source": F.lit(source), "metadata": F.to_json(F.struct(*[v.alias(k) for k, v in metadata.items()]))})
    whole = F.col("gene_id").isNotNull() & F.col("variant_id").isNotNull() & F.col("phenotype").isNotNull()
    return conform(rows.where(whole), CANONICAL)


def _slugged(c: Column) -> Column:
    return F.nullif(fn.slug(c), F.lit(""))


def gwas(df: DataFrame, mapping: DataFrame | None = None, dataset_id: str = "gwas", dataset_type: str = "TRAIT", source: str = "gwas") -> DataFrame:
    """Association rows: variant from rsId, else the marker up to the first hyphen; the p-value from pval, else p_value."""
    rows = df.select(
        "*", given(df, "gene", "gene_name", "gene_id").alias("__gene"), F.coalesce(given(df, "rsId"), F.split_part(given(df, "MarkerID"), F.lit("-"), F.lit(1))).alias("__variant"),
        _slugged(given(df, "Phenotype", "phenotype")).alias("__phenotype"), fn.to_float(given(df, "pval", "p_value")).alias("__p"), given(df, "PMID", "pmid").alias("__pmid"),
    )
    rows = rows.drop("gene_id", "variant_id", "phenotype", "p_value", "pmid").withColumnsRenamed({"__gene": "gene_id", "__variant": "variant_id", "__phenotype": "phenotype", "__p": "p_value", "__pmid": "pmid"})
    rows = resolved(rows, mapping, dataset_type).withColumns({"dataset_type": F.upper("mapped_type"), "disease_category": F.col("mapped_category")})
    return _canonical(rows, dataset_id, source, {"marker_id": given(df, "MarkerID"), "study": given(df, "Study"), "source_file": given(df, "source_file")})


def wide_populations(df: DataFrame, mapping: DataFrame | None = None, dataset_id: str = "ensembl", source: str = "ensembl", types: Sequence[str] = ()) -> DataFrame:
    """Variant rows with a column for each population: frequencies that are there become the ancestry map, else MAF counts as Total. The
    dataset type follows from the file's path, else from the map."""
    people = F.map_filter(F.map_from_arrays(F.array(*[F.lit(p) for p in POPULATIONS]), F.array(*[given(df, p) for p in POPULATIONS])), lambda _, v: v.isNotNull())
    maf = given(df, "MAF")
    ancestry = F.when(F.size(people) > 0, people).when(maf.isNotNull(), F.create_map(F.lit("Total"), maf)).otherwise(F.create_map().cast("map<string,string>"))
    new = {
        "gene_id": given(df, "Gene.symbol", "Gene.id"), "variant_id": given(df, "rsID", "variation_id"), "phenotype": _slugged(given(df, "diseases_associated", "phenotype")),
        "variation_type": given(df, "var_class"), "clinical_significance": given(df, "clinical_significance"), "most_severe_consequence": given(df, "most_severe_consequence"),
        "p_value": fn.to_float(given(df, "adj.P.Val")), "pmid": given(df, "pmid"), "ancestry": ancestry, "source_path": given(df, "source_file"),
        **{f"m_{c}": given(df, c) for c in ("allele_string", "protein_start", "protein_end", "location", "source", "description")},
    }
    rows = resolved(df.select(*[c.alias(n) for n, c in new.items()]), mapping)
    rows = rows.withColumns({"dataset_type": fn.dataset_type_of(F.coalesce("source_path", F.lit("")), F.col("mapped_type")), "disease_category": F.col("mapped_category")})
    names = {"allele_string": "m_allele_string", "protein_start": "m_protein_start", "protein_end": "m_protein_end", "location": "m_location", "source_note": "m_source", "description": "m_description", "source_file": "source_path"}
    return rec.of_types(_canonical(rows, dataset_id, source, {k: F.col(v) for k, v in names.items()}), types)


def clinical(df: DataFrame, mapping: DataFrame | None = None, dataset_id: str = "clinvar", source: str = "clinvar", types: Sequence[str] = ()) -> DataFrame:
    """Clinical variant rows of both layouts in one: alternative columns are coalesced, a list of phenotypes becomes rows."""
    new = {
        "gene_id": given(df, "primary_gene", "Gene Name"), "variant_id": given(df, "rsID", "Variant ID"), "phenotype": F.explode(fn.phenotype_list(given(df, "phenotype", "Subject Phenotype"))),
        "variation_type": given(df, "var_class", "Variant Call type"), "clinical_significance": given(df, "mutation", "Clinical Interpretation"), "most_severe_consequence": given(df, "most_severe_consequence"),
        "source_path": given(df, "source_file"), "m_location": given(df, "location", "Chromosome"),
    }
    rows = resolved(df.select(*[c.alias(n) for n, c in new.items()]).withColumn("phenotype", _slugged(F.col("phenotype"))), mapping)
    rows = rows.withColumns({"dataset_type": fn.dataset_type_of(F.coalesce("source_path", F.lit("")), F.col("mapped_type")), "disease_category": F.col("mapped_category"), "ancestry": F.create_map().cast("map<string,string>")})
    return rec.of_types(_canonical(rows, dataset_id, source, {"location": F.col("m_location"), "source_file": F.col("source_path")}), types)


def prepared_records(df: DataFrame, mapping: DataFrame | None = None, dataset_id: str = "legacy", source: str = "legacy_csv", types: Sequence[str] = ()) -> DataFrame:
    """Prepared association files: genes must look like genes, the ancestry column is JSON."""
    own = ("", "nan", "none", "null")
    text = lambda n: fn.clean_string(F.col(n), own) if n in df.columns else F.lit(None).cast("string")
    new = {
        "gene_id": text("gene"), "variant_id": text("rsid"), "phenotype": _slugged(text("phenotype")), "variation_type": text("var_class"), "clinical_significance": text("clinical_significance"),
        "most_severe_consequence": text("most_severe_consequence"), "p_value": fn.to_float(text("pval")), "pmid": text("pmid"),
        "ancestry": F.coalesce(fn.parse_ancestry(text("ancestry_data")), F.create_map().cast("map<string,string>")), "m_class": text("functional_class"), "m_file": text("source_file"),
    }
    rows = resolved(df.select(*[c.alias(n) for n, c in new.items()]), mapping).where(fn.is_gene(F.col("gene_id")))
    rows = rows.withColumns({"dataset_type": F.upper("mapped_type"), "disease_category": F.col("mapped_category")})
    return rec.of_types(_canonical(rows, dataset_id, source, {"functional_class": F.col("m_class"), "source_file": F.col("m_file")}), types)


STATISTICS = {
    "or": fn.to_float, "ci": lambda c: F.to_json(fn.parse_ci(c)), "q_pval": fn.to_float, "r2": fn.to_float, "i2": fn.to_float, "direction": fn.clean_string,
    "num_samples": fn.to_int, "num_cases": fn.to_int, "num_controls": fn.to_int, "case_af": fn.to_float, "control_af": fn.to_float,
}


def long_rows(df: DataFrame, mapping: DataFrame | None = None, overrides: dict | None = None) -> DataFrame:
    """Rows of the long layout (one for each ancestry) with typed columns: keys, ancestry group and label, frequency and statistics."""
    parent, code = given(df, "parent_phenotype"), given(df, "ancestry")
    new = {
        "gene_id": given(df, "gene_symbol"), "variant_id": given(df, "SNP_ID"), "phenotype": _slugged(given(df, "phenotype_description")), "description": given(df, "phenotype_description"),
        "phenotype_key": given(df, "phenotype_key"), "parent_phenotype": parent, "is_sub_phenotype": fn.to_bool(given(df, "is_sub_phenotype")), "chrom": given(df, "chrom"), "pos": fn.to_int(given(df, "pos")),
        "ref": given(df, "ref"), "alt": given(df, "alt"), "effect_allele": given(df, "ea"), "p_value": fn.to_float(given(df, "pval")), "af": fn.to_float(given(df, "af")),
        "code": fn.ancestry_code(code), "group": fn.ancestry_group(code, overrides), "label": fn.ancestry_label(code, overrides), "source_file": given(df, "source_file"),
        **{f"s_{n}": f(given(df, n)) for n, f in STATISTICS.items()},
    }
    rows = resolved(df.select(*[c.alias(n) for n, c in new.items()]), mapping)
    kind = F.upper("mapped_type")
    slug = fn.slug(F.col("parent_phenotype"))
    rows = rows.withColumns({"dataset_type": F.when(kind.isin("CVD", "TRAIT"), kind).otherwise("CVD"), "disease_category": F.coalesce(F.nullif("mapped_category", F.lit("")), F.when((slug != "") & ~slug.rlike("^[0-9]+$"), slug))})
    return rows.where("gene_id is not null and variant_id is not null and phenotype is not null").drop("mapped_type", "mapped_category")


LONG_KEY = ("source_file", "dataset_type", "gene_id", "variant_id", "merge_key")


def one_per_ancestry(rows: DataFrame) -> DataFrame:
    """`long_rows` with merge_key (phenotype key, else phenotype), cut to one row for each key and ancestry: the smallest p-value, then the first
    by its statistics. Cutting twice, or parts first and then their union, gives the same rows."""
    keyed = rows.withColumn("merge_key", F.coalesce("phenotype_key", "phenotype"))
    return keyed.withColumn("__n", F.row_number().over(Window.partitionBy(*LONG_KEY, "group").orderBy(*_long_order(keyed)))).where("__n = 1").drop("__n")


def _long_order(rows: DataFrame) -> list[Column]:
    return [F.col("p_value").asc_nulls_last(), F.xxhash64(*sorted(c for c in rows.columns if c not in ("source_file", "merge_key", "__n")))]


def merged_long(rows: DataFrame, dataset_id: str = "mvp", source: str = "million_veteran_program") -> DataFrame:
    """Canonical records of `long_rows`: one for each file, type, gene, variant and phenotype, with the ancestry map, each ancestry's
    statistics and those of the row with the smallest p-value.

    Of several rows of one ancestry the one with the smallest p-value counts, then the first by its statistics. Rows are first cut to
    one for each ancestry, so a group gathers at most as many as there are ancestries.
    """
    key, one = list(LONG_KEY), one_per_ancestry(rows)
    order = _long_order(one)
    stats = [F.col(f"s_{n}").alias(n) for n in STATISTICS]
    each = F.struct(F.col("group").alias("key"), F.struct("af", *stats, F.col("code").alias("source_ancestry_code"), F.col("label").alias("source_ancestry_label"), F.col("group").alias("canonical_ancestry_group")).alias("value"))
    best = ["phenotype", "disease_category", "p_value", "chrom", "pos", "ref", "alt", "effect_allele", "phenotype_key", "description", "parent_phenotype", "is_sub_phenotype", *[f"s_{n}" for n in STATISTICS]]
    ranked = one.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    gathered = ranked.groupBy(*key).agg(
        F.max(F.when(F.col("__n") == 1, F.struct(*best))).alias("b"), F.array_sort(F.collect_list(F.when(F.col("group").isNotNull(), each))).alias("people"),
    )
    b = lambda c: F.col(f"b.`{c}`")
    with_af = F.filter("people", lambda p: p.value.af.isNotNull())
    metadata = {
        "chrom": b("chrom"), "pos": b("pos"), "ref": b("ref"), "alt": b("alt"), "effect_allele": b("effect_allele"), "allele_string": fn.allele_string(b("ref"), b("alt")), "phenotype_key": b("phenotype_key"),
        "phenotype_description": b("description"), "parent_phenotype": b("parent_phenotype"), "is_sub_phenotype": b("is_sub_phenotype"), "source_file": F.col("source_file"),
        "by_ancestry": F.map_from_entries("people"), **{f"best_{n}": b(f"s_{n}") for n in STATISTICS},
    }
    out = gathered.select(
        "*", b("phenotype").alias("phenotype"), b("disease_category").alias("disease_category"), fn.infer_variation(b("ref"), b("alt")).alias("variation_type"), b("p_value").alias("p_value"),
        F.map_from_entries(F.transform(with_af, lambda p: F.struct(p.key, p.value.af.cast("string").alias("value")))).alias("ancestry"),
    )
    return _canonical(out, dataset_id, source, metadata)


def long_points(rows: DataFrame, dataset_id: str = "mvp", source: str = "million_veteran_program", types: Sequence[str] = (), ingested_at: Column | None = None) -> DataFrame:
    """Association points of `long_rows`: one for each key, ancestry and file with the smallest p-value, frequency and key."""
    kept = rec.of_types(rows.where(fn.is_gene(F.col("gene_id"))), types)
    typed = kept.select(
        "source_file", "dataset_type", "gene_id", "variant_id", "phenotype", F.coalesce("disease_category", F.lit("")).alias("disease_category"), fn.infer_variation(F.col("ref"), F.col("alt")).alias("variation_type"),
        F.col("group").alias("ancestry"), F.col("code").alias("ancestry_source_code"), F.col("label").alias("ancestry_source_label"), "p_value", "af", "phenotype_key",
    )
    keys = [c for c in typed.columns if c not in ("p_value", "af", "phenotype_key")]
    least = typed.groupBy(*keys).agg(F.min("p_value").alias("p_value"), F.min("af").alias("ancestry_af"), F.min("phenotype_key").alias("phenotype_key"))
    return conform(least.withColumns({"dataset_id": F.lit(dataset_id), "source": F.lit(source), "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at}), POINTS)


def raw_points(df: DataFrame, dataset_type: str, mapping: DataFrame | None = None, dataset_id: str = "legacy", source: str = "legacy_raw", ingested_at: Column | None = None) -> DataFrame:
    """Association points of the raw wide layout: one row for each ancestry column, null or not, one more where all are null, then the
    smallest value of each field for each key, ancestry and file. Rows are folded by key and file first, so what is unpivoted are groups."""
    kind = F.trim(F.coalesce(given(df, "dbsnp.vartype"), F.lit("")))
    new = {
        "variant_id": F.trim(F.coalesce(*[F.col(f"`{c}`") for c in ("dbsnp.rsid", "MarkerID") if c in df.columns])), "gene_id": F.trim(given(df, "snpeff.ann.gene_id")), "phenotype": _slugged(given(df, "Phenotype")),
        "variation_type": F.when(F.upper(kind) == "SNP", "SNP").when(kind != "", kind), "clinical_significance": given(df, "clinvar.rcv.clinical_significance"), "most_severe_consequence": given(df, "snpeff.ann.effect"),
        "p_value": fn.to_float(given(df, "pval")), "source_file": given(df, "source_file"), **{f"af_{i}": fn.to_float(given(df, c)) for i, c in enumerate(RAW_ANCESTRIES)},
    }
    rows = df.select(*[c.alias(n) for n, c in new.items()]).where(fn.is_gene(F.col("gene_id")) & (F.col("variant_id") != "") & F.col("phenotype").isNotNull())
    own = None if mapping is None else mapping.where(F.upper("mapped_type") == dataset_type.upper())
    rows = resolved(rows, own).withColumn("disease_category", F.nullif("mapped_category", F.lit(""))).drop("mapped_type", "mapped_category")
    key, own = ["source_file", "gene_id", "variant_id", "phenotype"], ["disease_category", "variation_type", "clinical_significance", "most_severe_consequence", "p_value"]
    af = [f"af_{i}" for i in range(len(RAW_ANCESTRIES))]
    rows = rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in own[1:4]} | {"__bare": F.coalesce(*af).isNull()})
    bare = [F.min(F.when(F.col("__bare"), F.col(c))).alias(f"__bare_{c}") for c in own]
    folded = rows.groupBy(*key).agg(*[F.min(c).alias(c) for c in (*own, *af)], F.bool_or("__bare").alias("__bare"), *bare)
    each = F.array(*[F.struct(F.lit(label).alias("ancestry"), F.col(f"af_{i}").alias("ancestry_af"), F.lit(False).alias("bare")) for i, label in enumerate(RAW_ANCESTRIES.values())])
    alone = F.array(F.struct(F.lit(None).cast("string").alias("ancestry"), F.lit(None).cast("double").alias("ancestry_af"), F.lit(True).alias("bare")))
    long = folded.withColumn("__x", F.explode(F.when(F.col("__bare"), F.concat(each, alone)).otherwise(each)))
    least = long.select(*key, "__x.ancestry", "__x.ancestry_af", *[F.when(F.col("__x.bare"), F.col(f"__bare_{c}")).otherwise(F.col(c)).alias(c) for c in own])
    least = least.withColumn("disease_category", F.coalesce("disease_category", F.lit("")))
    fixed = {"dataset_id": F.lit(dataset_id), "source": F.lit(source), "dataset_type": F.lit(dataset_type.upper()), "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at}
    return conform(least.withColumns(fixed), POINTS)


def prepared(df: DataFrame, dataset_type: str, source_name: str, profile: dict[str, Sequence[str]] | None = None, ancestries: dict[str, str] | None = None, defaults: dict[str, str] | None = None, digits: int | None = None) -> DataFrame:
    """Raw association rows in the prepared layout: candidate columns by profile, derived rsID, ancestry as JSON. Rows without rsID, gene or
    phenotype are dropped; missing fields are empty."""
    fields, fallback = profile or RAW_PROFILE, defaults or {}
    pick = lambda name: F.coalesce(given(df, *fields.get(name, ())), F.lit(fallback.get(name)))
    marker = pick("marker_id")
    out = {name: pick(name) for name in PREPARED}
    out |= {"dataset_type": F.lit(dataset_type), "source_name": F.lit(source_name), "rsid": fn.derive_rsid(pick("rsid"), marker), "pval": fn.to_float(pick("pval")).cast("string")}
    out["var_class"] = F.when(F.lower(out["var_class"]) == "snp", "SNP").otherwise(out["var_class"])
    have = {label: F.col(f"`{c}`") for c, label in (ancestries or RAW_ANCESTRIES).items() if c in df.columns}
    out["ancestry_data"] = fn.ancestry_json(have, out["allele_string"], digits) if have else F.lit("{}")
    rows = df.select(*[c.alias(f"__{n}") for n, c in out.items()]).where("__rsid is not null and __gene is not null and __phenotype is not null")
    return rows.select(*[F.coalesce(f"__{n}", F.lit("")).alias(n) for n in PREPARED])


BEST = ("or", "ci", "q_pval", "r2", "i2", "direction", "num_samples", "num_cases", "num_controls", "case_af", "control_af")


def prepared_export(records: DataFrame, change: Column | None = None) -> DataFrame:
    """Canonical records of the long layout as prepared rows with the best statistics, all columns strings, missing ones empty."""
    meta = lambda k: F.get_json_object("metadata", f"$.{k}")
    people = F.transform(F.array_sort(F.map_entries("ancestry")), lambda e: F.struct(e.key, F.struct(F.coalesce(meta("allele_string"), F.lit("")).alias("change"), e.value.cast("double").alias("MAF")).alias("value")))
    nothing = F.lit("")
    out = {
        "rsid": F.col("variant_id"), "pval": F.col("p_value").cast("string"), "gene": F.col("gene_id"), "phenotype": F.col("phenotype"), "functional_class": nothing, "var_class": F.col("variation_type"),
        "clinical_significance": F.col("clinical_significance"), "most_severe_consequence": F.col("most_severe_consequence"), "allele_string": meta("allele_string"), "protein_start": nothing,
        "protein_end": nothing, "ancestry_data": F.to_json(F.map_from_entries(people)), **{f"mvp_{k}": meta(k) for k in ("phenotype_key", "parent_phenotype", "is_sub_phenotype")},
        **{f"mvp_best_{n}": meta(f"best_{n}") for n in BEST}, "source": F.col("source"),
    }
    return records.select(*[F.coalesce(c, nothing).alias(n) for n, c in out.items()])


def structural_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Structural-variant rows with chromosome, start and end in order, type, phenotypes, significance and assembly. Rows without id, study or
    place are dropped. A byte-order mark before the first column's name is taken off."""
    clean = df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})
    own = (*fn.NULL_TOKENS, "n/a")
    text = lambda *ns: F.coalesce(*[fn.clean_string(F.col(f"`{n}`"), own) for n in ns if n in clean.columns], F.lit(None).cast("string"))
    place = lambda *ns: F.coalesce(*[fn.to_int(F.col(f"`{n}`")) for n in ns if n in clean.columns], F.lit(None).cast("bigint"))
    a, b = place("Inner Start", "Start", "Outer Start"), place("Inner End", "End", "Outer End")
    rows = clean.select(
        text("Variant ID").alias("variant_id"), text("Study ID").alias("study_id"), fn.chromosome(text("Chromosome")).alias("chrom"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"),
        F.when(a.isNotNull() & b.isNotNull(), True).alias("__placed"), fn.variant_type(text("Variant Call type"), text("Variant Region type")).alias("variant_type"),
        F.coalesce(fn.phenotype_list(text("Subject Phenotype")), F.array().cast("array<string>")).alias("phenotypes"), text("Clinical Interpretation").alias("clinical_significance"),
        text("Assembly Name").alias("assembly_name"), given(clean, "source_file").alias("source_file"), *keep,
    )
    return rows.where("variant_id is not null and study_id is not null and chrom is not null and __placed").drop("__placed")


def structural_records(df: DataFrame, dataset_id: str = "dbvar", source: str = "dbvar", dataset_type: str = "STRUCTURAL_VARIANT", genes: str = "gene_id") -> DataFrame:
    """Canonical records of structural-variant rows that name a gene: one for each phenotype, the place and assembly in the metadata.

    Rows without the column `genes`, or with a null in it, have no record: their genes come from the overlap (`structural.build`).
    """
    rows = structural_rows(df.withColumn("__gene", given(df, genes)), keep=("__gene",)).where("__gene is not null and size(phenotypes) > 0")
    rows = rows.select("*", F.col("__gene").alias("gene_id"), F.explode("phenotypes").alias("__p")).withColumns({"phenotype": _slugged(F.col("__p")), "variation_type": F.col("variant_type"), "dataset_type": F.lit(dataset_type), "ancestry": F.create_map().cast("map<string,string>")})
    return _canonical(rows, dataset_id, source, {n: F.col(n) for n in ("study_id", "chrom", "start", "end", "assembly_name", "source_file")})


def source_normalised(df: DataFrame, source_id: str, release_id: str) -> DataFrame:
    """Prepared rows as the source-normalised table: all fields trimmed, blanks instead of nulls, and a row id from source, release and the
    row's content, with a number for repeats, so that a rerun gives the same ids."""
    text = lambda *ns: F.trim(F.coalesce(*[F.col(f"`{n}`") for n in ns if n in df.columns], F.lit("")))
    plain = ("source_name", "marker_id", "study_id", "study", "pmid", "study_genome_build")
    late = ("functional_class", "clinical_significance", "most_severe_consequence", "allele_string", "protein_start", "protein_end")
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    rows = df.select(
        F.lit(source_id).alias("source_id"), F.lit(release_id).alias("release_id"), text("source_file").alias("source_file"), F.upper(text("dataset_type")).alias("dataset_type"), *[text(c).alias(c) for c in plain],
        text("rsid", "marker_id").alias("variant_id"), text("gene").alias("gene_id"), text("phenotype").alias("phenotype"), fn.to_float(text("pval")).alias("p_value"), text("var_class").alias("variation_type"),
        *[text(c).alias(c) for c in late], F.coalesce(F.nullif(text("ancestry_data"), F.lit("")), F.lit("{}")).alias("ancestry_data_json"), F.lit("{}").alias("raw_payload_json"), F.lit("{}").alias("metadata_json"), content.alias("__sha"),
    )
    number = F.row_number().over(Window.partitionBy("source_file", "__sha").orderBy(F.lit(1)))
    return rows.withColumn("source_row_id", F.concat_ws(":", "source_id", "release_id", "__sha", number.cast("string"))).drop("__sha")


#: Adapters by name: (raw table, phenotype map, further arguments) to canonical records. Users add their own.
ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "gwas": gwas, "ensembl": wide_populations, "clinvar": clinical, "legacy_csv": prepared_records, "mvp": lambda df, mapping=None, **more: merged_long(long_rows(df, mapping), **more),
    "dbvar": lambda df, mapping=None, **more: structural_records(df, **more),
}


def ingest(spark: SparkSession, sources: Sequence[dict], mapping: DataFrame | None = None, read: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Records of all configured sources, one after the other: {"adapter", "paths", "delimiter", "params"}; nothing is de-duplicated."""
    from allelix.sources.files import sniffed

    out = None
    for source in sources:
        name = source["adapter"]
        if name not in ADAPTERS:
            raise KeyError(f"no adapter {name!r}; there are {', '.join(sorted(ADAPTERS))}")
        table = (read or sniffed)(spark, source["paths"], source.get("delimiter", "auto"))
        part = ADAPTERS[name](table, mapping, **source.get("params", {}))
        out = part if out is None else out.unionByName(part)
    return out
