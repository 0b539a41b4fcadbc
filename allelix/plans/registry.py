"""All registered queries of the library's own operators, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import aggregates as ag
from allelix.operators import catalog as cat
from allelix.operators import intervals as iv
from allelix.operators import records as rec
from allelix.plans import filed, jobs, stored
from allelix.plans.points import INTERVALS_SQL, PRIORITY, SQL, TRANSCRIPT_SQL, intervals, points, read, transcripts
from allelix.plans.sqltext import BEST as _BEST
from allelix.plans.sqltext import G1 as _G1
from allelix.plans.sqltext import GENE as _GENE
from allelix.plans.sqltext import axes as _axes
from allelix.plans.sqltext import clean as _clean
from allelix.plans.sqltext import consequence as _consequence
from allelix.plans.sqltext import g1 as _g1
from allelix.plans.sqltext import label as _label
from allelix.plans.sqltext import number as _number
from allelix.plans.sqltext import significance as _significance
from allelix.plans.sqltext import slug as _slug
from allelix.plans.sqltext import strip as _strip
from allelix.plans.sqltext import unknown as _unknown
from allelix.plans.sqltext import variation as _variation

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None = None) -> None:
    _QUERIES[name] = query
    if sql:
        _SQL[name] = sql


def queries() -> dict[str, Query]:
    return _QUERIES | jobs.QUERIES | stored.QUERIES | filed.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | jobs.ORACLES | stored.ORACLES | filed.ORACLES


def _scalar(name: str, column: Callable[[], Column], sql: str) -> None:
    _add(name, lambda s, d: points(s, d).select("row_key", column().alias("value")), f"{SQL} SELECT row_key, {sql} AS value FROM points")


c = F.col
_scalar("C1_clean_string", lambda: fn.clean_string(c("messy")), _clean("messy"))
_scalar("C1_clean_string_dbvar", lambda: fn.clean_string(c("messy"), (*fn.NULL_TOKENS, "n/a")), _clean("messy", ", 'n/a'"))
_scalar("C2_to_float", lambda: fn.to_float(c("number_text")), _number("number_text"))
_scalar("C3_to_int", lambda: fn.to_int(c("number_text")), f"cast(trunc({_number('number_text')}) AS bigint)")
_scalar("C4_to_bool", lambda: fn.to_bool(c("flag_text")), f"CASE WHEN lower({_strip('flag_text')}) IN ('true', '1', 'yes') THEN true WHEN lower({_strip('flag_text')}) IN ('false', '0', 'no') THEN false END")
_add(
    "C5_parse_ci",
    lambda s, d: points(s, d).select("row_key", fn.parse_ci(c("ci_text")).alias("x")).select("row_key", "x.*"),
    f"{SQL} SELECT row_key, CASE WHEN ci_text LIKE '%,%' THEN try_cast(split_part(ci_text, ',', 1) AS double) END AS lower, CASE WHEN ci_text LIKE '%,%' THEN try_cast(trim(split_part(ci_text, ',', 2)) AS double) END AS upper, CASE WHEN ci_text NOT LIKE '%,%' THEN ci_text END AS raw FROM points",
)
_scalar("C6_slug", lambda: fn.slug(c("messy")), _slug("messy"))
_scalar("C7_text_label", lambda: fn.text_label(c("messy")), _label("messy"))
_scalar("C8_is_unknown", lambda: fn.is_unknown(c("messy")), _unknown("messy"))
_scalar("C9_variation_label", lambda: fn.variation_label(c("variation_type")), _variation("variation_type"))
_scalar("C10_consequence_label", lambda: fn.consequence_label(c("most_severe_consequence")), _consequence("most_severe_consequence"))
_scalar("C11_significance_label", lambda: fn.significance_label(c("clinical_significance")), _significance("clinical_significance"))
_scalar("C12_axis_label", lambda: fn.axis_label(c("messy"), "other"), f"CASE WHEN NOT {_unknown('messy')} THEN {_label('messy')} END")
_scalar("C13_is_gene", lambda: fn.is_gene(c("gene_id")), _GENE)
_ANC = "CASE upper(trim(code_text)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fn.ANCESTRIES.items()) + " ELSE upper(trim(code_text)) END"
_scalar("C14_ancestry_group", lambda: fn.ancestry_group(c("code_text")), _ANC)
_scalar("C14_ancestry_label", lambda: fn.ancestry_label(c("code_text"), {"XYZ": ("Source X", "Group X"), "SAS": "S. Asian"}), f"CASE upper(trim(code_text)) WHEN 'XYZ' THEN 'Source X' WHEN 'SAS' THEN 'S. Asian' ELSE {_ANC} END")
_scalar("C14_ancestry_group_override", lambda: fn.ancestry_group(c("code_text"), {"XYZ": ("Source X", "Group X"), "SAS": "S. Asian"}), f"CASE upper(trim(code_text)) WHEN 'XYZ' THEN 'Group X' WHEN 'SAS' THEN 'S. Asian' ELSE {_ANC} END")
_REF, _ALT = _clean("ref"), _clean("alt")
_scalar("C15_infer_variation", lambda: fn.infer_variation(c("ref"), c("alt")), f"CASE WHEN {_REF} IS NOT NULL AND {_ALT} IS NOT NULL THEN CASE WHEN length({_REF}) = 1 AND length({_ALT}) = 1 THEN 'SNP' ELSE 'INDEL' END END")
_scalar("C16_allele_string", lambda: fn.allele_string(c("ref"), c("alt")), f"{_REF} || '/' || {_ALT}")
_scalar(
    "C17_derive_rsid",
    lambda: fn.derive_rsid(c("alt"), c("marker")),
    f"coalesce({_ALT}, CASE WHEN {_clean('marker')} IS NOT NULL THEN CASE WHEN starts_with({_strip('marker')}, 'rs') THEN {_strip('marker')} ELSE split_part({_strip('marker')}, '-', 1) END END)",
)
_scalar("C17_rsid_of_marker", lambda: fn.derive_rsid(F.lit(None).cast("string"), c("marker")), f"CASE WHEN {_clean('marker')} IS NOT NULL THEN CASE WHEN starts_with({_strip('marker')}, 'rs') THEN {_strip('marker')} ELSE split_part({_strip('marker')}, '-', 1) END END")
_scalar("C18_dataset_type_of", lambda: fn.dataset_type_of(c("source"), c("dataset_type")), "CASE WHEN upper(source) LIKE '%TRAIT%' THEN 'TRAIT' WHEN upper(source) LIKE '%CVD%' THEN 'CVD' ELSE dataset_type END")
_CHROM = f"regexp_replace({_strip('chrom_text')}, '^chr', '', 'i')"
_scalar("C19_chromosome", lambda: fn.chromosome(c("chrom_text")), f"coalesce(cast(try_cast({_CHROM} AS bigint) AS varchar), {_CHROM})")
_scalar("C20_first_coordinate", lambda: fn.first_coordinate(c("number_text"), c("chrom_text")), f"coalesce(cast(trunc({_number('number_text')}) AS bigint), cast(trunc({_number('chrom_text')}) AS bigint))")
_scalar("C20_region", lambda: fn.region(fn.to_int(c("number_text")), F.lit(99)), f"concat_ws('-', cast(cast(trunc({_number('number_text')}) AS bigint) AS varchar), '99')")
_scalar("C21_without_version", lambda: fn.without_version(c("number_text")), "split_part(trim(number_text), '.', 1)")
_scalar("C23_phenotype_list", lambda: F.array_join(fn.phenotype_list(c("list_text")), "|"), "CASE WHEN phenotype = (SELECT trim(string_split(list_text, ';')[2])) THEN phenotype ELSE phenotype || '|' || trim(string_split(list_text, ';')[2]) END")
_scalar("C24_variant_type", lambda: fn.variant_type(c("variation_type"), c("messy")), f"lower(coalesce({_clean('variation_type')}, {_clean('messy')}))")
_scalar("C25_identity_interval", lambda: F.get(fn.identity_interval(c("variant_id")), F.lit(1)), "cast(cast('0x' || substr(sha1(variant_id), 1, 12) AS bigint) AS double)")
_add(
    "C26_round_ancestry",
    lambda s, d: points(s, d).select("row_key", fn.to_float(fn.round_ancestry(F.sqrt("ancestry_af"), 4)).alias("value"), F.when(fn.to_float(c("number_text")).isNull(), fn.round_ancestry(c("number_text"), 1)).alias("kept")),
    f"{SQL} SELECT row_key, round(sqrt(ancestry_af), 4) AS value, CASE WHEN ({_number('number_text')}) IS NULL THEN number_text END AS kept FROM points",
)
_scalar("C27_safe_gene", lambda: fn.safe_gene(c("messy")), "replace(messy, '/', '-')")
_scalar("C27_encoded_gene", lambda: fn.encoded_gene(c("messy")), f"url_encode({_strip('messy')})")
_scalar(
    "C28_parse_ancestry",
    lambda: F.array_join(F.transform(F.array_sort(F.map_entries(fn.parse_ancestry(c("ancestry_text")))), lambda e: F.concat_ws("=", e.key, e.value)), ";"),
    "concat('African=', json_extract_string(ancestry_text, '$.African'), ';European=', json_extract_string(ancestry_text, '$.European.MAF'), ';Other=', json_extract_string(ancestry_text, '$.Other.value'))",
)
_C29 = lambda: fn.ancestry_json({"African": c("ancestry_af"), "Total": c("number_text")}, fn.allele_string(c("ref"), c("alt")))
_add(
    "C29_ancestry_json",
    lambda s, d: points(s, d).select("row_key", _C29().alias("j")).select("row_key", *[F.get_json_object("j", f"$.{k}.{f}").alias(f"{k}_{f}".lower()) for k, f in (("African", "change"), ("Total", "change"))], *[fn.to_float(F.get_json_object("j", f"$.{k}.MAF")).alias(f"{k}_maf".lower()) for k in ("African", "Total")]),
    f"{SQL} SELECT row_key, CASE WHEN ancestry_af IS NOT NULL THEN coalesce({_REF} || '/' || {_ALT}, '') END AS african_change, CASE WHEN ({_number('number_text')}) IS NOT NULL THEN coalesce({_REF} || '/' || {_ALT}, '') END AS total_change, ancestry_af AS african_maf, {_number('number_text')} AS total_maf FROM points",
)
_scalar("C30_candidate_pick", lambda: fn.first_given(c("messy"), c("alt"), default="none given"), f"coalesce({_clean('messy')}, {_ALT}, 'none given')")
_scalar("C31_source_rank", lambda: fn.source_rank(c("source"), PRIORITY[:2]), "CASE source WHEN 'million_veteran_program' THEN 0 WHEN 'legacy_cvd_raw' THEN 1 ELSE 999999 END")
_scalar("C32_disease_category", lambda: fn.disease_category(F.lit(""), c("number_text")), f"CASE WHEN try_cast({_strip('number_text')} AS double) IS NULL THEN {_slug('number_text')} END")
_KIND = "CASE " + " ".join(f"WHEN {x} THEN '{n}'" for n, ws in fn.FEATURE_CLASSES for x in ["(" + " OR ".join([f"contains(t, '{w}')" for w in ws] + {"exons": ["t = 'exon'", "src = 'ensembl_translation_exon'"], "domains": ["src = 'interpro'"]}.get(n, [])) + ")"]) + " ELSE 'other_features' END"
_FEATURE = {
    "word": "CASE p_size % 12 WHEN 0 THEN 'Exon' WHEN 1 THEN 'translation_exon 4' WHEN 2 THEN 'Transmembrane helix' WHEN 3 THEN 'Compositional bias' WHEN 4 THEN 'disordered' WHEN 5 THEN 'Zinc finger domain' WHEN 6 THEN 'Tandem repeat' WHEN 7 THEN 'Binding site' WHEN 8 THEN 'Motif' WHEN 9 THEN 'Topological domain' ELSE p_name END",
    "src": "CASE p_partkey % 9 WHEN 0 THEN 'interpro' WHEN 1 THEN 'ensembl_translation_exon' ELSE 'ebi_proteins' END",
}
_add(
    "C38_feature_category",
    lambda s, d: read(s, d, "part").selectExpr("p_partkey", *[f"{e} AS {n}" for n, e in _FEATURE.items()]).select("p_partkey", fn.feature_category(c("word"), c("src")).alias("category")),
    f"WITH f AS (SELECT p_partkey, lower({_FEATURE['word']}) AS t, {_FEATURE['src']} AS src FROM part) SELECT p_partkey, {_KIND} AS category FROM f",
)
_XREF = "CASE p_size % 5 WHEN 0 THEN concat('NM_', cast(p_partkey AS varchar(20)), '.2') WHEN 1 THEN 'P12A45-2' WHEN 2 THEN 'Q9H0H5' WHEN 3 THEN 'A0A1' ELSE 'ENST01' END"
_XDB = "CASE p_partkey % 3 WHEN 0 THEN 'RefSeq_mRNA' WHEN 1 THEN 'Uniprot/SWISSPROT' END"
_add(
    "C39_xref_kinds",
    lambda s, d: read(s, d, "part").selectExpr("p_partkey", f"{_XREF} AS x", f"{_XDB} AS db").select("p_partkey", F.array_join(fn.xref_kinds(c("db"), c("x")), ",").alias("kinds")),
    f"WITH f AS (SELECT p_partkey, {_XREF} AS x, {_XDB} AS db FROM part) SELECT p_partkey, concat_ws(',', CASE WHEN contains(lower(db), 'refseq') OR regexp_matches(x, '^(NM_|NP_|XM_|XP_)') THEN 'refseq' END, CASE WHEN contains(lower(db), 'uniprot') OR regexp_matches(x, '^[OPQ][0-9][A-Z0-9]{{3}}[0-9](-\\d+)?$') THEN 'uniprot' END) AS kinds FROM f",
)
_FIELDS = ["row_key", "gene_id", "variant_id", "phenotype"]
_COLS = ", ".join(_FIELDS)
_add("D1_projection", lambda s, d: points(s, d).select("variant_id", "p_value"), f"{SQL} SELECT variant_id, p_value FROM points")
_add("D2_core_keys", lambda s, d: rec.core_keys(points(s, d)).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE {_GENE}")
_add("D3_dataset_types", lambda s, d: rec.of_types(points(s, d), ["TRAIT"]).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE dataset_type = 'TRAIT'")
_genes = lambda s, d: read(s, d, "part").where("p_size > 45").select(c("p_brand").alias("gene_id"))
_add("D4_genes_in", lambda s, d: rec.genes_in(points(s, d), _genes(s, d)).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE gene_id IN (SELECT p_brand FROM part WHERE p_size > 45)")
_add("D4_genes_not_in", lambda s, d: rec.genes_in(points(s, d), _genes(s, d), True).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE gene_id NOT IN (SELECT p_brand FROM part WHERE p_size > 45)")
_add("D5_term_filter", lambda s, d: points(s, d).where(fn.matches_terms(fn.phenotype_list(c("list_text")), ("urgent", "low"))).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE regexp_matches(lower(list_text), 'urgent|low')")
_add("D6_hash_part", lambda s, d: rec.hash_part(points(s, d), "gene_id", 4, 1).select(*_FIELDS), f"{SQL} SELECT {_COLS} FROM points WHERE cast('0x' || substr(sha1(gene_id), 1, 8) AS bigint) % 4 = 1")
_add("D11_single_genes", lambda s, d: points(s, d).where(~F.contains(c("messy"), F.lit(","))).select("row_key", "messy"), f"{SQL} SELECT row_key, messy FROM points WHERE NOT contains(messy, ',')")

# joins
_MAP = [("CVD", "1-urgent", "heart"), ("CVD", "2-high", "vessel"), ("TRAIT", "4-not_specified", "general"), ("", "5-low", "lipid"), ("", "1-urgent", "any")]
_MAP_SQL = "(VALUES " + ", ".join(str(r) for r in _MAP) + ")"
_MAP_JOIN = f"LEFT JOIN {_MAP_SQL} AS mt(t_type, t_slug, t_cat) ON dataset_type = t_type AND {_slug('phenotype')} = t_slug LEFT JOIN {_MAP_SQL} AS mp(p_type, p_slug, p_cat) ON p_type = '' AND {_slug('phenotype')} = p_slug"
_CATEGORY = f"coalesce(t_cat, p_cat, {_slug('disease_category')}, '')"
_PARENT = _slug("parent_phenotype")
_ROLL_LABEL = f"coalesce(CASE WHEN {_PARENT} <> '' AND NOT regexp_matches({_PARENT}, '^[0-9]+$') THEN {_PARENT} END, nullif({_CATEGORY}, ''), {_slug('phenotype')})"


def _roll_map(s: SparkSession) -> DataFrame:
    return s.createDataFrame(_MAP, "dataset_type string, slug string, mapped_category string")


_add("E1_phenotype_map", lambda s, d: ag.roll_up(rec.core_keys(points(s, d)), _roll_map(s)).select("row_key", "slug", "category"), f"{SQL} SELECT row_key, {_slug('phenotype')} AS slug, {_CATEGORY} AS category FROM points {_MAP_JOIN} WHERE {_GENE}")
_add("E3_rollup_target", lambda s, d: ag.roll_up(rec.core_keys(points(s, d)), _roll_map(s)).select("row_key", "category", "label"), f"{SQL} SELECT row_key, {_CATEGORY} AS category, {_ROLL_LABEL} AS label FROM points {_MAP_JOIN} WHERE {_GENE}")
_add(
    "E4_enrichment",
    lambda s, d: rec.enrich(points(s, d).select("row_key", "variant_id", c("variation_type").alias("field")), read(s, d, "part").selectExpr("concat('rs', cast(p_partkey AS string)) AS variant_id", "CASE WHEN p_size % 2 = 0 THEN 'first' ELSE 'other' END AS source", "p_type AS value"), "field", "variant_id", ("first",)),
    f"{SQL} SELECT row_key, variant_id, coalesce({_clean('variation_type')}, p_type) AS field FROM points LEFT JOIN part ON variant_id = 'rs' || p_partkey",
)


def _overlaps(s: SparkSession, d: str, size: int = 100_000) -> DataFrame:
    v, g = intervals(s, d)
    return iv.overlap_join(v, g, ("v_chrom", "g_chrom"), ("v_start", "g_start"), ("v_end", "g_end"), size)


_HIT = "v_chrom = g_chrom AND v_start <= g_end AND g_start <= v_end"
_add("E5_interval_overlap", lambda s, d: _overlaps(s, d).select("variant", "gene"), f"{INTERVALS_SQL} SELECT variant, gene FROM v JOIN g ON {_HIT}")
_add("J3_overlap_counts", lambda s, d: _overlaps(s, d).groupBy("gene").agg(F.count("*").alias("n_variants")), f"{INTERVALS_SQL} SELECT gene, count(*) AS n_variants FROM v JOIN g ON {_HIT} GROUP BY gene")
_add(
    "E6_overlap_with_fallback",
    lambda s, d: iv.with_fallback(intervals(s, d)[0], "variant", _overlaps(s, d).select("variant", c("gene").cast("string").alias("gene")), intervals(s, d)[0].select("variant", F.concat(F.lit("far_"), c("v_chrom").cast("string")).alias("gene"))),
    f"{INTERVALS_SQL}, l AS (SELECT variant, cast(gene AS varchar) AS gene FROM v JOIN g ON {_HIT}) SELECT * FROM l UNION ALL SELECT variant, 'far_' || v_chrom FROM v WHERE variant NOT IN (SELECT variant FROM l)",
)
_add("J4_region_chunks", lambda s, d: iv.chunks(intervals(s, d)[1], "g_start", "g_end", 5000).select("gene", "part_start", "part_end"), f"{INTERVALS_SQL} SELECT gene, part_start, least(part_start + 4999, g_end) AS part_end FROM (SELECT *, unnest(range(g_start, g_end + 1, 5000)) AS part_start FROM g)")
_add("E9_eligible_genes", lambda s, d: cat.eligible_genes(points(s, d)), f"{SQL} SELECT gene_id FROM points GROUP BY gene_id HAVING count(DISTINCT dataset_type) = 2")
_SHARED = f"sv AS (SELECT DISTINCT gene_id, dataset_type, {_slug('phenotype')} AS name, variant_id FROM points), both_types AS (SELECT gene_id, variant_id FROM sv GROUP BY ALL HAVING count(DISTINCT dataset_type) = 2)"
_add("E10_shared_variants", lambda s, d: cat.shared_variants(points(s, d)), f"{SQL}, {_SHARED} SELECT gene_id, lower(dataset_type) AS type, name, variant_id FROM sv SEMI JOIN both_types USING (gene_id, variant_id)")
_add("N11_shared_architecture", lambda s, d: cat.shared_architecture(points(s, d)), f"{SQL}, {_SHARED} SELECT gene_id, lower(dataset_type) AS type, name, count(*) AS shared_variant_count, min(x) AS least, max(x) AS most FROM (SELECT *, cast(cast('0x' || substr(sha1(variant_id), 1, 12) AS bigint) AS double) AS x FROM sv SEMI JOIN both_types USING (gene_id, variant_id)) GROUP BY ALL")


def _tables(s: SparkSession, d: str) -> dict[str, DataFrame]:
    p = points(s, d)
    return {"association": p.where("dataset_type = 'CVD'"), "overall": p.where("p_value is not null"), "expression": read(s, d, "part").select(c("p_brand").alias("gene_id"))}


_CATALOG = f"{SQL}, u AS (SELECT upper(trim(gene_id)) AS g, 'a' AS t FROM points WHERE dataset_type = 'CVD' UNION ALL SELECT upper(trim(gene_id)), 'o' FROM points WHERE p_value IS NOT NULL UNION ALL SELECT upper(trim(p_brand)), 'e' FROM part) SELECT g AS gene_id_normalized, bool_or(t = 'a') AS has_association, bool_or(t = 'o') AS has_overall, bool_or(t = 'e') AS has_expression FROM u GROUP BY g"
_add("E11_catalog_joins", lambda s, d: cat.gene_catalog_by_joins(_tables(s, d)), _CATALOG)
_add("E12_catalog_union", lambda s, d: cat.gene_catalog(_tables(s, d)), _CATALOG)
_add("E13_pending", lambda s, d: cat.pending(points(s, d), points(s, d).where("dataset_type = 'CVD'"), ["gene_id", "variant_id"]), f"{SQL} SELECT DISTINCT gene_id, variant_id FROM points EXCEPT SELECT gene_id, variant_id FROM points WHERE dataset_type = 'CVD'")
_add("E17_pairing_check", lambda s, d: cat.pending(points(s, d), points(s, d).where("p_value is not null"), ["dataset_type", "gene_id"]), f"{SQL} SELECT DISTINCT dataset_type, gene_id FROM points EXCEPT SELECT dataset_type, gene_id FROM points WHERE p_value IS NOT NULL")

# aggregation
def _kept(s: SparkSession, d: str) -> DataFrame:
    return rec.dedup_by_source(rec.core_keys(points(s, d)), PRIORITY)


_add("G1_source_priority_dedup", lambda s, d: _kept(s, d).select(*_FIELDS, "source", "p_value", "ancestry_source_code"), f"{SQL}, {_G1} SELECT {_COLS}, source, p_value, ancestry_source_code FROM kept")
_MESS = {"dataset_type": "CASE WHEN ci_text = 'wide' THEN concat(' ', lower(dataset_type)) ELSE dataset_type END", "gene_id": "CASE WHEN flag_text = '0' THEN concat(gene_id, '  ') ELSE gene_id END", "ancestry_source_code": "CASE WHEN flag_text = 'maybe' THEN ' ' WHEN flag_text = '0' THEN NULL ELSE ancestry_source_code END"}
_add(
    "G1_dedup_of_unclean_keys",
    lambda s, d: rec.dedup_by_source(rec.core_keys(points(s, d).withColumns({k: F.expr(v) for k, v in _MESS.items()})), PRIORITY).select(*_FIELDS, "dataset_type", "source", "ancestry_source_code"),
    f"{SQL}, mess AS (SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in _MESS.items())}) FROM points), {_g1('mess')} SELECT {_COLS}, dataset_type, source, ancestry_source_code FROM kept",
)
_LABEL, _OVER = ["dataset_type", "gene_id", "phenotype"], ["dataset_type", "gene_id"]
_add("F4_best_per_variant", lambda s, d: ag.best_per_variant(_kept(s, d), _OVER, ("row_key", "p_value")), f"{SQL}, {_G1} SELECT dataset_type, gene_id, variant_id, row_key, p_value FROM kept QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, variant_id ORDER BY p_value IS NULL, p_value, row_key) = 1")
_add("F5_label_counters", lambda s, d: ag.aggregate_variants(_kept(s, d), _LABEL), f"{SQL}, {_G1}, {_axes('dataset_type, gene_id, phenotype', 'kept')}")
_add("F5_label_counters_unknown", lambda s, d: ag.aggregate_variants(_kept(s, d), _LABEL, True), f"{SQL}, {_G1}, {_axes('dataset_type, gene_id, phenotype', 'kept', True)}")
_add("F6_overall_counters", lambda s, d: ag.aggregate_variants(_kept(s, d), _OVER), f"{SQL}, {_G1}, {_axes('dataset_type, gene_id', 'kept')}")
_R = f"rolled AS (SELECT kept.*, {_CATEGORY} AS category, {_ROLL_LABEL} AS label FROM kept {_MAP_JOIN})"
_rolled = lambda s, d: ag.roll_up(_kept(s, d), _roll_map(s))
_add("F7_rollup_counters", lambda s, d: ag.aggregate_variants(_rolled(s, d), ["dataset_type", "gene_id", "category", "label"]), f"{SQL}, {_G1}, {_R}, {_axes('dataset_type, gene_id, category, label', 'rolled')}")
_add("F8_rollup_overall", lambda s, d: ag.aggregate_variants(_rolled(s, d), _OVER), f"{SQL}, {_G1}, {_R}, {_axes('dataset_type, gene_id', 'rolled')}")
_add("F9_ancestry_points", lambda s, d: ag.ancestry_points(points(s, d), _LABEL), f"{SQL} SELECT dataset_type, gene_id, phenotype, ancestry, variant_id, ancestry_af AS value FROM points QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, phenotype, ancestry, variant_id ORDER BY ingested_at DESC, row_key DESC) = 1")
_BY_VARIANT = "PARTITION BY dataset_type, gene_id, phenotype, variant_id"
_F10 = (
    f"b AS (SELECT dataset_type, gene_id, phenotype, variant_id, {_variation('variation_type')} AS variation, {_significance('clinical_significance')} AS significance, {_consequence('most_severe_consequence')} AS consequence, p_value, source FROM kept QUALIFY row_number() OVER ({_BY_VARIANT} ORDER BY p_value IS NULL, p_value, row_key) = 1), "
    "g AS (SELECT dataset_type, gene_id, phenotype, variant_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS source_files, coalesce(string_agg(DISTINCT phenotype_key, ',' ORDER BY phenotype_key), '') AS phenotype_keys, count(*) AS record_count FROM kept GROUP BY ALL), "
    "n AS (SELECT dataset_type, gene_id, phenotype, variant_id, ancestry, ancestry_af FROM kept QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, phenotype, variant_id, ancestry ORDER BY ingested_at DESC, row_key DESC) = 1), "
    "m AS (SELECT dataset_type, gene_id, phenotype, variant_id, string_agg(ancestry, ',' ORDER BY ancestry) AS populations, min(ancestry_af) AS least_af, max(ancestry_af) AS most_af FROM n GROUP BY ALL)"
)
_add(
    "F10_variant_index",
    lambda s, d: ag.variant_index(_kept(s, d), _LABEL).withColumns({x: F.array_join(x, ",") for x in ("sources", "source_files", "phenotype_keys")})
    .withColumns({"populations": F.array_join(F.map_keys("ancestry"), ","), "least_af": F.array_min(F.map_values("ancestry")), "most_af": F.array_max(F.map_values("ancestry"))}).drop("ancestry"),
    f"{SQL}, {_G1}, {_F10} SELECT * FROM b JOIN g USING (dataset_type, gene_id, phenotype, variant_id) JOIN m USING (dataset_type, gene_id, phenotype, variant_id)",
)
_add(
    "F11_provenance",
    lambda s, d: ag.provenance(points(s, d), _OVER).select(*_OVER, *[F.array_join(x, ",").alias(x) for x in ("sources", "groups", "codes")], "source_file_count", "record_count"),
    f"{SQL} SELECT dataset_type, gene_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(DISTINCT ancestry, ',' ORDER BY ancestry) AS groups, string_agg(DISTINCT ancestry_source_code, ',' ORDER BY ancestry_source_code) AS codes, count(DISTINCT source_file) AS source_file_count, count(*) AS record_count FROM points GROUP BY ALL",
)
_add(
    "F2_mvp_group",
    lambda s, d: points(s, d).groupBy("dataset_id", "dataset_type", "source", "gene_id", "variant_id", "phenotype", "ancestry").agg(F.min("p_value").alias("p_value"), F.min("ancestry_af").alias("ancestry_af"), F.min(fn.slug(c("phenotype"))).alias("phenotype_key")),
    f"{SQL} SELECT dataset_id, dataset_type, source, gene_id, variant_id, phenotype, ancestry, min(p_value) AS p_value, min(ancestry_af) AS ancestry_af, min({_slug('phenotype')}) AS phenotype_key FROM points GROUP BY ALL",
)
_add(
    "F3_legacy_group",
    lambda s, d: points(s, d).groupBy("dataset_type", "gene_id", "variant_id", "phenotype", "ancestry", "source_file").agg(F.min(F.nullif(c("variation_type"), F.lit(""))).alias("variation_type"), F.min(F.nullif(c("alt"), F.lit(" "))).alias("alt")),
    f"{SQL} SELECT dataset_type, gene_id, variant_id, phenotype, ancestry, source_file, min(nullif(variation_type, '')) AS variation_type, min(nullif(alt, ' ')) AS alt FROM points GROUP BY ALL",
)
_add("F14_grouped_best", lambda s, d: rec.best_fields(points(s, d), ["dataset_type", "gene_id", "variant_id", "phenotype"], ["row_key", "source", "p_value", "variation_type"], PRIORITY), f"{SQL} SELECT dataset_type, gene_id, variant_id, phenotype, row_key, source, p_value, variation_type FROM points QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, variant_id, phenotype ORDER BY {_BEST}) = 1")
_BK = ["dataset_type", "gene_id", "variant_id", "phenotype"]
_add(
    "E8_best_with_ancestry",
    lambda s, d: rec.best_fields(points(s, d), _BK, ["row_key"], PRIORITY).join(rec.best_fields(points(s, d).where("ancestry_af > 0.3"), _BK, ["ancestry", "ancestry_af"], PRIORITY), _BK, "left"),
    f"{SQL}, r AS (SELECT dataset_type, gene_id, variant_id, phenotype, row_key FROM points QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, variant_id, phenotype ORDER BY {_BEST}) = 1), a AS (SELECT dataset_type, gene_id, variant_id, phenotype, ancestry, ancestry_af FROM points WHERE ancestry_af > 0.3 QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, variant_id, phenotype ORDER BY {_BEST}) = 1) SELECT * FROM r LEFT JOIN a USING (dataset_type, gene_id, variant_id, phenotype)",
)
_add("F15_both_types", lambda s, d: points(s, d).groupBy("variant_id").agg(F.count_distinct("dataset_type").alias("n")).where("n = 2"), f"{SQL} SELECT variant_id, count(DISTINCT dataset_type) AS n FROM points GROUP BY ALL HAVING n = 2")
_add("F16_flags", lambda s, d: points(s, d).groupBy("gene_id").agg(F.bool_or(c("dataset_type") == "CVD").alias("has_cvd"), F.bool_or(c("p_value").isNull()).alias("has_null_p")), f"{SQL} SELECT gene_id, bool_or(dataset_type = 'CVD') AS has_cvd, bool_or(p_value IS NULL) AS has_null_p FROM points GROUP BY ALL")
_add("F18_group_sizes", lambda s, d: ag.group_sizes(points(s, d), _OVER), f"{SQL} SELECT dataset_type, gene_id, count(*) AS n FROM points GROUP BY ALL")
_FIRST = lambda x: f"arg_min({_clean(x)}, CASE WHEN {_clean(x)} IS NOT NULL THEN row_key END) AS {x}"
_NEWEST = lambda x: f"SELECT dataset_type, gene_id, variant_id, phenotype, {x}, ancestry_af FROM points QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, variant_id, phenotype, {x} ORDER BY ingested_at DESC, row_key DESC) = 1"
_add(
    "F21_fold_records",
    lambda s, d: ag.fold_records(points(s, d), _BK).withColumns({"groups": F.array_join(F.map_keys("ancestry"), ","), "most_af": F.array_max(F.map_values("ancestry")), "codes": F.array_join(F.map_keys("source_ancestry"), ",")}).drop("ancestry", "source_ancestry"),
    f"{SQL}, h AS (SELECT dataset_type, gene_id, variant_id, phenotype, min(p_value) AS p_value, {_FIRST('variation_type')}, {_FIRST('clinical_significance')}, {_FIRST('most_severe_consequence')}, count(DISTINCT ancestry) AS n_ancestries FROM points GROUP BY ALL), "
    f"a AS (SELECT dataset_type, gene_id, variant_id, phenotype, string_agg(ancestry, ',' ORDER BY ancestry) AS groups, max(ancestry_af) AS most_af FROM ({_NEWEST('ancestry')}) GROUP BY ALL), "
    f"b AS (SELECT dataset_type, gene_id, variant_id, phenotype, string_agg(ancestry_source_code, ',' ORDER BY ancestry_source_code) AS codes FROM ({_NEWEST('ancestry_source_code')}) GROUP BY ALL) "
    "SELECT * FROM h JOIN a USING (dataset_type, gene_id, variant_id, phenotype) JOIN b USING (dataset_type, gene_id, variant_id, phenotype)",
)
_halves = lambda s, d: [ag.aggregate_variants(rec.core_keys(points(s, d)).where(w), _OVER) for w in ("source_file < 'file_3'", "source_file >= 'file_3'")]
_half = lambda w: f"(WITH h AS (SELECT * FROM points WHERE {_GENE} AND {w}), {_axes('dataset_type, gene_id', 'h')})"
_add("F22_merge_counters", lambda s, d: ag.merge_counters(*_halves(s, d), ["dataset_type", "gene_id", "axis", "name"]), SQL + " SELECT dataset_type, gene_id, axis, name, cast(sum(value) AS bigint) AS value FROM (" + _half("source_file < 'file_3'") + " UNION ALL " + _half("source_file >= 'file_3'") + ") GROUP BY ALL")
_add("F26_run_counters", lambda s, d: ag.run_counters(points(s, d)), f"{SQL} SELECT count(*) AS seen, count(*) FILTER (NOT {_GENE}) AS no_gene, count(*) FILTER ({_GENE} AND p_value IS NULL) AS no_p, count(*) FILTER ({_GENE} AND p_value IS NOT NULL) AS emitted FROM points")
_add("F28_filtered_counters", lambda s, d: ag.filtered(_kept(s, d), ["1-urgent", "5-low"], _OVER), f"{SQL}, {_G1}, f AS (SELECT * FROM kept WHERE phenotype IN ('1-urgent', '5-low')), {_axes('dataset_type, gene_id', 'f')}")
_add(
    "F24_structural_fold",
    lambda s, d: cat.fold_structural(_overlaps(s, d).select(c("gene").alias("gene_id"), c("variant").alias("variant_id"), c("v_start").alias("start"), c("v_end").alias("end"), F.lit("cnv").alias("type"))).select("gene_id", F.array_join(F.transform("variants", lambda v: v.variant_id.cast("string")), ",").alias("variants")),
    f"{INTERVALS_SQL} SELECT gene AS gene_id, string_agg(cast(variant AS varchar), ',' ORDER BY v_start, v_end, variant) AS variants FROM v JOIN g ON {_HIT} GROUP BY gene",
)
_add("F27_ordered_exons", lambda s, d: cat.ordered_exons(read(s, d, "lineitem").selectExpr("l_partkey AS gene_id", "l_suppkey AS transcript_id", "l_linenumber AS exon_number", "l_orderkey AS start", "l_orderkey + 5 AS end")).select("gene_id", "transcript_id", F.array_join(F.transform("exons", lambda e: F.concat_ws(":", e.exon_number.cast("string"), e.start.cast("string"))), ",").alias("exons")), "SELECT l_partkey AS gene_id, l_suppkey AS transcript_id, string_agg(l_linenumber || ':' || l_orderkey, ',' ORDER BY l_linenumber, l_orderkey) AS exons FROM lineitem GROUP BY ALL")

# windows, order, sets, shape
_T = "is_canonical DESC, is_mane DESC, is_appris DESC, (biotype = 'protein_coding') DESC, span DESC, transcript_id"
_add("G3_best_transcript", lambda s, d: cat.best_transcripts(transcripts(s, d)).select("gene_id", "transcript_id", "span"), f"{TRANSCRIPT_SQL} SELECT gene_id, transcript_id, span FROM transcripts QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY {_T}) = 1")
_CHOSEN = "(hinted OR is_canonical OR gencode_primary)"
_ISO = f"iso AS (SELECT *, {_CHOSEN} AS chosen, bool_or({_CHOSEN}) OVER (PARTITION BY gene_id) AS has_chosen, row_number() OVER (PARTITION BY gene_id ORDER BY ord, transcript_id) AS o FROM transcripts)"
_add(
    "G5_top_isoforms",
    lambda s, d: cat.top_isoforms(transcripts(s, d)).select("gene_id", "transcript_id", "rank"),
    f"{TRANSCRIPT_SQL}, {_ISO} SELECT gene_id, transcript_id, row_number() OVER (PARTITION BY gene_id ORDER BY is_canonical DESC, gencode_primary DESC, transcript_id) AS rank FROM iso WHERE chosen OR (NOT has_chosen AND o <= 12) QUALIFY rank <= 12",
)
_add("G4_canonical_transcript", lambda s, d: cat.canonical_transcripts(transcripts(s, d)).select("gene_id", "transcript_id"), f"{TRANSCRIPT_SQL} SELECT gene_id, transcript_id FROM transcripts QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY is_canonical DESC, gencode_primary DESC, ord, transcript_id) = 1")
_add("H1_publish_order", lambda s, d: points(s, d).select("gene_id", "phenotype", "variant_id", "row_key").orderBy("gene_id", "phenotype", "variant_id", "row_key"), f"{SQL} SELECT gene_id, phenotype, variant_id, row_key FROM points ORDER BY ALL")
_add("H2_label_order", lambda s, d: points(s, d).groupBy(*_OVER).agg(F.array_join(F.array_sort(F.collect_set("phenotype")), "|").alias("labels")), f"{SQL} SELECT dataset_type, gene_id, string_agg(DISTINCT phenotype, '|' ORDER BY phenotype) AS labels FROM points GROUP BY ALL")
_add("H4_bounded_batch", lambda s, d: points(s, d).select("gene_id", "variant_id").distinct().orderBy("gene_id", "variant_id").limit(100), f"{SQL} SELECT DISTINCT gene_id, variant_id FROM points ORDER BY gene_id, variant_id LIMIT 100")
_add("I3_distinct_keys", lambda s, d: points(s, d).select(*_BK).distinct(), f"{SQL} SELECT DISTINCT dataset_type, gene_id, variant_id, phenotype FROM points")
_add("I4_intersection", lambda s, d: points(s, d).where("dataset_type = 'CVD'").select("variant_id").intersect(points(s, d).where("dataset_type = 'TRAIT'").select("variant_id")), f"{SQL} SELECT variant_id FROM points WHERE dataset_type = 'CVD' INTERSECT SELECT variant_id FROM points WHERE dataset_type = 'TRAIT'")
_add("J1_unpivot_ancestry", lambda s, d: rec.unpivot_ancestry(read(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "nullif(l_tax, 0) AS afr", "nullif(l_discount, 0) AS eur"), ["l_orderkey", "l_linenumber"], {"afr": "African", "eur": "European"}), "WITH w AS (SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS afr, nullif(l_discount, 0) AS eur FROM lineitem) SELECT l_orderkey, l_linenumber, 'African' AS ancestry, afr AS ancestry_af FROM w UNION ALL SELECT l_orderkey, l_linenumber, 'European', eur FROM w UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM w WHERE afr IS NULL AND eur IS NULL")
_add("J2_ancestry_map", lambda s, d: ag.ancestry_points(points(s, d), _BK[:2]).groupBy("dataset_type", "gene_id", "variant_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ancestry", "value")))).alias("m")).select("dataset_type", "gene_id", "variant_id", F.array_join(F.map_keys("m"), ",").alias("keys"), F.array_max(F.map_values("m")).alias("most")), f"{SQL}, a AS (SELECT dataset_type, gene_id, ancestry, variant_id, ancestry_af AS value FROM points QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, ancestry, variant_id ORDER BY ingested_at DESC, row_key DESC) = 1) SELECT dataset_type, gene_id, variant_id, string_agg(ancestry, ',' ORDER BY ancestry) AS keys, max(value) AS most FROM a GROUP BY ALL")

# quality
_POLICY = (("gene_id", True, "exclude", ""), ("p_value", True, "allow", ""), ("clinical_significance", True, "unknown", "Unknown"), ("variation_type", False, "unknown", "none"))
_add(
    "K1_validation",
    lambda s, d: rec.validate(points(s, d).withColumn("gene_id", F.when(fn.is_gene(c("gene_id")), c("gene_id"))), _POLICY).select("row_key", "gene_id", "clinical_significance", "variation_type", "valid", F.array_join(F.transform("issues", lambda i: F.concat_ws(":", i.field, i.message)), "|").alias("issues")),
    f"{SQL}, x AS (SELECT *, {_GENE} AS ok FROM points) SELECT row_key, CASE WHEN ok THEN gene_id END AS gene_id, CASE WHEN ok THEN coalesce(clinical_significance, 'Unknown') ELSE clinical_significance END AS clinical_significance, CASE WHEN ok THEN coalesce(variation_type, 'none') ELSE variation_type END AS variation_type, ok AS valid, "
    "CASE WHEN NOT ok THEN 'gene_id:Required field missing; record excluded.' ELSE concat_ws('|', CASE WHEN p_value IS NULL THEN 'p_value:Required field missing; kept by policy.' END, CASE WHEN clinical_significance IS NULL THEN 'clinical_significance:Required field missing; set to unknown marker.' END) END AS issues FROM x",
)
_inv = lambda s, d: read(s, d, "events").select("event_id", F.array_distinct(F.array(c("event_type"), F.lit("ts"), F.when(c("user_id") % 2 == 0, "user").otherwise("guest"))).alias("columns"))
_INV = "WITH i AS (SELECT event_id, [event_type, 'ts', CASE WHEN user_id % 2 = 0 THEN 'user' ELSE 'guest' END] AS cols FROM events)"
_add("K3_drift", lambda s, d: rec.drift(_inv(s, d), ["ts", "user"]).select("event_id", "status", F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed")), f"{_INV} SELECT event_id, CASE WHEN NOT list_contains(cols, 'user') THEN 'breaking' ELSE 'compatible_with_additions' END AS status, array_to_string(list_filter(cols, lambda x: x NOT IN ('ts', 'user')), ',') AS added, CASE WHEN list_contains(cols, 'user') THEN '' ELSE 'user' END AS removed FROM i")
_LACK = "concat_ws(',', CASE WHEN NOT list_has_any(cols, ['user', 'owner']) THEN 'one_of(user|owner)' END, CASE WHEN NOT list_has_any(cols, ['ts', 'time']) THEN 'one_of(ts|time)' END, CASE WHEN NOT list_has_any(cols, ['click', 'view', 'guest']) THEN 'one_of(click|view|guest)' END)"
_MORE = "len(list_filter(cols, lambda x: x NOT IN ('user', 'owner', 'ts', 'time', 'click', 'view', 'guest')))"
_add(
    "K4_drift_of_groups",
    lambda s, d: rec.drift_of_groups(_inv(s, d), [["user", "owner"], ["ts", "time"], ["click", "view", "guest"]]).select("event_id", "status", F.array_join("removed", ",").alias("removed")),
    f"{_INV} SELECT event_id, CASE WHEN {_LACK} <> '' THEN 'breaking' WHEN {_MORE} > 0 THEN 'compatible_with_additions' ELSE 'compatible' END AS status, {_LACK} AS removed FROM i",
)
_add("F19_drift_counts", lambda s, d: rec.drift(_inv(s, d), ["ts", "user"]).groupBy("status").agg(F.count("*").alias("n")), f"{_INV} SELECT CASE WHEN NOT list_contains(cols, 'user') THEN 'breaking' ELSE 'compatible_with_additions' END AS status, count(*) AS n FROM i GROUP BY ALL")
_add("K6_payload_violations", lambda s, d: cat.payload_violations(points(s, d).select("gene_id", F.lit("vc").alias("axis"), c("variation_type").alias("name"), c("p_value").isNull().cast("bigint").alias("value")).where("name is not null").distinct(), ["gene_id"]).select("gene_id", "name", "problem"), f"{SQL}, t AS (SELECT DISTINCT gene_id, variation_type AS name, p_value IS NULL AS value FROM points WHERE variation_type IS NOT NULL) SELECT gene_id, name, CASE WHEN name IS DISTINCT FROM {_variation('name')} THEN 'not canonical' ELSE 'repeated' END AS problem FROM (SELECT gene_id, name, count(*) AS n FROM t GROUP BY ALL) WHERE name IS DISTINCT FROM {_variation('name')} OR n > 1")
FLAGSHIP: Query = _QUERIES["F6_overall_counters"]
