"""Registered queries of readers, publishing, structural, protein, serving and quality operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import aggregates as ag
from allelix.operators import catalog as cat
from allelix.operators import meta, paths, protein, qa, serving
from allelix.operators import publish as pub
from allelix.operators import records as rec
from allelix.operators import structural as sv
from allelix.plans import sqltext as q
from allelix.plans.points import INTERVALS_SQL, PRIORITY, SQL, TRANSCRIPT_SQL, intervals, points, read, transcripts
from allelix.sources import adapters as ad
from allelix.sources import files
from allelix.sources.scratch import dropped, folder, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
c = F.col


def add(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return keep


def joined(*columns: str) -> dict:
    """Array columns as comma-joined text."""
    return {x: F.array_join(x, ",") for x in columns}


# phenotype tree, label paths, filters on paths
TREE = {"CVD": {"heart": ["1-URGENT"], "vessel": {"large": ["2-HIGH"], "small": ["3-MEDIUM"]}}, "TRAIT": {"general": ["4-NOT SPECIFIED", {"low": ["5-LOW"]}]}}
LEAVES = [("CVD", "1-urgent", "heart,1-urgent"), ("CVD", "2-high", "vessel,large,2-high"), ("CVD", "3-medium", "vessel,small,3-medium"), ("TRAIT", "4-not_specified", "general,4-not_specified"), ("TRAIT", "5-low", "general,low,5-low")]
LEAF_SQL = "(VALUES " + ", ".join(str(r) for r in LEAVES) + ") AS leaf(l_type, l_slug, l_path)"
CATEGORY, SLUG = q.slug("disease_category"), q.slug("phenotype")
PATH = f"coalesce(l_path, CASE WHEN {CATEGORY} = {SLUG} THEN {SLUG} ELSE concat_ws(',', nullif({CATEGORY}, ''), nullif({SLUG}, '')) END)"
LEAF_JOIN = f"LEFT JOIN {LEAF_SQL} ON upper(coalesce(dataset_type, 'CVD')) = l_type AND {SLUG} = l_slug"
KEPT = f"{SQL}, {q.G1}, pathed AS (SELECT kept.*, {PATH} AS path FROM kept {LEAF_JOIN})"


def leaves(s: SparkSession) -> DataFrame:
    return paths.tree_tables(s, TREE)[0]


def pathed(s: SparkSession, d: str) -> DataFrame:
    return pub.kept_points(points(s, d), PRIORITY, leaves(s))


@add("E2_label_path", f"{KEPT} SELECT row_key, path FROM pathed")
def _(s, d):
    return pathed(s, d).select("row_key", F.array_join("label_path", ",").alias("path"))


@add("C33_label_path_without_tree", f"{SQL} SELECT row_key, CASE WHEN {q.slug('messy')} = {SLUG} THEN {SLUG} ELSE concat_ws(',', nullif({q.slug('messy')}, ''), {SLUG}) END AS path FROM points")
def _(s, d):
    return points(s, d).select("row_key", F.array_join(fn.label_path(F.lit(None).cast("array<string>"), c("messy"), c("phenotype")), ",").alias("path"))


@add("D8_path_filter", f"{KEPT} SELECT row_key FROM pathed WHERE list_has_any(string_split(path, ','), ['vessel', 'low'])")
def _(s, d):
    return paths.on_path(pathed(s, d), ["vessel", "LOW"]).select("row_key")


@add("F28_filtered_by_path", f"{KEPT}, f AS (SELECT * FROM pathed WHERE list_has_any(string_split(path, ','), ['vessel', 'low'])), {q.axes('dataset_type, gene_id', 'f')}")
def _(s, d):
    return ag.aggregate_variants(paths.on_path(pathed(s, d), ["vessel", "low"]), pub.GENE)


@add("A18_tree_leaves", f"SELECT o_orderkey, l_path AS path FROM orders LEFT JOIN {LEAF_SQL} ON l_type = CASE WHEN o_orderstatus = 'O' THEN 'TRAIT' ELSE 'CVD' END AND l_slug = {q.slug('o_orderpriority')}")
def _(s, d):
    rows = read(s, d, "orders").select("o_orderkey", F.when(c("o_orderstatus") == "O", "TRAIT").otherwise("CVD").alias("dataset_type"), fn.slug(c("o_orderpriority")).alias("slug"))
    return rows.join(leaves(s), ["dataset_type", "slug"], "left").select("o_orderkey", F.array_join("path", ",").alias("path"))


# provenance and manifest
MANIFEST = {
    "manifest_id": "m1", "version": 2, "promoted_fields": ["dataset_id", "gene_id"],
    "metadata_fields": [{"name": "a", "source": "row.phenotype_key", "target": "phenotype.key"}, {"name": "b", "source": "row.source_file", "target": "file"}, {"name": "k", "source": "literal:points", "target": "phenotype.kind"}],
    "derived_fields": [
        {"name": "prov", "helper": "source_provenance_bundle", "scope": "entry", "target": "meta.provenance"},
        {"name": "cov", "helper": "coverage_stub", "scope": "entry", "target": "meta.coverage", "params": {"scope": "association_entry"}},
        {"name": "cs", "helper": "normalized_clinical_significance", "scope": "axis", "target": "clinical_significance"},
    ],
    "publish_fields": {"entry_meta": ["manifest_id", "manifest_version", "prov", "cov"], "overall_meta": ["manifest_id", "cov"]},
}
_COUNTS = "SELECT dataset_type, gene_id, source, count(*) AS n FROM points GROUP BY ALL"
_PROVENANCE = f"s AS ({_COUNTS}), t AS (SELECT dataset_type, gene_id, string_agg(source, ',' ORDER BY source) AS sources, string_agg(cast(n AS varchar), ',' ORDER BY source) AS counts FROM s GROUP BY ALL), u AS (SELECT dataset_type, gene_id, count(DISTINCT source_file) AS files, count(*) AS records FROM points GROUP BY ALL)"


@add("F11_source_provenance", f"{SQL}, {_PROVENANCE} SELECT dataset_type, gene_id, sources, counts, files FROM t JOIN u USING (dataset_type, gene_id)")
def _(s, d):
    found = meta.source_provenance(points(s, d), pub.GENE).select(*pub.GENE, "provenance.*")
    return found.select(*pub.GENE, F.array_join("sources", ",").alias("sources"), F.array_join(F.transform(F.map_values("source_counts"), lambda n: n.cast("string")), ",").alias("counts"), c("source_file_count").alias("files"))


@add("F12_ancestry_provenance", f"{SQL} SELECT dataset_type, gene_id, string_agg(DISTINCT ancestry, ',' ORDER BY ancestry) AS canonical_groups, string_agg(DISTINCT ancestry_source_code, ',' ORDER BY ancestry_source_code) AS source_codes, string_agg(DISTINCT ancestry_source_label, ',' ORDER BY ancestry_source_label) AS source_labels FROM points GROUP BY ALL")
def _(s, d):
    return meta.ancestry_provenance(points(s, d), pub.GENE).select(*pub.GENE, "ancestry_provenance.*").withColumns(joined("canonical_groups", "source_codes", "source_labels"))


@add("F13_coverage", f"{SQL} SELECT dataset_type, gene_id, 'not_computed' AS status, 'entries' AS scope, count(*) AS record_count FROM points GROUP BY ALL")
def _(s, d):
    return meta.coverage(points(s, d), pub.GENE, {"scope": "entries"}).select(*pub.GENE, "coverage.status", "coverage.scope", "coverage.record_count")


_TWO = ("source_file < 'file_3'", "source_file >= 'file_3'")


@add(
    "F23_merge_provenance",
    f"{SQL}, {_PROVENANCE}, f AS (SELECT dataset_type, gene_id, string_agg(DISTINCT ancestry, ',' ORDER BY ancestry) AS groups FROM points GROUP BY ALL) SELECT dataset_type, gene_id, sources, counts, files, records, groups FROM t JOIN u USING (dataset_type, gene_id) JOIN f USING (dataset_type, gene_id)",
)
def _(s, d):
    both = meta.merge_provenance(*[meta.bundled(points(s, d).where(w), pub.GENE) for w in _TWO], pub.GENE)
    counts = F.array_join(F.transform(F.map_values("provenance.source_counts"), lambda n: n.cast("string")), ",").alias("counts")
    return both.select(*pub.GENE, F.array_join("provenance.sources", ",").alias("sources"), counts, c("provenance.source_file_count").alias("files"), c("coverage.record_count").alias("records"), F.array_join("ancestry_provenance.canonical_groups", ",").alias("groups"))


@add("C34_metadata_projection", f"{SQL} SELECT row_key, nullif(trim(phenotype_key), '') AS key, 'points' AS kind, source_file AS file FROM points")
def _(s, d):
    rows = points(s, d)
    found = rows.select("row_key", meta.Manifest.of(MANIFEST).metadata_json(rows.columns).alias("m"))
    return found.select("row_key", *[F.get_json_object("m", p).alias(n) for n, p in (("key", "$.phenotype.key"), ("kind", "$.phenotype.kind"), ("file", "$.file"))])


@add("M2_publish_meta", f"{SQL}, {_PROVENANCE} SELECT dataset_type, gene_id, 'm1' AS id, 2 AS version, records, files FROM u")
def _(s, d):
    found = meta.Manifest.of(MANIFEST).publish_meta(points(s, d), pub.GENE)
    number = lambda p: F.get_json_object("meta", p).cast("bigint")
    return found.select(*pub.GENE, F.get_json_object("meta", "$.manifest_id").alias("id"), number("$.manifest_version").cast("int").alias("version"), number("$.coverage.record_count").alias("records"), number("$.provenance.source_file_count").alias("files"))


@add("M3_axis_of_manifest", f"{SQL} SELECT row_key, {q.significance('clinical_significance')} AS label FROM points")
def _(s, d):
    return points(s, d).select("row_key", meta.Manifest.of(MANIFEST).axis("clinical_significance")(c("clinical_significance")).alias("label"))


# publishing
_LABELS = "dataset_type, gene_id, path"


def published(s: SparkSession, d: str, **more) -> pub.Published:
    """The whole publish of points that are joined and written once, so that the joins' files are gone before points are de-duplicated."""
    manifest, at = meta.Manifest.of(MANIFEST), folder(s, "points")
    found = pub.unified(stored(pub.lean(points(s, d), manifest), "points", at), PRIORITY, leaves(s), paths.rollup_map(s, TREE), manifest, scratch=folder(s, "kept"), **more)
    dropped(s, at)
    return found


def _counted(payloads: DataFrame, summary, schema: str) -> DataFrame:
    """Counters of payload rows read back from their JSON."""
    rows = payloads.select(*pub.GENE, F.from_json(summary(c("payload_json")), schema).alias("p"))
    if schema.startswith("array"):
        rows = rows.select(*pub.GENE, F.explode("p").alias("p"))
        keys = [F.array_join(F.coalesce("p.trait", "p.disease"), ",").alias("path")]
        items = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(f"p.{a}").alias("items")) for a in pub.AXIS_KINDS])
    else:
        keys = []
        items = F.array(*[F.struct(F.lit(a).alias("axis"), F.transform(F.map_entries(F.col(f"p.data.{a}")), lambda e: F.struct(e.key.alias("name"), e.value.alias("value"))).alias("items")) for a in pub.AXIS_KINDS])
    flat = rows.select(*pub.GENE, *keys, F.explode(items).alias("x"))
    return flat.select(*pub.GENE, *(["path"] if keys else []), "x.axis", F.explode("x.items").alias("i")).select(*pub.GENE, *(["path"] if keys else []), "axis", "i.*")


_ENTRY = "array<struct<trait:array<string>,disease:array<string>,vc:array<struct<name:string,value:bigint>>,msc:array<struct<name:string,value:bigint>>,cs:array<struct<name:string,value:bigint>>>>"
_TOTAL = "struct<data:struct<vc:map<string,bigint>,msc:map<string,bigint>,cs:map<string,bigint>>>"


@add("N5_association_payloads", f"{KEPT}, {q.axes(_LABELS, 'pathed')}")
def _(s, d):
    return _counted(published(s, d).payloads()["association"], pub.association_summary, _ENTRY)


@add("N5_overall_payloads", f"{KEPT}, {q.axes('dataset_type, gene_id', 'pathed')}")
def _(s, d):
    return _counted(published(s, d).payloads()["overall"], pub.overall_summary, _TOTAL)


_TREE_MAP = "(VALUES ('CVD', '1-urgent', 'heart'), ('TRAIT', '4-not_specified', 'general')) AS tm(tm_type, tm_slug, tm_cat)"
_TREE_CATEGORY = f"coalesce(tm_cat, {CATEGORY}, '')"
_TREE_LABEL = f"coalesce(CASE WHEN {q.slug('parent_phenotype')} <> '' AND NOT regexp_matches({q.slug('parent_phenotype')}, '^[0-9]+$') THEN {q.slug('parent_phenotype')} END, nullif({_TREE_CATEGORY}, ''), {SLUG})"
_ROLLED = f"{SQL}, {q.G1}, rolled AS (SELECT kept.*, concat_ws(',', {_TREE_CATEGORY}, {_TREE_LABEL}) AS path FROM kept LEFT JOIN {_TREE_MAP} ON dataset_type = tm_type AND {SLUG} = tm_slug)"


@add("B5_rollup_payloads", f"{_ROLLED}, {q.axes(_LABELS, 'rolled')}")
def _(s, d):
    return _counted(published(s, d).payloads()["association_rollup"], pub.association_summary, _ENTRY)


@add("B5_rollup_overall_payloads", f"{_ROLLED}, {q.axes('dataset_type, gene_id', 'rolled')}")
def _(s, d):
    return _counted(published(s, d).payloads()["overall_rollup"], pub.overall_summary, _TOTAL)


@add(
    "B6_index_payloads",
    f"{KEPT} SELECT dataset_type, gene_id, count(DISTINCT (path, variant_id)) AS n, min(path) AS first_path, count(DISTINCT variant_id) AS variants FROM pathed GROUP BY ALL",
)
def _(s, d):
    found = published(s, d).payloads()["variant_index"]
    rows = found.select(*pub.GENE, F.explode(F.from_json("payload_json", "array<struct<variant_id:string,phenotype_path:array<string>>>")).alias("x"))
    return rows.groupBy(*pub.GENE).agg(F.count("*").alias("n"), F.min(F.array_join("x.phenotype_path", ",")).alias("first_path"), F.count_distinct("x.variant_id").alias("variants"))


_KEY = "dataset_type, gene_id, variant_id, phenotype"


@add(
    "N6_index_backfill",
    f"{SQL}, norm AS (SELECT * REPLACE ({q.NORM}) FROM points WHERE {q.GENE}), r AS (SELECT * FROM norm QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {q.BEST}) = 1), "
    f"a AS (SELECT {_KEY}, string_agg(DISTINCT ancestry, ',' ORDER BY ancestry) AS populations FROM norm WHERE ancestry_af IS NOT NULL AND ancestry IS NOT NULL GROUP BY ALL) "
    f"SELECT dataset_type, gene_id, variant_id, {PATH} AS path, p_value, source, {q.variation('variation_type')} AS variation, populations FROM r {LEAF_JOIN} LEFT JOIN a USING ({_KEY})",
)
def _(s, d):
    found = pub.index_backfill(points(s, d), PRIORITY, leaves(s))
    return found.select(*pub.GENE, "variant_id", F.array_join("label_path", ",").alias("path"), "p_value", "source", "variation", F.array_join(F.map_keys("ancestry"), ",").alias("populations"))


_RAW = f"{SQL}, t AS (SELECT DISTINCT gene_id, 'vc' AS axis, variation_type AS name, p_value IS NULL AS value FROM points)"
_VL = q.variation("name")


@add("K6_axis_violations", f"{_RAW}, g AS (SELECT gene_id, name, count(*) AS n FROM t GROUP BY ALL) SELECT gene_id, name, CASE WHEN name IS NULL THEN 'empty' WHEN {_VL} IS NULL THEN 'unknown' WHEN {_VL} <> name THEN 'not canonical' ELSE 'repeated' END AS problem FROM g WHERE name IS NULL OR {_VL} IS NULL OR {_VL} <> name OR n > 1")
def _(s, d):
    rows = points(s, d).select("gene_id", F.lit("vc").alias("axis"), c("variation_type").alias("name"), c("p_value").isNull().cast("bigint").alias("value")).distinct()
    return pub.axis_violations(rows, ["gene_id"]).select("gene_id", "name", "problem")


@add("K7_index_violations", f"{SQL} SELECT gene_id, variant_id, 'variation not canonical' AS problem FROM points WHERE variation_type IS NOT NULL AND ({q.variation('variation_type')} IS NULL OR {q.variation('variation_type')} <> variation_type) UNION ALL SELECT gene_id, variant_id, 'no path' FROM points WHERE flag_text IS NULL UNION ALL SELECT gene_id, variant_id, 'repeated path' FROM points GROUP BY dataset_type, gene_id, variant_id, flag_text HAVING count(*) > 1")
def _(s, d):
    path = F.when(c("flag_text").isNotNull(), F.array("flag_text"))
    rows = points(s, d).select("dataset_type", "gene_id", "variant_id", path.alias("label_path"), c("variation_type").alias("variation"), F.lit(None).cast("string").alias("consequence"), F.lit(None).cast("string").alias("significance"))
    return pub.index_violations(rows).select("gene_id", "variant_id", "problem")


@add("C40_normalised_counters", f"{SQL} SELECT gene_id, {q.variation('variation_type')} AS name, count(*) AS value FROM points WHERE {q.variation('variation_type')} IS NOT NULL GROUP BY ALL")
def _(s, d):
    raw = points(s, d).groupBy("gene_id", F.lit("vc").alias("axis"), c("variation_type").alias("name")).agg(F.count("*").alias("value"))
    return pub.normalised_counters(raw, ["gene_id"]).select("gene_id", "name", "value")


# adapters over the given tables written as raw columns
_WIDE = {
    "Gene.symbol": "messy", "Gene.id": "p_brand", "rsID": "CASE WHEN l_linenumber % 3 = 0 THEN 'rs' || cast(l_partkey AS varchar(20)) END", "variation_id": "'v' || cast(l_partkey AS varchar(20))", "diseases_associated": "o_orderpriority",
    "adj.P.Val": "cast(l_tax AS varchar(20))", "European": "CASE WHEN l_linenumber % 2 = 0 THEN cast(p_size AS varchar(12)) END", "Other Asian": "CASE WHEN l_linenumber % 4 = 0 THEN 'nan' ELSE NULL END", "MAF": "CASE WHEN l_linenumber % 5 = 0 THEN '0.5' END",
    "source_file": "CASE WHEN l_returnflag = 'A' THEN '/in/TRAITS/a.csv' WHEN l_returnflag = 'N' THEN '/in/cvd/b.csv' ELSE '/in/c.csv' END",
}
_MESSY = "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'nan' ELSE ' GX' || cast(p_size AS varchar(12)) END"
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"


def _raw(s: SparkSession, d: str, columns: dict[str, str]) -> DataFrame:
    t = read(s, d, "lineitem").join(read(s, d, "orders"), c("l_orderkey") == c("o_orderkey")).join(read(s, d, "part"), c("l_partkey") == c("p_partkey"))
    return t.selectExpr(*[f"{e.replace('messy', '(' + _MESSY + ')')} AS `{n}`" for n, e in columns.items()])


def _raw_sql(columns: dict[str, str]) -> str:
    return "raw AS (SELECT " + ", ".join(f"{e.replace('messy', '(' + _MESSY + ')')} AS \"{n}\"" for n, e in columns.items()) + f" FROM {_LINES})"


TYPES = {"1-URGENT": ("TRAIT", "Heart x"), "2-HIGH": ("other", "Vessel")}
_TYPE_SQL = "(VALUES ('1-urgent', 'TRAIT', 'heart_x'), ('2-high', 'OTHER', 'vessel')) AS pm(pm_slug, pm_type, pm_cat)"


def types(s: SparkSession) -> DataFrame:
    return paths.phenotype_map(s, TYPES)


_G = q.clean('"Gene.symbol"')


@add(
    "A6_wide_populations",
    f"WITH {_raw_sql(_WIDE)} SELECT coalesce({_G}, \"Gene.id\") AS gene_id, coalesce(\"rsID\", variation_id) AS variant_id, {q.slug('diseases_associated')} AS phenotype, "
    "CASE WHEN contains(source_file, 'TRAITS') THEN 'TRAIT' WHEN contains(source_file, 'cvd') THEN 'CVD' WHEN pm_type = 'TRAIT' THEN 'TRAIT' ELSE 'CVD' END AS dataset_type, pm_cat AS disease_category, try_cast(\"adj.P.Val\" AS double) AS p_value, "
    "CASE WHEN \"European\" IS NOT NULL THEN 'European=' || \"European\" WHEN \"MAF\" IS NOT NULL THEN 'Total=0.5' ELSE '' END AS ancestry "
    f"FROM raw LEFT JOIN {_TYPE_SQL} ON {q.slug('diseases_associated')} = pm_slug",
)
def _(s, d):
    found = ad.wide_populations(_raw(s, d, _WIDE), types(s))
    shown = F.array_join(F.transform(F.map_entries("ancestry"), lambda e: F.concat_ws("=", e.key, e.value)), ";")
    return found.select("gene_id", "variant_id", "phenotype", "dataset_type", "disease_category", "p_value", shown.alias("ancestry"))


_GWAS = {"gene_name": "messy", "gene_id": "p_brand", "rsId": "CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE 'rs' || cast(l_partkey AS varchar(20)) END", "MarkerID": "'m' || cast(l_suppkey AS varchar(20)) || '-A-T'", "pval": "CASE WHEN l_linenumber % 2 = 0 THEN 'nan' ELSE cast(l_tax AS varchar(20)) END", "p_value": "'0.25'", "Phenotype": "o_orderpriority"}


@add(
    "A5_gwas",
    f"WITH {_raw_sql(_GWAS)} SELECT coalesce({q.clean('gene_name')}, gene_id) AS gene_id, coalesce({q.clean('rsId')}, split_part(\"MarkerID\", '-', 1)) AS variant_id, {q.slug('Phenotype')} AS phenotype, CASE WHEN pval = 'nan' THEN 0.25 ELSE cast(pval AS double) END AS p_value, 'TRAIT' AS dataset_type FROM raw",
)
def _(s, d):
    return ad.gwas(_raw(s, d, _GWAS)).select("gene_id", "variant_id", "phenotype", "p_value", "dataset_type")


_PREP = {"gene": "CASE WHEN p_size < 9 THEN cast(p_size AS varchar(12)) ELSE p_brand END", "rsid": "'rs' || cast(l_partkey AS varchar(20))", "phenotype": "o_orderpriority", "pval": "cast(l_tax AS varchar(20))", "var_class": "messy", "functional_class": "p_type", "ancestry_data": "concat('{\"African\": {\"MAF\": ', cast(p_size AS varchar(12)), '}, \"Other\": null}')"}


@add("A8_prepared_records", f"WITH {_raw_sql(_PREP)} SELECT gene AS gene_id, rsid AS variant_id, {q.slug('phenotype')} AS phenotype, coalesce(pm_type, 'CVD') AS dataset_type, {q.clean('var_class')} AS variation_type, json_extract_string(ancestry_data, '$.African.MAF') AS african, functional_class AS kind FROM raw LEFT JOIN {_TYPE_SQL} ON {q.slug('phenotype')} = pm_slug WHERE NOT regexp_matches(gene, '^[0-9]+$')")
def _(s, d):
    found = ad.prepared_records(_raw(s, d, _PREP), types(s))
    return found.select("gene_id", "variant_id", "phenotype", "dataset_type", "variation_type", F.col("ancestry")["African"].alias("african"), F.get_json_object("metadata", "$.functional_class").alias("kind"))


@add("A7_clinical", f"WITH {_raw_sql(_CLIN := {'Gene Name': 'p_brand', 'rsID': 'messy', 'Variant ID': 'cast(l_partkey AS varchar(20))', 'phenotype': 'concat(o_orderpriority, chr(59), p_type, chr(59), o_orderpriority)', 'Clinical Interpretation': 'p_type', 'source_file': 'concat(l_returnflag, chr(47), l_linestatus)'})}, r AS (SELECT *, unnest(list_distinct(string_split(phenotype, ';'))) AS p FROM raw) SELECT \"Gene Name\" AS gene_id, coalesce({q.clean('rsID')}, \"Variant ID\") AS variant_id, {q.slug('p')} AS phenotype, \"Clinical Interpretation\" AS clinical_significance FROM r")
def _(s, d):
    return ad.clinical(_raw(s, d, _CLIN)).select("gene_id", "variant_id", "phenotype", "clinical_significance")


_LONG = {
    "gene_symbol": "CASE WHEN p_size < 3 THEN cast(p_size AS varchar(12)) ELSE p_brand END", "SNP_ID": "'rs' || cast(l_partkey % 50 AS varchar(20))", "phenotype_description": "o_orderpriority", "phenotype_key": "CASE WHEN p_size % 4 = 0 THEN 'k1' END",
    "parent_phenotype": "CASE p_size % 3 WHEN 0 THEN '250' WHEN 1 THEN 'Big Group' END", "ref": "'A'", "alt": "CASE WHEN p_size % 2 = 0 THEN 'T' ELSE 'TT' END", "ancestry": "CASE l_linenumber % 4 WHEN 0 THEN 'eur' WHEN 1 THEN 'AFR' WHEN 2 THEN 'zz' END",
    "af": "CASE WHEN l_linenumber % 5 > 0 THEN cast(l_tax AS varchar(20)) END", "pval": "CASE WHEN l_linenumber % 7 > 0 THEN cast(l_discount AS varchar(20)) END", "num_samples": "cast(l_quantity AS varchar(20))", "source_file": "concat('f', cast(l_orderkey % 3 AS varchar(4)))",
}
_ANC = "CASE upper(ancestry) WHEN 'EUR' THEN 'European' WHEN 'AFR' THEN 'African' ELSE upper(ancestry) END"
_LT = "CASE WHEN pm_type = 'TRAIT' THEN 'TRAIT' ELSE 'CVD' END"
_LC = "coalesce(pm_cat, CASE WHEN parent_phenotype = 'Big Group' THEN 'big_group' END)"
_LONG_SQL = f"WITH {_raw_sql(_LONG)}, l AS (SELECT source_file, {_LT} AS dataset_type, gene_symbol AS gene_id, \"SNP_ID\" AS variant_id, {q.slug('phenotype_description')} AS phenotype, phenotype_key, {_LC} AS disease_category, CASE WHEN alt = 'T' THEN 'SNP' ELSE 'INDEL' END AS variation_type, {_ANC} AS grp, upper(ancestry) AS code, cast(pval AS double) AS p, cast(af AS double) AS f FROM raw LEFT JOIN {_TYPE_SQL} ON {q.slug('phenotype_description')} = pm_slug)"


@add("F1_long_merge", f"{_LONG_SQL} SELECT source_file, dataset_type, gene_id, variant_id, coalesce(phenotype_key, phenotype) AS k, min(p) AS p_value, coalesce(string_agg(DISTINCT grp, ',' ORDER BY grp), '') AS people FROM l GROUP BY ALL")
def _(s, d):
    found = ad.merged_long(ad.long_rows(_raw(s, d, _LONG), types(s)))
    m = lambda k: F.get_json_object("metadata", f"$.{k}")
    people = F.array_join(F.array_sort(F.map_keys(F.from_json(m("by_ancestry"), "map<string,string>"))), ",")
    return found.select(m("source_file").alias("source_file"), "dataset_type", "gene_id", "variant_id", F.coalesce(m("phenotype_key"), "phenotype").alias("k"), "p_value", people.alias("people"))


@add("N4_long_points", f"{_LONG_SQL} SELECT source_file, dataset_type, gene_id, variant_id, phenotype, coalesce(disease_category, '') AS disease_category, variation_type, grp AS ancestry, code AS ancestry_source_code, min(p) AS p_value, min(f) AS ancestry_af, min(phenotype_key) AS phenotype_key FROM l WHERE NOT regexp_matches(gene_id, '^[0-9]+$') GROUP BY ALL")
def _(s, d):
    found = ad.long_points(ad.long_rows(_raw(s, d, _LONG), types(s)))
    return found.select("source_file", "dataset_type", "gene_id", "variant_id", "phenotype", "disease_category", "variation_type", "ancestry", "ancestry_source_code", "p_value", "ancestry_af", "phenotype_key")


_LEGACY = {
    "MarkerID": "'m' || cast(l_partkey AS varchar(20))", "dbsnp.rsid": "CASE WHEN l_linenumber % 3 > 0 THEN 'rs' || cast(l_partkey AS varchar(20)) END", "snpeff.ann.gene_id": "CASE WHEN p_size < 3 THEN cast(p_size AS varchar(12)) ELSE p_brand END",
    "Phenotype": "o_orderpriority", "dbsnp.vartype": "CASE p_size % 3 WHEN 0 THEN 'snp' WHEN 1 THEN ' ins ' END", "snpeff.ann.effect": "p_type", "pval": "cast(l_tax AS varchar(20))", "gnomad_genome.af.af": "CASE WHEN l_linenumber % 2 = 0 THEN '0.5' END",
    "gnomad_genome.af.af_nfe": "CASE WHEN l_linenumber % 4 = 0 THEN '0.25' ELSE '.' END", "source_file": "concat('f', cast(l_orderkey % 3 AS varchar(4)))",
}
_LG = 'SELECT source_file, coalesce("dbsnp.rsid", "MarkerID") AS variant_id, "snpeff.ann.gene_id" AS gene_id, ' + q.slug('"Phenotype"') + ' AS phenotype, CASE WHEN "dbsnp.vartype" = \'snp\' THEN \'SNP\' WHEN "dbsnp.vartype" = \' ins \' THEN \'ins\' END AS variation_type, cast(pval AS double) AS p, try_cast("gnomad_genome.af.af" AS double) AS t, try_cast("gnomad_genome.af.af_nfe" AS double) AS e FROM raw'
_MANY = ", ".join(f"'{a}'" for a in ("African", "Admixed American", "Ashkenazi Jewish", "East Asian", "Finnish", "Other"))


@add(
    "N3_raw_points",
    f"WITH {_raw_sql(_LEGACY)}, r AS ({_LG}), x AS (SELECT *, 'Total' AS ancestry, t AS af FROM r UNION ALL SELECT *, 'European', e FROM r UNION ALL SELECT r.*, a, NULL FROM r, (SELECT unnest([{_MANY}]) AS a) UNION ALL SELECT *, NULL, NULL FROM r WHERE t IS NULL AND e IS NULL) "
    f"SELECT source_file, gene_id, variant_id, phenotype, ancestry, coalesce(min(CASE WHEN phenotype = '1-urgent' THEN 'heart_x' END), '') AS disease_category, min(variation_type) AS variation_type, min(p) AS p_value, min(af) AS ancestry_af FROM x WHERE regexp_matches(gene_id, '[A-Za-z]') GROUP BY source_file, gene_id, variant_id, phenotype, ancestry",
)
def _(s, d):
    found = ad.raw_points(_raw(s, d, _LEGACY), "TRAIT", types(s))
    return found.select("source_file", "gene_id", "variant_id", "phenotype", "ancestry", "disease_category", "variation_type", "p_value", "ancestry_af")


@add(
    "N2_prepared",
    f"WITH {_raw_sql(_LEGACY)} SELECT coalesce(\"dbsnp.rsid\", \"MarkerID\") AS rsid, \"snpeff.ann.gene_id\" AS gene, \"Phenotype\" AS phenotype, cast(pval AS double) AS p, CASE WHEN \"dbsnp.vartype\" = 'snp' THEN 'SNP' ELSE coalesce(trim(\"dbsnp.vartype\"), '') END AS var_class, \"MarkerID\" AS marker_id, '' AS pmid, CASE WHEN \"gnomad_genome.af.af\" IS NOT NULL THEN cast(0.5 AS double) END AS total FROM raw",
)
def _(s, d):
    found = ad.prepared(_raw(s, d, _LEGACY), "CVD", "x")
    return found.select("rsid", "gene", "phenotype", c("pval").cast("double").alias("p"), "var_class", "marker_id", "pmid", F.get_json_object("ancestry_data", "$.Total.MAF").cast("double").alias("total"))


_READY = {"dataset_type": "lower(l_linestatus)", "source_name": "' a '", "rsid": "CASE WHEN l_linenumber % 2 = 0 THEN 'rs' || cast(l_partkey AS varchar(20)) END", "marker_id": "'m1 '", "gene": "p_brand", "phenotype": "o_orderpriority", "pval": "cast(l_tax AS varchar(20))", "var_class": "messy", "source_file": "'f'"}


@add("D10_source_normalised", f"WITH {_raw_sql(_READY)} SELECT upper(dataset_type) AS dataset_type, 'a' AS source_name, coalesce(rsid, 'm1') AS variant_id, gene AS gene_id, phenotype, cast(pval AS double) AS p_value, trim(var_class) AS variation_type, '' AS study, '{{}}' AS ancestry_data_json FROM raw")
def _(s, d):
    return ad.source_normalised(_raw(s, d, _READY), "s", "r").select("dataset_type", "source_name", "variant_id", "gene_id", "phenotype", "p_value", "variation_type", "study", "ancestry_data_json")


@add("A11_row_ids", f"WITH {_raw_sql(_READY)} SELECT count(*) AS n, count(*) AS ids FROM raw")
def _(s, d):
    return ad.source_normalised(_raw(s, d, _READY), "s", "r").agg(F.count("*").alias("n"), F.count_distinct("source_row_id").alias("ids"))


@add("G2_row_ids", "SELECT count(*) AS n, count(*) AS ids FROM lineitem")
def _(s, d):
    return qa.row_ids(read(s, d, "lineitem"), "s", "r").agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("ids"))


@add("I8_concatenated_sources", f"WITH {_raw_sql(_PREP)} SELECT count(*) * 2 AS n FROM raw WHERE NOT regexp_matches(gene, '^[0-9]+$')")
def _(s, d):
    table = _raw(s, d, _PREP)
    sources = [{"adapter": "legacy_csv", "paths": p, "params": {"dataset_id": p}} for p in ("a", "b")]
    return ad.ingest(s, sources, read=lambda *_: table).agg(F.count("*").alias("n"))


# structural variants: orders as variants, parts as genes
def _variants(s: SparkSession, d: str) -> DataFrame:
    v = intervals(s, d)[0].join(read(s, d, "orders"), c("variant") == c("o_orderkey"))
    return v.select(F.concat(F.lit("sv"), (c("variant") % 500).cast("string")).alias("variant_id"), c("o_orderstatus").alias("study_id"), c("v_chrom").cast("string").alias("chrom"), c("v_start").alias("start"), c("v_end").alias("end"), F.lit("cnv").alias("variant_type"), F.array("o_orderpriority").alias("phenotypes"), F.lit(None).cast("string").alias("clinical_significance"), F.lit("g38").alias("assembly_name"))


def _genes(s: SparkSession, d: str) -> DataFrame:
    g = intervals(s, d)[1]
    return g.select(F.concat(F.lit("G"), (c("gene") % 90).cast("string")).alias("gene_id"), F.concat(F.lit("S"), c("gene").cast("string")).alias("gene_stable_id"), c("g_chrom").cast("string").alias("chrom"), c("g_start").alias("start"), c("g_end").alias("end"), F.lit(1).alias("strand"), F.lit("coding").alias("biotype"))


_SEED = [(f"G{i}", f"{i}-{i + 9}", -1, "seeded", None) for i in range(0, 90, 7)]


def _folded(s: SparkSession, d: str) -> DataFrame:
    seed = s.createDataFrame(_SEED, "gene_id string, gene_location string, strand long, biotype string, canonical_transcript string")
    annotation = _genes(s, d).where(c("start") % 2 == 0).select("gene_stable_id", "start", c("end") + 1, "strand", F.lit("annotated").alias("biotype"), F.lit(None).cast("string").alias("canonical_transcript")).toDF("gene_stable_id", "start", "end", "strand", "biotype", "canonical_transcript")
    return sv.build(_variants(s, d), _genes(s, d), seed, annotation, ("urgent", "low"))[0]


def stored_folded(s: SparkSession, d: str) -> DataFrame:
    """`_folded` written once and read back: a merge takes each of its tables twice, and would make the overlaps anew each time."""
    return stored(_folded(s, d), "folded")


_SV = (
    f"{INTERVALS_SQL}, h AS (SELECT 'G' || (gene % 90) AS gene_id, 'sv' || (variant % 500) AS variant_id, o_orderstatus AS study_id, v_start, v_end, g_start FROM v JOIN g ON v_chrom = g_chrom AND v_start <= g_end AND g_start <= v_end JOIN orders ON variant = o_orderkey WHERE regexp_matches(lower(o_orderpriority), 'urgent|low')), "
    "u AS (SELECT DISTINCT gene_id, variant_id, study_id, v_start, v_end FROM h)"
)


@add("N7_structural_build", f"{_SV} SELECT gene_id, count(*) AS n, string_agg(variant_id, ',' ORDER BY v_start, v_end, variant_id, study_id) AS variants, bool_or(cast(substr(gene_id, 2) AS int) % 7 = 0) AS seeded FROM u GROUP BY ALL")
def _(s, d):
    return _folded(s, d).select("gene_id", F.size("variants").cast("bigint").alias("n"), F.array_join(F.transform("variants", lambda v: v.variant_id), ",").alias("variants"), (c("biotype") == "seeded").alias("seeded"))


@add("F25_structural_merge", f"{_SV} SELECT gene_id, count(*) AS n FROM u GROUP BY ALL")
def _(s, d):
    whole = stored_folded(s, d)
    part = whole.withColumn("variants", F.slice("variants", 1, 3)).withColumn("biotype", F.lit(None).cast("string"))
    return sv.merge_folded(part, whole).select("gene_id", F.size("variants").cast("bigint").alias("n"))


@add("B7_structural_payloads", f"{_SV} SELECT gene_id, count(*) AS n FROM u GROUP BY ALL")
def _(s, d):
    return sv.gene_payloads(_folded(s, d)).select("gene_id", F.size(F.from_json("payload_json", "struct<variants:array<struct<variant_id:string>>>").variants).cast("bigint").alias("n"))


@add("E7_gene_metadata", "SELECT 'G' || (p_partkey % 90) AS gene_id, 'S' || p_partkey AS gene_stable_id, CASE WHEN p_partkey % 90 % 7 = 0 THEN (p_partkey % 90) || '-' || (p_partkey % 90 + 9) WHEN p_partkey * 750 % 2000 = 0 THEN (p_partkey * 750) || '-' || (p_partkey * 750 + p_size * 1000 + 1) ELSE (p_partkey * 750) || '-' || (p_partkey * 750 + p_size * 1000) END AS gene_location, CASE WHEN p_partkey % 90 % 7 = 0 THEN 'seeded' WHEN p_partkey * 750 % 2000 = 0 THEN 'annotated' ELSE 'coding' END AS biotype FROM part")
def _(s, d):
    seed = s.createDataFrame(_SEED, "gene_id string, gene_location string, strand long, biotype string, canonical_transcript string")
    genes = _genes(s, d)
    annotation = genes.where(c("start") % 2000 == 0).select("gene_stable_id", "start", (c("end") + 1).alias("end"), "strand", F.lit("annotated").alias("biotype"), F.lit(None).cast("string").alias("canonical_transcript"))
    return sv.gene_metadata(genes, seed, annotation).select("gene_id", "gene_stable_id", "gene_location", "biotype")


_EXON_CASE = "CASE WHEN p_size % 4 = 0 THEN '[]' WHEN p_size % 4 = 1 THEN concat('[{\"id\":\"T', cast(p_partkey AS varchar(20)), '.3\",\"Exon\":[{\"start\":1}]}]') ELSE concat('[{\"id\":\"T', cast(p_partkey AS varchar(20)), '.3\",\"note\":\"n\"}]') END"


@add(
    "N8_exon_backfill",
    f"WITH x AS (SELECT p_partkey, {_EXON_CASE} AS t FROM part), e AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY ALL) SELECT p_partkey AS gene_id, coalesce(CASE WHEN p_size % 4 > 1 THEN e.n END, json_array_length(x.t, '$[0].Exon'), 0) AS exons, CASE WHEN p_size % 4 > 1 THEN 'n' END AS note FROM part JOIN x USING (p_partkey) LEFT JOIN e ON l_partkey = p_partkey",
)
def _(s, d):
    payloads = read(s, d, "part").selectExpr("p_partkey AS gene_id", f"{_EXON_CASE} AS canonical_transcript")
    exons = read(s, d, "lineitem").selectExpr("cast(l_partkey AS string) AS gene_id", "concat('T', cast(l_partkey AS string), '.1') AS transcript_id", "l_linenumber AS exon_number", "l_orderkey AS start", "l_orderkey + 5 AS end")
    out = sv.backfill(payloads, exons)[0]
    count = F.size(F.get(F.from_json("canonical_transcript", "array<struct<Exon:array<struct<start:bigint>>>>"), F.lit(0)).Exon)
    return out.select("gene_id", F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)).cast("bigint").alias("exons"), F.get_json_object("canonical_transcript", "$[0].note").alias("note"))


@add("E14_patch_counts", "SELECT count(*) AS patch_genes, count(*) FILTER (p_size < 40 AND p_size % 2 = 0) AS applied_genes, count(*) FILTER (p_size >= 40) AS missing_genes, count(*) FILTER (p_size < 40 AND p_size % 2 = 1) AS skipped_genes FROM part")
def _(s, d):
    p = read(s, d, "part")
    patch = p.select(c("p_partkey").alias("gene_id"), F.when(c("p_size") % 2 == 0, '[{"id":"T"}]').otherwise("[]").alias("canonical_transcript"))
    return sv.apply_patch(p.where("p_size < 40").select(c("p_partkey").alias("gene_id"), F.lit("[]").alias("canonical_transcript")), patch)[1]


@add("H6_patch_candidates", "SELECT p_partkey AS gene_id FROM part WHERE p_size % 4 <> 1 ORDER BY p_partkey LIMIT 50")
def _(s, d):
    return sv.patch_candidates(read(s, d, "part").selectExpr("p_partkey AS gene_id", f"{_EXON_CASE} AS canonical_transcript"), limit=50).select("gene_id")


# protein features
_HINT = {"protein_id": "CASE p_size % 3 WHEN 0 THEN concat('NM_', cast(l_suppkey AS varchar(20)), '.2') ELSE concat('T', lpad(cast(l_partkey AS varchar(20)), 10, '0'), '.1') END", "length_aa": "CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber * 10 ELSE 0 END"}


@add("F17_isoform_hints", f"WITH {_raw_sql(_HINT)} SELECT protein_id, count(*) AS row_count, cast(max(CASE WHEN length_aa > 0 THEN length_aa END) AS bigint) AS length_aa FROM raw GROUP BY ALL")
def _(s, d):
    return protein.isoform_hints(_raw(s, d, _HINT)).withColumn("length_aa", c("length_aa").cast("bigint"))


def _xrefs(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "supplier").select(F.concat(F.lit("NM_"), c("s_suppkey").cast("string"), F.when(c("s_suppkey") % 2 == 0, ".2").otherwise("")).alias("name"), F.concat(F.when(c("s_suppkey") % 5 == 0, "X").otherwise("ENST"), c("s_suppkey").cast("string"), F.lit(".7")).alias("id"))


@add("E16_refseq_hints", f"WITH {_raw_sql(_HINT)}, h AS (SELECT DISTINCT protein_id FROM raw WHERE starts_with(protein_id, 'NM_')) SELECT protein_id, 'ENST' || s_suppkey AS transcript_id FROM h JOIN supplier ON protein_id = 'NM_' || s_suppkey || '.2' WHERE s_suppkey % 5 <> 0")
def _(s, d):
    return protein.hinted_transcripts(_raw(s, d, _HINT).select("protein_id").distinct(), _xrefs(s, d))


@add("D12_coding_transcripts", f"{TRANSCRIPT_SQL} SELECT transcript_id FROM transcripts WHERE biotype = 'protein_coding' AND span % 3 > 0")
def _(s, d):
    return protein.coding_transcripts(transcripts(s, d).withColumn("translation_id", F.when(c("span") % 3 > 0, c("transcript_id")))).select("transcript_id")


def _features(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(c("p_type").alias("transcript_id"), c("p_size").cast("string").alias("begin"), F.when(c("p_size") > 3, (c("p_partkey") % 40).cast("string")).alias("end"), F.lower("p_type").alias("type"), c("p_name").alias("description"), c("p_brand").alias("accession"))
    return protein.ebi_features(p)


@add("J7_feature_shape", "SELECT p_type AS transcript_id, least(p_size, p_partkey % 40) AS start, greatest(p_size, p_partkey % 40) AS end_, p_name AS label, lower(p_type) AS type, p_brand AS accession FROM part WHERE p_size > 3")
def _(s, d):
    return _features(s, d).select("transcript_id", "start", c("end").alias("end_"), "label", "type", "accession")


@add("C37_feature_range", "SELECT p_partkey, CASE WHEN p_size > 3 THEN least(p_size, p_partkey % 40) END AS start, CASE WHEN p_size > 3 THEN greatest(p_size, p_partkey % 40) END AS end_ FROM part")
def _(s, d):
    text = lambda e: F.expr(f"cast({e} AS string)")
    return read(s, d, "part").select("p_partkey", fn.feature_range(F.lit("?"), text("p_size"), ends=(F.lit(""), F.when(c("p_size") > 3, text("p_partkey % 40")))).alias("r")).select("p_partkey", "r.start", c("r.end").alias("end_"))


_CLASS = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(t, '{w}')" for w in ws) + f" THEN '{n}'" for n, ws in fn.FEATURE_CLASSES) + " ELSE 'other_features' END"


@add("F30_feature_groups", f"WITH f AS (SELECT DISTINCT p_type, least(p_size, p_partkey % 40) AS a, greatest(p_size, p_partkey % 40) AS b, p_brand FROM part WHERE p_size > 3) SELECT p_type AS transcript_id, count(*) AS n FROM f GROUP BY ALL")
def _(s, d):
    found = protein.grouped_features(_features(s, d))
    return found.select("transcript_id", sum((F.size(g) for g in protein.GROUPS), F.lit(0)).cast("bigint").alias("n"))


_NEST = (
    "concat('{\"metadata\":{\"accession\":\"', p_brand, '\",\"type\":\"domain\"},\"proteins\":[{\"entry_protein_locations\":[{\"fragments\":[{\"start\":', cast(p_size AS varchar(12)), ',\"end\":', cast(p_size + 9 AS varchar(12)), '},{\"start\":5,\"end\":2}]}]}],\"fragments\":[{\"start\":5,\"end\":2},{\"start\":7}]}')"
)


@add("J5_nested_fragments", "SELECT DISTINCT p_type AS transcript_id, p_brand AS accession, p_size AS start, p_size + 9 AS end_ FROM part UNION SELECT p_type, p_brand, 2, 5 FROM part")
def _(s, d):
    entries = read(s, d, "part").selectExpr("p_type AS transcript_id", f"{_NEST} AS entry")
    return protein.entry_fragments(entries).select("transcript_id", "accession", c("start").cast("int").alias("start"), c("end").cast("int").alias("end_"))


@add("J6_tree_rows", "SELECT n_nationkey, d.* FROM nation, (VALUES ('CVD', 'heart', 1, false), ('CVD', '1-urgent', 2, true), ('CVD', 'vessel', 1, false), ('CVD', 'large', 2, false), ('CVD', '2-high', 3, true), ('CVD', 'small', 2, false), ('CVD', '3-medium', 3, true), ('TRAIT', 'general', 1, false), ('TRAIT', '4-not_specified', 2, true), ('TRAIT', 'low', 2, false), ('TRAIT', '5-low', 3, true)) AS d(dataset_type, name, depth, is_leaf) WHERE n_nationkey % 2 = CASE WHEN dataset_type = 'CVD' THEN 0 ELSE 1 END")
def _(s, d):
    kinds = read(s, d, "nation").select("n_nationkey", F.when(c("n_nationkey") % 2 == 0, "CVD").otherwise("TRAIT").alias("dataset_type"))
    return kinds.join(paths.tree_rows(s, TREE).drop("path"), "dataset_type").select("n_nationkey", "dataset_type", "name", "depth", "is_leaf")


@add("N12_protein_context", f"{TRANSCRIPT_SQL}, k AS (SELECT * FROM transcripts WHERE biotype = 'protein_coding' AND span % 3 > 0), i AS (SELECT *, (hinted OR is_canonical OR gencode_primary) AS chosen, bool_or(hinted OR is_canonical OR gencode_primary) OVER (PARTITION BY gene_id) AS has_chosen, row_number() OVER (PARTITION BY gene_id ORDER BY ord, transcript_id) AS o FROM (SELECT * REPLACE (transcript_id IN (SELECT 'T' || lpad(cast(p_partkey AS varchar), 10, '0') FROM part WHERE p_partkey % 19 = 0) AS hinted) FROM k)) SELECT gene_id, least(count(*), 12) AS n FROM i WHERE chosen OR (NOT has_chosen AND o <= 12) GROUP BY ALL")
def _(s, d):
    rows = transcripts(s, d).withColumn("translation_id", F.when(c("span") % 3 > 0, c("transcript_id"))).drop("hinted")
    hints = read(s, d, "part").where("p_partkey % 19 = 0").select(F.concat(F.lit("T"), F.lpad(c("p_partkey").cast("string"), 10, "0"), F.lit(".4")).alias("protein_id"), F.lit(7).cast("bigint").alias("length_aa"))
    found = protein.protein_context(rows, hints, _xrefs(s, d), _features(s, d))
    return found.select("gene_id", F.size(F.from_json("payload_json", "struct<isoforms:array<struct<transcript_id:string>>>").isoforms).cast("bigint").alias("n"))


# serving, secondary analyses
def _payloads(s: SparkSession, d: str) -> dict[str, DataFrame]:
    body = F.lit('[{"disease":["a"],"vc":[{"name":"SNP","value":1}],"ancestry":[{"name":"x","data":[]}]}]')
    rows = points(s, d).groupBy("dataset_type", "gene_id").agg(F.min("source_file").alias("f"))
    rows = rows.withColumn("source_path", F.concat(F.lit("/old/final/association/"), "dataset_type", F.lit("/"), "f"))
    return {"association": rows.where("dataset_type = 'CVD'").select("dataset_type", "gene_id", body.alias("payload_json"), "source_path"), "overall": rows.select("dataset_type", "gene_id", F.lit('{"data":{"vc":{"SNP":2},"ancestry":{"x":{}}},"pvals":{}}').alias("payload_json"), "source_path")}


_PAIRS = "SELECT dataset_type, gene_id, min(source_file) AS f FROM points GROUP BY ALL"


@add("N9_serving_catalog", f"{SQL}, t AS ({_PAIRS}), x AS (SELECT upper(p_brand) AS g FROM part WHERE p_size > 45) SELECT upper(trim(gene_id)) AS gene_id_normalized, bool_or(dataset_type = 'CVD') AS has_cvd, bool_or(dataset_type = 'TRAIT') AS has_trait, bool_or(dataset_type = 'CVD') AS has_cvd_association, bool_or(dataset_type = 'TRAIT') AS has_trait_overall, upper(trim(gene_id)) IN (SELECT g FROM x) AS has_expression FROM t GROUP BY ALL")
def _(s, d):
    extra = {"expression": serving.secondary_rows(read(s, d, "part").where("p_size > 45").select(c("p_brand").alias("gene_id"), F.lit("{}").alias("payload_json")))}
    found = serving.build(_payloads(s, d), extra)["gene_catalog"]
    return found.select("gene_id_normalized", "has_cvd", "has_trait", "has_cvd_association", "has_trait_overall", "has_expression")


@add("B8_serving_counts", f"{SQL}, t AS ({_PAIRS}) SELECT 'association_gene_payloads' AS table_name, count(*) FILTER (dataset_type = 'CVD') AS row_count FROM t UNION ALL SELECT 'overall_gene_payloads', count(*) FROM t UNION ALL SELECT 'association_summary_payloads', count(*) FILTER (dataset_type = 'CVD') FROM t UNION ALL SELECT 'overall_summary_payloads', count(*) FROM t UNION ALL SELECT 'gene_catalog', count(DISTINCT upper(trim(gene_id))) FROM t")
def _(s, d):
    return serving.build(_payloads(s, d))["build_metadata"].select("table_name", "row_count")


@add("C36_summary", f"{SQL}, t AS ({_PAIRS}) SELECT dataset_type, gene_id, false AS has_ancestry, 2 AS snps FROM t")
def _(s, d):
    found = serving.summaries(serving.serving_rows(_payloads(s, d)["overall"]), "overall")
    return found.select("dataset_type", "gene_id", F.contains("payload_json", F.lit("ancestry")).alias("has_ancestry"), F.get_json_object("payload_json", "$.data.vc.SNP").cast("int").alias("snps"))


@add("B13_slim_serving", f"{SQL}, t AS ({_PAIRS}) SELECT gene_id, dataset_type, '/new/root/association/' || dataset_type || '/' || f AS source_path, true AS empty FROM t")
def _(s, d):
    found = serving.slim(serving.serving_rows(_payloads(s, d)["overall"]), "/new/root/")
    return found.select("gene_id", "dataset_type", "source_path", c("payload_json").isNull().alias("empty"))


@add("L4_pending_summaries", f"{SQL}, t AS ({_PAIRS}) SELECT dataset_type, gene_id FROM t WHERE dataset_type = 'TRAIT' ORDER BY dataset_type, upper(trim(gene_id)) LIMIT 9")
def _(s, d):
    rows = serving.serving_rows(_payloads(s, d)["overall"])
    return serving.pending_summaries(rows, rows.where("dataset_type = 'CVD'"), "overall", 9).select("dataset_type", "gene_id")


_ENTRY_TEXT = "CASE p_size % 3 WHEN 0 THEN concat('{\"regulation\": {\"upregulated\": ', cast(p_size AS varchar(12)), ', \"downregulated\": NaN}}') WHEN 1 THEN concat('{\"dcm\": {\"upregulated\": ', cast(p_size AS varchar(12)), '}, \"hcm\": 4}') ELSE '{}' END"


@add("N10_expression", "SELECT p_name AS gene_id, upper(p_name) AS gene_id_normalized, CASE p_size % 3 WHEN 0 THEN p_size WHEN 1 THEN NULL END AS up, CASE p_size % 3 WHEN 0 THEN 0 END AS down, CASE WHEN p_size % 3 = 1 THEN p_size END AS dcm_up, CASE WHEN p_size % 3 = 1 THEN 0 END AS dcm_down, CASE WHEN p_size % 3 = 1 THEN 4 END AS hcm FROM part")
def _(s, d):
    found = serving.expression_rows(read(s, d, "part").selectExpr("p_name AS gene_id", f"{_ENTRY_TEXT} AS entry"))
    number = lambda p: F.get_json_object("payload_json", p).cast("double").cast("int")
    return found.select("gene_id", "gene_id_normalized", *[number(p).alias(n) for n, p in (("up", "$.up"), ("down", "$.down"), ("dcm_up", "$.dcm.up"), ("dcm_down", "$.dcm.down"), ("hcm", "$.hcm"))])


@add("A13_expression_map", "SELECT DISTINCT p_brand AS gene_id FROM part")
def _(s, d):
    text = read(s, d, "part").groupBy().agg(F.to_json(F.map_from_entries(F.collect_set(F.struct("p_brand", F.lit("x"))))).alias("value"))
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("gene_id", "entry")).select("gene_id")


@add("A19_gene_seed", "SELECT p_partkey AS gene_id, CASE WHEN p_size % 2 = 0 THEN p_size || '-9' END AS gene_location, cast(-1 AS bigint) AS strand FROM part")
def _(s, d):
    entries = read(s, d, "part").select(c("p_partkey").alias("key"), F.concat(F.lit('{"gene_location":"'), F.when(c("p_size") % 2 == 0, F.concat(c("p_size").cast("string"), F.lit("-9"))).otherwise(" "), F.lit('","strand":"-1","canonical_transcript":[]}')).alias("value"))
    return files.seed_fields(entries).select("gene_id", "gene_location", "strand")


@add("A15_newest_payloads", "SELECT upper(p_type) AS gene_id_normalized, max(p_partkey) FILTER (p_size % 2 = 0) AS picked FROM part GROUP BY ALL")
def _(s, d):
    rows = read(s, d, "part").select(F.when(c("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.lower("p_type")).alias("gene_id"), F.struct(c("p_size") % 2 == 0, "p_partkey").alias("zipped"), c("p_partkey").alias("payload"), F.lit("").alias("source_path"))
    return files.newest_first(rows).select("gene_id_normalized", c("payload").alias("picked"))


_SHARED = f"sv AS (SELECT DISTINCT gene_id, dataset_type, {SLUG} AS name, variant_id FROM points), b AS (SELECT gene_id, variant_id FROM sv GROUP BY ALL HAVING count(DISTINCT dataset_type) = 2)"


@add("F29_shared_artifacts", f"{SQL}, {_SHARED}, k AS (SELECT gene_id, dataset_type, name, count(*) AS n FROM sv SEMI JOIN b USING (gene_id, variant_id) GROUP BY ALL) SELECT gene_id, count(*) FILTER (dataset_type = 'CVD') AS cvd, count(*) FILTER (dataset_type = 'TRAIT') AS trait, sum(n)::bigint AS shared FROM k GROUP BY ALL")
def _(s, d):
    kind = "array<struct<name:string,shared_variant_count:bigint,variants:map<string,array<double>>>>"
    rows = serving.shared_rows(points(s, d)).select("gene_id", F.from_json("payload_json", f"struct<cvd:{kind},trait:{kind}>").alias("p"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda x, v: x + F.size(v["variants"]))
    return rows.select("gene_id", F.size("p.cvd").cast("bigint").alias("cvd"), F.size("p.trait").cast("bigint").alias("trait"), (total(c("p.cvd")) + total(c("p.trait"))).alias("shared"))


# quality and life cycle
@add("K2_profile", f"{SQL} SELECT row_key, {q.GENE} AS valid, CASE WHEN {q.GENE} THEN coalesce(variation_type, 'Unknown') ELSE variation_type END AS variation_type FROM points")
def _(s, d):
    rows = points(s, d).withColumn("gene_id", F.when(fn.is_gene(c("gene_id")), c("gene_id")))
    return qa.validate_profile(rows, "structural_variant").select("row_key", "valid", "variation_type")


@add("K2_nested_profile", f"{SQL} SELECT row_key, flag_text IS NOT NULL AS valid FROM points")
def _(s, d):
    rows = points(s, d).select("row_key", F.lit("G").alias("gene_id"), F.to_json(F.struct(c("flag_text").alias("cell_type"))).alias("metadata"))
    return qa.validate_profile(rows, "single_cell").select("row_key", "valid")


@add("F20_catalog_summary", "SELECT 'status' AS kind, o_orderstatus AS name, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'category', CASE WHEN o_orderkey % 3 = 0 THEN 'uncategorized' ELSE o_orderpriority END, count(*) FROM orders GROUP BY ALL UNION ALL SELECT 'total', 'all', count(*) FROM orders")
def _(s, d):
    return qa.catalog_summary(read(s, d, "orders").select(c("o_orderstatus").alias("integration_status"), F.when(c("o_orderkey") % 3 == 0, " ").otherwise(c("o_orderpriority")).alias("data_category")))


@add("K8_artifact_report", "SELECT 'a/' || o_orderpriority AS \"group\", count(*) AS payload_count, sum(o_custkey)::bigint AS total_bytes, 5 AS samples FROM orders GROUP BY ALL")
def _(s, d):
    rows = read(s, d, "orders").select(F.concat(F.lit("/x/final/a/"), "o_orderpriority", F.lit("/"), c("o_orderkey").cast("string")).alias("file"), c("o_custkey").alias("bytes"), F.sha2(c("o_orderkey").cast("string"), 256).alias("sha256"))
    return qa.artifact_report(rows, qa.group_of(c("file"), "/x/final")).select("group", "payload_count", "total_bytes", F.size("sample_checksums").alias("samples"))


@add("H5_sample_checksums", "SELECT o_orderpriority, string_agg(sha256(cast(o_orderkey AS varchar)), ',' ORDER BY k) AS checks FROM (SELECT *, lpad(cast(o_orderkey AS varchar), 12, '0') AS k FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY k) <= 5) GROUP BY ALL")
def _(s, d):
    rows = read(s, d, "orders").select("o_orderpriority", F.lpad(c("o_orderkey").cast("string"), 12, "0").alias("file"), F.lit(1).alias("bytes"), F.sha2(c("o_orderkey").cast("string"), 256).alias("sha256"))
    return qa.artifact_report(rows, c("o_orderpriority")).select(c("group").alias("o_orderpriority"), F.array_join(F.map_values("sample_checksums"), ",").alias("checks"))


@add("B12_table_counts", "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def _(s, d):
    return qa.table_counts({n: read(s, d, n) for n in ("orders", "part")})


@add("K5_release_tables", "SELECT 's' AS source_id, 'r1' AS release_id, 'gwas' AS modality, count(*) AS n, count(*) FILTER (NOT list_contains([event_type, 'ts', CASE WHEN user_id % 2 = 0 THEN 'user' ELSE 'guest' END], 'user')) AS breaking FROM events")
def _(s, d):
    events = read(s, d, "events")
    name = c("event_id").cast("string")
    headers = events.select(name.alias("file"), F.lit(",").alias("delimiter"), F.array(c("event_type"), F.lit("ts"), F.when(c("user_id") % 2 == 0, "user").otherwise("guest")).alias("columns"), F.lit("x").alias("fingerprint"))
    inventory = events.select(name.alias("file"), name.alias("name"), F.lit(1).alias("bytes"), F.lit("").alias("sha256"))
    drift = qa.release_tables(inventory, headers, "s", "r1", "gwas", ["ts", "user"])["drift_reports"]
    return drift.groupBy("source_id", "release_id", "modality").agg(F.count("*").alias("n"), F.count_if(c("status") == "breaking").alias("breaking"))


@add("N14_candidate_genes", f"{SQL} SELECT DISTINCT upper({q.strip('gene_id')}) AS gene_id FROM points WHERE {q.GENE}")
def _(s, d):
    return qa.candidate_genes([read(s, d, "region"), points(s, d)])


@add("D9_analysis_ready", f"{SQL} SELECT row_key, source AS source_id, 'r1' AS release_id, upper(trim(gene_id)) AS gene_id_normalized, '[]' AS phenotype_path_json, p_value FROM points")
def _(s, d):
    return rec.analysis_ready(points(s, d), "r1").select("row_key", "source_id", "release_id", "gene_id_normalized", "phenotype_path_json", "p_value")


@add("N13_lifecycle", f"WITH {_raw_sql(_READY)} SELECT upper(gene) AS gene_id_normalized, count(*) AS n FROM raw GROUP BY ALL")
def _(s, d):
    rows = ad.source_normalised(_raw(s, d, _READY), "s", "r1").withColumn("source", c("source_id"))
    return rec.analysis_ready(rows, "r1").groupBy("gene_id_normalized").agg(F.count("*").alias("n"))


@add("L3_staged_publish", f"{SQL}, {q.G1}, {q.axes('dataset_type, gene_id', 'kept')}")
def _(s, d):
    from allelix.streaming.ingest import refresh_genes

    kept = rec.dedup_by_source(rec.core_keys(points(s, d)), PRIORITY)
    old = ag.aggregate_variants(kept.where(_TWO[0]), pub.GENE)
    return refresh_genes(kept, kept.where(_TWO[1]), old)


_POINT = ["dataset_type", "gene_id", "phenotype", "ancestry", "variant_id"]
_HALF = "SELECT dataset_type, gene_id, phenotype, ancestry, variant_id, ancestry_af AS value FROM points WHERE {} QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, phenotype, ancestry, variant_id ORDER BY ingested_at DESC, row_key DESC) = 1"


@add("F22_merge_ancestry", f"{SQL}, o AS ({_HALF.format(_TWO[0])}), n AS ({_HALF.format(_TWO[1])}) SELECT {', '.join(_POINT)}, coalesce(n.value, o.value) AS value FROM o FULL JOIN n USING ({', '.join(_POINT)})")
def _(s, d):
    return ag.merge_ancestry(*[ag.ancestry_points(points(s, d).where(w), _POINT[:3]) for w in _TWO], _POINT)


_ATTRIBUTES = "concat('gene_id \"', p_brand, '.3\"; tag \"a', cast(p_size AS varchar(12)), '\"; exon_number ', cast(p_size AS varchar(12)), '; tag \"b\";')"


@add("C22_gtf_attributes", "SELECT p_partkey, p_brand || '.3' AS gene_id, 'a' || p_size || ',b' AS tags, cast(p_size AS varchar) AS exon_number FROM part")
def _(s, d):
    rows = read(s, d, "part").selectExpr("p_partkey", f"{_ATTRIBUTES} AS a").select("p_partkey", fn.gtf_attributes(c("a")).alias("m"))
    return rows.select("p_partkey", c("m")["gene_id"][0].alias("gene_id"), F.array_join(c("m")["tag"], ",").alias("tags"), c("m")["exon_number"][0].alias("exon_number"))


@add("C41_adapter_metadata", f"WITH {_raw_sql(_WIDE)} SELECT coalesce(\"rsID\", variation_id) AS variant_id, source_file FROM raw")
def _(s, d):
    return ad.wide_populations(_raw(s, d, _WIDE), types(s)).select("variant_id", F.get_json_object("metadata", "$.source_file").alias("source_file"))


@add("N1_ingestion", f"WITH {_raw_sql(_PREP)}, r AS (SELECT gene AS gene_id, rsid AS variant_id, {q.slug('phenotype')} AS phenotype, coalesce(pm_type, 'CVD') AS dataset_type, {q.clean('var_class')} AS variation_type FROM raw LEFT JOIN {_TYPE_SQL} ON {q.slug('phenotype')} = pm_slug WHERE NOT regexp_matches(gene, '^[0-9]+$')) SELECT dataset_type, gene_id, variant_id, phenotype, coalesce(variation_type, 'Unknown') AS variation_type, 'African' AS ancestry FROM r")
def _(s, d):
    from allelix.plans import ingestion

    table = _raw(s, d, _PREP)
    records = ingestion.validated(ad.ingest(s, [{"adapter": "legacy_csv", "paths": "x"}], types(s), lambda *_: table))
    return ingestion.canonical_points(records).select("dataset_type", "gene_id", "variant_id", "phenotype", "variation_type", "ancestry")
