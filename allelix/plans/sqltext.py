"""SQL that says what the scalar functions and the shared steps do, for the oracles."""

from __future__ import annotations

from allelix.functions import text as fn
from allelix.plans.points import PRIORITY

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean(x: str, more: str = "") -> str:
    return f"CASE WHEN lower({strip(x)}) NOT IN ('', 'nan', 'none', 'null', 'na'{more}) THEN {strip(x)} END"


def number(x: str) -> str:
    return f"CASE WHEN NOT isnan(try_cast({strip(x)} AS double)) THEN try_cast({strip(x)} AS double) END"


def slug(x: str) -> str:
    return f"lower(regexp_replace(replace({strip(x)}, '/', '_'), '\\s+', '_', 'g'))"


def label(x: str) -> str:
    quotes = "^[\"'']+|[\"'']+$"
    return f"trim(regexp_replace(replace(regexp_replace({strip(x)}, '{quotes}', '', 'g'), '_', ' '), '\\s+', ' ', 'g'))"


UNKNOWN = ", ".join(f"'{u}'" for u in fn.UNKNOWN)


def unknown(x: str) -> str:
    return f"({x} IS NULL OR lower({label(x)}) IN ({UNKNOWN}))"


def variation(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fn.VARIATIONS.items())
    return f"CASE WHEN NOT {unknown(x)} THEN CASE lower({label(x)}) {cases} ELSE {label(x)} END END"


def consequence(x: str) -> str:
    return f"CASE WHEN NOT {unknown(x)} THEN lower({label(x)}) END"


def significance(x: str) -> str:
    item = fn.LIST_ITEM.replace("'", "''")
    items = f"CASE WHEN starts_with({strip(x)}, '[') AND ends_with({strip(x)}, ']') THEN regexp_extract_all({strip(x)}, '{item}') ELSE [{x}] END"
    rank = "CASE i " + " ".join(f"WHEN '{s}' THEN '{n:02d}'" for n, s in enumerate(fn.SIGNIFICANCE, 1)) + " ELSE '20' END"
    return f"CASE WHEN NOT {unknown(x)} THEN substr(list_min(list_transform(list_filter(list_transform({items}, lambda j: lower({label('j')})), lambda i: i NOT IN ({UNKNOWN})), lambda i: {rank} || i)), 3) END"


GENE = f"coalesce(regexp_matches({clean('gene_id')}, '[A-Za-z]'), false)"
RANK = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(PRIORITY)) + " ELSE 999999 END"
BEST = f"{RANK}, p_value IS NULL, p_value, ingested_at DESC, source, row_key"


BLANKS = ", ".join(f"nullif(trim({x}), '') AS {x}" for x in ("variation_type", "clinical_significance", "most_severe_consequence", "ancestry", "ancestry_source_code", "ancestry_source_label", "phenotype_key"))
NORM = f"upper(trim(dataset_type)) AS dataset_type, trim(gene_id) AS gene_id, trim(variant_id) AS variant_id, {slug('phenotype')} AS phenotype, coalesce(trim(disease_category), '') AS disease_category, {BLANKS}"


def g1(source: str = "points") -> str:
    parts = "PARTITION BY dataset_type, gene_id, variant_id, phenotype, coalesce(ancestry_source_code, ancestry)"
    return f"norm AS (SELECT * REPLACE ({NORM}) FROM {source} WHERE {GENE}), kept AS (SELECT * FROM norm QUALIFY row_number() OVER ({parts} ORDER BY {BEST}) = 1)"


G1 = g1()


def axes(scope: str, source: str, unknown: bool = False) -> str:
    best = f"best AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {scope}, variant_id ORDER BY p_value IS NULL, p_value, row_key) = 1)"
    parts = " UNION ALL ".join(f"SELECT {scope}, '{a}' AS axis, {e} AS name FROM best" for a, e in (("vc", variation("variation_type")), ("msc", consequence("most_severe_consequence")), ("cs", significance("clinical_significance"))))
    name = "coalesce(name, 'Unknown') AS name" if unknown else "name"
    return f"{best} SELECT {scope}, axis, {name}, count(*) AS value FROM ({parts})" + ("" if unknown else " WHERE name IS NOT NULL") + " GROUP BY ALL"
