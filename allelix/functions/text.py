"""Scalar functions on Columns: cleaning, labels, identifiers. All are built-in expressions, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which labels are unknown, canonical or first.
NULL_TOKENS = ("", "nan", "none", "null", "na")
UNKNOWN = ("", "na", "n/a", "nan", "none", "null", "unknown", "missing", "not available", "not provided", "not specified", "unspecified")
VARIATIONS = {
    "snp": "SNP", "snv": "SNV", "indel": "INDEL", "insertion": "Insertion", "deletion": "Deletion", "duplication": "Duplication",
    "inversion": "Inversion", "cnv": "CNV", "copy number variant": "CNV", "structural variant": "Structural variant", "sv": "SV", "mnv": "MNV",
}
SIGNIFICANCE = (
    "pathogenic", "pathogenic/likely pathogenic", "likely pathogenic", "risk factor", "association", "drug response",
    "conflicting interpretations of pathogenicity", "uncertain significance", "likely benign", "benign", "benign/likely benign", "other", "protective",
)
ANCESTRIES = {
    "ALL": "Total", "AFR": "African", "AMR": "Admixed American", "ASJ": "Ashkenazi Jewish", "EAS": "East Asian", "EUR": "European",
    "FIN": "Finnish", "SAS": "South Asian", "OTH": "Other",
}

#: An item of a list written as text: quoted, or a run without quote, comma and bracket.
LIST_ITEM = r"""'[^']*'|"[^"]*"|[^,'"\[\]]+"""


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


#: White space as regular expressions take it.
BLANKS = " \t\n\x0b\f\r"


def strip(x: Column) -> Column:
    """Without white space around, of any kind. No regular expression: this runs for every key of every row."""
    return F.btrim(x, F.lit(BLANKS))


def clean_string(x: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Stripped; null for tokens that mean nothing."""
    bare = strip(x.cast("string"))
    return F.when(~F.lower(bare).isin(*tokens), bare)


def to_float(x: Column) -> Column:
    """A double; null on failure and for NaN."""
    value = strip(x.cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_int(x: Column) -> Column:
    """The whole part of a number."""
    return to_float(x).try_cast("bigint")


def to_bool(x: Column) -> Column:
    bare = F.lower(strip(x.cast("string")))
    return F.when(bare.isin("true", "1", "yes"), F.lit(True)).when(bare.isin("false", "0", "no"), F.lit(False))


def parse_ci(x: Column) -> Column:
    """struct<lower, upper, raw> of "low,high"; raw alone if it is not a pair of numbers."""
    parts = F.split(clean_string(x), ",")
    low, high = to_float(F.get(parts, F.lit(0))), to_float(F.get(parts, F.lit(1)))
    pair = (F.size(parts) == 2) & low.isNotNull() & high.isNotNull()
    return F.struct(F.when(pair, low).alias("lower"), F.when(pair, high).alias("upper"), F.when(~F.coalesce(pair, F.lit(False)), clean_string(x)).alias("raw"))


def slug(x: Column) -> Column:
    return F.lower(F.regexp_replace(F.replace(strip(x), F.lit("/"), F.lit("_")), r"\s+", "_"))


def text_label(x: Column) -> Column:
    """Stripped, without quotes around, underscores and runs of white space as one space."""
    bare = F.regexp_replace(strip(x), "^[\"']+|[\"']+$", "")
    return strip(F.regexp_replace(F.replace(bare, F.lit("_"), F.lit(" ")), r"\s+", " "))


def is_unknown(x: Column) -> Column:
    return x.isNull() | F.lower(text_label(x)).isin(*UNKNOWN)


def variation_label(x: Column) -> Column:
    label = text_label(x)
    return F.when(~is_unknown(x), F.coalesce(F.element_at(literal_map(VARIATIONS), F.lower(label)), label))


def consequence_label(x: Column) -> Column:
    return F.when(~is_unknown(x), F.lower(text_label(x)))


def significance_label(x: Column) -> Column:
    """The most severe known label of a value that may be a list written as text; ties by name.

    An item of a list may be quoted, and a comma inside the quotes belongs to it.
    """
    bare = strip(x)
    listed = bare.startswith("[") & bare.endswith("]")
    items = F.when(listed, F.regexp_extract_all(bare, F.lit(LIST_ITEM), F.lit(0))).otherwise(F.array(bare))
    ranks = literal_map({s: i for i, s in enumerate(SIGNIFICANCE, 1)})
    known = F.filter(F.transform(items, lambda i: F.lower(text_label(i))), lambda i: ~i.isin(*UNKNOWN))
    ranked = F.transform(known, lambda i: F.struct(F.coalesce(F.element_at(ranks, i), F.lit(20)).alias("rank"), i.alias("label")))
    return F.when(~is_unknown(x), F.array_min(ranked)["label"])


def axis_label(x: Column, axis: str) -> Column:
    return {"variation": variation_label, "clinical_significance": significance_label, "most_severe_consequence": consequence_label}.get(axis, lambda c: F.when(~is_unknown(c), text_label(c)))(x)


def is_gene(x: Column) -> Column:
    """A token with a letter; numbers and null words that leak into gene columns are not."""
    return F.coalesce(clean_string(x).rlike("[A-Za-z]"), F.lit(False))


def ancestry_code(code: Column) -> Column:
    """The code in upper case; null if it is blank."""
    return F.nullif(F.upper(strip(code)), F.lit(""))


def ancestry_label(code: Column, overrides: dict[str, str | tuple[str, str]] | None = None) -> Column:
    """The source's label of a code; an unknown code stays, in upper case. An override is one text or (label, group)."""
    own = {k: v if isinstance(v, str) else v[0] for k, v in (overrides or {}).items()}
    return F.coalesce(F.element_at(literal_map(ANCESTRIES | own), ancestry_code(code)), ancestry_code(code))


def ancestry_group(code: Column, overrides: dict[str, str | tuple[str, str]] | None = None) -> Column:
    """The canonical group of a code; an unknown code stays, in upper case. An override is one text or (label, group)."""
    own = {k: v if isinstance(v, str) else v[1] for k, v in (overrides or {}).items()}
    return F.coalesce(F.element_at(literal_map(ANCESTRIES | own), ancestry_code(code)), ancestry_code(code))


def round_ancestry(value: Column, digits: int) -> Column:
    """A number rounded to `digits`, as text; what is no number stays as it is."""
    return F.coalesce(F.round(to_float(value), digits).cast("string"), value.cast("string"))


def parse_ancestry(text: Column) -> Column:
    """map<string, string> of JSON {population: value} or {population: {"MAF" | "maf" | "value": value}}; null words are left out."""
    entries = F.map_entries(F.from_json(text, "map<string,string>"))
    inner = lambda v: F.coalesce(*[F.get_json_object(v, f"$.{k}") for k in ("MAF", "maf", "value")])
    plain = F.transform(entries, lambda e: F.struct(e.key.alias("key"), F.when(e.value.startswith("{"), inner(e.value)).otherwise(e.value).alias("value")))
    return F.map_from_entries(F.filter(plain, lambda e: clean_string(e.value, ("", "nan", "none", "null")).isNotNull()))


def ancestry_json(columns: dict[str, Column], change: Column, digits: int | None = None) -> Column:
    """JSON {label: {"change", "MAF"}} of the columns that hold numbers, by label."""
    shown = lambda v: to_float(v) if digits is None else F.round(to_float(v), digits)
    items = [F.struct(F.lit(label).alias("key"), F.struct(F.coalesce(change, F.lit("")).alias("change"), shown(columns[label]).alias("MAF")).alias("value")) for label in sorted(columns)]
    return F.to_json(F.map_from_entries(F.filter(F.array(*items), lambda e: e.value.MAF.isNotNull())))


def first_given(*columns: Column, default: str | None = None) -> Column:
    """The first of the columns that is not blank, cleaned, else the default."""
    return F.coalesce(*[clean_string(c) for c in columns], F.lit(default))


def nested_json(targets: dict[str, Column]) -> Column:
    """JSON with each value at its dotted target; blank values, and branches without any value, are left out. Null without any value."""
    def build(items: dict[tuple[str, ...], Column]) -> Column:
        heads: dict[str, dict[tuple[str, ...], Column]] = {}
        for path, value in items.items():
            heads.setdefault(path[0], {})[path[1:]] = value
        given = lambda v: F.nullif(strip(v.cast("string")), F.lit(""))
        fields = {h: given(rest[()]) if () in rest else build(rest) for h, rest in heads.items()}
        some = F.coalesce(*[F.when(f.isNotNull(), F.lit(True)) for f in fields.values()], F.lit(False))
        return F.when(some, F.struct(*[f.alias(h) for h, f in fields.items()]))

    return F.to_json(build({tuple(k.split(".")): v for k, v in targets.items()}))


def infer_variation(ref: Column, alt: Column) -> Column:
    a, b = clean_string(ref), clean_string(alt)
    return F.when(a.isNotNull() & b.isNotNull(), F.when((F.length(a) == 1) & (F.length(b) == 1), "SNP").otherwise("INDEL"))


def allele_string(ref: Column, alt: Column) -> Column:
    a, b = clean_string(ref), clean_string(alt)
    return F.when(a.isNotNull() & b.isNotNull(), F.concat_ws("/", a, b))


def derive_rsid(rsid: Column, marker: Column) -> Column:
    """The given id, else a marker that begins with rs, else what stands before its first hyphen."""
    m = clean_string(marker)
    return F.coalesce(clean_string(rsid), F.when(m.startswith("rs"), m), F.get(F.split(m, "-"), F.lit(0)))


def dataset_type_of(path: Column, mapped: Column) -> Column:
    up = F.upper(path)
    forced = F.when(F.upper(mapped).isin("CVD", "TRAIT"), F.upper(mapped)).otherwise("CVD")
    return F.when(F.contains(up, F.lit("TRAIT")), "TRAIT").when(F.contains(up, F.lit("DISEASE")) | F.contains(up, F.lit("CVD")), "CVD").otherwise(forced)


def chromosome(x: Column) -> Column:
    bare = F.regexp_replace(strip(x), "(?i)^chr", "")
    return F.coalesce(to_int(bare).cast("string"), bare)


def first_coordinate(*columns: Column) -> Column:
    return F.coalesce(*[to_int(c) for c in columns])


def region(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def without_version(x: Column) -> Column:
    return F.substring_index(strip(x), ".", 1)


def strand(x: Column) -> Column:
    return F.when(strip(x) == "+", 1).when(strip(x) == "-", -1)


def phenotype_list(x: Column) -> Column:
    """Parts between semicolons, cleaned, each once in order."""
    return F.array_distinct(F.filter(F.transform(F.split(x, ";"), lambda p: clean_string(p, (*NULL_TOKENS, "n/a"))), lambda p: p.isNotNull()))


def variant_type(call: Column, region_type: Column) -> Column:
    return F.lower(F.coalesce(clean_string(call), clean_string(region_type)))


def identity_interval(variant: Column) -> Column:
    """The first 12 hex digits of the SHA-1 as a number, for both ends."""
    value = F.conv(F.substring(F.sha1(variant.cast("binary")), 1, 12), 16, 10).cast("double")
    return F.array(value, value)


def safe_gene(x: Column) -> Column:
    return F.replace(x, F.lit("/"), F.lit("-"))


def encoded_gene(x: Column) -> Column:
    """Percent-encoded, as in the file name of an artifact."""
    return F.replace(F.replace(F.url_encode(strip(x)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))


def source_rank(source: Column, priority: tuple[str, ...]) -> Column:
    return F.coalesce(F.element_at(literal_map({s: i for i, s in enumerate(priority)}), source), F.lit(999999))


def disease_category(mapped: Column, parent: Column) -> Column:
    return F.coalesce(F.nullif(mapped, F.lit("")), F.when(strip(parent).try_cast("double").isNull(), slug(parent)))


def matches_terms(phenotypes: Column, terms: tuple[str, ...]) -> Column:
    if not terms:
        return F.lit(True)
    return F.exists(phenotypes, lambda p: F.lower(p).rlike("|".join("\\Q" + t.lower() + "\\E" for t in terms)))


# Classes of protein features in order of precedence, with their keywords.
FEATURE_CLASSES = (
    ("exons", ("translation_exon",)), ("transmembrane", ("transmembrane", "topological domain", "intramembrane")),
    ("low_complexity", ("low complexity", "compositional bias", "compositionally biased")), ("disorder", ("disorder",)),
    ("domains", ("domain", "family", "pfam")), ("repeats", ("repeat",)), ("sites", ("site", "binding", "active", "metal")),
    ("regions", ("region", "motif", "zinc finger")),
)


def feature_category(text: Column, source: Column | None = None) -> Column:
    """The first class whose keyword the lower-cased text holds; some sources decide by themselves, and "exon" alone is an exon."""
    t, out, source = F.lower(text), F.lit("other_features"), F.lit("") if source is None else F.coalesce(source, F.lit(""))
    for name, words in reversed(FEATURE_CLASSES):
        holds = t.rlike("|".join(words))
        if name == "exons":
            holds = holds | (t == "exon") | (source == "ensembl_translation_exon")
        if name == "domains":
            holds = holds | (source == "interpro")
        out = F.when(holds, name).otherwise(out)
    return out


def xref_kinds(name: Column, value: Column) -> Column:
    """array<string>: refseq and uniprot, by the database's name or the form of the identifier."""
    db = F.lower(F.coalesce(name, F.lit("")))
    refseq = F.contains(db, F.lit("refseq")) | value.rlike("^(NM_|NP_|XM_|XP_)")
    uniprot = F.contains(db, F.lit("uniprot")) | value.rlike(r"^[OPQ][0-9][A-Z0-9]{3}[0-9](-\d+)?$")
    return F.filter(F.array(F.when(refseq, "refseq"), F.when(uniprot, "uniprot")), lambda k: k.isNotNull())


def feature_range(*starts: Column, ends: tuple[Column, ...]) -> Column:
    """struct<start, end> of the first start and the first end that are numbers, in order; null if one is missing."""
    a, b = first_coordinate(*starts), first_coordinate(*ends)
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end")))


def regulation_json(entry: Column) -> Column:
    """An expression entry with up and down instead of upregulated and downregulated, missing and NaN as 0: either
    {"regulation": {..}} or one such object for each disease; a disease's value that is no object stays."""
    # JSON knows no NaN, which some writers put in bare
    text = F.regexp_replace(entry, r":\s*NaN", ": 0")
    number = lambda x, k: F.coalesce(to_float(F.get_json_object(x, f"$.{k}")), F.lit(0.0))
    both = lambda x: F.struct(number(x, "upregulated").alias("up"), number(x, "downregulated").alias("down"))
    flat = F.get_json_object(text, "$.regulation")
    by_disease = F.try_parse_json(text).cast("map<string,variant>")
    shown = F.transform_values(by_disease, lambda _, v: F.when(F.schema_of_variant(v).startswith("OBJECT"), F.parse_json(F.to_json(both(F.to_json(v))))).otherwise(v))
    return F.when(flat.startswith("{"), F.to_json(both(flat))).otherwise(F.to_json(shown))


def label_path(leaf: Column, category: Column, phenotype: Column) -> Column:
    """array<string>: the leaf's path in the tree, else category and phenotype as slugs, without blanks and without a repeat at the end."""
    c, p = F.nullif(slug(category), F.lit("")), F.nullif(slug(phenotype), F.lit(""))
    fallback = F.when(c.eqNullSafe(p), F.array(p)).otherwise(F.array(c, p))
    return F.coalesce(leaf, F.filter(fallback, lambda x: x.isNotNull()))


def gtf_attributes(field: Column) -> Column:
    """map<string, array<string>> of a GTF attribute column; a repeated key keeps all its values."""
    pairs = F.filter(F.transform(F.split(field, ";"), lambda p: strip(p)), lambda p: p != "")
    split = F.transform(pairs, lambda p: F.struct(F.substring_index(p, " ", 1).alias("k"), F.regexp_replace(F.regexp_replace(p, r"^\S+\s*", ""), '^"|"$', "").alias("v")))
    keys = F.array_distinct(F.transform(split, lambda s: s.k))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(split, lambda s: s.k == k), lambda s: s.v)))
