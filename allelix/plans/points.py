"""The given tables seen as association points, genes and intervals, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRIORITY = ("million_veteran_program", "legacy_cvd_raw", "legacy_trait_raw")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point for each lineitem row, with its order, part, customer, nation and region."""
    t = {n: read(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "customer", "nation", "region")}
    joined = (
        t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).join(t["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.selectExpr(*[f"{e} AS {c}" for c, e in COLUMNS.items()])


#: Each column as an expression that Spark and DuckDB read alike.
COLUMNS = {
    "dataset_id": "concat('ds_', lower(l_returnflag))",
    "dataset_type": "CASE WHEN o_orderstatus = 'O' THEN 'TRAIT' ELSE 'CVD' END",
    "source": "CASE l_returnflag WHEN 'A' THEN 'legacy_cvd_raw' WHEN 'N' THEN 'legacy_trait_raw' ELSE 'million_veteran_program' END",
    "gene_id": "CASE WHEN p_size < 3 THEN cast(p_size AS varchar(12)) ELSE p_brand END",
    "variant_id": "concat('rs', cast(l_partkey AS varchar(20)))",
    "phenotype": "o_orderpriority",
    "disease_category": "lower(c_mktsegment)",
    "variation_type": "CASE p_size % 6 WHEN 0 THEN 'snp' WHEN 1 THEN 'copy_number_variant' WHEN 2 THEN 'indel' WHEN 3 THEN 'Unknown' WHEN 4 THEN p_type END",
    "clinical_significance": "CASE p_size % 8 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN concat('[', chr(39), 'benign', chr(39), ', ', chr(39), 'Likely_benign', chr(39), ']') WHEN 2 THEN 'Uncertain_significance' WHEN 3 THEN 'not provided' WHEN 4 THEN 'risk factor' WHEN 5 THEN '[drug response, association]' WHEN 6 THEN concat('[', chr(39), 'Pathogenic, low penetrance', chr(39), ', ', chr(39), 'benign', chr(39), ']') END",
    "parent_phenotype": "CASE p_size % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN '250' WHEN 2 THEN '' END",
    "ancestry_source_label": "concat(n_name, ' (source)')",
    "phenotype_key": "CASE p_size % 3 WHEN 0 THEN concat('pk_', cast(p_size AS varchar(12))) WHEN 1 THEN '' END",
    "ancestry_text": "concat('{\"African\": ', cast(p_size AS varchar(12)), ', \"European\": {\"MAF\": \"', cast(l_linenumber AS varchar(4)), '\"}, \"Total\": \"nan\", \"Other\": {\"value\": ', cast(p_size AS varchar(12)), '}}')",
    "most_severe_consequence": "replace(p_name, ' ', '_')",
    "p_value": "nullif(l_tax, 0)",
    "ancestry": "r_name",
    "ancestry_af": "l_extendedprice / 200000",
    "ancestry_source_code": "n_name",
    "source_file": "concat('file_', cast(l_orderkey % 7 AS varchar(4)))",
    "ingested_at": "cast(l_shipdate AS timestamp)",
    "row_key": "concat_ws('|', lpad(cast(l_orderkey AS varchar(20)), 12, '0'), lpad(cast(l_linenumber AS varchar(4)), 3, '0'), lpad(cast(l_partkey AS varchar(20)), 12, '0'), lpad(cast(l_suppkey AS varchar(20)), 12, '0'), lpad(cast(cast(round(l_extendedprice * 100) AS bigint) AS varchar(20)), 14, '0'))",
    "messy": "CASE l_linenumber % 6 WHEN 0 THEN concat('  ', o_orderpriority, ' ') WHEN 1 THEN 'NaN' WHEN 2 THEN concat('\"', p_name, '\"') WHEN 3 THEN 'n/a' WHEN 5 THEN concat('A/b__', p_name, ' ') END",
    "number_text": "CASE l_linenumber % 6 WHEN 0 THEN cast(l_partkey AS varchar(20)) WHEN 1 THEN 'abc' WHEN 3 THEN concat(cast(p_size AS varchar(12)), '.5') WHEN 4 THEN ' 12 ' WHEN 5 THEN 'nan' END",
    "flag_text": "CASE l_linenumber % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'true' WHEN 2 THEN '0' WHEN 3 THEN ' no ' WHEN 4 THEN 'maybe' END",
    "ref": "CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'AC' END",
    "alt": "CASE l_linenumber % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'TTG' ELSE ' ' END",
    "marker": "CASE l_linenumber % 4 WHEN 0 THEN concat('rs', cast(l_partkey AS varchar(20)), '-A') WHEN 1 THEN concat('rs', cast(l_partkey AS varchar(20))) WHEN 2 THEN '' ELSE concat('chr1:', cast(l_partkey AS varchar(20)), '-G') END",
    "chrom_text": "CASE l_linenumber % 4 WHEN 0 THEN concat('chr', cast(p_size AS varchar(12))) WHEN 1 THEN 'CHRX' WHEN 2 THEN '07' ELSE ' Y ' END",
    "list_text": "concat(o_orderpriority, '; ', p_type, ';', o_orderpriority, '; nan;')",
    "code_text": "CASE l_linenumber % 4 WHEN 0 THEN 'eur' WHEN 1 THEN ' AFR ' WHEN 2 THEN 'XYZ' ELSE 'SAS' END",
    "ci_text": "CASE l_linenumber % 3 WHEN 0 THEN concat(cast(p_size AS varchar(12)), ', 77') WHEN 1 THEN 'wide' END",
}
SQL = (
    "WITH points AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in COLUMNS.items()) + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)


def intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Variants from orders, genes from parts, as chromosome, start and end."""
    variants = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS variant", "o_custkey % 24 AS v_chrom", "o_orderkey * 100 AS v_start", "o_orderkey * 100 + cast(floor(o_totalprice / 100) AS bigint) AS v_end")
    genes = read(spark, sf_dir, "part").selectExpr("p_partkey AS gene", "p_partkey % 24 AS g_chrom", "p_partkey * 750 AS g_start", "p_partkey * 750 + cast(p_size AS bigint) * 1000 AS g_end")
    return variants, genes


INTERVALS_SQL = (
    "WITH v AS (SELECT o_orderkey AS variant, o_custkey % 24 AS v_chrom, o_orderkey * 100 AS v_start, o_orderkey * 100 + cast(floor(o_totalprice / 100) AS bigint) AS v_end FROM orders), "
    "g AS (SELECT p_partkey AS gene, p_partkey % 24 AS g_chrom, p_partkey * 750 AS g_start, p_partkey * 750 + cast(p_size AS bigint) * 1000 AS g_end FROM part)"
)


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(*[f"{e} AS {c}" for c, e in TRANSCRIPT.items()])


TRANSCRIPT = {
    "gene_id": "concat(p_brand, cast(p_partkey % 40 AS varchar(12)))", "transcript_id": "concat('T', lpad(cast(p_partkey AS varchar(20)), 10, '0'))", "is_canonical": "p_size % 20 = 0", "gencode_primary": "p_size % 15 = 0", "ord": "p_partkey", "is_mane": "p_size % 5 = 0",
    "is_appris": "p_partkey % 3 = 0", "hinted": "p_partkey % 19 = 0", "biotype": "CASE WHEN p_partkey % 2 = 0 THEN 'protein_coding' ELSE 'lncRNA' END", "span": "cast(floor(p_retailprice) AS bigint)",
}
TRANSCRIPT_SQL = "WITH transcripts AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in TRANSCRIPT.items()) + " FROM part)"
