"""Registered queries of readers and sinks: the given tables written in each layout that a reader knows, or by a sink, and read again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.operators import publish as pub
from allelix.plans import jobs
from allelix.plans import sqltext as q
from allelix.plans.points import SQL, points, read
from allelix.sources import adapters as ad
from allelix.sources import archives, files, readers, sinks
from allelix.sources.scratch import folder

QUERIES, ORACLES = {}, {}
c = F.col


def add(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return keep


def written(rows: DataFrame, root: str) -> int:
    """Write each row (path, text) as a file of its own below `root`, gzipped if its name ends so, in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, at = archives._place(f"{root}/{path}")
                system.create_dir(at.rpartition("/")[0], recursive=True)
                with system.open_output_stream(at, compression="gzip" if path.endswith(".gz") else None) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return rows.select("path", "text").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0]


# structural-variant files with a byte-order mark, zipped
_SV_COLUMNS = {
    "﻿Variant ID": "CASE WHEN o_orderkey % 9 > 0 THEN 'v' || cast(o_orderkey AS varchar(20)) ELSE 'n/a' END", "Study ID": "concat('s', cast(o_custkey % 5 AS varchar(4)))", "Chromosome": "CASE o_custkey % 3 WHEN 0 THEN 'chr07' WHEN 1 THEN 'X' ELSE cast(o_custkey % 20 AS varchar(4)) END",
    "Inner Start": "CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderkey * 10 AS varchar(20)) END", "Start": "cast(o_orderkey * 10 + 5 AS varchar(20))", "End": "CASE WHEN o_orderkey % 7 > 0 THEN cast(o_orderkey * 10 + 100 - o_custkey % 200 AS varchar(20)) END",
    "Variant Region type": "' CNV '", "Subject Phenotype": "concat(o_orderpriority, '; n/a;', o_orderstatus, ';', o_orderpriority)", "Assembly Name": "'g38'",
}
_SV_SQL = "raw AS (SELECT " + ", ".join(f'{e} AS "{n.lstrip(chr(0xFEFF))}"' for n, e in _SV_COLUMNS.items()) + " FROM orders)"
_SV_START = 'coalesce("Inner Start", "Start")::bigint'


def structural_files(s: SparkSession, d: str) -> DataFrame:
    root = folder(s, "structural")
    rows = read(s, d, "orders").selectExpr(*[f"{e} AS `{n}`" for n, e in _SV_COLUMNS.items()])
    archives.write_zipped(rows.coalesce(3), root, "sv", "\t")
    return ad.structural_rows(files.sniffed(s, root))


@add(
    "A10_structural_files",
    f"WITH {_SV_SQL} SELECT \"Variant ID\" AS variant_id, \"Study ID\" AS study_id, CASE \"Chromosome\" WHEN 'chr07' THEN '7' ELSE \"Chromosome\" END AS chrom, least({_SV_START}, \"End\"::bigint) AS start, greatest({_SV_START}, \"End\"::bigint) AS end_, 'cnv' AS variant_type, list_extract(string_split(\"Subject Phenotype\", ';'), 1) || '|' || list_extract(string_split(\"Subject Phenotype\", ';'), 3) AS phenotypes, 'g38' AS assembly_name FROM raw WHERE \"Variant ID\" <> 'n/a' AND \"End\" IS NOT NULL",
)
def _(s, d):
    return structural_files(s, d).select("variant_id", "study_id", "chrom", "start", c("end").alias("end_"), "variant_type", F.array_join("phenotypes", "|").alias("phenotypes"), "assembly_name")


@add("M4_structural_adapter", f"WITH {_SV_SQL} SELECT \"Study ID\" AS gene_id, \"Variant ID\" AS variant_id, {q.slug('p')} AS phenotype, 'cnv' AS variation_type FROM (SELECT *, unnest([list_extract(string_split(\"Subject Phenotype\", ';'), 1), list_extract(string_split(\"Subject Phenotype\", ';'), 3)]) AS p FROM raw) WHERE \"Variant ID\" <> 'n/a' AND \"End\" IS NOT NULL")
def _(s, d):
    """The structural adapter by its name in a configuration: records of rows that name a gene."""
    root = folder(s, "structural")
    rows = read(s, d, "orders").selectExpr(*[f"{e} AS `{n}`" for n, e in _SV_COLUMNS.items()]).withColumn("gene", c("Study ID"))
    archives.write_zipped(rows.coalesce(2), root, "sv", "|")
    found = ad.ingest(s, [{"adapter": "dbvar", "paths": root, "params": {"genes": "gene"}}])
    return found.select("gene_id", "variant_id", "phenotype", "variation_type")


_GTF = (
    "concat_ws(chr(9), concat('chr', cast(p_size % 23 AS varchar(4))), 'src', CASE p_partkey % 4 WHEN 0 THEN 'gene' WHEN 1 THEN 'transcript' WHEN 2 THEN 'exon' ELSE 'CDS' END, cast(p_partkey AS varchar(20)), cast(p_partkey + p_size AS varchar(20)), '.', "
    "CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END, '.', concat('gene_id \"', p_brand, '.3\"; gene_name \"', p_name, '\"; transcript_id \"T', cast(p_partkey AS varchar(20)), '.2\"; exon_number ', cast(p_size AS varchar(4)), '; tag \"basic\"; tag \"t', cast(p_size AS varchar(4)), '\";'))"
)


@add("A12_gtf", "SELECT cast(p_size % 23 AS varchar) AS chrom, CASE p_partkey % 4 WHEN 0 THEN 'gene' WHEN 1 THEN 'transcript' ELSE 'exon' END AS feature, p_partkey AS start, p_partkey + p_size AS end_, CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END AS strand, p_brand AS gene_id, p_name AS gene_name, 'T' || p_partkey AS transcript_id, cast(p_size AS bigint) AS exon_number, 'basic,t' || p_size AS tags FROM part WHERE p_partkey % 4 < 3")
def _(s, d):
    root = folder(s, "gtf")
    lines = read(s, d, "part").selectExpr(f"{_GTF} AS value")
    lines.unionByName(s.createDataFrame([("#!genome-build x",)], "value string")).coalesce(2).write.option("compression", "gzip").text(root)
    return readers.gtf(s, root).select("chrom", "feature", "start", c("end").alias("end_"), "strand", "gene_id", "gene_name", "transcript_id", "exon_number", F.array_join("tags", ",").alias("tags"))


@add("A14_shared_folder", "SELECT n_name AS gene_id, CASE WHEN r_regionkey % 2 = 0 THEN 'cvd' ELSE 'trait' END AS type, r_name AS name, n_nationkey AS n FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(s, d):
    """A file for each region in the folder of its type, an object by nation; region names hold blanks, so files are percent-encoded."""
    root = folder(s, "shared")
    rows = read(s, d, "nation").join(read(s, d, "region"), c("n_regionkey") == c("r_regionkey"))
    each = rows.groupBy(F.when(c("r_regionkey") % 2 == 0, "cvd").otherwise("trait").alias("type"), "r_name").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", F.struct(c("n_nationkey").alias("n")))))).alias("text"))
    written(each.select(F.concat("type", F.lit("/"), F.replace("r_name", F.lit(" "), F.lit("%20")), F.lit(".json")).alias("path"), "text"), root)
    return files.shared_lists(s, root).select("gene_id", "type", "name", F.get_json_object("entry", "$.n").cast("int").alias("n"))


@add("A16_gene_artifacts", "SELECT n_name AS gene_id, upper(n_name) AS gene_id_normalized, n_nationkey * CASE WHEN n_nationkey % 3 = 0 THEN 10 ELSE 1 END AS n FROM nation")
def _(s, d):
    """A payload for each nation by percent-encoded name, every third also gzipped with another value, which counts; hidden and metadata files apart."""
    root = folder(s, "artifacts")
    name = F.replace("n_name", F.lit(" "), F.lit("%20"))
    rows = read(s, d, "nation").select(F.concat(name, F.lit(".json")).alias("path"), F.to_json(F.struct(c("n_nationkey").alias("n"))).alias("text"), "n_nationkey", name.alias("name"))
    zipped = rows.where("n_nationkey % 3 = 0").select(F.concat("name", F.lit(".json.gz")).alias("path"), F.to_json(F.struct((c("n_nationkey") * 10).alias("n"))).alias("text"))
    other = s.createDataFrame([("metadata.json", "{}"), (".hidden.json", "{}")], "path string, text string")
    written(rows.select("path", "text").unionByName(zipped).unionByName(other), root)
    return files.artifact_files(s, root).select("gene_id", "gene_id_normalized", F.get_json_object("payload", "$.n").cast("int").alias("n"))


@add("A17_isoform_files", "SELECT 'NP_' || p_partkey AS protein_id, cast(p_size AS bigint) AS length_aa FROM part WHERE p_partkey % 5 > 0")
def _(s, d):
    """Two tables, one with tabs and the column max, one with commas and protein_length; rows without id apart."""
    root = folder(s, "isoforms")
    rows = read(s, d, "part").select(F.when(c("p_partkey") % 5 > 0, F.concat(F.lit("NP_"), c("p_partkey").cast("string"))).alias("protein_id"), "p_size", "p_partkey")
    for rest, (column, delimiter) in enumerate((("max", "\t"), ("protein_length", ","))):
        rows.where(c("p_partkey") % 2 == rest).select("protein_id", c("p_size").alias(column)).coalesce(1).write.mode("append").option("header", True).option("sep", delimiter).csv(root)
    return files.isoform_rows(s, root).select("protein_id", "length_aa")


@add("A18_gene_map_file", "SELECT p_brand AS gene_id, max(p_size) || '-9' AS gene_location, cast(-1 AS bigint) AS strand FROM part GROUP BY ALL")
def _(s, d):
    """A metadata map as one file."""
    root = folder(s, "seed")
    rows = read(s, d, "part").groupBy("p_brand").agg(F.max("p_size").alias("n"))
    entry = F.struct(F.concat(c("n").cast("string"), F.lit("-9")).alias("gene_location"), F.lit("-1").alias("strand"))
    written(rows.agg(F.lit("seed.json").alias("path"), F.to_json(F.map_from_entries(F.collect_list(F.struct("p_brand", entry)))).alias("text")), root)
    return files.gene_seed(s, f"{root}/seed.json").select("gene_id", "gene_location", "strand")


# sinks
@add("B1_canonical_records", jobs.ORACLES["A8_prepared_records"].replace("json_extract_string(ancestry_data, '$.African.MAF') AS african", "json_extract_string(ancestry_data, '$.African.MAF') AS african, 'd' AS dataset_id"))
def _(s, d):
    """Records written twice, the second time as they stand, and read back with their ancestry maps."""
    root = folder(s, "canonical")
    records = ad.prepared_records(jobs._raw(s, d, jobs._PREP), jobs.types(s), dataset_id="d")
    sinks.write_canonical(records.withColumn("variant_id", F.lit("old")), root)
    sinks.write_canonical(records, root)
    found = sinks.read_canonical(s, root)
    return found.select("gene_id", "variant_id", "phenotype", "dataset_type", "variation_type", c("ancestry")["African"].alias("african"), F.get_json_object("metadata", "$.functional_class").alias("kind"), "dataset_id")


@add("B10_prepared_files", jobs.ORACLES["N2_prepared"])
def _(s, d):
    root = folder(s, "prepared")
    sinks.write_prepared(ad.prepared(jobs._raw(s, d, jobs._LEGACY), "CVD", "x"), root)
    rows = files.sniffed(s, root)
    blank = lambda n: F.coalesce(c(n), F.lit("")).alias(n)
    return rows.select("rsid", "gene", "phenotype", c("pval").cast("double").alias("p"), blank("var_class"), "marker_id", blank("pmid"), F.get_json_object("ancestry_data", "$.Total.MAF").cast("double").alias("total"))


@add(
    "B11_prepared_export",
    f"{jobs._LONG_SQL} SELECT gene_id AS gene, variant_id AS rsid, coalesce(phenotype_key, '') AS mvp_phenotype_key, min(p) AS pval, 27 AS n_columns FROM (SELECT *, coalesce(phenotype_key, phenotype) AS k FROM l) GROUP BY dataset_type, gene_id, variant_id, source_file, k, coalesce(phenotype_key, '')",
)
def _(s, d):
    """The long layout's records exported in 27 columns, written as CSV and read again."""
    root = folder(s, "export")
    records = ad.merged_long(ad.long_rows(jobs._raw(s, d, jobs._LONG), jobs.types(s)))
    rows = ad.prepared_export(records)
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(root)
    back = files.sniffed(s, root)
    return back.select("gene", "rsid", F.coalesce("mvp_phenotype_key", F.lit("")).alias("mvp_phenotype_key"), c("pval").cast("double").alias("pval"), F.lit(len(back.columns) - 1).alias("n_columns"))


@add("B9_artifacts_in_parts", "SELECT p_brand AS gene_id, count(*) AS n, '3' AS version FROM part GROUP BY ALL")
def _(s, d):
    """Artifact rows of three parts by a hash of the gene, each with a metadata row of its own."""
    from allelix.operators import records as rec

    root = folder(s, "artifacts")
    rows = read(s, d, "part").groupBy(c("p_brand").alias("gene_id")).agg(F.count("*").alias("n"))
    for part in range(3):
        sinks.write_artifacts(rec.hash_part(rows, "gene_id", 3, part), root, {"version": part + 1, "parts": 3}, part, 3)
    told = s.read.json(f"{root}/metadata.part*").where("name = 'version'").agg(F.max("value").alias("version"))
    return s.read.option("recursiveFileLookup", True).json(f"{root}/payloads").select("gene_id", "n").crossJoin(F.broadcast(told))


@add("B3_payload_files", f"{SQL} SELECT dataset_type, gene_id, count(*) AS n FROM points WHERE {q.GENE} GROUP BY ALL")
def _(s, d):
    """Payload rows as gzipped JSON lines by type, read back."""
    root = folder(s, "payloads")
    rows = points(s, d).where("gene_id is not null")
    rows = rows.where(F.col("gene_id").rlike("[A-Za-z]")).groupBy(*pub.GENE).agg(F.to_json(F.struct(F.count("*").alias("n"))).alias("payload_json"))
    sinks.write_payloads(rows, root)
    return s.read.json(root).select(*pub.GENE, F.get_json_object("payload_json", "$.n").cast("bigint").alias("n"))
